"""Debug dumps and tag lists as tables: functions, segments, lines, source text.

A dump is a table of (dump, pos, line). Headers and paths are carried to the
rows behind them by scans over ranges of lines, so a dump may be of any length;
nothing is parsed row by row in Python.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from buildlake.functions import numbers, text
from buildlake.operators import numbering, scans, sequences

# fixed value: line numbers beyond this are the compiler's own
HIDDEN_LINE = 10_000_000


def text_lines(files: DataFrame, key: str, content: str) -> DataFrame:
    """(key, pos, line) of whole texts, positions from 0."""
    return files.select(key, F.posexplode(F.split(F.col(content), "\r?\n")).alias("pos", "line"))


def dump_rows(lines: DataFrame, per: str = "dump", end_closes: bool = True) -> DataFrame:
    """Line rows of dumps with their function, source file and digest; rows before a header or a path have nulls.

    A row closes its run if the line behind it is none; ``end_closes``: the end
    of the dump closes one as well. rva_start is the header's first address,
    share the share of hidden lines in the length of its lines so far. A dump
    may have any number of lines: they are scanned in ranges, those of
    ``numbering.in_ranges`` by ``per`` and pos where ``lines`` has them.
    """
    if "__at" not in lines.columns:
        lines = numbering.in_ranges(lines.select(per, "pos", "line"), ["pos"], [per])

    def read(rows: DataFrame) -> DataFrame:
        # each step is a column of its own, so no text is searched again by every expression that reads it
        line, kept = F.col("line"), [F.col(f"`{c}`") for c in rows.columns if c != "line"]
        rows = rows.withColumn("line", text.stripped(line)).withColumns({"is_header": line.startswith("**"), "is_row": line.startswith("line")})
        header, row = F.col("is_header"), F.col("is_row")
        rows = rows.withColumns({"path": F.when(row, F.regexp_extract(line, r"(\w:\\.*)$", 1)), "length": F.when(row, F.regexp_extract(line, r"len = (\w+)", 1))})
        rows = rows.withColumns({
            "function": F.when(header, F.replace(F.replace(line, F.lit("**"), F.lit("")), F.lit(" "), F.lit(""))),
            "path": F.when(F.col("path") != "", F.col("path")),
            "line_number": F.when(row, F.regexp_extract(line, r"line (\d+)", 1).cast("long")),
            "rva": F.when(row, F.regexp_extract(line, r"at \[(\w+)\]", 1)),
            "length": numbers.from_hex(F.col("length")),
        })
        return rows.select(*kept, "is_row", "is_header", "function", "path", "line_number", "rva", "length")

    begins = F.col("is_header")
    found = scans.scanned_ranges(lines, [per], {
        "header": scans.Sum(F.when(begins, 1).otherwise(0)),
        "function": scans.Last(F.col("function")),
        "path": scans.Last(F.col("path")),
        "rva_start": scans.First(F.col("rva"), begins),
        "total": scans.Sum(F.col("length"), begins),
        "hidden": scans.Sum(F.when(F.col("line_number") > HIDDEN_LINE, F.col("length")), begins),
        "next_is_row": scans.Following(F.col("is_row")),
    }, read)
    source = text.digest_of_path(F.col("path"))
    share = F.when(F.col("total") != 0, F.col("hidden") / F.col("total")).otherwise(F.lit(0.0))
    closes = ~F.coalesce("next_is_row", F.lit(not end_closes))
    return found.where("is_row").select(per, "pos", "header", "function", "line_number", "rva", "length", source["file"].alias("source_file"), source["digest"].alias("digest"), closes.alias("closes"), "rva_start", share.alias("share"))


def segments(rows: DataFrame, per: str = "dump") -> DataFrame:
    """One row for each closed run of ``dump_rows``: from its header's first address to behind the run's last line.

    debug_ratio is the share of hidden lines since the header. A header's runs
    share the first address, as the dump's reader keeps one record a header.
    """
    return rows.where("closes").select(per, "function", "header", "pos", "rva_start", numbers.hex_plus(F.col("rva"), F.col("length")).alias("rva_end"), F.col("share").alias("debug_ratio"))


def with_source(rows: DataFrame, sources: DataFrame) -> DataFrame:
    """Line rows with their source text (1-based, trimmed); empty where there is none. ``sources``: source_file, content."""
    found = text_lines(sources, "source_file", "content").select("source_file", (F.col("pos") + 1).cast("long").alias("line_number"), text.stripped(F.col("line")).alias("source_code"))
    return rows.join(found, ["source_file", "line_number"], "left").withColumn("source_code", F.coalesce("source_code", F.lit("")))


def tag_rows(lines: DataFrame) -> DataFrame:
    """(file, name, start, end, definition) of tag lines: fields from both ends, white space between."""
    parts = F.split(text.stripped(F.col("line")), r"\s+")
    value = lambda i: F.element_at(F.split(F.element_at(parts, i), ":"), -1)
    name = F.element_at(F.split(F.replace(F.replace(F.element_at(parts, 1), F.lit("/^"), F.lit("")), F.lit("$/;"), F.lit("")), r"\("), 1)
    good = (F.size(parts) >= 4) & ~F.element_at(parts, 1).startswith("__anon")
    rows = lines.where(good).select(F.element_at(parts, 2).alias("file"), name.alias("name"), value(-2).alias("start"), value(-1).alias("end"), F.array_join(F.slice(parts, 3, F.size(parts) - 4), " ").alias("definition"))
    return rows.where(F.col("start").rlike("^[0-9]+$") & F.col("end").rlike("^[0-9]+$")).withColumns({"start": F.col("start").cast("long"), "end": F.col("end").cast("long")})


def function_texts(tags: DataFrame, sources: DataFrame, step: int = 64) -> DataFrame:
    """(file, name, start, end, body) with starts extended to the previous end and leading directives trimmed.

    ``sources``: file, content. A line may be in several functions.
    """
    spans = sequences.extended_starts(tags.withColumn("tag_start", F.col("start")), "start", "end", ["file"], ["tag_start", "name"])
    lines = text_lines(sources, "file", "content")
    spans = spans.withColumns({"lo": F.greatest(F.col("start") - 1, F.lit(0)), "hi": F.col("end") - 1})
    inside = sequences.range_join(lines, "pos", spans, "lo", "hi", step, ("file",))
    directive = F.col("line").contains("#") | (F.col("line").contains("}") & F.col("line").contains(";"))
    key = ["file", "name", "tag_start", "end"]
    kept = sequences.leading_trimmed(inside, directive, key, ["pos"])
    body = F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("pos", "line"))), lambda r: r["line"]), "\n")
    return kept.groupBy(*key, F.col("start")).agg(body.alias("body"))


def matched_functions(functions: DataFrame, tags: DataFrame, order: list[str], on: tuple[str, ...] = ()) -> DataFrame:
    """Each debug function with the first tag of its name, whatever the case, and of equal ``on`` columns.

    If both names are qualified they are compared whole, else without their
    namespaces; so each side has up to two keys and the join is by equality.
    """
    def keyed(table: DataFrame, name: str) -> DataFrame:
        low = F.lower(name)
        qualified = F.col(name).contains("::")
        both = F.when(qualified, F.array(F.concat(F.lit("w:"), low), F.concat(F.lit("q:"), text.unqualified(low)))).otherwise(F.array(F.concat(F.lit("u:"), low)))
        return table.withColumn("__key", F.explode(both))

    left = keyed(functions, "function")
    right = keyed(tags.withColumnRenamed("name", "tag"), "tag")
    # whole with whole; a bare name with a bare or a stripped one
    left = left.withColumn("__key", F.explode(F.when(F.col("__key").startswith("u:"), F.array("__key", F.concat(F.lit("q:"), F.substring("__key", 3, 1 << 20)))).when(F.col("__key").startswith("q:"), F.array(F.concat(F.lit("u:"), F.substring("__key", 3, 1 << 20)))).otherwise(F.array("__key"))))
    # the first tag of a key is the first of all functions that meet it
    first = right.groupBy(*on, "__key").agg(F.min(F.struct(*[F.col(c).alias(f"__at{i}") for i, c in enumerate(order)], "tag")).alias("__t"))
    best = left.join(first, [*on, "__key"]).groupBy(*functions.columns).agg(F.min("__t").alias("__t"))
    return best.select(*functions.columns, "__t.tag", *[F.col(f"__t.__at{i}").alias(c) for i, c in enumerate(order)])


TAG_FIELDS = ("ctag_definitions", "top_comments", "body_comments", "source_codes_ctags", "prototype", "source_codes")


def with_tag_fields(functions: DataFrame, tags: DataFrame) -> DataFrame:
    """Debug functions (function, source_file, others) with the fields of the first tag of their name in their file; nulls without one.

    ``tags``: source_file, name, at (place in the file) and ``TAG_FIELDS``. Files
    meet without the digest behind them.
    """
    plain = functions.withColumn("__file", text.digest_of_path(F.col("source_file"))["file"])
    keys = plain.select("function", "__file").distinct()
    found = matched_functions(keys, tags.withColumnRenamed("source_file", "__file"), ["at"], ("__file",))
    # of a name with several tags the first place decides, then the least fields
    listed = tags.groupBy(F.col("source_file").alias("__file"), F.col("name").alias("tag"), "at").agg(F.min(F.struct(*TAG_FIELDS)).alias("__fields"))
    fields = found.join(listed, ["__file", "tag", "at"]).select("function", "__file", "__fields")
    return plain.join(fields, ["function", "__file"], "left").select(*functions.columns, *[F.col(f"__fields.{c}").alias(c) for c in TAG_FIELDS])


def first_gap_filled(rows: DataFrame, per: list[str], order: list[str], known: DataFrame) -> DataFrame:
    """Line rows; the first one of each function without source text gets it from ``known`` (source_file, line_number, source_code)."""
    gap = F.min_by(F.struct(*order), F.when(F.coalesce("source_code", F.lit("")) == "", F.struct(*order))).alias("__gap")
    marked = rows.join(rows.groupBy(*per).agg(gap), per)
    found = known.groupBy("source_file", "line_number").agg(F.min("source_code").alias("__found"))
    joined = marked.join(found, ["source_file", "line_number"], "left")
    here = F.coalesce(F.struct(*order) == F.col("__gap"), F.lit(False))
    return joined.withColumn("source_code", F.when(here, F.coalesce("__found", F.lit(""))).otherwise(F.col("source_code"))).select(*rows.columns)


def span_of_functions(rows: DataFrame, key: list[str], start: str, end: str) -> DataFrame:
    """Lowest and highest address of each function."""
    return rows.groupBy(*key).agg(F.min(F.least(start, end)).alias("first"), F.max(F.greatest(start, end)).alias("last"))
