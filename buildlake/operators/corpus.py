"""Dataset generation: from build documents and files to binaries, functions and lines."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from buildlake.functions import numbers, text, times
from buildlake.operators.lookup import within_size
from buildlake.operators.numbering import with_keys


def identified(documents: DataFrame) -> DataFrame:
    """Build documents with their composite identifier; an unknown platform is ``unknown`` everywhere."""
    return documents.withColumns({
        "Platform": F.coalesce("Platform", F.lit("unknown")),
        "identifier": numbers.identifier(F.col("URL"), F.col("Platform"), F.col("Build_mode"), F.col("Toolset_version"), F.col("Optimization")),
    })


def path_of(name: Column) -> Column:
    """Hash-partitioned path of a file: two digits, the other digits."""
    digits = F.md5(text.printable(name))
    return F.concat_ws("/", F.left(digits, F.lit(2)), F.substring(digits, 3, 30))


def described_binaries(documents: DataFrame) -> DataFrame:
    """One row for each binary that a document lists, keyed by identifier and file name."""
    listed = identified(documents).withColumn("b", F.explode("Binary_info_list"))
    return listed.select("identifier", text.base_name(F.col("b.file")).alias("file_name"), F.col("b.functions").alias("functions"))


def dataset_binaries(files: DataFrame, documents: DataFrame, least_kb: float | None = None, most_kb: float | None = None, least_files: int = 2) -> tuple[DataFrame, DataFrame]:
    """(binaries with their functions, dropped binaries) from files (identifier, file_name, n_bytes).

    Files of the wanted size whose folder has ``least_files`` or more are
    joined with what the documents list. Unlisted files stay, without
    functions; files listed with no function are dropped. Keys follow the
    order of identifier and name.
    """
    sized = within_size(files, F.col("n_bytes"), least_kb, most_kb)
    folders = sized.groupBy("identifier").agg(F.count(F.lit(1)).alias("__n")).where(F.col("__n") >= least_files)
    meta = identified(documents).select("identifier", F.col("Platform").alias("platform"), F.col("Build_mode").alias("build_mode"), F.col("Toolset_version").alias("toolset_version"), F.col("URL").alias("github_url"), F.col("Optimization").alias("optimization"), times.message_time(F.col("Pushed_at")).alias("pushed_at"))
    found = sized.join(folders, "identifier", "left_semi").join(meta, "identifier")
    listed = described_binaries(documents).dropDuplicates(["identifier", "file_name"])
    joined = found.join(listed, ["identifier", "file_name"], "left")
    full = joined.where(F.col("functions").isNull() | (F.size("functions") > 0))
    keyed = with_keys(full.withColumn("size", numbers.whole_kb(F.col("n_bytes"))).drop("n_bytes"), "id", ["identifier", "file_name"])
    # the path follows from the name, so it isn't moved with the row
    out = keyed.withColumn("path", path_of(F.concat_ws("_", "identifier", "file_name")))
    return out, joined.where(F.size("functions") == 0)


def segment_text(segments: Column) -> Column:
    """``start-end,start-end`` of an array of segments."""
    return F.array_join(F.transform(segments, lambda s: F.concat(s["rva_start"], F.lit("-"), s["rva_end"])), ",")


def dataset_functions(binaries: DataFrame) -> DataFrame:
    """Functions of binaries (id, functions), with keys and their lines."""
    rows = binaries.select(F.col("id").alias("binary_id"), F.posexplode("functions").alias("at", "f"))
    flat = rows.select("binary_id", "at", F.col("f.function_name").alias("name"), F.col("f.source_file").alias("source_file"), text.ratio_of_percent(F.col("f.intersect_ratio")).alias("intersect_ratio"), segment_text(F.col("f.function_info")).alias("rvas"), F.col("f.lines").alias("lines"))
    return with_keys(flat, "id", ["binary_id", "at"]).drop("at")


def dataset_lines(functions: DataFrame) -> DataFrame:
    rows = functions.select(F.col("id").alias("function_id"), F.posexplode("lines").alias("at", "l")).select("function_id", "at", "l.line_number", "l.rva", "l.length", "l.source_code")
    return with_keys(rows, "id", ["function_id", "at"]).drop("at")


def build_documents(binaries: DataFrame, functions: DataFrame, lines: DataFrame) -> DataFrame:
    """The reverse: functions with their lines nested into binaries, one row a binary."""
    per_function = lines.groupBy("function_id").agg(F.array_sort(F.collect_list(F.struct("line_number", "rva", "length", "source_code"))).alias("lines"))
    full = functions.join(per_function, functions["id"] == per_function["function_id"], "left")
    per_binary = full.groupBy("binary_id").agg(F.array_sort(F.collect_list(F.struct("name", "source_file", "rvas", "lines"))).alias("functions"))
    return binaries.join(per_binary, binaries["id"] == per_binary["binary_id"], "left").drop("binary_id")


def function_bytes(functions: DataFrame, images: DataFrame) -> DataFrame:
    """Each function's bytes: its segments one by one, and the span from first to last.

    ``functions``: file_name, name, segments (array of start and end offsets);
    ``images``: file_name, content.
    """
    joined = functions.join(images, "file_name")
    cut = lambda s, e: F.substring(F.col("content"), s + 1, e - s)
    first = F.array_min(F.transform("segments", lambda s: F.least(s["start"], s["end"])))
    last = F.array_max(F.transform("segments", lambda s: F.greatest(s["start"], s["end"])))
    return joined.select("file_name", "name", F.transform("segments", lambda s: cut(s["start"], s["end"])).alias("slices"), cut(first, last).alias("span"))


def reassembled(chunks: DataFrame, stream: str, seq: str, content: str) -> DataFrame:
    """Each stream's chunks in order, joined, with the SHA-256 of the whole: a content address."""
    parts = F.array_sort(F.collect_list(F.struct(seq, content)))
    whole = F.array_join(F.transform(parts, lambda p: p[content]), "")
    return chunks.groupBy(stream).agg(F.count(F.lit(1)).alias("chunks"), whole.alias("content")).withColumn("sha256", F.sha2(F.col("content"), 256))


def suffix_listed(files: DataFrame, path: str, listed: DataFrame, ending: str, last: bool = False) -> DataFrame:
    """Files with the first (or ``last``) listed entry that their path ends with, by the entries' order ``at``.

    Both sides meet on the base name, which ending and path share, and only
    then are compared whole.
    """
    base = text.base_name
    left = files.withColumn("__base", base(F.col(path)))
    right = listed.withColumn("__base", base(F.col(ending)))
    found = left.join(right, "__base").where(F.col(path).endswith(F.col(ending)))
    pick = F.max_by if last else F.min_by
    return found.groupBy(*files.columns).agg(pick(F.struct(*listed.columns), "at").alias("l")).select(*files.columns, "l.*")


def marked_disassembled(binaries: DataFrame, done: DataFrame, key: str = "_id") -> DataFrame:
    """All binaries; those in ``done`` are marked so, others keep their mark."""
    ids = done.select(F.col(key).alias("__done")).distinct()
    out = binaries.join(ids, F.col(key) == F.col("__done"), "left")
    return out.withColumn("disasmed", F.col("__done").isNotNull() | F.coalesce("disasmed", F.lit(False))).drop("__done")
