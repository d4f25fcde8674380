"""Lookups, searches, projections and ordered limits over the control tables."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from buildlake.functions import numbers, text, times
from buildlake.operators.numbering import with_keys
from buildlake.sources.staging import staged


def by_id(table: DataFrame, value: int, key: str = "_id") -> DataFrame:
    """The row of a key, if there is one."""
    return table.where(F.col(key) == value)


def matching(table: DataFrame, **wanted: object) -> DataFrame:
    """Rows equal in every given column; None sets no condition, a list allows any of its values."""
    for name, value in wanted.items():
        if value is not None:
            table = table.where(F.col(name).isin(*value) if isinstance(value, (list, tuple)) else F.col(name) == value)
    return table


def changed_between(statuses: DataFrame, start: int, end: int) -> DataFrame:
    """Statuses changed strictly between two seconds."""
    return statuses.where(times.strictly_between(F.col("mod_timestamp"), F.lit(start), F.lit(end)))


def containing(table: DataFrame, ignore_case: bool = False, **parts: str) -> DataFrame:
    """Rows whose columns contain all given parts; an empty part sets no condition. Numbers count as their digits."""
    for name, part in parts.items():
        if part:
            value = F.col(name).cast("string")
            table = table.where(F.lower(value).contains(part.lower()) if ignore_case else value.contains(part))
    return table


def repositories_by_status(projects: DataFrame, statuses: DataFrame, clone_status: int | None = None, build_status: int | Sequence[int] | None = None, build_opt_id: int | None = None, limit: int | None = None) -> DataFrame:
    """Projects once for each status that matches, most urgent first; the status's key settles ties."""
    found = matching(statuses, clone_status=clone_status, build_status=build_status, build_opt_id=build_opt_id)
    out = projects.join(found.select(F.col("_id").alias("status_id"), "repo_id", F.col("priority").alias("urgency")), F.col("repo_id") == F.col("_id")).drop("repo_id")
    return out if limit is None else out.orderBy(F.desc("urgency"), "status_id").limit(limit)


def repositories_with(projects: DataFrame, statuses: DataFrame) -> DataFrame:
    """Projects that have one of the statuses, each once."""
    return projects.join(statuses, statuses["repo_id"] == projects["_id"], "left_semi")


def within_size(table: DataFrame, n_bytes: Column, least_kb: float | None = None, most_kb: float | None = None) -> DataFrame:
    """Rows of a size from ``least_kb`` to ``most_kb``, both included; None and 0 set no bound."""
    size = numbers.kb(n_bytes)
    if least_kb:
        table = table.where(size >= least_kb)
    return table.where(size <= most_kb) if most_kb else table


def first_by_name(table: DataFrame, limit: int | None, *order: str) -> DataFrame:
    """The first rows of a listing; None and 0 set no limit."""
    return table.orderBy(*order).limit(limit) if limit else table


GRAM = 4
"""Characters of the runs by which texts of one or two words meet."""


def _inner_word(value: Column) -> Column:
    """The longest word with white space on both sides, null without one: what contains the text has it as a word of its own."""
    parts = F.split(value, r"\s+")
    inner = F.slice(parts, F.lit(2), F.greatest(F.size(parts) - 2, F.lit(0)))
    return F.array_max(F.transform(inner, lambda w: F.struct(F.length(w).alias("n"), w.alias("word"))))["word"]


def _grams(value: Column, n: int) -> Column:
    """Distinct runs of ``n`` characters; the empty one for 0, none where the text is shorter."""
    starts = F.sequence(F.lit(1), F.greatest(F.length(value) - n + 1, F.lit(1)))
    return F.when(F.length(value) >= n, F.array_distinct(F.transform(starts, lambda i: F.substring(value, i, F.lit(n))))).otherwise(F.array())


def _by_grams(told: DataFrame, part: DataFrame) -> DataFrame:
    """Likely (key, part): texts (key, whole) that have the rarest run of ``GRAM`` characters of a part, or all of a shorter one."""
    part = part.withColumn("n", F.least(F.length("part"), F.lit(GRAM)))
    lengths = sorted(r["n"] for r in part.select("n").distinct().collect())  # GRAM + 1 at most
    if not lengths:
        return told.select("key", F.lit(None).cast("string").alias("part")).limit(0)
    of_part = F.coalesce(*[F.when(F.col("n") == n, _grams(F.col("part"), n)) for n in lengths])
    wanted = staged(part.select("part", F.explode(of_part).alias("gram")), "grams")
    of_text = F.concat(*[_grams(F.col("whole"), n) for n in lengths])
    hits = staged(told.select("key", F.explode(of_text).alias("gram")).join(wanted.select("gram").distinct(), "gram"), "gram-hits")
    often = hits.groupBy("gram").agg(F.count(F.lit(1)).alias("df"))
    # a run that no text has is the rarest: its part is in none
    ranked = wanted.join(often, "gram", "left").withColumn("df", F.coalesce("df", F.lit(0)))
    rarest = staged(ranked.groupBy("part").agg(F.min_by("gram", F.struct("df", "gram")).alias("gram")), "rarest-grams")
    return hits.join(rarest, "gram").select("key", "part")


def _contained(whole: DataFrame, part: DataFrame) -> DataFrame:
    """Distinct (whole, part) with the part inside the whole; the two meet by equality only.

    Parts of three words or more meet texts that have their longest inner word,
    shorter ones texts that have their rarest run of characters; then the texts
    are compared.
    """
    keyed = part.withColumn("word", _inner_word(F.col("part")))
    told = whole.withColumn("key", F.sha2("whole", 256))
    words = told.select("key", F.explode(F.array_distinct(F.split("whole", r"\s+"))).alias("word"))
    likely = words.join(keyed.where("word is not null"), "word").select("key", "part").union(_by_grams(told, keyed.where("word is null").select("part")))
    return likely.distinct().join(told, "key").where(F.col("whole").contains(F.col("part"))).select("whole", "part")


def without_blacklisted(table: DataFrame, name: Column, blacklist: DataFrame, item: str) -> DataFrame:
    """Rows whose name neither contains an item of the blacklist nor is contained in one; null names stay."""
    keyed = table.withColumn("__name", name)
    names = keyed.select("__name").where("__name is not null").distinct()
    items = blacklist.select(F.col(item).alias("__item")).where("__item is not null").distinct()
    over = _contained(names.toDF("whole"), items.toDF("part")).select(F.col("whole").alias("__name"))
    under = _contained(items.toDF("whole"), names.toDF("part")).select(F.col("part").alias("__name"))
    return keyed.join(over.union(under).distinct(), "__name", "left_anti").select(*table.columns)


def repository_export(projects: DataFrame) -> DataFrame:
    return projects.select(F.col("_id").alias("id"), "name", text.web_url(F.col("url")).alias("url"), "owner_id", "build_system", "size")


def repository_message(projects: DataFrame) -> DataFrame:
    """Projects as messages: numbers are not negative, texts not null."""
    return projects.select(
        F.col("_id").cast("long").alias("id"),
        F.coalesce(F.col("name"), F.lit("")).alias("name"),
        F.coalesce(F.col("url"), F.lit("")).alias("url"),
        numbers.at_least_zero(F.col("size")).cast("long").alias("size"),
        numbers.at_least_zero(F.col("owner_id")).cast("int").alias("owner_id"),
    )


def repository_rows(messages: DataFrame) -> DataFrame:
    """The inverse: messages as projects; there is no column for a fork."""
    return messages.select(F.col("id").alias("_id"), "url", "owner_id", "name", "size")


def console_record(fields: dict[str, Column]) -> Column:
    """A record as ``label: value`` lines; nulls are empty."""
    return F.concat_ws("\n", *[F.concat(F.lit(f"{label}: "), F.coalesce(value.cast("string"), F.lit(""))) for label, value in fields.items()])


def export_document(table: DataFrame, name: str) -> DataFrame:
    """One JSON text a row, with the table's name: ready for a text sink of any size."""
    return table.select(F.lit(name).alias("table"), F.to_json(F.struct(*table.columns)).alias("row"))


def restored(documents: DataFrame, name: str, schema: str) -> DataFrame:
    """Rows of a table from ``export_document``; options come back enabled, ``id`` is the key."""
    rows = documents.where(F.col("table") == name).select(F.from_json("row", schema).alias("r")).select("r.*")
    if "id" in rows.columns:
        rows = rows.withColumnRenamed("id", "_id")
    return rows.withColumn("enable", F.lit(True)) if "enable" in rows.columns else rows


def numbered_lines(table: DataFrame, line: Column, per: Sequence[str], order: Sequence[str]) -> DataFrame:
    """``line n: ...`` within each group, counted from 1."""
    numbered = with_keys(table.withColumn("line", line), "__n", order, per)
    return numbered.withColumn("line", F.format_string("line %d: %s", "__n", "line")).drop("__n")
