"""Ordered-sequence operators: islands, carries, gaps, as-of and range joins. All partition by a key.

Windows here sort a group in one task: they are for groups of a bounded size,
like the segments of a function or the items of an order. ``scans`` carries and
sums along groups of any size.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

_ALL_BEFORE = (Window.unboundedPreceding, Window.currentRow)


def gaps(table: DataFrame, start: str, end: str, per: list[str]) -> DataFrame:
    """Gap between each segment's end and the next one's start; null for the last."""
    return table.withColumn("gap", F.lead(start).over(Window.partitionBy(*per).orderBy(start, end)) - F.col(end))


def intersect_ratio(segments: DataFrame, start: str, end: str, per: list[str]) -> DataFrame:
    """Share of a function's span that lies between its segments; 0 for one segment or an empty span."""
    spanned = gaps(segments, start, end, per).groupBy(*per).agg(
        F.count(F.lit(1)).alias("n"), F.coalesce(F.sum("gap"), F.lit(0)).alias("gap"), F.min(start).alias("first"), F.max_by(end, F.struct(start, end)).alias("last")
    )
    span = F.col("last") - F.col("first")
    return spanned.select(*per, F.when((F.col("n") > 1) & (span != 0), F.col("gap") / span).otherwise(F.lit(0.0)).alias("ratio"))


def running_share(table: DataFrame, length: Column, flagged: Column, per: list[str], order: list[str]) -> DataFrame:
    """Running flagged share of the length, since the start of each group; 0 while there is no length."""
    w = Window.partitionBy(*per).orderBy(*order).rowsBetween(*_ALL_BEFORE)
    total = F.sum(length).over(w)
    return table.withColumn("share", F.when(total != 0, F.sum(F.when(flagged, length).otherwise(0)).over(w) / total).otherwise(F.lit(0.0)))


def extended_starts(table: DataFrame, start: str, end: str, per: list[str], tie: list[str]) -> DataFrame:
    """Starts moved back to behind the previous end; the first of several to 0."""
    w = Window.partitionBy(*per).orderBy(end, *tie)
    n = F.count(F.lit(1)).over(Window.partitionBy(*per))
    before = F.lag(end).over(w)
    moved = F.when((F.row_number().over(w) == 1) & (n > 1), 0).when(before + 1 < F.col(start), before + 1).otherwise(F.col(start))
    return table.withColumn(start, moved.cast(table.schema[start].dataType))


def leading_trimmed(table: DataFrame, dropped: Column, per: list[str], order: list[str]) -> DataFrame:
    """Without each group's leading run of rows that meet a condition."""
    w = Window.partitionBy(*per).orderBy(*order).rowsBetween(*_ALL_BEFORE)
    return table.withColumn("__seen", F.sum(F.when(dropped, 0).otherwise(1)).over(w)).where("__seen > 0").drop("__seen")


def as_of(probes: DataFrame, base: DataFrame, key: list[str], time: str, value: str, out: str) -> DataFrame:
    """Each probe with the newest ``value`` of its key strictly before its time; null without one.

    Both sides are one stream in the order of time, probes first at equal
    times, so one window finds every answer: linear, whatever the matches.
    """
    left = probes.withColumns({"__side": F.lit(0), "__value": F.lit(None).cast(base.schema[value].dataType)})
    right = base.select(*key, time, F.lit(1).alias("__side"), F.col(value).alias("__value"))
    w = Window.partitionBy(*key).orderBy(time, "__side", "__value").rowsBetween(*_ALL_BEFORE)
    both = left.unionByName(right, allowMissingColumns=True)
    return both.withColumn(out, F.last("__value", ignorenulls=True).over(w)).where("__side = 0").drop("__side", "__value")


def range_join(points: DataFrame, at: str, ranges: DataFrame, start: str, end: str, step: int, on: tuple[str, ...] = ()) -> DataFrame:
    """Points with every range (of equal ``on`` columns) that holds them, both bounds included.

    Ranges are cut into cells of ``step``, and points meet ranges by cell: an
    equality join, exact for any ``step``, and cheap if ranges are about a
    few cells wide.
    """
    cell = lambda c: F.floor(F.col(c) / step)
    cells = ranges.where(F.col(start) <= F.col(end)).withColumn("__cell", F.explode(F.sequence(cell(start), cell(end))))
    return points.withColumn("__cell", cell(at)).join(cells, [*on, "__cell"]).where(F.col(at).between(F.col(start), F.col(end))).drop("__cell")


def sessions(table: DataFrame, key: str, ts: str, gap: str = "600 seconds") -> DataFrame:
    """Sessions of each key: rows no further apart than the gap."""
    return table.groupBy(key, F.session_window(ts, gap).alias("w")).agg(F.count(F.lit(1)).alias("n")).select(key, F.col("w.start").alias("start"), F.col("w.end").alias("end"), "n")


def hourly_excess(table: DataFrame, ts: str, limit: int) -> DataFrame:
    """Rows in each clock hour and how many of them are over a limit."""
    return table.groupBy(F.window(ts, "1 hour").alias("w")).agg(F.count(F.lit(1)).alias("n")).select(F.col("w.start").alias("hour"), "n", F.greatest(F.lit(0), F.col("n") - limit).alias("excess"))


def crawl_windows(rows: DataFrame, seconds: Column, start: int, end: int, interval: int, cap: int) -> DataFrame:
    """Windows from ``end`` back to ``start``: rows in each, and the pages of 100 that a capped crawl fetches."""
    spark = rows.sparkSession
    windows = spark.range(start, end, interval).select(F.col("id").alias("since"), (F.col("id") + interval).alias("until"))
    counted = rows.where((seconds >= start) & (seconds < end)).groupBy((F.floor((seconds - start) / interval) * interval + start).alias("since")).agg(F.count(F.lit(1)).alias("total"))
    joined = windows.join(counted, "since", "left").withColumn("total", F.coalesce("total", F.lit(0)))
    return joined.withColumn("pages", F.greatest(F.lit(1), F.ceil(F.least("total", F.lit(cap)) / 100)).cast("long"))
