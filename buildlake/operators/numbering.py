"""Positions in an order, without sorting a group in one task.

Rows are dealt out by ranges of (group, order) and sorted within a range. The
table is written in that state, so that positions within ranges and the counts
of the earlier ranges come from the same rows. Counts over all rows, one row a
range, are broadcast, so the rows themselves move once.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from buildlake.sources.staging import staged

_ROW = 33  # bits of a row's position within its partition, as Spark numbers rows


def in_ranges(table: DataFrame, order: Sequence[str], per: Sequence[str]) -> DataFrame:
    """``table``, written, with ``__range`` and ``__at``: where each row lies in the order of groups and of ``order``."""
    return as_it_lies(table.repartitionByRange(*per, *order).sortWithinPartitions(*per, *order))


def as_it_lies(ordered: DataFrame) -> DataFrame:
    """``in_ranges`` of a table whose partitions are ranges of the order already, each sorted."""
    return staged(ordered.withColumn("__at", F.monotonically_increasing_id()), "ranges").withColumn("__range", F.shiftright("__at", _ROW))


def with_keys(table: DataFrame, name: str, order: Sequence[str], per: Sequence[str] = ()) -> DataFrame:
    """``table`` with gapless numbers from 1 in the natural order of ``order``, within each group of ``per``."""
    held = in_ranges(table, order, per)
    counts = held.groupBy(*per, "__range").agg(F.count(F.lit(1)).alias("__n"), F.min("__at").alias("__first"))
    # one row for each range of a group
    earlier = Window.partitionBy(*per).orderBy("__range").rowsBetween(Window.unboundedPreceding, -1)
    starts = counts.withColumn("__before", F.coalesce(F.sum("__n").over(earlier), F.lit(0))).drop("__n")
    number = F.col("__before") + F.col("__at") - F.col("__first") + 1
    return held.join(starts if per else F.broadcast(starts), [*per, "__range"]).withColumn(name, number).select(*table.columns, name)


def running_sums(table: DataFrame, name: str, value: Column, order: Sequence[str]) -> DataFrame:
    """``table`` with the sum of ``value`` over all rows up to each, by ``order``."""
    held = in_ranges(table.withColumn("__v", value), order, ())
    sums = held.groupBy("__range").agg(F.sum("__v").alias("__s"))
    earlier = Window.orderBy("__range").rowsBetween(Window.unboundedPreceding, -1)
    starts = sums.withColumn("__before", F.coalesce(F.sum("__s").over(earlier), F.lit(0))).drop("__s")
    inside = F.sum("__v").over(Window.partitionBy("__range").orderBy("__at").rowsBetween(Window.unboundedPreceding, Window.currentRow))
    return held.join(F.broadcast(starts), "__range").withColumn(name, F.col("__before") + inside).select(*table.columns, name)
