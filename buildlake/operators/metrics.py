"""Counters: all measures of a panel in one pass, whatever their number."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from buildlake import schemas as S
from buildlake.functions import times
from buildlake.operators.numbering import running_sums

# fixed values: windows of the panel, in seconds
WINDOWS = {"hour": S.HOUR, "day": S.DAY, "month": S.MONTH}


def windowed_counts(table: DataFrame, seconds: Column, now: int, measures: dict[str, Column], windows: dict[str, int] | None = None) -> DataFrame:
    """One row: for each measure and window the rows that meet it strictly within the window before ``now``."""
    spans = WINDOWS if windows is None else windows
    return table.agg(*[F.count_if(cond & times.newer_than(seconds, F.lit(now), span)).alias(f"{name}_{window}") for name, cond in measures.items() for window, span in spans.items()])


def progress(statuses: DataFrame, binaries: DataFrame, now: int) -> DataFrame:
    """The panel of 18 counters: clones, builds and binaries of the last hour, day and month."""
    clone, build = F.col("clone_status"), F.col("build_status")
    tasks = windowed_counts(
        statuses,
        F.col("mod_timestamp"),
        now,
        {"cloned": clone == S.SUCCESS, "clone_failed": clone == S.FAILED, "built": build == S.SUCCESS, "build_failed": build.isin(*S.FAILURES)},
    )
    name = F.col("file_name")
    files = windowed_counts(binaries, times.exact_epoch(F.col("build_date")), now, {"binaries": F.lit(True), "windows_binaries": name.endswith(".exe") | name.endswith(".dll")})
    return tasks.crossJoin(files)  # one row each


def totals(statuses: DataFrame) -> DataFrame:
    return statuses.agg(F.count("_id").alias("total"), F.count_if(F.col("clone_status") == S.SUCCESS).alias("cloned"), F.count_if(F.col("build_status") == S.SUCCESS).alias("built"))


def histogram(table: DataFrame, *keys: str) -> DataFrame:
    return table.groupBy(*keys).agg(F.count(F.lit(1)).alias("n"))


def latest(table: DataFrame, keys: list[str], order: list[str], *values: str) -> DataFrame:
    """The newest values of each key; one partial aggregation, no sort."""
    best = F.max_by(F.struct(*values), F.struct(*order)).alias("v")
    return table.groupBy(*keys).agg(best).select(*keys, "v.*")


def running_total(table: DataFrame, key: str, value: Column) -> DataFrame:
    """Sum of each key and of all keys up to it."""
    return running_sums(table.groupBy(key).agg(F.sum(value).alias("found")), "total", F.col("found"), [key])


def rollup_counts(table: DataFrame, *keys: str) -> DataFrame:
    return table.rollup(*keys).agg(F.count(F.lit(1)).alias("n"))
