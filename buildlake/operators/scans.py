"""Scans along an order that no group bounds: carries, running sums and neighbours across ranges.

A window over a group sorts the group in one task. Here rows are dealt out by
ranges of (group, order); each range is scanned on its own. A group that lies in
several ranges has each of them summed up in one row; these summaries are
scanned in turn and what reaches a range from those before it (or the one behind
it) is joined back. A group with a third of all rows is a third of all ranges.

Each column is described by one of the classes below. ``since`` restarts a
column at the rows that meet a condition.
"""

from __future__ import annotations

import functools
from collections.abc import Callable, Mapping, Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from buildlake.operators.numbering import in_ranges

_SO_FAR = (Window.unboundedPreceding, Window.currentRow)
_BEFORE = (Window.unboundedPreceding, -1)


@dataclass(frozen=True)
class Last:
    """The last value up to each row that isn't null."""

    value: Column


@dataclass(frozen=True)
class Sum:
    """The sum of the values up to each row, since the group's or the last ``since`` row's start; nulls count as 0."""

    value: Column
    since: Column | None = None


@dataclass(frozen=True)
class First:
    """The first value up to each row that isn't null, since the group's or the last ``since`` row's start."""

    value: Column
    since: Column | None = None


@dataclass(frozen=True)
class Most:
    """The largest value up to each row."""

    value: Column


@dataclass(frozen=True)
class Following:
    """The value of the row behind each; null for a group's last."""

    value: Column


Step = Last | Sum | First | Most | Following


class _Plan:
    """Columns of one step at each of the three stages: within ranges, over summaries, put together."""

    def __init__(self, name: str, step: Step, group: Sequence[str], conditions: list[Column]) -> None:
        """``conditions``: those that columns restart at so far; steps with the same one share its counts."""
        self.name, self.step, self.group = name, step, group
        self.value, self.own, self.end, self.carry = (f"__{part}_{name}" for part in ("value", "own", "end", "carry"))
        self.restarts = isinstance(step, (Sum, First)) and step.since is not None
        if self.restarts:
            at = next((i for i, c in enumerate(conditions) if c is step.since), len(conditions))
            conditions[at:] = [step.since] if at == len(conditions) else conditions[at:]
            self.start, self.runs, self.most, self.stretch = (f"__{part}_{at}" for part in ("start", "runs", "most", "stretch"))

    def inputs(self) -> dict[str, Column]:
        value = F.struct(self.step.value.alias("v")) if isinstance(self.step, Following) else F.coalesce(self.step.value, F.lit(0)) if isinstance(self.step, Sum) else self.step.value
        return {self.value: value} | ({self.start: F.coalesce(self.step.since, F.lit(False))} if self.restarts else {})

    def numbered(self) -> dict[str, Column]:
        """Restarts so far within the range."""
        w = Window.partitionBy(*self.group, "__range").orderBy("__at").rowsBetween(*_SO_FAR)
        return {self.runs: F.sum(F.col(self.start).cast("long")).over(w)} if self.restarts else {}

    def within(self) -> dict[str, Column]:
        keys = (*self.group, "__range", self.runs) if self.restarts else (*self.group, "__range")
        ordered = Window.partitionBy(*keys).orderBy("__at")
        if isinstance(self.step, Following):
            return {self.own: F.lead(self.value).over(ordered)}
        return {self.own: self.pick(self.value).over(ordered.rowsBetween(*_SO_FAR))}

    def pick(self, column: str) -> Column:
        """What the step makes of a run of values."""
        if isinstance(self.step, (Sum, Most)):
            return (F.sum if isinstance(self.step, Sum) else F.max)(column)
        return (F.last if isinstance(self.step, Last) else F.first)(column, ignorenulls=True)

    def summary(self) -> dict[str, Column]:
        if isinstance(self.step, Following):
            return {self.end: F.min_by(self.value, "__at")}
        return {self.end: F.max_by(self.own, "__at")} | ({self.most: F.max(self.runs)} if self.restarts else {})

    def carried(self, summaries: DataFrame) -> DataFrame:
        """What reaches each range; the windows are over one row for each range of a group."""
        by_range = Window.partitionBy(*self.group).orderBy("__range")
        if isinstance(self.step, Following):
            return summaries.withColumn(self.carry, F.lead(self.end).over(by_range))
        if not self.restarts:
            return summaries.withColumn(self.carry, self.pick(self.end).over(by_range.rowsBetween(*_BEFORE)))
        # ranges up to the next one that restarts go on with one another
        placed = summaries.withColumn(self.stretch, F.sum((F.col(self.most) > 0).cast("long")).over(by_range.rowsBetween(*_SO_FAR)))
        so_far = Window.partitionBy(*self.group, self.stretch).orderBy("__range").rowsBetween(*_SO_FAR)
        return placed.withColumn(self.carry, self.pick(self.end).over(so_far)).withColumn(self.carry, F.lag(self.carry).over(by_range))

    def result(self) -> Column:
        own, carry = F.col(self.own), F.col(self.carry)
        if isinstance(self.step, Following):
            return F.coalesce(own, carry)["v"]
        if isinstance(self.step, Sum):
            both = own + F.coalesce(carry, F.lit(0))
        elif isinstance(self.step, Most):
            both = F.greatest(own, carry)
        else:
            both = F.coalesce(own, carry) if isinstance(self.step, Last) else F.coalesce(carry, own)
        return F.when(F.col(self.runs) == 0, both).otherwise(own) if self.restarts else both


def scanned(table: DataFrame, per: Sequence[str], order: Sequence[str], columns: Mapping[str, Step]) -> DataFrame:
    """``table`` with a column for each step, along ``order`` within the groups of ``per``.

    Rows that ``order`` doesn't tell apart are scanned in any order, but in the
    same one by every step. Null keys are a group; an empty table gives an empty result.
    """
    return scanned_ranges(in_ranges(table, order, per), per, columns).select(*[F.col(f"`{c}`") for c in table.columns if c not in columns], *columns)


def scanned_ranges(held: DataFrame, per: Sequence[str], columns: Mapping[str, Step], read: Callable[[DataFrame], DataFrame] = lambda rows: rows) -> DataFrame:
    """``scanned`` for rows that lie in ranges of (group, order), as ``in_ranges`` gives them; ``__range`` and ``__at`` stay.

    ``read`` derives, row by row, what the steps read; as it does so where the
    rows have been put together and sorted, what it adds is neither moved nor sorted.
    All but a few groups lie within one range, where nothing reaches them. At
    most one group goes on from a range to the next: summaries are made of
    those alone, and what reaches a range, two rows for each at most, is broadcast.
    """
    keys = [f"__key{i}" for i in range(len(per))]
    conditions: list[Column] = []
    plans = [_Plan(name, step, keys, conditions) for name, step in columns.items()]
    keyed = held.withColumns({k: F.col(c) for k, c in zip(keys, per, strict=True)})
    met = lambda first=F.lit(True): functools.reduce(lambda a, b: a & b, [F.col(k).eqNullSafe(F.col(f"{k}_")) for k in keys], first)

    def local(rows: DataFrame) -> DataFrame:
        rows = read(rows.repartition(*keys, "__range").sortWithinPartitions(*keys, "__range", "__at"))
        rows = rows.withColumns({k: v for p in plans for k, v in p.inputs().items()})
        # steps that never restart share the sort that restarts are counted in; then each condition's steps share one
        rows = rows.withColumns({k: v for p in plans for k, v in (p.numbered() if p.restarts else p.within()).items()})
        restarting = {k: v for p in plans if p.restarts for k, v in p.within().items()}
        return rows.withColumns(restarting) if restarting else rows

    spanning = keyed
    if keys:
        several = keyed.select(*[F.col(k).alias(f"{k}_") for k in keys], "__range").distinct().groupBy(*[f"{k}_" for k in keys]).agg(F.count(F.lit(1)).alias("__n")).where("__n > 1")
        spanning = keyed.join(F.broadcast(several), met(), "left_semi")
    ends = {k: v for p in plans for k, v in p.summary().items()}
    summaries = local(spanning).groupBy(*keys, "__range").agg(*[v.alias(k) for k, v in ends.items()])
    for p in plans:
        summaries = p.carried(summaries)
    reaching = summaries.select(*[F.col(k).alias(f"{k}_") for k in keys], F.col("__range").alias("__to"), *[p.carry for p in plans])
    joined = local(keyed).join(F.broadcast(reaching), met(F.col("__range") == F.col("__to")), "left")
    return joined.select(*[F.col(f"`{c}`") for c in read(held).columns if c not in columns], *[p.result().alias(p.name) for p in plans])
