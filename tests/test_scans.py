"""Scans along an order, by brute force: groups of any size, null keys and values, restarts, ties, an empty table."""

from __future__ import annotations

import random

import pytest
from pyspark.sql import functions as F

from buildlake.operators import debuginfo, scans



def steps():
    value, mark = F.col("v"), F.col("mark")
    return {
        "last": scans.Last(value),
        "sum": scans.Sum(value),
        "first": scans.First(value),
        "next": scans.Following(value),
        "sum_since": scans.Sum(value, mark),
        "first_since": scans.First(value, mark),
        "marks": scans.Sum(F.when(mark, 1)),
        "sum_since_five": scans.Sum(F.lit(1), value == 5),
    }


def walked(rows):
    """The same columns row by row."""
    out = []
    for g in {r[0] for r in rows}:
        group = sorted((r for r in rows if r[0] == g), key=lambda r: r[1])
        last, total, first, since, first_since, marks, fives = None, 0, None, 0, None, 0, 0
        for k, (_, at, v, mark) in enumerate(group):
            if mark:
                since, first_since, marks = 0, None, marks + 1
            fives = 1 if v == 5 else fives + 1
            last = last if v is None else v
            first = v if first is None else first
            first_since = v if first_since is None else first_since
            total, since = total + (v or 0), since + (v or 0)
            out.append((g, at, last, total, first, group[k + 1][2] if k + 1 < len(group) else None, since, first_since, marks, fives))
    return sorted(out, key=repr)


@pytest.mark.parametrize("marks", [0.0, 0.02, 0.4])
def test_scans_by_brute_force(spark, marks):
    """One group has a third of all rows and lies in several ranges; marks may be ranges apart."""
    rng = random.Random(int(marks * 100))
    at = rng.sample(range(10_000), 3000)
    rows = [("hot" if i < 1000 else None if i < 1100 else f"g{rng.randrange(200)}", a, rng.choice([None, None, 1, 5, -2]), rng.choice([None, False]) if rng.random() >= marks else True) for i, a in enumerate(at)]
    table = spark.createDataFrame(rows, "g string, at long, v long, mark boolean").repartition(6)
    got = scans.scanned(table, ["g"], ["at"], steps())
    assert got.columns == ["g", "at", "v", "mark", *steps()]
    assert sorted(((r["g"], r["at"], *(r[c] for c in steps())) for r in got.collect()), key=repr) == walked(rows)
    assert got.limit(0).count() == 0 and scans.scanned(table.limit(0), ["g"], ["at"], steps()).count() == 0


def test_no_window_spans_a_group(spark, capsys):
    """Every window over lines is over a range; only summaries have windows over a group."""
    lines = spark.createDataFrame([(1, i, f"line {i} at [0000{i:04x}], len = 0x4 c:\\a.c (MD5: AB)" if i % 9 else f"** f{i}") for i in range(500)], "dump long, pos long, line string")
    rows = debuginfo.dump_rows(lines)
    rows.explain("extended")
    windows = [w for w in capsys.readouterr().out.split("== Physical Plan ==")[1].splitlines() if "Window [" in w]
    assert windows
    for w in windows:
        _, per, order = w.rsplit(", [", 2)
        assert "__range" in (per if "__at" in order else order), w  # lines within a range; summaries by range


def test_one_dump_with_a_third_of_all_lines(spark):
    rng = random.Random(5)
    rows, want = [], []
    for dump, n in [(0, 3000), *((d, 60) for d in range(1, 101))]:
        function = first = end = None
        total = hidden = 0
        lines = []
        for pos in range(n):
            if rng.random() < (0.01 if dump == 0 else 0.2):
                function, first, total, hidden = f"f{pos}", None, 0, 0
                lines.append((pos, f"** {function}", None))
            elif rng.random() < 0.05:
                lines.append((pos, "note", None))
            else:
                number, rva, length = rng.choice([5, 20_000_000]), rng.randrange(1 << 20), rng.randrange(1, 64)
                first = rva if first is None else first
                total, hidden, end = total + length, hidden + length * (number > 10_000_000), rva + length
                lines.append((pos, f"line {number} at [{rva:08x}], len = 0x{length:x}", (dump, function, pos, f"{first:08x}", f"{end:08x}", round(hidden / total, 9))))
        rows += [(dump, pos, line) for pos, line, _ in lines]
        want += [closed for (_, _, closed), following in zip(lines, [*lines[1:], (0, "", None)], strict=True) if closed and following[2] is None]
    found = debuginfo.segments(debuginfo.dump_rows(spark.createDataFrame(rows, "dump long, pos long, line string").repartition(7)))
    got = [(r["dump"], r["function"], r["pos"], r["rva_start"], r["rva_end"], round(r["debug_ratio"], 9)) for r in found.collect()]
    assert sorted(got, key=repr) == sorted(want, key=repr)
