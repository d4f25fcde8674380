"""K-d tree sharding by bytes, with DataFrame functions only.

Each node of the tree is split at the weighted median (weight: a document's
bytes) along its widest metadata dimension until there are as many leaves as
shards; ``shards_for`` gives the number at which leaves reach a target size.

What a row needs (id, size, dimensions) is staged once. A level takes one
aggregation for the extents of its nodes and some that narrow the place of
each median: bytes by (node, bin), bins of equal width over what is left of
the node's range, until the bin with the median is light or a single value.
Rows of one value are split in the order of a hash in the same way. The tree
is three arrays in heap order, walked in one expression. What the driver sees
is bounded by ``BINS`` in all, whatever the number of nodes or documents.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from buildlake.llm.common import staged

BINS = 1 << 17
"""Bins of one pass over all nodes, 256 a node at most."""
EVEN = 1 / 2048
"""Share of a node's bytes that a bin may hold when the node is cut at its edge."""
PASSES = 12
SLOT_ROWS = 200_000
"""Rows numbered by one task."""
MOST = 1 << 14
"""Shards, at most: the tree travels with every task."""

_TIES = 1 << 30


def shards_for(total_bytes: int, target_bytes: int) -> int:
    """Leaves, a power of two, so that none is over the target size but for what single documents are larger."""
    return 1 << max(0, math.ceil(math.log2(max(1, total_bytes) / max(1, target_bytes))))


def _measured(docs: DataFrame, id_col: str, text_col: str, dimensions: dict[str, Column] | None) -> tuple[DataFrame, list[str]]:
    text = F.coalesce(F.col(f"`{text_col}`").cast("string"), F.lit(""))
    doc_id = F.col(f"`{id_col}`").cast("long")
    dims = dimensions
    if dims is None:
        dims = {"length": F.log2(F.octet_length(text).cast("double") + 1), "id": doc_id.cast("double")}
        for name in ("lang", "source"):
            if name in docs.columns:
                dims[name] = F.pmod(F.xxhash64(F.col(f"`{name}`").cast("string")), F.lit(1 << 20)).cast("double")
    names = [f"d{k}" for k in range(len(dims))]
    number = lambda c: F.when(F.isnan(c) | c.isNull() | (F.abs(c) == float("inf")), 0.0).otherwise(c)
    measured = docs.select(
        doc_id.alias("doc_id"),
        (F.octet_length(text).cast("long") + 1).alias("size"),
        F.crc32(text).alias("text_crc32"),
        *[number(c.cast("double")).alias(d) for d, c in zip(names, dims.values(), strict=True)],
        # only rows alike in all of this are told apart by their place, and for those it makes no difference which is which
        F.pmod(F.xxhash64(doc_id, text), F.lit(_TIES)).alias("alike"),
        (F.pmod(F.xxhash64(F.monotonically_increasing_id()), F.lit(1 << 20)) / F.lit(float(1 << 20))).alias("among"),
    )
    return staged(measured.withColumn("tie", F.col("alike") + F.col("among")), "shard-rows"), names


def _array(values: list, kind: str) -> Column:
    """A constant array, folded into one literal when the query is planned."""
    return F.split(F.lit(",".join(str(v).lower() for v in values)), ",").cast(f"array<{kind}>")


def _walk(tree: list[tuple[int, float, float]], names: list[str], levels: int) -> Column:
    """The node, from 0 within its level, of a row: beyond (value, tie) of a node's dimension is its second child."""
    if not levels:
        return F.lit(0)
    dims, values, ties = (_array([t[i] for t in tree], kind) for i, kind in enumerate(("int", "double", "double")))
    own = F.array(*names)

    def step(node: Column, _: Column) -> Column:
        value, limit = F.get(own, F.get(dims, node)), F.get(values, node)
        right = (value > limit) | ((value == limit) & (F.col("tie") > F.get(ties, node)))
        return 2 * node + F.when(right, 2).otherwise(1)

    return F.aggregate(F.sequence(F.lit(1), F.lit(levels)), F.lit(0), step) - F.lit((1 << levels) - 1)


class _Cut:
    """The search for one node's median: a range of values, then of ties of the value that holds it."""

    def __init__(self, dim: int, low: float, high: float, weight: int) -> None:
        self.dim, self.low, self.high, self.weight, self.below = dim, low, high, weight, 0
        self.value: float | None = None
        self.limit: tuple[float, float] | None = None

    def narrow(self, bins: list[tuple[float, float, int]]) -> None:
        """``bins``: (first and last value, bytes) in order; all of the node's bytes up to the range are ``below``."""
        run = self.below
        for lo, hi, w in bins:
            self.below, run = run, run + w
            if 2 * run >= self.weight:
                break
        behind = run - self.weight / 2 <= self.weight / 2 - self.below  # whether the cut is nearer behind the bin
        edge = hi if behind else math.nextafter(lo, -math.inf)
        if self.value is not None and (lo == hi or w <= EVEN * self.weight):
            self.limit = self.value, edge
        elif self.value is None and w <= EVEN * self.weight:
            self.limit = edge, math.inf
        elif lo == hi:  # one value: go on with its ties
            self.value, self.low, self.high = lo, 0.0, float(_TIES)
        else:
            self.low, self.high = lo, hi


def _medians(rows: DataFrame, node: Column, names: list[str], scale: dict[str, float], nodes: int) -> list[tuple[int, float, float]]:
    """(dimension, value, tie) of each node's cut; nodes without rows are cut anywhere."""
    at = rows.withColumn("node", node)
    cuts = [_Cut(0, 0.0, 0.0, 0) for _ in range(nodes)]
    for c in cuts:
        c.limit = (0.0, 0.0)
    for r in at.groupBy("node").agg(F.sum("size").alias("bytes"), *[f(d).alias(f"{n}_{d}") for d in names for n, f in (("lo", F.min), ("hi", F.max))]).collect():
        k = max(range(len(names)), key=lambda k: ((r[f"hi_{names[k]}"] - r[f"lo_{names[k]}"]) / scale[names[k]], -k))
        cuts[r["node"]] = _Cut(k, r[f"lo_{names[k]}"], r[f"hi_{names[k]}"], r["bytes"])
    bins = max(2, min(256, BINS // nodes))
    for _ in range(PASSES):
        if all(c.limit for c in cuts):
            break
        by_node = lambda f, kind: F.get(_array([f(c) for c in cuts], kind), F.col("node"))
        state = {"settled": by_node(lambda c: c.limit is not None, "boolean"), "tied": by_node(lambda c: c.value is not None, "boolean"), "one": by_node(lambda c: c.value or 0.0, "double"), "low": by_node(lambda c: c.low, "double"), "high": by_node(lambda c: c.high, "double"), "of": F.get(F.array(*names), by_node(lambda c: c.dim, "int"))}
        left = at.withColumns(state).where(~F.col("settled") & (~F.col("tied") | (F.col("of") == F.col("one")))).withColumn("v", F.when(F.col("tied"), F.col("tie")).otherwise(F.col("of"))).where("v between low and high")
        width = F.greatest((F.col("high") - F.col("low")) / bins, F.lit(1e-300))
        binned = left.withColumn("bin", F.least(F.floor((F.col("v") - F.col("low")) / width), F.lit(bins - 1)))
        found: dict[int, list] = {}
        for r in binned.groupBy("node", "bin").agg(F.min("v").alias("lo"), F.max("v").alias("hi"), F.sum("size").alias("w")).collect():
            found.setdefault(r["node"], []).append((r["lo"], r["hi"], r["w"]))
        for n, some in found.items():
            cuts[n].narrow(sorted(some))
    return [(c.dim, *(c.limit or ((c.high, math.inf) if c.value is None else (c.value, c.high)))) for c in cuts]


def kd_shards(docs: DataFrame, shards: int | None = None, target_bytes: int | None = None, id_col: str = "doc_id", text_col: str = "text", dimensions: dict[str, Column] | None = None) -> DataFrame:
    """All rows of ``docs`` in ``shards`` (a power of two) shards of nearly equal bytes.

    Without ``shards`` there are as many as bring leaves to ``target_bytes``.
    Returns doc_id, size (UTF-8 bytes plus 1), text_crc32, law ('bytes'),
    shard, slot (gapless from 0 within the shard), grown_shard (null).
    ``dimensions``: numeric columns to split on; by default the logarithm of
    the length, the id, and hashes of ``lang`` and ``source``.

    Rows of equal value in a dimension are ordered by a hash of what they hold,
    so constant columns are split exactly like anything else; equal texts under
    different ids are rows of their own and may lie in different shards. The
    same rows give the same shards and slots, however files hold them. Null
    texts have size 1; null, infinite and undefined dimensions count as 0; null
    ids are kept; repeated rows each get their slot; an empty table gives an
    empty result.
    """
    if (shards is None) == (target_bytes is None):
        raise ValueError("give shards or target_bytes")
    base, names = _measured(docs, id_col, text_col, dimensions)
    whole = base.agg(F.count(F.lit(1)).alias("n"), F.sum("size").alias("bytes"), *[(F.max(d) - F.min(d)).alias(d) for d in names]).first()
    shards = shards or shards_for(whole["bytes"] or 0, target_bytes)
    if shards < 1 or shards & (shards - 1) or shards > MOST:
        raise ValueError(f"shards must be a power of two, {MOST} at most")
    scale = {d: whole[d] or 1.0 for d in names}
    tree: list[tuple[int, float, float]] = []
    levels = shards.bit_length() - 1
    for level in range(levels if whole["n"] else 0):
        tree += _medians(base, _walk(tree, names, level), names, scale, 1 << level)
    placed = base.withColumn("shard", (_walk(tree, names, levels) if whole["n"] else F.lit(0)).cast("int"))
    # slots: rows are numbered within sub-buckets of bounded size, sub-buckets start where the earlier ones end
    subs = max(1, math.ceil(whole["n"] / SLOT_ROWS / shards * 2))
    many = base.groupBy("alike").agg(F.count(F.lit(1)).alias("n")).where(F.col("n") > SLOT_ROWS)  # rows repeated that often
    placed = placed.join(many, "alike", "left") if whole["n"] > SLOT_ROWS else placed.withColumn("n", F.lit(None).cast("long"))
    placed = placed.withColumns({"sub": F.floor(F.col("alike") * subs / _TIES), "heap": F.floor(F.col("among") * F.ceil(F.coalesce("n", F.lit(1)) / SLOT_ROWS))})
    at = ["shard", "sub", "heap"]
    counts = placed.groupBy(*at).agg(F.count(F.lit(1)).alias("c"))
    starts = counts.withColumn("start", F.coalesce(F.sum("c").over(Window.partitionBy("shard").orderBy("sub", "heap").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))).drop("c")
    numbered = placed.withColumn("k", F.row_number().over(Window.partitionBy(*at).orderBy("alike", "doc_id", "size", "text_crc32")) - 1)
    out = numbered.join(starts, at)
    return out.select("doc_id", "size", "text_crc32", F.lit("bytes").alias("law"), "shard", (F.col("start") + F.col("k")).cast("long").alias("slot"), F.lit(None).cast("int").alias("grown_shard"))
