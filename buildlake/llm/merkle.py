"""Merkle manifest: subtrees within ranges of the order, ragged nodes by coordinate, proofs for every row.

1. Rows are dealt out by ranges of (group, order) and sorted within a range;
   counts of a group's rows in earlier ranges number its leaves. The offsets
   table has one row for each range of a group.
2. A task builds every complete aligned subtree, of at most ``arity ** LEVELS``
   leaves, of the leaves it holds, and each leaf's siblings up to its subtree's
   root. So memory is bounded whatever the size of a range or a group.
3. Roots of subtrees that a range's end cut short are ragged: they, and only
   they, are shuffled by the coordinate of the block that they lie in, which
   completes them to full blocks. Blocks are joined ``LEVELS`` levels at a time
   until each group has one root; the groups' roots are leaves of one more tree.
4. The siblings of the upper levels are composed from the root downwards and
   joined to the leaves by the coordinates of their subtrees, of which each has
   a bounded number of leaves.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator, Sequence

import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from buildlake.llm.common import staged

FIELDS = ("doc_id", "source", "lang", "n_chars", "text")
LEVELS = 12
"""One step builds subtrees of at most ``2 ** LEVELS`` leaves, whatever the arity."""

_RANGE = 33  # bits of a row's position within its partition, as Spark numbers rows

Nodes = list[dict[int, bytes]]


def digest(parts: Sequence[bytes]) -> bytes:
    """Digest of children or siblings: their hex texts, concatenated."""
    return hashlib.sha256(b"".join(parts).hex().encode()).digest()


def leaf_digest(values: Sequence[Column]) -> Column:
    """SHA-256 of ``-`` for a null and ``bytes:value`` for any other value, concatenated."""
    texts = [v.cast("string") for v in values]
    return F.unhex(F.sha2(F.concat(*(F.coalesce(F.concat(F.octet_length(t).cast("string"), F.lit(":"), t), F.lit("-")) for t in texts)), 256))


def height(n: int, arity: int) -> int:
    """Levels above ``n`` leaves until one node remains."""
    levels = 0
    while n > 1:
        n, levels = -(-n // arity), levels + 1
    return levels


def level_sizes(n: int, arity: int, levels: int) -> list[int]:
    out = [n]
    for _ in range(levels):
        out.append(-(-out[-1] // arity))
    return out


def steps_levels(arity: int) -> int:
    """Levels that one step builds."""
    levels = 1
    while arity ** (levels + 1) <= 2**LEVELS:
        levels += 1
    return levels


def grow(nodes: Nodes, n: int, top: int, arity: int) -> list[dict[int, tuple[int, int, bytes]]]:
    """Completes ``nodes`` (by level, then by index) in place up to level ``top``; (level, index, siblings) by node.

    A parent is made when all its children are there. For every node: the
    highest node above it that was made, and the siblings on the way, from below
    and from left to right.
    """
    top = min(top, height(n, arity))
    sizes = level_sizes(n, arity, top)
    nodes += [{} for _ in range(top + 1 - len(nodes))]
    for level in range(top):
        here, above = nodes[level], nodes[level + 1]
        for parent in sorted({j // arity for j in here}):
            family = range(parent * arity, min((parent + 1) * arity, sizes[level]))
            if all(j in here for j in family):
                above[parent] = digest([here[j] for j in family])
    paths: list[dict[int, tuple[int, int, bytes]]] = [{} for _ in range(top + 1)]
    for level in range(top, -1, -1):
        for j in nodes[level]:
            up = paths[level + 1].get(j // arity) if level < top else None
            if up is None:
                paths[level][j] = (level, j, b"")
            else:
                first = j - j % arity
                others = b"".join(nodes[level][i] for i in range(first, min(first + arity, sizes[level])) if i != j)
                paths[level][j] = (up[0], up[1], others + up[2])
    return paths


def _local(numbered: DataFrame, columns: Sequence[str], arity: int) -> DataFrame:
    """Each leaf with the root (level, node) of its subtree and its path there; the root's digest on its first leaf."""
    levels = steps_levels(arity)
    block = arity**levels

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[tuple] = []  # consecutive leaves of one block of one group

        def flush() -> pa.RecordBatch:
            first, n = held[0][1], held[0][2]
            nodes: Nodes = [{first + k: row[3] for k, row in enumerate(held)}]
            paths = grow(nodes, n, levels, arity)[0]
            rows = [(*row, level, node, path, nodes[level][node] if row[1] == node * arity**level else None) for row in held for level, node, path in (paths[row[1]],)]
            held.clear()
            kinds = [pa.string(), pa.int64(), pa.int64(), pa.binary(), *of_extra, pa.int32(), pa.int64(), pa.binary(), pa.binary()]
            return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*rows, strict=True), kinds, strict=True)], names=["grp", "i", "n", "leaf", *columns, "level", "node", "path", "root_of"])

        of_extra: list[pa.DataType] = []
        for batch in batches:
            of_extra = of_extra or [batch.schema.field(c).type for c in columns]
            for row in zip(*(batch.column(c).to_pylist() for c in ("grp", "i", "n", "leaf", *columns)), strict=True):
                if held and (row[0] != held[-1][0] or row[1] != held[-1][1] + 1 or row[1] % block == 0):
                    yield flush()
                held.append(row)
        if held:
            yield flush()

    kinds = {c: numbered.schema[c].dataType.simpleString() for c in columns}
    extra = "".join(f", {c} {t}" for c, t in kinds.items())
    ordered = numbered.select("grp", "i", "n", "leaf", *columns).sortWithinPartitions("grp", "i")
    return ordered.mapInArrow(work, f"grp string, i long, n long, leaf binary{extra}, level int, node long, path binary, root_of binary")


def _completed(nodes: DataFrame, top: int, arity: int) -> DataFrame:
    """Each node with the node at level ``top``, or the root, above it and its path there; that one's digest beside the first.

    ``nodes`` has n, grp, level, node, digest; those of one block, at most
    ``arity ** steps_levels`` of them, meet in a task.
    """

    def work(block: pd.DataFrame) -> pd.DataFrame:
        n, held = int(block["n"].iloc[0]), [{} for _ in range(top + 1)]
        for level, node, digest_ in zip(block["level"], block["node"], block["digest"], strict=True):
            held[level][node] = bytes(digest_)
        mine = list(zip(block["level"].tolist(), block["node"].tolist(), strict=True))
        paths = grow(held, n, top, arity)
        rows = [(block["grp"].iloc[0], n, level, node, *paths[level][node]) for level, node in mine]
        out = pd.DataFrame(rows, columns=["grp", "n", "level", "node", "to_level", "to_node", "path"])
        first = out.groupby(["to_level", "to_node"]).cumcount() == 0
        out["root_of"] = [held[a][b] if f else None for a, b, f in zip(out["to_level"], out["to_node"], first, strict=True)]
        return out

    span = F.floor(F.col("node") / F.pow(F.lit(float(arity)), F.lit(top) - F.col("level"))).cast("long")
    grouped = nodes.withColumn("block", span).groupBy("grp", "block")
    return grouped.applyInPandas(work, "grp string, n long, level int, node long, to_level int, to_node long, path binary, root_of binary")


def tree(leaves: DataFrame, order: Sequence[str], arity: int = 2) -> tuple[DataFrame, DataFrame]:
    """A tree for each ``grp`` (a string, never null) of ``leaves`` (grp, leaf binary, other columns), leaves by ``order``.

    Returns the leaves (all columns, i, n, level, node, path) and the nodes
    they end in (grp, level, node, up: the path from there to the group's root,
    root). Equal leaves in the same place of the order are interchangeable.
    """
    columns = [c for c in leaves.columns if c not in ("grp", "leaf")]
    # the row's number splits repeated rows; written below, so it stays the same
    dealt = leaves.withColumn("tie", F.monotonically_increasing_id()).repartitionByRange("grp", *order, "leaf", "tie")
    held = staged(dealt.sortWithinPartitions("grp", *order, "leaf", "tie").drop("tie").withColumn("at", F.monotonically_increasing_id()), "leaves")
    held = held.withColumn("range", F.shiftright("at", _RANGE))
    counts = held.groupBy("grp", "range").agg(F.count(F.lit(1)).alias("m"), F.min("at").alias("least"))
    whole = Window.partitionBy("grp")
    earlier = F.coalesce(F.sum("m").over(whole.orderBy("range").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    offsets = staged(counts.select("grp", "range", (earlier - F.col("least")).alias("shift"), F.sum("m").over(whole).alias("n")), "offsets")
    most = offsets.agg(F.max("n")).first()[0] or 0
    numbered = held.join(offsets, ["grp", "range"]).withColumn("i", F.col("at") + F.col("shift"))
    paths = staged(_local(numbered, columns, arity), "paths")

    levels = steps_levels(arity)
    nodes = paths.where("root_of is not null").select("grp", "n", "level", "node", F.col("root_of").alias("digest"))
    ends, steps = nodes.select("grp", "n", "level", "node"), []
    for top in range(levels, max(levels, height(most, arity)) + levels, levels):
        # ragged nodes first, then whole blocks
        done = staged(_completed(nodes.where(F.col("level") < top), top, arity), "steps")
        steps.append(done)
        made = done.where("root_of is not null").select("grp", "n", F.col("to_level").alias("level"), F.col("to_node").alias("node"), F.col("root_of").alias("digest"))
        nodes = nodes.where(F.col("level") >= top).union(made)
        if top >= height(most, arity):
            break
    roots = staged(nodes.select("grp", F.col("digest").alias("root")), "roots")
    # from the highest step downwards: a node's path is its own step's and that of the node it ends in
    up = None
    for step in reversed(steps):
        own = step.select("grp", "level", "node", "to_level", "to_node", F.col("path").alias("own"))
        if up is None:
            up = own.select("grp", "level", "node", F.col("own").alias("up"))
        else:
            above = up.select("grp", F.col("level").alias("to_level"), F.col("node").alias("to_node"), "up")
            here = own.join(above, ["grp", "to_level", "to_node"], "left").select("grp", "level", "node", F.concat("own", F.coalesce("up", F.lit(b""))).alias("up"))
            up = staged(here.union(up), "up")
    known = ends.join(up, ["grp", "level", "node"], "left").join(roots, "grp")
    return paths.drop("root_of"), known.select("grp", "level", "node", F.coalesce("up", F.lit(b"")).alias("up"), "root")


def fold(leaf: bytes, i: int, n: int, siblings: bytes, arity: int) -> tuple[bytes, bytes]:
    """(digest, unused siblings) after folding ``leaf``, number ``i`` of ``n``, with its siblings."""
    while n > 1:
        first = i - i % arity
        others, at = min(first + arity, n) - first - 1, i - first
        leaf = digest([siblings[: 32 * at], leaf, siblings[32 * at : 32 * others]])
        siblings, i, n = siblings[32 * others :], i // arity, -(-n // arity)
    return leaf, siblings


def merkle_manifest(docs: DataFrame, fields: Sequence[str] = FIELDS, group: str = "lang", order: str = "doc_id", arity: int = 2, claimed: Column | None = None) -> DataFrame:
    """The ``order`` column, leaf, subroot, root, proof_sha256, folded_root and verified for every row of ``docs``.

    A leaf is the digest of ``fields``; leaves of a group ascend by ``order``,
    null first; a group's root is a leaf of the tree over all groups, ordered
    by their UTF-8 bytes, null first. ``claimed`` is the leaf (binary) that a holder
    of the row shows, null where it is the row's own: folded with the proof it
    gives folded_root, and verified says whether that is the root. A lone leaf
    is its group's root, a lone group's root the root, with no siblings.
    Repeated rows have a leaf and a proof each; rows of one id ascend by their
    digests; columns that aren't named play no part; an empty table gives an
    empty result.
    """
    named = docs.select(
        F.concat(F.lit("="), F.col(f"`{group}`").cast("string")).alias("grp"),
        F.col(f"`{order}`").alias("key"),
        leaf_digest([F.col(f"`{f}`") for f in fields]).alias("leaf"),
        (claimed if claimed is not None else F.lit(None)).cast("binary").alias("claimed"),
    )
    # a null group sorts before all others, which begin with a sign
    paths, ends = tree(named.withColumn("grp", F.coalesce("grp", F.lit(""))), ["key"], arity)
    ends = staged(ends, "ends")
    groups = ends.select("grp", "root").distinct().select(F.lit("").alias("grp"), F.col("grp").alias("name"), F.col("root").alias("leaf"))
    over, tops = tree(groups, ["name"], arity)
    above = over.join(tops, ["grp", "level", "node"]).select(F.col("name").alias("grp"), F.col("leaf").alias("subroot"), F.col("i").alias("group_i"), F.col("n").alias("group_n"), F.concat("path", "up").alias("over"), F.col("root").alias("whole"))
    known = ends.drop("root").join(staged(above, "above"), "grp")
    joined = paths.join(known, ["grp", "level", "node"]).select("key", "leaf", "claimed", "i", "n", "subroot", "group_i", "group_n", "whole", F.concat("path", "up").alias("inner"), "over")
    names = ["leaf", "subroot", "root", "proof_sha256", "folded_root"]

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            out: list[list[str]] = [[] for _ in names]
            columns = (batch.column(c).to_pylist() for c in ("leaf", "claimed", "i", "n", "subroot", "group_i", "group_n", "whole", "inner", "over"))
            for leaf, claim, i, n, subroot, group_i, group_n, root, inner, outer in zip(*columns, strict=True):
                folded, rest = fold(claim or leaf, i, n, inner, arity)
                folded, more = fold(folded, group_i, group_n, outer, arity)
                assert not rest and not more, "a proof of the wrong length"
                for to, value in zip(out, (leaf, subroot, root, digest([inner, outer]), folded), strict=True):
                    to.append(value.hex())
            verified = [a == b for a, b in zip(out[2], out[4], strict=True)]
            yield pa.RecordBatch.from_arrays([batch.column("key"), *(pa.array(c, pa.string()) for c in out), pa.array(verified, pa.bool_())], names=[order, *names, "verified"])

    kind = docs.schema[order].dataType.simpleString()
    return joined.mapInArrow(work, f"`{order}` {kind}, {', '.join(f'{n} string' for n in names)}, verified boolean")


def one_more(column: str, where: Column, fields: Sequence[str] = FIELDS) -> Column:
    """Leaf of a row whose ``column`` was raised by one (null stays null), for the rows of ``where``; null for others."""
    values = [F.col(f"`{f}`") + 1 if f == column else F.col(f"`{f}`") for f in fields]
    return F.when(where, leaf_digest(values))
