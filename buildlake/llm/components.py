"""Connected components of an edge table, by large-star and small-star rounds."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from buildlake.llm.common import staged


def _fingerprint(links: DataFrame) -> tuple:
    return tuple(links.agg(F.count(F.lit(1)), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)"))).first())


def components(edges: DataFrame) -> DataFrame:
    """(node, component): the least node that each node of ``edges`` (a, b) reaches.

    Every round halves the distance to the least neighbour or better; each
    round's edges are written to the shared folder, and the rounds go on until
    one changes nothing. Least neighbours are written before they are joined: a
    node with any number of neighbours is many rows of a join with two plain
    sides, which can be split at run time. Self links and repeated links are
    harmless.
    """
    links = staged(edges.where("a <> b").select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).distinct(), "links")
    state, before = _fingerprint(links), None
    while state[0] and state != before:
        # large star: every larger neighbour of a node is linked with the node's least neighbour
        both = links.union(links.select(F.col("b").alias("a"), F.col("a").alias("b")))
        least = staged(both.groupBy("a").agg(F.min("b").alias("m")).select("a", F.least("a", "m").alias("m")), "least")
        large = staged(both.where("b > a").join(least, "a").select(F.col("b").alias("a"), F.col("m").alias("b")).where("a <> b").distinct(), "large")
        # small star: a node and its smaller neighbours are linked with the least of them
        least = staged(large.groupBy("a").agg(F.min("b").alias("m")), "least")
        small = large.join(least, "a").select(F.col("b").alias("a"), F.col("m").alias("b")).where("a <> b").union(least.select("a", F.col("m").alias("b"))).distinct()
        links = staged(small, "links")
        state, before = _fingerprint(links), state
    nodes = links.select(F.col("a").alias("node"), F.col("b").alias("component"))
    return nodes.union(links.select(F.col("b").alias("node"), F.col("b").alias("component")).distinct())
