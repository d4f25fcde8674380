"""Target-distribution importance resampling over hashed word runs.

1. Each task keeps a trie of the word runs it has read: a node holds how often
   its run occurs and the CRC-32 of the run's bytes, continued from its
   parent's. A trie of more than ``NODES`` nodes is emptied into bucket totals,
   so a task's memory is bounded and nothing is lost. Totals by bucket are
   summed for the corpus and for the target texts: at most ``buckets`` rows.
2. A bucket's gain is the scaled log ratio of its smoothed shares. Tasks walk
   the paths of each text again; a node found once has its gain attached.
3. A document's weight is its mean gain; Gumbel noise from a hash of its id
   makes the highest scores a weighted draw without replacement. Ranks come
   from ranges of the score with the counts of the earlier ranges, so no task
   sees more than its range.
"""

from __future__ import annotations

import math
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from buildlake.llm.common import doc_texts, staged
from buildlake.operators.numbering import with_keys

NODES = 1 << 20
"""Nodes of a trie before it is emptied."""

_TABLE = bytes(c + 32 if 0x41 <= c <= 0x5A else c if 0x30 <= c <= 0x39 or 0x61 <= c <= 0x7A or c >= 0x80 else 0x20 for c in range(256))


def words_of(text: str) -> list[bytes]:
    """Words ``[^\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]+`` after lower-casing A-Z, as UTF-8."""
    return text.encode().translate(_TABLE).split()


class Node:
    """A run of words: CRC of its bytes, occurrences, gain once known, longer runs by their next word."""

    __slots__ = ("crc", "gain", "longer", "times")

    def __init__(self, crc: int) -> None:
        self.crc, self.times, self.gain, self.longer = crc, 0, 0, {}


class Trie:
    """Runs of 1 to ``most`` words; ``gains`` (by bucket) are attached to nodes when they are made."""

    def __init__(self, most: int, buckets: int, gains: np.ndarray | None = None) -> None:
        self.most, self.buckets = most, buckets
        self.gains = None if gains is None else gains.tolist()
        self.clear()

    def clear(self) -> None:
        self.root, self.size = Node(0), 0

    def child(self, node: Node, word: bytes) -> Node:
        """The run that is longer by ``word``, made where it is new; words of a run are joined by one space."""
        found = node.longer.get(word)
        if found is None:
            found = node.longer[word] = Node(zlib.crc32(word if node is self.root else b" " + word, node.crc))
            self.size += 1
            if self.gains is not None:
                found.gain = self.gains[found.crc % self.buckets]
        return found

    def add(self, words: list[bytes], begin: int, end: int) -> None:
        """Count every run that starts at words ``begin`` to ``end``."""
        for i in range(begin, min(end, len(words))):
            node = self.root
            for word in words[i : i + self.most]:
                node = self.child(node, word)
                node.times += 1

    def gain(self, words: list[bytes], begin: int, end: int) -> int:
        """Sum of the gains of every run that starts at words ``begin`` to ``end``."""
        total = 0
        for i in range(begin, min(end, len(words))):
            node = self.root
            for word in words[i : i + self.most]:
                node = self.child(node, word)
                total += node.gain
        return total

    def totals(self) -> np.ndarray:
        """Occurrences by bucket."""
        out = np.zeros(self.buckets, dtype=np.int64)
        todo = [self.root]
        while todo:
            for node in todo.pop().longer.values():
                out[node.crc % self.buckets] += node.times
                if node.longer:
                    todo.append(node)
        return out


def runs(n_words: int, most: int) -> int:
    """Number of runs of 1 to ``most`` words among ``n_words``."""
    return sum(max(0, n_words - k + 1) for k in range(1, most + 1))


def bucket_totals(texts: DataFrame, most: int, buckets: int, nodes: int = NODES) -> np.ndarray:
    """Occurrences by bucket of all runs in ``texts`` (doc_id, text): one row a bucket reaches the driver."""

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        trie, held = Trie(most, buckets), np.zeros(buckets, dtype=np.int64)
        for batch in batches:
            for text in batch.column(0):
                words = words_of(text.as_py())
                for i in range(0, len(words), nodes):
                    trie.add(words, i, i + nodes)
                    if trie.size > nodes:
                        held += trie.totals()
                        trie.clear()
        held += trie.totals()
        at = np.flatnonzero(held)
        yield pa.RecordBatch.from_arrays([pa.array(at), pa.array(held[at])], names=["bucket", "times"])

    sums = texts.select("text").mapInArrow(work, "bucket long, times long").groupBy("bucket").agg(F.sum("times").alias("times"))
    out = np.zeros(buckets, dtype=np.int64)
    for row in sums.collect():
        out[row["bucket"]] = row["times"]
    return out


def bucket_gains(source: np.ndarray, target: np.ndarray) -> np.ndarray:
    """Gain by bucket: 1000 times the log ratio of the target's smoothed share to the corpus's, floored."""
    n, all_source, all_target = len(source), int(source.sum()), int(target.sum())
    ratio = lambda s, t: (t + 1.0) * (all_source + n) / ((s + 1.0) * (all_target + n))
    return np.array([math.floor(1000 * math.log(ratio(s, t))) for s, t in zip(source.tolist(), target.tolist(), strict=True)], dtype=np.int64)


def importance_resample(docs: DataFrame, target: DataFrame, percent: int = 10, most: int = 1, buckets: int = 10000, least_words: int = 20, seed: int = 2024, id_col: str = "doc_id", text_col: str = "text", target_text: str = "text", nodes: int = NODES) -> DataFrame:
    """doc_id, n_features, weight, score, rank of every row of ``docs``.

    Features are all runs of 1 to ``most`` words, repeats counted. Of the N
    rows with at least ``least_words`` words, floor(percent * N / 100) with the
    highest scores have ranks from 1, ties in favour of smaller ids (null ids
    first, then in any order); all other ranks are null. Null and empty texts
    have no features and weight 0; a null id is hashed as an empty one;
    repeated rows are drawn each; an empty table gives an empty result, and an
    empty target a uniform share for each bucket.
    """
    texts = doc_texts(docs, id_col, text_col)
    gains = bucket_gains(
        bucket_totals(texts, most, buckets, nodes),
        bucket_totals(target.select(F.coalesce(F.col(f"`{target_text}`").cast("string"), F.lit("")).alias("text")), most, buckets, nodes),
    )

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        trie = Trie(most, buckets, gains)
        for batch in batches:
            sizes, weights = [], []
            for text in batch.column(1):
                words = words_of(text.as_py())
                n, total = runs(len(words), most), 0
                for i in range(0, len(words), nodes):
                    total += trie.gain(words, i, i + nodes)
                    if trie.size > nodes:
                        trie.clear()
                sizes.append((n, len(words)))
                weights.append(total // n if n else 0)
            columns = [batch.column(0), *(pa.array(c, pa.int64()) for c in ([s[0] for s in sizes], [s[1] for s in sizes], weights))]
            yield pa.RecordBatch.from_arrays(columns, names=["doc_id", "n_features", "n_words", "weight"])

    weighed = texts.mapInArrow(work, "doc_id long, n_features long, n_words long, weight long")
    digest = F.sha2(F.concat(F.lit(f"{seed}:"), F.coalesce(F.col("doc_id").cast("string"), F.lit(""))), 256)
    h = F.conv(F.substring(digest, 1, 8), 16, 10).cast("long")
    noise = F.floor(-1000 * F.log(-F.log((h + F.lit(0.5)) / F.lit(4294967296.0))))
    able = (F.col("n_words") >= least_words).alias("able")
    # the row's number only splits repeated rows; it is written, so it stays the same
    scored = staged(weighed.select("doc_id", "n_features", "weight", (F.col("weight") + noise).alias("score"), able, F.monotonically_increasing_id().alias("row")), "scored")
    drawn = percent * scored.where("able").count() // 100
    ordered = scored.withColumns({"unable": ~F.col("able"), "lower": -F.col("score")})
    ranked = with_keys(ordered, "place", ["unable", "lower", "doc_id", "row"])
    rank = F.when(F.col("able") & (F.col("place") <= drawn), F.col("place"))
    return ranked.select("doc_id", "n_features", "weight", "score", rank.alias("rank"))
