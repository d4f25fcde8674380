"""Quality rules: statistics of every whole text, judged by an isolation forest.

An Arrow pass turns each text into a few counts. A forest of random splits is
grown from half of the rows labelled good: each of them is dealt to one tree at
least, to more where they are few, and each tree grows in the task that holds
its rows. A document's anomaly score is ``2 ** (-mean path length / c(rows of a
tree))``. The threshold on the score is calibrated on all labelled rows that the
forest has not seen: the one of least cost, where a rejected good row costs
``COST`` times what a kept bad one does, found by sums along the scores. Trees
are tables of a few thousand numbers, so scoring is one map over the statistics.

Two things differ from the plain forest: it grows on rows labelled good only,
and a split value is drawn beyond the largest value of its rows by up to
``BEYOND`` of the statistic's span over all labelled rows, so that a document
beyond all of a tree's rows is isolated early, also by a statistic in which good
rows are all alike.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass, replace

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from buildlake.llm.common import doc_texts, filled, staged
from buildlake.llm.words import Words, batch_words, shingles
from buildlake.operators import scans

SYMBOLS = np.zeros(256, dtype=bool)
SYMBOLS[list(b"#*$%&|<>")] = True

TREES, PSI, SEED = 100, 256, 7
"""``PSI``: rows of a tree, at least, where there are so many; its depth is that of so many rows."""
COST = 10.0
"""What rejecting a share of the good rows costs, against keeping the same share of the bad ones."""
BEYOND = 0.1
"""Share of a statistic's span by which a split may lie beyond its rows."""

FEATURES = ("symbols", "repeats", "dup_lines", "upper", "word_length")
STATS = "doc_id long, n_words long, word_chars long, n_symbols long, n_dup_lines long, n_repeat_words long, n_upper long, n_bytes long, n_lines long"


def _per_doc(flags: np.ndarray, offsets: np.ndarray) -> np.ndarray:
    sums = np.zeros(len(flags) + 1, dtype=np.int64)
    np.cumsum(flags, out=sums[1:])
    return sums[offsets[1:]] - sums[offsets[:-1]]


def _repeat_words(hashes: np.ndarray) -> int:
    """Words covered by 3-word windows that occur twice or more."""
    if len(hashes) < 4:
        return 0
    grams = shingles(hashes, 3)
    order = np.argsort(grams, kind="stable")
    same = grams[order[1:]] == grams[order[:-1]]
    if not same.any():
        return 0
    twice = np.zeros(len(grams), dtype=bool)
    twice[order[1:][same]] = True
    twice[order[:-1][same]] = True
    covered = np.zeros(len(hashes), dtype=bool)
    for j in range(3):
        covered[j : len(grams) + j] |= twice
    return int(covered.sum())


def _dup_lines(text: bytes) -> int:
    seen, n = set(), 0
    for line in text.split(b"\n"):
        if line in seen:
            n += 1
        elif line.split(None, 1):
            seen.add(line)
    return n


def slice_stats(w: Words) -> dict[str, np.ndarray]:
    data, off = w.data, w.offsets
    docs = range(len(off) - 1)
    raw = data.tobytes()
    inside = np.zeros(len(data) + 1, dtype=np.int8)  # +1 where a word begins, -1 behind its end
    np.add.at(inside, w.begin, 1)
    np.add.at(inside, w.end, -1)
    in_word = np.cumsum(inside[:-1], dtype=np.int8).astype(bool)
    return {
        "n_words": np.diff(w.ptr),
        "word_chars": _per_doc(in_word & ((data & 0xC0) != 0x80), off),
        "n_symbols": _per_doc(SYMBOLS[data], off),
        "n_dup_lines": np.array([_dup_lines(raw[off[i] : off[i + 1]]) for i in docs], dtype=np.int64),
        "n_repeat_words": np.array([_repeat_words(w.hashes[w.ptr[i] : w.ptr[i + 1]]) for i in docs], dtype=np.int64),
        "n_upper": _per_doc((data >= 0x41) & (data <= 0x5A), off),
        "n_bytes": np.diff(off),
        "n_lines": _per_doc(data == 0x0A, off) + (np.diff(off) > 0),
    }


def _slices(batch: pa.RecordBatch, text: pa.Array) -> Iterator[tuple[pa.RecordBatch, dict[str, np.ndarray]]]:
    """Slices of a batch, each with its statistics."""
    for first, w in batch_words(text, lower=False):
        yield batch.slice(first, len(w.offsets) - 1), slice_stats(w)


def text_statistics(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row of counts for each row of ``docs``; no words: zeros."""

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part, cols in _slices(batch, batch.column(1)):
                yield pa.RecordBatch.from_arrays([part.column(0), *map(pa.array, cols.values())], names=["doc_id", *cols])

    return doc_texts(docs, id_col, text_col).mapInArrow(work, STATS)


def features(p: dict[str, np.ndarray]) -> np.ndarray:
    """Scale-free statistics, so that a long clean text looks like a short one."""
    words = np.maximum(p["n_words"], 1).astype(float)
    n_bytes = np.maximum(p["n_bytes"], 1).astype(float)
    return np.column_stack([
        np.minimum(p["n_symbols"] / words, 2.0),
        p["n_repeat_words"] / words,
        p["n_dup_lines"] / np.maximum(p["n_lines"], 1),
        p["n_upper"] / n_bytes,
        np.minimum(p["word_chars"] / words, 30.0) / 10.0,
    ])


def feature_columns() -> list[Column]:
    """``features`` as columns over ``STATS``: no second Python worker stands beside the one that counts."""
    p = {c.split()[0]: F.col(c.split()[0]).cast("double") for c in STATS.split(", ")}
    one = F.lit(1.0)
    words = F.greatest(p["n_words"], one)
    found = (
        F.least(p["n_symbols"] / words, F.lit(2.0)),
        p["n_repeat_words"] / words,
        p["n_dup_lines"] / F.greatest(p["n_lines"], one),
        p["n_upper"] / F.greatest(p["n_bytes"], one),
        F.least(p["word_chars"] / words, F.lit(30.0)) / F.lit(10.0),
    )
    return [c.alias(name) for c, name in zip(found, FEATURES, strict=True)]


@dataclass(frozen=True)
class Forest:
    """Trees of equal depth as arrays [tree, node]: split feature (-1: leaf), split value, path length at a leaf."""

    feature: np.ndarray
    value: np.ndarray
    length: np.ndarray
    psi: int
    threshold: float = 1.0

    def scores(self, x: np.ndarray) -> np.ndarray:
        total = np.zeros(len(x))
        rows = np.arange(len(x))
        for f, v, size in zip(self.feature, self.value, self.length, strict=True):
            at = np.zeros(len(x), dtype=np.int64)
            for _ in range(int(np.log2(len(f) + 1))):
                here = f[at]
                split = here >= 0
                right = x[rows, np.maximum(here, 0)] >= v[at]
                at = np.where(split, 2 * at + 1 + right, at)
            total += size[at]
        return np.exp2(-total / max(1, len(self.feature)) / max(_c(self.psi), 1e-9))


def _c(n: int) -> float:
    """Mean path length of an unsuccessful search among n."""
    return 0.0 if n < 2 else 1.0 if n == 2 else 2 * (np.log(n - 1) + 0.5772156649) - 2 * (n - 1) / n


def depth_of(psi: int) -> int:
    return max(1, int(np.ceil(np.log2(max(2, psi)))))


def grow_tree(x: np.ndarray, depth: int, span: np.ndarray, rng: np.random.Generator) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Split feature, split value and path length of each node of a tree over all rows of ``x``."""
    nodes = 2 ** (depth + 1) - 1
    feature, value, length = np.full(nodes, -1), np.zeros(nodes), np.zeros(nodes)
    todo = [(0, 0, x)]
    while todo:
        at, d, part = todo.pop()
        low, high = (part.min(0), part.max(0) + BEYOND * span) if len(part) else (np.zeros(0), np.zeros(0))
        able = np.flatnonzero(high > low)
        if d == depth or len(part) < 2 or not len(able):
            length[at] = d + _c(len(part))
            continue
        f = int(rng.choice(able))
        v = rng.uniform(low[f], high[f])
        feature[at], value[at] = f, v
        right = part[:, f] >= v
        todo += [(2 * at + 1, d + 1, part[~right]), (2 * at + 2, d + 1, part[right])]
    return feature, value, length


def grow(x: np.ndarray, trees: int = TREES, psi: int = PSI, seed: int = SEED, span: np.ndarray | None = None) -> Forest:
    """Isolation forest over the rows of ``x``; each tree takes ``psi`` of them. ``span``: of each statistic, else that of ``x``."""
    rng = np.random.default_rng(seed)
    psi = min(psi, len(x))
    if span is None:
        span = x.max(0) - x.min(0) if len(x) else np.zeros(x.shape[1])
    grown = [grow_tree(x[rng.choice(len(x), psi, replace=False)] if len(x) else x, depth_of(psi), span, rng) for _ in range(trees)]
    return Forest(*map(np.stack, zip(*grown, strict=True)), psi)


def dealt(rows: DataFrame, copies: int, trees: int = TREES) -> DataFrame:
    """Rows of ``FEATURES``, each ``copies`` times with a different ``tree``; equal rows get the same ones."""
    picks = F.transform(F.sequence(F.lit(0), F.lit(trees - 1)), lambda t: F.struct(F.xxhash64(*FEATURES, t).alias("h"), t.alias("tree")))
    return rows.select(*FEATURES, F.explode(F.slice(F.array_sort(picks), 1, copies)["tree"]).alias("tree"))


def grow_dealt(rows: DataFrame, n: int, span: np.ndarray, trees: int = TREES, psi: int = PSI, seed: int = SEED) -> Forest:
    """Isolation forest over all of ``rows``, which hold ``n`` different ones: a tree has ``psi`` of them or its share, whichever is more.

    The trees reach the driver: ``trees`` tables of a few hundred nodes each.
    """
    copies = min(trees, max(1, -(-psi * trees // n)))
    depth = depth_of(min(psi, n))

    def one(key: tuple, part: pd.DataFrame) -> pd.DataFrame:
        x = np.unique(part[list(FEATURES)].to_numpy(), axis=0)
        grown = grow_tree(x, depth, span, np.random.default_rng([seed, key[0]]))
        return pd.DataFrame({"tree": [key[0]], **{c: [v.tolist()] for c, v in zip(("feature", "value", "length"), grown, strict=True)}})

    found = dealt(rows, copies, trees).groupBy("tree").applyInPandas(one, "tree int, feature array<long>, value array<double>, length array<double>").toPandas().sort_values("tree")
    return Forest(*(np.stack([np.asarray(v) for v in found[c]]) for c in ("feature", "value", "length")), max(1, n * copies // trees))


def least_cost(good: np.ndarray, bad: np.ndarray, cost: float = COST) -> float:
    """Threshold on scores of labelled rows: above it, ``cost`` * (share of good rows) + (share of bad rows not above it) is least.

    Of several the highest, and then half the way to the next score, so that
    documents just unlike the sample's get the benefit of the doubt. Without
    bad rows nothing shows what to reject: all scores pass.
    """
    if not len(bad) or not len(good):
        return 1.0
    good, bad = np.sort(good), np.sort(bad)
    cuts = np.unique(np.concatenate([good, bad]))
    price = cost * (len(good) - np.searchsorted(good, cuts, "right")) / len(good) + np.searchsorted(bad, cuts, "right") / len(bad)
    best = len(cuts) - 1 - int(np.argmin(price[::-1]))
    return float((cuts[best] + (cuts[best + 1] if best + 1 < len(cuts) else 1.0)) / 2)


def least_cost_of(scored: DataFrame, cost: float = COST) -> float:
    """``least_cost`` of any number of rows (score, good 0 or 1): sums of both kinds along the scores."""
    counted = staged(scored.groupBy("score").agg(F.sum("good").alias("good"), F.sum(1 - F.col("good")).alias("bad")), "scores")
    n = counted.agg(F.sum("good").alias("good"), F.sum("bad").alias("bad")).first()
    if not n["good"] or not n["bad"]:
        return 1.0
    along = scans.scanned(counted, [], ["score"], {"good": scans.Sum(F.col("good")), "bad": scans.Sum(F.col("bad")), "behind": scans.Following(F.col("score"))})
    price = F.lit(float(cost)) * (n["good"] - F.col("good")) / n["good"] + F.col("bad") / n["bad"]
    best = along.agg(F.min(F.struct(price.alias("price"), (-F.col("score")).alias("lower"), "behind")).alias("best")).first()["best"]
    return (1.0 if best["behind"] is None else best["behind"]) / 2 - best["lower"] / 2


def fit_rules(stats: DataFrame, labels: DataFrame, cost: float = COST, trees: int = TREES, psi: int = PSI, label_id: str = "doc_id", label: str = "quality") -> Forest | None:
    """Forest and threshold from all labelled rows of ``text_statistics`` that pass the base rule; None without good rows.

    Half of the rows labelled good, by a hash, grow the forest; the other half
    and the rows labelled bad, none of which it has seen, decide on the threshold.
    """
    marked = labels.where(F.col(f"`{label}`").isNotNull() & F.col(f"`{label_id}`").isNotNull()).groupBy(F.col(f"`{label_id}`").cast("long").alias("doc_id")).agg(F.max(f"`{label}`").cast("int").alias("good"))
    found = stats.where("n_words >= 50 and 100 * n_repeat_words <= 50 * n_words").join(marked.where("good in (0, 1)"), "doc_id")
    grows = (F.col("good") == 1) & (F.pmod(F.xxhash64("doc_id", "n_bytes", "n_words"), F.lit(2)) == 0)
    found = found.withColumn("grows", grows)

    rows = staged(found.select(F.col("good"), F.col("grows"), *feature_columns()), "labelled")
    good = F.col("good") == 1
    spans = [(F.max(c) - F.min(c)).alias(c) for c in FEATURES]
    seen = rows.agg(F.count_if(good).alias("n_good"), F.count_if("grows").alias("n_grow"), *spans).first()
    if not seen["n_good"]:
        return None
    if seen["n_grow"] in (0, seen["n_good"]):  # too few to be halved
        growing, held = rows.where(good), rows
    else:
        growing, held = rows.where("grows"), rows.where("not grows")
    forest = grow_dealt(growing, growing.select(*FEATURES).distinct().count(), np.array([seen[c] for c in FEATURES]), trees, psi)

    def scored(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            x = np.column_stack([batch.column(c).to_numpy() for c in FEATURES])
            yield pa.RecordBatch.from_arrays([pa.array(forest.scores(x)), batch.column("good")], names=["score", "good"])

    return replace(forest, threshold=least_cost_of(held.select("good", *FEATURES).mapInArrow(scored, "score double, good int"), cost))


def verdicts(stats: dict[str, np.ndarray], forest: Forest | None) -> dict[str, np.ndarray]:
    """base_failed, anomaly (the forest's score) and kept of rows with statistics."""
    failed = (stats["n_words"] < 50) | (100 * stats["n_repeat_words"] > 50 * stats["n_words"])
    anomaly = forest.scores(features(stats)) if forest is not None else np.zeros(len(failed))
    return {"base_failed": failed, "anomaly": anomaly, "kept": ~failed & (anomaly <= (forest.threshold if forest is not None else 1.0))}


def quality_rules(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text", cost: float = COST) -> DataFrame:
    """Statistics, base rule and the forest's verdict for each row of ``docs``.

    Words are ``[^\\x20\\x09-\\x0D]+``. base_failed: fewer than 50 words, or over
    half of them in 3-word windows that the text repeats. kept is false where
    base_failed, else whether the anomaly is within the calibrated threshold.
    Null and empty texts have no words, so they fail; repeated rows are judged
    alike; without labelled good rows only the base rule counts; other
    columns are ignored; an empty table gives an empty result. Texts are read
    once: their statistics are written.
    """
    stats = staged(text_statistics(docs, id_col, text_col), "statistics")
    forest = fit_rules(stats, labels, cost)

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            judged = verdicts({c: batch.column(c).to_numpy() for c in batch.schema.names[1:]}, forest)
            yield pa.RecordBatch.from_arrays([*batch.columns, *map(pa.array, judged.values())], names=[*batch.schema.names, *judged])

    return stats.mapInArrow(work, f"{STATS}, base_failed boolean, anomaly double, kept boolean")


def keep_good(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text", cost: float = COST) -> DataFrame:
    """The rows of ``docs``, with all their columns, that ``quality_rules`` keeps; no shuffle of texts."""
    forest = fit_rules(text_statistics(docs, id_col, text_col), labels, cost)

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part, stats in _slices(batch, filled(batch, text_col)):
                yield part.filter(pa.array(verdicts(stats, forest)["kept"]))

    return docs.mapInArrow(work, docs.schema)
