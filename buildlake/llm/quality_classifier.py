"""Quality classifier: attention-based multiple-instance learning over passages.

A document is a bag of passages of ``PASSAGE`` words. Every passage is encoded
by its mix of byte classes and its repetitions, a learned layer embeds it, and
gated attention (a tanh and a sigmoid branch, multiplied) weighs the embeddings
into one vector, which a logistic unit scores. Labels are known for documents
only. Fitting takes a bounded sample of labelled rows; scoring is one Arrow
pass over all rows with a few thousand weights in its closure.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from buildlake.llm.common import doc_texts, filled
from buildlake.llm.words import Words, batch_words, mix

PASSAGE = 64
SAMPLE = 3000
"""Labelled documents that the fit takes at most."""
SAMPLE_PASSAGES = 200
"""A labelled document of more passages is left out of the fit (never of the scores)."""

# byte classes: 0 other control, then each kind of character that tells prose from debris
_CLASSES = [b" ", b"\n", b"\t\r\x0b\x0c", b"abcdefghijklmnopqrstuvwxyz", b"ABCDEFGHIJKLMNOPQRSTUVWXYZ", b"0123456789", b".", b",", b";:", b"!", b"?", b"'\"`", b"()[]{}", b"-_", b"#", b"*", b"$", b"%", b"&", b"|", b"<>", b"/\\", b"=+~^@", bytes(range(0x80, 0xC0)), bytes(range(0xC0, 0x100))]
CLASS = np.zeros(256, np.int64)
for _i, _c in enumerate(_CLASSES, 1):
    CLASS[list(_c)] = _i
N_CLASSES = len(_CLASSES) + 1
WIDTH = N_CLASSES + 6


def encode_passages(w: Words, passage: int = PASSAGE) -> tuple[np.ndarray, np.ndarray]:
    """(features of all passages of a slice, ptr of each document's passages); a document without words has one empty passage."""
    n_words = np.diff(w.ptr)
    per = np.maximum(1, -(-n_words // passage))
    ptr = np.concatenate([[0], np.cumsum(per)])
    doc = np.repeat(np.arange(len(per)), per)
    nth = np.arange(ptr[-1]) - ptr[doc]
    first = w.ptr[doc] + nth * passage
    last = np.minimum(first + passage, w.ptr[doc + 1])
    # a passage's bytes go from its first word to the next passage's, the first's from the text's start
    begin = np.where(nth == 0, w.offsets[doc], w.begin[np.minimum(first, max(0, len(w.begin) - 1))] if len(w.begin) else 0)
    sizes = np.diff(np.append(begin, len(w.data)))
    total = int(ptr[-1])
    of_byte = np.repeat(np.arange(total), sizes)
    counts = np.bincount(of_byte * N_CLASSES + CLASS[w.data], minlength=total * N_CLASSES).reshape(total, N_CLASSES)
    words = last - first
    of_word = np.repeat(np.arange(total), words)
    length = w.end - w.begin
    again = np.zeros(len(w.hashes), bool)
    again[1:] = (w.hashes[1:] == w.hashes[:-1]) & (of_word[1:] == of_word[:-1])

    # the passage of each distinct word: its first place
    order = np.unique(mix(w.hashes ^ mix(of_word.astype(np.uint64))), return_index=True)[1]
    some = np.maximum(words, 1)
    mean = lambda x: np.bincount(of_word, x, minlength=total) / some
    extra = np.column_stack([
        np.bincount(of_word[order], minlength=total) / some,
        mean(again.astype(float)),
        mean(np.minimum(length, 40).astype(float)) / 10,
        mean((length > 15).astype(float)),
        words / passage,
        (n_words[doc] == 0).astype(float),
    ])
    return np.column_stack([np.sqrt(counts / np.maximum(sizes, 1)[:, None]), extra]), ptr


@dataclass(frozen=True)
class AttentionModel:
    """Weights: standardisation, embedding (w1, b1), attention branches (v, u), its vector (a), the logistic unit (c, d)."""

    mean: np.ndarray
    scale: np.ndarray
    w1: np.ndarray
    b1: np.ndarray
    v: np.ndarray
    u: np.ndarray
    a: np.ndarray
    c: np.ndarray
    d: np.ndarray

    def forward(self, x: np.ndarray, ptr: np.ndarray) -> tuple[np.ndarray, ...]:
        bag = np.repeat(np.arange(len(ptr) - 1), np.diff(ptr))
        h = np.tanh(((x - self.mean) / self.scale) @ self.w1 + self.b1)
        t, s = np.tanh(h @ self.v), 1 / (1 + np.exp(-(h @ self.u)))
        e = (t * s) @ self.a
        e = np.exp(e - np.maximum.reduceat(e, ptr[:-1])[bag])
        weight = e / np.add.reduceat(e, ptr[:-1])[bag]
        z = np.add.reduceat(weight[:, None] * h, ptr[:-1])
        return bag, h, t, s, weight, z, 1 / (1 + np.exp(-(z @ self.c + self.d)))

    def gradients(self, x: np.ndarray, ptr: np.ndarray, labels: np.ndarray) -> list[np.ndarray]:
        """Of the mean cross entropy of the bags' labels, in the order of the weights from w1 on."""
        bag, h, t, s, weight, z, score = self.forward(x, ptr)
        g = (score - labels) / len(labels)
        dz = g[:, None] * self.c
        dw = (h * dz[bag]).sum(1)
        de = weight * (dw - np.add.reduceat(weight * dw, ptr[:-1])[bag])
        dt, ds = de[:, None] * self.a * s * (1 - t * t), de[:, None] * self.a * t * s * (1 - s)
        dh = weight[:, None] * dz[bag] + dt @ self.v.T + ds @ self.u.T
        dpre = dh * (1 - h * h)
        return [((x - self.mean) / self.scale).T @ dpre, dpre.sum(0), h.T @ dt, h.T @ ds, (t * s).T @ de, z.T @ g, np.array([g.sum()])]

    def scores(self, x: np.ndarray, ptr: np.ndarray) -> np.ndarray:
        return self.forward(x, ptr)[-1] if len(ptr) > 1 else np.zeros(0)


def train(bags: list[np.ndarray], labels: np.ndarray, hidden: int = 24, branch: int = 12, epochs: int = 30, batch: int = 64, rate: float = 0.01, decay: float = 1e-4, seed: int = 11) -> AttentionModel:
    """Adam on the cross entropy of document labels; deterministic."""
    rng = np.random.default_rng(seed)
    everything = np.concatenate(bags)
    mean, scale = everything.mean(0), everything.std(0) + 1e-3
    p = [rng.normal(0, s**-0.5, (s, n)) for s, n in ((WIDTH, hidden), (hidden, branch), (hidden, branch))]
    p = [p[0], np.zeros(hidden), p[1], p[2], rng.normal(0, branch**-0.5, branch), rng.normal(0, hidden**-0.5, hidden), np.array([float(np.log((labels.mean() + 0.01) / (1.01 - labels.mean())))])]
    m1, m2, step = [np.zeros_like(q) for q in p], [np.zeros_like(q) for q in p], 0
    for epoch in range(epochs):
        order = rng.permutation(len(bags))
        for at in range(0, len(bags), batch):
            some = order[at : at + batch]
            x = np.concatenate([bags[i] for i in some])
            ptr = np.concatenate([[0], np.cumsum([len(bags[i]) for i in some])])
            grads = AttentionModel(mean, scale, *p).gradients(x, ptr, labels[some])
            step += 1
            lr = rate * 0.5 * (1 + np.cos(np.pi * epoch / epochs))
            for k, grad in enumerate(grads):
                grad = grad + decay * p[k]
                m1[k] = 0.9 * m1[k] + 0.1 * grad
                m2[k] = 0.999 * m2[k] + 0.001 * grad * grad
                p[k] = p[k] - lr * (m1[k] / (1 - 0.9**step)) / (np.sqrt(m2[k] / (1 - 0.999**step)) + 1e-8)
    return AttentionModel(mean, scale, *p)


def held_out(doc_id: Column) -> Column:
    return F.coalesce(F.crc32(doc_id.cast("string")) % 4 == 2, F.lit(False))


def fit_quality(docs: DataFrame, labels: DataFrame, sample: int = SAMPLE, id_col: str = "doc_id", text_col: str = "text", label_id: str = "doc_id", label: str = "quality") -> AttentionModel | None:
    """Model from at most ``sample`` labelled rows (those of least hash) that are not held out; None without both labels."""
    marked = labels.where(F.col(f"`{label}`").isNotNull() & F.col(f"`{label_id}`").isNotNull()).groupBy(F.col(f"`{label_id}`").cast("long").alias("doc_id")).agg(F.max(F.col(f"`{label}`").cast("int")).alias("y"))
    chosen = marked.where(~held_out(F.col("doc_id"))).orderBy(F.xxhash64("doc_id"), "doc_id").limit(2 * sample)

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for first, w in batch_words(batch.column(1), lower=False):
                x, ptr = encode_passages(w)
                n = len(ptr) - 1
                fits = np.diff(ptr) <= SAMPLE_PASSAGES
                kept = pa.array(fits)
                bags = pa.array([x[ptr[i] : ptr[i + 1]].astype("<f4").tobytes() if fits[i] else b"" for i in range(n)], pa.binary())
                yield pa.RecordBatch.from_arrays([c.filter(kept) for c in (batch.column(0).slice(first, n), batch.column(2).slice(first, n), bags)], names=["doc_id", "y", "bag"])

    rows = doc_texts(docs, id_col, text_col).join(F.broadcast(chosen), "doc_id").mapInArrow(work, "doc_id long, y int, bag binary")
    got = rows.orderBy(F.xxhash64("doc_id"), "doc_id", "bag").limit(sample).toPandas()
    if got["y"].nunique() < 2:
        return None
    bags = [np.frombuffer(b, "<f4").reshape(-1, WIDTH).astype(float) for b in got["bag"]]
    return train(bags, got["y"].to_numpy().astype(float))


def score_quality(docs: DataFrame, model: AttentionModel | None, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(doc_id, score) of every row, from its text alone."""

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for first, w in batch_words(batch.column(1), lower=False, most=1 << 20):
                n = len(w.ptr) - 1
                scores = model.scores(*encode_passages(w)) if model is not None else np.full(n, 0.5)
                yield pa.RecordBatch.from_arrays([batch.column(0).slice(first, n), pa.array(scores)], names=["doc_id", "score"])

    return doc_texts(docs, id_col, text_col).mapInArrow(work, "doc_id long, score double")


def classify_quality(docs: DataFrame, labels: DataFrame, cut: float = 0.7, sample: int = SAMPLE, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """doc_id, held_out, score (0 to 1, higher: good likelier), predicted of every row of ``docs``.

    Rows whose crc32 of the id, as text, is 2 modulo 4 are held out: their
    labels are never seen. Null and empty texts are one empty passage; null
    ids are not held out; repeated rows get equal scores; without labels of
    both kinds every score is 0.5; an empty table gives an empty result.
    """
    model = fit_quality(docs, labels, sample, id_col, text_col)
    scored = score_quality(docs, model, id_col, text_col)
    return scored.select("doc_id", held_out(F.col("doc_id")).alias("held_out"), "score", (F.col("score") >= cut).cast("int").alias("predicted"))


def keep_predicted(docs: DataFrame, labels: DataFrame, cut: float = 0.7, sample: int = SAMPLE, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """The rows of ``docs``, with all their columns, that ``classify_quality`` predicts to be good; no shuffle of texts.

    Without labels of both kinds there is no model and every row stays.
    """
    model = fit_quality(docs, labels, sample, id_col, text_col)
    if model is None:
        return docs

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for first, w in batch_words(filled(batch, text_col), lower=False, most=1 << 20):
                part = batch.slice(first, len(w.ptr) - 1)
                yield part.filter(pa.array(model.scores(*encode_passages(w)) >= cut))

    return docs.mapInArrow(work, docs.schema)
