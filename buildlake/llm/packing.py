"""Order-preserving packing of documents into windows by dynamic programming.

Texts are encoded once, where they lie. What moves afterwards is small: for
each document its length, its possible cuts (sentence ends, and places inside
sentences of more than ``LONG`` tokens) and the CRC of its ids up to each cut. Rows
are range-partitioned by id; each partition is a stream whose cuts minimise
padding plus penalties: ``cost(j) = penalty(j) + min over i of cost(i) +
capacity - (pos(j) - pos(i))`` for ``pos(j) - pos(i) <= capacity``. As the
capacity is constant the minimum runs over ``cost(i) + pos(i)`` in a sliding
window, which a monotone queue gives in constant time. All later cuts descend
from an entry of the queue; as soon as the entries have an ancestor in common,
the windows up to it are final and given out, so what is held is short and the
result is that of one program over the whole stream. The CRC of a piece follows
from the CRCs at its ends, so no ids are kept or moved.
"""

from __future__ import annotations

import bisect
import math
import zlib
from collections import deque
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from buildlake.llm.common import doc_texts, staged
from buildlake.llm.tokens import load, sentence_ends

CAPACITY = 2048
LONG, STRIDE = 256, 64
"""A sentence of more than ``LONG`` tokens may be cut every ``STRIDE``; shorter ones are whole, which pads a window by an eighth at worst."""
SENTENCE, INSIDE = 16, 128
"""Penalties, in tokens of padding, of a cut at a sentence end and inside a sentence; a cut at a document's end is free."""
WINDOWS = 256
"""Windows' worth of tokens that are read before final windows are looked for."""
PARTITION_TOKENS = 4_000_000

# fixed value: the reflected CRC-32 polynomial
_POLYNOMIAL = 0xEDB88320


def _times(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Product of polynomials modulo the CRC's, bits reflected."""
    a, b = a.astype(np.uint32), b.astype(np.uint32)
    out = np.zeros_like(b)
    for bit in range(31, -1, -1):
        out ^= np.where((a >> np.uint32(bit)) & np.uint32(1), b, np.uint32(0))
        b = (b >> np.uint32(1)) ^ np.where(b & np.uint32(1), np.uint32(_POLYNOMIAL), np.uint32(0))
    return out


def _shifts(n: int) -> np.ndarray:
    """x ** (32 k) for k up to n: what a CRC is multiplied by when k 32-bit ids follow."""
    table = np.array([1 << 31], np.uint32)
    step = np.array([1 << 31], np.uint32)
    for _ in range(32):
        step = (step >> np.uint32(1)) ^ np.where(step & np.uint32(1), np.uint32(_POLYNOMIAL), np.uint32(0))
    while len(table) <= n:  # doubling: the table so far times x ** (32 len(table))
        factor = _times(table[-1:], step)
        table = np.concatenate([table, _times(np.repeat(factor, len(table)), table)])
    return table[: n + 1]


def slice_crcs(before: np.ndarray, until: np.ndarray, lengths: np.ndarray, shifts: np.ndarray) -> np.ndarray:
    """CRCs of slices from the CRCs of what ends before and with them."""
    return until.astype(np.uint32) ^ _times(shifts[lengths], before)


def possible_cuts(ids: np.ndarray, ends: np.ndarray, long: int = LONG, stride: int = STRIDE) -> tuple[np.ndarray, np.ndarray]:
    """(positions behind which a document may be cut, whether inside a sentence); the last is its end."""
    n = len(ids)
    stops = np.flatnonzero(ends[ids]) + 1
    edges = np.append(np.append(0, stops[stops < n]), n)
    gaps = np.diff(edges)
    extra = np.where(gaps > long, (gaps - 1) // stride, 0)
    if not extra.any():
        return edges[1:], np.zeros(len(gaps), bool)
    nth = np.arange(extra.sum()) - np.repeat(np.cumsum(extra) - extra, extra) + 1
    forced = np.repeat(edges[:-1], extra) + nth * stride
    cuts = np.concatenate([edges[1:], forced])
    order = np.argsort(cuts, kind="stable")
    return cuts[order], (np.arange(len(cuts)) >= len(gaps))[order]


class Cuts:
    """The cheapest cuts of a stream of positions that arrive bit by bit.

    No two neighbours of them (increasing) may be further apart than
    ``capacity``. Numbers of cuts count from 1; 0 is the stream's start.
    """

    def __init__(self, capacity: int = CAPACITY) -> None:
        self.capacity, self.first = capacity, 0  # number of what is first in the lists
        self.at, self.key, self.back = [0], [0.0], [0]
        self.queue: deque[int] = deque([0])

    def add(self, pos: np.ndarray, penalty: np.ndarray) -> None:
        at, key, back, queue, first, capacity = self.at, self.key, self.back, self.queue, self.first, self.capacity
        for p, extra in zip(pos.tolist(), penalty.tolist(), strict=True):
            j = first + len(at)
            while p - at[queue[0] - first] > capacity:
                queue.popleft()
            i = queue[0]
            k = key[i - first] + capacity + extra  # the cost of a cut here, and its position
            at.append(p)
            key.append(k)
            back.append(i)
            while queue and key[queue[-1] - first] >= k:
                queue.pop()
            queue.append(j)

    def settled(self, last: bool = False) -> list[int]:
        """Numbers of the cuts that are certain by now (with ``last``: all to the end), in order; earlier ones are forgotten."""
        if last:
            end = self.first + len(self.at) - 1
        else:  # the latest entry gives way to what it descends from until one is left
            live = sorted(set(self.queue))
            while len(live) > 1:
                before = self.back[live.pop() - self.first]
                at = bisect.bisect_left(live, before)
                if at == len(live) or live[at] != before:
                    live.insert(at, before)
            end = live[0]
        out, j = [], end
        while j > self.first:
            out.append(j)
            j = self.back[j - self.first]
        drop = end - self.first
        self.at, self.key, self.back, self.first = self.at[drop:], self.key[drop:], self.back[drop:], end
        return out[::-1]


def best_cuts(pos: np.ndarray, penalty: np.ndarray, capacity: int = CAPACITY) -> list[int]:
    """Indices of the cheapest cuts from position 0 to ``pos[-1]``, the last included."""
    cuts = Cuts(capacity)
    cuts.add(pos, penalty)
    return [j - 1 for j in cuts.settled(last=True)]


ENCODED = "doc_id long, rid long, doc_tokens long, cuts binary, inside binary, crcs binary"
PIECES = "part int, doc_id long, start long, length long, ids_crc32 long, doc_tokens long, window long, offset long"


def encode_documents(docs: DataFrame, path: str, ranks: str | None, end_id: int, long: int = LONG, stride: int = STRIDE) -> DataFrame:
    """Per row: number of ids with the end id, possible cuts, CRCs up to each cut."""
    ends = sentence_ends(path)

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tokenizer = load(path, ranks)
        for batch in batches:
            for at in range(0, batch.num_rows, 256):
                part, rows = batch.slice(at, 256), []
                for text in part.column(2):
                    ids = np.append(tokenizer.encode(text.as_py()), np.uint32(end_id)).astype("<u4")
                    cuts, inside = possible_cuts(ids, ends, long, stride)
                    raw, crc, last, crcs = memoryview(ids).cast("B"), 0, 0, []
                    for cut in cuts.tolist():
                        crc = zlib.crc32(raw[4 * last : 4 * cut], crc)
                        crcs.append(crc)
                        last = cut
                    rows.append((len(ids), cuts.astype("<u4").tobytes(), inside.tobytes(), np.array(crcs, "<u4").tobytes()))
                kinds = (pa.int64(), pa.binary(), pa.binary(), pa.binary())
                yield pa.RecordBatch.from_arrays([part.column(0), part.column(1), *(pa.array(c, t) for c, t in zip(zip(*rows, strict=True), kinds, strict=True))], names=["doc_id", "rid", "doc_tokens", "cuts", "inside", "crcs"])

    return docs.select("doc_id", F.monotonically_increasing_id().alias("rid"), "text").mapInArrow(work, ENCODED)


class _Stream:
    """Documents in order; emits pieces of final windows. Positions count from the stream's start."""

    def __init__(self, capacity: int, sentence: float, inside: float) -> None:
        self.costs = np.array([sentence, inside], dtype=float)
        self.cuts, self.shifts = Cuts(capacity), _shifts(capacity)
        self.docs: list[tuple] = []  # start, doc_id, doc_tokens, cuts, CRCs: not all of it in final windows
        self.end = self.begin = self.windows = self.held = 0

    def add(self, doc_id: int | None, tokens: int, cuts: np.ndarray, inside: np.ndarray, crcs: np.ndarray) -> None:
        penalty = self.costs[inside.astype(np.int64)]
        penalty[-1] = 0.0
        self.cuts.add(cuts.astype(np.int64) + self.end, penalty)
        self.docs.append((self.end, doc_id, tokens, cuts, crcs))
        self.end += tokens
        self.held += tokens

    def flush(self, final: bool) -> list[tuple]:
        self.held = 0
        base = self.cuts.first
        places = self.cuts.at
        chosen = self.cuts.settled(last=final)
        if not chosen or not self.docs:
            return []
        edge = np.array([self.begin, *(places[j - base] for j in chosen)])
        end = int(edge[-1])
        starts = np.array([d[0] for d in self.docs])
        pos = np.concatenate([d[3].astype(np.int64) + d[0] for d in self.docs])
        crcs = np.concatenate([d[4] for d in self.docs])
        edges = np.unique(np.concatenate([edge, starts[(starts > self.begin) & (starts < end)]]))
        a, b = edges[:-1], edges[1:]
        doc = np.searchsorted(starts, a, side="right") - 1
        win = np.searchsorted(edge, a, side="right") - 1
        before = np.where(a == starts[doc], np.uint32(0), crcs[np.minimum(np.searchsorted(pos, a), len(pos) - 1)])
        got = slice_crcs(before, crcs[np.searchsorted(pos, b)], b - a, self.shifts)
        rows = [
            (self.docs[d][1], s, n, int(c), self.docs[d][2], w, o)
            for d, s, n, c, w, o in zip(doc.tolist(), (a - starts[doc]).tolist(), (b - a).tolist(), got.tolist(), (win + self.windows).tolist(), (a - edge[win]).tolist(), strict=True)
        ]
        self.windows += len(chosen)
        self.begin = end
        self.docs = [d for d in self.docs if d[0] + d[2] > end]
        return rows


def pack_documents(docs: DataFrame, path: str, ranks: str | None = None, end_id: int = 1, capacity: int = CAPACITY, sentence: float = SENTENCE, inside: float = INSIDE, partition_tokens: int = PARTITION_TOKENS, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Pieces of all documents, in the order of their ids, in windows of at most ``capacity`` tokens.

    Returns doc_id, start, length, ids_crc32, doc_tokens, sequence_id, offset;
    windows are meant to be padded to ``capacity``. Each id of a document
    (its text's ids and ``end_id``) lies in exactly one piece. A null text is
    empty, an empty one a single end id; null ids come first; repeated rows
    are packed each; an empty table gives an empty result. The last window of
    each partition (of about ``partition_tokens``) may be padded more.
    """
    encoded = staged(encode_documents(doc_texts(docs, id_col, text_col), path, ranks, end_id, min(LONG, capacity), min(STRIDE, capacity)), "encoded")
    total = encoded.agg(F.sum("doc_tokens")).first()[0] or 0
    ordered = encoded.repartitionByRange(max(1, math.ceil(total / partition_tokens)), F.col("doc_id"), F.col("rid")).sortWithinPartitions("doc_id", "rid").withColumn("part", F.spark_partition_id())
    kinds = [("doc_id", pa.int64()), ("start", pa.int64()), ("length", pa.int64()), ("ids_crc32", pa.int64()), ("doc_tokens", pa.int64()), ("window", pa.int64()), ("offset", pa.int64())]

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        stream, part = _Stream(capacity, sentence, inside), 0

        def table(rows: list[tuple]) -> pa.RecordBatch:
            return pa.RecordBatch.from_arrays([pa.array([part] * len(rows), pa.int32()), *(pa.array(c, t) for c, (_, t) in zip(zip(*rows, strict=True), kinds, strict=True))], names=["part", *[n for n, _ in kinds]])

        for batch in batches:
            cols = {n: batch.column(n) for n in ("doc_id", "doc_tokens", "cuts", "inside", "crcs", "part")}
            for i in range(batch.num_rows):
                part = cols["part"][i].as_py()
                stream.add(cols["doc_id"][i].as_py(), cols["doc_tokens"][i].as_py(), np.frombuffer(cols["cuts"][i].as_buffer(), "<u4"), np.frombuffer(cols["inside"][i].as_buffer(), bool), np.frombuffer(cols["crcs"][i].as_buffer(), "<u4"))
                if stream.held >= WINDOWS * capacity and (rows := stream.flush(final=False)):
                    yield table(rows)
        if rows := stream.flush(final=True):
            yield table(rows)

    pieces = staged(ordered.mapInArrow(work, PIECES), "pieces")
    counts = pieces.groupBy("part").agg((F.max("window") + 1).alias("n"))
    # one row for each ``partition_tokens``: written, so that its size decides how it is joined
    starts = staged(counts.withColumn("first", F.coalesce(F.sum("n").over(Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))).drop("n"), "starts")
    placed = pieces.join(starts, "part")
    return placed.select("doc_id", "start", "length", "ids_crc32", "doc_tokens", (F.col("first") + F.col("window")).alias("sequence_id"), "offset")
