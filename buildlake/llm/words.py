"""Vectorised words of whole Arrow batches: byte classes, 64-bit word hashes, shingles.

Texts are never copied into Python strings. A slice of documents is looked at
as one byte array; runs of bytes that are no separators are words, and a
document's edge ends a word. Work arrays are a few MB (``CHUNK``), whatever
the length of a text; what grows with a text is 24 bytes a word.
"""

from __future__ import annotations

from collections.abc import Iterator
from typing import NamedTuple

import numpy as np
import pyarrow as pa

CHUNK = 1 << 20
SLICE = 6 << 20
_U = np.uint64
_BASE = 0x9E3779B97F4A7C15 | 1
_ROUND = np.array([0xBF58476D1CE4E5B9, 0x94D049BB133111EB], dtype=_U)

WHITE = np.zeros(256, dtype=bool)
WHITE[[0x20, *range(0x09, 0x0E)]] = True
"""Separators of ``[^\\x20\\x09-\\x0D]+``."""
NON_ALNUM = np.ones(256, dtype=bool)
NON_ALNUM[0x30:0x3A] = NON_ALNUM[0x61:0x7B] = NON_ALNUM[0x80:] = False
"""Separators of ``[^\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]+``, once A-Z are lower-cased."""
LOWER = np.arange(256, dtype=np.uint8)
LOWER[0x41:0x5B] += 32

_power: tuple[np.ndarray, np.ndarray] | None = None


def _powers(n: int) -> tuple[np.ndarray, np.ndarray]:
    global _power
    if _power is None or len(_power[0]) < n:
        n = max(n, CHUNK + 4096)
        both = []
        for base in (_BASE, pow(_BASE, -1, 1 << 64)):
            p = np.full(n, base, dtype=_U)
            p[0] = 1
            both.append(np.multiply.accumulate(p))
        _power = both[0], both[1]
    return _power


def mix(x: np.ndarray) -> np.ndarray:
    """A bijective finaliser over unsigned 64-bit values."""
    x = x ^ (x >> _U(30))
    x = x * _ROUND[0]
    x ^= x >> _U(27)
    x *= _ROUND[1]
    return x ^ (x >> _U(31))


class Words(NamedTuple):
    """Words of a slice: hash, first byte and end byte in ``data``; ``ptr[i]:ptr[i+1]`` are those of document i."""

    hashes: np.ndarray
    begin: np.ndarray
    end: np.ndarray
    ptr: np.ndarray
    data: np.ndarray
    offsets: np.ndarray


def string_buffers(column: pa.Array | pa.ChunkedArray) -> tuple[np.ndarray, np.ndarray]:
    """(bytes, offsets) of a string column without nulls, without a copy where Arrow allows."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
        if isinstance(column, pa.ChunkedArray):
            column = pa.concat_arrays(column.chunks)
    wide = pa.types.is_large_string(column.type) or pa.types.is_large_binary(column.type)
    _, off, data = column.buffers()
    if len(column) == 0 or off is None:
        return np.zeros(0, np.uint8), np.zeros(len(column) + 1, np.int64)
    offsets = np.frombuffer(off, np.int64 if wide else np.int32)[column.offset : column.offset + len(column) + 1].astype(np.int64)
    raw = np.frombuffer(data, np.uint8) if data is not None else np.zeros(0, np.uint8)
    return raw[offsets[0] : offsets[-1]], offsets - offsets[0]


def slices(offsets: np.ndarray, most: int = SLICE) -> Iterator[tuple[int, int]]:
    """Ranges of documents of about ``most`` bytes together, one document at least."""
    i, n = 0, len(offsets) - 1
    while i < n:
        j = max(i + 1, int(np.searchsorted(offsets, offsets[i] + most, side="right")) - 1)
        yield i, min(j, n)
        i = min(j, n)


def words_of(data: np.ndarray, offsets: np.ndarray, sep: np.ndarray = WHITE, lower: bool = True) -> Words:
    """Words of the documents at ``offsets`` in ``data``."""
    n = len(data)
    parts_h, parts_b, parts_e = [], [], []
    edges = np.unique(offsets)
    at = 0
    while at < n:
        to = min(n, at + CHUNK)
        while to < n:  # end a chunk behind a separator or at a document's edge, so no word is cut
            back = data[max(at, to - 65536) : to]
            white = np.flatnonzero(sep[LOWER[back]] if lower else sep[back])
            edge = int(edges[np.searchsorted(edges, to, side="right") - 1])
            cut = max(max(at, to - 65536) + int(white[-1]) + 1 if len(white) else 0, edge)
            if cut > at:
                to = cut
                break
            to = min(n, to + 65536)
        b = LOWER[data[at:to]] if lower else data[at:to]
        word = ~sep[b]
        fresh = np.zeros(to - at + 1, dtype=bool)
        inside = edges[np.searchsorted(edges, at) : np.searchsorted(edges, to, side="right")] - at
        fresh[inside] = True
        fresh[0] = fresh[-1] = True
        start = word.copy()
        start[1:] &= ~word[:-1] | fresh[1:-1]
        stop = word.copy()
        stop[:-1] &= ~word[1:] | fresh[1:-1]
        s, e = np.flatnonzero(start), np.flatnonzero(stop) + 1
        if len(s):
            power, inverse = _powers(to - at)
            sums = np.empty(to - at + 1, dtype=_U)
            sums[0] = 0
            np.cumsum((b.astype(_U) + _U(1)) * power[: to - at], out=sums[1:])
            h = (sums[e] - sums[s]) * inverse[s]
            parts_h.append(mix(h + (e - s).astype(_U) * _U(0xD6E8FEB86659FD93)))
            parts_b.append(s + at)
            parts_e.append(e + at)
        at = to
    if parts_h:
        hashes, begin, end = np.concatenate(parts_h), np.concatenate(parts_b), np.concatenate(parts_e)
    else:
        hashes, begin, end = np.zeros(0, _U), np.zeros(0, np.int64), np.zeros(0, np.int64)
    return Words(hashes, begin, end, np.searchsorted(begin, offsets), data, offsets)


def batch_words(column: pa.Array, sep: np.ndarray = WHITE, lower: bool = True, most: int = SLICE) -> Iterator[tuple[int, Words]]:
    """(index of the slice's first document, its Words), over slices of a batch's text column."""
    data, offsets = string_buffers(column)
    for i, j in slices(offsets, most):
        yield i, words_of(data[offsets[i] : offsets[j]], offsets[i : j + 1] - offsets[i], sep, lower)


def shingles(hashes: np.ndarray, k: int) -> np.ndarray:
    """Hash of each run of k words of one document; of the whole if it has fewer; none without words."""
    n = len(hashes)
    if not n:
        return hashes
    m = min(k, n)
    out = np.full(n - m + 1, m, dtype=_U)
    odd = _U(_BASE)
    for j in range(m):
        out = out * odd + hashes[j : n - m + 1 + j]
        out ^= out >> _U(29)
    return mix(out)
