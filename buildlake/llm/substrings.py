"""Repeated passages: shared k-mer seeds, chained with a Fenwick tree, then aligned.

1. Each text is a sequence of word hashes, and each of its k-mers is a seed,
   so two texts that share ``K`` words in a row anywhere share a seed. Seeds
   travel in compressed blocks, one for each bucket of hashes and some million
   seeds; only those that several documents have become rows.
2. A seed with at most ``RARE`` places matches each of them with every earlier
   document's. Places of more frequent seeds go back to their texts, where two
   that follow each other make a pair seed and ``least_words`` words that they
   cover make a long one. Pair seeds are matched like the first ones; frequent
   pairs and long seeds match each place with one earlier document's. So
   a run of ``least_words`` + 3 words is never lost to other places of its
   parts: two rare seeds in it match all who have them, and without those
   one of its long seeds does. Frequent seeds are told apart where they are
   dealt out: of such a seed, a block sends a few places and no more.
   Places of frequent pairs are noted. Where, once passages are known, none
   covers a window that is full of them, its text meets every earlier one that
   shares enough of them there: an exact prefix join, which looks up only the
   rarer ones of a window and leaves out texts that have too few of the words
   around them for a passage. So one earlier document is never in the way of others.
3. A text's matches with one earlier text are chained: in order in both, a
   gain for each seed, a cost for each word of gap. The best predecessor is a
   prefix maximum over the earlier text's positions, kept in a Fenwick tree.
4. Chains are aligned word by word (32 bits of a hash each), gaps by longest
   common subsequences, and extended at both ends; long and similar ones are
   passages. Both texts come as slices around the chain.
Exact copies of a whole text (by SHA-256) are set aside first and linked with
the first.
"""

from __future__ import annotations

import hashlib
import math
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from buildlake.llm.common import doc_texts, free_name, staged, text_key, text_key_of
from buildlake.llm.words import WHITE, batch_words, mix, shingles, slices, string_buffers, words_of

K = 4
"""Of 50 words with 10 replaced, 4 in a row are left at least."""
RARE = 8
"""Places of a seed up to which all of them are matched with each other."""
PAIR_SPAN = 20
"""Words between the starts of a pair seed's two parts, at most."""
NEAR, STEP = 24, 10
"""Repetitions at most so many words apart are numbered; equal runs are chained at each ``STEP``-th seed and their last."""
WIDTH = 5
"""Bytes of a seed's hash that are sent besides its bucket; more buckets tell more seeds apart, and equal hashes of different words only cost an alignment."""
BLOCK = 1 << 21
"""So many seeds, at least, are dealt out to the buckets at once; second seeds, which take more room, a quarter of that."""
KEY_WORDS = 16
"""Frequent pairs that begin in one stretch of so many words of the first text are looked up as one."""
MARGIN = 64
"""So many words beside a chain go with it; where they don't settle its ends, the whole texts do."""
GAIN, GAP = 6.0, 0.1
LEAST_WORDS = 50
SIMILARITY = 0.8
EDGE_DROP = 8
"""An end is extended until it has lost this many points (match 1, mismatch -2)."""

_NULL_ID = -1 << 63


def seeds(hashes: np.ndarray, k: int = K) -> np.ndarray:
    """Hashes of all k-mers of one text, in order; nothing under k words."""
    if len(hashes) < k:
        return np.zeros(0, np.uint64)
    grams = shingles(hashes, k)
    order = np.sort(grams)
    return numbered_runs(grams, np.arange(len(grams)), NEAR) if (order[1:] == order[:-1]).any() else grams


def _packed(x: np.ndarray) -> bytes:
    return np.ascontiguousarray(x.view(np.uint8).reshape(len(x), -1).T).tobytes()


def _unpacked(raw: bytes, n: int, kind: str) -> np.ndarray:
    return np.ascontiguousarray(np.frombuffer(raw, np.uint8).reshape(-1, n).T).reshape(-1).view(kind)


BLOCKS = "bucket int, settled boolean, n int, n_texts int, h binary, places binary"
_BLOCK_KINDS = (pa.int32(), pa.bool_(), pa.int32(), pa.int32(), pa.binary(), pa.binary())


def spare(h: np.ndarray) -> np.ndarray:
    """Which seeds a bucket needn't see to know that they are frequent: there are more than ``RARE`` of theirs before them."""
    out = np.zeros(len(h), bool)
    g = np.sort(h)
    often = g[RARE + 1 :][g[RARE + 1 :] == g[: -RARE - 1]]
    if not len(often):
        return out
    # only seeds with the low bits of a frequent one need their order
    low = np.uint64((1 << 20) - 1)
    some = np.zeros(1 << 20, bool)
    some[often & low] = True
    order = np.flatnonzero(some[h & low])
    order = order[np.argsort(h[order], kind="stable")]
    g = h[order]
    place = np.arange(len(g))
    out[order] = place - np.maximum.accumulate(np.where(np.append(True, g[1:] != g[:-1])[: len(g)], place, 0)) > RARE
    return out


def _block(bucket: int, settled: bool, h: np.ndarray, of: np.ndarray, x: np.ndarray, docs: np.ndarray, parts: np.ndarray) -> tuple:
    """One row of ``BLOCKS``: hashes, and compressed differences of ids, keys, counts and places."""
    new = np.append(0, np.flatnonzero(of[1:] != of[:-1]) + 1)
    t = of[new]
    raw = _packed(np.diff(docs[t], prepend=np.int64(0))) + _packed(parts[t]) + _packed(np.diff(new, append=len(of)).astype("<i4")) + _packed(np.diff(x, prepend=np.int64(0)))
    return bucket, settled, len(of), len(t), h.tobytes(), pa.compress(raw, "zstd", asbytes=True)


def blocks(h: np.ndarray, of: np.ndarray, x: np.ndarray, docs: np.ndarray, parts: np.ndarray, buckets: int) -> Iterator[tuple]:
    """Seeds (hash, number of its text, place) of texts (id, key) as rows of ``BLOCKS``, one for each bucket."""
    bucket = (h % np.uint64(buckets)).astype(np.uint16 if buckets <= 1 << 16 else np.uint32)
    order = np.argsort(bucket, kind="stable")
    short = (h // np.uint64(buckets))[order].view(np.uint8).reshape(-1, 8)[:, :WIDTH]
    of, x = of[order], x[order]
    edges = np.searchsorted(bucket[order], np.arange(buckets + 1))
    for b in np.flatnonzero(edges[1:] > edges[:-1]).tolist():
        i, j = edges[b], edges[b + 1]
        yield _block(b, False, short[i:j], of[i:j], x[i:j], docs, parts)


def block_seeds(bucket: int, settled: bool, n: int, n_texts: int, h: bytes, places: bytes, buckets: int) -> tuple[np.ndarray, ...]:
    """(hash, doc_id, key, place) of the seeds of a block; a hash keeps its bucket and ``WIDTH`` bytes more."""
    if settled:
        whole = np.frombuffer(h, "<u8")
        whole, low = whole // np.uint64(buckets) & np.uint64((1 << 8 * WIDTH) - 1), whole % np.uint64(buckets)
    else:
        short = np.zeros((n, 8), np.uint8)
        short[:, :WIDTH] = np.frombuffer(h, np.uint8).reshape(n, WIDTH)
        whole, low = short.reshape(-1).view("<u8"), np.uint64(bucket)
    raw = pa.decompress(places, 20 * n_texts + 8 * n, "zstd", asbytes=True)
    at = [0, 8 * n_texts, 16 * n_texts, 20 * n_texts]
    ids, keys, counts = (_unpacked(raw[a:b], n_texts, t) for a, b, t in zip(at, at[1:], ("<i8", "<i8", "<i4"), strict=False))
    return whole * np.uint64(buckets) + low, np.repeat(np.cumsum(ids), counts), np.repeat(keys, counts), np.cumsum(_unpacked(raw[at[3] :], n, "<i8"))


def met(h: np.ndarray, doc: np.ndarray, part: np.ndarray, x: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """What the places of a bucket's seeds come to: (later, earlier, frequent, first).

    All are indices: pairs of places of rare seeds in different documents; all
    places of frequent seeds, each with the seed's first place in the least
    document. Places of copies of one text are one place, of its least document.
    """
    order = np.argsort(h)
    g = h[order]
    same = g[1:] == g[:-1]
    some = np.zeros(len(g), bool)
    some[1:] = same
    some[:-1] |= same
    order = order[some]
    order = order[np.lexsort((doc[order], x[order], part[order], h[order]))]
    again = np.zeros(len(order), bool)
    again[1:] = (h[order[1:]] == h[order[:-1]]) & (part[order[1:]] == part[order[:-1]]) & (x[order[1:]] == x[order[:-1]])
    order = order[~again]
    g = h[order]
    new = np.concatenate([[True], g[1:] != g[:-1]])[: len(g)]
    group = np.cumsum(new) - 1
    size = np.bincount(group, minlength=1)[group] if len(g) else np.zeros(0, np.int64)
    later, earlier = [], []
    rare = size <= RARE
    for step in range(1, min(RARE, len(group))):
        i = np.flatnonzero(rare[step:] & (group[step:] == group[: len(group) - step]))
        a, b = order[i], order[i + step]
        up, down = doc[a] > doc[b], doc[a] < doc[b]
        later += [a[up], b[down]]
        earlier += [b[up], a[down]]
    order = order[~rare]
    order = order[np.lexsort((x[order], part[order], doc[order], h[order]))]
    g = h[order]
    new = np.concatenate([[True], g[1:] != g[:-1]])[: len(g)]
    first = order[np.maximum.accumulate(np.where(new, np.arange(len(g)), 0))]
    none = [np.zeros(0, np.int64)]
    return np.concatenate(later or none), np.concatenate(earlier or none), order, first


def numbered_runs(grams: np.ndarray, at: np.ndarray, near: int) -> np.ndarray:
    """Seeds whose repetitions within ``near`` words of each other are told apart by their number in the run.

    So a text that goes round in a circle meets another one like it period by
    period, not every period with the first.
    """
    order = np.lexsort((at, grams))
    g, a = grams[order], at[order]
    place = np.arange(len(g))
    fresh = np.ones(len(g), bool)
    fresh[1:] = (g[1:] != g[:-1]) | (a[1:] - a[:-1] > near)
    nth = place - np.maximum.accumulate(np.where(fresh, place, 0))
    out = grams.copy()
    out[order] = np.where(nth > 0, mix(g ^ mix(nth.astype(np.uint64))), g)
    return out


_ODD = np.uint64(0x9E3779B97F4A7C15)
LONG = 31
"""In the place of a pair's distance: a long seed."""


def second_seeds(of: np.ndarray, x: np.ndarray, h: np.ndarray, least: int = LEAST_WORDS) -> tuple[np.ndarray, ...]:
    """(hash, number of the text, 32 * place + distance) of pair and long seeds over frequent seeds, in order of text and place.

    A pair's second part is, of those within ``PAIR_SPAN`` words, the one with
    the least hash of both, so an edit between them does no harm.
    """
    n = len(h)
    best, gap = np.full(n, np.iinfo(np.uint64).max, np.uint64), np.zeros(n, np.int64)
    for step in range(1, min(PAIR_SPAN, n - 1) + 1):
        d = x[step:] - x[: n - step]
        near = np.flatnonzero((of[step:] == of[: n - step]) & (d <= PAIR_SPAN) & (d >= K))
        if len(near):
            both = mix(h[near] * _ODD ^ h[near + step])
            less = both < best[near]
            best[near[less]], gap[near[less]] = both[less], d[near[less]]
    pair = np.flatnonzero(gap)
    offsets = [*range(0, least - K, K), least - K] if least > K else []
    where = (of.astype(np.int64) << 36) + x
    m = len(offsets)
    at = np.arange(max(0, n - m + 1) if m else 0)
    at = at[(of[at + m - 1] == of[at]) & (x[at + m - 1] - x[at] <= least - K)] if len(at) else at
    whole = np.zeros(len(at), np.uint64)
    for o in offsets:
        there = np.minimum(np.searchsorted(where, where[at] + o), n - 1)
        has = where[there] == where[at] + o
        at, there, whole = at[has], there[has], whole[has]
        whole = mix(whole * _ODD ^ h[there])
    order = np.argsort(np.concatenate([pair, at]), kind="stable")
    hashes, texts, codes = np.concatenate([best[pair], whole]), np.concatenate([of[pair], of[at]]), np.concatenate([x[pair] * 32 + gap[pair], x[at] * 32 + LONG])
    return hashes[order], texts[order], codes[order]


def seed_places(a: np.ndarray, b: np.ndarray, least: int = LEAST_WORDS) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(index, x, y) of the short seeds that two matched second seeds stand for."""
    kind = a & 31
    steps = np.array([*range(0, max(least - K, 1), STEP), max(least - K, 0)])
    pair, long = np.flatnonzero(kind != LONG), np.flatnonzero(kind == LONG)
    index = np.concatenate([pair, pair, np.repeat(long, len(steps))])
    more = [np.zeros(len(pair), np.int64), kind[pair], np.tile(steps, len(long))]
    other = [more[0], (b & 31)[pair], more[2]]
    return index, (a >> 5)[index] + np.concatenate(more), (b >> 5)[index] + np.concatenate(other)


def _prefix_best(tree: list[tuple[float, int]], i: int) -> tuple[float, int]:
    best = (-1.0, -1)
    while i > 0:
        if tree[i] > best:
            best = tree[i]
        i &= i - 1
    return best


def chain(x: list[int], y: list[int], gain: float = GAIN, gap: float = GAP) -> list[list[int]]:
    """Chains of matches (indices, in order), best first; each match is in one chain at most.

    f(i) = gain + max(0, max over j before i in both texts of f(j) - gap *
    (x_i - x_j + y_i - y_j)); ``x`` must not decrease.
    """
    n = len(x)
    rank = {v: r for r, v in enumerate(sorted(set(y)), 1)}
    tree = [(-1.0, -1)] * (len(rank) + 1)
    f, back = [0.0] * n, [-1] * n
    i = 0
    while i < n:
        j = i
        while j < n and x[j] == x[i]:  # matches of one place never follow each other
            value, at = _prefix_best(tree, rank[y[j]] - 1)
            value -= gap * (x[j] + y[j])
            f[j] = gain + max(0.0, value) if at >= 0 else gain
            back[j] = at if at >= 0 and value > 0 else -1
            j += 1
        for m in range(i, j):
            item, r = (f[m] + gap * (x[m] + y[m]), m), rank[y[m]]
            while r < len(tree):
                if item > tree[r]:
                    tree[r] = item
                r += r & -r
        i = j
    out, used = [], [False] * n
    for end in sorted(range(n), key=lambda m: (-f[m], m)):
        part, m = [], end
        while m >= 0 and not used[m]:
            used[m] = True
            part.append(m)
            m = back[m]
        if part:
            out.append(part[::-1])
    return out


def _common(a: np.ndarray, b: np.ndarray) -> int:
    """Longest common subsequence, one bit a word; a plain comparison where lengths agree and most words do."""
    if not len(a) or not len(b):
        return 0
    if len(a) == len(b):
        same = int((a == b).sum())
        if same >= len(a) - 2:
            return same
    places: dict[int, int] = {}
    for j, word in enumerate(b.tolist()):
        places[word] = places.get(word, 0) | 1 << j
    full = row = (1 << len(b)) - 1  # a zero where the subsequence grows
    for word in a.tolist():
        hit = row & places.get(word, 0)
        if hit:
            row = (row + hit | row - hit) & full
    return len(b) - row.bit_count()


def _extend(a: np.ndarray, b: np.ndarray, drop: int = EDGE_DROP) -> tuple[int, int, bool]:
    """(words, matches) by which two sequences go on alike from their starts; whether one of them ended before that was settled."""
    best = words = matches = score = done = 0
    unsettled = True
    n = min(len(a), len(b))
    while done < n:
        same = a[done : done + 256] == b[done : min(n, done + 256)][: len(a[done : done + 256])] if done + 256 <= n else a[done:n] == b[done:n]
        total = score + np.cumsum(np.where(same, 1, -2))
        top = np.maximum.accumulate(np.maximum(total, best))
        lost = np.flatnonzero(top - total > drop)
        stop = int(lost[0]) if len(lost) else len(same)
        if stop and total[:stop].max() > best:
            i = int(total[:stop].argmax())
            best, words = int(total[i]), done + i + 1
        if len(lost):
            unsettled = False
            break
        score = int(total[-1])
        done += len(same)
    if words:
        matches = int((a[:words] == b[:words]).sum())
    return words, matches, unsettled


def align(a: np.ndarray, b: np.ndarray, x: list[int], y: list[int], k: int = K, before: int = 0, after: int = 0, ref_before: int = 0, ref_after: int = 0) -> tuple[int, int, int, int, int] | None:
    """(start, end, ref start, ref end, matching words) of a chain of seeds at x in a and y in b.

    Of their texts, ``a`` and ``b`` lack so many words before and after; None if
    the result depends on them.
    """
    at_x, at_y, matched = x[0], y[0], 0
    for px, py in zip(x, y, strict=True):
        if px + k <= at_x or py + k <= at_y:
            continue
        step = max(at_x - px, at_y - py, 0)  # overlap with the seed before
        if step == 0:
            matched += _common(a[at_x:px], b[at_y:py])
        matched += k - step
        at_x, at_y = px + k, py + k
    left, left_same, left_open = _extend(a[: x[0]][::-1], b[: y[0]][::-1])
    right, right_same, right_open = _extend(a[at_x:], b[at_y:])
    rest_x, rest_y = len(a) - at_x, len(b) - at_y
    if left_open and (before and x[0] <= y[0] or ref_before and y[0] <= x[0]) or right_open and (after and rest_x <= rest_y or ref_after and rest_y <= rest_x):
        return None
    return x[0] - left, at_x + right, y[0] - left, at_y + right, matched + left_same + right_same


def _extend_all(a: np.ndarray, b: np.ndarray, at: np.ndarray, ref_at: np.ndarray, n: np.ndarray, step: int, drop: int = EDGE_DROP) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """``_extend`` of many sequences at once: they start at ``at`` in a and ``ref_at`` in b, have n words and go on by ``step``."""
    words, best, score, unsettled = np.zeros(len(n), np.int64), np.zeros(len(n), np.int64), np.zeros(len(n), np.int64), np.ones(len(n), bool)
    done, go = 0, np.flatnonzero(n > 0)
    while len(go):
        col = np.arange(min(max(64, (1 << 18) // len(go)), int(n[go].max()) - done))
        there = col < (n[go] - done)[:, None]
        i, j = (np.where(there, o[go][:, None] + step * (done + col), 0) for o in (at, ref_at))
        total = score[go][:, None] + np.cumsum(np.where(there, np.where(a[i] == b[j], 1, -2), 0), axis=1)
        lost = np.maximum.accumulate(np.maximum(total, best[go][:, None]), axis=1) - total > drop
        gone = lost.any(axis=1)
        score[go] = total[:, -1]
        total[np.logical_or.accumulate(lost, axis=1)] = -1
        top = total.argmax(axis=1)
        most = total[np.arange(len(go)), top]
        more = most > best[go]
        best[go[more]], words[go[more]] = most[more], done + top[more] + 1
        unsettled[go[gone]] = False
        done += len(col)
        go = go[~gone & (n[go] > done)]
    return words, (best + 2 * words) // 3, unsettled


def align_all(a: np.ndarray, a_at: np.ndarray, b: np.ndarray, b_at: np.ndarray, x: np.ndarray, y: np.ndarray, at: np.ndarray, before: np.ndarray, after: np.ndarray, ref_before: np.ndarray, ref_after: np.ndarray, k: int = K) -> tuple[np.ndarray, ...]:
    """``align`` of many chains at once, as arrays, and whether each result depends on words that aren't there.

    Chain i has the seeds ``at[i]:at[i + 1]`` of x and y, which ascend, and the words ``a_at[i]:a_at[i + 1]`` of a.
    """
    n = len(at) - 1
    first, last = at[:-1], at[1:] - 1
    chain_of = np.repeat(np.arange(n), np.diff(at))
    dx, dy = np.diff(x, prepend=0), np.diff(y, prepend=0)
    dx[first] = dy[first] = k
    overlap = np.maximum(np.maximum(k - dx, k - dy), 0)
    matched = np.zeros(n, np.int64)
    np.add.at(matched, chain_of, k - overlap)
    gap = np.flatnonzero((dx > k) & (dy > k))
    of, size, ref_size = chain_of[gap], dx[gap] - k, dy[gap] - k
    i, j = a_at[of] + x[gap] - size, b_at[of] + y[gap] - ref_size
    even = np.flatnonzero(size == ref_size)
    within = np.arange(size[even].sum()) - np.repeat(np.cumsum(size[even]) - size[even], size[even])
    same = np.zeros(len(gap), np.int64)
    np.add.at(same, np.repeat(even, size[even]), a[np.repeat(i[even], size[even]) + within] == b[np.repeat(j[even], size[even]) + within])
    for g in np.flatnonzero((size != ref_size) | (same < size - 2)).tolist():
        same[g] = _common(a[i[g] : i[g] + size[g]], b[j[g] : j[g] + ref_size[g]])
    np.add.at(matched, of, same)
    x0, y0, x1, y1 = x[first], y[first], x[last] + k, y[last] + k
    rest_x, rest_y = np.diff(a_at) - x1, np.diff(b_at) - y1
    left, left_same, left_open = _extend_all(a, b, a_at[:-1] + x0 - 1, b_at[:-1] + y0 - 1, np.minimum(x0, y0), -1)
    right, right_same, right_open = _extend_all(a, b, a_at[:-1] + x1, b_at[:-1] + y1, np.minimum(rest_x, rest_y), 1)
    unknown = left_open & ((before > 0) & (x0 <= y0) | (ref_before > 0) & (y0 <= x0)) | right_open & ((after > 0) & (rest_x <= rest_y) | (ref_after > 0) & (rest_y <= rest_x))
    return x0 - left, x1 + right, y0 - left, y1 + right, matched + left_same + right_same, unknown


CHAINS = "doc_id long, part long, ref_doc long, ref_part long, x_from int, x_to int, y_from int, y_to int, xs binary, ys binary"
_CHAIN_KINDS = (*(pa.int64(),) * 4, *(pa.int32(),) * 4, pa.binary(), pa.binary())
MET = "doc_id long, part long, ref_doc long, ref_part long, x long, y long, h long"
"""Matches, and frequent seeds (y -1) with their hashes. In the last round a match by a frequent pair has its hash."""
ALIGNED = f"{CHAINS}, start_word long, end_word long, ref_start long, ref_end long, matched long, similarity double"
PASSAGES = "doc_id long, text_key long, ref_doc_id long, start_word long, end_word long, ref_start long, ref_end long, matched long, similarity double"


def _names(schema: str) -> list[str]:
    return [f.split()[0] for f in schema.split(", ")]


def _table(rows: list[tuple], kinds: tuple, names: list[str]) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*rows, strict=True), kinds, strict=True)], names=names)


def _some(rows: Iterator[tuple], kinds: tuple, names: list[str], most: int) -> Iterator[pa.RecordBatch]:
    held = []
    for row in rows:
        held.append(row)
        if len(held) == most:
            yield _table(held, kinds, names)
            held = []
    if held:
        yield _table(held, kinds, names)


def _met_batches(cols: list[np.ndarray]) -> Iterator[pa.RecordBatch]:
    for i in range(0, len(cols[0]), 1 << 16):
        yield pa.RecordBatch.from_arrays([pa.array(c[i : i + (1 << 16)]) for c in cols], names=_names(MET))


def _buckets_met(batches: Iterator[pa.RecordBatch], buckets: int, least: int, last: bool) -> Iterator[pa.RecordBatch]:
    """Rows of ``MET`` of blocks that arrive bucket by bucket."""
    now, held = None, []

    def one(cols: tuple[np.ndarray, ...]) -> Iterator[pa.RecordBatch]:
        h, doc, part, x = cols
        later, earlier, frequent, first = met(h, doc, part, x)
        if not last:
            none = np.zeros(len(frequent), np.int64)
            yield from _met_batches([doc[later], part[later], doc[earlier], part[earlier], x[later], x[earlier], np.zeros(len(later), np.int64)])
            yield from _met_batches([doc[frequent], part[frequent], none, none, x[frequent], none - 1, h[frequent].view(np.int64)])
            return
        other = doc[frequent] != doc[first]
        named = np.where((x[frequent] & 31) != LONG, h[frequent].view(np.int64), 0)
        named_of = np.concatenate([np.zeros(len(later), np.int64), named[other]])
        later, earlier = np.concatenate([later, frequent[other]]), np.concatenate([earlier, first[other]])
        i, px, py = seed_places(x[later], x[earlier], least)
        begins = np.arange(len(i)) < np.count_nonzero((x[later] & 31) != LONG)
        named_of, later, earlier = np.where(begins, named_of[i], 0), later[i], earlier[i]
        yield from _met_batches([doc[later], part[later], doc[earlier], part[earlier], px, py, named_of])
        own = frequent[~other & (named != 0)]
        none = np.zeros(len(own), np.int64)
        yield from _met_batches([doc[own], part[own], none, none, x[own] >> 5, none - 1, h[own].view(np.int64)])

    for batch in batches:
        for r in zip(*(batch.column(c).to_pylist() for c in range(6)), strict=True):
            cols = block_seeds(*r, buckets)
            if r[1]:
                h, doc, part, x = cols
                none = np.zeros(len(h), np.int64)
                yield from _met_batches([doc, part, none, none, x, none - 1, h.view(np.int64)])
                continue
            if r[0] != now:
                if held:
                    yield from one(tuple(map(np.concatenate, zip(*held, strict=True))))
                now, held = r[0], []
            held.append(cols)
    if held:
        yield from one(tuple(map(np.concatenate, zip(*held, strict=True))))


def text_chains(doc: np.ndarray, part: np.ndarray, ref: np.ndarray, ref_part: np.ndarray, x: np.ndarray, y: np.ndarray) -> Iterator[tuple]:
    """Rows of ``CHAINS`` of matches, sorted by all columns in this order."""
    pair = np.zeros(len(x), bool)
    for c in (doc, part, ref, ref_part):
        pair[1:] |= c[1:] != c[:-1]
    again = np.append(False, ~pair[1:] & (x[1:] == x[:-1]) & (y[1:] == y[:-1]))[: len(x)]
    group = np.cumsum(pair)
    keep = np.flatnonzero(~again & (np.bincount(group, minlength=1)[group] > 1)) if len(x) else np.zeros(0, np.int64)
    group, x, y = group[keep], x[keep], y[keep]
    # of equal runs, each STEP-th seed and the last
    order = np.lexsort((x, x - y, group))
    g, gx, gd = group[order], x[order], (x - y)[order]
    goes_on = np.zeros(len(order) + 1, bool)
    goes_on[1:-1] = (g[1:] == g[:-1]) & (gd[1:] == gd[:-1]) & (gx[1:] == gx[:-1] + 1)
    place = np.arange(len(order))
    in_run = place - np.maximum.accumulate(np.where(goes_on[:-1], 0, place))
    thin = np.sort(order[(in_run % STEP == 0) | ~goes_on[1:]])
    group, x, y, keep = group[thin], x[thin], y[thin], keep[thin]
    if not len(group):
        return
    edges = np.append(np.append(0, np.flatnonzero(group[1:] != group[:-1]) + 1), len(group))
    wide = x[edges[1:] - 1] - x[edges[:-1]] >= K
    for i, j in zip(edges[:-1][wide].tolist(), edges[1:][wide].tolist(), strict=True):
        xs, ys, at = x[i:j], y[i:j], keep[i]
        for found in chain(xs.tolist(), ys.tolist()):
            cx, cy = xs[found], ys[found]
            if cx[-1] - cx[0] >= K:  # two seeds apart, or as much in a row
                yield int(doc[at]), int(part[at]), int(ref[at]), int(ref_part[at]), int(cx[0]), int(cx[-1]) + K, int(cy[0]), int(cy[-1]) + K, cx.astype("<i4").tobytes(), cy.astype("<i4").tobytes()


def _by_text(batches: Iterator[pa.RecordBatch], names: list[str]) -> Iterator[list[np.ndarray]]:
    """Columns, the first two of which name a text, whole texts at a time."""
    held = []
    for batch in batches:
        cols = [batch.column(n).to_numpy(zero_copy_only=False) for n in names]
        if not len(cols[0]):
            continue
        new = np.flatnonzero((cols[0][1:] != cols[0][:-1]) | (cols[1][1:] != cols[1][:-1])) + 1
        fresh = not held or cols[0][0] != held[-1][0][-1] or cols[1][0] != held[-1][1][-1]
        cut = int(new[-1]) if len(new) else 0
        if held and (fresh or cut):
            held.append([c[:cut] for c in cols])
            yield [np.concatenate(c) for c in zip(*held, strict=True)]
            held = []
        elif cut:
            yield [c[:cut] for c in cols]
        held.append([c[cut:] for c in cols])
    if held:
        yield [np.concatenate(c) for c in zip(*held, strict=True)]


def noted(doc: np.ndarray, part: np.ndarray, x: np.ndarray, h: np.ndarray) -> Iterator[tuple]:
    """Rows of ``CHAINS`` without ref_doc, one for each text: places of frequent pairs (xs) and their hashes (ys)."""
    order = np.lexsort((x, part, doc))
    doc, part, x, h = doc[order], part[order], x[order], h[order]
    edges = np.append(np.flatnonzero(np.append(True, (doc[1:] != doc[:-1]) | (part[1:] != part[:-1]))), len(x)) if len(x) else [0]
    for i, j in zip(edges[:-1], edges[1:], strict=True):
        yield int(doc[i]), int(part[i]), *(None,) * 6, x[i:j].astype("<i4").tobytes(), h[i:j].astype("<i8").tobytes()


def crowded(x: np.ndarray, least: int = LEAST_WORDS) -> np.ndarray:
    """Which of a text's places of frequent pairs (ascending) are in a window of ``least`` words of which they cover a quarter."""
    if not len(x):
        return np.zeros(0, bool)
    covered = np.append(0, np.cumsum(np.minimum(np.diff(x, append=x[-1] + K), K)))
    end = np.searchsorted(x, x + least)
    full = 4 * (covered[end] - covered[:-1]) >= least
    steps = np.zeros(len(x) + 1, np.int64)
    np.add.at(steps, np.flatnonzero(full), 1)
    np.add.at(steps, end[full], -1)
    return np.cumsum(steps[:-1]) > 0


def probes(x: np.ndarray, often: np.ndarray, least: int = LEAST_WORDS) -> np.ndarray:
    """Which of a text's places (ascending, seen so ``often``) must be looked up to meet all who share a quarter of a window of ``least`` words.

    The most frequent places of a window may be left out as long as they cover
    less than that: who shares no others shares too little.
    """
    need = -(-least // 4)
    out = np.zeros(len(x), bool)
    end, at, n = np.searchsorted(x, x + least).tolist(), x.tolist(), (-often).tolist()
    for i in range(len(at)):
        words = 0
        order = sorted(range(i, end[i]), key=n.__getitem__)
        for m, j in enumerate(order):
            words |= ((1 << K) - 1) << at[j] - at[i]
            if words.bit_count() >= need:
                out[order[m:]] = True
                break
    return out


def _rounds(batches: Iterator[pa.RecordBatch], buckets: int, least: int, last: bool) -> Iterator[pa.RecordBatch]:
    """Chains of matches and, but for the last round, blocks of second seeds; rows arrive by their text's hash (text), in no order within it."""
    chain_names, block_names = _names(CHAINS), _names(BLOCKS)
    held: list[tuple[np.ndarray, ...]] = []
    waiting = 0

    def widened(rows: Iterator[tuple], kinds: tuple, names: list[str], most: int) -> Iterator[pa.RecordBatch]:
        for b in _some(rows, kinds, names, most):
            if last:
                yield b
            else:
                none = lambda t: pa.nulls(b.num_rows, t)  # noqa: B023, E731
                yield pa.RecordBatch.from_arrays([*(b.column(n) if n in names else none(t) for n, t in zip(chain_names, _CHAIN_KINDS, strict=True)), *(b.column(n) if n in names else none(t) for n, t in zip(block_names, _BLOCK_KINDS, strict=True))], names=[*chain_names, *block_names])

    def dealt() -> Iterator[pa.RecordBatch]:
        doc, part, x, h = map(np.concatenate, zip(*held, strict=True))
        order = np.lexsort((x, part, doc))
        doc, part, x, h = doc[order], part[order], x[order], h[order]
        new = np.append(True, (doc[1:] != doc[:-1]) | (part[1:] != part[:-1]))
        of, docs, parts = np.cumsum(new) - 1, doc[new], part[new]
        seed, of, code = second_seeds(of, x, h.view(np.uint64), least)
        more = spare(seed)
        yield from widened(blocks(seed[~more], of[~more], code[~more], docs, parts, buckets), _BLOCK_KINDS, block_names, 64)
        if more.any():  # the first text here that has the seed is as good as any
            order = np.argsort(seed, kind="stable")
            g = seed[order]
            place = np.arange(len(g))
            first = np.empty(len(g), np.int64)
            first[order] = order[np.maximum.accumulate(np.where(np.append(True, g[1:] != g[:-1]), place, 0))]
            at = np.flatnonzero(more & ((code & 31) != LONG))
            yield from widened(noted(docs[of[at]], parts[of[at]], code[at] >> 5, seed[at].view(np.int64)), _CHAIN_KINDS, chain_names, 1000)
            at = np.flatnonzero(more & (docs[of] != docs[of[first]]))
            i, px, py = seed_places(code[at], code[first[at]], least)
            a, b = of[at][i], of[first[at]][i]
            order = np.lexsort((py, px, parts[b], docs[b], parts[a], docs[a]))
            yield from widened(text_chains(*(c[order] for c in (docs[a], parts[a], docs[b], parts[b], px, py))), _CHAIN_KINDS, chain_names, 1000)

    for _, _, doc, part, ref, ref_part, x, y, h in _by_text(batches, ["text", "text", *_names(MET)]):
        often = y < 0
        m = np.flatnonzero(~often)
        m = m[np.lexsort(((x[m] << 32) + y[m], ref_part[m], ref[m], part[m], doc[m]))]
        yield from widened(text_chains(doc[m], part[m], ref[m], ref_part[m], x[m], y[m]), _CHAIN_KINDS, chain_names, 1000)
        if last:
            named = h != 0
            yield from widened(noted(doc[named], part[named], x[named], h[named]), _CHAIN_KINDS, chain_names, 1000)
        elif often.any():
            held.append((doc[often], part[often], x[often], h[often]))
            waiting += np.count_nonzero(often)
            if waiting >= BLOCK // 4:
                yield from dealt()
                held.clear()
                waiting = 0
    if held:
        yield from dealt()


def _probing(batches: Iterator[pa.RecordBatch], least: int) -> Iterator[pa.RecordBatch]:
    """(doc_id, part, x, key) of the ``probes`` of rows (doc_id, part, x, often, key) that arrive text by text."""
    for doc, part, x, often, key in _by_text(batches, ["doc_id", "part", "x", "often", "key"]):
        edges = np.append(np.flatnonzero(np.append(True, (doc[1:] != doc[:-1]) | (part[1:] != part[:-1]))), len(doc))
        some = np.concatenate([probes(x[i:j], often[i:j], least) for i, j in zip(edges[:-1], edges[1:], strict=True)])
        yield pa.RecordBatch.from_arrays([pa.array(c[some]) for c in (doc, part, x, key)], names=["doc_id", "part", "x", "key"])


def shared_places(h: np.ndarray, at: np.ndarray, ref_h: np.ndarray, ref_at: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(pair, index, ref index) of all equal hashes within each of many pairs; pair i has ``h[at[i]:at[i + 1]]`` and ``ref_h[ref_at[i]:ref_at[i + 1]]``."""
    pair, ref_pair = (np.repeat(np.arange(len(o) - 1), np.diff(o)) for o in (at, ref_at))
    key, ref_key = (v.view(np.uint64) ^ mix(p.astype(np.uint64)) for v, p in ((h, pair), (ref_h, ref_pair)))
    order = np.argsort(ref_key, kind="stable")
    low, high = (np.searchsorted(ref_key[order], key, side) for side in ("left", "right"))
    n = high - low
    i = np.repeat(np.arange(len(h)), n)
    j = order[np.repeat(low, n) + np.arange(n.sum()) - np.repeat(np.cumsum(n) - n, n)]
    same = (pair[i] == ref_pair[j]) & (h[i] == ref_h[j])  # keys of different pairs may be equal
    return pair[i[same]], i[same], j[same]


def _pair_chains(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Chains of pairs of texts that come with their places (xs, ys) and hashes (hs, ref_hs)."""
    for batch in batches:
        doc, part, ref, ref_part = (batch.column(c).to_numpy() for c in ("doc_id", "part", "ref_doc", "ref_part"))
        (x, at), (h, _), (y, ref_at), (ref_h, _) = ((c.values.to_numpy(), c.offsets.to_numpy()) for c in map(batch.column, ("xs", "hs", "ys", "ref_hs")))

        def rows() -> Iterator[tuple]:
            for i, j in slices(at.astype(np.int64) + ref_at, 1 << 18):  # noqa: B023
                a, b, c, d = at[i], at[j], ref_at[i], ref_at[j]  # noqa: B023
                pair, own, other = shared_places(h[a:b], at[i : j + 1] - a, ref_h[c:d], ref_at[i : j + 1] - c)  # noqa: B023
                px, py = x[a:b][own].astype(np.int64), y[c:d][other].astype(np.int64)  # noqa: B023
                order = np.lexsort((py, px, pair))
                pair = pair[order] + i
                yield from text_chains(doc[pair], part[pair], ref[pair], ref_part[pair], px[order], py[order])  # noqa: B023

        yield from _some(rows(), _CHAIN_KINDS, _names(CHAINS), 1000)


def surroundings(words: np.ndarray, places: np.ndarray, reach: int, most: int = LEAST_WORDS) -> tuple[np.ndarray, int]:
    """(16-bit hashes, lost) of the words within ``reach`` of places; repetitions are numbered, those after ``most`` left out.

    Of these words, two texts have no more in common than they have hashes in
    common and one of them has lost to equal hashes, or else ``most`` or more.
    """
    steps = np.zeros(len(words) + 1, np.int64)
    np.add.at(steps, np.maximum(places - reach, 0), 1)
    np.add.at(steps, np.minimum(places + K + reach, len(words)), -1)
    w = np.sort(words[np.cumsum(steps[:-1]) > 0])
    at = np.arange(len(w))
    nth = at - np.maximum.accumulate(np.where(np.append(True, w[1:] != w[:-1])[: len(w)], at, 0))
    w, nth = w[nth < most], nth[nth < most]
    hashes = np.unique((mix(w.astype(np.uint64) ^ mix(nth.astype(np.uint64))) >> np.uint64(48)).astype(np.uint16))
    return hashes.view(np.int16), len(w) - len(hashes)


def word_counts(data: np.ndarray, offsets: np.ndarray) -> np.ndarray:
    """Words of each document at ``offsets`` in ``data``."""
    word = ~WHITE[data]
    start = word.copy()
    start[1:] &= ~word[:-1]
    inner = offsets[1:-1][offsets[1:-1] < len(data)]
    start[inner] = word[inner]
    sums = np.append(0, np.cumsum(start))
    return sums[offsets[1:]] - sums[offsets[:-1]]


def repeated_passages(docs: DataFrame, least_words: int = LEAST_WORDS, similarity: float = SIMILARITY, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Passages of documents that an earlier document (by id) also has, exactly or nearly.

    Returns doc_id, text_key, ref_doc_id, start_word, end_word, ref_start,
    ref_end, matched, similarity, whole_copy. Words are ``[^\\x20\\x09-\\x0D]+``,
    A-Z lower-cased. A passage has ``least_words`` words or more, of which the
    share ``similarity`` (of the longer side) match in order; one that a few
    earlier documents have has a row for each. A copy of a whole text gives one
    row over all its words; its passages are those of the first row with that
    text. Passages repeated within one document only are no matter; texts under
    one id are one document, and text_key tells them apart. Null and short
    texts give nothing; null ids count as the earliest; rows repeated under one
    id count once; an empty table gives an empty result.
    """
    spark = docs.sparkSession
    texts = doc_texts(docs, id_col, text_col).withColumn("doc_id", F.coalesce("doc_id", F.lit(_NULL_ID)))

    parts = max(int(spark.conf.get("spark.sql.shuffle.partitions")), 1)
    buckets = 2 * parts

    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            data, offsets = string_buffers(batch.column(1))
            for i, j in slices(offsets):
                raw, off = data[offsets[i] : offsets[j]], offsets[i : j + 1] - offsets[i]
                view = memoryview(raw)
                digests = [hashlib.sha256(view[a:b]).digest() for a, b in zip(off[:-1].tolist(), off[1:].tolist(), strict=True)]
                keys = [int.from_bytes(d[:8], "big") >> 4 for d in digests]
                yield pa.RecordBatch.from_arrays([batch.column(0).slice(i, j - i), pa.array(digests, pa.binary()), pa.array(keys, pa.int64()), pa.array(word_counts(raw, off))], names=["doc_id", "tid", "part", "n_words"])

    def deal(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, ids, known, waiting, nth = [], [], {}, 0, 0

        def dealt() -> Iterator[pa.RecordBatch]:
            h, sizes = np.concatenate(held), np.array([len(s) for s in held])
            of = np.repeat(np.arange(len(sizes)), sizes)
            x = np.arange(len(h)) - np.repeat(np.cumsum(sizes) - sizes, sizes)
            docs, keys = np.array(ids, np.int64), np.array(list(known), np.int64)
            more = spare(h)
            if more.any():  # known to be frequent; any bucket may pass them on
                yield _table([_block((abs(ids[0]) + nth) % buckets, True, h[more], of[more], x[more], docs, keys)], _BLOCK_KINDS, _names(BLOCKS))
            yield from _some(blocks(h[~more], of[~more], x[~more], docs, keys, buckets), _BLOCK_KINDS, _names(BLOCKS), 64)

        for batch in batches:
            for first, w in batch_words(batch.column(1)):
                raw = memoryview(w.data)
                for i, doc in enumerate(batch.column(0).slice(first, len(w.ptr) - 1).to_pylist()):
                    text = w.hashes[w.ptr[i] : w.ptr[i + 1]]
                    if len(text) < K:
                        continue
                    key = text_key(raw[w.offsets[i] : w.offsets[i + 1]])
                    if key in known:
                        ids[known[key]] = min(ids[known[key]], doc)
                        continue
                    known[key] = len(ids)
                    ids.append(doc)
                    held.append(seeds(text))
                    waiting += len(text)
                if waiting >= BLOCK:
                    yield from dealt()
                    held, ids, known, waiting, nth = [], [], {}, 0, nth + 1
        if ids:
            yield from dealt()

    def in_buckets(frame: DataFrame) -> DataFrame:
        return frame.repartitionById(parts, F.col("bucket") % F.lit(parts)).sortWithinPartitions("bucket")

    def in_texts(frame: DataFrame) -> DataFrame:
        # one long is sorted by its digits; the rest of the order is made text by text
        return frame.repartition(parts, "doc_id", "part").withColumn("text", F.xxhash64("doc_id", "part")).sortWithinPartitions("text")

    keys = staged(texts.mapInArrow(scan, "doc_id long, tid binary, part long, n_words long"), "texts")
    first = staged(keys.groupBy("tid").agg(F.min("doc_id").alias("doc_id"), F.first("part").alias("part")), "firsts")
    round_1 = in_texts(in_buckets(texts.mapInArrow(deal, BLOCKS)).mapInArrow(lambda b: _buckets_met(b, buckets, least_words, False), MET))
    round_1 = staged(round_1.mapInArrow(lambda b: _rounds(b, buckets, least_words, False), f"{CHAINS}, {BLOCKS}"), "round")
    round_2 = in_texts(in_buckets(round_1.where("bucket is not null").select(*_names(BLOCKS))).mapInArrow(lambda b: _buckets_met(b, buckets, least_words, True), MET))
    chained = round_2.mapInArrow(lambda b: _rounds(b, buckets, least_words, True), CHAINS).union(round_1.where("bucket is null").select(*_names(CHAINS)))
    # copies of a whole text are linked as such
    chained = staged(chained.join(first.select("doc_id", "part").hint("shuffle_merge"), ["doc_id", "part"], "left_semi").distinct(), "chains")
    chained, places = chained.where("ref_doc is not null"), chained.where("ref_doc is null")

    def as_words(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for i, w in batch_words(batch.column("text")):
                n = len(w.ptr) - 1
                words = [(w.hashes[a:b] >> np.uint64(32)).astype("<u4").tobytes() for a, b in zip(w.ptr[:-1], w.ptr[1:], strict=True)]
                yield pa.RecordBatch.from_arrays([*(batch.column(c).slice(i, n) for c in ("doc_id", "part")), pa.array(words, pa.binary())], names=["doc_id", "part", "words"])

    def with_words(wanted: DataFrame) -> DataFrame:
        """Words of the texts named: only these are read again; how many they are has no bound."""
        named = texts.withColumn("part", text_key_of(F.col("text"))).join(wanted.hint("shuffle_merge"), ["doc_id", "part"])
        return staged(named.select("doc_id", "part", "text").mapInArrow(as_words, "doc_id long, part long, words binary").dropDuplicates(["doc_id", "part"]), "words")

    names = _names(CHAINS)

    def aligned(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """Passages; chains that need more of a text than is there come out as they are, without a start."""
        for batch in batches:
            if not batch.num_rows:
                continue
            before, after, ref_before, ref_after = (batch.column(c).to_numpy() for c in ("before", "after", "ref_before", "ref_after"))
            (x, at), (y, _), (a, a_at), (b, b_at) = ((raw.view("<i4" if c in "xsys" else "<u4"), o // 4) for c in ("xs", "ys", "slice", "ref_slice") for raw, o in [string_buffers(batch.column(c))])
            n = np.diff(at)
            start, end, ref_start, ref_end, same, unknown = align_all(a, a_at, b, b_at, x - np.repeat(before, n), y - np.repeat(ref_before, n), at, before, after, ref_before, ref_after)
            share = same / np.maximum(end - start, ref_end - ref_start)
            some = np.flatnonzero(unknown | (end - start >= least_words) & (share >= similarity))
            unknown, row = unknown[some], batch.take(pa.array(some))
            found = (start + before, end + before, ref_start + ref_before, ref_end + ref_before, same, share)
            seeds_of = [pc.if_else(pa.array(unknown), row.column(c), pa.scalar(None, pa.binary())) for c in ("xs", "ys")]
            yield pa.RecordBatch.from_arrays([*(row.column(c) for c in names[:8]), *seeds_of, *(pa.array(v[some], mask=unknown) for v in found)], names=_names(ALIGNED))

    def tried(chains: DataFrame, sequences: DataFrame, margin: int) -> DataFrame:
        """Chains aligned over slices with so many words beside them; the slices are cut where the words are joined."""

        def cut(frame: DataFrame, axis: str, words: str, name: str, ref: str) -> DataFrame:
            size = f"octet_length({words}) div 4"
            frame = frame.withColumns({f"{ref}before": F.expr(f"greatest(0L, {axis}_from - {margin}L)"), f"{ref}after": F.expr(f"greatest(0L, {size} - {axis}_to - {margin}L)")})
            # positions within an array fit an int
            begin, n = f"cast(4 * {ref}before + 1 as int)", f"cast(4 * ({size} - {ref}before - {ref}after) as int)"
            return frame.withColumn(name, F.expr(f"substring({words}, {begin}, {n})")).drop(words)

        own = cut(chains.join(sequences.hint("shuffle_merge"), ["doc_id", "part"]), "x", "words", "slice", "")
        refs = sequences.toDF("ref_doc", "ref_part", "ref_words")
        both = cut(own.join(refs.hint("shuffle_merge"), ["ref_doc", "ref_part"]), "y", "ref_words", "ref_slice", "ref_")
        return both.select(*names, "before", "after", "slice", "ref_before", "ref_after", "ref_slice").mapInArrow(aligned, ALIGNED)

    def found_by(chains: DataFrame, sequences: DataFrame) -> DataFrame:
        near = staged(tried(chains, sequences, MARGIN), "aligned")
        return near.where("start_word is not null").union(tried(near.where("start_word is null").select(*names), sequences, 1 << 31))

    def crowded_places(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple]:
        for batch in batches:
            for doc, part, xs, hs, spans in zip(*batch.to_pydict().values(), strict=True):
                x = np.concatenate([np.frombuffer(v, "<i4") for v in xs])
                x, at = np.unique(x, return_index=True)
                h = np.concatenate([np.frombuffer(v, "<i8") for v in hs])[at]
                some = crowded(x, least_words)
                x, h = x[some], h[some]
                bare = np.ones(len(x), bool)
                for span in spans or []:
                    bare[np.searchsorted(x, span["start_word"]) : np.searchsorted(x, span["end_word"])] = False
                bare[bare] = crowded(x[bare], least_words)
                if len(x):
                    yield doc, part, x, h, bare

    def left_over(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """Crowded places of frequent pairs, text by text; whether no passage covers them."""
        kinds = (pa.int64(), pa.int64(), pa.list_(pa.int32()), pa.list_(pa.int64()), pa.list_(pa.bool_()))
        yield from _some(crowded_places(batches), kinds, ["doc_id", "part", "xs", "hs", "bares"], 1000)

    # where a passage is no longer than this, all of it lies around each of its places
    reach = 5 * least_words // 4
    ref_reach = int(min(reach / max(similarity, 1e-6), 1 << 30))
    need = math.ceil(similarity * least_words - 1e-9)

    def surrounded(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """Words around the places of each key of a text."""
        kinds = (pa.int64(), pa.int64(), pa.int64(), pa.bool_(), pa.list_(pa.int16()), pa.int32())

        def rows(batch: pa.RecordBatch) -> Iterator[tuple]:
            for doc, part, sought, words in zip(*(batch.column(c) for c in ("doc_id", "part", "keys", "words")), strict=True):
                w = np.frombuffer(words.as_buffer(), "<u4")
                for key in sought.as_py():
                    places = np.array(key["places"], np.int64)
                    yield doc.as_py(), part.as_py(), key["key"], key["probing"], *surroundings(w, places, reach if key["probing"] else ref_reach, least_words)

        for batch in batches:
            yield from _some(rows(batch), kinds, ["doc_id", "part", "key", "probing", "around", "lost"], 1 << 12)

    words = with_words(chained.select("doc_id", "part").union(chained.select("ref_doc", "ref_part")).union(places.select("doc_id", "part")).distinct())
    passages = staged(found_by(chained, words), "passages")
    # what no passage covers though it is full of frequent pairs meets every earlier text that shares enough of them
    spans = passages.groupBy("doc_id", "part").agg(F.collect_set(F.struct("start_word", "end_word")).alias("spans"))
    by_text = places.groupBy("doc_id", "part").agg(F.collect_list("xs").alias("xs"), F.collect_list("ys").alias("hs")).join(spans.hint("shuffle_merge"), ["doc_id", "part"], "left")
    rest = staged(by_text.select("doc_id", "part", "xs", "hs", "spans").mapInArrow(left_over, "doc_id long, part long, xs array<int>, hs array<long>, bares array<boolean>"), "rest")
    by_place = rest.select("doc_id", "part", F.expr("inline(arrays_zip(xs, hs, bares))")).selectExpr("doc_id", "part", "cast(xs as long) x", "hs h", "bares bare")
    bare = by_place.where("bare").drop("bare")
    if not bare.isEmpty():
        # pairs that begin within some words of each other in the first text that has them are one key
        holders = by_place.groupBy("h", "doc_id", "part").agg(F.max("bare").alias("bare"), F.min("x").alias("x"))
        often = holders.groupBy("h").agg(F.count(F.lit(1)).alias("often"), F.max("bare").alias("bare"), F.min(F.struct("doc_id", "part", "x")).alias("first"))
        often = staged(often.where("bare and often > 1").select("h", "often", F.col("first.doc_id").alias("first"), F.xxhash64("first.doc_id", "first.part", F.expr(f"first.x div {KEY_WORDS}")).alias("key")), "often")
        counted = bare.join(often, "h").where("first < doc_id").repartition(parts, "doc_id", "part").sortWithinPartitions("doc_id", "part", "x")
        probe = staged(counted.select("doc_id", "part", "x", "often", "key").mapInArrow(lambda b: _probing(b, least_words), "doc_id long, part long, x long, key long"), "probes")
        # of the others only those matter that are earlier than a probe
        latest = probe.groupBy("key").agg(F.max("doc_id").alias("latest"))
        sought = by_place.join(often.join(latest, "key"), "h").where("doc_id < latest").select("doc_id", "part", "x", "key")
        keyed = probe.withColumn("probing", F.lit(True)).union(sought.withColumn("probing", F.lit(False))).groupBy("doc_id", "part", "key", "probing").agg(F.collect_set(F.col("x").cast("int")).alias("places"))
        keyed = staged(keyed.groupBy("doc_id", "part").agg(F.collect_list(F.struct("key", "probing", "places")).alias("keys")), "keyed")
        sequences = staged(words.join(keyed.select("doc_id", "part").hint("shuffle_merge"), ["doc_id", "part"], "left_semi"), "sequences")
        around = keyed.join(sequences.hint("shuffle_merge"), ["doc_id", "part"]).select("doc_id", "part", "keys", "words")
        around = staged(around.mapInArrow(surrounded, "doc_id long, part long, key long, probing boolean, around array<smallint>, lost int"), "around")
        # who shares a key but too few of the words around it has no passage there
        earlier = around.where("not probing").select("key", F.col("doc_id").alias("ref_doc"), F.col("part").alias("ref_part"), F.col("around").alias("ref_around"))
        alike = f"ref_doc < doc_id and ref_part <> part and size(array_intersect(around, ref_around)) + lost >= {need}"
        both = staged(around.where("probing").join(earlier, "key").where(alike).select("doc_id", "part", "ref_doc", "ref_part").distinct(), "both")
        # a row for each pair of texts: their places come as arrays
        own = rest.where("exists(bares, b -> b)").select("doc_id", "part", *(F.expr(f"transform(filter(arrays_zip({c}, bares), p -> p.bares), p -> p.{c})").alias(c) for c in ("xs", "hs")))
        ref = rest.select(F.col("doc_id").alias("ref_doc"), F.col("part").alias("ref_part"), F.col("xs").alias("ys"), F.col("hs").alias("ref_hs"))
        pairs = both.join(own.hint("shuffle_merge"), ["doc_id", "part"]).join(ref.hint("shuffle_merge"), ["ref_doc", "ref_part"])
        more = pairs.select("doc_id", "part", "ref_doc", "ref_part", "xs", "hs", "ys", "ref_hs").mapInArrow(_pair_chains, CHAINS)
        passages = passages.union(found_by(staged(more, "more-chains"), sequences))
    fuzzy = passages.withColumnsRenamed({"ref_doc": "ref_doc_id", "part": "text_key"}).select(*_names(PASSAGES)).distinct().withColumn("whole_copy", F.lit(False))
    copies = keys.where(F.col("n_words") >= least_words).distinct().join(first.select("tid", F.col("doc_id").alias("ref_doc_id")), "tid").where("doc_id <> ref_doc_id")
    n = F.col("n_words")
    whole = copies.select("doc_id", F.col("part").alias("text_key"), "ref_doc_id", F.lit(0).cast("long").alias("start_word"), n.alias("end_word"), F.lit(0).cast("long").alias("ref_start"), n.alias("ref_end"), n.alias("matched"), F.lit(1.0).alias("similarity"), F.lit(True).alias("whole_copy"))
    out = fuzzy.union(whole)
    return out.withColumns({c: F.when(F.col(c) != _NULL_ID, F.col(c)) for c in ("doc_id", "ref_doc_id")})


def without_repeats(docs: DataFrame, passages: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``docs`` with the passages cut out of their later documents; the columns stay as they are.

    Cut from the first byte of a passage's first word to the end of its last;
    n_chars, where there is one, is counted anew. Of several texts under one id
    each loses its own passages. Rows without passages are unchanged, rows all
    of whose words go keep what white space is left.
    """
    doc_key, key, spans = (free_name(n, docs) for n in ("doc_key", "text_key", "spans"))
    found = passages.groupBy(F.coalesce("doc_id", F.lit(_NULL_ID)).alias(doc_key), F.col("text_key").alias(key)).agg(F.collect_set(F.struct("start_word", "end_word")).alias(spans))

    @F.pandas_udf("string")
    def cut(text: pd.Series, spans: pd.Series) -> pd.Series:
        return pd.Series([t if s is None else _cut(t or "", s) for t, s in zip(text, spans, strict=True)], dtype=object)

    text = F.col(f"`{text_col}`")
    keyed = docs.withColumns({doc_key: F.coalesce(F.col(f"`{id_col}`").cast("long"), F.lit(_NULL_ID)), key: text_key_of(F.coalesce(text.cast("string"), F.lit("")))})
    out = keyed.join(found, [doc_key, key], "left").withColumn(text_col, cut(text, F.col(spans)))
    if "n_chars" in docs.columns:
        out = out.withColumn("n_chars", F.when(F.col(spans).isNull(), F.col("n_chars")).otherwise(F.length(text).cast(dict(docs.dtypes)["n_chars"])))
    return out.select(*[f"`{c}`" for c in docs.columns])


def _cut(text: str, spans: list) -> str:
    raw = text.encode()
    w = words_of(np.frombuffer(raw, np.uint8), np.array([0, len(raw)]), WHITE)
    keep, at = [], 0
    for b, e in sorted((p["start_word"], p["end_word"]) for p in spans):
        e = min(e, len(w.begin))
        if b < e:
            begin, end = int(w.begin[b]), int(w.end[e - 1])
            keep.append(raw[at : max(at, begin)])
            at = max(at, end)
    return b"".join([*keep, raw[at:]]).decode()
