"""Near duplicates: MinHash bands, sequential Bayesian verification, exact confirmation.

1. An Arrow pass makes each document's shingle set, its digest and, once for
   each distinct set, a signature. From here on distinct sets are the vertices,
   so exact copies, however many, cost nothing more.
2. Bands of signature rows are bucketed. In each bucket every set is compared
   with the bucket's least one: as many pairs as rows.
3. A pair's signatures are compared in batches. After each batch the posterior
   of the similarity is a Beta distribution; the pair is dropped when reaching
   the threshold is less likely than ``miss``. Survivors are confirmed on the
   full sets.
4. Buckets whose sets are not all connected by then are finished. In small
   ones each set outside the largest component is compared with all sets of
   other components. Sets of crowded ones go through an exact prefix join: in
   order of their rarity, a similar pair's first common shingle is among the
   first fifth of the larger set and the first ninth of the smaller one, so
   sets that only share a frequent passage never meet; parity bitmaps bound
   from below in how many shingles two sets differ.
So no pair of a bucket that could change the result is left out.
"""

from __future__ import annotations

import functools
import hashlib
import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from buildlake.llm.common import doc_texts, free_name, staged, text_key, text_key_of
from buildlake.llm.components import components
from buildlake.llm.words import WHITE, batch_words, mix, shingles, string_buffers, words_of

BANDS, ROWS = 32, 5
"""A pair of similarity 0.8 shares no band with probability (1 - 0.8 ** 5) ** 32 = 3e-6."""
BATCH = 32
MISS = 1e-6
"""Chance, at most, that a batch drops a pair at the threshold."""

CROWDED = 16
"""Rows of a bucket from which on the prefix join takes the place of comparing pairs."""

BITMAP = 8
"""64-bit words of a parity bitmap."""

_NULL_ID = -1 << 63
_U = np.uint64
_rng = np.random.default_rng(20240601)
_SLOPES = _rng.integers(1, 1 << 63, BANDS * ROWS, dtype=_U) * _U(2) + _U(1)
_SHIFTS = _rng.integers(0, 1 << 63, BANDS * ROWS, dtype=_U)


def shingle_set(hashes: np.ndarray, k: int) -> np.ndarray:
    """Sorted distinct shingles of a document's word hashes."""
    s = np.sort(shingles(hashes, k))
    return s[np.concatenate([[True], s[1:] != s[:-1]])] if len(s) else s


def set_digest(shingle: np.ndarray) -> bytes:
    return hashlib.blake2b(shingle.tobytes(), digest_size=16).digest()


def signature(shingle: np.ndarray) -> np.ndarray:
    """Least upper half of each permuted shingle, 32 bits each."""
    out = np.full(len(_SLOPES), 0xFFFFFFFF, dtype=np.uint32)
    for at in range(0, len(shingle), 1024):
        part = shingle[at : at + 1024]
        permuted = (part[None, :] * _SLOPES[:, None] + _SHIFTS[:, None]) >> _U(32)
        np.minimum(out, permuted.min(axis=1).astype(np.uint32), out=out)
    return out


def band_hashes(sig: np.ndarray) -> np.ndarray:
    h = np.arange(BANDS, dtype=_U) + _U(1)
    for column in sig.astype(_U).reshape(BANDS, ROWS).T:
        h = mix(h * _U(0x9E3779B97F4A7C15) + column)
    return h.view(np.int64)


@functools.lru_cache(maxsize=8)
def least_matches(threshold: float, miss: float) -> tuple[int, ...]:
    """By batch: matches that a pair needs so far, else P(similarity >= threshold) < miss.

    With a uniform prior the posterior after m of n matches is Beta(m + 1,
    n - m + 1), whose upper tail at t is P(Binomial(n + 1, t) <= m).
    """
    out = []
    for n in range(BATCH, len(_SLOPES) + 1, BATCH):
        tail, m = 0.0, -1
        while tail < miss:
            m += 1
            tail += math.comb(n + 1, m) * threshold**m * (1 - threshold) ** (n + 1 - m)
        out.append(m)
    return tuple(out)


def plausible(a: np.ndarray, b: np.ndarray, threshold: float, miss: float) -> np.ndarray:
    """Which rows of two signature matrices survive every batch."""
    alive = np.arange(len(a))
    matches = np.zeros(len(a), dtype=np.int64)
    for k, need in enumerate(least_matches(threshold, miss)):
        part = slice(k * BATCH, (k + 1) * BATCH)
        matches = matches + (a[alive, part] == b[alive, part]).sum(axis=1)
        keep = matches >= need
        alive, matches = alive[keep], matches[keep]
    return alive


def _sets(docs: DataFrame, k: int) -> DataFrame:
    """(doc_id, text_key, set_id, n_shingles, sig) of each row; sig only for a set's first row in a slice of a batch."""

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for first, w in batch_words(batch.column(1)):
                raw, keys, ids, sizes, sigs, seen = memoryview(w.data), [], [], [], [], set()
                for i in range(len(w.ptr) - 1):
                    s = shingle_set(w.hashes[w.ptr[i] : w.ptr[i + 1]], k)
                    digest = set_digest(s) if len(s) else None
                    keys.append(text_key(raw[w.offsets[i] : w.offsets[i + 1]]))
                    ids.append(digest)
                    sizes.append(len(s))
                    sigs.append(None if digest is None or digest in seen else signature(s).tobytes())
                    seen.add(digest)
                yield pa.RecordBatch.from_arrays([batch.column(0).slice(first, len(ids)), pa.array(keys, pa.int64()), pa.array(ids, pa.binary()), pa.array(sizes, pa.int64()), pa.array(sigs, pa.binary())], names=["doc_id", "text_key", "set_id", "n_shingles", "sig"])

    return docs.mapInArrow(work, "doc_id long, text_key long, set_id binary, n_shingles long, sig binary")


def _buckets(signed: DataFrame) -> DataFrame:
    """(bucket, set_id, leader) of the buckets with two sets or more."""

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            sig = string_buffers(batch.column(1))[0].view(np.uint32).reshape(batch.num_rows, -1)
            hashes = np.concatenate([band_hashes(s) for s in sig]) if batch.num_rows else np.zeros(0, np.int64)
            yield pa.RecordBatch.from_arrays([pa.array(hashes), batch.column(0).take(pa.array(np.repeat(np.arange(batch.num_rows), BANDS)))], names=["bucket", "set_id"])

    banded = signed.select("set_id", "sig").mapInArrow(work, "bucket long, set_id binary")
    shared = banded.groupBy("bucket").agg(F.min("set_id").alias("leader"), F.max("set_id").alias("most")).where("leader < most").drop("most")
    # written first: a crowded bucket is many rows of a join with two plain sides, which can be split at run time
    return staged(banded.join(staged(shared, "shared"), "bucket"), "buckets")


def _keyed(docs: DataFrame) -> DataFrame:
    return docs.select(F.coalesce("doc_id", F.lit(_NULL_ID)).alias("key"), text_key_of(F.col("text")).alias("text_key"), "text")


def _confirmed(pairs: DataFrame, signed: DataFrame, first_row: DataFrame, docs: DataFrame, k: int, percent: int, miss: float) -> DataFrame:
    """Pairs (a, b) of set ids whose full sets have 100 * intersection >= percent * union."""
    threshold = percent / 100

    def sift(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            left, right = (string_buffers(batch.column(c))[0].view(np.uint32).reshape(batch.num_rows, -1) for c in ("sig_a", "sig_b"))
            yield batch.select(["a", "b"]).take(pa.array(plausible(left, right, threshold, miss)))

    def confirm(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        @functools.lru_cache(maxsize=64)
        def of(text: str) -> np.ndarray:
            raw = np.frombuffer(text.encode(), np.uint8)
            return shingle_set(words_of(raw, np.array([0, len(raw)]), WHITE).hashes, k)

        for batch in batches:
            keep = []
            for i, (x, y) in enumerate(zip(batch.column("text_a"), batch.column("text_b"), strict=True)):
                left, right = of(x.as_py()), of(y.as_py())
                common = len(left) + len(right) - len(np.union1d(left, right))
                if 100 * common >= percent * (len(left) + len(right) - common):
                    keep.append(i)
            yield batch.select(["a", "b"]).take(pa.array(keep, pa.int64()))

    sig = signed.select(F.col("set_id").alias("a"), F.col("sig").alias("sig_a"), F.col("n_shingles").alias("n_a"))
    both = pairs.join(sig, "a").join(sig.toDF("b", "sig_b", "n_b"), "b")
    # sets of too different a size can't reach the threshold
    both = both.where(100 * F.least("n_a", "n_b") >= percent * F.greatest("n_a", "n_b")).select("a", "b", "sig_a", "sig_b")
    likely = staged(both.mapInArrow(sift, "a binary, b binary"), "likely")
    needed = likely.select(F.col("a").alias("set_id")).union(likely.select("b")).distinct()
    rows = needed.join(first_row, "set_id")
    texts = staged(_keyed(docs).join(rows, ["key", "text_key"]).select("set_id", "text").dropDuplicates(["set_id"]), "texts")
    joined = likely.join(texts.toDF("b", "text_b"), "b").join(texts.toDF("a", "text_a"), "a").select("a", "b", "text_a", "text_b")
    return staged(joined.mapInArrow(confirm, "a binary, b binary").distinct(), "confirmed")


def parity_bitmap(shingle: np.ndarray) -> np.ndarray:
    """Bits that an odd number of shingles hash to: two sets differ in as many shingles, at least, as their bitmaps in bits."""
    bits = np.bincount((shingle >> _U(7)).astype(np.int64) % (64 * BITMAP), minlength=64 * BITMAP) & 1
    return np.packbits(bits.astype(np.uint8)).view("<i8")


def _prefix_pairs(sets: DataFrame, first_row: DataFrame, docs: DataFrame, k: int, percent: int) -> DataFrame:
    """Pairs (a, b) of ``sets`` (set_id, component, n) in different components that may be similar: none is missed."""
    maps = [f"m{i}" for i in range(BITMAP)]

    def pack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for first, w in batch_words(batch.column("text")):
                part, held, bits = batch.slice(first, len(w.ptr) - 1), [], []
                for i in range(part.num_rows):
                    s = shingle_set(w.hashes[w.ptr[i] : w.ptr[i + 1]], k)
                    held.append(s.tobytes())
                    bits.append(parity_bitmap(s))
                columns = [pa.array(c) for c in np.array(bits).reshape(-1, BITMAP).T.copy()]
                yield pa.RecordBatch.from_arrays([*(part.column(c) for c in ("set_id", "component", "n")), pa.array(held, pa.binary()), *columns], names=["set_id", "component", "n", "tokens", *maps])

    def unpack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for i in range(0, batch.num_rows, 256):
                part = batch.slice(i, 256)
                raw, offsets = string_buffers(part.column("tokens"))
                rep = pa.array(np.repeat(np.arange(part.num_rows), np.diff(offsets) // 8))
                yield pa.RecordBatch.from_arrays([pa.array(raw.view(np.int64)), *(part.column(c).take(rep) for c in ("set_id", "component", "n"))], names=["token", "set_id", "component", "n"])

    kinds = "set_id binary, component binary, n long"
    rows = _keyed(docs).join(sets.join(first_row, "set_id"), ["key", "text_key"]).select("set_id", "component", "n", "text")
    packed = rows.mapInArrow(pack, f"{kinds}, tokens binary, {', '.join(f'{m} long' for m in maps)}")
    held = staged(packed.dropDuplicates(["set_id"]), "tokens")
    tokens = held.select("set_id", "component", "n", "tokens").mapInArrow(unpack, f"token long, {kinds}")
    # written before it is joined: a token that a whole crowd holds is many rows of a join with two plain sides
    often = staged(tokens.groupBy("token").agg(F.count(F.lit(1)).alias("df")).where("df > 1"), "often")
    one = Window.partitionBy("set_id")
    # shingles of one set alone come first in its order; only their number matters
    ranked = tokens.join(often, "token").withColumn("pos", F.col("n") - F.count(F.lit(1)).over(one) + F.row_number().over(one.orderBy("df", "token")))
    probe = ranked.where(F.col("pos") <= F.col("n") - F.expr(f"({percent} * n + 99) div 100") + 1).drop("df").join(held.select("set_id", *maps), "set_id")
    index = probe.where(F.col("pos") <= F.col("n") - F.expr(f"({2 * percent} * n + {99 + percent}) div {100 + percent}") + 1)
    x, y = (d.select("token", F.col("set_id").alias(s), *[F.col(c).alias(f"{c}_{s}") for c in ("component", "n", "pos", *maps)]) for d, s in ((probe, "a"), (index, "b")))
    differ = " + ".join(f"bit_count({m}_a ^ {m}_b)" for m in maps)
    smaller = "component_a <> component_b and (n_b < n_a or n_b = n_a and b < a) and 100 * n_b >= {p} * n_a"
    reach = "{q} * (1 + least(n_a - pos_a, n_b - pos_b)) >= {p} * (n_a + n_b) and {q} * (n_a + n_b - ({differ})) >= 2 * {p} * (n_a + n_b)"
    met = x.join(y, "token").where(f"{smaller} and {reach}".format(p=percent, q=100 + percent, differ=differ))
    return met.select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b")).distinct()


def _classified(docs: DataFrame, k: int, percent: int, miss: float) -> tuple[DataFrame, DataFrame]:
    """(doc_id, text_key, n_shingles, set_id) of each row, and (set_id, component, component_id, links) of each set."""
    rows = staged(_sets(docs, k), "sets")
    per_set = rows.where("set_id is not null").groupBy("set_id")
    signed = rows.where("sig is not null").groupBy("set_id").agg(F.min("sig").alias("sig"), F.max("n_shingles").alias("n_shingles"))
    signed = staged(signed, "signatures")
    first_row = per_set.agg(F.min(F.struct(F.coalesce("doc_id", F.lit(_NULL_ID)).alias("key"), "text_key")).alias("row"), F.min("doc_id").alias("least"))
    first_row = staged(first_row.select("set_id", "row.*", "least"), "first-rows")
    named = first_row.drop("least")
    buckets = _buckets(signed)

    confirm = functools.partial(_confirmed, signed=signed, first_row=named, docs=docs, k=k, percent=percent, miss=miss)
    found = confirm(buckets.where("set_id <> leader").select(F.col("leader").alias("a"), F.col("set_id").alias("b")).distinct())
    parts = staged(components(found).toDF("set_id", "component"), "components")

    # what the leaders left apart
    placed = buckets.join(parts, "set_id", "left").withColumn("component", F.coalesce("component", "set_id"))
    apart = placed.groupBy("bucket").agg(F.min("component").alias("lo"), F.max("component").alias("hi"), F.count(F.lit(1)).alias("size")).where("lo < hi").select("bucket", "size")
    open_rows = staged(placed.join(staged(apart, "apart"), "bucket"), "open")
    few = open_rows.where(F.col("size") < CROWDED)
    sizes = few.groupBy("bucket", "component").agg(F.count(F.lit(1)).alias("n"))
    main = sizes.groupBy("bucket").agg(F.max_by("component", F.struct("n", "component")).alias("main"))
    outside = few.join(main, "bucket").where("component <> main").select("bucket", F.col("set_id").alias("a"), F.col("component").alias("of_a"), "main", "leader")
    inside = few.select("bucket", F.col("set_id").alias("b"), F.col("component").alias("of_b"))
    rest = outside.join(inside, "bucket").where("of_a <> of_b and (of_b = main or a < b) and a <> leader and b <> leader")
    rest = rest.select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b")).distinct()
    crowd = open_rows.where(F.col("size") >= CROWDED).select("set_id", "component").distinct()
    crowd = crowd.join(signed.select("set_id", F.col("n_shingles").alias("n")), "set_id")
    more = confirm(rest.union(_prefix_pairs(crowd, named, docs, k, percent)).distinct())
    # links between components join these, and with them their sets
    ends = (parts.toDF("a", "of_a"), parts.toDF("b", "of_b"))
    joined = more.join(ends[0], "a", "left").join(ends[1], "b", "left").select(F.coalesce("of_a", "a").alias("a"), F.coalesce("of_b", "b").alias("b"))
    groups = staged(components(joined).toDF("component", "group"), "groups")

    links = found.union(more)
    ends = links.select(F.col("a").alias("set_id")).union(links.select("b"))
    degree = ends.groupBy("set_id").agg(F.count(F.lit(1)).alias("links"))
    members = first_row.select("set_id", "least").join(parts, "set_id", "left").withColumn("component", F.coalesce("component", "set_id"))
    members = staged(members.join(groups, "component", "left").withColumn("component", F.coalesce("group", "component")).drop("group"), "members")
    # written before they are joined: one component may hold a third of all sets, one set a third of all rows
    least = staged(members.groupBy("component").agg(F.min("least").alias("component_id")), "least-ids")
    known = members.select("set_id", "component").join(least, "component").join(degree, "set_id", "left")
    return rows.drop("sig"), staged(known.select("set_id", "component", "component_id", F.coalesce("links", F.lit(0)).alias("links")), "known")


def near_duplicates(docs: DataFrame, k: int = 5, percent: int = 80, miss: float = MISS, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """doc_id, n_shingles, component_id, kept, links of every row of ``docs``.

    Words are ``[^\\x20\\x09-\\x0D]+`` after lower-casing A-Z; a set holds the
    distinct shingles of ``k`` words, or the whole sequence if it is shorter.
    Rows are linked from a similarity of ``percent`` on; component_id is the
    least id that a row reaches, kept whether that is its own. links counts
    the confirmed links of the row's set to other sets that the search used;
    copies share a set. Null, empty and wordless texts have no shingles and
    no links and stand alone. Rows with a null id keep null ids
    and are kept only if nothing with an id is like them; rows repeated under
    one id are judged alike; an empty table gives an empty result.
    """
    rows, known = _classified(doc_texts(docs, id_col, text_col), k, percent, miss)
    out = rows.select("doc_id", "n_shingles", "set_id").join(known, "set_id", "left")
    component = F.when(F.col("set_id").isNull(), F.col("doc_id")).otherwise(F.col("component_id"))
    return out.select("doc_id", "n_shingles", component.alias("component_id"), F.col("doc_id").eqNullSafe(component).alias("kept"), F.coalesce("links", F.lit(0)).alias("links"))


def without_near_duplicates(docs: DataFrame, k: int = 5, percent: int = 80, miss: float = MISS, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row of each group of ``docs`` with all its columns: the least id, null last, of several texts under it one.

    Of rows repeated under one id with one text, one stays. Rows without words
    are no group and all stay.
    """
    rows, known = _classified(doc_texts(docs, id_col, text_col), k, percent, miss)
    first = F.min(F.struct(F.col("doc_id").isNull(), "doc_id", "text_key")).alias("row")
    # of each set, then of each group of sets: a third of all rows may be one set's
    per_set = rows.where("set_id is not null").groupBy("set_id").agg(first)
    winners = per_set.join(known.select("set_id", "component"), "set_id").groupBy("component").agg(F.min("row").alias("row")).select("row.doc_id", "row.text_key", F.lit(True).alias("one"))
    alone = rows.where("set_id is null").select("doc_id", "text_key", F.lit(False).alias("one")).distinct()
    doc_key, key, one, place = (free_name(n, docs) for n in ("doc_key", "text_key", "one", "place"))
    kept = winners.union(alone).select(F.coalesce("doc_id", F.lit(_NULL_ID)).alias(doc_key), F.col("text_key").alias(key), F.col("one").alias(one))
    keyed = docs.withColumns({doc_key: F.coalesce(F.col(f"`{id_col}`").cast("long"), F.lit(_NULL_ID)), key: text_key_of(F.coalesce(F.col(f"`{text_col}`").cast("string"), F.lit("")))})
    out = keyed.join(kept, [doc_key, key])
    if not rows.where("set_id is not null").groupBy("doc_id", "text_key").count().where("count > 1").isEmpty():
        out = out.withColumn(place, F.when(F.col(one), 0).otherwise(F.monotonically_increasing_id())).dropDuplicates([doc_key, key, place])
    return out.select(*[f"`{c}`" for c in docs.columns])
