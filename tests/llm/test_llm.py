"""Training-data operators against brute force, libraries, round trips and held-out labels, and on awkward rows."""

from __future__ import annotations

import collections
import hashlib
import io
import itertools
import re
import zlib

import numpy as np
import public_tokenizers
import pytest

from buildlake.llm import licenses, media, near_dedup, packing, pieces, quality_classifier, quality_rules, queries, sharding, substrings, token_counts, words
from buildlake.llm.components import components

WORD = re.compile(r"[^\x20\x09-\x0D]+")
LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
BASE = " ".join(f"w{i}" for i in range(90))

# nulls, empty and white texts, repeated rows, ties, clashing column names, a very long text
AWKWARD = [
    (1, None, "a", 0),
    (2, "", "b", 0),
    (3, " \n\t", "c", 0),
    (4, BASE, "d", 0),
    (4, BASE, "d", 0),
    (5, BASE + " Ünïcode ▁ <|endoftext|>", None, 0),
    (6, "one", "e", 0),
    (None, BASE.upper(), "f", 0),
    (7, "lärm ! " * 30_000, "g", 0),
]
COLUMNS = "doc_id long, text string, set_id string, n int"


def by_id(frame):
    return {r["doc_id"]: r for r in frame.collect()}


@pytest.fixture(scope="module")
def awkward(spark):
    return spark.createDataFrame(AWKWARD, COLUMNS)


@pytest.fixture(scope="module")
def docs(spark, sf_dir):
    return spark.read.parquet(f"{sf_dir}/documents.parquet")


@pytest.fixture(scope="module")
def texts(docs):
    return {r["doc_id"]: r["text"] or "" for r in docs.select("doc_id", "text").collect()}


def shingles(text, k):
    w = WORD.findall(text.translate(LOWER))
    m = min(k, len(w))
    return {tuple(w[i : i + m]) for i in range(len(w) - m + 1)} if w else set()


def groups(texts, k):
    """Least id that each text reaches, by comparing all that share a shingle."""
    sets = {d: shingles(t, k) for d, t in texts.items()}
    holders = collections.defaultdict(list)
    for d, s in sets.items():
        for x in s:
            holders[x].append(d)
    common = collections.Counter(p for h in holders.values() for p in itertools.combinations(sorted(h), 2))
    least = {d: d for d in texts}

    def root(d):
        while least[d] != d:
            d = least[d]
        return d

    for (a, b), c in common.items():
        if 100 * c >= 80 * (len(sets[a]) + len(sets[b]) - c):
            a, b = root(a), root(b)
            least[max(a, b)] = min(a, b)
    return {d: (len(sets[d]), root(d)) for d in texts}


def test_op1_equals_its_sql(spark, sf_dir, duck):
    got = queries.op1_near_dedup(spark, sf_dir).toPandas()
    want = duck.sql(queries.ORACLE_SQL["op1_near_dedup"]).df()
    assert sorted(map(tuple, got[list(want.columns)].values.tolist())) == sorted(map(tuple, want.values.tolist()))


def test_near_duplicates_equal_brute_force(spark):
    """Crowds: a shared passage, copies with growing noise, so that buckets hold many sets that aren't linked."""
    rng = np.random.default_rng(3)
    word = lambda: f"x{rng.integers(1 << 40)}"
    passage = [word() for _ in range(60)]
    texts = {}
    for i in range(120):
        texts[len(texts)] = " ".join([word() for _ in range(int(rng.integers(5, 40)))] + passage)
    for i in range(120):
        edited = [word() if rng.random() < i / 1500 else w for w in passage]
        texts[len(texts)] = " ".join(edited)
    got = by_id(near_dedup.near_duplicates(spark.createDataFrame(list(texts.items()), "doc_id long, text string"), k=4))
    assert {d: (r["n_shingles"], r["component_id"]) for d, r in got.items()} == groups(texts, 4)


def test_near_duplicates_on_awkward_rows(awkward):
    rows = near_dedup.near_duplicates(awkward).collect()
    got = {r["doc_id"]: r for r in rows}
    assert len(rows) == len(AWKWARD)
    assert all(got[d]["n_shingles"] == 0 and got[d]["kept"] for d in (1, 2, 3))
    assert got[5]["component_id"] == got[4]["component_id"] == got[None]["component_id"] == 4 and not got[None]["kept"]


def test_bayesian_bounds_and_bitmaps():
    need = near_dedup.least_matches(0.8, 1e-6)
    assert list(need) == sorted(need) and need[0] < 0.8 * near_dedup.BATCH
    rng = np.random.default_rng(1)
    for _ in range(50):
        a, b = (np.unique(rng.integers(0, 300, 150).astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15)) for _ in range(2))
        differ = len(np.setxor1d(a, b))
        bits = sum(int(x).bit_count() for x in (near_dedup.parity_bitmap(a) ^ near_dedup.parity_bitmap(b)).view(np.uint64))
        assert bits <= differ


def test_components_of_a_path(spark):
    got = components(spark.createDataFrame([(i, i + 1) for i in range(40)] + [(99, 98), (98, 99), (7, 7)], "a long, b long"))
    assert {r["node"]: r["component"] for r in got.collect()} == {i: 0 for i in range(41)} | {98: 98, 99: 98}


def test_words_equal_the_pattern():
    for text in ("", "  ", "aB\x0b c\x85d", "ä ß\n日本 x" * 50):
        raw = text.encode()
        w = words.words_of(np.frombuffer(raw, np.uint8), np.array([0, len(raw)]))
        assert [raw[a:b].decode() for a, b in zip(w.begin, w.end, strict=True)] == WORD.findall(text)


def test_media_round_trip(spark, docs, texts, awkward):
    got = by_id(media.text_media(docs))
    for d, t in texts.items():
        raw = t.encode()
        padded = raw + b" " * (-len(raw) % 192 or (0 if raw else 192))
        r = got[d]
        assert (r["n_bytes"], r["payload_bytes"]) == (len(raw), len(padded))
        assert r["payload_sha256"] == hashlib.sha256(padded).hexdigest() and r["tail_crc32"] == zlib.crc32(padded[-16:])
    assert media.text_media(awkward).count() == len(AWKWARD)


def test_image_formats():
    rng = np.random.default_rng(5)
    rgb, grey = rng.integers(0, 256, (7, 5, 3), np.uint8), rng.integers(0, 256, (6, 9), np.uint8)
    assert (media.decode(media.encode_bmp(rgb)) == rgb).all()
    assert (media.decode(media.encode_netpbm(rgb)) == rgb).all() and (media.decode(media.encode_netpbm(grey)) == grey).all()
    assert media.decode(b"P2 # c\n2 1 255\n0 255").tolist() == [[0, 255]] and media.decode(b"P1 2 1\n1 0").tolist() == [[0, 255]]
    whole = media.area_resize(grey, 3, 3)
    assert np.allclose(whole, grey.reshape(3, 2, 3, 3).mean((1, 3)))
    with pytest.raises(ValueError):
        media.decode(b"GIF89a")


def test_licences(spark, texts, docs):
    got = by_id(licenses.scan_licenses(docs))
    pattern = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")
    for d, t in texts.items():
        w = pattern.findall(t.translate(LOWER))
        places = [(i, label) for p, label in licenses.PHRASES.items() for i in range(len(w)) if w[i : i + len(p.split())] == p.split()]
        r = got[d]
        assert (r["n_words"], r["n_base"]) == (len(w), len(places))
        assert r["base_labels"] == ",".join(sorted({label for _, label in places}))
        assert (r["first_word"], r["last_word"]) == ((min(places)[0], max(places)[0]) if places else (None, None))
    notice = licenses.TEMPLATES["mit-notice"].replace("without restriction", "with no restriction")
    row = licenses.scan_licenses(spark.createDataFrame([(1, "x " + notice.upper())], "doc_id long, text string")).first()
    assert row["labels"] == "mit-notice" and row["score"] > 0.9 and row["spans"][0]["start"] <= 2


def test_matching_statistics_equal_brute_force():
    rng = np.random.default_rng(2)
    sequences = [rng.integers(0, 4, n).tolist() for n in (30, 17, 25)]
    automaton = licenses.build_automaton(sequences)
    text = rng.integers(0, 4, 200).tolist()
    runs = {tuple(s[i:j]) for s in sequences for i in range(len(s)) for j in range(i + 1, len(s) + 1)}
    for i, (n, _) in enumerate(licenses.matching_statistics(automaton, text)):
        assert n == max((m for m in range(1, i + 2) if tuple(text[i + 1 - m : i + 1]) in runs), default=0)


def test_quality_classifier_held_out(spark, awkward):
    folder = "/root/testdata/sf0.1"
    docs, labels = (spark.read.parquet(f"{folder}/{t}.parquet") for t in ("documents", "labels"))
    scored = quality_classifier.classify_quality(docs, labels).join(labels, "doc_id").where("held_out").toPandas()
    order = scored["score"].rank()
    good, bad = (scored["quality"] == 1), (scored["quality"] == 0)
    auc = (order[good].sum() - good.sum() * (good.sum() + 1) / 2) / (good.sum() * bad.sum())
    assert auc > 0.97
    assert scored.loc[good, "predicted"].mean() > 0.98 and scored.loc[bad, "predicted"].mean() < 0.2
    none = quality_classifier.classify_quality(awkward, labels.limit(0))
    assert {r["score"] for r in none.collect()} == {0.5} and none.count() == len(AWKWARD)


def test_quality_rules_base(docs, spark, sf_dir, texts, awkward):
    labels = spark.read.parquet(f"{sf_dir}/labels.parquet")
    got = by_id(quality_rules.quality_rules(docs, labels))
    for d, t in texts.items():
        w = WORD.findall(t)
        grams = [tuple(w[i : i + 3]) for i in range(len(w) - 2)]
        twice = collections.Counter(grams)
        repeated = len({i + j for i, g in enumerate(grams) if twice[g] > 1 for j in range(3)})
        lines = [x for x in t.split("\n") if WORD.search(x)]
        r = got[d]
        assert (r["n_words"], r["word_chars"], r["n_symbols"]) == (len(w), sum(map(len, w)), len(re.findall(r"[#*$%&|<>]", t)))
        assert (r["n_dup_lines"], r["n_repeat_words"]) == (len(lines) - len(set(lines)), repeated)
        assert r["base_failed"] == (len(w) < 50 or 100 * repeated > 50 * len(w)) and not (r["base_failed"] and r["kept"])
    good = [r["doc_id"] for r in labels.where("quality = 1").collect()]
    passed = [got[d] for d in good if d in got and not got[d]["base_failed"]]
    assert sum(r["kept"] for r in passed) > 0.95 * len(passed)
    assert quality_rules.quality_rules(awkward, labels).count() == len(AWKWARD)


def test_pieces_equal_the_library(docs, texts, awkward):
    import sentencepiece

    path = public_tokenizers.path(queries.PIECE_MODEL)
    library = sentencepiece.SentencePieceProcessor(model_file=path)
    got = by_id(pieces.piece_digests(docs, path))
    for d, t in texts.items():
        ids = library.encode(t, add_bos=True, add_eos=True)
        assert got[d]["n_tokens"] == len(ids) and got[d]["ids_sha256"] == hashlib.sha256(np.array(ids, "<u4").tobytes()).hexdigest()
        assert got[d]["decoded_sha256"] == hashlib.sha256(library.decode(ids).encode()).hexdigest()
    for r, (_, text, _, _) in zip(pieces.encode_pieces(awkward, path).collect(), AWKWARD, strict=True):
        spans = [(b, e) for b, e in zip(r["begins"], r["ends"], strict=True) if e > b]
        assert spans == sorted(spans)
        if text and text.strip():
            assert spans[0][0] == 0 and spans[-1][1] <= len(text.encode())


def test_character_map_without_entries():
    raw, begin, end = pieces.CharacterMap(b"").replaced("aé".encode())
    assert raw.tobytes() == "aé".encode() and begin.tolist() == [0, 1, 1] and end.tolist() == [1, 3, 3]


def test_repeats_are_covered(spark, docs, texts):
    """Every run of 50 words that an earlier document has lies, for the most part, in a passage found."""
    found = collections.defaultdict(list)
    for r in substrings.repeated_passages(docs).collect():
        found[r["doc_id"]].append(r)
    seen, copies = {}, set()
    for d in sorted(texts):
        w = WORD.findall(texts[d].translate(LOWER))
        if texts[d] in copies:
            assert len(w) < 50 or any(r["whole_copy"] for r in found[d])
            continue
        copies.add(texts[d])
        runs = [tuple(w[i : i + 50]) for i in range(len(w) - 49)]
        covered = {i for r in found[d] for i in range(r["start_word"], r["end_word"])}
        for i, run in enumerate(runs):
            if seen.get(run, d) != d:
                assert sum(j in covered for j in range(i, i + 50)) >= 25
        for run in runs:
            seen.setdefault(run, d)


def test_repeats_of_planted_and_periodic_passages(spark):
    rng = np.random.default_rng(8)
    noise = lambda n: " ".join(f"n{rng.integers(1 << 40)}" for _ in range(n))
    round_about = "is so " * 60
    rows = [(i, f"{noise(80)} {BASE} {noise(30)}", None, 1) for i in range(20)] + [(100 + i, f"{noise(40)} {round_about}{noise(10)}", None, 1) for i in range(5)] + [(200, noise(200), None, 1), (None, None, None, 1)]
    table = spark.createDataFrame(rows, COLUMNS)
    passages = substrings.repeated_passages(table)
    got = collections.defaultdict(list)
    for r in passages.collect():
        got[r["doc_id"]].append((r["start_word"], r["end_word"]))
    assert set(got) == {*range(1, 20), *range(101, 105)}
    assert all(min(s for s, _ in got[i]) == 80 and max(e for _, e in got[i]) == 170 for i in range(1, 20))
    cut = by_id(substrings.without_repeats(table, passages))
    assert len(cut) == len(rows) and cut[0]["text"] == rows[0][1] and "w40" not in cut[5]["text"] and cut[200]["text"] == rows[25][1]


def test_chains_prefer_order():
    assert substrings.chain([0, 10, 20, 30], [5, 15, 1, 25])[0] == [0, 1, 3]
    assert substrings.chain([], []) == []


@pytest.mark.parametrize("shards", [1, 8])
def test_shards(docs, texts, shards):
    rows = sharding.kd_shards(docs, shards).collect()
    assert len(rows) == len(texts)
    size, slots = collections.Counter(), collections.defaultdict(list)
    for r in rows:
        raw = texts[r["doc_id"]].encode()
        assert (r["size"], r["text_crc32"], r["grown_shard"]) == (len(raw) + 1, zlib.crc32(raw), None)
        size[r["shard"]] += r["size"]
        slots[r["shard"]].append(r["slot"])
    assert all(sorted(s) == list(range(len(s))) for s in slots.values())
    assert set(size) == set(range(shards)) and max(size.values()) - min(size.values()) <= 2 * max(r["size"] for r in rows)


def test_shards_of_awkward_rows(awkward):
    assert sharding.kd_shards(awkward, 4).count() == len(AWKWARD)
    assert sharding.kd_shards(awkward.limit(0), 4).count() == 0


def test_token_counts_and_cache(spark, docs, texts, awkward, tmp_path):
    from tokenizers import Tokenizer

    path, ranks = public_tokenizers.path(queries.BPE_JSON), public_tokenizers.path(queries.BPE_RANKS)
    library = Tokenizer.from_file(path)
    library.no_truncation()
    cache = str(tmp_path / "cache")
    for _ in range(2):  # the second time from the cache
        got = by_id(token_counts.count_tokens(docs, path, ranks, cache))
        assert all(got[d]["n_tokens"] == len(library.encode(t, add_special_tokens=False).ids) and got[d]["n_bytes"] == len(t.encode()) for d, t in texts.items())
    assert token_counts.cached_counts(spark, cache, token_counts.version_digest(path, ranks)).count() == len(set(texts.values()))
    assert token_counts.count_tokens(awkward, path, ranks).count() == len(AWKWARD)


def test_packing(spark, docs, texts, awkward):
    from tokenizers import Tokenizer

    path, ranks = public_tokenizers.path(queries.BPE_JSON), public_tokenizers.path(queries.BPE_RANKS)
    library = Tokenizer.from_file(path)
    rows = packing.pack_documents(docs, path, ranks).collect()
    per_doc, per_window = collections.defaultdict(list), collections.defaultdict(list)
    for r in rows:
        per_doc[r["doc_id"]].append(r)
        per_window[r["sequence_id"]].append((r["offset"], r["length"]))
    for d, t in texts.items():
        ids = np.array([*library.encode(t, add_special_tokens=False).ids, 1], "<u4")
        at = 0
        for r in sorted(per_doc[d], key=lambda r: r["start"]):
            assert r["start"] == at and r["doc_tokens"] == len(ids) and r["ids_crc32"] == zlib.crc32(ids[at : at + r["length"]].tobytes())
            at += r["length"]
        assert at == len(ids)
    for parts in per_window.values():
        at = 0
        for offset, length in sorted(parts):
            assert offset == at and length > 0
            at += length
        assert at <= packing.CAPACITY
    total = sum(r["length"] for r in rows)
    assert sorted(per_window) == list(range(len(per_window))) and total > 0.97 * packing.CAPACITY * (len(per_window) - 1)
    assert {r["doc_id"] for r in packing.pack_documents(awkward, path, ranks).collect()} == {r[0] for r in AWKWARD}


def test_best_cuts_equal_brute_force():
    rng = np.random.default_rng(4)
    for _ in range(30):
        pos = np.cumsum(rng.integers(1, 5, 9))
        penalty = rng.integers(0, 6, 9).astype(float)
        penalty[-1] = 0
        best = np.inf
        for n in range(9):
            for some in itertools.combinations(range(8), n):
                cuts = [0, *(int(pos[i]) for i in some), int(pos[-1])]
                gaps = np.diff(cuts)
                if (gaps <= 10).all():
                    best = min(best, float((10 - gaps).sum() + penalty[list(some)].sum()))
        chosen = packing.best_cuts(pos, penalty, 10)
        gaps = np.diff([0, *pos[chosen]])
        assert chosen[-1] == 8 and (gaps <= 10).all() and (10 - gaps).sum() + penalty[chosen].sum() == best


def test_pipeline_stages(spark, sf_dir):
    import corpus_pipeline as p

    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    labels = spark.read.parquet(f"{sf_dir}/labels.parquet")
    kept = docs
    for name, stage in p.STAGES[:-1]:
        before, kept = kept, stage(spark, kept, sf_dir).cache()
        assert kept.columns == docs.columns and 0 < kept.count() <= before.count(), name
        if name == "quality_classifier":
            clean = docs.join(labels.where("quality = 1"), "doc_id").where("n_chars > 500")
            assert kept.join(clean, "doc_id", "left_semi").count() > 0.9 * clean.count()
    rows = p.STAGES[-1][1](spark, kept, sf_dir).toPandas()
    assert rows.groupby("doc_id")["length"].sum().equals(rows.groupby("doc_id")["doc_tokens"].first().rename("length"))
    assert p.run(spark, sf_dir).count() == len(rows)


def test_empty_tables(spark):
    empty = spark.createDataFrame([], "doc_id long, text string, lang string, source string, n_chars long")
    labels = spark.createDataFrame([], "doc_id long, quality int, toxic int")
    path = public_tokenizers.path
    results = (
        near_dedup.without_near_duplicates(empty),
        media.text_media(empty),
        licenses.scan_licenses(empty),
        quality_classifier.keep_predicted(empty, labels),
        quality_rules.keep_good(empty, labels),
        pieces.encode_pieces(empty, path(queries.PIECE_MODEL)),
        substrings.without_repeats(empty, substrings.repeated_passages(empty)),
        token_counts.count_tokens(empty, path(queries.BPE_JSON)),
        packing.pack_documents(empty, path(queries.BPE_JSON)),
    )
    assert [r.count() for r in results] == [0] * len(results)


def test_media_tiles_of_sound_and_damaged_images(spark):
    rng = np.random.default_rng(6)
    rgb, grey = rng.integers(0, 256, (20, 31, 3), np.uint8), rng.integers(0, 256, (40, 9), np.uint8)
    palette = bytearray(media.encode_bmp(rgb[:2, :4]))
    palette[28:30], palette[46:50] = (8).to_bytes(2, "little"), (1).to_bytes(4, "little")  # indices beyond the palette
    sound = {1: media.encode_bmp(rgb), 2: media.encode_netpbm(rgb), 3: media.encode_netpbm(grey), 10: b"P5 1 1 255\n\x07"}
    damaged = [None, b"", b"P", b"BM", b"GIF89a", b"P6 9 9 255\n", b"P5 0 4 255\n", b"P2 1 1 255\n99999999999999999999999", b"P2 1 1 255\nx", b"P5 99999999999 99999999999 255\n1", b"P5 2 2 70000\n", media.encode_bmp(rgb)[:100], bytes(palette)]
    rows = [(i, b, "clash") for i, b in sound.items()] + [(100 + i, None if b is None else bytearray(b), None) for i, b in enumerate(damaged)] + [(None, bytearray(sound[1]), "x"), (1, sound[1], "again")]
    images = spark.createDataFrame([(i, None if b is None else bytearray(b), t) for i, b, t in rows], "image long, data binary, tile string")
    got = media.media_tiles(images, "image", "data", side=8).collect()
    assert len(got) == len(rows)
    for r in got:
        broken = r["id"] is not None and r["id"] >= 100
        assert (r["error"] is not None) == broken and (r["tile"] is None) == broken and (r["dhash"] is None) == broken
    one = {r["id"]: r for r in got}
    assert (one[1]["width"], one[1]["height"], one[1]["channels"]) == (31, 20, 3) and (one[3]["width"], one[3]["channels"]) == (9, 1)
    assert one[1]["tile"] == one[2]["tile"] and one[1]["dhash"] == one[2]["dhash"] == one[None]["dhash"]
    tile = np.load(io.BytesIO(bytes(one[3]["tile"])))
    assert tile.shape == (8, 8) and (tile == np.rint(media.area_resize(grey, 8, 8))).all()
    assert media.media_tiles(images.limit(0), "image", "data").count() == 0


def test_area_resize_equals_weighted_boxes():
    rng = np.random.default_rng(9)
    image = rng.integers(0, 256, (7, 10), np.uint8)

    def weights(size, n):
        edge = [i * size / n for i in range(n + 1)]
        return np.array([[max(0.0, min(edge[k + 1], i + 1) - max(edge[k], i)) for i in range(size)] for k in range(n)]) * n / size

    for h, w in ((3, 4), (7, 10), (9, 13), (1, 1)):
        assert np.allclose(media.area_resize(image, h, w), weights(7, h) @ image @ weights(10, w).T)


def test_edited_passages_are_found(spark):
    """Passages of 60 words, 10 of them replaced inside, all similar enough by construction: as good as all are found."""
    rng = np.random.default_rng(31)
    noise = lambda n: [f"v{rng.integers(1 << 40)}" for _ in range(n)]
    rows, n = [], 200
    for i in range(n):
        passage = noise(60)
        edited = passage.copy()
        for j in rng.choice(58, 10, replace=False) + 1:
            edited[j] = noise(1)[0]
        rows += [(k, " ".join([*noise(40), *body, *noise(40)]), None, 1) for k, body in ((i, passage), (1000 + i, edited))]
    got = {(r["doc_id"], r["ref_doc_id"]) for r in substrings.repeated_passages(spark.createDataFrame(rows, COLUMNS)).collect()}
    assert got <= {(1000 + i, i) for i in range(n)} and len(got) >= 0.9 * n, len(got)


def test_part_of_a_text_aligns_as_the_whole():
    a = np.arange(400)
    assert substrings.align(a, a, [200, 210], [200, 210]) == (0, 400, 0, 400, 400)
    assert substrings.align(a[136:280], a, [64, 74], [200, 210], before=136, after=120) is None
    b = np.concatenate([-a[:180], a[180:260], -a[260:]])
    assert substrings.align(a[136:280], b, [64, 74], [200, 210], before=136, after=120) == (44, 124, 180, 260, 80)


def test_passages_whose_sentences_are_older_are_found(spark):
    """Two documents share a passage; each of its sentences, and each joint of two, is in an earlier document of its own."""
    rng = np.random.default_rng(5)
    noise = lambda n: [f"u{rng.integers(1 << 40)}" for _ in range(n)]
    passage = noise(56)
    parts = [(i, noise(40) + passage[i : i + 7] + noise(40), None, 1) for i in range(0, 50, 3)]
    table = [*parts, (100, noise(30) + passage + noise(30), None, 1), (200, noise(50) + passage + noise(20), None, 1)]
    rows = [(d, " ".join(w), s, n) for d, w, s, n in table]
    got = [(r["doc_id"], r["ref_doc_id"], r["start_word"], r["end_word"]) for r in substrings.repeated_passages(spark.createDataFrame(rows, COLUMNS)).collect()]
    assert got == [(200, 100, 50, 106)]
