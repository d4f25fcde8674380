"""The dealt methods against brute force: what decides a result, and every awkward row's value."""

from __future__ import annotations

import collections
import difflib
import hashlib
import itertools
import math
import re
import zlib

import numpy as np
import public_tokenizers
import pytest
from pyspark.sql import functions as F

from buildlake.llm import licenses, media, near_dedup, packing, pieces, quality_classifier, quality_rules, queries, sharding, substrings, token_counts

WORD = re.compile(r"[^\x20\x09-\x0D]+")
COLUMNS = "doc_id long, text string, set_id string, n int"


def noise(rng, n, mark="v"):
    return [f"{mark}{rng.integers(1 << 40)}" for _ in range(n)]


def passages_of(spark, rows, **options):
    return substrings.repeated_passages(spark.createDataFrame(rows, COLUMNS), **options)


# --- substring dedup


@pytest.mark.parametrize("share", [0.0, 0.05, 0.1, 0.15, 0.18, 0.2])
def test_recall_of_edited_passages(spark, share):
    """Passages of 120 words, words substituted at random, those that keep a similarity of 0.8 by an exact alignment."""
    rng = np.random.default_rng(int(share * 100))
    rows, wanted = [], set()
    for i in range(150):
        passage = noise(rng, 120)
        edited = [w if rng.random() >= share else noise(rng, 1)[0] for w in passage]
        same = sum(a == b for a, b in zip(passage, edited, strict=True))
        if same >= 0.8 * 120:
            wanted.add((1000 + i, i))
        rows += [(k, " ".join([*noise(rng, 40), *body, *noise(rng, 40)]), None, 1) for k, body in ((i, passage), (1000 + i, edited))]
    got = {(r["doc_id"], r["ref_doc_id"]) for r in passages_of(spark, rows).collect()}
    assert got <= {(1000 + i, i) for i in range(150)} and len(got & wanted) >= 0.9 * len(wanted), (len(got & wanted), len(wanted))


def test_shortest_passages_with_inserted_and_lost_words(spark):
    rng = np.random.default_rng(6)
    rows = []
    for i in range(150):
        passage = noise(rng, 60)
        edited = passage.copy()
        for _ in range(4):
            edited.insert(int(rng.integers(5, 55)), noise(rng, 1)[0])
            del edited[int(rng.integers(5, 55))]
        rows += [(k, " ".join([*noise(rng, 40), *body, *noise(rng, 40)]), None, 1) for k, body in ((i, passage), (1000 + i, edited))]
    got = {(r["doc_id"], r["ref_doc_id"]) for r in passages_of(spark, rows).collect()}
    assert got <= {(1000 + i, i) for i in range(150)} and len(got) >= 0.9 * 150, len(got)


@pytest.mark.parametrize("older", [1, 30])
def test_thirds_in_older_documents_hide_no_passage(spark, older):
    """Two documents share exactly 81 words, each third of which also stands in older ones, more than make a seed rare or not."""
    rng = np.random.default_rng(7)
    rows, wanted = [], {}
    for i in range(20):
        passage = noise(rng, 81)
        for t in range(3):
            rows += [(1000 * t + 40 * i + o, " ".join([*noise(rng, 30), *passage[27 * t : 27 * t + 27], *noise(rng, 30)]), None, 1) for o in range(older)]
        rows += [(d + i, " ".join([*noise(rng, 25), *passage, *noise(rng, 35)]), None, 1) for d in (10_000, 20_000)]
        wanted[20_000 + i] = (10_000 + i, 25, 106)
    got = {r["doc_id"]: (r["ref_doc_id"], r["start_word"], r["end_word"]) for r in passages_of(spark, rows).where("doc_id >= 20000").collect()}
    assert got == wanted


def test_frequent_passages_and_hot_blocks(spark, monkeypatch):
    """A passage of 60 words in hundreds of documents, in blocks so small that most places are settled where they are dealt out."""
    rng = np.random.default_rng(8)
    passage, other = noise(rng, 60), noise(rng, 90)
    rows = [(i, " ".join([*noise(rng, 20), *passage, *noise(rng, 20)]), None, 1) for i in range(300)]
    rows += [(1000 + i, " ".join([*noise(rng, 10), *other[:70], *noise(rng, 10), *other[60:]]), None, 1) for i in range(60)]
    found = collections.defaultdict(set)
    for r in passages_of(spark, rows).collect():
        assert r["ref_doc_id"] < r["doc_id"]
        found[r["doc_id"]] |= set(range(r["start_word"], r["end_word"]))
    assert set(found) == {*range(1, 300), *range(1001, 1060)}
    assert all(found[i] == set(range(20, 80)) for i in range(1, 300)) and all(set(range(10, 80)) <= found[1000 + i] for i in range(1, 60))


def test_settled_and_bucketed_seeds_agree():
    rng = np.random.default_rng(9)
    h = rng.integers(0, 1 << 63, 40).astype(np.uint64)[rng.integers(0, 40, 3000)]
    more = substrings.spare(h)
    left = collections.Counter(h[~more].tolist())
    assert all(left[v] == min(n, substrings.RARE + 1) for v, n in collections.Counter(h.tolist()).items())
    of, x = np.repeat(np.arange(30), 100), np.tile(np.arange(100), 30)
    docs, keys = np.arange(30) * 7 - 50, rng.integers(0, 1 << 60, 30)
    rows = [substrings._block(3, True, h[more], of[more], x[more], docs, keys), *substrings.blocks(h[~more], of[~more], x[~more], docs, keys, 16)]
    back = [c for r in rows for c in zip(*(a.tolist() for a in substrings.block_seeds(*r, 16)), strict=True)]
    mask = (1 << 8 * substrings.WIDTH) - 1
    want = [((int(v) // 16 & mask) * 16 + int(v) % 16, int(docs[o]), int(keys[o]), int(p)) for v, o, p in zip(h, of, x, strict=True)]
    assert sorted(back) == sorted(want)


def test_met_places_equal_brute_force():
    rng = np.random.default_rng(10)
    n = 600
    h, doc = rng.integers(0, 90, n).astype(np.uint64), rng.integers(0, 40, n)
    part, x = doc * 3 + 1, rng.integers(0, 6, n)
    part[doc > 35], doc[doc > 35] = 1, rng.integers(36, 40, int((doc > 35).sum()))  # copies of document 0
    later, earlier, frequent, first = substrings.met(h, doc, part, x)
    places = collections.defaultdict(dict)
    for a, b, c, d in zip(h.tolist(), part.tolist(), x.tolist(), doc.tolist(), strict=True):
        places[a][b, c] = min(d, places[a].get((b, c), 1 << 30))
    pairs, often = set(), set()
    for v, some in places.items():
        rows = sorted((d, p, q) for (p, q), d in some.items())
        if 1 < len(rows) <= substrings.RARE:
            pairs |= {(v, a, b) for a, b in itertools.permutations(rows, 2) if a[0] > b[0]}
        elif len(rows) > substrings.RARE:
            often |= {(v, r, rows[0]) for r in rows}
    key = lambda i: (int(doc[i]), int(part[i]), int(x[i]))
    assert {(int(h[a]), key(a), key(b)) for a, b in zip(later, earlier, strict=True)} == pairs and len(later) == len(pairs)
    assert {(int(h[a]), key(a), key(b)) for a, b in zip(frequent, first, strict=True)} == often and len(frequent) == len(often)


def test_two_texts_under_one_id_lose_their_own_passages(spark):
    rng = np.random.default_rng(11)
    passage, mine, other = noise(rng, 60), noise(rng, 60), noise(rng, 120)
    rows = [(1, " ".join(noise(rng, 10) + passage), "k", 1), (2, " ".join(mine + passage), "k", 1), (2, " ".join(other), "k", 1), (None, " ".join(passage + noise(rng, 90)), "k", 1), (3, " ".join(other), "k", 1)]
    table = spark.createDataFrame(rows, COLUMNS).withColumnsRenamed({"set_id": "text_key", "n": "spans"})
    passages = substrings.repeated_passages(table)
    texts = sorted((r["doc_id"] is not None, r["doc_id"] or 0, r["text"].strip()) for r in substrings.without_repeats(table, passages).select("doc_id", "text").collect())
    assert substrings.without_repeats(table, passages).columns == table.columns
    # the null id is the earliest document; a whole copy goes, word for word
    assert texts == sorted([(False, 0, rows[3][1]), (True, 1, " ".join(rows[0][1].split()[:10])), (True, 2, " ".join(mine)), (True, 2, rows[2][1]), (True, 3, "")])


# --- sharding


def balanced(rows, shards):
    size = collections.Counter()
    for r in rows:
        size[r["shard"]] += r["size"]
    return size


@pytest.mark.parametrize("shards", [8, 64, 1024])
def test_any_number_of_shards_is_even(spark, shards):
    docs = spark.read.parquet("/root/testdata/sf0.1/documents.parquet")
    rows = sharding.kd_shards(docs, shards).select("shard", "size", "slot").collect()
    size, most = balanced(rows, shards), max(r["size"] for r in rows)
    fair = sum(size.values()) / shards
    # documents are whole: one that is larger than a shard leaves a sibling empty
    assert len(size) >= shards - sum(r["size"] > fair for r in rows) and set(size) <= set(range(shards))
    # each cut is within half a document and half a light bin of its node's middle
    assert max(abs(v - fair) for v in size.values()) <= most + fair * shards.bit_length() * sharding.EVEN
    slots = collections.defaultdict(list)
    for r in rows:
        slots[r["shard"]].append(r["slot"])
    assert all(sorted(s) == list(range(len(s))) for s in slots.values())


def test_shards_do_not_depend_on_files(spark, sf_dir):
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet").where("doc_id is not null")
    docs = docs.unionByName(docs.where("doc_id % 5 = 0"))
    one = sharding.kd_shards(docs.coalesce(1), 16).collect()
    other = sharding.kd_shards(docs.repartition(7, "text").sortWithinPartitions(F.desc("n_chars")), 16).collect()
    assert sorted(map(str, one)) == sorted(map(str, other))
    with_target = sharding.kd_shards(docs, target_bytes=1 << 16)
    size = balanced(with_target.collect(), None)
    assert len(size) == sharding.shards_for(sum(size.values()), 1 << 16) and sum(size.values()) / len(size) <= 1 << 16


def test_tree_equals_brute_force(spark):
    """200 rows of 400 to 600 bytes, two dimensions: each half is what sorting the node along its widest side gives, within a row."""
    rng = np.random.default_rng(12)
    rows = [(i, "x" * int(rng.integers(400, 600)), int(rng.integers(0, 40)), float(rng.normal())) for i in range(200)]
    table = spark.createDataFrame(rows, "doc_id long, text string, a long, b double")
    got = {r["doc_id"]: r["shard"] for r in sharding.kd_shards(table, 8, dimensions={"a": F.col("a"), "b": F.col("b")}).collect()}
    sides = [{r[0]: float(r[2]) for r in rows}, {r[0]: r[3] for r in rows}]
    span = [max(s.values()) - min(s.values()) for s in sides]
    size = {r[0]: len(r[1]) + 1 for r in rows}

    def check(ids, level, shard):
        if level == 3:
            return
        left = {i for i in ids if got[i] >> (2 - level) == 2 * shard}
        right = ids - left
        side = max((0, 1), key=lambda k: ((max(sides[k][i] for i in ids) - min(sides[k][i] for i in ids)) / span[k], -k))
        assert max(sides[side][i] for i in left) <= min(sides[side][i] for i in right)
        assert abs(sum(size[i] for i in left) - sum(size[i] for i in right)) <= 2 * max(size[i] for i in ids)
        check(left, level + 1, 2 * shard)
        check(right, level + 1, 2 * shard + 1)

    check(set(got), 0, 0)


# --- packing


def test_stream_equals_one_program():
    """What the stream gives out bit by bit costs what the best cuts of the whole stream cost."""
    rng = np.random.default_rng(13)
    for capacity, flush in ((64, 3), (256, 20)):
        stream, rows, pos, penalty, end = packing._Stream(capacity, 16, 128), [], [], [], 0
        for d in range(1500):
            cuts = np.unique(np.minimum(np.cumsum(rng.integers(1, 12, rng.integers(1, 12))), 90))
            inside = rng.random(len(cuts)) < 0.3
            stream.add(d, int(cuts[-1]), cuts.astype("<u4"), inside, np.zeros(len(cuts), "<u4"))
            pos += (cuts + end).tolist()
            penalty += [*np.where(inside[:-1], 128.0, 16.0).tolist(), 0.0]
            end += int(cuts[-1])
            if d % flush == 0:
                rows += stream.flush(final=False)
        rows += stream.flush(final=True)
        windows = collections.Counter()
        for r in rows:
            windows[r[5]] += r[2]
        edges = np.cumsum([windows[w] for w in range(len(windows))])
        where = {p: c for p, c in zip(pos, penalty, strict=True)}
        cost = lambda cuts: sum(capacity - n for n in np.diff([0, *cuts])) + sum(where[int(c)] for c in cuts)
        best = packing.best_cuts(np.array(pos), np.array(penalty), capacity)
        assert cost(edges) == cost([pos[i] for i in best]) and edges[-1] == end
        assert max(windows.values()) <= capacity


def test_short_sentences_are_not_cut():
    ends = np.array([False, True])
    ids = np.array([0] * 200 + [1] + [0] * 700 + [1] + [0] * 5)
    cuts, inside = packing.possible_cuts(ids, ends)
    assert cuts.tolist() == [201, *range(265, 902, 64), 902, 907] and cuts[inside].tolist() == list(range(265, 902, 64))


# --- licence scans


def test_notices_get_their_version(spark):
    texts = {
        1: "Licensed under the Apache License, Version 2.0.",
        2: "This work is licensed under the GNU General Public License, version 3.",
        3: "Licensed under the GNU General Public License, version 2 or later",
        4: "Licensed under CC BY-NC 4.0.",
        5: "Licensed under CC BY-NC-SA 3.0, see below",
        6: "Released under the MIT License.",
        7: "we met at the apache license office",
        8: "a b c",
        9: licenses.TEMPLATES["apache-notice"].replace("compliance", "agreement") + " end",
        10: f"Under the ISC License. {'word ' * 50} under the MIT License and the mit license",
    }
    got = {r["doc_id"]: r for r in licenses.scan_licenses(spark.createDataFrame(list(texts.items()), "doc_id long, text string")).collect()}
    want = {1: "apache,apache-2.0", 2: "gpl,gpl-3.0", 3: "gpl,gpl-2.0", 4: "cc-by,cc-by-nc-4.0", 5: "cc-by,cc-by-nc-sa-3.0", 6: "mit", 7: "apache", 8: "", 9: "apache,apache-2.0,apache-notice", 10: "isc,mit"}
    assert {i: got[i]["labels"] for i in texts} == want
    assert all(got[i]["score"] == 1.0 for i in (1, 2, 3, 4, 5, 6, 10)) and 0 < got[7]["score"] < 0.6 and got[8]["score"] == 0 and 0.9 < got[9]["score"]
    assert [(s["label"], s["start"], s["end"]) for s in got[10]["spans"]] == [("isc", 0, 4), ("mit", 54, 58)]


def test_chains_equal_brute_force():
    """Random templates with edits and repeated runs: the best chain of all in-order selections of matches at all their ends."""
    rng = np.random.default_rng(14)
    for _ in range(60):
        template = rng.integers(0, 6, 14).tolist()
        text = [int(rng.integers(0, 8)) if rng.random() < 0.25 else c for c in template]
        text[5:5] = rng.integers(0, 8, int(rng.integers(0, 3))).tolist()
        a = licenses.build_automaton([template])
        pairs = np.zeros((8, 8), bool)
        pairs[template[:-1], template[1:]] = True
        matches = licenses.long_matches(a, np.array(text), pairs).get(0, [])
        runs = {(e - n, e, t) for e in range(len(text) + 1) for n in range(2, e + 1) for t in range(n, 15) if text[e - n : e] == template[t - n : t]}
        longest = {(b, e) for b, e, _ in runs if not any((b, e + 1, t) in runs or (b - 1, e, t) in runs for t in range(15))}
        assert {(e - n, e) for e, n, _ in matches} >= longest
        items = [(e - n, e, t - n, t) for e, n, at in matches for t in a.ends[at][0]]
        assert all(text[b:e] == template[tb:te] for b, e, tb, te in items)
        best = 0
        for k in range(1, 4):
            for some in itertools.permutations(items, k):
                covered, good = some[0][1] - some[0][0], True
                for p, q in itertools.pairwise(some):
                    fresh = min(q[1] - max(q[0], p[1]), q[3] - max(q[2], p[3]))
                    good &= p[0] < q[0] and p[1] <= q[1] and p[2] < q[2] and p[3] <= q[3] and q[0] - p[1] <= 24 and q[2] - p[3] <= 24 and fresh > 0
                    covered += fresh
                best = max(best, covered) if good else best
            if len(items) > 7:
                break
        found = licenses.chains(matches, a, 0)
        assert max((c for _, _, c in found), default=0) >= best
        assert all(0 <= s < e <= len(text) and c <= min(e - s, len(template)) for s, e, c in found)


# --- trained models


def test_attention_gradients_equal_differences():
    rng = np.random.default_rng(15)
    width, hidden, branch = quality_classifier.WIDTH, 5, 4
    p = [rng.normal(size=s) for s in ((width, hidden), hidden, (hidden, branch), (hidden, branch), branch, hidden, 1)]
    x, ptr, y = rng.normal(size=(11, width)), np.array([0, 3, 4, 11]), np.array([1.0, 0.0, 1.0])
    mean, scale = np.zeros(width), np.ones(width)

    def loss(p):
        s = quality_classifier.AttentionModel(mean, scale, *p).scores(x, ptr)
        return float(-(y * np.log(s) + (1 - y) * np.log(1 - s)).mean())

    for k, g in enumerate(quality_classifier.AttentionModel(mean, scale, *p).gradients(x, ptr, y)):
        for i in rng.choice(p[k].size, min(5, p[k].size), replace=False):
            step = np.zeros(p[k].size)
            step[i] = 1e-6
            up, down = ([q + s * step.reshape(q.shape) if j == k else q for j, q in enumerate(p)] for s in (1, -1))
            assert math.isclose((loss(up) - loss(down)) / 2e-6, g.reshape(-1)[i], rel_tol=1e-3, abs_tol=1e-8)


def test_path_lengths_equal_a_walk():
    rng = np.random.default_rng(16)
    x = rng.normal(size=(300, 5))
    forest = quality_rules.grow(x, trees=20, psi=64)
    probe = np.concatenate([x[:50], rng.normal(size=(20, 5)) * 6])

    def walk(tree, row):
        at = depth = 0
        while forest.feature[tree, at] >= 0:
            at, depth = 2 * at + (2 if row[forest.feature[tree, at]] >= forest.value[tree, at] else 1), depth + 1
        assert depth <= forest.length[tree, at]
        return forest.length[tree, at]

    c = lambda n: 2 * (math.log(n - 1) + 0.5772156649) - 2 * (n - 1) / n
    want = [2 ** (-np.mean([walk(t, row) for t in range(20)]) / c(64)) for row in probe]
    assert np.allclose(forest.scores(probe), want)
    assert forest.scores(probe)[50:].mean() > forest.scores(probe)[:50].mean()
    # the rows of a tree's leaves add up: each leaf's length is its depth and what its rows would still take
    sample = quality_rules.grow(x[:40], trees=1, psi=40)
    at = [0]
    rows = {0: list(range(40))}
    while at:
        n = at.pop()
        f = sample.feature[0, n]
        if f >= 0:
            rows[2 * n + 1] = [i for i in rows[n] if x[i, f] < sample.value[0, n]]
            rows[2 * n + 2] = [i for i in rows[n] if x[i, f] >= sample.value[0, n]]
            at += [2 * n + 1, 2 * n + 2]
        else:
            m = len(rows[n])
            assert math.isclose(sample.length[0, n], int(math.log2(n + 1)) + (0 if m < 2 else 1 if m == 2 else c(m)))


# --- pieces, images, counts


ODD = ["", " ", "Hello  world ", " ﬁne ｆｕｌｌ Ünïcode①  x", "日本語 テスト\n\nnew​ line", "é é   z\t\r\n", "a\x00b\x7f", "👩‍👩‍👧 ▁x", "A" * 300 + " b", "ͅῳ"]


def test_spans_equal_the_library(spark):
    path = public_tokenizers.path(queries.PIECE_MODEL)
    import sentencepiece

    library = sentencepiece.SentencePieceProcessor(model_file=path)
    got = {r["doc_id"]: r for r in pieces.encode_pieces(spark.createDataFrame(list(enumerate(ODD)), "doc_id long, text string"), path).collect()}
    digests = {r["doc_id"]: r for r in pieces.piece_digests(spark.createDataFrame(list(enumerate(ODD)), "doc_id long, text string"), path).collect()}
    for i, text in enumerate(ODD):
        want = list(library.encode(text, return_type="proto").pieces)
        r = got[i]
        begins, ends, ids = r["begins"], r["ends"], r["ids"]
        assert ids[1:-1] == [p.id for p in want] and (begins[0], ends[0]) == (0, 0) and (begins[-1], ends[-1]) == (len(text.encode()),) * 2
        for k, p in enumerate(want, 1):
            if p.begin < p.end:  # the library gives a character's span to the last of its byte pieces only
                assert (begins[k], ends[k]) == (p.begin, p.end)
            elif library.is_byte(p.id):
                assert begins[k] <= p.begin < ends[k]
            else:
                assert begins[k] == ends[k]
        crc = zlib.crc32(np.array(ends, "<i8").tobytes(), zlib.crc32(np.array(begins, "<i8").tobytes()))
        assert digests[i]["spans_crc32"] == crc and digests[i]["n_tokens"] == len(ids)


def test_unknown_pieces_have_spans():
    model = pieces.load(public_tokenizers.path(queries.PIECE_MODEL))
    known, unknown = int(model.processor.piece_to_id("a")), int(model.processor.unk_id())
    n = model._unknown("xéya".encode(), np.array([unknown, unknown, known]), np.array([-1, -1, 1]))
    assert n.tolist() == [1, 3, 1]
    assert model._unknown("xé".encode(), np.array([unknown, unknown]), np.array([-1, -1])).tolist() == [1, 2]


def test_stored_forms_by_hand(spark):
    """Header and samples of both formats, the difference hash and the tile, computed anew from the payload."""
    texts = {1: "word " * 30, 2: "word " * 60, 3: "", 4: "ü" * 5000, 5: "line\n" * 700}
    got = {r["doc_id"]: r for r in media.text_media(spark.createDataFrame(list(texts.items()), "doc_id long, text string")).collect()}
    for d, t in texts.items():
        raw = t.encode()
        payload = raw + b" " * (-len(raw) % 192 or (0 if raw else 192))
        n = len(payload) // 192
        if n % 2:
            rows = [payload[192 * i : 192 * i + 192] for i in range(n)][::-1]
            flipped = b"".join(bytes(itertools.chain.from_iterable(r[k : k + 3][::-1] for k in range(0, 192, 3))) for r in rows)
            le = lambda v, w=4: v.to_bytes(w, "little")
            stored = b"BM" + le(54 + len(payload)) + le(0) + le(54) + le(40) + le(64) + le(n) + le(1, 2) + le(24, 2) + le(0) + le(len(payload)) + le(2835) * 2 + le(0) * 2 + flipped
        else:
            stored = b"P6\n64 %d\n255\n" % n + payload
        r = got[d]
        assert (r["format"], r["media_bytes"], r["media_sha256"]) == ("bmp" if n % 2 else "ppm", len(stored), hashlib.sha256(stored).hexdigest())
        assert r["payload_sha256"] == hashlib.sha256(payload).hexdigest()
        image = np.frombuffer(payload, np.uint8).reshape(n, 64, 3)

        def boxes(x, h, w):
            share = lambda size, m: np.array([[max(0.0, min((k + 1) * size / m, i + 1) - max(k * size / m, i)) for i in range(size)] for k in range(m)]) * m / size
            return share(x.shape[0], h) @ x @ share(x.shape[1], w).T

        grey = image.astype(int).sum(2) // 3
        small = np.floor(boxes(grey, 8, 9) * 256 + 0.5)
        assert r["feature"] == np.packbits(small[:, 1:] > small[:, :-1]).tobytes().hex()
        tile = np.stack([boxes(image[:, :, c], 16, 16) for c in range(3)], 2)
        back = np.frombuffer(bytes(r["tile"])[-768:], np.uint8).reshape(16, 16, 3)
        assert np.abs(back - tile).max() <= 0.5 + 1e-9 and r["tile_crc32"] == zlib.crc32(bytes(r["tile"]))


def test_bands_and_refused_bitmaps():
    rng = np.random.default_rng(17)
    image = rng.integers(0, 256, (1000, 7, 3), np.uint8)
    assert np.allclose(media.area_resize(image, 9, 5, band=50), media.area_resize(image, 9, 5))
    sound = bytearray(media.encode_bmp(image[:2]))
    for at, value in ((14, 12), (30, 3)):  # an older header; bit fields
        damaged = sound.copy()
        damaged[at : at + 4] = value.to_bytes(4, "little")
        with pytest.raises(ValueError):
            media.decode(bytes(damaged))
    masks = bytearray(sound[:54]) + (0xFF0000).to_bytes(4, "little") + (0xFF00).to_bytes(4, "little") + (0xFF).to_bytes(4, "little") + bytes([3, 2, 1, 0])
    masks[10:14], masks[18:22], masks[22:26], masks[28:30], masks[30:34] = (66).to_bytes(4, "little"), (1).to_bytes(4, "little"), (1).to_bytes(4, "little"), (32).to_bytes(2, "little"), (3).to_bytes(4, "little")
    assert media.decode(bytes(masks)).tolist() == [[[1, 2, 3]]]


def test_stored_counts_are_used(spark, sf_dir, tmp_path):
    """The query with a folder for counts: a second run encodes nothing and gives the same rows; other ranks are another version."""
    path, ranks = public_tokenizers.path(queries.BPE_JSON), public_tokenizers.path(queries.BPE_RANKS)
    spark.conf.set("spark.buildlake.tokenCache", str(tmp_path / "counts"))
    try:
        runs = [sorted(map(tuple, queries.op9_token_counts(spark, sf_dir).collect())) for _ in range(2)]
    finally:
        spark.conf.unset("spark.buildlake.tokenCache")
    assert runs[0] == runs[1]
    stored = spark.read.parquet(str(tmp_path / "counts"))
    assert stored.count() == stored.select("digest").distinct().count()
    assert token_counts.version_digest(path) != token_counts.version_digest(path, ranks)
    # what is stored decides: a count that was changed comes back
    version = token_counts.version_digest(path, ranks)
    cache = str(tmp_path / "other")
    spark.createDataFrame([(bytearray(hashlib.sha256(b"one").digest()), 5000)], token_counts.CACHE).write.parquet(f"{cache}/version={version}")
    rows = token_counts.count_tokens(spark.createDataFrame([(1, "one"), (None, "one"), (2, "two")], "doc_id long, text string"), path, ranks, cache).collect()
    assert sorted((r["doc_id"] or 0, r["n_tokens"], r["over_limit"]) for r in rows) == [(0, 5000, True), (1, 5000, True), (2, 1, False)]


# --- awkward rows: nulls, empty and very long texts, ties, repeated rows, clashing columns

BASE = " ".join(f"w{i}" for i in range(90))
LONG = "lärm ! " * 30_000
AWKWARD = [(1, None, "a", 0), (2, "", "b", 0), (3, " \n\t", "c", 0), (4, BASE, "d", 0), (4, BASE, "d", 0), (5, BASE + " Ünïcode ▁ <|endoftext|>", None, 0), (6, "one", "e", 0), (None, BASE.upper(), "f", 0), (7, LONG, "g", 0), (None, None, None, None)]


@pytest.fixture(scope="module")
def awkward(spark):
    return spark.createDataFrame(AWKWARD, "doc_id long, text string, text_key string, shard int")


def told(frame, *columns):
    return sorted(((r["doc_id"] if r["doc_id"] is not None else -1), *(r[c] for c in columns)) for r in frame.collect())


def test_awkward_rows_of_every_operator(spark, awkward):
    path = public_tokenizers.path
    texts = [(-1 if d is None else d, t or "") for d, t, *_ in AWKWARD]
    words = lambda t: WORD.findall(t)
    assert told(licenses.scan_licenses(awkward), "n_words", "labels", "score", "first_word") == sorted((d, len(re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", t.lower())), "", 0.0, None) for d, t in texts)
    assert told(media.text_media(awkward), "n_bytes", "payload_bytes") == sorted((d, len(t.encode()), max(192, -(-len(t.encode()) // 192) * 192)) for d, t in texts)
    labels = spark.createDataFrame([], "doc_id long, quality int")
    rules = told(quality_rules.quality_rules(awkward, labels), "n_words", "word_chars", "kept")
    assert rules == sorted((d, len(words(t)), sum(map(len, words(t))), 50 <= len(words(t)) and t != LONG) for d, t in texts)
    scores = collections.defaultdict(set)
    train = spark.createDataFrame([(100 + i, BASE if i % 2 else "one " * 60) for i in range(40)], "doc_id long, text string")
    for d, s in told(quality_classifier.classify_quality(awkward.unionByName(train, allowMissingColumns=True), spark.createDataFrame([(100 + i, i % 2) for i in range(40)], "doc_id long, quality int")), "score"):
        assert 0 <= s <= 1
        scores[d].add(s)
    assert len(scores[4]) == 1 and scores[1] == scores[2] and len(scores) == 8 + 40
    from tokenizers import Tokenizer

    library = Tokenizer.from_file(path(queries.BPE_JSON))
    library.no_truncation()
    count = {t: len(library.encode(t, add_special_tokens=False).ids) for _, t in texts}
    assert told(token_counts.count_tokens(awkward, path(queries.BPE_JSON), path(queries.BPE_RANKS)), "n_bytes", "n_tokens", "over_limit") == sorted((d, len(t.encode()), count[t], count[t] > 1024) for d, t in texts)
    packed = collections.Counter()
    for r in packing.pack_documents(awkward, path(queries.BPE_JSON), path(queries.BPE_RANKS)).collect():
        packed[-1 if r["doc_id"] is None else r["doc_id"]] += r["length"]
    want = collections.Counter()
    for d, t in texts:
        want[d] += count[t] + 1
    assert packed == want
    sizes = told(sharding.kd_shards(awkward, 4), "size", "text_crc32")
    assert sizes == sorted((d, len(t.encode()) + 1, zlib.crc32(t.encode())) for d, t in texts)
    ids = told(pieces.piece_digests(awkward, path(queries.PIECE_MODEL)), "n_tokens")
    assert len(ids) == len(AWKWARD) and (1, 2) in ids and (2, 2) in ids


def test_awkward_rows_of_every_stage(spark, awkward):
    kept = near_dedup.without_near_duplicates(awkward)
    assert kept.columns == awkward.columns
    # one row of the group of 4, 5 and the null id; rows without words all stay
    assert told(kept, "shard") == [(-1, None), (1, 0), (2, 0), (3, 0), (4, 0), (6, 0), (7, 0)]
    null_twice = spark.createDataFrame([(None, BASE), (None, BASE + " x"), (None, "other " * 30 + BASE[:40]), (None, None), (None, None)], "doc_id long, text string")
    assert sorted((r["text"] or "")[:7] for r in near_dedup.without_near_duplicates(null_twice).collect()) == ["", "", "other o", "w0 w1 w"]
    passages = substrings.repeated_passages(awkward)
    found = {(r["doc_id"], r["ref_doc_id"], r["start_word"], r["end_word"], r["whole_copy"]) for r in passages.collect()}
    assert found == {(4, None, 0, 90, False), (5, None, 0, 90, False), (5, 4, 0, 90, False)}
    cut = sorted((-1 if r["doc_id"] is None else r["doc_id"], (r["text"] or "").strip()[:7]) for r in substrings.without_repeats(awkward, passages).collect())
    assert cut == [(-1, ""), (-1, "w0 w1 w".upper()), (1, ""), (2, ""), (3, ""), (4, ""), (4, ""), (5, "Ünïcode"), (6, "one"), (7, "lärm ! ")]
    labels = spark.createDataFrame([], "doc_id long, quality int")
    assert told(quality_rules.keep_good(awkward, labels), "shard") == [(-1, 0), (4, 0), (4, 0), (5, 0)]
    assert quality_classifier.keep_predicted(awkward, labels).count() == len(AWKWARD)


def test_similar_by_word_alignment():
    """The aligner's similarity is that of an independent matcher on substituted words."""
    rng = np.random.default_rng(18)
    for _ in range(20):
        a = rng.integers(0, 1 << 30, 80)
        b = np.where(rng.random(80) < 0.1, rng.integers(0, 1 << 30, 80), a)
        runs = [m for m in difflib.SequenceMatcher(None, a.tolist(), b.tolist(), autojunk=False).get_matching_blocks() if m.size >= 4]
        if len(runs) > 1:
            x = [m.a + i for m in runs for i in range(m.size - 3)]
            start, end, _, _, matched = substrings.align(a, b, x, x)
            assert matched == int((a[start:end] == b[start:end]).sum())


def test_threshold_of_least_cost():
    good, bad = np.array([0.3, 0.4, 0.4, 0.5, 0.9]), np.array([0.45, 0.6, 0.7, 0.8])
    price = lambda t, c: c * (good > t).mean() + (bad <= t).mean()
    for cost in (0.1, 1.0, 4.0, 100.0):
        found = quality_rules.least_cost(good, bad, cost)
        assert price(found, cost) == min(price(t, cost) for t in np.linspace(0.25, 1, 400))
    assert quality_rules.least_cost(good, bad[:0]) == 1.0 == quality_rules.least_cost(good[:0], bad)


def test_rules_reject_bad_rows_they_have_not_seen(spark):
    """Fitted on half of the labelled rows of a larger table; judged on the others, of those that pass the base rule."""
    sf_dir = "/root/testdata/sf0.1"
    labels = spark.read.parquet(f"{sf_dir}/labels.parquet")
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet").join(labels.select("doc_id").distinct(), "doc_id", "left_semi")
    half = F.col("doc_id") % 2 == 0
    judged = quality_rules.quality_rules(docs, labels.where(half)).where(~half & ~F.col("base_failed")).join(labels, "doc_id")
    share = {r["quality"]: r["kept"] for r in judged.groupBy("quality").agg(F.avg(F.col("kept").cast("int")).alias("kept")).collect()}
    assert share[1] >= 0.985 and share[0] <= 0.1, share


def test_rules_learn_from_all_labelled_rows(spark):
    """All bad rows lie beyond the 8000 labelled ids of least hash, which once were all that the fit saw."""
    last = [r["doc_id"] for r in spark.range(8200).select(F.col("id").alias("doc_id")).orderBy(F.xxhash64("doc_id").desc()).limit(150).collect()]
    bad = F.col("id").isin(last)
    word = lambda w: F.when(bad & (w % 2 == 0), F.concat(F.lit("#"), F.upper(F.hex(F.xxhash64("id", w))))).otherwise(F.concat(F.lit("w"), F.lower(F.hex(F.pmod(F.xxhash64("id", w), F.lit(99999))))))
    table = spark.range(8200).select(F.col("id").alias("doc_id"), F.array_join(F.transform(F.sequence(F.lit(1), F.lit(55)), word), " ").alias("text"), F.when(bad, 0).otherwise(1).alias("quality"))
    judged = quality_rules.quality_rules(table, table).join(table.select("doc_id", "quality"), "doc_id")
    share = {r["quality"]: r["kept"] for r in judged.groupBy("quality").agg(F.avg(F.col("kept").cast("int")).alias("kept")).collect()}
    assert share[1] >= 0.985 and share[0] <= 0.1, share


def test_threshold_from_sums_along_the_scores(spark):
    rng = np.random.default_rng(3)
    good, bad = np.round(rng.normal(0.4, 0.1, 3000), 3), np.round(rng.normal(0.6, 0.1, 700), 3)
    rows = spark.createDataFrame([(float(v), k) for k, part in ((1, good), (0, bad)) for v in part], "score double, good int")
    for cost in (1.0, 10.0):
        assert math.isclose(quality_rules.least_cost_of(rows, cost), quality_rules.least_cost(good, bad, cost))
    assert quality_rules.least_cost_of(rows.where("good = 1")) == 1.0 == quality_rules.least_cost_of(rows.limit(0))


def test_columns_of_the_fit_equal_the_features(spark):
    """The fit takes them from Spark: one Python worker a task, not two, where labels are joined by broadcast."""
    texts = [None, "", "#", "A B\nA B\nA B\n", "x" * 500, "é $ % word " * 30, "One line.\nOne line.\nand another, 1 < 2"]
    stats = quality_rules.text_statistics(spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string"))
    rows = stats.select("*", *quality_rules.feature_columns()).toPandas()
    assert (rows[list(quality_rules.FEATURES)].to_numpy() == quality_rules.features({c: rows[c].to_numpy() for c in stats.columns})).all()


@pytest.mark.parametrize("copies", [1, 3, 10])
def test_each_row_grows_trees(spark, copies):
    rows = spark.range(500).select(*[(F.col("id") % 250 + i).cast("double").alias(c) for i, c in enumerate(quality_rules.FEATURES)])
    got = quality_rules.dealt(rows, copies, 10).groupBy(*quality_rules.FEATURES).agg(F.count("*").alias("n"), F.count_distinct("tree").alias("trees")).collect()
    assert len(got) == 250 and {(r["n"], r["trees"]) for r in got} == {(2 * copies, copies)}


@pytest.mark.parametrize(("copies", "share"), [(12, 0.05), (40, 0.1)])
def test_families_of_edited_copies(spark, copies, share):
    """Passages of 100 words in more documents than make a seed rare, each edited on its own; an earlier copy must be found for nine in ten."""
    rng = np.random.default_rng(copies)
    rows, of = [], {}
    for f in range(6):
        passage = noise(rng, 100)
        for c in range(copies):
            edited = [w if rng.random() >= share else noise(rng, 1)[0] for w in passage]
            rows.append((1000 * c + f, " ".join([*noise(rng, 40), *edited, *noise(rng, 40)]), None, 1))
            of[1000 * c + f] = edited
    got = collections.defaultdict(set)
    for r in passages_of(spark, rows).collect():
        assert r["doc_id"] % 1000 == r["ref_doc_id"] % 1000
        got[r["doc_id"]].add(r["ref_doc_id"])
    same = lambda a, b: sum(x == y for x, y in zip(of[a], of[b], strict=True)) >= 80
    wanted = [d for d in of if any(e < d and e % 1000 == d % 1000 and same(d, e) for e in of)]
    assert len(wanted) > 5 * copies and len(got.keys() & set(wanted)) >= 0.9 * len(wanted), (len(got), len(wanted))


@pytest.mark.parametrize("n", [50, 53])
def test_runs_whose_parts_stand_in_older_documents(spark, n):
    rng = np.random.default_rng(n)
    rows = []
    for i in range(20):
        run = noise(rng, n)
        for o in range(12):
            cut = [*run[: n // 2], *noise(rng, 40), *run[n // 2 :]] if o % 2 else [*run[n // 3 :], *noise(rng, 40), *run[: n // 3]]
            rows.append((100 * i + o, " ".join([*noise(rng, 20), *cut, *noise(rng, 20)]), None, 1))
        rows += [(d + i, " ".join([*noise(rng, 25), *run, *noise(rng, 35)]), None, 1) for d in (10_000, 20_000)]
    got = {(r["doc_id"], r["ref_doc_id"], r["start_word"], r["end_word"]) for r in passages_of(spark, rows).where("doc_id >= 20000").collect()}
    assert {(20_000 + i, 10_000 + i, 25, 25 + n) for i in range(20)} <= got


def test_edited_passages_of_frequent_parts(spark):
    """All parts of a passage stand in ten older documents or more, none of which has enough of it: its edited copy still meets it."""
    rng = np.random.default_rng(11)
    rows = []
    for i in range(5):
        passage = noise(rng, 100)
        parts = [passage[b : b + 40] for b in range(0, 61, 6)]
        rows += [(1000 * i + 10 * f + o, " ".join([*noise(rng, 20), *part, *noise(rng, 20)]), None, 1) for f, part in enumerate(parts) for o in range(10)]
        edited = [noise(rng, 1)[0] if k % 16 == 8 else w for k, w in enumerate(passage)]
        rows += [(d + i, " ".join([*noise(rng, 25), *body, *noise(rng, 35)]), None, 1) for d, body in ((10_000, passage), (20_000, edited))]
    got = {(r["doc_id"], r["ref_doc_id"], r["start_word"], r["end_word"]) for r in passages_of(spark, rows).where("doc_id >= 10000").collect()}
    assert got == {(20_000 + i, 10_000 + i, 25, 125) for i in range(5)}


def test_probes_meet_all_who_share_a_quarter_of_a_window():
    rng = np.random.default_rng(12)
    for _ in range(200):
        x = np.flatnonzero(rng.random(90) < rng.choice([0.2, 0.5, 0.9]))
        probe = substrings.probes(x, rng.integers(2, 40, len(x)))
        for _ in range(20):
            shared = rng.random(len(x)) < rng.choice([0.2, 0.5, 0.8])
            if substrings.crowded(x[shared]).any():
                assert (probe & shared).any()


def test_a_common_line_brings_no_pairs_of_texts(spark, monkeypatch):
    """Texts that share one line only do not meet, however many have it; a passage around that line is found."""
    rng = np.random.default_rng(13)
    line, made, write = noise(rng, 20), {}, substrings.staged
    monkeypatch.setattr(substrings, "staged", lambda df, name: made.setdefault(name, write(df, name)) if name == "both" else write(df, name))
    rows = [(i, " ".join([*noise(rng, 60), *line, *noise(rng, 60)]), None, 1) for i in range(40)]
    around = noise(rng, 15), noise(rng, 25)
    rows += [(100 + i, " ".join([*noise(rng, 60), *(w if k % 4 else noise(rng, 1)[0] for k, w in enumerate(around[0])), *line, *(w if k % 4 != 3 else noise(rng, 1)[0] for k, w in enumerate(around[1])), *noise(rng, 60)]), None, 1) for i in range(2)]
    got = {(r["doc_id"], r["ref_doc_id"]) for r in passages_of(spark, rows).collect()}
    assert got == {(101, 100)} and made["both"].isEmpty()


def test_surroundings_have_no_less_in_common_than_their_words():
    rng = np.random.default_rng(14)
    for _ in range(200):
        a, b = (rng.integers(0, 40, 300).astype(np.uint32) for _ in range(2))
        x, y, reach = rng.integers(0, 296, 2), rng.integers(0, 296, 3), int(rng.integers(5, 80))
        near = lambda w, at, reach=reach: collections.Counter(w[sorted({i for p in at.tolist() for i in range(max(p - reach, 0), min(p + 4 + reach, 300))})].tolist())
        (h, lost), (g, _) = substrings.surroundings(a, x, reach), substrings.surroundings(b, y, reach)
        most = len(np.intersect1d(h, g)) + lost
        assert most >= min((near(a, x) & near(b, y)).total(), 50) and len(h) + lost == sum(min(n, 50) for n in near(a, x).values())


@pytest.mark.parametrize("shared", [None, 5])
def test_many_texts_under_one_id(spark, shared):
    """Each is read once for its own passages, however many share the id."""
    rng = np.random.default_rng(4)
    rows, wanted = [], set()
    for i in range(400):
        passage = noise(rng, 55)
        rows.append((shared, " ".join([*noise(rng, 10), *passage]), None, 1))
        rows.append((1000 + i, " ".join([*passage, *noise(rng, 10)]), None, 1))
        wanted.add((1000 + i, shared, 0, 55, 10, 65))
    got = {(r["doc_id"], r["ref_doc_id"], r["start_word"], r["end_word"], r["ref_start"], r["ref_end"]) for r in passages_of(spark, rows).collect()}
    assert got == wanted


def test_chains_are_aligned_together_as_alone():
    rng = np.random.default_rng(91)

    def edited(words):
        out = [int(rng.integers(1000)) if rng.random() < 0.1 else w for w in words if rng.random() > 0.03]
        return np.array([*rng.integers(0, 4, rng.integers(0, 90)), *out, *rng.integers(0, 4, rng.integers(0, 90))], "<u4")

    rows = []
    for _ in range(60):
        base = rng.integers(0, rng.choice([3, 1000]), int(rng.integers(20, 150))).tolist()
        a, b = edited(base), edited(base)
        same = a[:, None] == b[None, :]
        met = np.argwhere(same[:-3, :-3] & same[1:-2, 1:-2] & same[2:-1, 2:-1] & same[3:, 3:])[:200]
        chains = substrings.chain(met[:, 0].tolist(), met[:, 1].tolist())[:3]
        rows += [(a, b, met[c, 0], met[c, 1], *(int(v) for v in 7 * rng.integers(0, 2, 4))) for c in chains]
    flat, ends = [np.concatenate([r[i] for r in rows]) for i in range(4)], [np.cumsum([0, *(len(r[i]) for r in rows)]) for i in range(3)]
    got = substrings.align_all(flat[0], ends[0], flat[1], ends[1], flat[2], flat[3], ends[2], *(np.array([r[i] for r in rows]) for i in range(4, 8)))
    want = [substrings.align(a, b, x.tolist(), y.tolist(), substrings.K, *r) for a, b, x, y, *r in rows]
    assert [None if open_ else tuple(v) for *v, open_ in zip(*(c.tolist() for c in got), strict=True)] == want
    assert 10 < sum(w is None for w in want) < len(want) - 10


def test_longest_common_subsequences_by_bits():
    rng = np.random.default_rng(92)
    for _ in range(200):
        a, b = rng.integers(0, 5, rng.integers(1, 90)), rng.integers(0, 5, rng.integers(1, 90))
        row = [0] * (len(b) + 1)
        for v in a:
            new = [0]
            for j, w in enumerate(b):
                new.append(row[j] + 1 if v == w else max(new[-1], row[j + 1]))
            row = new
        assert substrings._common(a, b) == row[-1] or len(a) == len(b) and (a == b).sum() >= len(a) - 2


def test_candidates_meet_in_one_row_a_pair(spark, monkeypatch):
    """However many places two texts share, the join behind the candidates makes a row for them; none of the places is lost."""
    rng = np.random.default_rng(93)
    h, ref = rng.integers(-9, 9, 400), rng.integers(-9, 9, 300)
    at, ref_at = np.array([0, 90, 90, 250, 400]), np.array([0, 50, 120, 200, 300])
    got = sorted(zip(*(c.tolist() for c in substrings.shared_places(h, at, ref, ref_at)), strict=True))
    assert got == [(p, i, j) for p in range(4) for i in range(at[p], at[p + 1]) for j in range(ref_at[p], ref_at[p + 1]) if h[i] == ref[j]]

    chains = substrings._pair_chains

    def once(batches):
        met = set()
        for batch in batches:
            pairs = list(zip(*(batch.column(c).to_pylist() for c in ("doc_id", "part", "ref_doc", "ref_part")), strict=True))
            assert len(pairs) == len({*pairs} - met)
            met |= {*pairs}
            yield from chains(iter([batch]))

    monkeypatch.setattr(substrings, "_pair_chains", once)
    rows = []
    for i in range(2):
        passage = noise(rng, 100)
        parts = [passage[b : b + 40] for b in range(0, 61, 6)]
        rows += [(1000 * i + 100 * p + n, " ".join([*noise(rng, 30), *part, *noise(rng, 30)]), None, 1) for p, part in enumerate(parts) for n in range(10)]
        edited = [noise(rng, 1)[0] if k % 16 == 8 else w for k, w in enumerate(passage)]
        rows += [(d + i, " ".join([*noise(rng, 25), *body, *noise(rng, 35)]), None, 1) for d, body in ((10_000, passage), (20_000, edited))]
    got = {(r["doc_id"], r["ref_doc_id"]) for r in passages_of(spark, rows).where("doc_id >= 10000").collect()}
    assert {(20_000 + i, 10_000 + i) for i in range(2)} <= got
