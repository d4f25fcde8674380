"""Readers, writers, streams and small functions that no catalogue query reaches, each on small inputs."""

from __future__ import annotations

import datetime as dt
import json
import struct

import numpy as np
import pytest
from pyspark.sql import functions as F

import buildlake
from buildlake.functions import text
from buildlake.operators import corpus, lookup, numbering, projects
from buildlake.sources import addresses, crawl, files, images, roles, staging
from buildlake.streaming import jobs


def stream_of(spark, folder, rows, schema, per_trigger=None):
    spark.createDataFrame(rows, schema).coalesce(1).write.mode("append").parquet(folder)
    return jobs.messages(spark, folder, spark.read.parquet(folder).schema, "parquet", per_trigger)


def collected(stream, checkpoint, mode="append"):
    out = []
    jobs.run_available(stream, checkpoint, lambda batch, k: out.extend(tuple(r) for r in batch.collect()), mode)
    return out


def at(minute, second=0):
    return dt.datetime(2024, 1, 1, minute // 60, minute % 60, second)


def test_replies_are_filtered_and_routed(spark, tmp_path):
    stream = stream_of(spark, str(tmp_path / "in"), [(1, 3, 7), (2, 6, 7), (3, 0, None)], "id long, status int, opt_id int")
    got = collected(jobs.routed(jobs.accepted_replies(stream)).select("id", "route"), str(tmp_path / "ck"))
    assert sorted(got) == [(1, "worker.7"), (3, None)]


def test_repetitions_within_the_delay_are_dropped(spark, tmp_path):
    rows = [("a", at(0)), ("a", at(5)), ("b", at(1)), ("a", at(9))]
    stream = stream_of(spark, str(tmp_path / "in"), rows, "key string, ts timestamp")
    got = collected(jobs.once_per_key(stream, ["key"], "ts"), str(tmp_path / "ck"))
    assert sorted(k for k, _ in got) == ["a", "b"]


def test_sliding_counts_of_closed_windows(spark, tmp_path):
    rows = [("a", at(0)), ("a", at(30)), ("b", at(61)), ("a", at(600))]
    counted = jobs.pane_counts(stream_of(spark, str(tmp_path / "in"), rows, "key string, ts timestamp"), "ts", "key")
    panes = spark.createDataFrame(collected(counted, str(tmp_path / "ck"), "update"), "pane timestamp, key string, n long")
    for panes_in_window in (12, 288):
        got = {(r["until"], r["key"]): r["n"] for r in jobs.last_counts(panes, "key", 300 * panes_in_window).collect()}
        want = {}
        for k, t in rows:
            for s in range(panes_in_window):
                end = dt.datetime.fromtimestamp((t.timestamp() // 300 + 1 + s) * 300)
                want[end, k] = want.get((end, k), 0) + 1
        assert got == want


def test_heartbeats_add_up(spark, tmp_path):
    folder = str(tmp_path / "in")
    stream_of(spark, folder, [("w1", at(0)), ("w1", at(2)), ("w2", at(1))], "uuid string, ts timestamp")
    stream = stream_of(spark, folder, [("w1", at(3))], "uuid string, ts timestamp", 1)
    got = collected(jobs.heartbeats(stream), str(tmp_path / "ck"), "update")
    assert ("w2", at(1), at(1), 1) in got and max(r for r in got if r[0] == "w1") == ("w1", at(0), at(3), 3)


def test_json_arrays_and_folder_sink(spark, tmp_path):
    stream = stream_of(spark, str(tmp_path / "in"), [('[{"k": 1}, {"k": 2}]',), ("[]",), ("oops",)], "value string")
    jobs.to_folder(jobs.decoded_batches(stream, "value", "struct<k: int>"), str(tmp_path / "out"), str(tmp_path / "ck")).awaitTermination()
    assert sorted(r["k"] for r in spark.read.parquet(str(tmp_path / "out")).where("k is not null").collect()) == [1, 2]


def test_table_versions_touch_their_buckets_only(spark, tmp_path):
    table = jobs.VersionedTable(spark, str(tmp_path / "t"), spark.createDataFrame([], "_id long, v long").schema, buckets=8)
    table.write(spark.createDataFrame([(i, 0) for i in range(40)], "_id long, v long"), 0)
    merge = table.merge_updates("_id", ["n"])
    for batch in (1, 2, 2, 3):  # the second batch is replayed
        merge(spark.createDataFrame([(5, 10 * batch, 1)], "_id long, v long, n long"), batch)
    got = {r["_id"]: r["v"] for r in table.before().collect()}
    assert got == {i: 30 if i == 5 else 0 for i in range(40)}
    assert sorted(map(len, table.versions().values())) == [1] * 7 + [2]
    assert {r["v"] for r in table.before(3).where("_id = 5").collect()} == {20}
    with pytest.raises(ValueError):
        table.insert_new(["v"], ["v"])


def test_files_and_layouts(spark, tmp_path):
    (tmp_path / "f").mkdir()
    (tmp_path / "f" / "a.bin").write_bytes(b"\x7fELF" + bytes(20))
    (tmp_path / "f" / "b.txt").write_bytes(b"x")
    assert [r["length"] for r in files.binary_files(spark, str(tmp_path / "f"), "*.bin").collect()] == [24]
    names = spark.createDataFrame([(1, "ä a.exe"), (2, "b")], "id long, name string")
    files.write_hashed(names, "name", str(tmp_path / "h"))
    back = spark.read.option("basePath", str(tmp_path / "h")).parquet(str(tmp_path / "h"))
    assert {(r["id"], len(r["rest"])) for r in back.collect()} == {(1, 30), (2, 30)} and "prefix" in back.columns
    for _ in range(2):
        files.append_rows(names, str(tmp_path / "rows"))
    assert spark.read.parquet(str(tmp_path / "rows")).columns == ["name"] and spark.read.parquet(str(tmp_path / "rows")).count() == 4
    files.recreate(spark, names.schema, str(tmp_path / "rows"))
    assert spark.read.parquet(str(tmp_path / "rows")).count() == 0
    files.write_json_documents(names, str(tmp_path / "json"))
    assert spark.read.json(str(tmp_path / "json")).count() == 2
    (tmp_path / "x.xml").write_text("<r><row><a>1</a></row><row><a>2</a></row></r>")
    schema = spark.createDataFrame([], "a int").schema
    assert sorted(r["a"] for r in files.xml_rows(spark, str(tmp_path / "x.xml"), "row", schema).collect()) == [1, 2]
    found = files.catalogue_rows(spark.createDataFrame([('{"Source": [{"Name": "zlib"}, {"Name": "fmt"}]}',), ("{}",)], ["j"]), "j")
    assert sorted(r["url"] for r in found.collect()) == ["catalogue://fmt", "catalogue://zlib"]
    documents = spark.createDataFrame([("9dd4e461268c8034f5c8564e155c67a6_x.json",), ("q.json",)], ["name"])  # md5 of x
    assert files.documents_of_project(documents, "x", "name").count() == 1
    assert files.identified_by(spark.createDataFrame([("u", None, "Debug")], "URL string, Platform string, Build_mode string")).first()["identifier"].endswith("_unknown_Debug")


def test_database_tables(spark, tmp_path):
    url = f"jdbc:derby:{tmp_path}/db"
    spark.range(20).selectExpr("cast(id as int) as id", "'n' as name").write.jdbc(f"{url};create=true", "items")
    assert files.jdbc_table(spark, url, "items").count() == 20
    parts = files.jdbc_table(spark, url, "items", "id", (0, 20, 4))
    assert parts.rdd.getNumPartitions() == 4 and parts.count() == 20


def test_small_functions(spark):
    row = lambda *c: spark.range(1).select(*c).first()[:]
    assert row(text.inline_name(F.lit("/Ob1")), text.inline_name(F.lit("?")))[1] == ""
    assert row(text.first_match(F.lit("x.sln"), {"win": r"\.sln$", "all": "."}, "none"), text.first_match(F.lit(""), {"a": "a"}, "none")) == ("win", "none")
    assert row(projects.condition_of(F.lit("'$(Configuration)|$(Platform)'=='Debug|Win32'")))[0][:] == ("Debug", "Win32")
    assert projects.strip_bom("﻿<a/>") == "<a/>" == projects.strip_bom("<a/>")


def test_numbers_follow_the_order(spark):
    rng = np.random.default_rng(2)
    rows = [(int(k), int(v)) for k, v in zip(rng.integers(0, 3, 300), rng.permutation(300), strict=True)] + [(0, None), (7, 5)]
    table = spark.createDataFrame(rows, "k long, v long").repartition(7)
    got = {(r["k"], r["v"]): r["n"] for r in numbering.with_keys(table, "n", ["v"], ["k"]).collect()}
    for k in {k for k, _ in rows}:
        inside = sorted((v for g, v in rows if g == k), key=lambda v: -1 if v is None else v)
        assert [got[k, v] for v in inside] == list(range(1, len(inside) + 1))
    sums = {r["v"]: r["s"] for r in numbering.running_sums(table.where("v is not null").select("v").distinct(), "s", F.col("v"), ["v"]).collect()}
    assert all(s == v * (v + 1) // 2 for v, s in sums.items())
    assert numbering.with_keys(table.limit(0), "n", ["v"]).count() == 0


def test_blacklists_by_brute_force(spark, capsys):
    names = ["one two three", "a one  two three b", "two", "xone two threey", "", "a", "ab", "xabcdy", "abcd", "bcde", "zzz", None, "long name with abcd inside", "日本語テキスト"]
    for items in ([""], ["abcd"], ["b"], ["abcdefgh", "本語テキ"], ["zzzz", None], ["one two three"], ["one  two three"], ["q one two three r", "zz"], ["", "zzz"], ["日", "キ", "x"], ["abc", "bcd", "bcde f", "wo t", "aaaa"], []):
        want = sorted((n is None, n or "") for n in names if n is None or not any(i is not None and (i in n or n in i) for i in items))
        table = spark.createDataFrame([(n, "c") for n in names], "name string, gram string")
        found = lookup.without_blacklisted(table, F.col("name"), spark.createDataFrame([(i,) for i in items], "item string"), "item")
        found.explain()
        plan = capsys.readouterr().out
        assert "Join" in plan and "NestedLoop" not in plan and "Cartesian" not in plan
        assert found.columns == table.columns and sorted((r["name"] is None, r["name"] or "") for r in found.collect()) == want


def test_crowded_windows_are_split():
    def fetch(since, until, page):
        rows = [{"name": str(t)} for t in range(since, until)]
        return len(rows), rows[(page - 1) * 100 : page * 100]

    assert sorted(int(r[0]) for r in crawl.fetched(fetch, 0, 5000)) == list(range(5000))


def executable(sections, size, wide):
    """A portable executable of sections (address, virtual size, bytes)."""
    optional = 240 if wide else 224
    head = bytearray(0x400)
    head[:2], head[0x3C:0x40] = b"MZ", struct.pack("<I", 0x80)
    head[0x80:0x84], head[0x86:0x88], head[0x94:0x96] = b"PE\0\0", struct.pack("<H", len(sections)), struct.pack("<H", optional)
    struct.pack_into("<II", head, 0x98 + 56, size, 0x400)
    out = head
    for i, (address, virtual, body) in enumerate(sections):
        struct.pack_into("<IIII", head, 0x98 + optional + 40 * i + 8, virtual, address, len(body), len(out))
        out = out + body
    out[: len(head)] = head
    return bytes(out)


def test_images_lie_as_in_memory(spark):
    data = executable([(0x1000, 5, b"codecode"), (0x2000, 0x100, b"data")], 0x3000, wide=True)
    rows = [("a", data), ("b", b"MZ"), ("c", None), ("d", executable([], 0x400, wide=False))]
    got = {r["file_name"]: r for r in images.mapped_images(spark.createDataFrame([(n, None if b is None else bytearray(b)) for n, b in rows], "file_name string, content binary")).collect()}
    image = bytes(got["a"]["content"])
    assert len(image) == 0x3000 and image[0x1000:0x1008] == b"codec\0\0\0" and image[0x2000:0x2005] == b"data\0" and image[:2] == b"MZ"
    assert got["b"]["error"] and got["c"]["error"] and got["b"]["content"] is None and len(got["d"]["content"]) == 0x400


def test_bytes_by_address_equal_the_image(spark, tmp_path):
    """Slices by section intervals are those of the whole image; sections overlap, touch, are cut short, lie behind the image."""
    rng = np.random.default_rng(3)
    blobs, rows = {}, []
    for f in range(12):
        sections = [(int(rng.integers(0, 60)) * 16 + 0x100, int(rng.integers(0, 90)), rng.bytes(int(rng.integers(0, 80)))) for _ in range(int(rng.integers(0, 6)))]
        blob = executable(sections, 0x500, wide=bool(f % 2))
        blobs[f"f{f}.exe"] = blob[: len(blob) - 7] if f == 5 else blob
        rows += [(f"f{f}.exe", f"g{k}", [{"start": int(a), "end": int(a + rng.integers(-5, 200))} for a in rng.integers(0, 0x520, int(rng.integers(1, 4)))]) for k in range(15)]
    rows += [("f0.exe", "none", None), ("f0.exe", "g0", rows[0][2]), ("bad.exe", "g", rows[0][2]), ("lost.exe", "g", rows[0][2])]
    blobs |= {"bad.exe": b"MZ" + bytes(90)}
    table = spark.createDataFrame([(n, bytearray(b)) for n, b in blobs.items()], "file_name string, content binary")
    functions = spark.createDataFrame(rows, "file_name string, name string, segments array<struct<start: long, end: long>>")
    want = set()
    for name, g, segments in rows:
        if name in blobs and name != "bad.exe":
            image = images.image_of(blobs[name])
            ends = [v for s in segments or [] for v in (s["start"], s["end"])]
            want.add((name, g, tuple(image[s["start"] : max(s["start"], s["end"])] for s in segments or []), image[min(ends) : max(ends)] if ends else None))
    got = [(r["file_name"], r["name"], tuple(bytes(s) for s in r["slices"]), None if r["span"] is None else bytes(r["span"])) for r in addresses.mapped_bytes(functions, table).collect()]
    assert len(got) == len(want) and set(got) == want
    errors = {r["file_name"]: r["error"] for r in addresses.mapped_files(table.union(spark.createDataFrame([("null", None)], table.schema)).union(spark.createDataFrame([("cut", bytearray(blobs["f1.exe"][:0x100]))], table.schema))).collect()}
    assert {n for n, e in errors.items() if e} >= {"bad.exe", "null"} and errors["f1.exe"] is None


def test_corpus_loader(spark, tmp_path):
    """From a folder of documents and executables to functions and their bytes."""
    code = bytes(range(64))
    for n in "ab":
        (tmp_path / n).mkdir()
        (tmp_path / n / f"{n}.exe").write_bytes(executable([(0x1000, 64, code)], 0x2000, wide=True))
        info = [{"rva_start": "00001004", "rva_end": "00001008"}, {"rva_start": "00001010", "rva_end": "00001012"}]
        (tmp_path / n / f"{n}.json").write_text(json.dumps({"URL": n, "Binary_info_list": [{"file": f"c:\\{n}.exe", "functions": [{"function_name": "f", "function_info": info}]}]}))
    got = {r["file_name"]: ([bytes(s) for s in r["slices"]], bytes(r["span"])) for r in addresses.load_corpus(spark, str(tmp_path)).collect()}
    assert got == {f"{n}.exe": ([code[4:8], code[16:18]], code[4:18]) for n in "ab"}
    assert [r["file_name"] for r in addresses.load_corpus(spark, str(tmp_path), limit=1).collect()] == ["a.exe"]


def test_listed_by_ending_and_marked(spark):
    found = spark.createDataFrame([("d/out/a.exe",), ("x/a.exe",), ("b.dll",)], ["path"])
    listed = spark.createDataFrame([("out/a.exe", 0, "first"), ("a.exe", 1, "last"), ("c.exe", 2, "none")], "ending string, at int, meta string")
    first = {r["path"]: r["meta"] for r in corpus.suffix_listed(found, "path", listed, "ending").collect()}
    last = {r["path"]: r["meta"] for r in corpus.suffix_listed(found, "path", listed, "ending", last=True).collect()}
    assert first == {"d/out/a.exe": "first", "x/a.exe": "last"} and last == {"d/out/a.exe": "last", "x/a.exe": "last"}
    table = spark.createDataFrame([(1, None), (2, False), (3, True)], "_id int, disasmed boolean")
    assert {r["_id"]: r["disasmed"] for r in corpus.marked_disassembled(table, table.where("_id = 1")).collect()} == {1: True, 2: False, 3: True}


def test_package_names_and_farm(spark):
    assert set(buildlake.__all__) <= set(dir(buildlake))
    with pytest.raises(ValueError):
        buildlake.Farm(spark).run()
    base = buildlake.Farm(spark).sizes(1, 2).folders_of(3)
    assert base.only(lambda d: d).steps and not base.steps and (base.least_kb, base.most_kb, base.least_files) == (1, 2, 3)


def test_staged_tables_are_in_the_shared_folder(spark, sf_dir):
    region = roles.load(spark, sf_dir, "region")
    base = spark.conf.get("spark.checkpoint.dir")
    assert staging.work_folder(spark, "x").startswith(base) and staging.staged(region, "region").count() == region.count()
