"""Streams that keep state or write twice: crawl, outbox, heartbeats, panes, dispatch; each with a restart or a broken batch."""

from __future__ import annotations

import datetime as dt
import hashlib
import os
import random

import pytest

from buildlake.operators import chunks
from buildlake.sources import crawl, outbox
from buildlake.streaming import dispatch, jobs, workers

BEGIN = 1_600_000_200


def frontier(folder):
    with open(f"{folder}/frontier") as f:
        return int(f.read())


def fragile(folder):
    """A fetcher that notes the process of each window and breaks while the file ``broken`` is there."""

    def fetch(since, until, page):
        if os.path.exists(f"{folder}/broken") and until > BEGIN + 600 * 250:
            raise OSError("service unavailable")
        with open(f"{folder}/pids", "a") as f:
            f.write(f"{os.getpid()}\n")
        return crawl.sample_fetch(since, until, page)

    return fetch


def test_crawl_goes_on_where_it_was_stopped(spark, tmp_path):
    """Executors fetch; a batch whose fetcher breaks leaves nothing and is read again after a restart."""
    folder, box = str(tmp_path), str(tmp_path / "outbox")

    def run(until):
        (tmp_path / "frontier").write_text(str(until))
        stream = crawl.crawl_stream(spark, BEGIN, None, f"{__name__}:frontier", 600 * 50, f"{__name__}:fragile", folder)
        outbox.to_outbox(stream.writeStream, box, f"{folder}/checkpoint").trigger(once=True).start().awaitTermination()

    names = lambda: sorted(int(r["name"][4:]) for r in spark.read.schema("name string").json(box).collect())
    first = BEGIN // 600
    run(BEGIN + 600 * 200)
    assert names() == list(range(first + (BEGIN % 600 > 0), first + 200 + (BEGIN % 600 > 0)))
    (tmp_path / "broken").write_text("")
    with pytest.raises(Exception, match="service unavailable"):
        run(BEGIN + 600 * 400)
    assert len(names()) == 200
    os.remove(tmp_path / "broken")
    run(BEGIN + 600 * 400)
    run(BEGIN + 600 * 400)  # nothing new
    assert len(names()) == 400 == len(set(names())) and not [f for f in os.listdir(box) if f.startswith(".")]
    pids = set((tmp_path / "pids").read_text().split())
    assert len(pids) > 1 and str(os.getpid()) not in pids
    with pytest.raises(ValueError):
        crawl.crawl_stream(spark, BEGIN)


def test_outbox_names_and_aborts(tmp_path):
    """A replayed batch replaces its own files; an aborted one is removed; empty tasks leave no file."""
    writer = outbox.OutboxWriter(str(tmp_path))
    hidden = lambda text: (tmp_path / ".x.json").write_text(text) and outbox.Written(3, f"{tmp_path}/.x.json")
    for text in ("old", "new"):
        writer.commit([hidden(text), outbox.Written(4, None), None], 7)
    assert [(p.name, p.read_text()) for p in tmp_path.iterdir()] == [("batch-000000007-00003.json", "new")]
    (tmp_path / ".killed.json").write_text("part of a li")
    writer.abort([hidden("lost"), None], 8)
    assert len(list(tmp_path.iterdir())) == 1


# --- workers: state with a life cycle


def at(minute):
    return dt.datetime(2024, 1, 1, minute // 60, minute % 60)


def appended(spark, folder, rows, schema):
    """One more file of an inbox, and the inbox as a stream that takes a file a batch."""
    spark.createDataFrame(rows, schema).coalesce(1).write.mode("append").parquet(folder)
    return jobs.messages(spark, folder, spark.createDataFrame([], schema).schema, "parquet", 1)


def test_workers_join_expire_and_come_back(spark, tmp_path):
    """Restarted from its checkpoint after every ping: state, timers and watermark go on."""
    folder, told = str(tmp_path), []

    def ping(*rows):
        stream = workers.worker_events(appended(spark, f"{folder}/in", rows, "uuid string, ts timestamp"), ttl=600, delay="60 seconds")
        with workers.timed_state(spark):
            jobs.run_available(stream, f"{folder}/ck", lambda batch, k: told.extend((r["uuid"], r["event"], r["pings"], r["last"]) for r in batch.collect()))
        out = told.copy()
        told.clear()
        return out

    assert sorted(ping(("a", at(0)), ("a", at(2)), ("b", at(1)))) == [("a", "joined", 2, at(2)), ("b", "joined", 1, at(1))]
    assert ping(("a", at(8))) == [("a", "seen", 3, at(8))]
    # the watermark passes b's last ping by more than the time to live; a's timer has moved
    assert sorted(ping(("c", at(15)))) == [("b", "expired", 1, at(1)), ("c", "joined", 1, at(15))]
    # too late for the watermark: no event, and a is not kept alive by it
    assert ping(("a", at(9))) == []
    got = ping(("b", at(30)))
    assert ("b", "joined", 1, at(30)) in got and {g[:2] for g in got} == {("b", "joined"), ("a", "expired"), ("c", "expired")}
    assert spark.conf.get("spark.sql.streaming.stateStore.providerClass", "none").endswith("HDFSBackedStateStoreProvider") or spark.conf.get("spark.sql.streaming.stateStore.providerClass", None) is None
    events = spark.createDataFrame([("a", "joined", at(1)), ("a", "expired", at(1)), ("b", "joined", at(1)), ("b", "expired", at(1)), ("b", "joined", at(30))], "uuid string, event string, last timestamp")
    assert [(r["uuid"], r["last"]) for r in workers.live(events).collect()] == [("b", at(30))]


# --- dispatch and scraping: batches that break off between their writes


def options_of(spark):
    return spark.createDataFrame([(1, "linux", "make", True), (2, "linux", "cmake", True), (3, "windows", "sln", False)], "_id int, platform string, build_system string, enable boolean")


def test_a_dispatch_that_breaks_off_is_repeated_alike(spark, tmp_path, monkeypatch):
    schema = "_id int, priority int, clone_status int, build_status int, build_opt_id int, repo_id int, mod_timestamp long"
    rows = [(i, i % 3, 1 if i % 5 else 0, 0, i % 3 + 1, i % 7, 0) for i in range(60)]
    projects = spark.createDataFrame([(i, f"r{i}", f"u{i}", "make") for i in range(7)], "_id int, name string, url string, build_system string")
    results = []
    for breaks in (False, True):
        folder = f"{tmp_path}/{breaks}"
        table = jobs.VersionedTable(spark, f"{folder}/statuses", spark.createDataFrame([], schema).schema, ["_id"], buckets=4)
        table.write(spark.createDataFrame(rows, schema), 0)
        sink = dispatch.dispatcher(table, projects, options_of(spark), f"{folder}/outbox")
        for n, asked in enumerate([[(1, 100), (2, 100)], [(2, 200), (2, 201), (3, 200)], [(1, 300), (None, 300)]]):
            stream = appended(spark, f"{folder}/in", asked, "opt_id int, ts long")
            if breaks and n == 1:
                with monkeypatch.context() as m:
                    m.setattr(table, "write", lambda *_: (_ for _ in ()).throw(OSError("lost")))
                    with pytest.raises(Exception, match="lost"):
                        jobs.run_available(stream, f"{folder}/ck", lambda batch, k: sink(batch, k + 1))
                assert spark.read.parquet(f"{folder}/outbox").where("batch = 2").count() == 1  # emitted, not yet marked
            jobs.run_available(stream, f"{folder}/ck", lambda batch, k: sink(batch, k + 1))
        sent = sorted((r["batch"], r["opt_id"], r["task_id"], r["msg_time"]) for r in spark.read.parquet(f"{folder}/outbox").collect())
        marked = sorted((r["_id"], r["build_status"], r["mod_timestamp"]) for r in table.before().collect())
        results.append((sent, marked))
    assert results[0] == results[1]
    queue = lambda o: [r[0] for r in sorted(rows, key=lambda r: (-r[1], r[0])) if r[4] == o and r[2] == 1]
    assert results[0][0] == [(1, 1, queue(1)[0], 100), (1, 2, queue(2)[0], 100), (2, 2, queue(2)[1], 201), (3, 1, queue(1)[1], 300)]
    assert {i for i, s, _ in results[0][1] if s == 1} == {t for _, _, t, _ in results[0][0]} and len(results[0][1]) == 60


def test_scraped_rows_fan_out_in_their_batch(spark, tmp_path, monkeypatch):
    project_schema, status_schema = "_id long, url string, build_system string", "_id long, repo_id long, build_opt_id int, clone_status int, build_status int, priority int, mod_timestamp long"
    results = []
    for breaks in (False, True):
        folder = f"{tmp_path}/{breaks}"
        projects, statuses = (jobs.VersionedTable(spark, f"{folder}/{n}", spark.createDataFrame([], s).schema, ["_id"], buckets=4) for n, s in (("p", project_schema), ("s", status_schema)))
        sink = dispatch.ingester(projects, statuses, options_of(spark))
        for n, scraped in enumerate([[("a", "make"), ("b", "cmake"), ("a", "make")], [("b", "cmake"), ("c", "make")], [("a", "make")]]):
            stream = appended(spark, f"{folder}/in", scraped, "url string, build_system string")
            if breaks and n == 1:
                with monkeypatch.context() as m:
                    m.setattr(statuses, "write", lambda *_: (_ for _ in ()).throw(OSError("lost")))
                    with pytest.raises(Exception, match="lost"):
                        jobs.run_available(stream, f"{folder}/ck", sink)
            jobs.run_available(stream, f"{folder}/ck", sink)
        urls = {r["_id"]: r["url"] for r in projects.before().collect()}
        results.append((sorted(urls.values()), sorted((urls[r["repo_id"]], r["build_opt_id"], r["clone_status"]) for r in statuses.before().collect())))
    # "make" is inside both "make" and "cmake"
    assert results[0] == results[1] == (["a", "b", "c"], [("a", 1, 0), ("a", 2, 0), ("b", 2, 0), ("c", 1, 0), ("c", 2, 0)])


# --- binary chunks


def test_digests_of_chunks(spark):
    """Any order; chunks lost, sent again, sent again with other content; empty and null ones."""
    rng = random.Random(1)
    rows, want = [], {}
    for name in ("hot", "a", "ü", None, "empty"):
        parts = [rng.randbytes(rng.randrange(50)) for _ in range(400 if name == "hot" else 9)] if name != "empty" else [b""]
        kept = [i for i in range(len(parts)) if i in (0, 3, len(parts) - 1) or rng.random() < 0.8]
        again = rng.sample(kept, len(kept) // 3)
        rows += [(name, i, bytearray(parts[i]) if parts[i] else None) for i in kept + again]
        whole = b"".join(parts[i] for i in kept)
        want[name] = [len(kept), len(whole), hashlib.sha256(whole).hexdigest(), len(parts) - len(kept), len(again), 0]
    rows += [("ü", 3, bytearray(b"\xff" * 60)), ("a", None, None), ("a", -1, None)]
    want["ü"][4:] = [want["ü"][4] + 1, 1]  # the chunk of less content counts
    table = spark.createDataFrame(rows, "name string, seq long, content binary").repartition(5)
    got = {r["name"]: [r[c] for c in ("chunks", "n_bytes", "sha256", "missing", "repeated", "conflicting")] for r in chunks.chunk_digests(table).collect()}
    assert got == want
    places = {}
    for r in chunks.placed_chunks(table).collect():
        places.setdefault(r["name"], []).append((r["seq"], r["place"], bytes(r["content"])))
    assert places.keys() == want.keys()
    for name, parts in places.items():
        parts.sort()
        assert hashlib.sha256(b"".join(c for *_, c in parts)).hexdigest() == want[name][2]
        assert [p for _, p, _ in parts] == [sum(len(c) for *_, c in parts[:i]) for i in range(len(parts))]
    assert chunks.chunk_digests(table.limit(0)).count() == 0 == chunks.placed_chunks(table.limit(0)).count()


# --- panes and late rows


def test_panes_leave_the_state_and_late_rows_are_kept_apart(spark, tmp_path):
    folder = str(tmp_path)
    schema = "key string, ts timestamp"
    table = jobs.VersionedTable(spark, f"{folder}/panes", spark.createDataFrame([], "pane timestamp, key string, n long").schema, ["pane"])
    progress = jobs.VersionedTable(spark, f"{folder}/progress", spark.createDataFrame([], "id int, newest timestamp").schema, ["id"])
    seen = {"on time": [], "late": []}
    note = lambda name: lambda rows, k: seen[name].extend((k, r["key"], r["ts"]) for r in rows.collect())
    parted = jobs.late_apart(note("on time"), note("late"), "ts", 600, progress)
    held = []
    for n, rows in enumerate([[("a", at(1)), ("a", at(3)), ("b", at(2))], [("a", at(300)), ("a", at(4))], [("a", at(5)), ("a", at(292)), ("b", None)]]):
        stream = appended(spark, f"{folder}/in", rows, schema)
        query = jobs.run_available(jobs.pane_counts(stream, "ts", "key"), f"{folder}/ck", table.upsert(["pane", "key"]), "update")
        held.append(query.lastProgress["stateOperators"][0]["numRowsTotal"])
        jobs.run_available(stream, f"{folder}/ck2", parted)
        if n == 1:
            for _ in range(2):  # replayed
                parted(spark.createDataFrame(rows, schema), 1)
    # of two keys' panes, of the one that the watermark hasn't passed, of that and one within the delay
    assert held[0] == held[2] == 2 * held[1] > 0
    assert {(r["pane"], r["key"], r["n"]) for r in table.before().collect()} >= {(at(0), "a", 3), (at(0), "b", 1), (at(300), "a", 1), (at(290), "a", 1)}
    assert set(seen["late"]) == {(2, "a", at(5)), (2, "b", None)}
    assert set(seen["on time"]) == {(0, "a", at(1)), (0, "a", at(3)), (0, "b", at(2)), (1, "a", at(300)), (1, "a", at(4)), (2, "a", at(292))}
