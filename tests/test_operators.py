"""Operators on small literal inputs: dumps, sources, projects, archives, crawls, streams, task rules."""

from __future__ import annotations

import io
import json
import random
import re
import zipfile

import pandas as pd
from pyspark.sql import functions as F

from buildlake.functions import numbers, text, times
from buildlake.operators import corpus, debuginfo, hooks, projects, queues, sequences, source_text, tasks
from buildlake.sources import crawl, files
from buildlake.streaming import jobs

DUMP = r"""** int main
line 1 at [00001000], len = 0x10 c:\a\m.c (MD5: AA)
line 2 at [00001010], len = 0x6

** void ns::Work
line 20000000 at [00002000], len = 0x4 d:\b\w.c (0x3: BB)
line 7 at [00002004], len = 0xc
note
line 9 at [00002020], len = 0x8"""


def one(spark, **columns):
    return spark.createDataFrame([tuple(columns.values())], list(columns))


def test_dump(spark):
    rows = debuginfo.dump_rows(debuginfo.text_lines(one(spark, dump=1, content=DUMP), "dump", "content"))
    got = [(r["function"], r["line_number"], r["rva"], r["length"], r["source_file"], r["digest"]) for r in rows.orderBy("pos").collect()]
    assert got[1] == ("intmain", 2, "00001010", 6, "c:\\a\\m.c", "AA")
    assert got[3] == ("voidns::Work", 7, "00002004", 12, "d:\\b\\w.c", "BB")
    told = lambda rows: [(r["function"], r["rva_start"], r["rva_end"], round(r["debug_ratio"], 3)) for r in debuginfo.segments(rows).orderBy("pos").collect()]
    closed = [("intmain", "00001000", "00001016", 0.0), ("voidns::Work", "00002000", "00002010", 0.25)]
    # the dump's last run has no row behind it: its end closes it, unless asked otherwise
    assert told(rows) == [*closed, ("voidns::Work", "00002000", "00002028", 0.167)]
    assert told(debuginfo.dump_rows(debuginfo.text_lines(one(spark, dump=1, content=DUMP), "dump", "content"), end_closes=False)) == closed


def test_source_lines_are_one_based(spark):
    rows = spark.createDataFrame([("m.c", 2), ("m.c", 9)], "source_file string, line_number long")
    got = {r["line_number"]: r["source_code"] for r in debuginfo.with_source(rows, one(spark, source_file="m.c", content="int x;\n  y();\n")).collect()}
    assert got == {2: "y();", 9: ""}


def test_tags_and_function_texts(spark):
    tags = debuginfo.tag_rows(spark.createDataFrame([("first m.c /^int first(int a)$/;\" f line:2 end:3",), ("__anon1 m.c x line:1 end:2",), ("second m.c /^void second()$/;\" f line:6 end:7",), ("bad m.c x line:a end:2",)], ["line"]))
    assert [(r["name"], r["start"], r["end"]) for r in tags.orderBy("start").collect()] == [("first", 2, 3), ("second", 6, 7)]
    body = "#include <a>\nint first(int a)\n{ }\n#define X\n// about\nvoid second()\n{ }\n"
    got = {r["name"]: r["body"] for r in debuginfo.function_texts(tags, one(spark, file="m.c", content=body), step=2).collect()}
    assert got == {"first": "int first(int a)\n{ }", "second": "// about\nvoid second()\n{ }"}


def test_names_match_whatever_their_case_and_qualifier(spark):
    functions = spark.createDataFrame([("Run",), ("ns::Stop",), ("a::go",), ("b::go",)], ["function"])
    tags = spark.createDataFrame([("x::run", 1), ("stop", 2), ("a::GO", 3)], ["name", "at"])
    got = {r["function"]: r["at"] for r in debuginfo.matched_functions(functions, tags, ["at"]).collect()}
    assert got == {"Run": 1, "ns::Stop": 2, "a::go": 3}


SOURCE = ["#include <a.h>", "/* adds", "two */", "static", "int add(int a,", "    int b)", "{", "  // sum", "  return a + b;", "}"]


def test_comments_and_prototype(spark):
    assert source_text.comment_lines(SOURCE, "add", body=False) == ["/* adds", "two */"]
    assert source_text.comment_lines(SOURCE, "add", body=True) == ["  // sum"]
    assert source_text.prototype_lines(SOURCE, "add") == ["static", "int add(int a,", "    int b)"]
    assert source_text.definition_start(SOURCE, "add") == 1
    assert source_text.definition_start(SOURCE, "ns::add") == 1
    assert source_text.definition_start(["x();"], "add") is None
    got = source_text.described_functions(one(spark, name="add", body="\n".join(SOURCE))).first()
    assert got["prototype"].startswith("static") and got["top_comments"] == "/* adds\ntwo */"


def test_range_join_and_as_of(spark):
    points = spark.range(20).toDF("p")
    spans = spark.createDataFrame([(0, 3), (5, 4), (2, 19)], "lo long, hi long")
    got = {(r["p"], r["lo"]) for r in sequences.range_join(points, "p", spans, "lo", "hi", 4).collect()}
    assert got == {(p, 0) for p in range(4)} | {(p, 2) for p in range(2, 20)}
    probes = spark.createDataFrame([(1, 5), (1, 6), (2, 1)], "k long, t long")
    base = spark.createDataFrame([(1, 5, "a"), (1, 3, "b")], "k long, t long, v string")
    assert {(r["k"], r["t"], r["found"]) for r in sequences.as_of(probes, base, ["k"], "t", "v", "found").collect()} == {(1, 5, "b"), (1, 6, "a"), (2, 1, None)}


def test_time_out_boundary(spark):
    rows = spark.createDataFrame([(1, 1, 0, 401), (2, 1, 0, 400), (3, 1, 0, 399), (4, 2, 0, 0)], "_id int, clone_status int, build_status int, mod_timestamp long")
    assert {r["_id"] for r in tasks.timed_out(rows, 1000).where("clone_status = 0").collect()} == {2, 3}
    assert {r["_id"] for r in tasks.timed_out(rows, 1000, None).where("clone_status = 0").collect()} == {1, 2, 3}


def test_merge_keeps_what_an_update_leaves_out(spark):
    table = spark.createDataFrame([(1, 0, "x"), (2, 0, "y")], "_id int, status int, sha string")
    updates = spark.createDataFrame([(1, 10, 2, None), (1, 11, None, "z"), (1, 9, 3, "w")], "_id int, at int, status int, sha string")
    assert {tuple(r) for r in tasks.merged(table, updates, "_id", ["at"]).collect()} == {(1, 2, "z"), (2, 0, "y")}


def test_fan_out_directions(spark):
    p = spark.createDataFrame([(1, "make"), (2, "cmake/make"), (3, "")], "_id int, build_system string")
    o = spark.createDataFrame([(7, "make/cmake"), (8, "make")], "_id int, build_system string")
    pairs = lambda way: {(r["repo_id"], r["build_opt_id"]) for r in tasks.fan_out(p, o, way).collect()}
    assert pairs(True) == {(1, 7), (1, 8), (3, 7), (3, 8)}
    assert pairs(False) == {(1, 8), (2, 8)}


def test_archives_and_products(spark):
    def archive(*names):
        blob = io.BytesIO()
        with zipfile.ZipFile(blob, "w") as z:
            for n in names:
                z.writestr(n, "abc")
        return blob.getvalue()

    table = spark.createDataFrame([("a", archive("pdbinfo.json", "x/b.EXE")), ("b", archive("c.dll")), ("c", b"no zip")], "path string, content binary")
    got = files.archive_members(table)
    assert {(r["archive"], r["member"], r["n_bytes"]) for r in got.collect()} == {("a", "pdbinfo.json", 3), ("a", "x/b.EXE", 3)}
    assert files.build_products(got, "member").count() == 1


def test_json_documents_and_quarantine(spark, tmp_path):
    (tmp_path / "a.json").write_text(json.dumps({"Platform": "x64", "URL": "u", "Binary_info_list": [{"file": "c:\\o\\a.exe", "functions": []}]}))
    docs = files.json_documents(spark, str(tmp_path))
    assert docs.select("URL", F.size("Binary_info_list")).first()[:] == ("u", 1)
    good, bad = files.decoded_json(spark.createDataFrame([('{"k": 1}',), ("{oops",)], ["j"]), "j", "k int")
    assert good.first()["k"] == 1 and bad.count() == 1


def test_dataset_keeps_unlisted_and_drops_empty(spark):
    function = ("f", "12.5%", "a.c", [("10", "20", "0%")], [(1, "10", 2, "x", "a.c")])
    kind = "struct<function_name: string, intersect_ratio: string, source_file: string, function_info: array<struct<rva_start: string, rva_end: string, debug_ratio: string>>, lines: array<struct<line_number: int, rva: string, length: int, source_code: string, source_file: string>>>"
    docs = spark.createDataFrame(
        [(None, "Debug", "v142", "u", "O2", "02/03/2020, 04:05:06", [("d\\a.exe", [function]), ("d\\b.exe", [])])],
        f"Platform string, Build_mode string, Toolset_version string, URL string, Optimization string, Pushed_at string, Binary_info_list array<struct<file: string, functions: array<{kind}>>>",
    )
    key = corpus.identified(docs).first()["identifier"]
    assert key.endswith("_unknown_Debug_v142_O2")
    found = spark.createDataFrame([(key, n, 2048) for n in ("a.exe", "b.exe", "c.exe")], "identifier string, file_name string, n_bytes long")
    binaries, dropped = corpus.dataset_binaries(found, docs)
    assert {r["file_name"] for r in binaries.collect()} == {"a.exe", "c.exe"} and dropped.count() == 1
    functions = corpus.dataset_functions(binaries)
    assert functions.first()["rvas"] == "10-20" and functions.first()["intersect_ratio"] == 0.125
    assert corpus.dataset_lines(functions).count() == 1


def test_projects_round_trip(spark):
    xml = f"""<Project xmlns="{projects.NAMESPACE}"><ItemGroup Label="ProjectConfigurations"><ProjectConfiguration Include="Debug|x64"/></ItemGroup>
    <PropertyGroup Label="Configuration"><PlatformToolset>v140</PlatformToolset></PropertyGroup><ItemDefinitionGroup><ClCompile/></ItemDefinitionGroup></Project>"""
    table = spark.createDataFrame([(xml,), ("<broken",), (None,)], ["xml"])
    changed = table.withColumn("xml", projects.set_favor(projects.set_optimization(projects.set_toolset("xml", F.lit("v142")), F.lit("O2")), F.lit("Speed")))
    assert changed.where("xml is null").count() == 2
    got = projects.described_projects(changed.where("xml is not null")).first()
    assert (got["toolset"], got["optimization"]) == ("v142", "MaxSpeed")
    assert projects.configurations(table.limit(1)).select("configuration", "platform").first()[:] == ("Debug", "x64")


def test_solution_configuration(spark):
    content = "Project(\"{T}\") = \"a\", \"a.vcxproj\", \"{A}\"\nEndProject\nGlobal\n\tGlobalSection(SolutionConfigurationPlatforms) = preSolution\n\t\tDebug|x86 = Debug|x86\n\tEndGlobalSection\nEndGlobal"
    table = one(spark, k=1, c=content)
    assert "Release|x64 = Release|x64" in projects.with_configuration(table, "k", "c", "Release", "x64").first()["c"]
    assert projects.with_configuration(table, "k", "c", "Debug", "x86").first()["c"] == content


def test_crawl_pages_and_stream(spark, tmp_path):
    start, end = 1_704_067_200, 1_704_067_200 + 600 * 250
    assert crawl.crawl(spark, start, end, 600 * 120).count() == 250
    assert len(list(crawl.fetched(crawl.sample_fetch, start, end))) == 250
    stream = crawl.CrawlStream({"start": start, "end": end, "interval": 600 * 200})
    parts = stream.partitions(stream.initialOffset(), stream.latestOffset())
    assert [len(list(stream.read(p))) for p in parts] == [200, 50] and stream.partitions(stream.latestOffset(), stream.latestOffset()) == []


def test_streams_equal_batches(spark, tmp_path):
    inbox = tmp_path / "in"
    spark.createDataFrame([(i, i % 3, "2024-01-01 00:%02d:00" % i) for i in range(30)], "id long, k long, t string").withColumn("ts", F.col("t").cast("timestamp")).repartition(3).write.parquet(str(inbox))
    stream = jobs.messages(spark, str(inbox), spark.read.parquet(str(inbox)).schema, "parquet", per_trigger=1)
    table = jobs.VersionedTable(spark, str(tmp_path / "table"), spark.createDataFrame([], "id long, k long").schema)
    jobs.run_available(stream.select("id", "k"), str(tmp_path / "ck"), table.insert_new(["k"], ["id"]))
    assert table.before().count() == 3
    late = jobs.split_late(spark.createDataFrame([(400,), (401,)], ["t"]), F.col("t"), F.lit(1000)).collect()
    assert [r["outdated"] for r in late] == [True, False]


def test_columns(spark):
    row = lambda *c: spark.range(1).select(*c).first()[:]
    assert row(text.service_url(F.lit("https://forge.com/a"))) == ("https://api.forge.com/repos/a",)
    assert row(numbers.hex_plus(F.lit("0000fff0"), F.lit(32)), numbers.from_hex(F.lit("zz"))) == ("00010010", None)
    assert row(text.version_at_most(F.lit("1.9"), F.lit("1-10")), text.version_matches(F.lit("1.2"), F.lit("1.2-3"))) == (True, True)
    assert row(times.console_epoch(F.lit("01/01/1970--00:01:5")), times.message_time(F.lit("x"))) == (65, None)
    assert row(text.unix_command(F.lit("cmake/make"), F.lit("/r")))[0].startswith("cd /r && cmake")
    assert row(text.build_systems(F.array(F.lit("Makefile"), F.lit("x/CMakeLists.txt")))) == ("cmake/make",)


def test_strategy_stops_where_a_stage_fails(spark):
    tasks_ = spark.createDataFrame([(i, f"r{i}") for i in range(6)], "task_id long, url string").repartition(2)

    def clone(rows: pd.DataFrame) -> pd.DataFrame:
        return pd.DataFrame({"status": [2 if i == 1 else 3 for i in rows["task_id"]], "msg": "cloned"}, index=rows.index)

    def build(rows: pd.DataFrame) -> pd.DataFrame:
        assert 1 not in set(rows["task_id"])
        return pd.DataFrame({"status": [3 if i % 2 else 10 for i in rows["task_id"]], "msg": "built"}, index=rows.index)

    def broken(rows: pd.DataFrame) -> pd.DataFrame:
        raise RuntimeError("no tool")

    got = {r["task_id"]: (r["stage"], r["status"], r["msg"]) for r in hooks.run_strategy(tasks_, {"clone": clone, "build": build}).collect()}
    assert got[1] == ("clone", 2, "cloned") and got[3] == ("build", 3, "built") and got[4] == ("build", 10, "built") and len(got) == 6
    assert {(r["status"], r["msg"]) for r in hooks.run_strategy(tasks_, {"clone": broken}).collect()} == {(2, "RuntimeError: no tool")}
    assert {(r["stage"], r["status"]) for r in hooks.run_strategy(tasks_, {}).collect()} == {(None, 0)}
    assert hooks.run_strategy(tasks_.limit(0), {"clone": clone}).count() == 0


def test_analyses_and_predicates(spark):
    table = spark.createDataFrame([("a.exe", bytearray(b"ab")), ("b.so", None), ("c.dll", bytearray(b"x"))], "file_name string, content binary")
    rows = hooks.analysed(table, lambda name, blob: ((i, chr(c)) for i, c in enumerate(blob)), "at long, byte string").collect()
    assert sorted(map(tuple, rows)) == [("a.exe", 0, "a"), ("a.exe", 1, "b"), ("c.dll", 0, "x")]
    assert [r["file_name"] for r in hooks.accepted(table, lambda name: name.endswith(".so"), "file_name").collect()] == ["b.so"]


def test_admission_boundaries(spark):
    rows = [(i, "a", i // 3, 100) for i in range(30)] + [(100, "a", 0, 600), (101, "a", 0, 599), (102, None, 0, 1), (103, "b", 0, 700)]
    table = spark.createDataFrame(rows, "id long, queue string, seq long, age long")
    got = {r["id"]: r["verdict"] for r in queues.admission(table, "queue", ["seq", "id"], F.col("age"), capacity=5, buckets=4).collect()}
    assert got[100] == got[103] == "expired" and [i for i in range(102) if got.get(i) == "queued"] == [0, 1, 2, 3, 101] and len(got) == len(rows)


def test_commands(spark):
    lines = spark.createDataFrame([("  progress ",), ("build a  b",), ("build a",), ("",), (None,), ("what now",)], "line string")
    got = [(r["command"], r["args"], r["valid"]) for r in queues.parsed_commands(lines, "line", {"progress": 0, "build": 2}).collect()]
    assert got[:3] == [("progress", [], True), ("build", ["a", "b"], True), ("build", ["a"], False)]
    assert [g[2] for g in got[3:]] == [False] * 3


def test_newest_versions_by_brute_force(spark):
    """Many commits and several limits of one key; versions with parts that are no numbers, prefixes, ties."""
    rng = random.Random(9)
    version = lambda: rng.choice(["", "v", "1-"]) * (rng.random() < 0.2) + ".".join(rng.choice(["0", "1", "2", "10", "03", "x", "2147483648"]) for _ in range(rng.randrange(1, 4)))
    commits = [("hot" if i < 300 else rng.choice(["a", "b", None]), version() if i % 40 else None, rng.randrange(50), i) for i in range(500)]
    wanted = [(k, v) for k in ("hot", "a", "c") for v in {version() for _ in range(12)}] + [("a", None)]
    parts = lambda v: [(p.isdigit() and int(p) < 1 << 31, int(p) if p.isdigit() and int(p) < 1 << 31 else 0) for p in v.replace("-", ".").split(".")] if v is not None else []
    best = {}
    for k, limit in wanted:
        fitting = [(at, i) for key, v, at, i in commits if key == k and limit is not None and parts(v) <= parts(limit)]
        if fitting:
            best[k, limit] = max(fitting)
    table = spark.createDataFrame(commits, "key string, version string, at long, id long").repartition(5)
    limits = spark.createDataFrame(wanted, "key string, wanted string")
    got = {(r["key"], r["wanted"]): (r["at"], r["id"]) for r in queues.newest_at_most(table, limits, "key", "version", "wanted", ["at", "id"], "at", "id").collect()}
    assert got == best and len(best) > 20
    row = spark.range(1).select(*[text.version_key(F.lit(v)) for v in ("1.9", "1.10", "1", "x.1", "1-10", "1.x")]).first()
    assert row[0] < row[1] == row[4] and row[2] < row[5] < row[0] and row[3] < row[2]


def test_a_script_of_edits_equals_its_setters(spark, capsys):
    xml = f'<Project xmlns="{projects.NAMESPACE}"><PropertyGroup Label="Configuration"><PlatformToolset>v1</PlatformToolset></PropertyGroup><PropertyGroup/><ItemDefinitionGroup><ClCompile/><Link/></ItemDefinitionGroup></Project>'
    table = spark.createDataFrame([(xml, "v9"), (xml, None), ("<broken", "v9"), (None, "v9")], "xml string, v string")
    chain, script = F.col("xml"), []
    for name in projects.CHANGES:
        value = F.lit("/Ox") if name == "optimization" else F.concat(F.lit(f"{name}"), F.col("v")) if name != "toolset" else F.col("v")
        chain, script = getattr(projects, f"set_{name}")(chain, value), [*script, (name, value)]
    once = table.select("v", chain.alias("want"), projects.edited(F.col("xml"), script).alias("got"))
    rows = once.collect()
    assert all(r["want"] == r["got"] for r in rows) and "toolsetv9" not in rows[0]["got"] and "<PlatformToolset>v9</PlatformToolset>" in rows[0]["got"]
    assert [r["got"] is None for r in rows] == [False, False, True, True] and "PlatformToolset" not in rows[1]["got"]
    table.select(projects.edited(F.col("xml"), script)).explain()
    assert capsys.readouterr().out.count("EvalPython") == 1


def test_hashed_layout_reads_the_folders_of_the_names(spark, tmp_path, capsys):
    names = spark.createDataFrame([(i, f"name {i}") for i in range(3000)] + [(-1, None), (-2, "name 7")], "id long, name string")
    files.write_hashed(names.where("name is not null"), "name", str(tmp_path / "h"))
    wanted = spark.createDataFrame([("name 7",), ("name 2999",), ("none",), (None,), ("name 7",)], "name string")
    found = files.read_hashed(spark, str(tmp_path / "h"), names.schema, wanted, "name")
    assert sorted(r["id"] for r in found.collect()) == [-2, 7, 2999] and found.columns == ["id", "name"]
    found.explain()
    plan = capsys.readouterr().out
    filters = re.search(r"PartitionFilters: \[(.*?)\], PushedFilters", plan)[1]
    assert "prefix" in filters and len(found.inputFiles()) > 0
    assert files.read_hashed(spark, str(tmp_path / "h"), names.schema, wanted.limit(0), "name").count() == 0


def test_literals_and_comments_are_told_apart():
    lines = [
        'const char *url = "http://a/*b";',
        "int other(int c) { return '\\\"'; } // add(1)",
        "",
        "// first",
        "// second",
        "",
        "static",
        'int add(int a, /* second( */ int b = f(")"),',
        "        int c)",
        "{",
        '  puts("// no comment");  /* one',
        "",
        '  "two" */ puts("*/");',
        "  return '/' / *p; // three",
        "}",
    ]
    code = [line.code for line in source_text.lexed(lines)]
    assert "http" not in code[0] and code[0].endswith(";") and "add" not in code[1] and "puts" in code[10] and "two" not in code[12] and "puts" in code[12]
    assert all(len(line.text) == len(line.code) for line in source_text.lexed(lines))
    assert source_text.definition_start(lines, "add") == 3
    assert source_text.comment_lines(lines, "add", body=False) == [lines[1], *lines[3:5]]
    assert source_text.comment_lines(lines, "add", body=True) == [lines[7], lines[10], lines[12], lines[13]]
    assert source_text.prototype_lines(lines, "add") == lines[6:8]
    assert source_text.definition_start(lines, "second") is None and source_text.comment_lines([], "x", True) == [] == source_text.prototype_lines([], "x")
    assert source_text.lexed(["a /* open", "b"])[1].only_comment and source_text.lexed(['"open', "b"])[1].code == "b"
    assert source_text.definition_start(["#define A", "/* x", "*/", "", "int f(", "  int a)", "{"], "f") == 1
    assert source_text.definition_start(["g();", "int f(int a)", "{"], "f") == 1 and source_text.definition_start(["@deco", "", "int f(int a)"], "f") == 2
    assert source_text.comment_lines(["// a", "#include <x> // b", "// c", "int f()"], "f", body=False) == ["// c"]


def test_fields_of_the_first_tag_of_a_file(spark):
    functions = spark.createDataFrame([(1, "ns::Run", "a.c (MD5: 1)"), (2, "RUN", "a.c (0x3: 2)"), (3, "run", "b.c"), (4, "x::run", "b.c"), (5, None, "a.c")], "id long, function string, source_file string")
    row = lambda file, name, at, mark: (file, name, at, *[f"{mark}{i}" for i in range(len(debuginfo.TAG_FIELDS))])
    tags = spark.createDataFrame([row("a.c", "run", 7, "late"), row("a.c", "Run", 3, "first"), row("a.c", "Run", 3, "again"), row("b.c", "y::run", 1, "other")], f"source_file string, name string, at long, {', '.join(f'{c} string' for c in debuginfo.TAG_FIELDS)}")
    found = debuginfo.with_tag_fields(functions, tags)
    assert found.columns == [*functions.columns, *debuginfo.TAG_FIELDS]
    # of two tags in one place the one of the least fields; two qualified names are compared whole
    assert {r["id"]: (r["ctag_definitions"], r["source_codes"]) for r in found.collect()} == {1: ("again0", "again5"), 2: ("again0", "again5"), 3: ("other0", "other5"), 4: (None, None), 5: (None, None)}
