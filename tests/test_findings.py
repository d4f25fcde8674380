"""Queries against their SQL twins on awkward and crowded tables, after findings of the third round."""

from __future__ import annotations

import duckdb
import pytest
from pyspark.sql import functions as F
from test_catalogue import rows

from buildlake.operators import debuginfo, numbering, projects
from buildlake.plans import catalogue, staged_files
from buildlake.sources import crawl, staging


def twins(spark, folder, name, **tables):
    """A query's rows and those of its SQL over ``tables``, each given as a SELECT."""
    con = duckdb.connect()
    for table, select in tables.items():
        con.sql(f"COPY ({select}) TO '{folder}/{table}.parquet' (FORMAT parquet)")
        con.sql(f"CREATE VIEW {table} AS FROM '{folder}/{table}.parquet'")
    want = con.sql(catalogue.ORACLE_SQL[name]).df()
    got = catalogue.QUERIES[name](spark, str(folder)).toPandas()
    assert sorted(got.columns) == sorted(want.columns)
    return rows(got), rows(want)


@pytest.mark.parametrize("name", ["progress_events", "queue_admission", "cache_eviction"])
def test_fractions_of_a_second_count(name, spark, tmp_path):
    """Events within a second of every bound, on both sides of it."""
    events = """SELECT row_number() OVER (ORDER BY b, d)::BIGINT AS event_id, make_timestamp((1706572800 - b)::BIGINT * 1000000 + d) AS ts, 'view' AS event_type
    FROM (VALUES (60), (3600), (86400), (2592000), (1728000)) x(b), (VALUES (-900000), (-500000), (-1), (0), (1), (400000), (500000), (500001), (999999), (1500000)) y(d)"""
    got, want = twins(spark, tmp_path, name, events=events)
    assert got == want


@pytest.mark.parametrize("name", ["crawled_rows", "crawled_repositories", "streamed_crawl"])
def test_a_second_with_more_rows_than_a_window_may_have(name, spark, tmp_path):
    orders = """SELECT k AS o_orderkey, k % 97 AS o_custkey, k * 1.5 AS o_totalprice, CASE k % 3 WHEN 0 THEN 'O' WHEN 1 THEN 'F' ELSE 'P' END AS o_orderstatus,
    CASE WHEN k < 2350 THEN TIMESTAMP '1997-03-04' WHEN k = 2350 THEN TIMESTAMP '2003-12-31 23:59:59' ELSE TIMESTAMP '1990-01-01' + to_seconds(k * 100000) END AS o_orderdate FROM range(3000) t(k)"""
    got, want = twins(spark, tmp_path, name, orders=orders)
    assert got == want


def test_a_service_that_stops_early_is_no_whole_crawl():
    cut = lambda since, until, page: (1500, [{"name": "r"}] * 100 if page <= 10 else [])
    with pytest.raises(ValueError, match="1500"):
        list(crawl.fetched(cut, 0, 1))


NESTED = """<P xmlns="http://schemas.microsoft.com/developer/msbuild/2003"><!-- c --><PropertyGroup Label="Configuration"><PropertyGroup><OutDir/><OutDir>in</OutDir></PropertyGroup><PlatformToolset>v1<!-- x -->4<b>2</b></PlatformToolset></PropertyGroup>
<PropertyGroup><OutDir>out</OutDir><LinkIncremental> true </LinkIncremental></PropertyGroup><ItemDefinitionGroup><Link/><ClCompile Include="d.c"><Optimization/></ClCompile></ItemDefinitionGroup>
<ItemDefinitionGroup><Lib><OutputFile>l</OutputFile></Lib><Link><OutputFile>o</OutputFile></Link><ClCompile><Optimization>Full</Optimization></ClCompile></ItemDefinitionGroup>
<ItemGroup><ClCompile Include="a.c"/><ClCompile/><x:ClCompile xmlns:x="u" Include="b&amp;.c"/><ClInclude Include="a.h"/></ItemGroup><ConfigurationType>none</ConfigurationType></P>"""


def test_one_parse_gives_what_the_single_getters_give(spark):
    wanted = dict(projects._DESCRIBED) | {"incremental": ("PropertyGroup", "LinkIncremental", None), "missing": ("ItemDefinitionGroup", "ClCompile", "Nothing")}
    table = spark.createDataFrame([(NESTED,), ('<PropertyGroup Label="Configuration"><ConfigurationType>StaticLibrary</ConfigurationType></PropertyGroup>',), (None,)], "xml string")
    single = {
        "Include": lambda item: F.xpath(F.col("xml"), F.lit(f'//*[local-name()="{item}"]/@Include')),
        "PropertyGroup": lambda item, label: projects.property_value(F.col("xml"), item, label),
        "ItemDefinitionGroup": lambda group, item: projects.definition_value(F.col("xml"), group, item),
    }
    got = table.select(projects.values_of(F.col("xml"), wanted).alias("v")).select("v.*").collect()
    want = table.select(*[single[place[0]](*place[1:]).alias(name) for name, place in wanted.items()]).collect()
    assert got == want


def test_projects_are_parsed_once_and_by_all_cores(spark, sf_dir):
    for name in ("xml_project_getters", "xml_project_setters", "xml_project_all_setters"):
        found = catalogue.QUERIES[name](spark, sf_dir)
        plan = found._jdf.queryExecution().executedPlan().toString()
        assert "xpath" not in plan and "Join" not in plan
        assert found.rdd.getNumPartitions() >= spark.sparkContext.defaultParallelism


def test_a_key_keeps_its_first_tag_only(spark):
    """Functions meet one tag a key, not all of them."""
    functions = spark.createDataFrame([("ns::Run",), ("run",), ("STOP",), ("x::stop",)], "function string")
    tags = spark.createDataFrame([("Run", 3), ("a::run", 2), ("ns::run", 5), ("b::Stop", 1), *((f"t{i}::stop", i) for i in range(2, 40))], "name string, at int")
    found = debuginfo.matched_functions(functions, tags, ["at"])
    assert {(r["function"], r["tag"], r["at"]) for r in found.collect()} == {("ns::Run", "Run", 3), ("run", "a::run", 2), ("STOP", "b::Stop", 1)}
    joins = found._jdf.queryExecution().optimizedPlan().toString()
    assert joins.index("Join") < joins.rindex("min(struct(")


def test_numbering_all_rows_moves_them_once(spark):
    """Counts of the ranges come to the rows, also where nothing may be broadcast by its size."""
    limit = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        table = spark.range(1000).select((999 - F.col("id")).alias("k"))
        for found in (numbering.with_keys(table, "n", ["k"]), numbering.running_sums(table, "n", F.lit(1), ["k"])):
            assert "SortMergeJoin" not in found._jdf.queryExecution().executedPlan().toString()
            assert sorted(map(tuple, found.collect())) == [(k, k + 1) for k in range(1000)]
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", limit)


def test_orders_are_nested_where_they_are(spark, sf_dir):
    """One exchange builds the documents of all orders."""
    plan = staged_files._build_documents(spark, sf_dir)._jdf.queryExecution().executedPlan().toString()
    assert plan.count("Exchange hashpartitioning") == 1


@pytest.mark.parametrize("name", ["debug_dump_segments", "debug_dump_lines"])
def test_dumps_of_any_size_with_repeated_items(name, spark, tmp_path):
    """One supplier has a third of all items, orders lie in several suppliers' dumps, items are repeated."""
    lineitem = """SELECT k // 4 + 1 AS l_orderkey, k % 13 AS l_partkey, CASE WHEN k % 3 = 0 THEN 1 ELSE k % 90 END AS l_suppkey, (k % 4)::INT AS l_linenumber, (k * 7 % 50 + 1)::DOUBLE AS l_quantity
    FROM range(3000) t(k), range(2) r"""
    got, want = twins(spark, tmp_path, name, lineitem=lineitem)
    assert got == want


def test_lines_of_dumps_move_twice(spark, sf_dir, tmp_path, monkeypatch):
    """Once into ranges, where they are written and scanned, and once to the windows; what reaches a range is broadcast."""
    written = []
    monkeypatch.setattr(numbering, "staged", lambda df, name: (written.append(df), staging.staged(df, name))[1])
    limit = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        found = catalogue.QUERIES["debug_dump_segments"](spark, sf_dir)
        (lines,) = written
        plan = lines._jdf.queryExecution().executedPlan().toString()
        assert plan.count("Exchange ") == 1 and "Exchange rangepartitioning" in plan
        plan = found._jdf.queryExecution().executedPlan().toString()
        assert "SortMergeJoin" not in plan
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", limit)
