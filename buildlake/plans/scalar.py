"""Queries of the column functions: text, numbers, times, nested values."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from buildlake.functions import numbers, text, times
from buildlake.operators import debuginfo
from buildlake.plans.registry import Registry
from buildlake.sources import roles

REGISTRY = query = Registry()


def _load(spark: SparkSession, sf_dir: str, table: str) -> DataFrame:
    return roles.load(spark, sf_dir, table)


@query(
    r"""SELECT _id, replace(replace(url, 'repos/', ''), 'api.', '') AS web, regexp_replace(regexp_replace(replace(replace(url, 'repos/', ''), 'api.', ''), '^(.*?//)', '\1api.'), '^(.*?\.com)', '\1/repos') AS service FROM projects""",
    roles=True,
)
def url_patch_unpatch(spark: SparkSession, sf_dir: str) -> DataFrame:
    web = text.web_url(F.col("url"))
    return roles.projects(spark, sf_dir).select("_id", web.alias("web"), text.service_url(web).alias("service"))


@query(r"SELECT doc_id, right(text, 200) AS tail, left(text, 200) AS head, trim(regexp_replace(text, '\s+', ' ', 'g')) AS spaced, replace(text, chr(10), ' ') AS flat, regexp_replace(text, '[^\x09-\x0d\x20-\x7e]', '', 'g') AS ascii FROM documents")
def text_cleanup(spark: SparkSession, sf_dir: str) -> DataFrame:
    t = F.col("text")
    return _load(spark, sf_dir, "documents").select("doc_id", text.tail(t, 200).alias("tail"), text.head(t, 200).alias("head"), text.single_spaced(t).alias("spaced"), text.one_line(t).alias("flat"), text.printable(t).alias("ascii"))


@query("SELECT page_id, list_extract(string_split(translate(url, '\\', '/'), '/'), -1) AS base, CASE WHEN contains(lower(url), 'debug') THEN 'debug' ELSE 'release' END || CASE WHEN contains(lower(url), 'x86') THEN '_x86' ELSE '' END || CASE WHEN contains(lower(url), 'x64') THEN '_x64' ELSE '' END AS label FROM pages")
def path_basename_label(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _load(spark, sf_dir, "pages").select("page_id", text.base_name(F.col("url")).alias("base"), text.label_of_path(F.col("url")).alias("label"))


_FLAG = "CASE p_size % 5 WHEN 0 THEN '/O2' WHEN 1 THEN '/O1' WHEN 2 THEN '/Ox' WHEN 3 THEN '/Ot' ELSE '/Os' END"


@query(f"SELECT p_partkey, CASE WHEN contains(f, 'O2') THEN 'MaxSpeed' WHEN contains(f, 'O1') THEN 'MinSpace' WHEN contains(f, 'Ox') THEN 'Full' ELSE 'Disabled' END AS optimization, CASE WHEN contains(f, 'Ot') THEN 'Speed' WHEN contains(f, 'Os') THEN 'Size' ELSE '' END AS favor FROM (SELECT p_partkey, {_FLAG} AS f FROM part)")
def flag_mapping(spark: SparkSession, sf_dir: str) -> DataFrame:
    flag = F.expr(_FLAG)
    return _load(spark, sf_dir, "part").select("p_partkey", text.optimization_name(flag).alias("optimization"), text.favor_name(flag).alias("favor"))


@query(r"SELECT o_orderkey, lower(printf('%08x', o_orderkey)) AS rva, lower(printf('%08x', o_orderkey + (o_custkey % 4096))) AS rva_end, o_orderkey AS back FROM orders")
def hex_arithmetic(spark: SparkSession, sf_dir: str) -> DataFrame:
    rva = numbers.to_hex(F.col("o_orderkey"), F.lit(8))
    return _load(spark, sf_dir, "orders").select("o_orderkey", rva.alias("rva"), numbers.hex_plus(rva, F.col("o_custkey") % 4096).alias("rva_end"), numbers.from_hex(rva).alias("back"))


_DIGITS = "regexp_replace(md5(url), '[^0-9]', '', 'g')"


@query(f"SELECT page_id, {', '.join(f"list_extract({list(v)}, (CASE WHEN length({_DIGITS}) < 4 THEN 1 ELSE substr({_DIGITS}, {k}, 1)::INT END % {len(v)}) + 1) AS {n}" for k, (n, v) in enumerate(numbers.CONFIG_AXES.items(), 1))} FROM pages")
def hash_config_pick(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _load(spark, sf_dir, "pages").select("page_id", *[c.alias(n) for n, c in numbers.picked_config(F.col("url")).items()])


_ISO = "CASE WHEN o_orderkey % 7 = 0 THEN 'corrupt' ELSE strftime(o_orderdate, '%Y-%m-%dT%H:%M:%SZ') END"


@query(
    f"""SELECT o_orderkey, coalesce(try_strptime({_ISO}, '%Y-%m-%dT%H:%M:%SZ'), TIMESTAMP '2000-01-01 01:01:01') AS lenient, strftime(o_orderdate, '%m/%d/%Y, %H:%M:%S') AS message,
    epoch(o_orderdate)::BIGINT AS epoch, epoch(o_orderdate)::BIGINT - epoch(o_orderdate)::BIGINT % 86400 AS day, epoch(o_orderdate)::BIGINT - epoch(o_orderdate)::BIGINT % 1200 + 1200 AS boundary,
    strftime(o_orderdate, '%Y-%m-%dT%H:%M:%S') AS iso, greatest(0, 900000000 - epoch(o_orderdate)::BIGINT) + 3 AS remaining FROM orders"""
)
def time_parse_lenient(spark: SparkSession, sf_dir: str) -> DataFrame:
    date = F.col("o_orderdate")
    written = F.when(F.col("o_orderkey") % 7 == 0, "corrupt").otherwise(F.date_format(date, times.ISO_FORMAT))
    seconds = times.epoch(date)
    return _load(spark, sf_dir, "orders").select(
        "o_orderkey",
        times.iso_or_default(written).alias("lenient"),
        times.as_message_time(date).alias("message"),
        seconds.alias("epoch"),
        times.floor_to(seconds, 86400).alias("day"),
        times.next_boundary(seconds, 1200).alias("boundary"),
        times.iso_of_epoch(seconds).alias("iso"),
        times.remaining(F.lit(900_000_000), seconds, 3).alias("remaining"),
    )


@query("SELECT o_orderkey, try_strptime(strftime(o_orderdate, '%m/%d/%Y, %H:%M:%S'), '%m/%d/%Y, %H:%M:%S') AS parsed, epoch(o_orderdate)::BIGINT AS console FROM orders")
def time_round_trip(spark: SparkSession, sf_dir: str) -> DataFrame:
    date = F.col("o_orderdate")
    return _load(spark, sf_dir, "orders").select("o_orderkey", times.message_time(times.as_message_time(date)).alias("parsed"), times.console_epoch(F.date_format(date, "dd/MM/yyyy--HH:mm:ss")).alias("console"))


@query("SELECT event_id, json_extract_string(props, '$.k')::BIGINT AS k, coalesce(json_extract_string(props, '$.rate.remaining')::BIGINT, 0) AS remaining FROM events")
def json_decode_props(spark: SparkSession, sf_dir: str) -> DataFrame:
    left = F.coalesce(F.get_json_object("props", "$.rate.remaining").cast("long"), F.lit(0).cast("long"))
    return _load(spark, sf_dir, "events").select("event_id", F.from_json("props", "k long")["k"].alias("k"), left.alias("remaining"))


@query("SELECT event_id, list_sort(json_keys(props)) = ['k'] AS conforms FROM events")
def schema_conformance(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _load(spark, sf_dir, "events").select("event_id", (F.array_sort(F.json_object_keys("props")) == F.array(F.lit("k"))).alias("conforms"))


@query("SELECT count_if(valid)::BIGINT AS valid, count_if(NOT valid)::BIGINT AS invalid FROM (SELECT value > 50 AND event_type <> 'error' AS valid FROM events)")
def invalid_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    valid = (F.col("value") > 50) & (F.col("event_type") != "error")
    return _load(spark, sf_dir, "events").agg(F.count_if(valid).alias("valid"), F.count_if(~valid).alias("invalid"))


@query("SELECT user_id, coalesce(nullif(array_to_string(list_sort(list(DISTINCT event_type)), '/'), ''), 'others') AS tools FROM events GROUP BY user_id")
def build_tools_of_user(spark: SparkSession, sf_dir: str) -> DataFrame:
    joined = F.array_join(F.array_sort(F.collect_set("event_type")), "/")
    return _load(spark, sf_dir, "events").groupBy("user_id").agg(F.coalesce(F.nullif(joined, F.lit("")), F.lit("others")).alias("tools"))


@query(
    r"""SELECT page_id, CASE WHEN len(t) = 0 THEN 'others' ELSE array_to_string(t, '/') END AS tools FROM (SELECT page_id, list_filter([
    CASE WHEN len(list_filter(f, lambda x: contains(x, 'configure'))) > 0 THEN 'autoconf' END, CASE WHEN len(list_filter(f, lambda x: contains(x, 'cmakelists.txt'))) > 0 THEN 'cmake' END,
    CASE WHEN len(list_filter(f, lambda x: contains(x, 'makefile'))) > 0 THEN 'make' END, CASE WHEN len(list_filter(f, lambda x: contains(x, '.sln'))) > 0 THEN 'sln' END], lambda x: x IS NOT NULL) AS t
    FROM (SELECT page_id, CASE page_id % 4 WHEN 0 THEN ['cmakelists.txt', 'makefile'] WHEN 1 THEN ['app.sln', 'configure.ac'] WHEN 2 THEN ['gnumakefile', 'readme'] ELSE ['readme'] END AS f FROM pages))"""
)
def build_system_classify(spark: SparkSession, sf_dir: str) -> DataFrame:
    k = F.col("page_id") % 4
    names = lambda *x: F.array(*map(F.lit, x))
    files = F.when(k == 0, names("CMakeLists.txt", "Makefile")).when(k == 1, names("app.sln", " configure.ac")).when(k == 2, names("GNUmakefile", "README")).otherwise(names("README"))
    return _load(spark, sf_dir, "pages").select("page_id", text.build_systems(files).alias("tools"))


@query(
    r"""SELECT p_partkey, arg_min(b.k, b.k) AS matched FROM (SELECT p_partkey, lower(list_extract(string_split(p_name, ' '), -1)) AS t FROM part) p
    JOIN (SELECT DISTINCT p_brand || '::' || list_extract(string_split(p_name, ' '), -1) AS k FROM part) b ON lower(list_extract(string_split(b.k, '::'), -1)) = p.t GROUP BY p_partkey"""
)
def name_match_ci(spark: SparkSession, sf_dir: str) -> DataFrame:
    last = F.element_at(F.split("p_name", " "), -1)
    part = _load(spark, sf_dir, "part")
    tags = part.select(F.concat("p_brand", F.lit("::"), last).alias("name")).distinct().withColumn("matched", F.col("name"))
    return debuginfo.matched_functions(part.select("p_partkey", last.alias("function")), tags, ["matched"]).select("p_partkey", "matched")


@query(
    r"""SELECT p_partkey, matched FROM (SELECT p_partkey, lower(list_extract(string_split(p_name, ' '), -1)) AS t FROM part) p
    JOIN (SELECT lower(list_extract(string_split(p_name, ' '), -1)) AS t, min(p_brand || '::' || list_extract(string_split(p_name, ' '), -1)) AS matched FROM part GROUP BY 1) b USING (t)"""
)
def name_match_ci_all(spark: SparkSession, sf_dir: str) -> DataFrame:
    """``name_match_ci`` with the tags of all parts."""
    last = F.element_at(F.split("p_name", " "), -1)
    part = _load(spark, sf_dir, "part")
    tags = part.select(F.concat("p_brand", F.lit("::"), last).alias("k")).distinct()
    tags = tags.groupBy(F.lower(text.unqualified(F.col("k"))).alias("t")).agg(F.min("k").alias("matched"))
    return part.select("p_partkey", F.lower(last).alias("t")).join(tags, "t").select("p_partkey", "matched")


@query(
    r"""SELECT page_id, CASE WHEN mode IN ('Release', 'Debug') THEN 'msbuild /property:Configuration=' || mode ELSE 'msbuild' END || ' /property:Platform=' || library
    || CASE WHEN toolset IN ('v140', 'v141') THEN ' /p:WindowsTargetPlatformVersion= ' ELSE '' END || ' ''' || url || '''' AS command FROM (
    SELECT page_id, url, CASE page_id % 3 WHEN 0 THEN 'Debug' WHEN 1 THEN 'Release' ELSE 'other' END AS mode, CASE page_id % 2 WHEN 0 THEN 'x86' ELSE 'x64' END AS library, 'v14' || page_id % 3 AS toolset FROM pages)"""
)
def windows_commands(spark: SparkSession, sf_dir: str) -> DataFrame:
    k = F.col("page_id")
    mode = F.when(k % 3 == 0, "Debug").when(k % 3 == 1, "Release").otherwise("other")
    library = F.when(k % 2 == 0, "x86").otherwise("x64")
    return _load(spark, sf_dir, "pages").select("page_id", text.windows_command(mode, library, F.concat(F.lit("v14"), k % 3), F.col("url")).alias("command"))


@query("SELECT o_orderkey, least(o_custkey, o_orderkey) AS low, greatest(o_custkey, o_orderkey) AS high, (o_custkey * 37 // 1024)::BIGINT AS kb, round((o_custkey % 1000) / 10.0 / 100, 6)::DOUBLE AS ratio FROM orders")
def number_functions(spark: SparkSession, sf_dir: str) -> DataFrame:
    percent = F.concat((F.col("o_custkey") % 1000 / 10).cast("string"), F.lit("%"))
    return _load(spark, sf_dir, "orders").select("o_orderkey", F.least("o_custkey", "o_orderkey").alias("low"), F.greatest("o_custkey", "o_orderkey").alias("high"), numbers.whole_kb(F.col("o_custkey") * 37).alias("kb"), F.round(text.ratio_of_percent(percent), 6).alias("ratio"))


@query("SELECT s_suppkey, 'set(KEY ' || s_name || ')' || chr(10) || 'set(NATION ' || s_nationkey || ')' AS settings, 's' || s_suppkey || ' (MD5: ' || md5(s_name) || ')' AS path, 's' || s_suppkey AS file, md5(s_name) AS digest FROM supplier")
def settings_and_digests(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = F.concat(F.lit("s"), "s_suppkey", F.lit(" (MD5: "), F.md5("s_name"), F.lit(")"))
    parts = text.digest_of_path(path)
    return _load(spark, sf_dir, "supplier").select("s_suppkey", text.set_lines(F.create_map(F.lit("NATION"), F.col("s_nationkey").cast("string"), F.lit("KEY"), F.col("s_name"))).alias("settings"), path.alias("path"), parts["file"].alias("file"), parts["digest"].alias("digest"))


@query("SELECT p_partkey, (p_size // 10)::INT AS major, (p_size % 10)::INT AS minor, (p_size // 10, p_size % 10) <= (3, 2) AS older FROM part")
def version_compare(spark: SparkSession, sf_dir: str) -> DataFrame:
    version = F.concat_ws("-", (F.floor(F.col("p_size") / 10)).cast("int"), F.col("p_size") % 10)
    parts = text.version_parts(version)
    return _load(spark, sf_dir, "part").select("p_partkey", parts[0].alias("major"), parts[1].alias("minor"), text.version_at_most(version, F.lit("3.2")).alias("older"))


@query("SELECT page_id, list_filter(string_split(url, '/'), lambda x: x <> '' AND NOT contains(x, ':')).array_to_string(';') AS parts, len(string_split(url, '/')) AS n FROM pages")
def list_functions(spark: SparkSession, sf_dir: str) -> DataFrame:
    parts = F.split("url", "/")
    return _load(spark, sf_dir, "pages").select("page_id", F.array_join(F.filter(parts, lambda x: (x != "") & ~x.contains(":")), ";").alias("parts"), F.size(parts).cast("long").alias("n"))
