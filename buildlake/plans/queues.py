"""Queries over messages: admission, guards, routing, eviction, commands, records, versions."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from buildlake import schemas as S
from buildlake.functions import text, times
from buildlake.operators import debuginfo, lookup, queues
from buildlake.plans.control import EVENT_NOW
from buildlake.plans.registry import Registry
from buildlake.sources import roles

REGISTRY = query = Registry()

_TTL = 20 * S.DAY


def _nearest_second(ts: str) -> F.Column:
    """A time's second, rounded to the nearest one (a half to the even one), as the SQL's cast does."""
    return F.rint(times.exact_epoch(F.col(ts))).cast("long")


@query(
    f"""WITH e AS (SELECT event_id, event_type, ts, {EVENT_NOW} - epoch(ts)::BIGINT AS age FROM events),
    f AS (SELECT event_id, row_number() OVER (PARTITION BY event_type ORDER BY ts, event_id) AS n FROM e WHERE age < {_TTL})
    SELECT event_id, event_type, CASE WHEN age >= {_TTL} THEN 'expired' WHEN n <= 70 THEN 'queued' ELSE 'rejected' END AS verdict FROM e LEFT JOIN f USING (event_id)"""
)
def queue_admission(spark: SparkSession, sf_dir: str) -> DataFrame:
    events = roles.load(spark, sf_dir, "events").select("event_id", "event_type", "ts")
    age = F.lit(EVENT_NOW) - _nearest_second("ts")
    return queues.admission(events, "event_type", ["ts", "event_id"], age, capacity=70, ttl=_TTL).drop("ts")


@query(
    f"""SELECT s._id, CASE WHEN o.platform IN ('ASIA', 'EUROPE') AND p.build_system <> 'sln' THEN {S.BLACKLIST} ELSE s.clone_status END AS clone_status
    FROM statuses s JOIN projects p ON p._id = s.repo_id JOIN options o ON o._id = s.build_opt_id""",
    roles=True,
)
def guarded_tasks(spark: SparkSession, sf_dir: str) -> DataFrame:
    repo = roles.projects(spark, sf_dir).select(F.col("_id").alias("repo_id"), "build_system")
    option = roles.options(spark, sf_dir).select(F.col("_id").alias("build_opt_id"), "platform")
    tasks = roles.statuses(spark, sf_dir).select("_id", "repo_id", "build_opt_id", "clone_status").join(repo, "repo_id").join(option, "build_opt_id")
    return queues.guarded(tasks, F.col("platform").isin("ASIA", "EUROPE"), F.col("build_system")).select("_id", "clone_status")


@query(
    """SELECT 'post_analysis.' || s.build_opt_id AS queue, b.status_id, b.file_name FROM binaries b JOIN statuses s ON s._id = b.status_id
    WHERE NOT contains(file_name, 'linux') AND (ends_with(file_name, '.exe') OR ends_with(file_name, '.dll'))""",
    roles=True,
)
def analysis_messages(spark: SparkSession, sf_dir: str) -> DataFrame:
    return queues.analysis_messages(roles.binaries(spark, sf_dir), roles.statuses(spark, sf_dir))


@query(f"SELECT event_id, ts FROM events WHERE {EVENT_NOW} - epoch(ts)::BIGINT > 60")
def cache_eviction(spark: SparkSession, sf_dir: str) -> DataFrame:
    return queues.outlived(roles.load(spark, sf_dir, "events").select("event_id", "ts"), _nearest_second("ts"), F.lit(EVENT_NOW))


@query(
    """WITH l AS (SELECT event_id, event_type || CASE WHEN event_id % 3 = 0 THEN '' ELSE '  ' || user_id END || CASE WHEN event_id % 5 = 0 THEN ' all ' ELSE '' END AS line FROM events),
    w AS (SELECT event_id, list_filter(regexp_split_to_array(trim(line), '\\s+'), lambda x: x <> '') AS w FROM l)
    SELECT event_id, w[1] AS command, array_to_string(w[2:], ',') AS args, CASE w[1] WHEN 'view' THEN len(w) = 2 WHEN 'click' THEN len(w) = 1 WHEN 'error' THEN len(w) = 3 ELSE false END AS valid FROM w"""
)
def console_commands(spark: SparkSession, sf_dir: str) -> DataFrame:
    line = F.expr("event_type || CASE WHEN event_id % 3 = 0 THEN '' ELSE '  ' || user_id END || CASE WHEN event_id % 5 = 0 THEN ' all ' ELSE '' END")
    lines = roles.load(spark, sf_dir, "events").select("event_id", line.alias("line"))
    return queues.parsed_commands(lines, "line", {"view": 1, "click": 0, "error": 2}).select("event_id", "command", F.array_join("args", ",").alias("args"), "valid")


@query("SELECT _id, 'id: ' || _id || chr(10) || 'name: ' || name || chr(10) || 'url: ' || url || chr(10) || 'build system: ' || build_system || chr(10) || 'size: ' || size AS record FROM projects", roles=True)
def console_records(spark: SparkSession, sf_dir: str) -> DataFrame:
    fields = {"id": "_id", "name": "name", "url": "url", "build system": "build_system", "size": "size"}
    return roles.projects(spark, sf_dir).select("_id", lookup.console_record({label: F.col(c) for label, c in fields.items()}).alias("record"))


@query("SELECT _id, url, greatest(owner_id, 0) AS owner_id, name, greatest(size, 0)::BIGINT AS size FROM projects", roles=True)
def repository_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    return lookup.repository_rows(lookup.repository_message(roles.projects(spark, sf_dir)))


@query(
    """WITH c AS (SELECT o_custkey, o_orderdate, o_orderkey, [o_orderkey % 4, o_orderkey % 11, o_orderkey % 3] AS v FROM orders)
    SELECT o_custkey, arg_max(o_orderkey, struct_pack(d := o_orderdate, k := o_orderkey)) AS o_orderkey FROM c JOIN customer ON c_custkey = o_custkey WHERE v <= [c_nationkey % 4, 5] GROUP BY o_custkey"""
)
def newest_wanted_version(spark: SparkSession, sf_dir: str) -> DataFrame:
    key = F.col("o_orderkey")
    version = F.concat(key % 4, F.lit("."), key % 11, F.lit("-"), key % 3)
    commits = roles.load(spark, sf_dir, "orders").select("o_custkey", "o_orderdate", "o_orderkey", version.alias("version"))
    wanted = roles.load(spark, sf_dir, "customer").select(F.col("c_custkey").alias("o_custkey"), F.concat(F.col("c_nationkey") % 4, F.lit(".5")).alias("wanted"))
    return queues.newest_at_most(commits, wanted, "o_custkey", "version", "wanted", ["o_orderdate", "o_orderkey"], "o_orderkey").drop("wanted")


@query(
    """WITH r AS (SELECT doc_id, unnest(string_split(text, chr(10))) AS line, generate_subscripts(string_split(text, chr(10)), 1) - 1 AS pos FROM documents),
    t AS (SELECT doc_id, pos, CASE WHEN pos % 2 = 1 THEN '' ELSE line END AS source_code, line FROM r),
    g AS (SELECT doc_id, min(pos) FILTER (WHERE source_code = '') AS gap FROM t GROUP BY doc_id)
    SELECT doc_id, pos::INTEGER AS line_number, CASE WHEN pos = gap THEN line ELSE source_code END AS source_code FROM t JOIN g USING (doc_id)"""
)
def filled_source_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = roles.load(spark, sf_dir, "documents")
    lines = docs.select("doc_id", F.posexplode(F.split("text", "\n")).alias("line_number", "line")).withColumn("source_file", F.col("doc_id").cast("string"))
    rows = lines.select("doc_id", "source_file", "line_number", F.when(F.col("line_number") % 2 == 1, "").otherwise(F.col("line")).alias("source_code"))
    known = lines.select("source_file", "line_number", F.col("line").alias("source_code"))
    return debuginfo.first_gap_filled(rows, ["doc_id"], ["line_number"], known).drop("source_file")
