"""Queries over the control tables: lookups, searches, joins, counters, dispatch, updates."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from buildlake import schemas as S
from buildlake.functions import times
from buildlake.operators import lookup, metrics, tasks
from buildlake.plans.registry import Registry
from buildlake.sources import roles

REGISTRY = query = Registry()

# the end of the test tables' time
NOW = 996_624_000  # 2001-08-01
EVENT_NOW = 1_706_572_800  # 2024-01-30


def _events(spark: SparkSession, sf_dir: str) -> DataFrame:
    return roles.load(spark, sf_dir, "events")


_WINDOWED = ", ".join(
    f"count_if({cond} AND mod_timestamp > {NOW} - {span})::BIGINT AS {name}_{window}"
    for name, cond in (("cloned", "clone_status = 3"), ("clone_failed", "clone_status = 2"), ("built", "build_status = 3"), ("build_failed", "build_status IN (2, 10)"))
    for window, span in metrics.WINDOWS.items()
)
_WINDOWED_FILES = ", ".join(
    f"count_if({cond} AND epoch(build_date) > {NOW} - {span})::BIGINT AS {name}_{window}"
    for name, cond in (("binaries", "true"), ("windows_binaries", "(ends_with(file_name, '.exe') OR ends_with(file_name, '.dll'))"))
    for window, span in metrics.WINDOWS.items()
)


@query(f"SELECT * FROM (SELECT {_WINDOWED} FROM statuses), (SELECT {_WINDOWED_FILES} FROM binaries)", roles=True)
def progress_counters(spark: SparkSession, sf_dir: str) -> DataFrame:
    return metrics.progress(roles.statuses(spark, sf_dir), roles.binaries(spark, sf_dir), NOW)


_EVENT_KINDS = ("click", "error", "purchase", "signup", "view")


@query(f"SELECT {', '.join(f"count_if(event_type = '{k}' AND epoch(ts) > {EVENT_NOW} - {s})::BIGINT AS {k}_{w}" for k in _EVENT_KINDS for w, s in metrics.WINDOWS.items())} FROM events")
def progress_events(spark: SparkSession, sf_dir: str) -> DataFrame:
    return metrics.windowed_counts(_events(spark, sf_dir), times.exact_epoch(F.col("ts")), EVENT_NOW, {k: F.col("event_type") == k for k in _EVENT_KINDS})


@query("SELECT count(_id) AS total, count_if(clone_status = 3)::BIGINT AS cloned, count_if(build_status = 3)::BIGINT AS built FROM statuses", roles=True)
def repo_info_totals(spark: SparkSession, sf_dir: str) -> DataFrame:
    return metrics.totals(roles.statuses(spark, sf_dir))


@query("SELECT build_system, count(*) AS n FROM projects GROUP BY build_system", roles=True)
def build_system_histogram(spark: SparkSession, sf_dir: str) -> DataFrame:
    return metrics.histogram(roles.projects(spark, sf_dir), "build_system")


@query("SELECT clone_status, priority, count(*) AS n FROM statuses GROUP BY ROLLUP (clone_status, priority)", roles=True)
def status_rollup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return metrics.rollup_counts(roles.statuses(spark, sf_dir), "clone_status", "priority")


@query("SELECT * FROM statuses WHERE _id = 7 UNION ALL SELECT * FROM statuses WHERE repo_id = 7 AND _id <> 7", roles=True)
def status_point_lookup(spark: SparkSession, sf_dir: str) -> DataFrame:
    s = roles.statuses(spark, sf_dir)
    return lookup.by_id(s, 7).unionByName(lookup.by_id(s, 7, "repo_id").where("_id <> 7"))


@query("SELECT * FROM statuses WHERE clone_status = 3 AND build_status IN (2, 10) AND build_opt_id = 2", roles=True)
def statuses_matching(spark: SparkSession, sf_dir: str) -> DataFrame:
    return lookup.matching(roles.statuses(spark, sf_dir), clone_status=S.SUCCESS, build_status=S.FAILURES, build_opt_id=2, priority=None)


@query("SELECT * FROM options WHERE enable", roles=True)
def enabled_options(spark: SparkSession, sf_dir: str) -> DataFrame:
    return roles.options(spark, sf_dir).where("enable")


@query("SELECT file_name, size, status_id FROM binaries WHERE NOT disasmed AND (ends_with(file_name, '.exe') OR ends_with(file_name, '.dll')) AND NOT contains(file_name, '11')", roles=True)
def pending_binaries(spark: SparkSession, sf_dir: str) -> DataFrame:
    name = F.col("file_name")
    return roles.binaries(spark, sf_dir).where(~F.col("disasmed") & (name.endswith(".exe") | name.endswith(".dll")) & ~name.contains("11")).select("file_name", "size", "status_id")


@query("SELECT p.*, s._id AS status_id, s.priority AS urgency FROM projects p JOIN statuses s ON s.repo_id = p._id WHERE clone_status = 3 AND build_status IN (2, 10) ORDER BY urgency DESC, status_id LIMIT 100", roles=True)
def repos_by_status(spark: SparkSession, sf_dir: str) -> DataFrame:
    return lookup.repositories_by_status(roles.projects(spark, sf_dir), roles.statuses(spark, sf_dir), S.SUCCESS, S.FAILURES, limit=100)


@query("SELECT p.*, s._id AS status_id, s.priority AS urgency FROM projects p JOIN statuses s ON s.repo_id = p._id WHERE clone_status = 2 AND build_status = 0", roles=True)
def clone_failures(spark: SparkSession, sf_dir: str) -> DataFrame:
    return lookup.repositories_by_status(roles.projects(spark, sf_dir), roles.statuses(spark, sf_dir), S.FAILED, S.INIT)


_RANGE = (852_076_800, 883_612_800)  # 1997


@query(f"SELECT * FROM projects WHERE _id IN (SELECT repo_id FROM statuses WHERE build_status = 3 AND mod_timestamp > {_RANGE[0]} AND mod_timestamp < {_RANGE[1]})", roles=True)
def dump_success_repos(spark: SparkSession, sf_dir: str) -> DataFrame:
    s = roles.statuses(spark, sf_dir)
    return lookup.repositories_with(roles.projects(spark, sf_dir), lookup.changed_between(s, *_RANGE).where(F.col("build_status") == S.SUCCESS))


@query(f"SELECT _id, build_opt_id, repo_id, clone_status, build_status, mod_timestamp, build_time FROM statuses WHERE build_status = 3 AND mod_timestamp > {_RANGE[0]} AND mod_timestamp < {_RANGE[1]}", roles=True)
def dump_success_status(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = lookup.changed_between(roles.statuses(spark, sf_dir), *_RANGE).where(F.col("build_status") == S.SUCCESS)
    return found.select("_id", "build_opt_id", "repo_id", "clone_status", "build_status", "mod_timestamp", "build_time")


@query("SELECT * FROM projects WHERE contains(name, '00001') AND contains(url, 'machinery')", roles=True)
def search_repo_name_url(spark: SparkSession, sf_dir: str) -> DataFrame:
    return lookup.containing(roles.projects(spark, sf_dir), name="00001", url="machinery")


@query("SELECT * FROM projects WHERE url ILIKE '%BUILDING%'", roles=True)
def search_repo_ignore_case(spark: SparkSession, sf_dir: str) -> DataFrame:
    return lookup.containing(roles.projects(spark, sf_dir), ignore_case=True, url="BUILDING", name="")


@query("SELECT DISTINCT p.* FROM projects p JOIN statuses s ON s.repo_id = p._id JOIN options o ON o._id = s.build_opt_id WHERE contains(o._id::VARCHAR, '1') AND contains(p.name, '2')", roles=True)
def search_repo_numeric_like(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = lookup.containing(roles.options(spark, sf_dir), _id="1").select(F.col("_id").alias("build_opt_id"))
    of = roles.statuses(spark, sf_dir).join(found, "build_opt_id", "left_semi")
    return lookup.repositories_with(lookup.containing(roles.projects(spark, sf_dir), name="2"), of)


@query("SELECT s._id AS status_id, p.name, o.platform FROM statuses s JOIN projects p ON p._id = s.repo_id JOIN options o ON o._id = s.build_opt_id WHERE s.build_status = 10", roles=True)
def status_repo_option(spark: SparkSession, sf_dir: str) -> DataFrame:
    s = lookup.matching(roles.statuses(spark, sf_dir), build_status=S.COMMAND_FAILED).select(F.col("_id").alias("status_id"), "repo_id", "build_opt_id")
    p = roles.projects(spark, sf_dir).select(F.col("_id").alias("repo_id"), "name")
    o = roles.options(spark, sf_dir).select(F.col("_id").alias("build_opt_id"), "platform")
    return s.join(p, "repo_id").join(o, "build_opt_id").select("status_id", "name", "platform")


@query("SELECT p._id AS repo_id, o._id AS build_opt_id, 0 AS clone_status, 0 AS build_status, 0 AS priority FROM projects p, options o WHERE contains(o.build_system, p.build_system)", roles=True)
def fanout_new_repos(spark: SparkSession, sf_dir: str) -> DataFrame:
    return tasks.fan_out(roles.projects(spark, sf_dir), roles.options(spark, sf_dir), project_in_option=True)


@query("SELECT p._id AS repo_id, o._id AS build_opt_id, 0 AS clone_status, 0 AS build_status, 0 AS priority FROM projects p, options o WHERE contains(p.build_system, o.build_system)", roles=True)
def fanout_new_option(spark: SparkSession, sf_dir: str) -> DataFrame:
    return tasks.fan_out(roles.projects(spark, sf_dir), roles.options(spark, sf_dir), project_in_option=False)


@query(
    """SELECT build_opt_id AS opt_id, task_id, repo_id, name, url, p.build_system, platform, priority, mod_timestamp FROM (
    SELECT build_opt_id, _id AS task_id, repo_id, priority, mod_timestamp, row_number() OVER (PARTITION BY build_opt_id ORDER BY priority DESC, _id) AS r
    FROM statuses WHERE clone_status = 1 AND build_status = 0) t JOIN options o ON o._id = build_opt_id AND enable JOIN projects p ON p._id = repo_id WHERE r = 1""",
    roles=True,
)
def dispatch_next_task(spark: SparkSession, sf_dir: str) -> DataFrame:
    return tasks.next_tasks(roles.statuses(spark, sf_dir), roles.projects(spark, sf_dir), roles.options(spark, sf_dir))


@query(
    """SELECT s.build_opt_id AS opt_id, arg_min(s._id, (-s.priority, s._id)) AS task_id FROM statuses s JOIN projects p ON p._id = s.repo_id JOIN options o ON o._id = s.build_opt_id
    WHERE s.clone_status = 1 AND s.build_status = 0 AND o.enable AND contains(p.build_system, o.build_system) GROUP BY s.build_opt_id""",
    roles=True,
)
def dispatch_fitting_task(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The next task among those whose project is built with the option's build system."""
    return tasks.next_tasks(roles.statuses(spark, sf_dir), roles.projects(spark, sf_dir), roles.options(spark, sf_dir), same_build_system=True).select("opt_id", "task_id")


@query("SELECT * FROM statuses WHERE clone_status = 2 AND build_status = 0 AND repo_id IN (SELECT repo_id FROM statuses WHERE clone_status = 3 AND build_status = 3)", roles=True)
def recycle_clone_failures(spark: SparkSession, sf_dir: str) -> DataFrame:
    s = roles.statuses(spark, sf_dir)
    return tasks.recyclable(s).select(*s.columns)


@query("SELECT clone_status, build_status, count(*) AS n FROM (SELECT CASE WHEN clone_status = 2 AND build_status = 0 AND repo_id IN (SELECT repo_id FROM statuses WHERE clone_status = 3 AND build_status = 3) THEN 0 ELSE clone_status END AS clone_status, build_status FROM statuses) GROUP BY ALL", roles=True)
def recycled_states(spark: SparkSession, sf_dir: str) -> DataFrame:
    return metrics.histogram(tasks.recycled(roles.statuses(spark, sf_dir)), "clone_status", "build_status")


@query(f"SELECT _id, CASE WHEN clone_status = 1 AND {NOW} - mod_timestamp >= 100000000 THEN 0 ELSE clone_status END AS clone_status, CASE WHEN clone_status = 1 AND {NOW} - mod_timestamp >= 100000000 THEN 0 ELSE build_status END AS build_status FROM statuses", roles=True)
def reset_timeouts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return tasks.timed_out(roles.statuses(spark, sf_dir), NOW, 100_000_000).select("_id", "clone_status", "build_status")


@query(
    """SELECT s._id, coalesce(u.clone_status, s.clone_status) AS clone_status, coalesce(u.build_time, s.build_time) AS build_time FROM statuses s LEFT JOIN (
    SELECT user_id AS _id, arg_max(CASE event_type WHEN 'error' THEN 2 WHEN 'view' THEN 3 END, event_id) FILTER (event_type IN ('error', 'view')) AS clone_status,
    arg_max(floor(value)::BIGINT, event_id) FILTER (event_type = 'purchase') AS build_time FROM events GROUP BY user_id) u ON u._id = s._id""",
    roles=True,
)
def merge_status_updates(spark: SparkSession, sf_dir: str) -> DataFrame:
    kind = F.col("event_type")
    updates = _events(spark, sf_dir).select(
        F.col("user_id").alias("_id"),
        "event_id",
        F.when(kind == "error", S.FAILED).when(kind == "view", S.SUCCESS).alias("clone_status"),
        F.when(kind == "purchase", F.floor("value").cast("long")).alias("build_time"),
    )
    return tasks.merged(roles.statuses(spark, sf_dir), updates, "_id", ["event_id"]).select("_id", "clone_status", "build_time")


@query("SELECT user_id, event_type, event_id, ts FROM (SELECT *, row_number() OVER (PARTITION BY user_id, event_type ORDER BY ts DESC, event_id DESC) AS r FROM events) WHERE r = 1")
def latest_event(spark: SparkSession, sf_dir: str) -> DataFrame:
    return metrics.latest(_events(spark, sf_dir), ["user_id", "event_type"], ["ts", "event_id"], "event_id", "ts")


@query("SELECT host, page_id, url FROM (SELECT split_part(url, '/', 3) AS host, page_id, url, row_number() OVER (PARTITION BY split_part(url, '/', 3) ORDER BY page_id) AS r FROM pages) WHERE r = 1")
def insert_ignore_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = roles.load(spark, sf_dir, "pages").select(F.split_part("url", F.lit("/"), F.lit(3)).alias("host"), "page_id", "url")
    return tasks.keep_first(rows, ["host"], ["page_id"])


@query("SELECT min(event_id) AS event_id, user_id, event_type FROM events WHERE (user_id, event_type) NOT IN (SELECT user_id, event_type FROM events WHERE epoch(ts) < 1705000000) GROUP BY user_id, event_type")
def insert_new_keys(spark: SparkSession, sf_dir: str) -> DataFrame:
    events = _events(spark, sf_dir)
    old = events.where(times.epoch(F.col("ts")) < 1_705_000_000).select("user_id", "event_type")
    return tasks.keep_first(events.select("event_id", "user_id", "event_type"), ["user_id", "event_type"], ["event_id"], old)


@query("SELECT _id, enable OR _id = 3 AS enable FROM options", roles=True)
def enable_option(spark: SparkSession, sf_dir: str) -> DataFrame:
    return tasks.with_flag(roles.options(spark, sf_dir), F.col("_id"), 3, "enable", True).select("_id", "enable")


@query("SELECT build_opt_id, repo_id, mod_timestamp, 0 AS clone_status, 0 AS build_status, 0 AS build_time FROM statuses WHERE build_status = 3", roles=True)
def restore_statuses(spark: SparkSession, sf_dir: str) -> DataFrame:
    return tasks.restored_statuses(lookup.matching(roles.statuses(spark, sf_dir), build_status=S.SUCCESS))


@query(
    """, gone AS (SELECT _id FROM projects WHERE build_system = 'sln') SELECT
    (SELECT count(*) FROM projects WHERE _id NOT IN (FROM gone)) AS projects, (SELECT count(*) FROM statuses WHERE repo_id NOT IN (FROM gone)) AS statuses,
    (SELECT count(*) FROM binaries WHERE status_id NOT IN (SELECT _id FROM statuses WHERE repo_id IN (FROM gone))) AS binaries""",
    roles=True,
)
def cascade_delete(spark: SparkSession, sf_dir: str) -> DataFrame:
    p = roles.projects(spark, sf_dir)
    left = tasks.cascade_delete(p, roles.statuses(spark, sf_dir), roles.binaries(spark, sf_dir), p.where("build_system = 'sln'").select("_id"))
    one = [t.agg(F.count(F.lit(1)).alias(n)) for t, n in zip(left, ("projects", "statuses", "binaries"), strict=True)]
    return one[0].crossJoin(one[1]).crossJoin(one[2])  # one row each


@query("SELECT b.* FROM binaries b WHERE status_id NOT IN (SELECT _id FROM statuses WHERE clone_status = 3)", roles=True)
def orphan_binaries(spark: SparkSession, sf_dir: str) -> DataFrame:
    s = lookup.matching(roles.statuses(spark, sf_dir), clone_status=S.SUCCESS)
    b = roles.binaries(spark, sf_dir)
    return tasks.orphans(b, s, "status_id", "_id").select(*b.columns)


@query("SELECT _id AS id, name, replace(replace(url, 'repos/', ''), 'api.', '') AS url, owner_id, build_system, size FROM projects", roles=True)
def repository_export(spark: SparkSession, sf_dir: str) -> DataFrame:
    return lookup.repository_export(roles.projects(spark, sf_dir))


@query("SELECT _id::BIGINT AS id, name, url, greatest(size, 0)::BIGINT AS size, greatest(owner_id, 0)::INTEGER AS owner_id FROM projects", roles=True)
def repository_messages(spark: SparkSession, sf_dir: str) -> DataFrame:
    return lookup.repository_message(roles.projects(spark, sf_dir))


@query("SELECT _id, platform, build_system, true AS enable FROM options", roles=True)
def export_and_restore(spark: SparkSession, sf_dir: str) -> DataFrame:
    o = roles.options(spark, sf_dir)
    return lookup.restored(lookup.export_document(o.withColumnRenamed("_id", "id"), "buildopt"), "buildopt", "id int, platform string, build_system string, enable boolean")


@query("SELECT user_id, event_id, (row_number() OVER (PARTITION BY user_id ORDER BY ts, event_id) - 1) // 10 AS batch FROM events")
def microbatches(spark: SparkSession, sf_dir: str) -> DataFrame:
    return tasks.micro_batches(_events(spark, sf_dir), ["user_id"], ["ts", "event_id"]).select("user_id", "event_id", "batch")


@query(f"SELECT user_id, date_trunc('second', max(ts)) AS last_seen, abs({EVENT_NOW} - floor(epoch(max(ts)))::BIGINT) < 86400 AS alive FROM events GROUP BY user_id")
def worker_liveness(spark: SparkSession, sf_dir: str) -> DataFrame:
    seen = tasks.live_workers(_events(spark, sf_dir), "user_id", times.epoch(F.col("ts")), F.lit(EVENT_NOW), 86400)
    return seen.withColumn("last_seen", F.timestamp_seconds("last_seen").cast("timestamp_ntz"))


@query("SELECT event_id, user_id, coalesce(c_nationkey, 0) AS opt_id FROM events LEFT JOIN customer ON c_custkey = user_id WHERE event_type = 'view'")
def worker_assignment(spark: SparkSession, sf_dir: str) -> DataFrame:
    pings = _events(spark, sf_dir).where("event_type = 'view'").select("event_id", "user_id")
    control = roles.load(spark, sf_dir, "customer").select(F.col("c_custkey").alias("user_id"), F.col("c_nationkey").alias("opt_id"))
    return tasks.assigned(pings, control, "user_id").select("event_id", "user_id", "opt_id")


@query("SELECT owner_id, sum(n)::BIGINT AS found, sum(sum(n)) OVER (ORDER BY owner_id)::BIGINT AS total FROM (SELECT owner_id, 1 AS n FROM projects) GROUP BY owner_id", roles=True)
def running_binary_total(spark: SparkSession, sf_dir: str) -> DataFrame:
    return metrics.running_total(roles.projects(spark, sf_dir), "owner_id", F.lit(1))


@query("SELECT _id, 'line ' || row_number() OVER (PARTITION BY build_system ORDER BY _id) || ': ' || name AS line FROM projects", roles=True)
def numbered_listing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return lookup.numbered_lines(roles.projects(spark, sf_dir), F.col("name"), ["build_system"], ["_id"]).select("_id", "line")


@query("SELECT d.doc_id FROM documents d WHERE NOT EXISTS (SELECT 1 FROM benchmark b WHERE contains(d.text, b.text) OR contains(b.text, d.text))")
def blacklist_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = roles.load(spark, sf_dir, "documents").select("doc_id", "text")
    return lookup.without_blacklisted(docs, F.col("text"), roles.load(spark, sf_dir, "benchmark"), "text").select("doc_id")


@query(
    """SELECT c_custkey FROM customer WHERE NOT EXISTS (SELECT 1 FROM
    (SELECT 'x Customer#' || lpad(n_nationkey::VARCHAR, 9, '0') AS item FROM nation UNION SELECT right(s_name, 3) || '5' FROM supplier UNION SELECT '7' || p_size FROM part WHERE p_size < 3) i
    WHERE contains(c_name, item) OR contains(item, c_name))"""
)
def blacklist_names(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Names of one word against items of one or two words, shorter and longer than they are."""
    load = lambda t: roles.load(spark, sf_dir, t)
    longer = load("nation").select(F.concat(F.lit("x Customer#"), F.lpad(F.col("n_nationkey").cast("string"), 9, "0")).alias("item"))
    shorter = load("supplier").select(F.concat(F.right("s_name", F.lit(3)), F.lit("5"))).union(load("part").where("p_size < 3").select(F.concat(F.lit("7"), "p_size")))
    return lookup.without_blacklisted(load("customer"), F.col("c_name"), longer.union(shorter), "item").select("c_custkey")


@query("SELECT doc_id, lang FROM documents WHERE doc_id IN (SELECT doc_id FROM labels)")
def reviewed(spark: SparkSession, sf_dir: str) -> DataFrame:
    return roles.load(spark, sf_dir, "documents").select("doc_id", "lang").join(roles.load(spark, sf_dir, "labels"), "doc_id", "left_semi")


@query("SELECT doc_id, lang FROM documents WHERE doc_id NOT IN (SELECT doc_id FROM labels)")
def unreviewed(spark: SparkSession, sf_dir: str) -> DataFrame:
    return roles.load(spark, sf_dir, "documents").select("doc_id", "lang").join(roles.load(spark, sf_dir, "labels"), "doc_id", "left_anti")


@query("SELECT doc_id, n_chars, (n_chars // 1024)::BIGINT AS kb FROM documents WHERE n_chars / 1024 BETWEEN 1 AND 4 ORDER BY md5(doc_id::VARCHAR), doc_id LIMIT 200")
def size_filter_limit(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = roles.load(spark, sf_dir, "documents").select("doc_id", "n_chars", F.md5(F.col("doc_id").cast("string")).alias("name"))
    found = lookup.first_by_name(lookup.within_size(docs, F.col("n_chars"), 1, 4), 200, "name", "doc_id")
    return found.select("doc_id", "n_chars", F.floor(F.col("n_chars") / 1024).cast("long").alias("kb"))


@query("SELECT c_mktsegment, c_nationkey FROM customer UNION SELECT c_mktsegment, c_nationkey FROM customer WHERE c_acctbal > 0 EXCEPT SELECT c_mktsegment, c_nationkey FROM customer WHERE c_acctbal > 9000")
def set_operations(spark: SparkSession, sf_dir: str) -> DataFrame:
    c = roles.load(spark, sf_dir, "customer")
    keys = lambda t: t.select("c_mktsegment", "c_nationkey")
    return keys(c).union(keys(c.where("c_acctbal > 0"))).distinct().subtract(keys(c.where("c_acctbal > 9000")))
