"""The task table as data: fan-out, dispatch, recycling, time-outs, merges, keep-first inserts, cascades."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from buildlake import schemas as S
from buildlake.functions import times


def fan_out(projects: DataFrame, options: DataFrame, project_in_option: bool) -> DataFrame:
    """Initial statuses for every matching (project, option).

    A match is a substring of one build system in the other: the project's in
    the option's (new projects) or the reverse (new options). Build systems
    are few, so the substring test joins the distinct values of both sides;
    the projects themselves are then joined by equality.
    """
    p = projects.select(F.col("_id").alias("repo_id"), F.col("build_system").alias("repo_bs"))
    o = options.select(F.col("_id").alias("build_opt_id"), F.col("build_system").alias("opt_bs"))
    inside = F.col("opt_bs").contains(F.col("repo_bs")) if project_in_option else F.col("repo_bs").contains(F.col("opt_bs"))
    pairs = p.select("repo_bs").distinct().join(o.select("opt_bs").distinct(), inside)
    return p.join(pairs, "repo_bs").join(o, "opt_bs").select("repo_id", "build_opt_id", F.lit(S.INIT).alias("clone_status"), F.lit(S.INIT).alias("build_status"), F.lit(0).alias("priority"))


def next_tasks(statuses: DataFrame, projects: DataFrame, options: DataFrame, same_build_system: bool = False) -> DataFrame:
    """For each enabled option its next task: not started, most urgent, lowest key; with what a worker needs to know.

    ``same_build_system``: only tasks whose project's build system contains the
    option's. The pick is a partial aggregation, so the queue's length costs
    no sort.
    """
    waiting = statuses.where((F.col("clone_status") == S.PROCESSING) & (F.col("build_status") == S.INIT))
    if same_build_system:
        fitting = fan_out(projects, options, project_in_option=False).select("repo_id", "build_opt_id")
        waiting = waiting.join(fitting, ["repo_id", "build_opt_id"], "left_semi")
    first = waiting.groupBy("build_opt_id").agg(F.min_by(F.struct("_id", "repo_id", "priority", "mod_timestamp"), F.struct(-F.col("priority"), F.col("_id"))).alias("t"))
    enabled = options.where("enable").select(F.col("_id").alias("opt_id"), "platform")
    task = first.select(F.col("build_opt_id").alias("opt_id"), "t.*").withColumnRenamed("_id", "task_id").join(enabled, "opt_id")
    repo = projects.select(F.col("_id").alias("repo_id"), "name", "url", "build_system")
    return task.join(repo, "repo_id").select("opt_id", "task_id", "repo_id", "name", "url", "build_system", "platform", "priority", "mod_timestamp")


def recyclable(statuses: DataFrame) -> DataFrame:
    """Failed clones of repositories that another option has built."""
    good = statuses.where((F.col("clone_status") == S.SUCCESS) & (F.col("build_status") == S.SUCCESS)).select("repo_id")
    return statuses.where((F.col("clone_status") == S.FAILED) & (F.col("build_status") == S.INIT)).join(good, "repo_id", "left_semi")


def recycled(statuses: DataFrame) -> DataFrame:
    """All statuses; those that ``recyclable`` names are initial again."""
    good = statuses.where((F.col("clone_status") == S.SUCCESS) & (F.col("build_status") == S.SUCCESS)).select(F.col("repo_id").alias("__good")).distinct()
    hit = (F.col("clone_status") == S.FAILED) & (F.col("build_status") == S.INIT) & F.col("__good").isNotNull()
    return statuses.join(good, F.col("repo_id") == F.col("__good"), "left").withColumn("clone_status", F.when(hit, S.INIT).otherwise(F.col("clone_status"))).drop("__good")


def timed_out(statuses: DataFrame, now: int, ttl: int | None = S.TASK_TTL) -> DataFrame:
    """All statuses; clones in progress for ``ttl`` seconds or more (None: all of them) are initial again."""
    hit = F.col("clone_status") == S.PROCESSING
    if ttl is not None:
        hit &= times.is_stale(F.col("mod_timestamp"), F.lit(now), ttl)
    return statuses.withColumns({"clone_status": F.when(hit, S.INIT).otherwise(F.col("clone_status")), "build_status": F.when(hit, S.INIT).otherwise(F.col("build_status"))})


def merged(table: DataFrame, updates: DataFrame, key: str, order: list[str]) -> DataFrame:
    """``table`` with each key's newest non-null update of every column; what an update leaves out stays as it was."""
    columns = [c for c in updates.columns if c != key and c not in order]
    place = F.struct(*order)
    newest = updates.groupBy(key).agg(*[F.max_by(F.col(c), F.when(F.col(c).isNotNull(), place)).alias(f"__{c}") for c in columns])
    joined = table.join(newest, key, "left")
    return joined.select(*[F.coalesce(f"__{c}", c).alias(c) if c in columns else F.col(c) for c in table.columns])


def keep_first(rows: DataFrame, keys: list[str], order: list[str], existing: DataFrame | None = None) -> DataFrame:
    """Insert-ignore: the first row of each key that ``existing`` doesn't have."""
    rest = [c for c in rows.columns if c not in keys]
    first = rows.groupBy(*keys).agg(F.min_by(F.struct(*rest), F.struct(*order)).alias("__r")).select(*keys, "__r.*").select(*rows.columns)
    return first if existing is None else first.join(existing, keys, "left_anti")


def with_flag(table: DataFrame, key: Column, value: int, column: str, flag: bool) -> DataFrame:
    """``table`` with a boolean set for one key."""
    return table.withColumn(column, F.when(key == value, F.lit(flag)).otherwise(F.col(column)))


def restored_statuses(dump: DataFrame) -> DataFrame:
    """Statuses of a dump as new tasks: option, repository and time stay, states start over."""
    return dump.select("build_opt_id", "repo_id", "mod_timestamp", F.lit(S.INIT).alias("clone_status"), F.lit(S.INIT).alias("build_status"), F.lit(0).alias("build_time"))


def cascade_delete(projects: DataFrame, statuses: DataFrame, binaries: DataFrame, gone: DataFrame) -> tuple[DataFrame, DataFrame, DataFrame]:
    """The three tables without the projects in ``gone`` (_id) and everything that hangs on them."""
    left = projects.join(gone, "_id", "left_anti")
    lost = statuses.join(gone.withColumnRenamed("_id", "repo_id"), "repo_id", "left_semi").select(F.col("_id").alias("status_id"))
    kept = statuses.join(gone.withColumnRenamed("_id", "repo_id"), "repo_id", "left_anti")
    return left, kept, binaries.join(lost, "status_id", "left_anti")


def orphans(children: DataFrame, parents: DataFrame, child_key: str, parent_key: str) -> DataFrame:
    """Rows whose parent is missing: the foreign-key check."""
    return children.join(parents.select(F.col(parent_key).alias(child_key)), child_key, "left_anti")


def micro_batches(rows: DataFrame, per: list[str], order: list[str], size: int = 10) -> DataFrame:
    """Numbered batches of ``size`` rows within each group, the last one as large as what is left."""
    n = F.row_number().over(Window.partitionBy(*per).orderBy(*order))
    return rows.withColumn("batch", F.floor((n - 1) / size).cast("long"))


def live_workers(pings: DataFrame, key: str, ts: Column, now: Column, ttl: int = S.WORKER_TTL) -> DataFrame:
    """Each worker's last ping and whether it is younger than ``ttl`` seconds."""
    last = pings.groupBy(key).agg(F.max(ts).alias("last_seen"))
    return last.withColumn("alive", F.abs(now - F.col("last_seen")) < ttl)


def assigned(pings: DataFrame, assignments: DataFrame, key: str) -> DataFrame:
    """Pings with the option that the control table gives each worker; 0 without one."""
    return pings.join(assignments, key, "left").withColumn("opt_id", F.coalesce("opt_id", F.lit(0)))
