"""Dispatch and scraping as streams whose batches can be repeated.

Each sink reads its tables as they were before its batch, so a batch that broke
off between its writes gives, when it is replayed, the same picks, messages and
rows; what it had written is replaced.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from buildlake import schemas as S
from buildlake.operators import tasks
from buildlake.streaming.jobs import VersionedTable

Sink = Callable[[DataFrame, int], None]


def dispatcher(statuses: VersionedTable, projects: DataFrame, options: DataFrame, outbox: str) -> Sink:
    """A sink of requests (opt_id, ts): each requested option's next task is emitted and marked as in progress.

    Messages (opt_id, task_id, repo_id, name, url, build_system, platform, priority,
    msg_time) go to ``outbox``, a folder for each batch; the task's build status
    and time go to ``statuses``. An option gets one task a batch.
    """

    def sink(requests: DataFrame, k: int) -> None:
        asked = requests.groupBy("opt_id").agg(F.max("ts").alias("msg_time"))
        task = tasks.next_tasks(statuses.before(k), projects, options)
        task.drop("mod_timestamp").join(asked, "opt_id").write.mode("overwrite").parquet(f"{outbox}/batch={k}")
        # what was written decides what is marked
        sent = requests.sparkSession.read.parquet(f"{outbox}/batch={k}")
        marks = sent.select(F.col("task_id").alias("_id"), F.lit(S.PROCESSING).alias("build_status"), F.col("msg_time").alias("mod_timestamp"), F.lit(k).alias("at"))
        statuses.merge_updates("_id", ["at"])(marks, k)

    return sink


def ingester(projects: VersionedTable, statuses: VersionedTable, options: DataFrame) -> Sink:
    """A sink of scraped rows (url, ...): new addresses become projects, and every matching option gets an initial status, in the same batch.

    A project's key is a hash of its address, a status's one of project and
    option, so that a replay gives the same keys.
    """

    def sink(scraped: DataFrame, k: int) -> None:
        keyed = scraped.withColumn("_id", F.xxhash64("url")).select(*projects.schema.fieldNames())
        projects.insert_new(["_id"], keyed.columns)(keyed, k)
        new = projects.spark.read.schema(projects.schema).parquet(f"{projects.path}/v={k}").join(projects.before(k).select("_id"), "_id", "left_anti")
        fanned = tasks.fan_out(new, options, project_in_option=True).withColumns({"_id": F.xxhash64("repo_id", "build_opt_id"), "mod_timestamp": F.lit(0).cast("long")})
        rows = fanned.select(*[F.col(f.name).cast(f.dataType) for f in statuses.schema.fields])
        statuses.insert_new(["_id"], ["_id"])(rows, k)

    return sink
