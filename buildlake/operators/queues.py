"""Messages and their queues: admission, guards, routing, ageing files, console commands."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from buildlake import schemas as S
from buildlake.functions import text
from buildlake.operators import scans

# fixed values: what a queue holds at most, how long a served archive stays, in seconds
QUEUE_CAPACITY = 3600
SERVED_TTL = 60


def admission(messages: DataFrame, queue: str, order: list[str], age: Column, capacity: int = QUEUE_CAPACITY, ttl: int = S.TASK_TTL, buckets: int = 64) -> DataFrame:
    """Every message with its ``verdict``: expired, queued (among its queue's first ``capacity`` others) or rejected.

    ``order`` must tell messages apart. The last admitted place of each queue
    is found in two steps, so no task sorts more of a queue than a bucket of
    it or ``buckets * capacity`` rows.
    """
    place = F.struct(*order)
    fresh = messages.where(age < ttl).select(queue, *order).withColumn("__bucket", F.pmod(F.xxhash64(*order), F.lit(buckets)))
    for per in ([queue, "__bucket"], [queue]):
        fresh = fresh.withColumn("__n", F.row_number().over(Window.partitionBy(*per).orderBy(*order))).where(F.col("__n") <= capacity)
    last = fresh.groupBy(queue).agg(F.max(place).alias("__last"))
    verdict = F.when(age >= ttl, "expired").when(place <= F.col("__last"), "queued").otherwise("rejected")
    return messages.join(last, queue, "left").withColumn("verdict", verdict).drop("__last")


def guarded(tasks: DataFrame, windows: Column, build_system: Column, status: str = "clone_status") -> DataFrame:
    """Tasks whose status says blacklisted where a Windows worker would get anything but a solution."""
    return tasks.withColumn(status, F.when(windows & (build_system != "sln"), F.lit(S.BLACKLIST)).otherwise(F.col(status)))


def is_analysable(file_name: Column) -> Column:
    """Windows programs and libraries that no Linux build made."""
    return ~F.contains(file_name, F.lit("linux")) & (F.endswith(file_name, F.lit(".exe")) | F.endswith(file_name, F.lit(".dll")))


def analysis_messages(binaries: DataFrame, statuses: DataFrame) -> DataFrame:
    """One message for each binary to be analysed, with the queue of the option that built it."""
    built = statuses.select(F.col("_id").alias("status_id"), "build_opt_id")
    return binaries.where(is_analysable(F.col("file_name"))).join(built, "status_id").select(F.concat(F.lit("post_analysis."), F.col("build_opt_id")).alias("queue"), "status_id", "file_name")


def outlived(files: DataFrame, modified: Column, now: Column, ttl: int = SERVED_TTL) -> DataFrame:
    """Served files older than ``ttl`` seconds: what an eviction takes."""
    return files.where(now - modified > ttl)


def parsed_commands(lines: DataFrame, line: str, arity: Mapping[str, int]) -> DataFrame:
    """command (first word), args (the others) and whether the command is known and has as many as it needs."""
    words = F.filter(F.split(F.trim(F.col(line)), r"\s+"), lambda w: w != "")
    needed = F.element_at(F.create_map(*[F.lit(x) for pair in arity.items() for x in pair]), F.col("command"))
    parsed = lines.withColumn("__w", words).withColumns({"command": F.coalesce(F.get("__w", F.lit(0)), F.lit("")), "args": F.slice("__w", 2, 1 << 20)}).drop("__w")
    return parsed.withColumn("valid", F.coalesce(F.size("args") == needed, F.lit(False)))


def newest_at_most(commits: DataFrame, wanted: DataFrame, per: str, version: str, limit: str, order: list[str], *values: str) -> DataFrame:
    """For each row of ``wanted`` (per, limit) its key's newest commit, by ``order``, whose version isn't newer than the limit.

    Both sides are one stream in the order of sortable version keys, commits
    first at equal ones, and a running maximum finds the newest so far: linear
    in both, whatever a key's number of commits and of limits. Rows without
    such a commit are left out; null limits have none; commits without a
    version count as older than any.
    """
    newest = F.struct(*order, *[F.col(c).alias(f"__{i}") for i, c in enumerate(values)])
    left = commits.select(per, F.coalesce(text.version_key(F.col(version)), F.lit("")).alias("__key"), F.lit(0).alias("__side"), F.lit(None).cast(wanted.schema[limit].dataType).alias(limit), newest.alias("__c"))
    right = wanted.where(F.col(limit).isNotNull()).select(per, text.version_key(F.col(limit)).alias("__key"), F.lit(1).alias("__side"), limit, F.lit(None).cast(left.schema["__c"].dataType).alias("__c"))
    found = scans.scanned(left.union(right), [per], ["__key", "__side"], {"__best": scans.Most(F.col("__c"))})
    return found.where("__side = 1 and __best is not null").select(per, limit, *[F.col(f"__best.__{i}").alias(c) for i, c in enumerate(values)])
