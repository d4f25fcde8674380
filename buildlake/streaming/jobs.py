"""Structured Streaming: message streams, late messages, heartbeats, rate counts, upserts.

Each job takes a streaming DataFrame and returns one, or starts a query with
an explicit checkpoint folder. The batch twins are in ``operators``.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery
from pyspark.sql.streaming.state import GroupState, GroupStateTimeout
from pyspark.sql.types import StructType

from buildlake import schemas as S
from buildlake.operators import tasks


def messages(spark: SparkSession, path: str, schema: StructType, fmt: str = "json", per_trigger: int | None = None) -> DataFrame:
    """A queue as a folder of files; ``per_trigger`` bounds the files of a micro-batch (the queue's cap)."""
    reader = spark.readStream.schema(schema).format(fmt)
    return (reader.option("maxFilesPerTrigger", per_trigger) if per_trigger else reader).load(path)


def split_late(stream: DataFrame, msg_time: Column, now: Column, ttl: int = S.TASK_TTL) -> DataFrame:
    """Messages with status OUTDATED where they are ``ttl`` seconds old or older; nothing is lost silently."""
    return stream.withColumn("outdated", now - msg_time >= ttl).withColumn("reply_status", F.when(F.col("outdated"), S.OUTDATED))


def accepted_replies(stream: DataFrame, status: str = "status") -> DataFrame:
    return stream.where(F.col(status) != S.OUTDATED)


def routed(stream: DataFrame, option: str = "opt_id") -> DataFrame:
    """Messages by option: rows of one option share a partition."""
    return stream.withColumn("route", F.concat(F.lit("worker."), F.col(option).cast("string"))).repartition(option)


def hourly_counts(stream: DataFrame, ts: str, delay: str = "600 seconds") -> DataFrame:
    return stream.withWatermark(ts, delay).groupBy(F.window(ts, "1 hour").alias("w")).agg(F.count(F.lit(1)).alias("n")).select(F.col("w.start").alias("hour"), "n")


def pane_counts(stream: DataFrame, ts: str, key: str, pane: str = "5 minutes", delay: str = "600 seconds") -> DataFrame:
    """(pane, key, n): rows of each pane of time, counted once whatever the number of windows over it.

    In update mode a batch gives the panes it changed; state holds the panes that
    the watermark hasn't passed. Later rows are dropped: ``late_apart`` keeps them.
    """
    counted = stream.withWatermark(ts, delay).groupBy(F.window(ts, pane).alias("w"), key).agg(F.count(F.lit(1)).alias("n"))
    return counted.select(F.col("w.start").alias("pane"), key, "n")


def last_counts(panes: DataFrame, key: str, seconds: int, pane: int = 300) -> DataFrame:
    """(until, key, n): at every end of a pane, the rows of the last ``seconds`` by then, where there are any.

    A pane adds to the count when it ends and takes it off ``seconds`` later, so
    an hour, a day and a month cost the same: two changes a pane, one running sum.
    """
    at = F.unix_seconds("pane")
    changes = panes.select(key, F.explode(F.array(F.struct((at + pane).alias("at"), F.col("n").alias("d")), F.struct((at + pane + seconds).alias("at"), (-F.col("n")).alias("d")))).alias("c"))
    summed = changes.groupBy(key, "c.at").agg(F.sum("c.d").alias("d"))
    w = Window.partitionBy(key).orderBy("at")  # panes of a key: bounded by time, not by rows
    steps = summed.select(key, "at", F.sum("d").over(w.rowsBetween(Window.unboundedPreceding, Window.currentRow)).alias("n"), F.lead("at").over(w).alias("next"))
    marks = F.sequence(F.col("at"), F.col("next") - pane, F.lit(pane).cast("long"))
    return steps.where("n > 0").select(F.explode(marks).alias("until"), key, "n").withColumn("until", F.timestamp_seconds("until"))


def late_apart(on_time: Callable[[DataFrame, int], None], late: Callable[[DataFrame, int], None], ts: str, delay: int, progress: VersionedTable) -> Callable[[DataFrame, int], None]:
    """A sink that hands each batch's rows to one of two: late are those ``delay`` seconds or more behind the newest row of earlier batches.

    ``progress`` (id int, newest timestamp) keeps that time by batch, so a
    replayed batch is parted alike. Rows without a time are late.
    """

    def sink(batch: DataFrame, k: int) -> None:
        known = progress.before(k).agg(F.max("newest")).first()[0]
        here = batch.agg(F.max(ts)).first()[0]
        behind = F.col(ts).isNull() if known is None else F.col(ts).isNull() | (F.unix_micros(F.lit(known)) - F.unix_micros(ts) >= delay * 1_000_000)
        on_time(batch.where(~behind), k)
        late(batch.where(behind), k)
        times = [t for t in (known, here) if t is not None]
        progress.write(batch.sparkSession.createDataFrame([(0, max(times, default=None))], progress.schema), k)

    return sink


def once_per_key(stream: DataFrame, keys: list[str], ts: str, delay: str = "600 seconds") -> DataFrame:
    """The idempotent-build guard: a key's repetitions within the delay are dropped."""
    return stream.withWatermark(ts, delay).dropDuplicatesWithinWatermark(keys)


def worker_sessions(stream: DataFrame, key: str, ts: str, gap: str = "600 seconds") -> DataFrame:
    return stream.withWatermark(ts, gap).groupBy(F.session_window(ts, gap).alias("w"), key).agg(F.count(F.lit(1)).alias("n")).select(key, F.col("w.start").alias("start"), F.col("w.end").alias("end"), "n")


def heartbeats(stream: DataFrame, ttl: int = S.WORKER_TTL, delay: str = "0 seconds") -> DataFrame:
    """Worker states (uuid, first, last, pings) after each batch of pings (uuid, ts), forgotten once pings are ``ttl`` seconds past the last one.

    On the plain state store; ``workers.worker_events`` tells of expiries too.
    """

    def beat(key: tuple, parts: Iterator[pd.DataFrame], state: GroupState) -> Iterator[pd.DataFrame]:
        if state.hasTimedOut:
            state.remove()
            return
        first, last, pings = state.get if state.exists else (None, None, 0)
        for part in parts:
            low, high = int(part["at"].min()), int(part["at"].max())
            first, last = (low, high) if first is None else (min(first, low), max(last, high))
            pings += len(part)
        state.update((first, last, pings))
        state.setTimeoutTimestamp(max(last // 1000 + 1000 * ttl, state.getCurrentWatermarkMs() + 1))
        yield pd.DataFrame({"uuid": [key[0]], "first": [first], "last": [last], "pings": [pings]})

    # microseconds: the same in every time zone
    told = "first long, last long, pings long"
    timed = stream.select("uuid", "ts", F.unix_micros("ts").alias("at")).withWatermark("ts", delay)
    beats = timed.groupBy("uuid").applyInPandasWithState(beat, f"uuid string, {told}", told, "update", GroupStateTimeout.EventTimeTimeout)
    return beats.withColumns({c: F.timestamp_micros(c) for c in ("first", "last")})


def run_available(stream: DataFrame, checkpoint: str, sink: Callable[[DataFrame, int], None], mode: str = "append") -> StreamingQuery:
    """Everything that is there now, batch by batch, into ``sink``; a later call goes on where this one, now done, ended."""
    query = stream.writeStream.outputMode(mode).option("checkpointLocation", checkpoint).trigger(availableNow=True).foreachBatch(sink).start()
    query.awaitTermination()
    return query


def to_folder(stream: DataFrame, path: str, checkpoint: str) -> StreamingQuery:
    """An append-only Parquet sink; its commit log makes replays harmless."""
    return stream.writeStream.format("parquet").option("path", path).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()


class VersionedTable:
    """A table that batches are merged into: buckets of its key, each with versions named by batch.

    A batch writes the buckets that it touches and no others, in one write, and
    a replayed batch replaces its own. Of a bucket the newest version stays, and
    the one before it, from which the newest is made again if it is replayed.
    Without ``keys`` the first sink's keys decide on the buckets, or else the
    first column.
    """

    def __init__(self, spark: SparkSession, path: str, schema: StructType, keys: list[str] | None = None, buckets: int = 64) -> None:
        self.spark, self.path, self.schema, self.keys, self.buckets = spark, path, schema, keys, buckets
        self.root = spark._jvm.org.apache.hadoop.fs.Path(path)
        self.fs = self.root.getFileSystem(spark._jsc.hadoopConfiguration())

    def _numbers(self, path: str, prefix: str) -> list[int]:
        at = self.spark._jvm.org.apache.hadoop.fs.Path(path)
        names = [s.getPath().getName() for s in self.fs.listStatus(at)] if self.fs.exists(at) else []
        return sorted(int(n.removeprefix(prefix)) for n in names if n.startswith(prefix))

    def versions(self) -> dict[int, list[int]]:
        """Batches that wrote each bucket, in order."""
        out: dict[int, list[int]] = {}
        for v in self._numbers(self.path, "v="):
            for b in self._numbers(f"{self.path}/v={v}", "bucket="):
                out.setdefault(b, []).append(v)
        return out

    def _read(self, newest: dict[int, int]) -> DataFrame:
        paths = [f"{self.path}/v={v}/bucket={b}" for b, v in sorted(newest.items())]
        return self.spark.read.schema(self.schema).parquet(*paths) if paths else self.spark.createDataFrame([], self.schema)

    def before(self, batch: int | None = None, only: list[int] | None = None) -> DataFrame:
        """What the table held before a batch, or holds now; of some buckets or all."""
        older = {b: [v for v in vs if batch is None or v < batch] for b, vs in self.versions().items() if only is None or b in only}
        return self._read({b: vs[-1] for b, vs in older.items() if vs})

    def bucket(self) -> Column:
        return F.pmod(F.xxhash64(*(self.keys or self.schema.fieldNames()[:1])), F.lit(self.buckets)).cast("int")

    def _keyed_by(self, keys: list[str]) -> None:
        self.keys = self.keys or keys
        if not set(self.keys) <= set(keys):
            raise ValueError(f"the table's buckets are of {self.keys}, rows of one key may lie in several")

    def write(self, table: DataFrame, batch: int) -> None:
        """A batch's version of the buckets that ``table`` has rows of."""
        table.withColumn("bucket", self.bucket()).repartition("bucket").write.mode("overwrite").partitionBy("bucket").parquet(f"{self.path}/v={batch}")
        for b, vs in self.versions().items():
            for v in vs[:-2]:
                self.fs.delete(self.spark._jvm.org.apache.hadoop.fs.Path(f"{self.path}/v={v}/bucket={b}"), True)
        for v in self._numbers(self.path, "v=")[:-2]:
            if not self._numbers(f"{self.path}/v={v}", "bucket="):
                self.fs.delete(self.spark._jvm.org.apache.hadoop.fs.Path(f"{self.path}/v={v}"), True)

    def _touched(self, rows: DataFrame) -> list[int]:
        return [r["b"] for r in rows.select(self.bucket().alias("b")).distinct().collect()]  # bounded by the number of buckets

    def merge_updates(self, key: str, order: list[str]) -> Callable[[DataFrame, int], None]:
        """A sink that applies each batch's newest update of every key."""
        self._keyed_by([key])
        return lambda updates, batch: self.write(tasks.merged(self.before(batch, self._touched(updates)), updates, key, order), batch)

    def upsert(self, keys: list[str]) -> Callable[[DataFrame, int], None]:
        """A sink of rows that take the place of those with the same key; a batch has one row a key."""
        self._keyed_by(keys)
        return lambda rows, batch: self.write(self.before(batch, self._touched(rows)).join(rows, keys, "left_anti").unionByName(rows), batch)

    def insert_new(self, keys: list[str], order: list[str]) -> Callable[[DataFrame, int], None]:
        """A sink that adds rows whose key is new, the first of each."""
        self._keyed_by(keys)

        def sink(rows: DataFrame, batch: int) -> None:
            old = self.before(batch, self._touched(rows))
            self.write(old.unionByName(tasks.keep_first(rows, keys, order, old.select(*keys)).select(*old.columns)), batch)

        return sink


def decoded_batches(stream: DataFrame, column: str, schema: str) -> DataFrame:
    """Rows of messages that are JSON arrays of objects."""
    return stream.select(F.explode(F.from_json(column, f"array<{schema}>")).alias("r")).select("r.*")
