"""Workers as keyed state with a life cycle: they join, are seen, expire; pings are answered from a control table that changes.

State is a value for each worker with a timer on it, kept in RocksDB; what it
holds is bounded by the workers alive within the time to live and the watermark's delay.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from contextlib import contextmanager

from pyspark.sql import DataFrame, Row, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming.stateful_processor import ExpiredTimerInfo, StatefulProcessor, StatefulProcessorHandle, TimerValues

from buildlake import schemas as S
from buildlake.operators import tasks

# times within state and rows are microseconds, whatever the time zones of sessions and workers
_STATE = "first long, last long, pings long"
_EVENTS = f"uuid string, event string, {_STATE}"
_STORE = "spark.sql.streaming.stateStore.providerClass"


@contextmanager
def timed_state(spark: SparkSession) -> Iterator[None]:
    """State with timers needs a store that has them; queries started within use it, the session's own setting comes back."""
    before = spark.conf.get(_STORE, None)
    spark.conf.set(_STORE, "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider")
    try:
        yield
    finally:
        spark.conf.set(_STORE, before) if before is not None else spark.conf.unset(_STORE)


class Workers(StatefulProcessor):
    """Life cycle of one worker: a timer ``ttl`` seconds behind its last ping is moved by each ping and ends it."""

    def __init__(self, ttl: int) -> None:
        self.ttl = ttl

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.handle = handle
        self.state = handle.getValueState("worker", _STATE)

    def _due(self, last: int) -> int:
        return last // 1000 + 1000 * self.ttl

    def handleInputRows(self, key: tuple, rows: Iterator[Row], timerValues: TimerValues) -> Iterator[Row]:  # noqa: N802, N803
        known = self.state.get()
        times = [r["at"] for r in rows]
        pings = len(times)
        if known is not None:
            times += known[:2]
            pings += known[2]
            self.handle.deleteTimer(self._due(known[1]))
        self.state.update((min(times), max(times), pings))
        self.handle.registerTimer(self._due(max(times)))
        yield Row(uuid=key[0], event="joined" if known is None else "seen", first=min(times), last=max(times), pings=pings)

    def handleExpiredTimer(self, key: tuple, timerValues: TimerValues, expiredTimerInfo: ExpiredTimerInfo) -> Iterator[Row]:  # noqa: N802, N803
        first, last, pings = self.state.get()
        self.state.clear()
        yield Row(uuid=key[0], event="expired", first=first, last=last, pings=pings)

    def close(self) -> None:
        pass


def worker_events(pings: DataFrame, ttl: int = S.WORKER_TTL, delay: str = "0 seconds") -> DataFrame:
    """(uuid, event, first, last, pings): a row for each batch of a worker's pings (uuid, ts), joined or seen, and one when it expires, in event time.

    Start it within ``timed_state``. A ping older than the watermark is dropped;
    one behind an expiry joins anew. Null workers are one worker.
    """
    timed = pings.select("uuid", "ts", F.unix_micros("ts").alias("at")).withWatermark("ts", delay)
    events = timed.groupBy("uuid").transformWithState(Workers(ttl), _EVENTS, "Append", "EventTime")
    return events.withColumns({c: F.timestamp_micros(c) for c in ("first", "last")})


def answers(control: Callable[[], DataFrame], path: str) -> Callable[[DataFrame, int], None]:
    """A sink that answers each batch's pings (uuid, ...) with the worker's option by the newest control table; 0 for unknown workers.

    ``control`` is asked anew for every batch (uuid, opt_id); answers go to the
    batch's own folder below ``path``, which a replay replaces.
    """

    def sink(batch: DataFrame, k: int) -> None:
        tasks.assigned(batch, control().select("uuid", "opt_id"), "uuid").write.mode("overwrite").parquet(f"{path}/batch={k}")

    return sink


def live(events: DataFrame) -> DataFrame:
    """Workers whose newest event is no expiry."""
    newest = events.groupBy("uuid").agg(F.max_by("event", F.struct("last", F.when(F.col("event") == "expired", 1).otherwise(0))).alias("event"), F.max("last").alias("last"))
    return newest.where("event <> 'expired'").select("uuid", "last")
