"""Queries that run as streams over the given tables: crawl, outbox, dispatch, states, panes."""

from __future__ import annotations

import bisect
import functools
from collections.abc import Callable

import pyarrow as pa
import pyarrow.dataset as ds
from pyarrow import fs
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from buildlake import schemas as S
from buildlake.functions import times
from buildlake.operators import chunks
from buildlake.plans.registry import Registry
from buildlake.sources import crawl, files, outbox, roles
from buildlake.sources.staging import work_folder
from buildlake.streaming import dispatch, jobs, workers

REGISTRY = query = Registry()

# the orders' time, in windows of thirty days
ORDERS_BEGIN, ORDERS_END, MONTH = 631_152_000, 1_072_915_200, 30 * 86400  # 1990-01-01, 2004-01-01
_FILES = 4  # of a month at the service, at most


def served_orders(spark: SparkSession, sf_dir: str) -> str:
    """The orders as the crawled service keeps them: a folder for each month of the crawl. One pass writes it, a window reads its month only."""
    orders, path = roles.load(spark, sf_dir, "orders"), work_folder(spark, "service")
    at = times.epoch(F.col("o_orderdate"))
    rows = orders.select("o_orderkey", "o_custkey", "o_totalprice", "o_orderstatus", at.alias("at"), F.floor((ORDERS_END - 1 - at) / MONTH).alias("month"))
    rows.where((at >= ORDERS_BEGIN) & (at < ORDERS_END)).repartition("month", F.pmod(F.col("o_orderkey"), F.lit(_FILES))).write.partitionBy("month").parquet(path)
    return path


def orders_pages(service: str) -> Callable[[int, int, int], tuple[int, list[dict]]]:
    """A fetcher that serves ``served_orders`` of a time window page by page, by order of times and keys."""

    @functools.lru_cache(maxsize=2)
    def month(number: int) -> tuple[pa.Table, list[int]]:
        system, folder = fs.FileSystem.from_uri(service) if ":/" in service else (fs.LocalFileSystem(), service)
        if system.get_file_info(f"{folder}/month={number}").type == fs.FileType.NotFound:
            return pa.table({}), []
        table = ds.dataset(f"{folder}/month={number}", filesystem=system, format="parquet").to_table().sort_by([("at", "ascending"), ("o_orderkey", "ascending")])
        return table, table["at"].to_pylist()

    def rows(table: pa.Table) -> list[dict]:
        return [{"name": f"repo{r['o_orderkey']}", "url": f"https://api.forge.com/repos/repo{r['o_orderkey']}", "owner_id": r["o_custkey"], "size": int(r["o_totalprice"] // 1000), "created_at": str(r["at"]), "build_system": {"O": "make", "F": "cmake"}.get(r["o_orderstatus"], "sln")} for r in table.to_pylist()]

    def fetch(since: int, until: int, page: int) -> tuple[int, list[dict]]:
        total, found, skip = 0, [], (page - 1) * crawl.PAGE
        # months count backwards from the end
        for number in range((ORDERS_END - 1 - since) // MONTH, (ORDERS_END - until) // MONTH - 1, -1):
            table, at = month(number)
            first, last = bisect.bisect_left(at, since), bisect.bisect_left(at, until)
            start = max(first, first + skip - total)
            total += last - first
            if start < last and len(found) < crawl.PAGE:
                found += rows(table.slice(start, min(last - start, crawl.PAGE - len(found))))
        return total, found

    return fetch


_CRAWLED = """SELECT 'repo' || o_orderkey AS name, 'https://api.forge.com/repos/repo' || o_orderkey AS url, o_custkey::BIGINT AS owner_id, floor(o_totalprice / 1000)::BIGINT AS size,
    epoch(o_orderdate)::BIGINT::VARCHAR AS created_at, CASE o_orderstatus WHEN 'O' THEN 'make' WHEN 'F' THEN 'cmake' ELSE 'sln' END AS build_system FROM orders"""


def _rows(crawled: DataFrame) -> DataFrame:
    return crawled.select("name", "url", F.col("owner_id").cast("long").alias("owner_id"), F.col("size").cast("long").alias("size"), "created_at", "build_system")


@query(_CRAWLED)
def crawled_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All orders, fetched in pages; windows with more than the service gives are halved."""
    return _rows(crawl.crawl(spark, ORDERS_BEGIN, ORDERS_END, MONTH, f"{__name__}:orders_pages", served_orders(spark, sf_dir), ORDERS_BEGIN))


@query(f"SELECT build_system, count(*) AS repositories, count(DISTINCT created_at::BIGINT // 86400) AS days FROM ({_CRAWLED}) GROUP BY build_system")
def crawled_repositories(spark: SparkSession, sf_dir: str) -> DataFrame:
    day = F.floor(F.col("created_at").cast("long") / 86400)
    return crawled_rows(spark, sf_dir).groupBy("build_system").agg(F.count(F.lit(1)).alias("repositories"), F.countDistinct(day).alias("days"))


@query(_CRAWLED)
def streamed_crawl(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The crawl as a stream into an outbox, and the outbox's messages as rows again."""
    folder = work_folder(spark, "crawl")
    stream = crawl.crawl_stream(spark, ORDERS_BEGIN, ORDERS_END, None, MONTH, f"{__name__}:orders_pages", served_orders(spark, sf_dir), ORDERS_BEGIN)
    outbox.to_outbox(stream.writeStream, f"{folder}/outbox", f"{folder}/checkpoint").trigger(availableNow=True).start().awaitTermination()
    return _rows(spark.read.schema(S.CRAWLED).json(f"{folder}/outbox"))


def _chunks(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every text as chunks of 100 bytes; of some the second is lost, of some the first is sent again."""
    body = F.encode(F.coalesce("text", F.lit("")), "utf-8")
    docs = roles.load(spark, sf_dir, "documents").select(F.col("doc_id").alias("name"), body.alias("body"))
    seqs = F.sequence(F.lit(0), F.greatest(F.ceil(F.octet_length("body") / 100).cast("int") - 1, F.lit(0)))
    cut = docs.withColumn("seq", F.explode(seqs)).select("name", "seq", F.substring("body", F.col("seq") * 100 + 1, F.lit(100)).alias("content"))
    kept = cut.where((F.col("name") % 11 != 0) | (F.col("seq") != 1))
    return kept.unionByName(cut.where((F.col("name") % 7 == 0) & (F.col("seq") == 0)))


_CHUNKS = """SELECT doc_id AS name, hex(encode(coalesce(text, ''))) AS h, greatest((octet_length(encode(coalesce(text, ''))) + 99) // 100, 1) AS n, doc_id % 11 = 0 AS lossy, doc_id % 7 = 0 AS again FROM documents"""


@query(
    f"""SELECT name, (n - (lossy AND n > 1)::INT)::BIGINT AS chunks, (length(b) // 2)::BIGINT AS n_bytes, sha256(unhex(b)) AS sha256, (lossy AND n > 2)::BIGINT AS missing, again::BIGINT AS repeated, 0::BIGINT AS conflicting
    FROM (SELECT *, CASE WHEN lossy THEN substr(h, 1, 200) || substr(h, 401) ELSE h END AS b FROM ({_CHUNKS}))"""
)
def chunk_digests(spark: SparkSession, sf_dir: str) -> DataFrame:
    return chunks.chunk_digests(_chunks(spark, sf_dir))


@query(
    f"""SELECT name, seq, (seq * 100 - CASE WHEN lossy AND seq > 1 THEN 100 ELSE 0 END)::BIGINT AS place, upper(substr(h, seq * 200 + 1, 200)) AS content
    FROM (SELECT *, unnest(range(n)) AS seq FROM ({_CHUNKS})) WHERE NOT (lossy AND seq = 1)"""
)
def chunk_places(spark: SparkSession, sf_dir: str) -> DataFrame:
    return chunks.placed_chunks(_chunks(spark, sf_dir)).withColumn("content", F.hex("content"))


@query("SELECT p_partkey, p_name FROM part WHERE p_name IN (SELECT p_name FROM part WHERE p_size = 1)")
def pruned_hashed_reads(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Parts in the hashed layout of their names; only the folders of the wanted names are read."""
    parts, path = roles.load(spark, sf_dir, "part").select("p_partkey", "p_name"), work_folder(spark, "hashed")
    files.write_hashed(parts, "p_name", path)
    return files.read_hashed(spark, path, parts.schema, roles.load(spark, sf_dir, "part").where("p_size = 1"), "p_name")


@query(
    """WITH w AS (SELECT user_id::VARCHAR AS uuid, min(ts) AS first, max(ts) AS last, count(*) AS pings FROM events GROUP BY user_id)
    SELECT uuid, 'joined' AS event, first, last, pings FROM w UNION ALL
    SELECT uuid, 'expired', first, last, pings FROM w WHERE last + INTERVAL 600 SECOND <= (SELECT max(ts) FROM events)"""
)
def streamed_workers(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Users as workers, their events as pings: who joined, and who expired by the end of the stream."""
    folder = work_folder(spark, "workers")
    pings = roles.load(spark, sf_dir, "events").select(F.col("user_id").cast("string").alias("uuid"), F.col("ts").cast("timestamp").alias("ts"))
    pings.coalesce(1).write.parquet(f"{folder}/inbox")  # one file is one batch
    stream = workers.worker_events(jobs.messages(spark, f"{folder}/inbox", pings.schema, "parquet"))
    with workers.timed_state(spark):
        jobs.to_folder(stream, f"{folder}/events", f"{folder}/checkpoint").awaitTermination()
    found = spark.read.schema(stream.schema).parquet(f"{folder}/events")
    return found.withColumns({c: F.col(c).cast("timestamp_ntz") for c in ("first", "last")})


@query(
    """WITH m AS (SELECT max(event_id) // 2 AS middle FROM events)
    SELECT event_id, user_id::VARCHAR AS uuid, CASE WHEN event_id <= middle THEN CASE WHEN user_id % 3 = 0 THEN 0 ELSE user_id % 5 + 1 END ELSE CASE WHEN user_id % 4 = 0 THEN 0 ELSE user_id % 7 + 1 END END::INT AS opt_id FROM events, m"""
)
def streamed_answers(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Pings answered from a control table of which a new version comes half way: other workers, other options."""
    folder, events = work_folder(spark, "answers"), roles.load(spark, sf_dir, "events")
    middle = events.agg(F.floor(F.max("event_id") / 2)).first()[0]
    users = events.select("user_id").distinct()
    control = jobs.VersionedTable(spark, f"{folder}/control", spark.createDataFrame([], "uuid string, opt_id int").schema, ["uuid"])
    pings = events.select("event_id", F.col("user_id").cast("string").alias("uuid"))
    for version, (part, gone, options) in enumerate(((F.col("event_id") <= middle, 3, 5), (F.col("event_id") > middle, 4, 7))):
        # workers that the new version doesn't name are unknown
        known = users.select(F.col("user_id").cast("string").alias("uuid"), F.when(F.col("user_id") % gone != 0, F.col("user_id") % options + 1).cast("int").alias("opt_id"))
        control.write(known, version)
        pings.where(part).write.mode("append").parquet(f"{folder}/inbox")
        stream = jobs.messages(spark, f"{folder}/inbox", pings.schema, "parquet")
        jobs.run_available(stream, f"{folder}/checkpoint", workers.answers(control.before, f"{folder}/answers"))
    return spark.read.parquet(f"{folder}/answers").select("event_id", "uuid", "opt_id")


_ROUNDS = 3


@query(
    f"""SELECT s.build_opt_id AS opt_id, s._id AS task_id, p.name, r - 1 AS round FROM (SELECT *, row_number() OVER (PARTITION BY build_opt_id ORDER BY priority DESC, _id) AS r
    FROM statuses WHERE clone_status = 1 AND build_status = 0) s JOIN options o ON o._id = s.build_opt_id AND o.enable JOIN projects p ON p._id = s.repo_id WHERE r <= {_ROUNDS}""",
    roles=True,
)
def streamed_dispatch(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every option asks for a task three times, batch by batch; each gets its next one, which the batch marks."""
    folder = work_folder(spark, "dispatch")
    options, statuses = roles.options(spark, sf_dir), roles.statuses(spark, sf_dir)
    table = jobs.VersionedTable(spark, f"{folder}/statuses", statuses.schema, ["_id"])
    table.write(statuses, 0)
    requests = options.select(F.col("_id").alias("opt_id"), F.lit(1_000_000_000).cast(statuses.schema["mod_timestamp"].dataType).alias("ts"))
    sink = dispatch.dispatcher(table, roles.projects(spark, sf_dir), options, f"{folder}/outbox")
    for _ in range(_ROUNDS):
        requests.coalesce(1).write.mode("append").parquet(f"{folder}/inbox")
        jobs.run_available(jobs.messages(spark, f"{folder}/inbox", requests.schema, "parquet"), f"{folder}/checkpoint", lambda batch, k: sink(batch, k + 1))
    sent = spark.read.parquet(f"{folder}/outbox")
    return sent.select("opt_id", "task_id", "name", (F.col("batch") - 1).cast("long").alias("round"))
