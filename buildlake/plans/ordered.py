"""Queries of ordered sequences: islands, gaps, as-of and range joins, unnesting, windows of time."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from buildlake.functions import numbers, times
from buildlake.operators import corpus, numbering, scans, sequences
from buildlake.plans.control import EVENT_NOW
from buildlake.plans.registry import Registry
from buildlake.sources import roles

REGISTRY = query = Registry()

# segments of an order: one for each distinct line number
_SEGMENTS = "seg AS (SELECT l_orderkey AS fn, l_linenumber::BIGINT * 100 AS s, l_linenumber::BIGINT * 100 + max(l_quantity)::BIGINT AS e FROM lineitem GROUP BY l_orderkey, l_linenumber)"


def _segments(spark: SparkSession, sf_dir: str) -> DataFrame:
    start = F.col("l_linenumber").cast("long") * 100
    rows = roles.load(spark, sf_dir, "lineitem").groupBy(F.col("l_orderkey").alias("fn"), start.alias("s")).agg(F.max("l_quantity").cast("long").alias("q"))
    return rows.select("fn", "s", (F.col("s") + F.col("q")).alias("e"))


def _events(spark: SparkSession, sf_dir: str) -> DataFrame:
    return roles.load(spark, sf_dir, "events")


@query(f"WITH {_SEGMENTS} SELECT fn, s, e, lead(s) OVER (PARTITION BY fn ORDER BY s, e) - e AS gap FROM seg")
def segment_gaps(spark: SparkSession, sf_dir: str) -> DataFrame:
    return sequences.gaps(_segments(spark, sf_dir), "s", "e", ["fn"])


@query(
    f"""WITH {_SEGMENTS}, g AS (SELECT *, lead(s) OVER (PARTITION BY fn ORDER BY s, e) - e AS gap FROM seg)
    SELECT fn, round(CASE WHEN count(*) > 1 AND arg_max(e, s) <> min(s) THEN coalesce(sum(gap), 0) / (arg_max(e, s) - min(s)) ELSE 0.0 END, 9)::DOUBLE AS ratio FROM g GROUP BY fn"""
)
def intersect_ratio(spark: SparkSession, sf_dir: str) -> DataFrame:
    return sequences.intersect_ratio(_segments(spark, sf_dir), "s", "e", ["fn"]).withColumn("ratio", F.round("ratio", 9))


@query("SELECT l_orderkey, l_linenumber, l_partkey, l_suppkey, l_quantity, round(sum(CASE WHEN l_returnflag = 'R' THEN l_quantity ELSE 0 END) OVER w / sum(l_quantity) OVER w, 9)::DOUBLE AS share FROM lineitem WINDOW w AS (PARTITION BY l_orderkey ORDER BY l_linenumber, l_partkey, l_suppkey, l_quantity, l_extendedprice ROWS UNBOUNDED PRECEDING)")
def debug_ratio(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = sequences.running_share(roles.load(spark, sf_dir, "lineitem"), F.col("l_quantity"), F.col("l_returnflag") == "R", ["l_orderkey"], ["l_linenumber", "l_partkey", "l_suppkey", "l_quantity", "l_extendedprice"])
    return rows.select("l_orderkey", "l_linenumber", "l_partkey", "l_suppkey", "l_quantity", F.round("share", 9).alias("share"))


@query(f"WITH {_SEGMENTS} SELECT fn, string_agg(lower(printf('%08x', s)) || '-' || lower(printf('%08x', e)), ',' ORDER BY s, e) AS rvas FROM seg GROUP BY fn")
def function_rva_strings(spark: SparkSession, sf_dir: str) -> DataFrame:
    hexed = lambda c: numbers.to_hex(F.col(c), F.lit(8))
    rows = _segments(spark, sf_dir).groupBy("fn").agg(F.array_sort(F.collect_list(F.struct(hexed("s").alias("rva_start"), hexed("e").alias("rva_end")))).alias("segments"))
    return rows.select("fn", corpus.segment_text(F.col("segments")).alias("rvas"))


@query(f"WITH {_SEGMENTS} SELECT fn, min(least(s, e)) AS first, max(greatest(s, e)) AS last FROM seg GROUP BY fn")
def function_span(spark: SparkSession, sf_dir: str) -> DataFrame:
    from buildlake.operators.debuginfo import span_of_functions

    return span_of_functions(_segments(spark, sf_dir), ["fn"], "s", "e")


@query(
    """SELECT user_id, island::BIGINT AS island, count(*) AS n, min(event_id) AS first_id, max(event_id) AS last_id, arg_min(props, event_id) AS header FROM (
    SELECT *, sum((event_type = 'signup')::INT) OVER (PARTITION BY user_id ORDER BY ts, event_id ROWS UNBOUNDED PRECEDING) AS island FROM events) GROUP BY user_id, island"""
)
def dump_segments(spark: SparkSession, sf_dir: str) -> DataFrame:
    starts = F.when(F.col("event_type") == "signup", 1).otherwise(0)
    rows = scans.scanned(_events(spark, sf_dir), ["user_id"], ["ts", "event_id"], {"island": scans.Sum(starts)})
    return rows.groupBy("user_id", "island").agg(F.count(F.lit(1)).alias("n"), F.min("event_id").alias("first_id"), F.max("event_id").alias("last_id"), F.min_by("props", "event_id").alias("header"))


@query("SELECT event_id, last_value(CASE WHEN event_type = 'signup' THEN event_id END IGNORE NULLS) OVER (PARTITION BY user_id ORDER BY ts, event_id ROWS UNBOUNDED PRECEDING) AS header FROM events")
def carried_header(spark: SparkSession, sf_dir: str) -> DataFrame:
    header = F.when(F.col("event_type") == "signup", F.col("event_id"))
    return scans.scanned(_events(spark, sf_dir), ["user_id"], ["ts", "event_id"], {"header": scans.Last(header)}).select("event_id", "header")


@query("SELECT event_id, coalesce(lead(event_type) OVER (PARTITION BY user_id ORDER BY ts, event_id) <> event_type, true) AS closes FROM events")
def run_ends(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = scans.scanned(_events(spark, sf_dir), ["user_id"], ["ts", "event_id"], {"after": scans.Following(F.col("event_type"))})
    return rows.select("event_id", F.coalesce(F.col("after") != F.col("event_type"), F.lit(True)).alias("closes"))


@query(
    f"""WITH {_SEGMENTS}, o AS (SELECT *, row_number() OVER w AS r, count(*) OVER (PARTITION BY fn) AS n, lag(e) OVER w AS before FROM seg WINDOW w AS (PARTITION BY fn ORDER BY e, s))
    SELECT fn, e, CASE WHEN r = 1 AND n > 1 THEN 0 WHEN before + 1 < s THEN before + 1 ELSE s END AS s FROM o"""
)
def extend_starts(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = _segments(spark, sf_dir).withColumn("tie", F.col("s"))
    return sequences.extended_starts(rows, "s", "e", ["fn"], ["tie"]).select("fn", "s", "e")


@query(
    """SELECT user_id, event_id FROM (SELECT *, sum((event_type NOT IN ('view', 'click'))::INT) OVER (PARTITION BY user_id ORDER BY ts, event_id ROWS UNBOUNDED PRECEDING) AS seen FROM events) WHERE seen > 0"""
)
def leading_trim(spark: SparkSession, sf_dir: str) -> DataFrame:
    return sequences.leading_trimmed(_events(spark, sf_dir), F.col("event_type").isin("view", "click"), ["user_id"], ["ts", "event_id"]).select("user_id", "event_id")


@query("SELECT p_partkey, s_suppkey FROM part JOIN supplier ON p_partkey BETWEEN s_suppkey * 5 AND s_suppkey * 5 + s_nationkey")
def lines_in_functions(spark: SparkSession, sf_dir: str) -> DataFrame:
    spans = roles.load(spark, sf_dir, "supplier").select("s_suppkey", (F.col("s_suppkey") * 5).alias("lo"), (F.col("s_suppkey") * 5 + F.col("s_nationkey")).alias("hi"))
    return sequences.range_join(roles.load(spark, sf_dir, "part").select("p_partkey"), "p_partkey", spans, "lo", "hi", 16).select("p_partkey", "s_suppkey")


@query("SELECT e.event_id, (SELECT arg_max(s.event_id, (s.ts, s.event_id)) FROM events s WHERE s.user_id = e.user_id AND s.event_type = 'signup' AND s.ts < e.ts) AS commit FROM events e WHERE e.event_type = 'error'")
def asof_commit(spark: SparkSession, sf_dir: str) -> DataFrame:
    events = _events(spark, sf_dir)
    probes = events.where("event_type = 'error'").select("user_id", "ts", "event_id")
    commits = events.where("event_type = 'signup'").select("user_id", "ts", F.col("event_id").alias("id"))
    return sequences.as_of(probes, commits, ["user_id"], "ts", "id", "commit").select("event_id", "commit")


@query("WITH s AS (SELECT *, sum(fresh) OVER (PARTITION BY user_id ORDER BY ts, event_id ROWS UNBOUNDED PRECEDING) AS k FROM (SELECT *, (ts >= lag(ts, 1, TIMESTAMP '1970-01-01') OVER (PARTITION BY user_id ORDER BY ts, event_id) + INTERVAL 600 SECOND)::INT AS fresh FROM events)) SELECT user_id, min(ts) AS start, max(ts) + INTERVAL 600 SECOND AS \"end\", count(*) AS n FROM s GROUP BY user_id, k")
def worker_sessions(spark: SparkSession, sf_dir: str) -> DataFrame:
    return sequences.sessions(_events(spark, sf_dir), "user_id", "ts")


@query("SELECT date_trunc('hour', ts) AS hour, count(*) AS n, greatest(0, count(*) - 12) AS excess FROM events GROUP BY 1")
def hourly_rate_limit(spark: SparkSession, sf_dir: str) -> DataFrame:
    return sequences.hourly_excess(_events(spark, sf_dir), "ts", 12)


@query(
    """SELECT since, since + 86400 AS until, count(event_id) AS total, greatest(1, ceil(least(count(event_id), 999) / 100))::BIGINT AS pages
    FROM (SELECT unnest(range(1704067200, 1706659200, 86400)) AS since) LEFT JOIN events ON epoch(ts) >= since AND epoch(ts) < since + 86400 GROUP BY since"""
)
def crawl_windows(spark: SparkSession, sf_dir: str) -> DataFrame:
    return sequences.crawl_windows(_events(spark, sf_dir), times.epoch(F.col("ts")), 1_704_067_200, 1_706_659_200, 86400, 999)


@query(f"SELECT event_id, {EVENT_NOW} - floor(epoch(ts))::BIGINT AS age, {EVENT_NOW} - floor(epoch(ts))::BIGINT >= 1296000 AS outdated, CASE WHEN {EVENT_NOW} - floor(epoch(ts))::BIGINT >= 1296000 THEN 6 END AS reply FROM events")
def late_message_ttl(spark: SparkSession, sf_dir: str) -> DataFrame:
    age = F.lit(EVENT_NOW) - times.epoch(F.col("ts"))
    late = times.is_stale(times.epoch(F.col("ts")), F.lit(EVENT_NOW), 1_296_000)
    return _events(spark, sf_dir).select("event_id", age.alias("age"), late.alias("outdated"), F.when(late, 6).alias("reply"))


@query("SELECT doc_id, (unnest(range(1, len(l) + 1)) - 1)::INT AS pos, unnest(l) AS line FROM (SELECT doc_id, string_split(text, chr(10)) AS l FROM documents)")
def corpus_unnest_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    return roles.load(spark, sf_dir, "documents").select("doc_id", F.posexplode(F.split("text", "\n")).alias("pos", "line"))


@query(
    """SELECT md5(url) || '_' || coalesce(nullif(host, ''), 'unknown') AS identifier, count(*) AS n FROM (
    SELECT split_part(url, '/', 3) AS url, page_id % 3 AS g, CASE WHEN page_id % 3 = 0 THEN '' ELSE 'h' || page_id % 3 END AS host FROM pages) GROUP BY ALL HAVING count(*) >= 2"""
)
def folder_min_count(spark: SparkSession, sf_dir: str) -> DataFrame:
    part = F.when(F.col("page_id") % 3 == 0, "").otherwise(F.concat(F.lit("h"), F.col("page_id") % 3))
    rows = roles.load(spark, sf_dir, "pages").select(numbers.identifier(F.split_part("url", F.lit("/"), F.lit(3)), part).alias("identifier"))
    return rows.groupBy("identifier").agg(F.count(F.lit(1)).alias("n")).where("n >= 2")


@query("SELECT conv_id, count(*) AS chunks, string_agg(text, '' ORDER BY turn) AS content, sha256(string_agg(text, '' ORDER BY turn)) AS sha256 FROM conversations GROUP BY conv_id")
def chunk_reassembly(spark: SparkSession, sf_dir: str) -> DataFrame:
    return corpus.reassembled(roles.load(spark, sf_dir, "conversations"), "conv_id", "turn", "text")


@query("SELECT count(*) AS n, count(DISTINCT id) AS ids, min(id) AS least, max(id) AS most FROM (SELECT row_number() OVER (ORDER BY page_id) AS id FROM pages)")
def surrogate_keys(spark: SparkSession, sf_dir: str) -> DataFrame:
    keyed = numbering.with_keys(roles.load(spark, sf_dir, "pages"), "id", ["page_id"])
    return keyed.agg(F.count(F.lit(1)).alias("n"), F.countDistinct("id").alias("ids"), F.min("id").alias("least"), F.max("id").alias("most"))


@query("SELECT page_id, row_number() OVER (ORDER BY url, page_id) AS id, row_number() OVER (PARTITION BY page_id % 3 ORDER BY url, page_id) AS within FROM pages")
def surrogate_key_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Keys in the natural order of a text, over all rows and within groups."""
    pages = roles.load(spark, sf_dir, "pages").select("page_id", "url", (F.col("page_id") % 3).alias("group"))
    keyed = numbering.with_keys(numbering.with_keys(pages, "id", ["url", "page_id"]), "within", ["url", "page_id"], ["group"])
    return keyed.select("page_id", "id", "within")


@query(
    """SELECT l_orderkey AS binary_id, string_agg(l_linenumber || ':' || l_partkey, ',' ORDER BY l_linenumber, l_partkey) AS lines
    FROM (SELECT DISTINCT l_orderkey, l_linenumber, l_partkey FROM lineitem) GROUP BY l_orderkey"""
)
def nested_documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = roles.load(spark, sf_dir, "lineitem").select("l_orderkey", "l_linenumber", "l_partkey").distinct()
    nested = rows.groupBy(F.col("l_orderkey").alias("binary_id")).agg(F.array_sort(F.collect_list(F.struct("l_linenumber", "l_partkey"))).alias("r"))
    return nested.select("binary_id", F.array_join(F.transform("r", lambda x: F.concat_ws(":", x["l_linenumber"], x["l_partkey"])), ",").alias("lines"))
