"""Tables in their roles: projects, options, statuses and binaries from any folder of Parquet files.

``load`` reads one table. The role views rename and derive columns only, so
filters and pruning reach the scan. Each view has an SQL twin in ``ROLE_SQL``
for checks against another engine.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from buildlake.functions import times

# fixed values: build systems of the test tables' roles
_PROJECT_BUILD = {"AUTOMOBILE": "make", "BUILDING": "cmake", "FURNITURE": "cmake/make", "HOUSEHOLD": "sln"}
_OPTION_BUILD = {0: "make", 1: "cmake", 2: "make/cmake", 3: "sln"}


def load(spark: SparkSession, sf_dir: str, table: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{table}.parquet")


def _mapped(column: str, table: dict) -> F.Column:
    out = F.lit("")
    for key, value in table.items():
        out = F.when(F.col(column) == key, F.lit(value)).otherwise(out)
    return out


def projects(spark: SparkSession, sf_dir: str) -> DataFrame:
    return load(spark, sf_dir, "customer").select(
        F.col("c_custkey").alias("_id"),
        F.concat(F.lit("https://api.forge.com/repos/"), F.lower("c_mktsegment"), F.lit("/"), F.col("c_name")).alias("url"),
        F.col("c_name").alias("name"),
        F.col("c_nationkey").alias("owner_id"),
        F.floor("c_acctbal").cast("long").alias("size"),
        _mapped("c_mktsegment", _PROJECT_BUILD).alias("build_system"),
    )


def options(spark: SparkSession, sf_dir: str) -> DataFrame:
    return load(spark, sf_dir, "region").select(
        F.col("r_regionkey").alias("_id"),
        F.col("r_name").alias("platform"),
        _mapped("r_regionkey", _OPTION_BUILD).alias("build_system"),
        (F.col("r_regionkey") != 3).alias("enable"),
    )


def statuses(spark: SparkSession, sf_dir: str) -> DataFrame:
    key, state, urgency = F.col("o_orderkey"), F.col("o_orderstatus"), F.left("o_orderpriority", F.lit(1))
    built = F.when(key % 3 == 0, 3).when(key % 3 == 1, 2).otherwise(10)
    return load(spark, sf_dir, "orders").select(
        key.alias("_id"),
        F.when(urgency == "1", 2).when(urgency == "2", 1).otherwise(0).alias("priority"),
        F.when(state == "F", 2).when(state == "P", 1).otherwise(3).alias("clone_status"),
        F.when(state == "O", built).otherwise(0).alias("build_status"),
        (key % 5).cast("int").alias("build_opt_id"),
        F.col("o_custkey").alias("repo_id"),
        times.epoch(F.col("o_orderdate")).alias("mod_timestamp"),
        F.floor("o_totalprice").cast("long").alias("build_time"),
    )


def binaries(spark: SparkSession, sf_dir: str) -> DataFrame:
    number = F.col("l_linenumber") % 3
    return load(spark, sf_dir, "lineitem").select(
        F.col("l_orderkey").alias("status_id"),
        F.concat(F.lit("p"), F.col("l_partkey"), F.when(number == 0, ".exe").when(number == 1, ".dll").otherwise(".so")).alias("file_name"),
        F.col("l_shipdate").alias("build_date"),
        F.col("l_quantity").cast("long").alias("size"),
        (F.col("l_returnflag") == "R").alias("disasmed"),
    )


ROLE_SQL = """
projects AS (SELECT c_custkey AS _id, 'https://api.forge.com/repos/' || lower(c_mktsegment) || '/' || c_name AS url, c_name AS name,
    c_nationkey AS owner_id, floor(c_acctbal)::BIGINT AS size,
    CASE c_mktsegment WHEN 'AUTOMOBILE' THEN 'make' WHEN 'BUILDING' THEN 'cmake' WHEN 'FURNITURE' THEN 'cmake/make' WHEN 'HOUSEHOLD' THEN 'sln' ELSE '' END AS build_system FROM customer),
options AS (SELECT r_regionkey AS _id, r_name AS platform,
    CASE r_regionkey WHEN 0 THEN 'make' WHEN 1 THEN 'cmake' WHEN 2 THEN 'make/cmake' WHEN 3 THEN 'sln' ELSE '' END AS build_system, r_regionkey <> 3 AS enable FROM region),
statuses AS (SELECT o_orderkey AS _id, CASE left(o_orderpriority, 1) WHEN '1' THEN 2 WHEN '2' THEN 1 ELSE 0 END AS priority,
    CASE o_orderstatus WHEN 'F' THEN 2 WHEN 'P' THEN 1 ELSE 3 END AS clone_status,
    CASE WHEN o_orderstatus <> 'O' THEN 0 WHEN o_orderkey % 3 = 0 THEN 3 WHEN o_orderkey % 3 = 1 THEN 2 ELSE 10 END AS build_status,
    (o_orderkey % 5)::INTEGER AS build_opt_id, o_custkey AS repo_id, epoch(o_orderdate)::BIGINT AS mod_timestamp, floor(o_totalprice)::BIGINT AS build_time FROM orders),
binaries AS (SELECT l_orderkey AS status_id, 'p' || l_partkey || CASE l_linenumber % 3 WHEN 0 THEN '.exe' WHEN 1 THEN '.dll' ELSE '.so' END AS file_name,
    l_shipdate AS build_date, l_quantity::BIGINT AS size, l_returnflag = 'R' AS disasmed FROM lineitem)
"""
