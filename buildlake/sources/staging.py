"""Tables in the folder that the cluster shares: written once, read by every later step."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession


def work_folder(spark: SparkSession, name: str) -> str:
    """A new path below the shared folder: ``spark.checkpoint.dir``, or else the session's checkpoint folder.

    Only a local session, where all is one machine, gets a temporary one if neither is set.
    """
    sc = spark.sparkContext
    base = spark.conf.get("spark.checkpoint.dir", None) or sc._jsc.sc().getCheckpointDir().getOrElse(None)
    if base is None and not sc.master.startswith("local"):
        raise ValueError("spark.checkpoint.dir must name a folder that driver and executors share")
    if base is None:
        sc.setCheckpointDir(tempfile.mkdtemp(prefix="buildlake-"))
        base = sc._jsc.sc().getCheckpointDir().get()
    return f"{base.rstrip('/')}/{name}-{uuid.uuid4().hex}"


def staged(df: DataFrame, name: str) -> DataFrame:
    """Write ``df`` to the shared folder and read it back: lineage ends here and survives lost executors."""
    spark = df.sparkSession
    path = work_folder(spark, name)
    df.write.option("compression", "zstd").parquet(path)
    return spark.read.schema(df.schema).parquet(path)
