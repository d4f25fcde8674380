"""What the operators share: input projection and tables in the shared folder."""

from __future__ import annotations

import hashlib
import tempfile
import uuid

import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F


def doc_texts(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(doc_id long, text string) of every row; a null text is empty; other columns are ignored."""
    return docs.select(
        F.col(f"`{id_col}`").cast("long").alias("doc_id"),
        F.coalesce(F.col(f"`{text_col}`").cast("string"), F.lit("")).alias("text"),
    )


def free_name(name: str, frame: DataFrame) -> str:
    """``name``, longer where ``frame`` has a column of that name."""
    taken = {c.lower() for c in frame.columns}
    while name.lower() in taken:
        name += "_"
    return name


def text_key(raw: bytes | memoryview) -> int:
    """60 bits of a text's SHA-256: with its id it names a row's content."""
    return int(hashlib.sha256(raw).hexdigest()[:15], 16)


def text_key_of(text: Column) -> Column:
    """``text_key`` as a column expression."""
    return F.conv(F.substring(F.sha2(text, 256), 1, 15), 16, 10).cast("long")


def filled(batch: pa.RecordBatch, text_col: str) -> pa.Array:
    """The text column of a batch, empty where it is null."""
    return pc.fill_null(batch.column(batch.schema.names.index(text_col)), "")


def shared_dir(spark: SparkSession, name: str) -> str:
    """A new path below the folder that the cluster shares: ``spark.checkpoint.dir``, or else the session's checkpoint folder.

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
    path = shared_dir(spark, name)
    df.write.option("compression", "zstd").parquet(path)
    return spark.read.schema(df.schema).parquet(path)
