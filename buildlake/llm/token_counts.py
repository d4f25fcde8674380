"""Token counts through a digest cache.

A cache is a table of (version, digest, n_tokens) in a shared folder. Contents
are digested in the JVM; distinct digests that the cache lacks are encoded
once, whatever the number of copies, and appended; all rows then get their
count by a join. Texts move only for misses, by one shuffle on ids and digests.
The counts of all digests are written before the last join, which so has two
plain sides: a digest that a third of the rows share can be split at run time.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from buildlake.llm.common import doc_texts, shared_dir, staged
from buildlake.llm.tokens import load

CACHE = "digest binary, n_tokens long"


def version_digest(path: str, ranks: str | None = None) -> str:
    """Digest of the tokenizer's files: others never read these ones' counts."""
    out = hashlib.sha256()
    for name in (path, ranks):
        if name:
            with open(name, "rb") as f:
                out.update(hashlib.file_digest(f, "sha256").digest())
    return out.hexdigest()


def cached_counts(spark: SparkSession, cache: str, version: str) -> DataFrame:
    """(digest, n_tokens) of a version; empty where nothing is stored yet. Repeated entries count once."""
    folder = spark._jvm.org.apache.hadoop.fs.Path(f"{cache}/version={version}")
    there = folder.getFileSystem(spark._jsc.hadoopConfiguration()).exists(folder)
    stored = spark.read.schema(CACHE).parquet(f"{cache}/version={version}") if there else spark.createDataFrame([], CACHE)
    return stored.groupBy("digest").agg(F.max("n_tokens").alias("n_tokens"))


def encode_misses(texts: DataFrame, path: str, ranks: str | None) -> DataFrame:
    """(digest, n_tokens) of (digest, text); rows that repeat the one before are encoded once."""

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tokenizer, last = load(path, ranks), None
        for batch in batches:
            digests, counts = [], []
            for digest, text in zip(batch.column(0).to_pylist(), batch.column(1), strict=True):
                if digest != last:
                    digests.append(digest)
                    counts.append(tokenizer.count(text.as_py()))
                last = digest
            yield pa.RecordBatch.from_arrays([pa.array(digests, pa.binary()), pa.array(counts, pa.int64())], names=["digest", "n_tokens"])

    return texts.select("digest", "text").mapInArrow(work, CACHE)


def count_tokens(docs: DataFrame, path: str, ranks: str | None = None, cache: str | None = None, limit: int = 1024, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """doc_id, n_bytes, n_tokens, over_limit of every row of ``docs``.

    ``path``: a .json file (tokenizers) or .model file (sentencepiece); no
    begin, end or added tokens, no truncation. ``cache``: the folder that keeps
    counts between runs; a new one if not given. Content is normalised only as
    far as no count can change: null is empty. Repeated rows, also several
    texts under one id and null ids, each get their own count; an empty table
    gives an empty result and leaves the cache as it is.
    """
    spark = docs.sparkSession
    cache = cache or shared_dir(spark, "token-cache")
    version = version_digest(path, ranks)
    texts = doc_texts(docs, id_col, text_col)
    digest = F.unhex(F.sha2(F.col("text"), 256))
    keys = staged(texts.select("doc_id", digest.alias("digest"), F.octet_length("text").cast("long").alias("n_bytes")), "digests")
    # one id to read each missing content from
    distinct = keys.groupBy("digest").agg(F.min(F.coalesce("doc_id", F.lit(-1 << 63))).alias("key"))
    misses = staged(distinct.join(cached_counts(spark, cache, version), "digest", "left_anti"), "misses")
    found = texts.select(F.coalesce("doc_id", F.lit(-1 << 63)).alias("key"), digest.alias("digest"), "text").join(misses, ["key", "digest"])
    encode_misses(found, path, ranks).write.mode("append").parquet(f"{cache}/version={version}")
    counts = staged(keys.select("digest").distinct().join(cached_counts(spark, cache, version), "digest"), "counts")
    counted = keys.join(counts, "digest")
    return counted.select("doc_id", "n_bytes", "n_tokens", (F.col("n_tokens") > limit).alias("over_limit"))
