"""Streams of binary chunks: digests chunk by chunk, places of chunks in the whole, what is missing or repeated.

No stream is ever put together in one cell. A task reads its streams' chunks in
order and feeds them to the digest one by one, so it holds one batch of chunks,
whatever a stream's length (``spark.sql.execution.arrow.maxBytesPerBatch`` bounds
a batch). A stream's digest is sequential by its nature: a long stream takes one
task long, but no memory.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from buildlake.operators import scans

DIGESTS = "chunks long, n_bytes long, sha256 string, missing long, repeated long, conflicting long"


class _Stream:
    """What is known of a stream after its chunks so far."""

    def __init__(self) -> None:
        self.digest, self.chunks, self.n_bytes, self.missing, self.repeated, self.conflicting = hashlib.sha256(), 0, 0, 0, 0, 0
        self.last, self.content = -1, b""

    def add(self, seq: int, content: bytes) -> None:
        if seq == self.last:
            self.repeated += 1
            self.conflicting += content != self.content
            return
        self.missing += seq - self.last - 1
        self.last, self.content = seq, content
        self.chunks += 1
        self.n_bytes += len(content)
        self.digest.update(content)

    def row(self) -> tuple:
        return self.chunks, self.n_bytes, self.digest.hexdigest(), self.missing, self.repeated, self.conflicting


def chunk_digests(chunks: DataFrame, stream: str = "name", seq: str = "seq", content: str = "content") -> DataFrame:
    """One row a stream: chunks, n_bytes and sha256 of its chunks in order; how many are missing, repeated, and repeated with other content.

    Numbers begin at 0. Of chunks of one number the one of least content counts.
    Chunks behind the last one can't be seen to be missing. Null content is
    empty; a null stream is one; rows with a null or negative number are left out;
    an empty table gives an empty result.
    """
    kind = dict(chunks.dtypes)[stream]
    rows = chunks.select(F.col(f"`{stream}`").alias("stream"), F.col(f"`{seq}`").cast("long").alias("seq"), F.coalesce(F.col(f"`{content}`").cast("binary"), F.lit(b"")).alias("content")).where("seq >= 0")

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        name, state = None, None

        def done() -> pa.RecordBatch:
            return pa.RecordBatch.from_arrays([pa.array([name], of_stream), *(pa.array([v], t) for v, t in zip(state.row(), (pa.int64(), pa.int64(), pa.string(), *[pa.int64()] * 3), strict=True))], names=["stream", *(c.split()[0] for c in DIGESTS.split(", "))])

        for batch in batches:
            of_stream = batch.schema.field("stream").type
            for i in range(batch.num_rows):
                key = batch.column("stream")[i].as_py()
                if state is None or key != name:
                    if state is not None:
                        yield done()
                    name, state = key, _Stream()
                state.add(batch.column("seq")[i].as_py(), batch.column("content")[i].as_py())
        if state is not None:
            yield done()

    ordered = rows.repartition("stream").sortWithinPartitions("stream", "seq", "content")
    return ordered.mapInArrow(work, f"stream {kind}, {DIGESTS}").withColumnRenamed("stream", stream)


def placed_chunks(chunks: DataFrame, stream: str = "name", seq: str = "seq", content: str = "content") -> DataFrame:
    """(stream, seq, place, content): the distinct chunks of each stream with the byte at which each begins.

    Written as they are, in parts, they are the stream's content: a reader takes
    the parts that its byte range meets. Chunks as in ``chunk_digests``; the
    places are summed up in ranges, so a stream may have any number of chunks.
    """
    rows = chunks.select(F.col(f"`{stream}`").alias(stream), F.col(f"`{seq}`").cast("long").alias("seq"), F.coalesce(F.col(f"`{content}`").cast("binary"), F.lit(b"")).alias("content")).where("seq >= 0")
    once = rows.groupBy(stream, "seq").agg(F.min("content").alias("content"))
    found = scans.scanned(once, [stream], ["seq"], {"end": scans.Sum(F.octet_length("content").cast("long"))})
    return found.select(stream, "seq", (F.col("end") - F.octet_length("content")).alias("place"), "content")
