"""Portable executables by address: section tables as intervals, bytes of functions cut where they lie in the file.

Only headers are parsed, and no memory image is made: an address range meets its
file's sections, each meeting is a piece of the file, and pieces are cut and put
together in the JVM, with zeros where the file stores nothing. So a slice costs
its own length, whatever the size of the image, and may cross sections.
"""

from __future__ import annotations

import struct
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from buildlake.functions import numbers, text
from buildlake.sources import files
from buildlake.sources.images import MOST_BYTES
from buildlake.sources.staging import staged


def little_endian(content: Column, at: Column, n: int) -> Column:
    """The unsigned number of ``n`` bytes at an offset; null where the content ends before."""
    digits = F.hex(F.substring(content, (at + 1).cast("int"), F.lit(n)))
    turned = F.concat(*[F.substring(digits, 2 * k + 1, 2) for k in reversed(range(n))])
    return F.when(F.length(digits) == 2 * n, F.conv(turned, 16, 10).cast("long"))


def read_header(header: bytes, length: int) -> tuple[int, list[tuple[int, int, int]]]:
    """(size, sections as (start, end, offset)) from a header, which begins at its signature; ValueError if it is none."""
    if header[:4] != b"PE\0\0":
        raise ValueError("no portable executable")
    try:
        n, optional = struct.unpack_from("<H", header, 6)[0], struct.unpack_from("<H", header, 20)[0]
        size, headers = struct.unpack_from("<II", header, 24 + 56)
        table = [struct.unpack_from("<IIII", header, 24 + optional + 40 * i + 8) for i in range(n)]
    except struct.error as e:
        raise ValueError("truncated header") from e
    if size > MOST_BYTES:
        raise ValueError("image size out of range")
    stored = [(0, headers, 0), *((address, min(raw, virtual or raw), offset) for virtual, address, raw, offset in table)]
    return size, [(at, min(size, at + min(n, length - offset)), offset) for at, n, offset in stored if at < size and min(n, length - offset) > 0]


def mapped_files(table: DataFrame, name: str = "file_name", content: str = "content") -> DataFrame:
    """(file_name, file_key, size, sections, error) of executables; sections: array of (start, end, offset).

    Addresses in ``start`` to ``end`` lie from ``offset`` on in the file: the
    headers, and each section as far as it is stored; the rest of ``size`` is
    zeros. Sections of a well-formed file are apart; of an address in several the
    later section counts. Null content is empty; error says why there is no
    image, and size and sections are null then. Only headers leave the JVM;
    file_key tells contents under one name apart.
    """
    blob = F.col("blob")
    rows = table.select(F.col(f"`{name}`").alias("file_name"), F.coalesce(F.col(f"`{content}`").cast("binary"), F.lit(b"")).alias("blob"))
    start = little_endian(blob, F.lit(0x3C), 4)
    begins = rows.withColumn("pe", F.when((F.hex(F.substring(blob, 1, 2)) == "4D5A") & (start < F.octet_length(blob)), start.cast("int")))
    # as many bytes as the header's own numbers say
    n = 24 + 128 + F.coalesce(little_endian(blob, F.col("pe") + 20, 2), F.lit(0)) + 40 * F.coalesce(little_endian(blob, F.col("pe") + 6, 2), F.lit(0))
    heads = begins.select("file_name", F.xxhash64("blob").alias("file_key"), F.octet_length(blob).cast("long").alias("length"), F.substring(blob, F.col("pe") + 1, n.cast("int")).alias("header"))

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            sizes, sections, errors = [], [], []
            for header, length in zip(batch.column("header").to_pylist(), batch.column("length").to_pylist(), strict=True):
                try:
                    size, found = read_header(header or b"", length)
                    sizes.append(size)
                    sections.append([dict(zip(("start", "end", "offset"), s, strict=True)) for s in found])
                    errors.append(None)
                except ValueError as e:
                    sizes.append(None)
                    sections.append(None)
                    errors.append(str(e))
            kind = pa.list_(pa.struct([(f, pa.int64()) for f in ("start", "end", "offset")]))
            yield pa.RecordBatch.from_arrays([batch.column("file_name"), batch.column("file_key"), pa.array(sizes, pa.int64()), pa.array(sections, kind), pa.array(errors, pa.string())], names=["file_name", "file_key", "size", "sections", "error"])

    return heads.mapInArrow(work, f"file_name {dict(table.dtypes)[name]}, file_key long, size long, sections array<struct<start: long, end: long, offset: long>>, error string")


def _uncovered(sections: Column) -> Column:
    """Sections cut to the addresses that no later one has: pieces of the address space, in its order."""
    # every start and end cuts; of the sections over a piece the last counts
    cuts = F.array_sort(F.array_distinct(F.flatten(F.transform(sections, lambda s: F.array(s["start"], s["end"])))))
    last = lambda c: F.try_element_at(F.filter(sections, lambda s: (s["start"] <= c) & (c < s["end"])), F.lit(-1))
    piece = lambda c, i: F.struct(c.alias("start"), F.try_element_at(cuts, (i + 2).cast("int")).alias("end"), (last(c)["offset"] + c - last(c)["start"]).alias("offset"))
    return F.filter(F.transform(cuts, piece), lambda p: p["end"].isNotNull() & p["offset"].isNotNull())


def section_intervals(mapped: DataFrame) -> DataFrame:
    """(file_name, file_key, start, end, offset): one row for each stored piece of a file's addresses; pieces don't overlap."""
    pieces = F.when(F.size("sections") > 0, _uncovered(F.col("sections")))
    return mapped.select("file_name", "file_key", F.explode(pieces).alias("p")).select("file_name", "file_key", "p.*")


def _zeros(n: Column) -> Column:
    return F.unhex(F.repeat(F.lit("00"), F.greatest(n, F.lit(0)).cast("int")))


def mapped_bytes(functions: DataFrame, table: DataFrame, name: str = "file_name", content: str = "content") -> DataFrame:
    """Each function's bytes in memory: file_name, name, slices (its segments one by one), span (first to last address).

    ``functions``: file_name, name, segments (array of start and end addresses);
    ``table``: executables. What lies beyond an image's size is cut off, what
    lies in it but isn't stored is zeros; a segment that ends before it starts is
    empty. Functions of files that are no executables have no row, those of a
    name with several contents one for each; rows repeated in ``functions`` come
    out once; a function without segments has no slices and no span.
    """
    mapped = staged(mapped_files(table, name, content).where("error is null"), "sections")
    blobs = table.select(F.col(f"`{name}`").alias("file_name"), F.coalesce(F.col(f"`{content}`").cast("binary"), F.lit(b"")).alias("content"))
    blobs = blobs.withColumn("file_key", F.xxhash64("content"))
    segments = F.col("segments")
    first = F.array_min(F.transform(segments, lambda s: F.least(s["start"], s["end"])))
    last = F.array_max(F.transform(segments, lambda s: F.greatest(s["start"], s["end"])))
    longs = F.transform(segments, lambda s: F.struct(s["start"].cast("long").alias("start"), s["end"].cast("long").alias("end")))
    plain = functions.select("file_name", "name", F.coalesce(longs, F.array().cast("array<struct<start: bigint, end: bigint>>")).alias("segments")).distinct()
    whole = F.struct(first.cast("long").alias("start"), last.cast("long").alias("end"))
    # the span is one more segment, the last one
    ranges = plain.withColumn("n", F.size("segments")).select("file_name", "name", "segments", F.posexplode(F.concat("segments", F.array(whole))).alias("at", "r"))
    clipped = ranges.join(mapped.select("file_name", "file_key", "size"), "file_name").select("file_name", "file_key", "name", "segments", "at", F.col("r.start").alias("low"), F.least("r.end", "size").alias("high"))
    key = ["file_name", "file_key", "name", "segments", "at", "low", "high"]
    meets = (F.col("start") < F.col("high")) & (F.col("end") > F.col("low"))
    # a file has few sections; each meeting is a piece of the file
    pieces = clipped.join(section_intervals(mapped), ["file_name", "file_key"]).where(meets)
    from_, to = F.greatest("start", "low"), F.least("end", "high")
    placed = pieces.select(*key, from_.alias("from"), (F.col("offset") + from_ - F.col("start")).alias("place"), (to - from_).alias("length"))
    stored = placed.join(blobs, ["file_name", "file_key"]).select(*key, F.struct("from", F.substring(F.col("content"), (F.col("place") + 1).cast("int"), F.col("length").cast("int")).alias("bytes")).alias("piece"))
    # ranges without a piece keep their row; nulls are not collected
    every = stored.union(clipped.select(*key, F.lit(None).cast(stored.schema["piece"].dataType).alias("piece")))
    gathered = every.groupBy(*key).agg(F.array_sort(F.collect_list("piece")).alias("pieces"))
    start = F.struct(F.col("low").alias("done"), F.lit(b"").alias("bytes"))
    put = lambda a, p: F.struct((p["from"] + F.octet_length(p["bytes"])).alias("done"), F.concat(a["bytes"], _zeros(p["from"] - a["done"]), p["bytes"]).alias("bytes"))
    joined = F.aggregate("pieces", start, put)
    data = F.when(F.col("high") > F.col("low"), F.concat(joined["bytes"], _zeros(F.col("high") - joined["done"]))).otherwise(F.when(F.col("low").isNotNull(), F.lit(b"")))
    cut = gathered.select("file_name", "file_key", "name", "segments", F.struct("at", data.alias("bytes")).alias("c")).groupBy("file_name", "file_key", "name", "segments").agg(F.array_sort(F.collect_list("c")).alias("c"))
    n = F.size("segments")
    return cut.select("file_name", "name", F.transform(F.slice("c", F.lit(1), n), lambda c: c["bytes"]).alias("slices"), F.element_at("c", n + 1)["bytes"].alias("span"))


def load_corpus(spark: SparkSession, folder: str, endings: str = "*.{exe,dll}", limit: int | None = None) -> DataFrame:
    """(file_name, name, slices, span) of every function that the JSON build documents below ``folder`` list, from the executables beside them.

    Documents and binaries meet by base name; ``limit`` takes the first
    documents by path.
    """
    docs = files.json_documents(spark, folder, limit=limit, name_filter="*.json").where("_corrupt is null")
    listed = docs.select(F.explode("Binary_info_list").alias("b")).select(text.base_name(F.col("b.file")).alias("file_name"), F.explode("b.functions").alias("f"))
    segments = F.transform("f.function_info", lambda s: F.struct(numbers.from_hex(s["rva_start"]).alias("start"), numbers.from_hex(s["rva_end"]).alias("end")))
    functions = listed.select("file_name", F.col("f.function_name").alias("name"), segments.alias("segments"))
    binaries = files.binary_files(spark, folder, endings).select(text.base_name(F.col("path")).alias("file_name"), "content")
    return mapped_bytes(functions, binaries)
