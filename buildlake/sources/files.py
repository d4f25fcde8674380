"""Readers and writers: JSON documents, archives, binaries by magic number, listings, XML, partitioned paths."""

from __future__ import annotations

import io
import zipfile
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from buildlake import schemas as S
from buildlake.functions import numbers, text

# fixed values: magic number and types (executable, shared object) of ELF files
ELF_MAGIC, ELF_TYPES = "7F454C46", (2, 3)
# fixed values: name of the metadata in archives, endings of Windows build products
METADATA = "pdbinfo.json"
PRODUCTS = r"(?i)\.(pdb|exe|dll|lib)$"


def json_documents(spark: SparkSession, path: str, schema: str = S.BUILD_DOCUMENT, limit: int | None = None, name_filter: str | None = None) -> DataFrame:
    """Build documents, one a file, by a fixed schema; what can't be read is in ``_corrupt``. ``limit``: the first ones by path."""
    reader = spark.read.schema(f"{schema}, _corrupt string").option("multiLine", True).option("columnNameOfCorruptRecord", "_corrupt").option("recursiveFileLookup", True)
    docs = (reader.option("pathGlobFilter", name_filter) if name_filter else reader).json(path)
    return docs.withColumn("__path", F.col("_metadata.file_path")).orderBy("__path").limit(limit).drop("__path") if limit else docs


def decoded_json(table: DataFrame, column: str, schema: str) -> tuple[DataFrame, DataFrame]:
    """(rows with their decoded fields, rows that can't be decoded)."""
    parsed = table.withColumn("__r", F.from_json(column, schema, {"mode": "PERMISSIVE", "columnNameOfCorruptRecord": "_corrupt"}))
    broken = F.col("__r").isNull() | F.expr(f"try_parse_json({column}) is null")
    return parsed.where(~broken).select("*", "__r.*").drop("__r"), parsed.where(broken).drop("__r")


def binary_files(spark: SparkSession, path: str, name_filter: str | None = None) -> DataFrame:
    """path, length, modificationTime, content of every file below a folder."""
    reader = spark.read.format("binaryFile").option("recursiveFileLookup", True)
    return (reader.option("pathGlobFilter", name_filter) if name_filter else reader).load(path)


def archive_members(archives: DataFrame, path: str = "path", content: str = "content", metadata: str | None = METADATA) -> DataFrame:
    """(archive, member, n_bytes, content) of zip archives that hold the metadata; damaged ones give nothing.

    ``metadata`` None keeps every archive.
    """
    names = ["archive", "member", "n_bytes", "content"]

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for archive, blob in zip(batch.column(0), batch.column(1), strict=True):
                try:
                    z = zipfile.ZipFile(io.BytesIO(blob.as_py() or b""))
                except zipfile.BadZipFile:
                    continue
                with z:
                    members = [m for m in z.infolist() if not m.is_dir()]
                    if metadata and not any(m.filename.rsplit("/", 1)[-1] == metadata for m in members):
                        continue
                    for m in members:  # one member at a time
                        yield pa.RecordBatch.from_arrays([pa.array([archive.as_py()]), pa.array([m.filename]), pa.array([m.file_size], pa.int64()), pa.array([z.read(m)], pa.binary())], names=names)

    return archives.select(path, content).mapInArrow(work, "archive string, member string, n_bytes long, content binary")


def elf_binaries(files: DataFrame, content: str = "content") -> DataFrame:
    """Files that are ELF executables or shared objects, in either byte order; decided by 18 bytes, in the JVM."""
    at = lambda place, n=1: F.conv(F.hex(F.substring(content, place, n)), 16, 10).cast("int")
    kind = F.when(at(6) == 2, at(17) * 256 + at(18)).otherwise(at(18) * 256 + at(17))
    return files.where((F.hex(F.substring(content, 1, 4)) == ELF_MAGIC) & (F.octet_length(content) >= 18)).withColumn("elf_type", kind).where(F.col("elf_type").isin(*ELF_TYPES))


def build_products(files: DataFrame, path: str = "path") -> DataFrame:
    return files.where(F.col(path).rlike(PRODUCTS))


def hashed_layout(table: DataFrame, name: str) -> DataFrame:
    """``table`` with the first two digits of the name's hash as ``prefix`` and the others as ``rest``: partition by the first."""
    digits = F.md5(text.printable(F.col(name)))
    return table.withColumns({"prefix": F.left(digits, F.lit(2)), "rest": F.substring(digits, 3, 30)})


def write_hashed(table: DataFrame, name: str, path: str) -> None:
    """``table`` below ``path``, a folder for each prefix; ``read_hashed`` reads some of them."""
    hashed_layout(table, name).repartition("prefix").write.mode("append").partitionBy("prefix").parquet(path)


def read_hashed(spark: SparkSession, path: str, schema: T.StructType, names: DataFrame, name: str) -> DataFrame:
    """Rows of a hashed layout whose name is in ``names``: only the folders that those names lie in are listed and read.

    The names' prefixes, of which there are 256, become a filter on the
    partition column; the names themselves are joined.
    """
    wanted = hashed_layout(names.select(F.col(name)).where(F.col(name).isNotNull()).distinct(), name)
    prefixes = sorted(r["prefix"] for r in wanted.select("prefix").distinct().collect())  # 256 at most
    stored = spark.read.schema(T.StructType([*schema.fields, T.StructField("rest", T.StringType()), T.StructField("prefix", T.StringType())])).parquet(path)
    return stored.where(F.col("prefix").isin(prefixes)).join(wanted, ["prefix", "rest", name], "left_semi").select(*schema.fieldNames())


def append_rows(table: DataFrame, path: str) -> None:
    """Bulk insert: ids are the store's, so they go."""
    table.drop("id", "_id").write.mode("append").parquet(path)


def recreate(spark: SparkSession, schema: T.StructType, path: str) -> None:
    """An empty table in the place of what was there."""
    spark.createDataFrame([], schema).write.mode("overwrite").parquet(path)


def write_json_documents(documents: DataFrame, path: str) -> None:
    documents.write.mode("overwrite").json(path)


def jdbc_table(spark: SparkSession, url: str, table: str, key: str | None = None, bounds: tuple[int, int, int] | None = None, **options: str) -> DataFrame:
    """A table of a database; with a key and (low, high, parts) it is read in parallel."""
    reader = spark.read.format("jdbc").options(url=url, dbtable=table, **options)
    if key and bounds:
        reader = reader.options(partitionColumn=key, lowerBound=bounds[0], upperBound=bounds[1], numPartitions=bounds[2])
    return reader.load()


def xml_rows(spark: SparkSession, path: str, row_tag: str, schema: T.StructType) -> DataFrame:
    return spark.read.format("xml").option("rowTag", row_tag).schema(schema).load(path)


def catalogue_rows(documents: DataFrame, column: str) -> DataFrame:
    """Repositories of a catalogue ``{"Source": [{"Name": ...}]}``, with the columns it lacks as constants."""
    names = documents.select(F.explode(F.from_json(column, "struct<Source: array<struct<Name: string>>>")["Source"]).alias("s"))
    return names.select(F.col("s.Name").alias("name"), F.concat(F.lit("catalogue://"), F.col("s.Name")).alias("url"), F.lit("c++").alias("language"), F.lit(0).alias("owner_id"), F.lit("").alias("description"), F.lit("others").alias("build_system"))


def documents_of_project(documents: DataFrame, url: str, name: str) -> DataFrame:
    """Documents whose name begins with the hash of an address."""
    return documents.where(F.col(name).startswith(F.md5(F.lit(url))))


def identified_by(documents: DataFrame) -> DataFrame:
    return documents.withColumn("identifier", numbers.identifier(F.col("URL"), F.col("Platform"), F.col("Build_mode")))
