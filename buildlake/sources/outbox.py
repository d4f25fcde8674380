"""A message-queue sink: JSON lines in a shared folder that appear all at once, batch by batch.

Executors write their rows to hidden files (readers skip names that begin with
a dot). When all tasks of a batch are done, its files get names made from batch
and partition; a batch that is replayed gets the same names again, so a reader
sees every message once. An aborted batch's files, and those of lost tasks, are
removed when a batch ends; so an outbox has one query that writes to it. Whoever
reads the folder as a stream of files reads committed messages only.

The folder is any that ``pyarrow.fs`` opens from a path or URI on driver and
executors alike.
"""

from __future__ import annotations

import json
import uuid
from collections.abc import Iterator
from dataclasses import dataclass

import pyarrow as pa
from pyarrow import fs
from pyspark import TaskContext
from pyspark.sql.datasource import DataSource, DataSourceStreamArrowWriter, WriterCommitMessage
from pyspark.sql.streaming import DataStreamWriter
from pyspark.sql.types import StructType

FORMAT = "message_outbox"


@dataclass
class Written(WriterCommitMessage):
    """A task's hidden file, None where it had no rows."""

    partition: int
    file: str | None


class OutboxWriter(DataSourceStreamArrowWriter):
    def __init__(self, path: str) -> None:
        self.path = path

    def _folder(self) -> tuple[fs.FileSystem, str]:
        system, folder = fs.FileSystem.from_uri(self.path) if "://" in self.path or self.path.startswith("file:") else (fs.LocalFileSystem(), self.path)
        system.create_dir(folder, recursive=True)
        return system, folder

    def write(self, iterator: Iterator[pa.RecordBatch]) -> Written:
        """Runs on an executor; what it can't finish it removes."""
        system, folder = self._folder()
        partition, file, n = TaskContext.get().partitionId(), f"{folder}/.{uuid.uuid4().hex}.json", 0
        try:
            with system.open_output_stream(file) as out:
                for batch in iterator:
                    n += batch.num_rows
                    out.write("".join(json.dumps(row, default=str) + "\n" for row in batch.to_pylist()).encode())
        except BaseException:
            system.delete_file(file)
            raise
        if not n:
            system.delete_file(file)
        return Written(partition, file if n else None)

    def _sweep(self, system: fs.FileSystem, folder: str) -> None:
        """Removes hidden files: when a batch ends, those are what lost and killed tasks have left."""
        for entry in system.get_file_info(fs.FileSelector(folder)):
            if entry.base_name.startswith(".") and entry.base_name.endswith(".json"):
                system.delete_file(entry.path)

    def commit(self, messages: list[WriterCommitMessage | None], batchId: int) -> None:  # noqa: N803
        system, folder = self._folder()
        for m in messages:
            if isinstance(m, Written) and m.file is not None:
                system.move(m.file, f"{folder}/batch-{batchId:09d}-{m.partition:05d}.json")
        self._sweep(system, folder)

    def abort(self, messages: list[WriterCommitMessage | None], batchId: int) -> None:  # noqa: N803
        self._sweep(*self._folder())


class Outbox(DataSource):
    @classmethod
    def name(cls) -> str:
        return FORMAT

    def streamWriter(self, schema: StructType, overwrite: bool) -> OutboxWriter:  # noqa: N802
        return OutboxWriter(self.options["path"])


def to_outbox(writer: DataStreamWriter, path: str, checkpoint: str) -> DataStreamWriter:
    """``writer`` set to append to the outbox in ``path``; start it with a trigger of one's own."""
    writer._spark.dataSource.register(Outbox)
    return writer.format(FORMAT).option("path", path).option("checkpointLocation", checkpoint).outputMode("append")
