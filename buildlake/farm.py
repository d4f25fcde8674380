"""A build farm put together step by step; each step returns the farm, ``run`` the dataset's tables.

    Farm(spark).documents(path).sizes(least_kb=1).folders_of(2).only(predicate).run(files)
"""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass, field, replace

from pyspark.sql import DataFrame, SparkSession

from buildlake.operators import corpus
from buildlake.sources import files as readers
from buildlake.sources.staging import staged

Step = Callable[[DataFrame], DataFrame]


@dataclass(frozen=True)
class Farm:
    """Settings only: nothing is read before ``run``, and a farm can be the start of several others."""

    spark: SparkSession
    source: DataFrame | None = None
    least_kb: float | None = None
    most_kb: float | None = None
    least_files: int = 2
    steps: tuple[Step, ...] = field(default=())

    def documents(self, source: str | DataFrame) -> Farm:
        """Build documents: a table, or a folder of JSON files."""
        return replace(self, source=readers.json_documents(self.spark, source) if isinstance(source, str) else source)

    def sizes(self, least_kb: float | None = None, most_kb: float | None = None) -> Farm:
        return replace(self, least_kb=least_kb, most_kb=most_kb)

    def folders_of(self, least_files: int) -> Farm:
        return replace(self, least_files=least_files)

    def only(self, step: Step) -> Farm:
        """A user's own transformation of the documents, after those already there."""
        return replace(self, steps=(*self.steps, step))

    def run(self, listed: DataFrame | None = None) -> dict[str, DataFrame]:
        """binaries, dropped, functions and lines; ``listed``: files (identifier, file_name, n_bytes).

        Without files those that the documents list are taken, whose sizes nobody
        knows: they are null, and a farm with bounds on the size needs files.
        """
        if self.source is None:
            raise ValueError("a farm needs documents")
        docs = self.source
        for step in self.steps:
            docs = docs.transform(step)
        if listed is None and (self.least_kb or self.most_kb):
            raise ValueError("bounds on the size need files with their sizes")
        docs = staged(docs, "documents")  # read for names, for metadata and for functions
        files = listed if listed is not None else corpus.described_binaries(docs).selectExpr("identifier", "file_name", "cast(null as long) as n_bytes")
        binaries, dropped = corpus.dataset_binaries(files, docs, self.least_kb, self.most_kb, self.least_files)
        functions = corpus.dataset_functions(binaries)
        return {"binaries": binaries, "dropped": dropped, "functions": functions, "lines": corpus.dataset_lines(functions)}
