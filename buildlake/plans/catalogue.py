"""The query catalogue: name to Spark query, name to its SQL twin."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from buildlake.plans import control, ordered, queues, scalar, staged_files, streams
from buildlake.plans.registry import merged

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]]
ORACLE_SQL: dict[str, str]
QUERIES, ORACLE_SQL = merged(control.REGISTRY, ordered.REGISTRY, queues.REGISTRY, scalar.REGISTRY, staged_files.REGISTRY, streams.REGISTRY)
