"""Registration of queries with their SQL twins."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from buildlake.sources.roles import ROLE_SQL

Query = Callable[[SparkSession, str], DataFrame]


class Registry:
    """Queries by name; ``roles`` puts the role views before the SQL."""

    def __init__(self) -> None:
        self.queries: dict[str, Query] = {}
        self.sql: dict[str, str] = {}

    def __call__(self, sql: str | None = None, roles: bool = False) -> Callable[[Query], Query]:
        def add(query: Query) -> Query:
            self.queries[query.__name__] = query
            if sql:
                self.sql[query.__name__] = f"WITH {ROLE_SQL}\n{sql}" if roles else sql
            return query

        return add


def merged(*registries: Registry) -> tuple[dict[str, Query], dict[str, str]]:
    queries: dict[str, Query] = {}
    sql: dict[str, str] = {}
    for r in registries:
        queries |= r.queries
        sql |= r.sql
    return queries, sql
