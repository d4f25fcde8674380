"""Places for a user's own code: staged strategies over tasks, analyses of binaries, predicates.

Hooks get pandas batches inside tasks; Spark partitions and retries them, so
they should have no effect that a second call would spoil.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator, Mapping

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from buildlake import schemas as S

Stage = Callable[[pd.DataFrame], pd.DataFrame]
"""Tasks to (status, msg) rows with the same index."""


def run_strategy(tasks: DataFrame, stages: Mapping[str, Stage]) -> DataFrame:
    """``tasks`` with stage, status and msg: each stage takes the tasks in which all earlier ones succeeded.

    A task's result is that of its last stage; a stage that raises fails its
    batch with the error's text. No stages: every task is initial.
    """
    steps = dict(stages)

    def work(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            out = batch.assign(stage=None, status=S.INIT, msg=None)
            for name, step in steps.items():
                alive = out.index[(out["status"] == S.SUCCESS) | out["stage"].isna()]
                if not len(alive):
                    break
                try:
                    got = step(batch.loc[alive])[["status", "msg"]].reindex(alive)
                except Exception as e:  # noqa: BLE001 - whatever a hook raises is the task's message
                    got = pd.DataFrame({"status": S.FAILED, "msg": f"{type(e).__name__}: {e}"[-500:]}, index=alive)
                out.loc[alive, "stage"] = name
                out.loc[alive, "status"] = got["status"].fillna(S.FAILED).astype("int64")
                out.loc[alive, "msg"] = got["msg"]
            yield out.astype({"status": "int32"})

    schema = ", ".join([*[f"`{n}` {t}" for n, t in tasks.dtypes], "stage string, status int, msg string"])
    return tasks.mapInPandas(work, schema)


def analysed(binaries: DataFrame, analysis: Callable[[str, bytes], Iterator[tuple]], schema: str, name: str = "file_name", content: str = "content") -> DataFrame:
    """The rows that ``analysis(name, content)`` makes of each binary, none to many; ``schema`` names their columns."""
    from pyspark.sql.types import StructType

    columns = StructType.fromDDL(schema).names

    def work(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            for key, blob in zip(batch[name], batch[content], strict=True):  # a binary's rows at a time
                rows = list(analysis(key, b"" if blob is None else bytes(blob)))
                if rows:
                    yield pd.DataFrame(rows, columns=columns).assign(**{name: key})[[name, *columns]]

    return binaries.select(name, content).mapInPandas(work, f"`{name}` string, {schema}")


def accepted(table: DataFrame, predicate: Callable[..., bool], *columns: str) -> DataFrame:
    """Rows that a Python predicate over some columns accepts; null counts as refused."""

    @F.pandas_udf("boolean")
    def test(*values: pd.Series) -> pd.Series:
        return pd.Series([bool(predicate(*row)) for row in zip(*values, strict=True)], dtype="boolean")

    return table.where(F.coalesce(test(*columns), F.lit(False)))
