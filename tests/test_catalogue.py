"""Every catalogue query against its SQL twin, row by row."""

from __future__ import annotations

import numbers

import pandas as pd
import pytest

from buildlake.plans import catalogue


def cell(v: object) -> str:
    if v is None or v is pd.NA or v is pd.NaT or v != v:
        return ""
    if isinstance(v, bool) or type(v).__name__ == "bool_":
        return str(bool(v))
    return f"{float(v):.6f}" if isinstance(v, numbers.Number) else str(v)


def rows(frame: pd.DataFrame) -> list[tuple]:
    return sorted(tuple(map(cell, r)) for r in frame[sorted(frame.columns)].astype(object).itertuples(index=False, name=None))


@pytest.mark.parametrize("name", sorted(catalogue.ORACLE_SQL))
def test_query_equals_its_sql(name, spark, sf_dir, duck):
    got = catalogue.QUERIES[name](spark, sf_dir).toPandas()
    want = duck.sql(catalogue.ORACLE_SQL[name]).df()
    assert sorted(got.columns) == sorted(want.columns)
    assert rows(got) == rows(want)


def test_byte_spans_of_all_documents(spark, sf_dir):
    texts = {r["doc_id"]: r["text"] for r in spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text").collect()}
    got = {r["doc_id"]: r["span"] for r in catalogue.QUERIES["function_bytes_hex"](spark, sf_dir).collect()}
    assert got == {d: t.encode()[10:30].hex().upper() for d, t in texts.items()}
    assert any(not t[:40].isascii() for t in texts.values())


def test_every_part_matches_its_name(spark, tmp_path):
    rows = [(1, "a Rose", "B#2"), (2, "b rose", "B#1"), (3, "c lily", "B#3"), (4, "d LILY", "B#1")]
    spark.createDataFrame(rows, "p_partkey long, p_name string, p_brand string").write.parquet(f"{tmp_path}/part.parquet")
    got = {r["p_partkey"]: r["matched"] for r in catalogue.QUERIES["name_match_ci_all"](spark, str(tmp_path)).collect()}
    assert got == {1: "B#1::rose", 2: "B#1::rose", 3: "B#1::LILY", 4: "B#1::LILY"}
    assert {r["p_partkey"]: r["matched"] for r in catalogue.QUERIES["name_match_ci"](spark, str(tmp_path)).collect()} == got
