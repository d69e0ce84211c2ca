"""Side-by-side comparison of a registered query with its DuckDB statement."""

from __future__ import annotations

import glob
import os

import duckdb
import pandas as pd
from pyspark.sql import SparkSession

from fixtures.registry import ORACLES, QUERIES


def connect(sf_dir: str) -> duckdb.DuckDBPyConnection:
    """An in-process DuckDB with a view per supplied table."""
    con = duckdb.connect()
    for path in glob.glob(f"{sf_dir}/*.parquet"):
        name = os.path.basename(path)[: -len(".parquet")]
        con.execute(f"CREATE VIEW {name} AS SELECT * FROM '{path}'")
    return con


def _canonical(df: pd.DataFrame) -> list[tuple]:
    df = df[sorted(df.columns)]
    rows = []
    for row in df.itertuples(index=False, name=None):
        rows.append(tuple("NULL" if v is None or v is pd.NA or v != v else
                          (repr(float(v)) if isinstance(v, float) else str(v)) for v in row))
    return sorted(rows)


def difference(spark: SparkSession, con: duckdb.DuckDBPyConnection, sf_dir: str, name: str) -> tuple[int, str | None]:
    """Row count of the Spark side, and a description of the first difference (or None)."""
    df = QUERIES[name](spark, sf_dir)
    got = pd.DataFrame([tuple(r) for r in df.collect()], columns=df.columns, dtype=object)
    if name not in ORACLES:
        return len(got), None
    cursor = con.execute(ORACLES[name])
    columns = [d[0] for d in cursor.description]
    want = pd.DataFrame(cursor.fetchall(), columns=columns, dtype=object)
    if sorted(got.columns) != sorted(want.columns):
        return len(got), f"columns {sorted(got.columns)} vs {sorted(want.columns)}"
    if len(got) != len(want):
        return len(got), f"rows {len(got)} vs {len(want)}"
    a, b = _canonical(got), _canonical(want)
    wrong = [(x, y) for x, y in zip(a, b) if x != y]
    return len(got), f"{len(wrong)} rows differ, first {wrong[0]}" if wrong else None
