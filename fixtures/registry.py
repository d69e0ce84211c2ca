"""Registration of queries with their DuckDB counterparts."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

Query = Callable[[SparkSession, str], DataFrame]

QUERIES: dict[str, Query] = {}
ORACLES: dict[str, str] = {}


def query(name: str, oracle: str | None = None) -> Callable[[Query], Query]:
    """Register a query under a name, with the SQL it is compared to."""

    def register(fn: Query) -> Query:
        if name in QUERIES:
            raise ValueError(f"query {name} is registered twice")
        QUERIES[name] = fn
        if oracle is not None:
            ORACLES[name] = oracle
        return fn

    return register


def rounded(df: DataFrame, digits: int = 6) -> DataFrame:
    """Double columns rounded for comparison (sums differ in the last digits by order)."""
    return df.select(*[
        F.round(F.col(f.name).cast("double"), digits).alias(f.name)
        if isinstance(f.dataType, (T.DoubleType, T.FloatType)) else F.col(f.name)
        for f in df.schema.fields
    ])


def vertices(df: DataFrame, keys: list[str], ring: str = "ring") -> DataFrame:
    """A ring table flattened to one row per vertex, for comparison."""
    flat = df.select(*keys, F.posexplode(ring).alias("pos", "p"))
    return rounded(flat.select(*keys, "pos", F.col("p.x").alias("x"), F.col("p.y").alias("y")))
