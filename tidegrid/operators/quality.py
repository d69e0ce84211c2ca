"""Counts, expectations and profiles."""

from __future__ import annotations

from pyspark.sql import DataFrame, Observation
from pyspark.sql import functions as F

from tidegrid.operators.overlay import ring_extent


def null_report(df: DataFrame) -> DataFrame:
    """NULL count per column in long form (column_name, null_count), one scan."""
    counts = df.agg(*[F.count_if(F.col(c).isNull()).alias(c) for c in df.columns])
    return counts.select(F.inline(F.array(*[
        F.struct(F.lit(c).alias("column_name"), F.col(c).alias("null_count")) for c in df.columns
    ])))


def warn_on_nulls(report: DataFrame) -> int:
    """Total of a NULL report; prints the offending columns when it is not zero."""
    bad = report.where("null_count > 0").collect()  # one row per column of the table
    for row in bad:
        print(f"NULL values found: {row['column_name']} = {row['null_count']}")
    return sum(row["null_count"] for row in bad)


def observed_count(df: DataFrame, name: str) -> tuple[DataFrame, Observation]:
    """The table with a row counter that fills while another action runs."""
    seen = Observation(name)
    return df.observe(seen, F.count(F.lit(1)).alias("rows")), seen


def observed_nan_points(nodes: DataFrame, name: str) -> tuple[DataFrame, Observation]:
    """Node table with a counter of NaN coordinates."""
    seen = Observation(name)
    nan = F.isnan("long") | F.isnan("lat")
    return nodes.observe(seen, F.count_if(nan).alias("nan_points")), seen


def mesh_profile(nodes: DataFrame, elements: DataFrame, extra: DataFrame | None = None) -> DataFrame:
    """One row: max_node_id, node_count, element_count, extra_count."""
    n = nodes.agg(F.max("node_id").alias("max_node_id"), F.count(F.lit(1)).alias("node_count"))
    e = elements.agg(F.count(F.lit(1)).alias("element_count"))
    out = n.withColumn("element_count", e.scalar())
    if extra is None:
        return out.withColumn("extra_count", F.lit(0).cast("long"))
    return out.withColumn("extra_count", extra.agg(F.count(F.lit(1))).scalar())


def extent(df: DataFrame, ring: str = "ring") -> DataFrame:
    """Extent of a polygon layer as one row."""
    return ring_extent(df, ring)


class Expectation:
    """What a table must hold, judged by counters that filled while the caller's action ran."""

    def __init__(self, seen: Observation, rows: int | None) -> None:
        self.seen, self.rows = seen, rows

    def verify(self) -> int:
        """The number of rows that passed, or an error; waits for the action to end."""
        found = self.seen.get["rows"]
        if self.rows is None and not found:
            raise ValueError("the table is empty")
        if self.rows is not None and found != self.rows:
            raise ValueError(f"expected {self.rows} rows, found {found}")
        return found


def expect(df: DataFrame, columns: list[str] | None = None, rows: int | None = None) -> tuple[DataFrame, Expectation]:
    """The table with a check of its required columns (at once) and of its row count.

    Without ``rows`` the table only has to be non-empty. The count is taken while the caller's
    own action runs, so the input is computed once: act on the table, then ``verify``. To keep a wrong
    table from being seen, write it through ``TableStore.write`` with ``rows``, which commits after the check.
    """
    missing = [c for c in columns or [] if c not in df.columns]
    if missing:
        raise ValueError(f"missing columns: {', '.join(missing)}")
    counted, seen = observed_count(df, "expected")
    return counted, Expectation(seen, rows)
