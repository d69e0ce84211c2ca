"""Mesh and crosswalk text files."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tidegrid.functions.scalars import nan_to_null
from tidegrid.operators.positions import numbered_lines


def _tokens(df: DataFrame) -> DataFrame:
    return df.withColumn("t", F.split(F.trim(F.regexp_replace("value", r"\s+", " ")), " "))


def _whole(token: Column) -> Column:
    """An id token; written as a float by some tools."""
    return token.try_cast("double").try_cast("long")


def _node_columns(t: str = "t") -> list[Column]:
    tok = lambda i: F.element_at(t, i)
    return [
        _whole(tok(1)).alias("node_id"), tok(2).try_cast("double").alias("long"),
        tok(3).try_cast("double").alias("lat"), nan_to_null(tok(4).try_cast("double")).alias("wse"),
    ]


def read_mesh_text(spark: SparkSession, path: str) -> tuple[DataFrame, DataFrame, DataFrame]:
    """Loose mesh text, told apart by token count: nodes, elements, extra.

    The first line is a header whatever it holds. Four tokens make a node, five a triangle,
    more an extra line; other lines are ignored. A malformed number becomes NULL (a failing
    cast could run ahead of the line test and trip over the header), which a NULL report
    brings to light.
    """
    rows = _tokens(numbered_lines(spark, path).where("line_no > 0")).withColumn("n", F.size("t"))
    nodes = rows.where("n = 4").select(*_node_columns())
    ids = ["pg_id", "num_nodes", "node_id_1", "node_id_2", "node_id_3"]
    elements = rows.where("n = 5").select(
        *[F.element_at("t", i).try_cast("long").alias(name) for i, name in enumerate(ids, start=1)]
    )
    return nodes, elements, rows.where("n > 5").select("line_no", F.col("t").alias("tokens"))


def read_mesh_strict(spark: SparkSession, path: str) -> tuple[DataFrame, DataFrame]:
    """Mesh text with counts: nodes, and raw elements of any arity.

    Line 1 is a title and line 2 holds the element and node counts; the counts decide which
    lines are nodes and which are elements. Elements: index, element_id, raw (vertex count
    followed by the vertex ids).
    """
    rows = _tokens(numbered_lines(spark, path))
    counts = rows.where("line_no = 1")
    n_elements = counts.select(F.element_at("t", 1).cast("long")).scalar()
    n_nodes = counts.select(F.element_at("t", 2).cast("long")).scalar()
    body = rows.where("line_no > 1").select(
        "t", (F.col("line_no") - 2).alias("i"), n_nodes.alias("np"), n_elements.alias("ne")
    )
    nodes = body.where("i < np").select(*_node_columns())
    elements = body.where("i >= np AND i < np + ne").select(
        (F.col("i") - F.col("np")).alias("index"),
        F.element_at("t", 1).try_cast("long").alias("element_id"),
        F.transform(F.slice("t", 2, F.size("t")), lambda v: v.try_cast("long")).alias("raw"),
    )
    return nodes, elements


def read_2dm(spark: SparkSession, path: str) -> tuple[DataFrame, DataFrame]:
    """2DM mesh text: ``ND id x y z`` and ``E3T id n1 n2 n3``; other records are ignored."""
    rows = _tokens(spark.read.text(path))
    tok = lambda i: F.element_at("t", i)
    kind = F.get("t", F.lit(0))
    nodes = rows.where(kind == "ND").select(
        tok(2).cast("long").alias("node_id"),
        *[tok(i).cast("double").alias(name) for i, name in enumerate("xyz", start=3)],
    )
    elements = rows.where(kind == "E3T").select(
        *[tok(i).cast("long").alias(name)
          for i, name in enumerate(["element_id", "node1", "node2", "node3"], start=2)],
    )
    return nodes, elements


def read_crosswalk(spark: SparkSession, path: str) -> DataFrame:
    """Crosswalk file, one mesh id per line: node_id_nc (1-based position), node_id_gr3."""
    lines = numbered_lines(spark, path, skip_blank=True)
    return lines.select(
        (F.col("line_no") + 1).alias("node_id_nc"), F.trim("value").cast("long").alias("node_id_gr3")
    )
