"""Element tables: domain filters, validation, polygons."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidegrid.functions.geometry import point
from tidegrid.operators.nodes import TRIANGLE_NODES, with_vertices


def mask_triangles(triangles: DataFrame, cov: DataFrame) -> DataFrame:
    """Triangles that own at least one coverage row.

    The ids are made distinct before the join: map-side aggregation then collapses the many
    coverage rows of a triangle, and the join reuses the aggregate's partitioning.
    """
    owners = cov.select("pg_id").distinct()
    return triangles.join(owners, "pg_id", "left_semi").select(*triangles.columns)


def mask_elements(elements: DataFrame, cov: DataFrame) -> DataFrame:
    """Elements that own at least one coverage row."""
    return mask_triangles(elements, cov)


def filter_valid_elements(elements: DataFrame, nodes: DataFrame) -> DataFrame:
    """Elements whose three vertices are all present in the node table."""
    kept = elements
    for column in TRIANGLE_NODES:
        present = nodes.select(F.col("node_id").alias(column))
        kept = kept.join(present, column, "left_semi")
    return kept.select(*elements.columns)


def index_triangles(triangles: DataFrame) -> DataFrame:
    """Feature ids turned into 1-based triangle ids (``FID`` -> ``pg_id`` + 1)."""
    renamed = triangles.withColumnRenamed("FID", "pg_id")
    return renamed.withColumn("pg_id", F.col("pg_id") + 1)


def validate_elements(elements: DataFrame, nodes: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Split raw elements into usable ones and a failure table.

    ``elements``: index, element_id, raw (count followed by node ids). Good rows come back
    as pg_id, num_nodes, node_ids; bad rows as index, element_id, error, raw. An id without
    a node row is an error, also when it lies inside the id range.
    """
    declared = F.coalesce(F.try_element_at("raw", F.lit(1)), F.lit(0)).cast("int")
    ids = elements.withColumn("node_ids", F.slice("raw", F.lit(2), F.greatest(declared, F.lit(0))))
    max_id = nodes.agg(F.max("node_id").alias("max_id"))
    # Distinct ids first: a vertex shared by very many elements is looked up once.
    # The outer form keeps the optimizer from inlining the slice into a size filter; the NULL
    # ids of empty lists match nothing below.
    uses = ids.select("index", F.posexplode_outer("node_ids").alias("pos", "id"))
    known = nodes.where("node_id > 0").select(F.col("node_id").alias("id"))
    unknown = uses.select("id").distinct().join(known, "id", "left_anti")
    unknown = unknown.withColumn("max_id", max_id.scalar())
    outside = (F.col("id") <= 0) | (F.col("id") > F.col("max_id"))
    missing = uses.join(unknown, "id").groupBy("index").agg(
        F.min_by("id", F.when(outside, F.col("pos"))).alias("outside_id"),
        F.min_by("id", "pos").alias("missing_id"),
        F.max("max_id").alias("max_id"),
    )
    checked = ids.join(missing, "index", "left")
    error = (
        F.when(F.size("raw") == 0, F.lit("no vertex list"))
        .when(F.size("node_ids") < 3,
              F.concat(F.lit("needs 3 vertices or more, has "), F.size("node_ids").cast("string")))
        .when(F.col("outside_id").isNotNull(),
              F.concat(F.lit("vertex id outside 1.."), F.col("max_id").cast("string"), F.lit(": "),
                       F.col("outside_id").cast("string")))
        .when(F.col("missing_id").isNotNull(),
              F.concat(F.lit("vertex id without a node: "), F.col("missing_id").cast("string")))
    )
    checked = checked.withColumn("error", error)
    good = checked.where("error IS NULL").select(
        F.col("element_id").alias("pg_id"), F.element_at("raw", 1).cast("int").alias("num_nodes"), "node_ids"
    )
    bad = checked.where("error IS NOT NULL").select("index", "element_id", "error", "raw")
    return good, bad


def top_failures(bad: DataFrame, n: int = 15) -> DataFrame:
    """The first failures by input position, for a log."""
    return bad.orderBy("index").limit(n)


def element_polygons(elements: DataFrame, nodes: DataFrame, flat_columns: int = 4) -> DataFrame:
    """Element polygons from ordered vertices, with the mean vertex value.

    ``elements``: pg_id, num_nodes, node_ids (3 or more). Result: pg_id, num_nodes, node_ids
    (all of them), node_id_1 .. node_id_{flat_columns} besides, ring, mean_wse. The grouped
    list is one element's vertices, so its size is the element's arity.
    """
    uses = elements.select("pg_id", "num_nodes", F.posexplode("node_ids").alias("pos", "node_id"))
    placed = uses.join(nodes.select("node_id", "long", "lat", "wse"), "node_id")
    grouped = placed.groupBy("pg_id").agg(
        F.max("num_nodes").alias("num_nodes"),
        F.array_sort(F.collect_list(
            F.struct("pos", "node_id", F.col("long").alias("x"), F.col("lat").alias("y"))
        )).alias("v"),
        F.avg("wse").alias("mean_wse"),
    )
    ids = [F.get(F.col("v.node_id"), i).alias(f"node_id_{i + 1}") for i in range(flat_columns)]
    ring = F.transform("v", lambda p: F.struct(p["x"].alias("x"), p["y"].alias("y")))
    return grouped.select("pg_id", "num_nodes", F.col("v.node_id").alias("node_ids"), *ids, ring.alias("ring"), "mean_wse")


def triangle_rings(elements: DataFrame, nodes: DataFrame) -> DataFrame:
    """Rings of triangles given as node_id_1..3: pg_id, ring. Incomplete triangles drop out."""
    placed = with_vertices(elements.select("pg_id", *TRIANGLE_NODES), nodes, ["long", "lat"], "inner")
    ring = F.array(*[point(f"node{k}_long", f"node{k}_lat") for k in (1, 2, 3)])
    return placed.select("pg_id", ring.alias("ring"))
