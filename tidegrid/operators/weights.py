"""Barycentric weights from terrain slope, and values per triangle.

The arithmetic is staged: each select names intermediate columns that the next one uses
several times. The optimizer keeps such projections apart, so every stage becomes a small
method that the JVM still compiles (it leaves methods over 8,000 bytes interpreted).
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidegrid.operators.nodes import TRIANGLE_NODES, with_vertices

# Fixed value: the weight of each vertex of a flat triangle (eleven digits, not 1/3).
FLAT_WEIGHT = 0.33333333333


def triangle_vertices(weights: DataFrame, nodes: DataFrame) -> DataFrame:
    """Weighted triangles with the coordinates and value of all three vertices."""
    values = ["long", "lat", "wse"]
    keep = ["pg_id", *TRIANGLE_NODES, *(f"node{k}_weight" for k in (1, 2, 3))]
    joined = with_vertices(weights.select(*keep), nodes, values, "inner")
    return joined.select(*keep, *(f"node{k}_{v}" for k in (1, 2, 3) for v in values))


def triangle_barycentric(weights: DataFrame, nodes: DataFrame) -> DataFrame:
    """Weighted centroid and water level per triangle.

    Every triangle is kept. A missing vertex leaves NULL in one term and so in the whole
    sum, which is what joining the complete triangles back to all of them would give.
    """
    weighted = lambda v: (
        F.col("node1_weight") * F.col(f"node1_{v}")
        + F.col("node2_weight") * F.col(f"node2_{v}")
        + F.col("node3_weight") * F.col(f"node3_{v}")
    )
    joined = with_vertices(weights, nodes, ["long", "lat", "wse"], "left")
    return joined.select(
        *weights.columns,
        weighted("long").alias("centroid_long"),
        weighted("lat").alias("centroid_lat"),
        weighted("wse").alias("wse_weighted_average"),
    )


def edge_slope(dx: Column, dy: Column, dz: Column) -> Column:
    """Absolute slope along an edge; a zero run counts as slope 0, a NULL rise stays NULL."""
    run = F.sqrt(dx * dx + dy * dy)
    return F.when(run != 0, F.abs(dz / F.nullif(run, F.lit(0.0)))).otherwise(F.lit(0.0) * dz)


def vertex_slope(at: tuple[Column, ...], p: tuple[Column, ...], q: tuple[Column, ...]) -> Column:
    """Mean absolute slope at a vertex toward two others."""
    toward = lambda other: edge_slope(*(o - v for o, v in zip(other, at)))
    return (toward(p) + toward(q)) / F.lit(2.0)


def _length(x: Column, y: Column, z: Column) -> Column:
    return F.sqrt(x * x + y * y + z * z)


def _cross(u: tuple[Column, ...], v: tuple[Column, ...]) -> tuple[Column, Column, Column]:
    return (
        u[1] * v[2] - u[2] * v[1],
        u[2] * v[0] - u[0] * v[2],
        u[0] * v[1] - u[1] * v[0],
    )


def barycentric_weights(elements: DataFrame, nodes: DataFrame) -> DataFrame:
    """Vertex weights of each triangle from the slope-weighted centroid.

    ``nodes`` needs long, lat and elevation. Weights are NULL when a vertex is missing,
    when its elevation is NULL or NaN, and for zero-area triangles.
    """
    keep = elements.columns
    pts = nodes.select("node_id", F.col("long").alias("x"), F.col("lat").alias("y"),
                       F.when(~F.isnan("elevation"), F.col("elevation")).alias("z"))
    t = with_vertices(elements, pts, ["x", "y", "z"], "left")
    corners = [f"node{k}_{v}" for k in (1, 2, 3) for v in "xyz"]
    vec = lambda p: tuple(F.col(f"{p}{v}") for v in "xyz")
    edge = lambda i, j, name: [
        (F.col(f"node{j}_{v}") - F.col(f"node{i}_{v}")).alias(f"{name}{v}") for v in "xyz"
    ]
    t = t.select(*keep, *corners, *edge(1, 2, "ab"), *edge(1, 3, "ac"), *edge(2, 3, "bc"))
    # An edge has one absolute slope, whichever end it is seen from.
    t = t.select(
        *keep, *corners, *[edge_slope(*vec(e)).alias(f"g_{e}") for e in ("ab", "ac", "bc")],
        *[f"{e}{v}" for e in ("ab", "ac") for v in "xyz"],
    )
    half_sum = lambda p, q: (F.col(f"g_{p}") + F.col(f"g_{q}")) / F.lit(2.0)
    t = t.select(
        *keep, *corners, half_sum("ab", "ac").alias("s1"), half_sum("ab", "bc").alias("s2"),
        half_sum("ac", "bc").alias("s3"), _length(*_cross(vec("ab"), vec("ac"))).alias("normal"),
    )
    t = t.withColumn("s", F.col("s1") + F.col("s2") + F.col("s3"))
    share = lambda k: F.when(F.col("s") == 0, F.lit(FLAT_WEIGHT)).otherwise(
        F.col(f"s{k}") / F.nullif(F.col("s"), F.lit(0.0))
    )
    t = t.select(*keep, *corners, "normal", *[share(k).alias(f"w{k}") for k in (1, 2, 3)])
    t = t.select(*keep, *corners, "normal", *[
        (F.col("w1") * F.col(f"node1_{v}") + F.col("w2") * F.col(f"node2_{v}")
         + F.col("w3") * F.col(f"node3_{v}")).alias(f"c{v}") for v in "xyz"
    ])
    t = t.select(*keep, "normal", *[
        (F.col(f"c{v}") - F.col(f"node{k}_{v}")).alias(f"d{k}{v}") for k in (1, 2, 3) for v in "xyz"
    ])
    t = t.select(
        *keep, "normal",
        _length(*_cross(vec("d2"), vec("d3"))).alias("n1"),
        _length(*_cross(vec("d3"), vec("d1"))).alias("n2"),
        _length(*_cross(vec("d1"), vec("d2"))).alias("n3"),
    )
    t = t.select(*keep, *[
        (F.col(f"n{k}") / F.nullif(F.col("normal"), F.lit(0.0))).alias(f"area{k}") for k in (1, 2, 3)
    ])
    t = t.withColumn("area", F.col("area1") + F.col("area2") + F.col("area3"))
    return t.select(*keep, *[
        (F.col(f"area{k}") / F.nullif(F.col("area"), F.lit(0.0))).alias(f"node{k}_weight")
        for k in (1, 2, 3)
    ])


def equal_weights(elements: DataFrame) -> DataFrame:
    """The elements with one third per vertex."""
    return elements.withColumns({f"node{k}_weight": F.lit(1.0) / F.lit(3.0) for k in (1, 2, 3)})
