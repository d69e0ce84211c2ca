"""Exact coverage fraction of every grid cell by every polygon.

The overlay works on polygon *edges*, never on polygon x cell candidates. An edge is cut
into the grid rows it crosses and, inside a row, into the columns it crosses. Each piece
carries two numbers: ``cover``, the signed height it spans, and ``area``, the signed part of
the cell lying right of it. For a cell, coverage is its own area plus the cover of every
piece further left on the same row, so one running sum along the row finishes the job and
interior cells are generated only at the end. Work grows with boundary pieces plus output
rows, whatever the size of a polygon.

One shuffle, on (polygon, row): a polygon holding a third of all cells is spread over all
the rows it touches, and a row's share is bounded by the grid width.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tidegrid.functions.geometry import explode_edges
from tidegrid.functions.grid import GridMeta, cell_id
from tidegrid.operators.skew import salted_join, spread

#: Rows at or below this coverage are rounding noise of cells that only touch the polygon.
MIN_COVERAGE = 1e-9


def _row_pieces(edges: DataFrame, key: str, meta: GridMeta) -> DataFrame:
    """Edges in cell units, cut at row borders: key, row, u0, u1 (left to right), cover."""
    u = lambda x: (F.col(x) - F.lit(meta.c)) / F.lit(meta.a)
    v = lambda y: (F.col(y) - F.lit(meta.f)) / F.lit(meta.e)
    cut = edges.select(
        key, u("x1").alias("u1"), v("y1").alias("v1"), u("x2").alias("u2"), v("y2").alias("v2")
    )
    # An edge along a row spans no height, and one right of the grid reaches no cell.
    cut = cut.where((F.col("v1") != F.col("v2")) & (F.least("u1", "u2") < meta.width))
    cut = cut.select(
        "*",
        F.least("v1", "v2").alias("v_lo"),
        F.greatest("v1", "v2").alias("v_hi"),
        ((F.col("u2") - F.col("u1")) / (F.col("v2") - F.col("v1"))).alias("du_dv"),
        F.signum(F.col("v2") - F.col("v1")).alias("sign"),
    )
    cut = cut.select(
        "*",
        F.greatest(F.floor("v_lo"), F.lit(0)).alias("row_lo"),
        F.least(F.ceil("v_hi") - 1, F.lit(meta.height - 1)).alias("row_hi"),
    ).where("row_lo <= row_hi")
    cut = cut.withColumn("row", F.explode(F.sequence("row_lo", "row_hi")))
    cut = cut.select(
        "*",
        F.greatest("v_lo", F.col("row").cast("double")).alias("va"),
        F.least("v_hi", (F.col("row") + 1).cast("double")).alias("vb"),
    ).where("vb > va")
    # Interpolated ends may leave the edge's own extent by an ulp; clamp them to it.
    end = lambda w: F.greatest(
        F.least(F.col("u1") + (F.col(w) - F.col("v1")) * F.col("du_dv"), F.greatest("u1", "u2")),
        F.least("u1", "u2"),
    )
    cut = cut.select(
        key, "row", end("va").alias("ua"), end("vb").alias("ub"),
        (F.col("sign") * (F.col("vb") - F.col("va"))).alias("cover"),
    )
    return cut.select(
        key, "row", F.least("ua", "ub").alias("u0"), F.greatest("ua", "ub").alias("u1"), "cover"
    )


def _cell_pieces(pieces: DataFrame, key: str, width: int) -> DataFrame:
    """Row pieces cut at column borders: key, row, col, area, cover.

    Everything left of the grid lands in column -1, whose cover still counts to its right.
    Everything right of it lands in column ``width``, to be dropped at the end: a filter
    here would be pushed below the shuffle with the whole formula inlined.
    """
    column = lambda u: F.least(F.greatest(F.floor(u), F.lit(-1)), F.lit(width))
    cut = pieces.select("*", column("u0").alias("col_lo"), column("u1").alias("col_hi"))
    cut = cut.withColumn("col", F.explode(F.sequence("col_lo", "col_hi")))
    cut = cut.select(
        key, "row", "col", "cover", "u0", "u1",
        F.when(F.col("col") < 0, F.col("u0"))
        .otherwise(F.greatest("u0", F.col("col").cast("double"))).alias("ca"),
        F.least("u1", (F.col("col") + 1).cast("double")).alias("cb"),
    )
    # A piece inside one column keeps its whole cover; dividing a tiny span would add noise.
    share = F.when(
        (F.col("ca") == F.col("u0")) & (F.col("cb") == F.col("u1")), F.lit(1.0)
    ).otherwise((F.col("cb") - F.col("ca")) / (F.col("u1") - F.col("u0")))
    cut = cut.select(
        key, "row", "col", (F.col("cover") * share).alias("cover"),
        (F.col("col") + 1 - (F.col("ca") + F.col("cb")) / 2).alias("right_part"),
    )
    return cut.select(key, "row", "col", "cover", (F.col("cover") * F.col("right_part")).alias("area"))


def coverage_fraction(
    rings: DataFrame, meta: GridMeta, key: str = "pg_id", min_coverage: float = MIN_COVERAGE
) -> DataFrame:
    """Share of every cell covered by every polygon: ``key``, cell, coverage_fraction.

    ``rings`` holds one simple polygon per row (``key``, ring), in the grid's coordinate
    system and in either orientation. Output is unique on (key, cell).
    """
    pieces = _row_pieces(explode_edges(rings, [key]), key, meta)
    # The overlay's only shuffle: the sums and the window below both run on this layout.
    pieces = spread(pieces, key, "row")
    steps = _cell_pieces(pieces, key, meta.width).groupBy(key, "row", "col").agg(
        F.sum("area").alias("area"), F.sum("cover").alias("cover")
    )
    along = Window.partitionBy(key, "row").orderBy("col")
    steps = steps.select(
        key, "row", "col", "area", "cover",
        F.coalesce(
            F.sum("cover").over(along.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0.0)
        ).alias("carried"),
        F.coalesce(F.lead("col").over(along), F.lit(meta.width).cast("long")).alias("next_col"),
    )
    steps = steps.select(
        key, "row", "col", "next_col",
        F.abs(F.col("area") + F.col("carried")).alias("edge_coverage"),
        F.abs(F.col("carried") + F.col("cover")).alias("fill_coverage"),
    )
    fills = (F.col("fill_coverage") > min_coverage) & (F.col("next_col") > F.col("col"))
    last = F.when(fills, F.col("next_col") - 1).otherwise(F.col("col"))
    cells = steps.select(
        key, "row", "edge_coverage", "fill_coverage", F.col("col").alias("edge_col"),
        F.explode(F.sequence(F.col("col"), last)).alias("col"),
    )
    cells = cells.select(
        key, "row", "col",
        F.when(F.col("col") == F.col("edge_col"), F.col("edge_coverage"))
        .otherwise(F.col("fill_coverage")).alias("coverage_fraction"),
    )
    on_grid = (F.col("col") >= 0) & (F.col("col") < meta.width)
    return cells.where(on_grid & (F.col("coverage_fraction") > min_coverage)).select(
        key, cell_id("row", "col", meta.width).alias("cell"), "coverage_fraction"
    )


def attach_cell_attributes(overlay: DataFrame, cells: DataFrame, hot: DataFrame | None = None) -> DataFrame:
    """Overlay rows with the elevation and mask of their cell.

    ``mask`` is false, never NULL, for an unmasked cell, because the coverage filter keeps
    strictly false rows only. ``hot`` lists cells under exceptionally many polygons.
    """
    attributes = cells.select(
        "cell", "elevation",
        (F.coalesce("mask", F.lit(False)) if "mask" in cells.columns else F.lit(False)).alias("_mask"),
    )
    joined = salted_join(overlay, attributes, "cell", hot, spread_by="pg_id")
    return joined.select(
        *overlay.columns, "elevation", F.coalesce("_mask", F.lit(False)).alias("mask")
    )


def ring_extent(rings: DataFrame, ring: str = "ring") -> DataFrame:
    """One row with the extent of a polygon layer: min_x, min_y, max_x, max_y."""
    xs, ys = F.col(f"{ring}.x"), F.col(f"{ring}.y")
    return rings.agg(
        F.min(F.array_min(xs)).alias("min_x"), F.min(F.array_min(ys)).alias("min_y"),
        F.max(F.array_max(xs)).alias("max_x"), F.max(F.array_max(ys)).alias("max_y"),
    )


def tessellate(rings: DataFrame, n: int = 10, key: str = "pg_id") -> DataFrame:
    """Features per tile of an n x n tessellation of the layer's extent: ``key``, tile_id.

    A feature is listed once for every tile it shares area with, and tiles without any
    feature do not appear. Tiles are numbered from 1, row by row from the top left.
    """
    box = ring_extent(rings).first()
    if box is None or box["min_x"] is None:
        empty = rings.select(key, F.lit(None).cast("long").alias("tile_id"))
        return empty.where(F.lit(False))
    step_x, step_y = (box["max_x"] - box["min_x"]) / n, (box["max_y"] - box["min_y"]) / n
    tiles = GridMeta(n, n, (step_x, 0.0, box["min_x"], 0.0, -step_y, box["max_y"]))
    shared = coverage_fraction(rings, tiles, key, min_coverage=1e-12)
    return shared.select(key, F.col("cell").alias("tile_id"))
