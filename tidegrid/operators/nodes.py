"""Node preparation: crosswalk, elevation, domain membership."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidegrid.functions.geometry import point, to_crs, transform_xy
from tidegrid.functions.grid import GridMeta, cell_at, cell_center_x, cell_center_y

TRIANGLE_NODES = ["node_id_1", "node_id_2", "node_id_3"]


def _spread_missing(cell: Column, by: str) -> Column:
    """Points outside the grid get negative ids, which match no cell.

    Left as NULL they would all hash to one partition of an outer or anti join.
    """
    return F.coalesce(cell, F.lit(-1).cast("long") - F.abs(F.hash(by)).cast("long"))


def with_vertices(triangles: DataFrame, nodes: DataFrame, values: list[str], how: str) -> DataFrame:
    """The triangles with ``node{k}_{value}`` columns looked up for k = 1, 2, 3."""
    out = triangles
    for k, column in enumerate(TRIANGLE_NODES, start=1):
        vertex = nodes.select(
            F.col("node_id").alias(column), *[F.col(v).alias(f"node{k}_{v}") for v in values]
        )
        out = out.join(vertex, column, how)
    return out


def crosswalk_nodes(nodes: DataFrame, xwalk: DataFrame) -> DataFrame:
    """Forecast nodes renumbered to mesh ids; an unmatched node keeps a NULL ``node_id``."""
    renamed = nodes.withColumnRenamed("node_id", "original_id")
    joined = renamed.join(xwalk, renamed["original_id"] == xwalk["node_id_nc"], "left")
    return joined.select("original_id", F.col("node_id_gr3").alias("node_id"), "long", "lat", "wse")


def mask_nodes(nodes: DataFrame, elements: DataFrame) -> DataFrame:
    """Nodes used by any of the elements."""
    used = elements.select(F.explode(F.array(*TRIANGLE_NODES)).alias("node_id")).distinct()
    return nodes.join(used, "node_id", "left_semi").select(*nodes.columns)


def filter_nodes(nodes: DataFrame, valid: DataFrame) -> DataFrame:
    """Nodes listed in a table of valid node ids."""
    return nodes.join(valid.select("node_id"), "node_id", "left_semi").select(*nodes.columns)


def add_elevation(nodes: DataFrame, elevations: DataFrame, threshold: float | None = None) -> DataFrame:
    """Nodes with a terrain elevation, optionally at or above a threshold.

    The non-NULL test turns the lookup into an inner join, and the threshold is applied to
    the elevation table before it is shuffled.
    """
    elev = elevations.select("node_id", "elevation").where("elevation IS NOT NULL")
    if threshold is not None:
        elev = elev.where(F.col("elevation") >= F.lit(float(threshold)))
    return nodes.join(elev, "node_id").select("node_id", "long", "lat", "wse", "elevation")


def extract_elevation(
    nodes: DataFrame, dem: DataFrame, meta: GridMeta, crs: str = "EPSG:4326"
) -> DataFrame:
    """Elevation of the pixel under each node; NULL outside the raster or on nodata."""
    x, y = transform_xy(F.col("long"), F.col("lat"), crs, meta.crs)
    located = nodes.select("node_id", "long", "lat", _spread_missing(cell_at(x, y, meta), "node_id").alias("cell"))
    pixels = dem.select("cell", "elevation")
    return located.join(pixels, "cell", "left").select("node_id", "long", "lat", "elevation")


def valid_cells(dem: DataFrame) -> DataFrame:
    """Cells of the raster that hold data."""
    return dem.where("elevation IS NOT NULL AND NOT isnan(elevation)").select("cell")


def valid_bitmaps(dem: DataFrame) -> DataFrame:
    """Index of the valid cells: ``block`` and ``bits``, one bit per cell of a block of 32,768.

    Bits are set before the shuffle, so a raster in order moves 4 KB for each 32,768 pixels.
    """
    valid = valid_cells(dem)
    return valid.groupBy(F.bitmap_bucket_number("cell").alias("block")).agg(
        F.bitmap_construct_agg(F.bitmap_bit_position("cell")).alias("bits"))


def _bit_is_set(bits: Column, at: Column) -> Column:
    byte = F.substring(bits, (F.call_function("div", at, F.lit(8)) + 1).cast("int"), F.lit(1))
    return F.getbit(F.conv(F.hex(byte), 16, 10).cast("int"), (at % 8).cast("int")) == 1


def points_outside_dem(
    nodes: DataFrame, dem: DataFrame, meta: GridMeta, crs: str = "EPSG:4326"
) -> DataFrame:
    """Nodes whose point does not fall on a valid raster pixel.

    Points meet the bitmap of their block of cells, so that blocks are shuffled and not pixels.
    """
    moved = to_crs(nodes, crs, meta.crs)
    located = moved.withColumn("_cell", _spread_missing(cell_at("long", "lat", meta), "node_id"))
    located = located.withColumn("_block", F.bitmap_bucket_number("_cell"))
    blocks = valid_bitmaps(dem)
    there = (located["_block"] == blocks["block"]) & (located["_cell"] > 0) & _bit_is_set(
        blocks["bits"], F.bitmap_bit_position(located["_cell"]))
    return located.join(blocks, there, "left_anti").select(*nodes.columns)


def node_points(nodes: DataFrame) -> DataFrame:
    """Node table with a point geometry: node_id, long, lat, wse, geometry."""
    return nodes.select(
        F.col("node_id").cast("long").alias("node_id"), "long", "lat", "wse",
        point("long", "lat").alias("geometry"),
    )


def resample_nearest(dem: DataFrame, src: GridMeta, dst: GridMeta) -> DataFrame:
    """The raster pulled onto another grid by nearest pixel; unchanged when the CRS matches.

    Every target cell looks up the source cell under its centre, so holes cannot appear.
    """
    if src.crs == dst.crs:
        return dem.select("cell", "elevation")
    spark = dem.sparkSession
    target = spark.range(1, dst.cells + 1).withColumnRenamed("id", "cell")
    row = F.call_function("div", F.col("cell") - 1, F.lit(dst.width).cast("long"))
    col = (F.col("cell") - 1) % F.lit(dst.width).cast("long")
    x, y = transform_xy(cell_center_x(col, dst), cell_center_y(row, dst), dst.crs, src.crs)
    pulled = target.select("cell", _spread_missing(cell_at(x, y, src), "cell").alias("src_cell"))
    pixels = dem.select(F.col("cell").alias("src_cell"), "elevation")
    return pulled.join(pixels, "src_cell", "left").select("cell", "elevation")
