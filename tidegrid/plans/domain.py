"""Jobs that prepare a domain once: mask, overlay, mesh conversion, preprocessing."""

from __future__ import annotations

import math

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from tidegrid.functions.geometry import add_point
from tidegrid.functions.grid import GridMeta
from tidegrid.operators import elements as el
from tidegrid.operators import masks as mk
from tidegrid.operators import nodes as nd
from tidegrid.operators.overlay import attach_cell_attributes, coverage_fraction
from tidegrid.operators.quality import null_report, observed_nan_points, warn_on_nulls
from tidegrid.operators.skew import HOT_ROWS, SALT, add_salt, hot_keys
from tidegrid.operators.weights import barycentric_weights
from tidegrid.operators.zonal import filter_masked, with_coverage_sum, with_tile
from tidegrid.plans.config import JobConfig
from tidegrid.sinks.store import TableStore, export_land_mask, export_mesh, export_node_ids
from tidegrid.sources.filesystem import validate_inputs
from tidegrid.sources.layers import register_layers
from tidegrid.sources.mesh_text import read_crosswalk, read_mesh_strict, read_mesh_text
from tidegrid.sources.tables import metadata_row, read_zonal

#: Coverage rows per bucket (some 25 MB of Parquet), and Spark's limit on buckets.
BUCKET_ROWS = 1_000_000
MIN_BUCKET_ROWS = 50_000
MAX_BUCKETS = 100_000


def build_mask(spark: SparkSession, cfg: JobConfig, meta: GridMeta) -> DataFrame:
    """Register the layers and store the general mask as runs (``mask_runs``)."""
    store = TableStore(spark, cfg.store)
    layers, lineage, _ = register_layers(spark, cfg.layers_path, suffix=cfg.layer_suffix)
    if layers is None:
        raise ValueError(f"no readable layer in {cfg.layers_path}")
    stored = store.write(layers, "mask_layers")
    store.upsert(lineage, "metadata", "table_name")
    pick = lambda name: stored.where(F.col("layer") == name)
    runs = mk.general_mask_runs(
        [pick(n) for n in cfg.exterior_layers],
        [pick(n) for n in cfg.interior_layers if n],
        meta, cfg.ring_deg,
    )
    return store.write(runs, "mask_runs")


def build_coverage(
    spark: SparkSession, cfg: JobConfig, rings: DataFrame, dem: DataFrame, meta: GridMeta
) -> DataFrame:
    """Overlay the elements on the grid and store the coverage table."""
    store = TableStore(spark, cfg.store)
    cells = dem
    if store.exists("mask_runs"):
        cells = mk.flag_cells(dem, store.read("mask_runs"), meta)
    # Stored first: counting the rows per cell would otherwise compute the overlay again.
    overlay = store.write(coverage_fraction(rings, meta), "overlay")
    # Stored as well: lazy, its count over the whole overlay would run on both sides of the join.
    hot_cells = store.write(hot_keys(overlay, "cell"), "hot_overlay_cells")
    return store.write(attach_cell_attributes(overlay, cells, hot_cells), "coverage_fraction")


def convert_mesh(
    spark: SparkSession, mesh_path: str, nodes_path: str, elements_path: str
) -> tuple[DataFrame, list[str], int]:
    """Mesh text to element polygons and node points in Parquet.

    Returns the failures, the paths written, and the number of nodes with a NaN coordinate,
    which is also reported.
    """
    nodes, raw = read_mesh_strict(spark, mesh_path)
    good, bad = el.validate_elements(raw, nodes)
    watched, seen = observed_nan_points(nodes, "mesh nodes")
    paths = export_mesh(nd.node_points(watched), el.element_polygons(good, nodes), nodes_path, elements_path)
    nan_points = seen.get["nan_points"] or 0
    if nan_points:
        print(f"{nan_points} nodes have a NaN coordinate")
    return bad, paths, nan_points


def build_crosswalk(land_mask: DataFrame, mask_path: str, ids_path: str, filter_value: int = 0) -> DataFrame:
    """Land mask and list of unmasked node ids; returns the crosswalk read back."""
    export_land_mask(land_mask, mask_path)
    export_node_ids(land_mask, ids_path, filter_value)
    return read_crosswalk(land_mask.sparkSession, ids_path)


def domain_nodes(nodes: DataFrame, store: TableStore, threshold: float | None) -> DataFrame:
    """Nodes inside the domain with their elevation (used by both job kinds)."""
    inside = nd.mask_nodes(nodes, store.read("masked_elements"))
    return nd.add_elevation(inside, store.read("nodes_elevation"), threshold)


def bucket_count(rows: int, parallelism: int) -> int:
    """Buckets for a table: by size, yet enough for every core once it is worth splitting."""
    by_size = math.ceil(rows / BUCKET_ROWS)
    by_cores = min(parallelism, math.ceil(rows / MIN_BUCKET_ROWS))
    return min(max(by_size, by_cores, 1), MAX_BUCKETS)


def store_coverage(
    store: TableStore,
    raw: DataFrame,
    meta: GridMeta,
    threshold: float | None = None,
    tile: int = 512,
    hot_rows: int = HOT_ROWS,
) -> DataFrame:
    """Store the filtered coverage in the layout every forecast run works on.

    Coverage is by far the largest table and static, so it is moved once: bucketed by the
    raster tile of its cell, tiles with exceptionally many rows salted into several buckets.
    ``triangle_tiles`` lists the places each triangle's value has to reach; a run shuffles
    those values and leaves the coverage where it is.

    A count per tile says how many buckets and salts there are. A cell lies in one tile, so
    its total coverage is summed inside the layout; only the cells of salted tiles, which
    lie in several buckets, are summed ahead of it. ``raw`` is read several times for that, so
    it should be a stored table.
    """
    kept = filter_masked(raw, threshold).select("pg_id", "cell", "coverage_fraction", "elevation", "mask")
    tiled = with_tile(kept, meta, tile)
    counts = store.write(tiled.groupBy("tile").agg(F.count(F.lit(1)).alias("n")), "tile_rows")
    salts = F.ceil(F.col("n") / F.lit(hot_rows)).cast("int").alias("salts")
    hot = store.write(counts.where(F.col("n") > hot_rows).select("tile", salts), "hot_tiles")
    rows = counts.agg(F.sum("n")).first()[0] or 0
    buckets = bucket_count(rows, store.spark.sparkContext.defaultParallelism)
    total = F.lit(None).cast("double").alias("coverage_sum")
    if hot.isEmpty():
        summed = tiled.select("*", total)
    else:
        several = tiled.join(hot.select("tile"), "tile", "left_semi").select(*tiled.columns)
        one = tiled.join(hot.select("tile"), "tile", "left_anti").select(*tiled.columns, total)
        hot_cells = store.write(hot_keys(several, "cell", hot_rows), "hot_cells")
        summed = one.unionByName(with_coverage_sum(several, hot_cells))
    salted = add_salt(summed, "tile", hot, "pg_id")
    placed = salted.repartition(buckets, "tile", SALT)
    here = F.sum("coverage_fraction").over(Window.partitionBy("tile", SALT, "cell"))
    laid_out = placed.withColumn("coverage_sum", F.coalesce("coverage_sum", here))
    stored = store.write_bucketed(laid_out, "masked_coverage_fraction", ["tile", SALT], buckets, ["cell"])
    store.write(stored.select("pg_id", "tile", SALT).distinct(), "triangle_tiles")
    return stored


def preprocess(spark: SparkSession, cfg: JobConfig, dem: DataFrame, meta: GridMeta) -> DataFrame:
    """Prepare a domain once and store its static tables; returns ``triangle_weights``."""
    validate_inputs(spark, cfg.mesh_path, cfg.coverage_path, cfg.crosswalk_path)
    store = TableStore(spark, cfg.store)
    store.write(read_crosswalk(spark, cfg.crosswalk_path), "node_cross_walk")
    coverage = store_coverage(store, read_zonal(spark, cfg.coverage_path), meta, cfg.elevation_threshold)
    if cfg.triangles_path:
        store.write(el.mask_triangles(spark.read.parquet(cfg.triangles_path), coverage), "triangles")
    nodes, elements, _ = read_mesh_text(spark, cfg.mesh_path)
    nodes = store.write(add_point(nodes), "mesh_nodes")
    elements = store.write(elements, "elements")
    store.write(el.mask_elements(elements, coverage), "masked_elements")
    store.write(nd.extract_elevation(nodes, dem, meta), "nodes_elevation")
    store.upsert(metadata_row(spark, meta), "dem_metadata", "dem_metadata")
    ready = domain_nodes(nodes, store, cfg.elevation_threshold)
    ready = store.write(ready, "nodes")
    valid = store.write(el.filter_valid_elements(store.read("masked_elements"), ready), "null_filtered_masked_elements")
    weights = store.write(barycentric_weights(valid, ready), "triangle_weights")
    store.record_crs("triangle_weights", "EPSG:4326")
    warn_on_nulls(null_report(weights))
    return weights
