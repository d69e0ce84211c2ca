"""Jobs that turn a forecast snapshot into depth rasters."""

from __future__ import annotations

import os
import uuid

from pyspark.sql import DataFrame, SparkSession

from tidegrid.functions.grid import GridMeta
from tidegrid.operators import nodes as nd
from tidegrid.operators import zonal as zo
from tidegrid.operators.weights import triangle_barycentric
from tidegrid.plans.config import JobConfig
from tidegrid.plans.domain import build_mask, domain_nodes, preprocess
from tidegrid.session import colocated_joins
from tidegrid.sinks.rasters import VARIABLES, tiles_in_memory, write_chunk_store, write_overviews, write_tiles
from tidegrid.sinks.store import TableStore, materialize_result
from tidegrid.sources.mesh_text import read_mesh_text
from tidegrid.sources.tables import load_dem_metadata, load_result, load_table, normalize_node_wse


#: Largest mean bucket, in stored bytes, whose triangles a task may hash.
BUCKET_BYTES = 64 << 20


def forecast_nodes(spark: SparkSession, cfg: JobConfig, store: TableStore) -> DataFrame:
    """Node water levels of one run, inside the domain.

    A mesh text already carries mesh ids; a snapshot is renumbered through the crosswalk.
    """
    if cfg.snapshot_path:
        snapshot = normalize_node_wse(load_table(spark, cfg.snapshot_path))
        nodes = nd.crosswalk_nodes(snapshot, store.read("node_cross_walk"))
    else:
        nodes, _, _ = read_mesh_text(spark, cfg.mesh_path)
    return domain_nodes(nodes, store, cfg.elevation_threshold)


def compute_depth(store: TableStore, triangles: DataFrame, cfg: JobConfig) -> DataFrame:
    """Depth per cell of one run from stored domain tables.

    The older path fixes the threshold at zero here and applies it to the raster instead.
    """
    return zo.depth_by_tile(
        store.read("masked_coverage_fraction"), store.read("triangle_tiles"), triangles,
        cfg.depth_threshold if cfg.low_memory else 0.0, cfg.renormalize,
        bounded_buckets=store.bytes_per_bucket("masked_coverage_fraction") <= BUCKET_BYTES,
        any_hot=not store.read("hot_tiles").isEmpty(),
    )


def base_name(source: str) -> str:
    """File name of a source without folder and extension (the string form of ``run_name``)."""
    return os.path.splitext(os.path.basename(source.rstrip("/")))[0]


def rasterize(
    df: DataFrame, meta: GridMeta, cfg: JobConfig, source: str
) -> dict[str, DataFrame] | None:
    """Tiles with overviews (COG switch), chunk store (ZARR) or cached tiles (IN_MEMORY) of a stored result."""
    chosen = cfg.format()
    flags = {"wse": cfg.generate_wse, "depth": cfg.generate_depth}
    wanted = [name for name, on in flags.items() if on]
    if chosen == "IN_MEMORY":
        return tiles_in_memory(df, meta, cfg.generate_wse, cfg.generate_depth)
    name = base_name(source)
    for variable in wanted:
        column = VARIABLES[variable]
        if chosen == "ZARR":
            target = cfg.output_path if cfg.output_path.endswith(".zarr") else f"{cfg.output_path}/{cfg.chunk_store}"
            write_chunk_store(df, meta, column, target, f"{name}_{variable}", unique=True)
        else:
            write_tiles(df, meta, column, f"{cfg.output_path}/{name}_{variable}", unique=True)
            write_overviews(df, meta, column, f"{cfg.output_path}/{name}_{variable}_overviews", cfg.overview_levels)
    return None


def rasterize_legacy(df: DataFrame, meta: GridMeta, cfg: JobConfig, source: str) -> None:
    """Older layout: 1000 x 1000 tiles, NaN nodata, threshold on the depth raster only."""
    name = base_name(source)
    if cfg.generate_depth:
        write_tiles(df, meta, "depth", f"{cfg.output_path}/{name}_depth", 1000, float("nan"),
                    cfg.depth_threshold, unique=True)
    if cfg.generate_wse:
        write_tiles(df, meta, "wse_cell_weighted_average", f"{cfg.output_path}/{name}_wse", 1000,
                    float("nan"), unique=True)


def interpolate_and_rasterize(
    spark: SparkSession, cfg: JobConfig, source: str, triangles: DataFrame | None = None
) -> tuple[int, dict[str, DataFrame] | None]:
    """Depth from triangle levels (default: the stored ``triangle_barycentric`` table), materialised and rasterised.

    Returns the number of result cells and, for IN_MEMORY, the cached tiles.
    """
    cfg.format()
    if not cfg.generate_wse and not cfg.generate_depth:
        return 0, None
    store = TableStore(spark, cfg.store)
    if triangles is None:
        triangles = store.read("triangle_barycentric")
    cells = compute_depth(store, triangles, cfg)
    result = zo.select_outputs(cells, cfg.generate_wse, cfg.generate_depth)
    path = f"{cfg.store}/result/{base_name(source)}"
    with colocated_joins(spark):
        count = materialize_result(result, path)
    meta = load_dem_metadata(store.read("dem_metadata"))
    return count, rasterize(load_result(spark, path), meta, cfg, source)


def execute(spark: SparkSession, cfg: JobConfig) -> tuple[int, dict[str, DataFrame] | None]:
    """One forecast run: nodes -> triangles -> cells -> depth -> rasters."""
    cfg.format()
    store = TableStore(spark, cfg.store)
    source = cfg.snapshot_path or cfg.mesh_path
    nodes = forecast_nodes(spark, cfg, store)
    if cfg.low_memory:
        # A table per run: runs side by side never read each other's levels.
        levels = triangle_barycentric(store.read("triangle_weights"), nodes)
        run = f"triangle_barycentric/run={base_name(source)}-{uuid.uuid4().hex}"
        return interpolate_and_rasterize(spark, cfg, source, store.write(levels, run))
    cells = compute_depth(store, triangle_barycentric(store.read("triangle_weights"), nodes), cfg)
    path = f"{cfg.store}/result/{base_name(source)}"
    with colocated_joins(spark):
        count = materialize_result(cells, path)
    meta = load_dem_metadata(store.read("dem_metadata"))
    rasterize_legacy(load_result(spark, path), meta, cfg, source)
    return count, None


def run_job(
    spark: SparkSession, cfg: JobConfig, dem: DataFrame | None = None, meta: GridMeta | None = None
) -> tuple[int, dict[str, DataFrame] | None]:
    """The steps a configuration switches on, in order: mask, preprocess, execute."""
    if (cfg.generate_mask or cfg.preprocess) and meta is None:
        raise ValueError("mask and preprocess steps need the grid metadata")
    if cfg.generate_mask:
        build_mask(spark, cfg, meta)
    if cfg.preprocess:
        if dem is None:
            raise ValueError("preprocess needs the terrain cells")
        preprocess(spark, cfg, dem, meta)
    if cfg.execute:
        return execute(spark, cfg)
    return 0, None
