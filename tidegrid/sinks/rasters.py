"""Raster outputs: tile tables, a chunk store, and cached tiles."""

from __future__ import annotations

from pyspark import StorageLevel
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidegrid.functions.grid import GridMeta
from tidegrid.operators.tiles import build_tiles, overviews
from tidegrid.sinks.chunks import consolidate_store, read_chunk_store, store_attributes, write_arrays  # noqa: F401

VARIABLES = {"wse": "wse_cell_weighted_average", "depth": "depth"}


def write_tiles(
    df: DataFrame,
    meta: GridMeta,
    col: str,
    path: str,
    tile: int = 512,
    nodata: float = -9999.0,
    depth_threshold: float | None = None,
    unique: bool = False,
) -> DataFrame:
    """Write the sparse tile table of one variable and return it as stored.

    Every tile is built whole by one task, so cells on a seam or arriving late need no
    merge. ``nodata=nan`` with ``tile=1000`` gives the older dense layout, tile by tile.
    """
    tiles = build_tiles(df, meta, col, tile, nodata, depth_threshold, unique)
    tiles.write.mode("overwrite").parquet(path)
    return df.sparkSession.read.parquet(path)


def write_overviews(df: DataFrame, meta: GridMeta, col: str, path: str, levels: int | None = None) -> DataFrame:
    """Write the overview pyramid of one variable, partitioned by level."""
    pyramid = overviews(df, meta, col, levels)
    pyramid.write.mode("overwrite").partitionBy("level").parquet(path)
    return df.sparkSession.read.schema(pyramid.schema).parquet(path)


def tiles_in_memory(
    df: DataFrame, meta: GridMeta, generate_wse: bool = False, generate_depth: bool = True
) -> dict[str, DataFrame]:
    """Tiles per variable, kept by the executors (spilling to disk), by name ``wse``/``depth``.

    They stay until ``release_tiles`` gives them back.
    """
    wanted = [n for n, on in (("wse", generate_wse), ("depth", generate_depth)) if on]
    return {
        name: build_tiles(df, meta, VARIABLES[name], unique=True).persist(StorageLevel.MEMORY_AND_DISK)
        for name in wanted
    }


def release_tiles(tiles: dict[str, DataFrame] | None) -> None:
    """Give back what ``tiles_in_memory`` keeps."""
    for frame in (tiles or {}).values():
        frame.unpersist()


def write_chunk_store(
    df: DataFrame,
    meta: GridMeta,
    col: str,
    store: str,
    array_name: str,
    chunk: int = 512,
    nodata: float = -9999.0,
    unique: bool = False,
    consolidate: bool = True,
    opener: str | None = None,
) -> int:
    """Write one variable as an array of a shared chunk store; returns chunks written.

    The array is the old one until all chunks of the new one are there (see ``sinks.chunks``).
    Edge chunks are padded to full size. No rows gives an array without chunks, which reads as
    nodata. Arrays written side by side leave ``consolidate`` to one call afterwards.
    """
    tiles = build_tiles(df, meta, col, chunk, nodata, unique=unique).withColumn("array", F.lit(array_name))
    written = write_arrays(tiles, meta, store, [array_name], chunk, nodata, opener)
    if consolidate:
        consolidate_store(df.sparkSession, store, opener)
    return written[array_name]


def write_run_arrays(
    cells: DataFrame, meta: GridMeta, variables: list[str], store: str, runs: list[str], run_col: str = "run_id",
    chunk: int = 512, nodata: float = -9999.0,
) -> dict[str, int]:
    """Arrays ``<run>_<variable>`` of any number of runs, in one job; returns chunks written per array.

    ``cells`` has one row per run and cell. A run without rows has arrays without chunks.
    """
    names = [F.struct(F.concat(F.col(run_col), F.lit(f"_{v}")).alias("array"), F.col(VARIABLES[v]).cast("double").alias("value"))
             for v in variables]
    values = cells.select("cell", F.inline(F.array(*names)))
    tiles = build_tiles(values, meta, "value", chunk, nodata, unique=True, by=["array"])
    written = write_arrays(tiles, meta, store, [f"{run}_{v}" for run in runs for v in variables], chunk, nodata)
    consolidate_store(cells.sparkSession, store)
    return written
