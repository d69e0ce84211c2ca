"""Sparse raster tiles: cells -> tiles -> cells, and averaged overviews."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidegrid.functions.grid import GridMeta, cell_id, cell_to_rowcol, tile_key

TILE_SCHEMA = (
    "tile_row int, tile_col int, row_off bigint, col_off bigint, n_rows int, n_cols int, data binary"
)


def build_tiles(
    df: DataFrame,
    meta: GridMeta,
    col: str,
    tile: int = 512,
    nodata: float = -9999.0,
    depth_threshold: float | None = None,
    unique: bool = False,
    by: list[str] | None = None,
) -> DataFrame:
    """One row per tile that holds data, with row-major little-endian float32 ``data``.

    With ``by`` (string columns), tiles of each of their values are kept apart and carry them.

    Tiles at the right and bottom edge are cropped to the raster. Values below
    ``depth_threshold`` become nodata. Cells are made unique first (largest value wins), so
    a tile's group is at most tile x tile rows; pass ``unique=True`` to skip that step for
    input grouped by cell already.
    """
    by = by or []
    cells = df.select(*by, "cell", F.col(col).cast("double").alias("value"))
    if not unique:
        cells = cells.groupBy(*by, "cell").agg(F.max("value").alias("value"))
    placed = tile_key(cell_to_rowcol(cells, meta.width), tile)
    placed = placed.where((F.col("row") < meta.height) & (F.col("row") >= 0))
    values = F.col("value").cast("float")
    if depth_threshold is not None:
        values = F.when(F.col("value") < F.lit(float(depth_threshold)), F.lit(nodata).cast("float")).otherwise(values)
    placed = placed.select(
        *by, "row_off", "col_off", (F.col("tile_r") * tile + F.col("tile_c")).alias("pos"), values.alias("value")
    )
    width, height = meta.width, meta.height

    def assemble(key: tuple, rows: pd.DataFrame) -> pd.DataFrame:
        row_off, col_off = int(key[-2]), int(key[-1])
        block = np.full(tile * tile, nodata, dtype="<f4")
        values = rows["value"].to_numpy(dtype="<f4", na_value=np.nan)
        pos = rows["pos"].to_numpy()
        present = ~np.isnan(values)
        block[pos[present]] = values[present]
        n_rows, n_cols = min(tile, height - row_off), min(tile, width - col_off)
        data = block.reshape(tile, tile)[:n_rows, :n_cols].tobytes()
        return pd.DataFrame({
            **{name: [value] for name, value in zip(by, key)}, "tile_row": [row_off // tile], "tile_col": [col_off // tile],
            "row_off": [row_off], "col_off": [col_off],
            "n_rows": [n_rows], "n_cols": [n_cols], "data": [data],
        })

    schema = "".join(f"{name} string, " for name in by) + TILE_SCHEMA
    return placed.groupBy(*by, "row_off", "col_off").applyInPandas(assemble, schema)


def tiles_to_cells(tiles: DataFrame, meta: GridMeta, nodata: float = -9999.0) -> DataFrame:
    """The cells stored in tiles: cell, value. Nodata and NaN pixels are left out."""

    def decode(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            for t in batch.itertuples(index=False):
                block = np.frombuffer(t.data, dtype="<f4").reshape(t.n_rows, t.n_cols)
                rows, cols = np.nonzero(~np.isnan(block) & (block != np.float32(nodata)))
                yield pd.DataFrame({
                    "row": rows.astype("int64") + t.row_off,
                    "col": cols.astype("int64") + t.col_off,
                    "value": block[rows, cols],
                })

    pixels = tiles.select("row_off", "col_off", "n_rows", "n_cols", "data").mapInPandas(
        decode, "row bigint, col bigint, value float"
    )
    return pixels.select(cell_id("row", "col", meta.width).alias("cell"), "value")


def dem_cells(tiles: DataFrame, meta: GridMeta, nodata: float | None = None) -> DataFrame:
    """Terrain tiles as a long table of every cell: cell, elevation.

    ``tiles``: row_off, col_off, n_cols, values (row-major array). Nodata becomes NULL, and
    the row is kept, so cells run from 1 to the number of pixels.
    """
    pixels = tiles.select("row_off", "col_off", "n_cols", F.posexplode("values").alias("pos", "value"))
    in_row = F.call_function("div", F.col("pos").cast("long"), F.col("n_cols").cast("long"))
    in_col = F.col("pos").cast("long") % F.col("n_cols").cast("long")
    value = F.when(~F.isnan("value"), F.col("value").cast("double"))
    if nodata is not None:
        value = F.when(F.col("value") != F.lit(nodata), value)
    return pixels.select(
        cell_id(F.col("row_off") + in_row, F.col("col_off") + in_col, meta.width).alias("cell"),
        value.alias("elevation"),
    )


def overview_levels(meta: GridMeta, tile: int = 512) -> int:
    """Halvings needed until the raster fits one tile."""
    levels, size = 0, max(meta.width, meta.height)
    while size > tile:
        size, levels = (size + 1) // 2, levels + 1
    return levels


#: Halvings that stay inside one aligned square of 512 pixels.
LEVELS_PER_SHUFFLE = 9


def overviews(df: DataFrame, meta: GridMeta, col: str, levels: int | None = None, tile: int = 512) -> DataFrame:
    """Overview pyramid by averaging 2 x 2 blocks of valid pixels: level, row, col, value.

    Each level averages the level below it. A pixel's place on a level is a prefix of the bits
    of its row and column, so pixels that share a prefix of all levels are dealt out together,
    once, and every further grouping finds them where they are. Nine halvings stay inside an
    aligned square of 512 pixels, which bounds what is dealt out together; what a square leaves
    for coarser levels is one pixel. Finished levels ride along, so no level is computed twice.
    """
    levels = overview_levels(meta, tile) if levels is None else levels
    base = cell_to_rowcol(df.select("cell", F.col(col).cast("double").alias("value")), meta.width)
    rows = base.where("value IS NOT NULL AND NOT isnan(value)").selectExpr("0 AS level", "row", "col", "value")
    if levels < 1:
        return rows.where(F.lit(False))
    for level in range(1, levels + 1):
        if (level - 1) % LEVELS_PER_SHUFFLE == 0:
            bits = min(LEVELS_PER_SHUFFLE, levels - level + 1)
            rows = rows.selectExpr("level", "row", "col", "value", f"shiftright(row, {bits}) AS top", f"shiftright(col, {bits}) AS left")
            rows = rows.repartition("top", "left")
        # A pixel of the level below stands for its own place and for the one above it.
        places = "array(1)" if level == 1 else "array(0, 1)"
        rows = rows.selectExpr("*", f"explode(CASE WHEN level = {level - 1} THEN {places} ELSE array(0) END) AS up")
        rows = rows.selectExpr("top", "left", "level + up AS level", "shiftright(row, up) AS row", "shiftright(col, up) AS col", "value")
        rows = rows.groupBy("top", "left", "level", "row", "col").agg(F.avg("value").alias("value"))
    return rows.select("level", "row", "col", "value")


def ordered_result(df: DataFrame) -> DataFrame:
    """Total order by cell (a range-partitioned sort, no single task)."""
    return df.orderBy("cell")
