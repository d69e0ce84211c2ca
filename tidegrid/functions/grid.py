"""Raster grid arithmetic on columns.

A raster is a sparse long table keyed by ``cell``: 1-based, row-major ids. Ids pass
seven hundred million on a continental grid, so every product is done on BIGINT.
"""

from __future__ import annotations

import json
from dataclasses import dataclass, replace

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


@dataclass(frozen=True)
class GridMeta:
    """Grid metadata record: size, affine transform ``(a, b, c, d, e, f)``, CRS, nodata."""

    width: int
    height: int
    transform: tuple[float, float, float, float, float, float]
    crs: str = "EPSG:4326"
    nodata: float | None = -9999.0

    def __post_init__(self) -> None:
        if self.width <= 0 or self.height <= 0:
            raise ValueError("grid width and height must be positive")
        if self.transform[1] != 0 or self.transform[3] != 0:
            raise ValueError("rotated or sheared grids are not supported")
        if self.transform[0] == 0 or self.transform[4] == 0:
            raise ValueError("pixel size must not be zero")

    @property
    def a(self) -> float:
        return self.transform[0]

    @property
    def c(self) -> float:
        return self.transform[2]

    @property
    def e(self) -> float:
        return self.transform[4]

    @property
    def f(self) -> float:
        return self.transform[5]

    @property
    def cells(self) -> int:
        return self.width * self.height

    @property
    def transform_json(self) -> str:
        return json.dumps(list(self.transform))

    def window(self, row_off: int, col_off: int, height: int, width: int) -> "GridMeta":
        """The metadata of a window cut out of this grid."""
        moved = (self.a, 0.0, self.c + col_off * self.a, 0.0, self.e, self.f + row_off * self.e)
        return replace(self, width=width, height=height, transform=moved)


def _col(c: Column | str) -> Column:
    return F.col(c) if isinstance(c, str) else c


def int_div(a: Column, b: int) -> Column:
    """Integral division, staying on BIGINT (no detour through double)."""
    return F.call_function("div", a.cast("long"), F.lit(b).cast("long"))


def cell_row(cell: Column | str, width: int) -> Column:
    return int_div(_col(cell) - 1, width)


def cell_col(cell: Column | str, width: int) -> Column:
    return (_col(cell).cast("long") - 1) % F.lit(width).cast("long")


def cell_id(row: Column | str, col: Column | str, width: int) -> Column:
    return _col(row).cast("long") * F.lit(width).cast("long") + _col(col).cast("long") + 1


def cell_center_x(col: Column, meta: GridMeta) -> Column:
    return F.lit(meta.c) + (col.cast("double") + F.lit(0.5)) * F.lit(meta.a)


def cell_center_y(row: Column, meta: GridMeta) -> Column:
    return F.lit(meta.f) + (row.cast("double") + F.lit(0.5)) * F.lit(meta.e)


def cell_at(x: Column | str, y: Column | str, meta: GridMeta) -> Column:
    """Id of the cell holding a point; NULL outside the grid.

    Row and column are range-checked one by one: an out-of-range column would
    otherwise wrap to a valid id on a neighbouring row.
    """
    col = F.floor((_col(x) - F.lit(meta.c)) / F.lit(meta.a))
    row = F.floor((_col(y) - F.lit(meta.f)) / F.lit(meta.e))
    inside = (col >= 0) & (col < meta.width) & (row >= 0) & (row < meta.height)
    # NaN compares above every number, so a NaN coordinate must be ruled out first.
    valid = ~F.isnan(_col(x)) & ~F.isnan(_col(y))
    return F.when(valid & inside, cell_id(row, col, meta.width))


def cell_to_rowcol(df: DataFrame, width: int, cell: str = "cell") -> DataFrame:
    """Add ``row`` and ``col`` (0-based) to a table keyed by cell."""
    return df.withColumns({"row": cell_row(cell, width), "col": cell_col(cell, width)})


def tile_key(df: DataFrame, size: int = 512) -> DataFrame:
    """Add the offset of the tile holding (row, col) and the position inside it."""
    row, col = F.col("row"), F.col("col")
    return df.withColumns({
        "row_off": row - row % size,
        "col_off": col - col % size,
        "tile_r": (row % size).cast("int"),
        "tile_c": (col % size).cast("int"),
    })


def geotransform(meta: DataFrame) -> DataFrame:
    """Metadata rows with the JSON affine ``[a,b,c,d,e,f]`` spelled out as (c,a,b,f,d,e)."""
    parsed = meta.withColumn("_t", F.from_json("transform", "array<double>"))
    at = lambda i: F.element_at("_t", i)
    return parsed.select(
        "dem_metadata", "crs", "height", "width",
        at(3).alias("gt_origin_x"), at(1).alias("gt_pixel_w"), at(2).alias("gt_row_rot"),
        at(6).alias("gt_origin_y"), at(4).alias("gt_col_rot"), at(5).alias("gt_pixel_h"),
    )
