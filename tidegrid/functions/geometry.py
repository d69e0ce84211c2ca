"""Points, rings and coordinate systems as columns.

A point is ``struct<x,y>`` and a ring ``array<struct<x,y>>``, so geometry travels through
Parquet, shuffles and whole-stage code like any other column.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def point(x: Column | str, y: Column | str) -> Column:
    as_col = lambda c: F.col(c) if isinstance(c, str) else c
    return F.struct(as_col(x).cast("double").alias("x"), as_col(y).cast("double").alias("y"))


def add_point(df: DataFrame, long: str = "long", lat: str = "lat") -> DataFrame:
    """Add a ``geometry`` point built from the coordinate columns."""
    return df.withColumn("geometry", point(long, lat))


def explode_edges(df: DataFrame, keys: list[str], ring: str = "ring") -> DataFrame:
    """One row per ring edge: keys, x1, y1, x2, y2. Empty and NULL rings give no rows."""
    edges = df.select(*keys, F.col(ring).alias("p")).where(F.size("p") > 0)
    edges = edges.withColumn("q", F.concat(F.slice("p", 2, F.size("p")), F.slice("p", 1, 1)))
    edges = edges.select(*keys, F.explode(F.arrays_zip("p", "q")).alias("_e"))
    return edges.select(
        *keys,
        F.col("_e.p.x").alias("x1"), F.col("_e.p.y").alias("y1"),
        F.col("_e.q.x").alias("x2"), F.col("_e.q.y").alias("y2"),
    )


def wkt_rings(wkt: Column | str) -> Column:
    """Rings of a POLYGON or MULTIPOLYGON text, as array of rings.

    Even-odd filling makes the ring order and the polygon grouping irrelevant.
    """
    wkt = F.col(wkt) if isinstance(wkt, str) else wkt
    texts = F.regexp_extract_all(wkt, F.lit(r"\(([^()]+)\)"), 1)

    def ring(text: Column) -> Column:
        return F.transform(
            F.split(text, ","),
            lambda v: point(
                F.split(F.trim(v), r"\s+")[0].cast("double"),
                F.split(F.trim(v), r"\s+")[1].cast("double"),
            ),
        )

    return F.transform(texts, ring)


def ring_wkt(ring: Column | str) -> Column:
    """POLYGON text of one ring, closed by repeating the first vertex."""
    ring = F.col(ring) if isinstance(ring, str) else ring
    closed = F.concat(ring, F.slice(ring, 1, 1))
    vertex = lambda p: F.concat_ws(" ", p["x"].cast("string"), p["y"].cast("string"))
    return F.concat(F.lit("POLYGON (("), F.array_join(F.transform(closed, vertex), ", "), F.lit("))"))


# --- coordinate systems -------------------------------------------------------------

# Sphere radius of EPSG:3857; GRS80 ellipsoid and EPSG:5070 parameters.
MERCATOR_RADIUS = 6378137.0
GRS80_A = 6378137.0
GRS80_INV_F = 298.257222101
ALBERS_LON0 = -96.0
ALBERS_LAT0 = 23.0
ALBERS_LAT1 = 29.5
ALBERS_LAT2 = 45.5

_E2 = (2 - 1 / GRS80_INV_F) / GRS80_INV_F
_E = math.sqrt(_E2)


def _authalic_q(sin_lat: float) -> float:
    return (1 - _E2) * (
        sin_lat / (1 - _E2 * sin_lat**2)
        - math.log((1 - _E * sin_lat) / (1 + _E * sin_lat)) / (2 * _E)
    )


def _parallel_m(lat: float) -> float:
    s = math.sin(math.radians(lat))
    return math.cos(math.radians(lat)) / math.sqrt(1 - _E2 * s * s)


_Q0, _Q1, _Q2 = (_authalic_q(math.sin(math.radians(v))) for v in (ALBERS_LAT0, ALBERS_LAT1, ALBERS_LAT2))
_M1, _M2 = _parallel_m(ALBERS_LAT1), _parallel_m(ALBERS_LAT2)
ALBERS_N = (_M1**2 - _M2**2) / (_Q2 - _Q1)
ALBERS_C = _M1**2 + ALBERS_N * _Q1
ALBERS_RHO0 = GRS80_A * math.sqrt(ALBERS_C - ALBERS_N * _Q0) / ALBERS_N


def _to_mercator(x: Column, y: Column) -> tuple[Column, Column]:
    r = F.lit(MERCATOR_RADIUS)
    return F.radians(x) * r, F.log(F.tan(F.lit(math.pi / 4) + F.radians(y) / 2)) * r


def _from_mercator(x: Column, y: Column) -> tuple[Column, Column]:
    r = F.lit(MERCATOR_RADIUS)
    return F.degrees(x / r), F.degrees(F.lit(2.0) * F.atan(F.exp(y / r)) - F.lit(math.pi / 2))


def _to_albers(x: Column, y: Column) -> tuple[Column, Column]:
    s = F.sin(F.radians(y))
    q = F.lit(1 - _E2) * (
        s / (F.lit(1.0) - F.lit(_E2) * s * s)
        - F.log((F.lit(1.0) - F.lit(_E) * s) / (F.lit(1.0) + F.lit(_E) * s)) / F.lit(2 * _E)
    )
    rho = F.lit(GRS80_A) * F.sqrt(F.lit(ALBERS_C) - F.lit(ALBERS_N) * q) / F.lit(ALBERS_N)
    theta = F.lit(ALBERS_N) * F.radians(x - F.lit(ALBERS_LON0))
    return rho * F.sin(theta), F.lit(ALBERS_RHO0) - rho * F.cos(theta)


_TRANSFORMS = {
    ("EPSG:4326", "EPSG:3857"): _to_mercator,
    ("EPSG:3857", "EPSG:4326"): _from_mercator,
    ("EPSG:4326", "EPSG:5070"): _to_albers,
}


def transform_xy(x: Column, y: Column, src: str, dst: str) -> tuple[Column, Column]:
    """Transformed coordinates for a supported pair of systems; other pairs raise."""
    if src == dst:
        return x, y
    try:
        return _TRANSFORMS[(src, dst)](x, y)
    except KeyError:
        raise ValueError(f"no closed-form transform from {src} to {dst}") from None


def to_crs(df: DataFrame, src: str, dst: str, x: str = "long", y: str = "lat") -> DataFrame:
    """Move the coordinate columns from one system to another (identity when equal)."""
    if src == dst:
        return df
    new_x, new_y = transform_xy(F.col(x), F.col(y), src, dst)
    return df.withColumns({x: new_x, y: new_y})
