"""Tables from files and local frames, and the normalisation of their columns."""

from __future__ import annotations

import json
from typing import Any

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidegrid.functions.grid import GridMeta
from tidegrid.functions.scalars import nan_to_null

# Variable names of a forecast snapshot and the column names used here.
SNAPSHOT_COLUMNS = {
    "SCHISM_hgrid_node_x": "long",
    "SCHISM_hgrid_node_y": "lat",
    "elevation": "wse",
}
SNAPSHOT_NODE = "nSCHISM_hgrid_node"

DEM_METADATA_SCHEMA = (
    "dem_metadata string, crs string, height int, width int, nodata float, transform string"
)


def load_table(spark: SparkSession, path: str) -> DataFrame:
    """A file or folder as a table; the format follows the extension, Parquet by default."""
    suffix = path.rstrip("/").rsplit(".", 1)[-1].lower()
    if suffix == "csv":
        return spark.read.csv(path, header=True, inferSchema=True)
    if suffix == "json":
        return spark.read.json(path)
    if suffix == "orc":
        return spark.read.orc(path)
    return spark.read.parquet(path)


def register_frame(
    spark: SparkSession,
    rows: Any = None,
    schema: Any = None,
    path: str | None = None,
    name: str | None = None,
) -> DataFrame:
    """A small local frame or a path as a table; exactly one of the two must be given."""
    if (rows is None) == (path is None):
        raise ValueError("give either rows or path, and not both")
    df = spark.createDataFrame(rows, schema) if path is None else load_table(spark, path)
    if name:
        df.createOrReplaceTempView(name)
    return df


def normalize_node_wse(df: DataFrame) -> DataFrame:
    """Forecast snapshot rows as nodes: node_id (1-based), long, lat, wse.

    Variables the snapshot lacks are reported and skipped; with none of them the result is
    an empty table. Time is dropped and NaN becomes NULL.
    """
    present = [c for c in SNAPSHOT_COLUMNS if c in df.columns]
    absent = [c for c in SNAPSHOT_COLUMNS if c not in df.columns]
    if absent:
        print(f"snapshot lacks: {', '.join(absent)}")
    if not present:
        return df.sparkSession.createDataFrame([], T.StructType([]))
    values = [nan_to_null(F.col(c).cast("double")).alias(SNAPSHOT_COLUMNS[c]) for c in present]
    return df.select((F.col(SNAPSHOT_NODE).cast("long") + 1).alias("node_id"), *values)


def read_zonal(spark: SparkSession, path: str, numeric_mask: bool = True) -> DataFrame:
    """Coverage table with a boolean mask.

    Some producers write a numeric mask with NULL for "not masked". With ``numeric_mask``
    such a column is coerced (NULL and 0 to false, anything else to true); a boolean mask is
    left alone, NULL included.
    """
    df = load_table(spark, path)
    mask = F.col("mask")
    if numeric_mask and not isinstance(df.schema["mask"].dataType, T.BooleanType):
        mask = F.coalesce(mask.cast("double") != 0, F.lit(False))
    return df.select(
        F.col("pg_id").cast("long").alias("pg_id"), F.col("cell").cast("long").alias("cell"),
        F.col("coverage_fraction").cast("double").alias("coverage_fraction"),
        F.col("elevation").cast("double").alias("elevation"), mask.alias("mask"),
    )


def convert_elements(df: DataFrame) -> DataFrame:
    """Element polygons with ``pg_id`` and ``geometry``; an unknown schema passes through."""
    renamed = df.withColumnRenamed("elementID", "pg_id")
    if "pg_id" in renamed.columns:
        return renamed.select("pg_id", "geometry")
    print("no elementID column; the element table is passed through unchanged")
    return renamed


def load_result(spark: SparkSession, path: str) -> DataFrame:
    """A materialised depth result."""
    return spark.read.parquet(path)


def extract_mask(layer: DataFrame) -> DataFrame:
    """The final mask layer, geometry only."""
    return layer.select("geometry")


def metadata_row(spark: SparkSession, meta: GridMeta, key: str = "DEM") -> DataFrame:
    """Grid metadata as its one-row table."""
    row = (key, meta.crs, meta.height, meta.width, meta.nodata, meta.transform_json)
    return spark.createDataFrame([row], DEM_METADATA_SCHEMA)


def load_dem_metadata(df: DataFrame, key: str = "DEM") -> GridMeta:
    """Grid metadata read back from the record stored under ``key``."""
    row = df.where(F.col("dem_metadata") == key).first()
    if row is None:
        raise LookupError(f"no grid metadata stored under {key}")
    transform = tuple(float(v) for v in json.loads(row["transform"])[:6])
    return GridMeta(row["width"], row["height"], transform, row["crs"], row["nodata"])
