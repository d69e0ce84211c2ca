"""Mask layers: a folder of polygon files, one layer each."""

from __future__ import annotations

from py4j.protocol import Py4JJavaError
from pyspark.errors import PySparkException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidegrid.functions.geometry import wkt_rings
from tidegrid.operators.masks import stack_layers
from tidegrid.sources.filesystem import list_paths
from tidegrid.sources.tables import load_table

# Fixed value: suffix of a registered layer's name where a job names none.
LAYER_SUFFIX = "_atlgulf"


def layer_rings(df: DataFrame, layer: str) -> DataFrame:
    """Polygon rows in ring form: layer, feature_id, ring (one row per ring).

    Accepts a ``ring`` array, a ``rings`` array of arrays, or WKT text in ``geometry``,
    ``geom`` or ``wkt``.
    """
    if "feature_id" not in df.columns:
        df = df.withColumn("feature_id", F.monotonically_increasing_id())
    feature = F.col("feature_id").cast("long").alias("feature_id")
    named = F.lit(layer).alias("layer")
    if "ring" in df.columns:
        return df.select(named, feature, "ring").where("ring IS NOT NULL")
    if "rings" in df.columns:
        return df.select(named, feature, F.explode("rings").alias("ring"))
    texts = [c for c in ("geometry", "geom", "wkt") if c in df.columns]
    if not texts:
        raise ValueError(f"layer {layer} has no polygon column")
    return df.select(named, feature, F.explode(wkt_rings(F.coalesce(*texts))).alias("ring"))


def register_layers(
    spark: SparkSession, folder: str, crs: str = "EPSG:4326", suffix: str = LAYER_SUFFIX
) -> tuple[DataFrame | None, DataFrame, list[tuple[str, str]]]:
    """Every polygon file of a folder as one stacked table, plus CRS records and failures.

    A layer is named by its file and ``suffix``. A file that cannot be read is reported and skipped. The loop runs over file names only.
    """
    layers, names, failures = [], [], []
    for path in list_paths(spark, folder):
        stem = path.rstrip("/").rsplit("/", 1)[-1].rsplit(".", 1)[0]
        try:
            layers.append(layer_rings(load_table(spark, path), stem + suffix))
            names.append(stem + suffix)
        except (PySparkException, Py4JJavaError, ValueError) as problem:
            failures.append((stem, str(problem).splitlines()[0]))
            print(f"layer {stem} skipped: {failures[-1][1]}")
    lineage = spark.createDataFrame([(n, crs) for n in names], "table_name string, crs string")
    return (stack_layers(layers) if layers else None), lineage, failures
