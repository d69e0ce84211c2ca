"""Path checks and listings through the cluster's own file system layer."""

from __future__ import annotations

from pyspark.sql import SparkSession


def _resolve(spark: SparkSession, path: str):
    jvm = spark.sparkContext._jvm
    hadoop_path = jvm.org.apache.hadoop.fs.Path(path)
    return hadoop_path.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()), hadoop_path


def qualify(spark: SparkSession, path: str) -> str:
    """A path as the one URI that the driver, all executors and Spark's readers agree on."""
    fs, hadoop_path = _resolve(spark, path)
    uri = fs.makeQualified(hadoop_path).toString()
    return uri.replace("file:/", "file:///", 1) if uri.startswith("file:/") and not uri.startswith("file://") else uri


def path_exists(spark: SparkSession, path: str) -> bool:
    fs, hadoop_path = _resolve(spark, path)
    return bool(fs.exists(hadoop_path))


def list_paths(spark: SparkSession, folder: str) -> list[str]:
    """Entries of a folder by name, hidden and marker files left out."""
    fs, hadoop_path = _resolve(spark, folder)
    found = [s.getPath().toString() for s in fs.listStatus(hadoop_path)]
    return sorted(p for p in found if not p.rsplit("/", 1)[-1].startswith(("_", ".")))


def validate_inputs(spark: SparkSession, *paths: str) -> None:
    """Stop when an input path does not exist."""
    missing = [p for p in paths if not p or not path_exists(spark, p)]
    if missing:
        raise FileNotFoundError(f"missing inputs: {', '.join(repr(p) for p in missing)}")
