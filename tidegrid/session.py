"""Session helpers: recommended settings and the shared scratch folder."""

from __future__ import annotations

import os
import tempfile
import uuid
import zipfile
from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import SparkSession

#: Settings that keep the plans in this package adaptive on any cluster size.
RECOMMENDED = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.adaptive.forceOptimizeSkewedJoin": "true",
    # Hash the small side of a join instead of sorting the large one, where it fits a task.
    "spark.sql.adaptive.maxShuffledHashJoinLocalMapThreshold": "64MB",
    "spark.sql.sources.partitionOverwriteMode": "dynamic",
    "spark.sql.session.timeZone": "UTC",
    # Call sites recorded for every column expression cost more than building the plan.
    "spark.python.sql.dataFrameDebugging.enabled": "false",
}

#: Settings that let a plan rely on the bucketing and order of a stored table.
COLOCATED = {
    "spark.sql.requireAllClusterKeysForCoPartition": "false",
    "spark.sql.legacy.bucketedTableScan.outputOrdering": "true",
    "spark.sql.execution.replaceHashWithSortAgg": "true",
}


def build_session(app: str, master: str | None = None, **conf: str) -> SparkSession:
    """A session with :data:`RECOMMENDED` applied; ``conf`` keys use ``__`` for dots."""
    builder = SparkSession.builder.appName(app)
    if master:
        builder = builder.master(master)
    settings = {**RECOMMENDED, **{k.replace("__", "."): v for k, v in conf.items()}}
    for key, value in settings.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()


@contextmanager
def colocated_joins(spark: SparkSession) -> Iterator[None]:
    """Let queries use a stored layout: bucketed by tile, sorted by cell, joined by (tile, id).

    Without it Spark shuffles both sides to the full join key and hashes the groups, which is
    as correct but moves the bucketed table. The settings count while a query is planned, so
    the action goes inside.
    """
    before = {name: spark.conf.get(name, None) for name in COLOCATED}
    for name, value in COLOCATED.items():
        spark.conf.set(name, value)
    try:
        yield
    finally:
        for name, value in before.items():
            if value is None:
                spark.conf.unset(name)
            else:
                spark.conf.set(name, value)


def scratch_dir(spark: SparkSession, label: str) -> str:
    """A fresh folder under the cluster's shared checkpoint folder, ``spark.checkpoint.dir``.

    There is no fallback: a folder of one machine would be invisible to the others.
    """
    shared = spark.conf.get("spark.checkpoint.dir", None)
    shared = shared or spark.sparkContext.getConf().get("spark.checkpoint.dir")
    if not shared:
        raise ValueError("spark.checkpoint.dir names no shared folder")
    return f"{shared.rstrip('/')}/{label}-{uuid.uuid4().hex}"


def ship_package(spark: SparkSession) -> None:
    """Make this package importable on the workers, whatever the driver's path is.

    Jobs whose tasks call functions of the package need that; once per application is enough.
    ``--py-files`` does the same from outside.
    """
    context = spark.sparkContext
    if getattr(context, "_tidegrid_shipped", False):
        return
    root = os.path.dirname(os.path.abspath(__file__))
    archive = os.path.join(tempfile.mkdtemp(prefix="ship-"), "tidegrid.zip")
    with zipfile.ZipFile(archive, "w", zipfile.ZIP_DEFLATED) as out:
        for folder, _, names in os.walk(root):
            for name in sorted(names):
                if name.endswith(".py"):
                    path = os.path.join(folder, name)
                    out.write(path, os.path.join("tidegrid", os.path.relpath(path, root)))
    context.addPyFile(archive)
    context._tidegrid_shipped = True
