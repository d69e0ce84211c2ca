"""Scratch folders of the registered queries."""

from __future__ import annotations

import tempfile

from pyspark.sql import SparkSession

from tidegrid import session


def scratch_dir(spark: SparkSession, label: str) -> str:
    """A fresh shared folder; a session that names none (tests) is given one of this machine."""
    if not (spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getConf().get("spark.checkpoint.dir")):
        spark.conf.set("spark.checkpoint.dir", tempfile.mkdtemp(prefix="run-"))
    return session.scratch_dir(spark, label)
