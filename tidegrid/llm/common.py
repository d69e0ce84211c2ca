"""Helpers shared by the corpus operators: tables, stored intermediates, safe column names."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

#: ASCII white space as the contracts spell it: space, tab, line feed, vertical tab, form feed, return.
ASCII_SPACE = r"[\x20\x09-\x0D]+"


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """One of the supplied tables, read by Spark so that any file system will do."""
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def shared_folder(spark: SparkSession) -> str:
    """A new folder under ``spark.checkpoint.dir``, which every executor can reach.

    Where the session names no such folder (tests), one is made and set for the session.
    """
    root = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getConf().get("spark.checkpoint.dir")
    if not root:
        root = tempfile.mkdtemp(prefix="shared-")
        spark.conf.set("spark.checkpoint.dir", root)
    return f"{root.rstrip('/')}/llm-{uuid.uuid4().hex}"


def store(df: DataFrame) -> DataFrame:
    """The frame written to the shared folder and read back.

    Cuts the lineage (a lost executor costs a re-read, not a re-computation), is computed once
    however often it is used, and forgets the partitioning of ``df`` so that a join of it is
    exchanged anew and can be split by adaptive execution where a key is hot. The schema is
    given on reading, so an empty result is no special case.
    """
    path = shared_folder(df.sparkSession)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def text_of(column: str = "text") -> Column:
    """A text column with null read as empty."""
    return F.coalesce(F.col(column).cast("string"), F.lit(""))


def ids_and_texts(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``(doc_id, text)`` only: whatever else the table carries cannot clash with work columns."""
    return docs.select(F.col(id_col).alias("doc_id"), text_of(text_col).alias("text"))


def semi(left: DataFrame, keys: DataFrame, *on: str) -> DataFrame:
    """Rows of ``left`` whose keys (nulls equal to each other) are in ``keys``."""
    return left.join(keys, _same(left, keys, on), "left_semi")


def anti(left: DataFrame, keys: DataFrame, *on: str) -> DataFrame:
    """Rows of ``left`` whose keys (nulls equal to each other) are not in ``keys``."""
    return left.join(keys, _same(left, keys, on), "left_anti")


def _same(left: DataFrame, right: DataFrame, on: tuple[str, ...]) -> Column:
    match = left[on[0]].eqNullSafe(right[on[0]])
    for c in on[1:]:
        match = match & left[c].eqNullSafe(right[c])
    return match
