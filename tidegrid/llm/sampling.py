"""Training rows for the classifiers: a bounded sample of labelled documents, and held-out folds."""

from __future__ import annotations

from collections.abc import Callable

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidegrid.llm.common import ids_and_texts
from tidegrid.session import ship_package


def fold(id_col: Column, folds: int) -> Column:
    """crc32 of the id as text, modulo the number of folds; null ids are in fold 0."""
    return F.coalesce(F.pmod(F.crc32(id_col.cast("string").cast("binary")), F.lit(folds)), F.lit(0))


def labelled_sample(docs: DataFrame, labels: DataFrame, label_col: str, usable: Column, rows: int) -> DataFrame:
    """``(order, label, text)`` of about ``rows`` labelled documents at most.

    Chosen by a hash of the id among all labels that ``usable`` (an expression on ``doc_id``)
    admits. A document with several labels has the largest; null labels and ids are no labels; of rows
    that share a chosen id the smallest text counts. The list of chosen ids has a fixed bound, so it
    may be broadcast; only texts of chosen ids are shuffled.
    """
    ship_package(docs.sparkSession)
    known = labels.select("doc_id", F.col(label_col).cast("int").alias("label")).filter(
        F.col("doc_id").isNotNull() & F.col("label").isNotNull())
    known = known.filter(usable).groupBy("doc_id").agg(F.max("label").alias("label"))
    total = known.count()
    order = F.xxhash64(F.col("doc_id"), F.lit("sample"))
    chosen = known.filter(F.pmod(order, F.lit(max(total, 1))) < rows).withColumn("order", order)
    found = ids_and_texts(docs).join(F.broadcast(chosen), "doc_id")
    return found.groupBy("doc_id", "order", "label").agg(F.min("text").alias("text")).select("order", "label", "text")


def train(rows: DataFrame, fit: Callable[[np.ndarray, list[np.ndarray], list[np.ndarray]], dict[int, float]]
          ) -> tuple[np.ndarray, np.ndarray]:
    """Fit a model on ``(order, label, idx array<int>, weight array<float>)`` in one task.

    The rows are a bounded sample, so one task holds them. They are sorted before fitting, which
    makes the model the same however they arrive. Returns the non-zero coordinates and values.
    """
    def run(batches):
        parts = [b for b in batches if b.num_rows]
        if not parts:
            return
        data = pa.Table.from_batches(parts).sort_by([("order", "ascending"), ("label", "ascending")])
        idx = [np.asarray(v.values) for v in data["idx"]]
        weight = [np.asarray(v.values) for v in data["weight"]]
        model = fit(np.asarray(data["label"]), idx, weight)
        yield pa.RecordBatch.from_pydict({
            "at": pa.array(np.fromiter(model.keys(), np.int64, len(model))),
            "value": pa.array(np.fromiter(model.values(), np.float64, len(model)))})

    out = rows.repartition(1).mapInArrow(run, "at long, value double").collect()
    return np.array([r["at"] for r in out], np.int64), np.array([r["value"] for r in out], np.float64)
