"""Connected components of an edge table, by joins; nothing is gathered on the driver."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidegrid.llm.common import store


def roots(parents: DataFrame) -> DataFrame:
    """``(node, label)`` of a forest ``(node, parent)``: a node has one parent, and no circle exists.

    Pointer jumping: the distance doubles with each round, so that paths of any length take
    logarithmically many. Roots themselves are not listed.
    """
    labels = store(parents.select("node", F.col("parent").alias("label")))
    while True:
        up = labels.select(F.col("node").alias("label"), F.col("label").alias("next"))
        jumped = store(labels.join(up, "label", "left").select("node", F.coalesce("next", "label").alias("label"),
                                                              F.col("next").isNotNull().alias("moved")))
        if jumped.filter("moved").isEmpty():
            return labels
        labels = jumped.drop("moved")


def components(edges: DataFrame) -> DataFrame:
    """``(node, label)`` for every node of ``edges(a, b)``; the label is the smallest node reached.

    Each round takes the smallest label among the neighbours and then the label of the label.
    """
    both = store(edges.select("a", "b").union(edges.select("b", "a")).filter("a <> b").distinct())
    labels = store(both.groupBy(F.col("a").alias("node")).agg(F.min("b").alias("m"))
                   .select("node", F.least("node", "m").alias("label")))
    while True:
        near = both.join(labels, both["b"] == labels["node"]).groupBy("a").agg(F.min("label").alias("near"))
        hooked = store(labels.join(near, labels["node"] == near["a"]).select(
            "node", F.col("label").alias("old"), F.least("label", "near").alias("label")))
        up = hooked.select(F.col("node").alias("label"), F.col("label").alias("next"))
        jumped = store(hooked.join(up, "label").select("node", F.col("next").alias("label"),
                                                       (F.col("old") != F.col("next")).alias("moved")))
        if jumped.filter("moved").isEmpty():
            return jumped.select("node", "label")
        labels = jumped.drop("moved")
