"""A corpus pipeline of five stages over the documents table.

Each stage takes ``(spark, docs, sf_dir)`` and returns a DataFrame; the first four return the columns
of ``docs``, the last adds the place of each document in the mixture. Each works on all that its
predecessor kept. Null and empty texts, repeated rows and empty tables give what the operator of
the stage says of them.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidegrid.llm.common import store, table
from tidegrid.llm.decontaminate import drop_contaminated
from tidegrid.llm.exact_dedup import drop_exact_duplicates
from tidegrid.llm.minhash import drop_near_duplicates
from tidegrid.llm.mixing import mix_sources
from tidegrid.llm.quality import held_out, keep_good, train_quality


def quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Drops the documents that a classifier, trained on the labelled ones, rejects."""
    model = train_quality(docs, table(spark, sf_dir, "labels"), usable=~held_out(F.col("doc_id")))
    return keep_good(docs, model)


def exact(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Drops all but the first of the documents whose texts are equal but for white space."""
    return drop_exact_duplicates(docs)


def near(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Keeps one document of each group that shares 0.8 of its five-word shingles."""
    return drop_near_duplicates(docs, size=5, percent=80)


def decontaminate(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Drops the documents in which ten consecutive words of a benchmark item occur."""
    return drop_contaminated(docs, table(spark, sf_dir, "benchmark"))


def mix(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Gives every document its place in a mixture of the sources; nothing is dropped."""
    return mix_sources(docs)


STAGES = [("quality", quality), ("exact_dedup", exact), ("near_dedup", near), ("decontaminate", decontaminate), ("mix", mix)]

#: The stages learn a model and hash; SQL cannot say them.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over the documents table, each written before the next reads it."""
    docs = table(spark, sf_dir, "documents")
    for number, (_, stage) in enumerate(STAGES):
        docs = stage(spark, docs, sf_dir)
        if number < len(STAGES) - 1:
            docs = store(docs)
    return docs
