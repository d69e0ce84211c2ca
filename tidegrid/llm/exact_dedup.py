"""Exact duplicates by progressive refinement: length, then prefix hash, then full hash.

Built-in functions only. The wide text is never shuffled for the two cheap levels, and the full
hash is computed only for rows that share length and prefix with another row.

Defined results: a null text counts as empty; texts are compared after every run of ASCII white
space became one space; the smallest ``doc_id`` of a group stays, a group of null ids alone keeps
them all; rows that repeat both ``doc_id`` and text cannot be told apart and get the same answer;
an empty table gives an empty result; further columns are ignored.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tidegrid.llm.common import ASCII_SPACE, anti, ids_and_texts, semi, store, text_of

#: Characters of a text that the second level hashes.
PREFIX = 128

#: What identifies a row between the scans.
ROW_KEY = ("doc_id", "length", "prefix")


def normalised(text: Column) -> Column:
    return F.regexp_replace(text, ASCII_SPACE, " ")


def full_hash(text: Column) -> Column:
    """SHA-256 of the normalised text in UTF-8, lowercase hex."""
    return F.sha2(normalised(text).cast("binary"), 256)


def exact_duplicates(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text",
                     prefix: int = PREFIX, digests: bool = False) -> DataFrame:
    """``(doc_id, keep_id, group_size, kept)`` for every row of ``docs``, and its refinement keys.

    ``digests`` adds ``text_sha256`` for every row. All texts must be hashed for that, so the
    digest is then taken in the first scan, where the texts are read anyway, instead of in a
    scan of its own for the survivors; the levels work alike.
    """
    texts = ids_and_texts(docs, id_col, text_col)
    rows = store(_facts(texts, prefix, digests).drop("text"))

    # Level 1 and 2: a count per length, then per (length, prefix) among the lengths that repeat.
    lengths = rows.groupBy("length").count().filter("count > 1")
    level1 = semi(rows, store(lengths.select("length")), "length")
    prefixes = level1.groupBy("length", "prefix").count().filter("count > 1")
    level2 = semi(level1, store(prefixes.select("length", "prefix")), "length", "prefix")

    # Level 3: whole contents, of the survivors alone.
    if digests:
        hashed = level2
    else:
        keys = store(level2.select(*ROW_KEY).distinct())
        survivors = semi(_facts(texts, prefix), keys, *ROW_KEY)
        hashed = store(survivors.select(*ROW_KEY, full_hash(F.col("text")).alias("text_sha256")))
    groups = store(hashed.groupBy("text_sha256").agg(F.min("doc_id").alias("keep_id"), F.count("*").alias("group_size"))
                   .filter("group_size > 1"))

    # Every row gets its group; a hash is one row on the group side, however many rows have it.
    alone = F.col("group_size").isNull()
    answer = [F.when(alone, F.col("doc_id")).otherwise(F.col("keep_id")).alias("keep_id"),
              F.coalesce("group_size", F.lit(1)).cast("long").alias("group_size"),
              (alone | F.col("doc_id").eqNullSafe(F.col("keep_id"))).alias("kept")]
    if digests:
        return rows.join(groups, "text_sha256", "left").select("doc_id", *answer, "text_sha256")
    found = hashed.join(groups, "text_sha256", "left").select(*ROW_KEY, *answer)
    found = store(found.groupBy(*ROW_KEY).agg(
        F.min("keep_id").alias("keep_id"), F.max("group_size").alias("group_size"), F.max("kept").alias("found_kept")))
    match = F.lit(True)
    for c in ROW_KEY:
        match = match & rows[c].eqNullSafe(found[c])
    return rows.join(found, match, "left").select(
        rows["doc_id"],
        F.when(alone, rows["doc_id"]).otherwise(F.col("keep_id")).alias("keep_id"),
        F.coalesce("group_size", F.lit(1)).cast("long").alias("group_size"),
        F.coalesce("found_kept", F.lit(True)).alias("kept"), rows["length"], rows["prefix"],
    )


def _facts(texts: DataFrame, prefix: int, digests: bool = False) -> DataFrame:
    norm = normalised(F.col("text"))
    columns = {"length": F.length("norm"), "prefix": F.xxhash64(F.substring("norm", 1, prefix))}
    if digests:
        columns["text_sha256"] = F.sha2(F.col("norm").cast("binary"), 256)
    return texts.withColumn("norm", norm).withColumns(columns).drop("norm")


def drop_exact_duplicates(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text",
                          prefix: int = PREFIX) -> DataFrame:
    """``docs`` with one row per text, that with the smallest id; all columns stay.

    Rows are matched by id, length and prefix hash, so of rows that wrongly share an id only
    those go whose own text is a copy. Of rows equal in id and text one stays, by a hash of the
    whole row; so does one of a text that only rows without an id have. A table loaded twice
    thus gives what it gives when loaded once.
    """
    found = store(exact_duplicates(docs, id_col, text_col, prefix).filter("group_size > 1").select(*ROW_KEY, "kept"))
    # Stored by itself, so that its own size decides how it is joined.
    gone = store(found.filter(~F.col("kept")).select(*ROW_KEY).distinct())
    # Ids on several kept rows of a group: only these rows are dealt out and numbered.
    again = store(found.filter("kept").groupBy(*ROW_KEY).count().filter("count > 1").select(*ROW_KEY))
    norm = normalised(text_of(text_col))

    def match(keys: DataFrame) -> Column:
        return (docs[id_col].eqNullSafe(keys["doc_id"]) & (F.length(norm) == keys["length"])
                & (F.xxhash64(F.substring(norm, 1, prefix)) == keys["prefix"]))

    rest = docs.join(gone, match(gone), "left_anti")
    if again.isEmpty():
        return rest
    several = docs.join(again, match(again), "left_semi").join(gone, match(gone), "left_anti")
    same = Window.partitionBy(F.col(id_col), F.sha2(norm.cast("binary"), 256))
    numbers = F.row_number().over(same.orderBy(F.xxhash64(*docs.columns)))
    number = f"_n{''.join(docs.columns)}"  # a name that no column has
    one = several.withColumn(number, numbers).filter(F.col(number) == 1).select(docs.columns)
    return rest.join(again, match(again), "left_anti").unionByName(one)
