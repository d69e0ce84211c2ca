"""Joins that stay balanced when a few keys hold a large share of the rows."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: Rows of one key a task should handle; keys with more are spread over several tasks.
HOT_ROWS = 5_000_000
SALT, HOT = "_salt", "_hot"


def hot_keys(df: DataFrame, key: str, min_rows: int = HOT_ROWS) -> DataFrame:
    """Keys holding more than ``min_rows`` rows, with the number of salts each one needs.

    The result has fewer than rows / min_rows entries (2e5 for 1e12 rows at the default), so
    that Spark broadcasts it by its size; nothing here forces that. Salts grow with the key, so a key holding a
    third of everything still leaves no more than ``min_rows`` rows per salt.
    """
    counts = df.groupBy(key).agg(F.count(F.lit(1)).alias("_n")).where(F.col("_n") > min_rows)
    return counts.select(key, F.ceil(F.col("_n") / F.lit(min_rows)).cast("int").alias("salts"))


def add_salt(df: DataFrame, key: str, hot: DataFrame, spread_by: str) -> DataFrame:
    """The large side with a salt (spread over the key's salts if hot, else 0) and a hot flag."""
    flagged = df.join(hot.select(key, "salts"), key, "left")
    salt = F.coalesce(F.pmod(F.hash(spread_by), F.col("salts")), F.lit(0))
    return flagged.select(*df.columns, salt.alias(SALT), F.col("salts").isNotNull().alias(HOT))


def salt_copies(df: DataFrame, key: str, hot: DataFrame) -> DataFrame:
    """The small side, one copy per salt of a hot key and one copy of everything else."""
    flagged = df.join(hot.select(key, "salts"), key, "left")
    salts = F.sequence(F.lit(0), F.coalesce("salts", F.lit(1)) - 1)
    return flagged.select(*df.columns, F.explode(salts).alias(SALT))


#: Rows a task should make at most, and at least while there are idle cores.
TASK_ROWS = 2_000_000
LEAST_TASK_ROWS = 20_000


def spread(df: DataFrame, *keys: str, stands_for: Column | None = None) -> DataFrame:
    """Hash the rows over many tasks, ahead of a step that multiplies them.

    The count is explicit because adaptive coalescing goes by bytes: a few kilobytes of
    runs or edges that stand for millions of cells would otherwise end up in one task. It
    follows the rows that a row ``stands_for`` (summed up, one row) where the caller can
    tell, and the cores of the cluster in any case.
    """
    tasks = max(df.sparkSession.sparkContext.defaultParallelism, int(df.sparkSession.conf.get("spark.sql.shuffle.partitions")))
    if stands_for is not None:
        rows = df.agg(F.sum(stands_for)).first()[0] or 0
        tasks = max(min(tasks, rows // LEAST_TASK_ROWS), -(-rows // TASK_ROWS), 1)
    return df.repartition(int(tasks), *keys)


def salted_join(
    left: DataFrame, right: DataFrame, key: str, hot: DataFrame | None, spread_by: str, how: str = "left"
) -> DataFrame:
    """Equi join of a large side with a small one, hot keys spread over many tasks.

    Without ``hot`` it is a plain join, left to adaptive skew handling.
    """
    if hot is None:
        return left.join(right, key, how)
    salted = add_salt(left, key, hot, spread_by)
    return salted.join(salt_copies(right, key, hot), [key, SALT], how).drop(SALT, HOT)
