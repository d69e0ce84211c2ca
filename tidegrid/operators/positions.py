"""Stable positions: file line numbers and sorted row numbers, without a single-task window.

Rows are counted per split (of a file) or per block of neighbouring values, and the counts are
summed up level by level: inside groups of a million neighbouring keys (or files) by a window
each, then over the sums of the groups, until at most a few dozen sums are left. Nothing is kept
between runs: splits and blocks are properties of the input, so a recomputation after a lost
executor finds the same numbers.
"""

from __future__ import annotations

import re

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

#: Bits of a key that tell the members of one group apart.
GROUP_BITS = 20


def prefix_sums(counts: DataFrame, levels: int) -> DataFrame:
    """``(key, before)``: the sum of ``n`` over all smaller keys. ``counts``: key (a unique long), n.

    ``levels`` times, keys are grouped by their bits above the lowest 20; what is left after that
    has to be few (keys of 64 bits: three levels leave 16).
    """
    if levels == 0:
        everything = counts.agg(F.collect_list(F.struct("key", "n")).alias("_all"))
        smaller = "aggregate(filter(_all, x -> x.key < key), 0L, (a, x) -> a + x.n)"
        return counts.crossJoin(everything).selectExpr("key", f"{smaller} AS before")  # one row on the right
    grouped = counts.selectExpr("key", "n", f"shiftright(key, {GROUP_BITS}) AS _up")
    above = prefix_sums(grouped.groupBy(F.col("_up").alias("key")).agg(F.sum("n").alias("n")), levels - 1)
    inside = Window.partitionBy("_up").orderBy("key").rowsBetween(Window.unboundedPreceding, -1)
    grouped = grouped.select("key", "_up", F.coalesce(F.sum("n").over(inside), F.lit(0).cast("long")).alias("_inside"))
    return grouped.join(above.select(F.col("key").alias("_up"), "before"), "_up").selectExpr("key", "_inside + before AS before")


#: Splits whose row counts may be broadcast (some 30 MB).
BROADCAST_SPLITS = 200_000


#: The scheme of a path and the slashes behind it, of which different parts of Spark write one or three.
SCHEME = r"^([A-Za-z][A-Za-z0-9+.-]*):/+"


def _plain(path: str) -> str:
    return re.sub(SCHEME, r"\1:/", path)


def _most_splits(text: DataFrame, files: int) -> int:
    """A bound on the splits of a text scan, from the sizes that the scan has listed."""
    conf = text.sparkSession._jsparkSession.sessionState().conf()
    size = int(text._jdf.queryExecution().optimizedPlan().stats().sizeInBytes())
    return files + size // max(min(conf.filesMaxPartitionBytes(), conf.filesOpenCostInBytes()), 1)


def numbered_lines(spark: SparkSession, path: str, skip_blank: bool = False) -> DataFrame:
    """Lines of a text file (or folder of part files, by name) with their position: value, line_no.

    A line's place in its split comes from a counter of the scan. The text is scanned twice,
    once to count: keeping it in between would cost more than reading it again. The counts are
    broadcast where there are few splits, so that lines stay where they are read; beyond
    that, lines are shuffled to them.
    """
    text = spark.read.text(path)
    lines = text.select(
        "value", F.col("_metadata.file_path").alias("_file"),
        F.col("_metadata.file_block_start").alias("_start"),
    )
    if skip_blank:
        lines = lines.where(F.trim("value") != "")
    lines = lines.withColumn("_mid", F.monotonically_increasing_id())
    splits = lines.groupBy("_file", "_start").agg(F.count(F.lit(1)).alias("_n"), F.min("_mid").alias("_first"))
    # The order of the files is the scan's own listing, which the driver holds anyway.
    names = sorted(_plain(name) for name in text.inputFiles())
    ranks = spark.createDataFrame([(name, k) for k, name in enumerate(names)], "_name string, _rank bigint")
    plain = F.regexp_replace("_file", SCHEME, "$1:/")
    splits = splits.join(ranks, plain == F.col("_name")).withColumn("_group", F.shiftright("_rank", GROUP_BITS))
    along = Window.partitionBy("_group").orderBy("_rank", "_start").rowsBetween(Window.unboundedPreceding, -1)
    before = F.coalesce(F.sum("_n").over(along), F.lit(0).cast("long"))
    splits = splits.select("_file", "_start", "_first", "_n", "_group", before.alias("_before"))
    if len(names) > 1 << GROUP_BITS:
        totals = splits.groupBy(F.col("_group").alias("key")).agg(F.sum("_n").alias("n"))
        earlier = prefix_sums(totals, 1).select(F.col("key").alias("_group"), F.col("before").alias("_earlier"))
        splits = splits.join(earlier, "_group").withColumn("_before", F.col("_before") + F.col("_earlier"))
    splits = splits.select("_file", "_start", "_first", "_before")
    if _most_splits(text, len(names)) <= BROADCAST_SPLITS:
        splits = F.broadcast(splits)
    numbered = lines.join(splits, ["_file", "_start"])
    return numbered.select("value", (F.col("_before") + F.col("_mid") - F.col("_first")).alias("line_no"))


def row_positions(df: DataFrame, order_col: str, out: str = "position") -> DataFrame:
    """Rows with their 0-based rank in the order of a column of whole numbers, dates or times (unique, not null).

    Rows are dealt out by blocks of 2**20 neighbouring values, so a task ranks a million rows
    of a block at the most, and counts per block say where each block begins.
    """
    kind = df.schema[order_col].dataType.typeName()
    if kind not in ("byte", "short", "integer", "long", "date", "timestamp", "timestamp_ntz"):
        raise TypeError(f"{order_col} is a {kind}; rows are ranked by whole numbers, dates or times")
    value = F.col(order_col)
    if kind == "date":
        value = F.unix_date(value)
    elif kind.startswith("timestamp"):
        value = F.unix_micros(value.cast("timestamp"))
    block = F.shiftright(value.cast("long"), GROUP_BITS)
    counts = df.groupBy(block.alias("key")).agg(F.count(F.lit(1)).alias("n"))
    starts = prefix_sums(counts, 2).select(F.col("key").alias("_block"), "before")
    inside = F.row_number().over(Window.partitionBy("_block").orderBy(order_col))
    ranked = df.withColumn("_block", block).withColumn("_inside", inside)
    position = (F.col("before") + F.col("_inside") - 1).alias(out)
    return ranked.join(starts, "_block").select(*df.columns, position)


def page(df: DataFrame, n: int, k: int, order_col: str = "cell") -> DataFrame:
    """Page ``k`` (from 0) of ``n`` rows in the order of a column."""
    positions = row_positions(df, order_col)
    return positions.where((F.col("position") >= n * k) & (F.col("position") < n * (k + 1))).drop("position")
