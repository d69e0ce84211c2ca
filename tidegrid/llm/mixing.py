"""Mixing sources to target weights by Pfair scheduling.

Rows of a source, in an order that a hash gives, make blocks. Of a source with the share w of all
weights, block j is released at ``floor(j / w)`` and due at ``ceil((j + 1) / w)``, and at every slot the
released block of the earliest deadline goes next. Shares are exact fractions of the weights as they
are written, not rounded to a period. Until the first source runs out, each has at every slot its
target number of blocks, by less than one, however long the mixture is. Nothing is dropped:
afterwards the slots of sources that ran out stay empty.

The schedule is made in one task, which holds a row per source and hands on one row per block as it goes. Ranks
within a source come from counts per hash bucket, so that a source of any size is spread over
buckets of bounded size, and each bucket gets the slots of its blocks.

Defined results: a null source is a source; sources without a weight, or with none above 0, have no
share and come behind the others, in equal shares; every weight above 0 counts, however small, and
only empty slots behind ``LAST_SLOT`` are left out of the count, so that slots stay in 64 bits
(releases and deadlines that do not fit are null); equal rows share their rank order; an empty table
gives an empty result; columns of the input stay, whatever their names, and the four new ones replace
namesakes.
"""

from __future__ import annotations

import heapq
import itertools
import math
from collections.abc import Iterator
from fractions import Fraction

import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tidegrid.llm.common import store
from tidegrid.session import ship_package

#: Empty slots are counted up to this one; behind it only slots with a block are.
LAST_SLOT = 1 << 50
#: Rows of a block, and rows of a hash bucket on average.
BLOCK_ROWS, BUCKET_ROWS = 32, 20_000
#: Without weights, a source of n rows has the weight n ** TEMPERATURE.
TEMPERATURE = 0.5


def earliest_first(weights: list[int], blocks: list[int]) -> Iterator[tuple[int, int, int, int, int]]:
    """``(source, block, release, deadline, slot)`` of so many blocks per source, earliest deadline first.

    Weights are whole numbers above 0 whose sum stands for one block per slot.
    """
    total = sum(weights)
    coming = [(0, i, 0) for i, n in enumerate(blocks) if n]
    heapq.heapify(coming)
    waiting: list[tuple[int, int, int, int]] = []
    t = left_out = 0
    while coming or waiting:
        if not waiting and coming[0][0] > t:
            slot = max(t - left_out, min(coming[0][0] - left_out, LAST_SLOT))
            t = coming[0][0]
            left_out = t - slot
        while coming and coming[0][0] <= t:
            release, i, j = heapq.heappop(coming)
            heapq.heappush(waiting, (-(-(j + 1) * total // weights[i]), i, j, release))
            if j + 1 < blocks[i]:
                heapq.heappush(coming, ((j + 1) * total // weights[i], i, j + 1))
        deadline, i, j, release = heapq.heappop(waiting)
        yield i, j, release, deadline, t - left_out
        t += 1


def mixture(weights: list[float], blocks: list[int]) -> Iterator[tuple[int, int, int, int, int]]:
    """``(source, block, release, deadline, slot)`` of all blocks, sources without a share behind the others."""
    exact = {i: Fraction(repr(float(x))) for i, x in enumerate(weights) if x is not None and math.isfinite(x) and x > 0}
    unit = math.lcm(*(w.denominator for w in exact.values()))
    end = 0
    for group, whole in ((list(exact), [int(w * unit) for w in exact.values()]),
                         (rest := [i for i in range(len(weights)) if i not in exact], [1] * len(rest))):
        begin = end
        for k, j, release, deadline, slot in earliest_first(whole, [blocks[i] for i in group]):
            yield group[k], j, begin + release, begin + deadline, begin + slot
            end = max(end, begin + min(deadline, max(slot + 1, LAST_SLOT)))


def _plan(sources: DataFrame, block_rows: int) -> DataFrame:
    """``(of, block, release, deadline, slot)`` of every block, from ``(of, n, weight)``."""
    def fitting(numbers: pd.Series) -> pd.Series:
        return pd.Series([n if n < 1 << 63 else None for n in numbers], dtype="Int64")

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        parts = [b for b in batches if len(b)]
        if not parts:
            return
        rows = pd.concat(parts).sort_values("of").reset_index(drop=True)
        made = mixture(rows["weight"].tolist(), [-(-n // block_rows) for n in rows["n"].tolist()])
        while some := list(itertools.islice(made, 10_000)):
            i, block, release, deadline, slot = zip(*some)
            yield pd.DataFrame({"of": rows["of"].iloc[list(i)].values, "block": block, "release": fitting(release),
                                "deadline": fitting(deadline), "slot": slot})

    ship_package(sources.sparkSession)
    return sources.repartition(1).mapInPandas(run, "of string, block long, release long, deadline long, slot long")


def mix_sources(docs: DataFrame, weights: DataFrame | None = None, block_rows: int = BLOCK_ROWS,
                source_col: str = "source") -> DataFrame:
    """``docs`` with ``release``, ``deadline``, ``slot`` and ``position``; sorted by position they are the mixture.

    ``weights`` is ``(source, weight)``. Release, deadline and slot count blocks, position counts rows.
    """
    # A source is named behind a sign, null by the empty string: joins by it need no care for nulls.
    def named(c: Column) -> Column:
        return F.coalesce(F.concat(F.lit("="), c.cast("string")), F.lit(""))

    counts = store(docs.groupBy(named(F.col(source_col)).alias("of")).agg(F.count("*").alias("n")))
    if weights is None:
        sources = counts.select("of", "n", F.pow(F.col("n"), F.lit(TEMPERATURE)).alias("weight"))
    else:
        given = weights.groupBy(named(F.col("source")).alias("of")).agg(F.sum("weight").cast("double").alias("weight"))
        sources = counts.join(given, "of", "left").select("of", "n", F.coalesce("weight", F.lit(0.0)).alias("weight"))

    buckets = max(1, -(-(counts.agg(F.sum("n")).first()[0] or 0) // BUCKET_ROWS))
    rows = docs.select(F.struct("*").alias("row"), named(F.col(source_col)).alias("of"))
    rows = rows.withColumn("order", F.xxhash64("row"))
    rows = rows.withColumn("bucket", F.pmod("order", F.lit(buckets)))
    sizes = rows.groupBy("of", "bucket").agg(F.count("*").alias("size"))
    earlier = Window.partitionBy("of").orderBy("bucket").rowsBetween(Window.unboundedPreceding, -1)
    offsets = sizes.select("of", "bucket", "size", F.coalesce(F.sum("size").over(earlier), F.lit(0)).alias("offset"))
    first, last = F.floor(F.col("offset") / block_rows), F.floor((F.col("offset") + F.col("size") - 1) / block_rows)
    wanted = offsets.select("of", "bucket", "offset", F.explode(F.sequence(first, last)).alias("block"))
    places = store(wanted.join(_plan(sources, block_rows), ["of", "block"]).groupBy("of", "bucket", "offset").agg(
        F.array_sort(F.collect_list(F.struct("block", "release", "deadline", "slot"))).alias("plan")))

    within = Window.partitionBy("of", "bucket").orderBy("order")
    ranked = rows.withColumn("within", F.row_number().over(within) - 1)
    rank = F.col("offset") + F.col("within")
    at = F.floor(rank / block_rows) - F.floor(F.col("offset") / block_rows)
    found = ranked.join(places, ["of", "bucket"]).select("row", rank.alias("rank"), F.get("plan", at.cast("int")).alias("p"))
    new = {"release": F.col("p.release"), "deadline": F.col("p.deadline"), "slot": F.col("p.slot"),
           "position": F.col("p.slot") * block_rows + F.pmod("rank", F.lit(block_rows))}
    kept = [F.col("row")[c].alias(c) for c in docs.columns if c not in new]
    return found.select(*kept, *[c.cast("long").alias(name) for name, c in new.items()])
