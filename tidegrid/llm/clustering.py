"""Centroid clustering in whole numbers, each round by a Shallot search.

A vector keeps, from round to round, its nearest and second-nearest centroid, a bound from
above on its distance to the nearest and one from below on its distance to all others. When
the centroids have moved, the bounds move with them; a vector whose bounds still part is not
looked at. For any other, both remembered centroids are measured and the scan starts from the
closer one: the other centroids stand sorted by their distance from it, and only those inside
a ball of radius (distance to the start) + (distance to the second nearest so far) can matter.
The ball shrinks whenever the second nearest does, and the scan of a vector ends at its rim.
Bounds are floating-point numbers with a margin, so they only ever spare work; whatever is
compared to decide is a squared distance in integers.

Spark keeps the vectors apart: a round is one pass over a stored table, the new centroids one
aggregation of 64 sums with partial sums per task, so a cluster with a third of all rows is no
group anywhere. The driver sees k rows per round.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidegrid.llm.common import store
from tidegrid.session import ship_package

#: Components up to this size leave squared distances of 64 components inside a long.
LARGEST = 1 << 27

#: Relative margin of the bounds; errors of a square root are a thousand times smaller.
MARGIN = 1e-12

STATE = "vec_id long, q array<int>, near int, second int, upper double, lower double, distance long"


def whole_vectors(vectors: DataFrame, id_col: str, vec_col: str, dims: int, scale: int) -> DataFrame:
    """``(vec_id, q)``: vectors of ``dims`` finite components, each component as floor(scale * x).

    Null vectors, other lengths, and null or non-finite components leave a row out. A
    component beyond an int stops the job, and so does one over :data:`LARGEST` later.
    """
    x = F.col(vec_col).cast("array<double>")
    finite = F.forall("x", lambda v: v.isNotNull() & ~F.isnan(v) & (F.abs(v) < F.lit(float("inf"))))
    kept = vectors.select(F.col(id_col).cast("long").alias("vec_id"), x.alias("x")).where((F.size("x") == dims) & finite)
    return kept.select("vec_id", F.transform("x", lambda v: F.floor(v * F.lit(float(scale))).cast("int")).alias("q"))


def first_centroids(whole: DataFrame, k: int, seed: str) -> np.ndarray:
    """The vectors with the k smallest hashes of ``seed:vec_id``.

    Rows that repeat an id stand in the order of their components; null ids come last.
    """
    chosen = F.sha2(F.concat(F.lit(f"{seed}:"), F.col("vec_id").cast("string")).cast("binary"), 256)
    rows = whole.select(chosen.alias("sha"), "q").orderBy(F.col("sha").asc_nulls_last(), "q").limit(k).collect()
    return np.array([r["q"] for r in rows], dtype=np.int64)


def _squares(x: np.ndarray, c: np.ndarray) -> np.ndarray:
    gap = x - c
    return np.einsum("ij,ij->i", gap, gap)


class Centroids:
    """Centroids with all that a search asks of them: gaps between them, and neighbours by gap."""

    def __init__(self, places: np.ndarray, before: np.ndarray | None = None):
        self.places = places
        k = len(places)
        self.gap = np.sqrt(np.array([_squares(places, p) for p in places]).reshape(k, k).astype(float))
        self.order = np.argsort(self.gap, axis=1, kind="stable")
        apart = self.gap + np.diag(np.full(k, np.inf))
        self.half = apart.min(axis=1) / 2
        # What a move adds to the upper bound of a centroid's own vectors and takes from the lower one.
        moved = np.zeros(k) if before is None else np.sqrt(_squares(places, before).astype(float))
        self.moved = moved * (1 + MARGIN)
        self.others_moved = np.array([np.delete(self.moved, i).max(initial=0.0) for i in range(k)])


def shallot(x: np.ndarray, near: np.ndarray, second: np.ndarray, upper: np.ndarray, lower: np.ndarray,
            to: Centroids, exact: bool = False) -> tuple[np.ndarray, int]:
    """Bring ``near``, ``second`` and the bounds of vectors up to the centroids, in place.

    Returns each vector's squared distance to its nearest centroid (-1 for a vector that its
    bounds spared, none with ``exact``), and how many distances to other centroids were
    measured. Of equally near centroids the smaller number is nearest.
    """
    c, measured = to.places, 0
    rim = np.maximum(lower, to.half[near] * (1 - MARGIN))
    own = np.full(len(x), -1, np.int64)
    look = np.arange(len(x)) if exact else np.flatnonzero(~(upper < rim))
    own[look] = _squares(x[look], c[near[look]])
    upper[look] = np.sqrt(own[look]) * (1 + MARGIN)
    at = look[~(upper[look] < rim[look])]
    if len(c) == 1 or not len(at):
        return own, measured
    best, best_at = own[at], near[at]
    next_at = second[at]
    rival = _squares(x[at], c[next_at])
    measured += len(at)
    swap = (rival < best) | ((rival == best) & (next_at < best_at))
    best, rival = np.where(swap, rival, best), np.where(swap, best, rival)
    best_at, next_at = np.where(swap, next_at, best_at), np.where(swap, best_at, next_at)
    start, skip = best_at.copy(), next_at.copy()
    reach = np.sqrt(best)
    for s in np.unique(start):
        live = np.flatnonzero(start == s)
        for j in to.order[s]:
            if j == s:
                continue
            ball = (reach[live] + np.sqrt(rival[live])) * (1 + MARGIN)
            live = live[to.gap[s, j] * (1 - MARGIN) <= ball]
            if not len(live):
                break
            who = live[skip[live] != j]
            d = _squares(x[at[who]], c[j])
            measured += len(who)
            first = (d < best[who]) | ((d == best[who]) & (j < best_at[who]))
            inner = ~first & (d < rival[who])
            f, n = who[first], who[inner]
            rival[f], next_at[f] = best[f], best_at[f]
            best[f], best_at[f] = d[first], j
            rival[n], next_at[n] = d[inner], j
    own[at], near[at], second[at] = best, best_at, next_at
    upper[at], lower[at] = np.sqrt(best) * (1 + MARGIN), np.sqrt(rival) * (1 - MARGIN)
    return own, measured


def _assign(state: DataFrame, to: Centroids, exact: bool = False) -> DataFrame:
    """One pass: every vector with its nearest centroid, by the bounds it brings along."""
    k, dims = to.places.shape

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            n = batch.num_rows
            if not n:
                continue
            flat = np.asarray(batch["q"].flatten())
            if np.abs(flat.astype(np.int64)).max() > LARGEST:
                raise ValueError(f"a component is over {LARGEST}: its squared distances would not fit a long")
            x = flat.astype(np.int64).reshape(n, dims)
            if "near" in batch.schema.names:
                near, second = (batch[c].to_numpy(zero_copy_only=False).copy() for c in ("near", "second"))
                lower = batch["lower"].to_numpy(zero_copy_only=False) - to.others_moved[near]
                upper = batch["upper"].to_numpy(zero_copy_only=False) + to.moved[near]
            else:
                near, second = np.zeros(n, np.int32), np.full(n, min(1, k - 1), np.int32)
                upper, lower = np.full(n, np.inf), np.full(n, -np.inf)
            distance, _ = shallot(x, near, second, upper, lower, to, exact)
            yield pa.RecordBatch.from_arrays(
                [batch["vec_id"], batch["q"], *map(pa.array, (near, second, upper, lower, distance))],
                names=["vec_id", "q", "near", "second", "upper", "lower", "distance"])

    return state.mapInArrow(run, STATE)


def _means(state: DataFrame, places: np.ndarray) -> np.ndarray:
    """Component-wise floor of sum / count per cluster; an empty cluster keeps its centroid."""
    sums = [F.sum(F.col("q")[i].cast("long")).alias(f"s{i}") for i in range(places.shape[1])]
    moved = places.copy()
    for r in state.groupBy("near").agg(F.count(F.lit(1)).alias("n"), *sums).collect():
        moved[r["near"]] = [r[f"s{i}"] // r["n"] for i in range(places.shape[1])]
    return moved


def cluster_vectors(vectors: DataFrame, id_col: str = "vec_id", vec_col: str = "embedding", k: int = 16, rounds: int = 3,
                    dims: int = 64, scale: int = 64, seed: str = "1") -> DataFrame:
    """Clusters after ``rounds`` of assignment and means and one more assignment.

    Per kept vector (see :func:`whole_vectors`): vec_id, cluster, distance (squared),
    cluster_inertia, inertia and centroid (array). With fewer vectors than ``k`` there are
    fewer centroids; without any the result is empty. Repeated rows and null ids are vectors
    like others; further columns are not looked at.
    """
    spark = vectors.sparkSession
    ship_package(spark)
    whole = store(whole_vectors(vectors, id_col, vec_col, dims, scale))
    places = first_centroids(whole, k, seed)
    if not len(places):
        return whole.select("vec_id", *[F.lit(None).cast(t).alias(n) for n, t in (
            ("cluster", "int"), ("distance", "long"), ("cluster_inertia", "long"), ("inertia", "long"), ("centroid", "array<long>"))])
    state, before = whole, None
    for _ in range(rounds):
        state = store(_assign(state, Centroids(places, before)).drop("distance"))
        before, places = places, _means(state, places)
    final = store(_assign(state, Centroids(places, before), exact=True).select("vec_id", "near", "distance"))
    total = F.sum(F.col("distance").cast("decimal(38,0)"))
    inertia = {r["near"]: int(r["total"]) for r in final.groupBy("near").agg(total.alias("total")).collect()}
    about = spark.createDataFrame(  # k rows
        [(i, inertia.get(i, 0), sum(inertia.values()), p.tolist()) for i, p in enumerate(places)],
        "cluster int, cluster_inertia long, inertia long, centroid array<long>")
    return final.withColumnRenamed("near", "cluster").join(F.broadcast(about), "cluster").select(
        "vec_id", "cluster", "distance", "cluster_inertia", "inertia", "centroid")
