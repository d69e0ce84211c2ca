"""Weights, triangle values, zonal means: edge cases and invariants."""

import math

import numpy as np
import pytest
from pyspark.sql import functions as F

from tidegrid.operators import skew
from tidegrid.operators import weights as wt
from tidegrid.operators import zonal as zo

ELEMENTS = "pg_id bigint, node_id_1 bigint, node_id_2 bigint, node_id_3 bigint"
NODES = "node_id bigint, long double, lat double, elevation double"


def weights_of(spark, points):
    """Weights of one triangle with the given (x, y, z) corners."""
    nodes = spark.createDataFrame([(i, *map(float, p)) if p[2] is not None else (i, float(p[0]), float(p[1]), None)
                                   for i, p in enumerate(points, 1)], NODES)
    row = wt.barycentric_weights(spark.createDataFrame([(1, 1, 2, 3)], ELEMENTS), nodes).first()
    return [row[f"node{k}_weight"] for k in (1, 2, 3)]


def expected(points):
    p = np.array(points, dtype=float)

    def slope(i):
        total = 0.0
        for j in range(3):
            if j != i:
                run = math.hypot(*(p[j] - p[i])[:2])
                total += abs((p[j] - p[i])[2] / run) if run else 0.0
        return total / 2

    s = np.array([slope(i) for i in range(3)])
    w = s / s.sum() if s.sum() else np.full(3, wt.FLAT_WEIGHT)
    c = w @ p
    area = np.array([np.linalg.norm(np.cross(p[(i + 1) % 3] - c, p[(i + 2) % 3] - c)) for i in range(3)])
    return area / area.sum()


@pytest.mark.parametrize("points", [
    [(0, 0, 1), (1, 0, 2), (0, 1, 4)],
    [(0, 0, -3), (0.01, 0, 2), (0, 0.02, 4)],
    [(0, 0, 5), (3, 1, 5), (1, 4, 5)],  # flat
    [(0, 0, 1), (0, 0, 2), (1, 1, 0)],  # two vertices at one place
    [(-80.1, 27.2, 0.1), (-80.0, 27.25, 0.1), (-80.05, 27.4, 3.0)],
])
def test_weights(spark, points):
    assert weights_of(spark, points) == pytest.approx(list(expected(points)), abs=1e-9)


def test_random_weights_sum_to_one_and_match(spark):
    rng = np.random.default_rng(5)
    pts = rng.normal(size=(300, 3))
    ids = np.array([rng.choice(300, 3, replace=False) for _ in range(400)]) + 1
    nodes = spark.createDataFrame([(i + 1, *map(float, p)) for i, p in enumerate(pts)], NODES)
    elements = spark.createDataFrame([(i, *map(int, t)) for i, t in enumerate(ids)], ELEMENTS)
    for row in wt.barycentric_weights(elements, nodes).collect():
        got = [row[f"node{k}_weight"] for k in (1, 2, 3)]
        assert sum(got) == pytest.approx(1, abs=1e-9)
        assert got == pytest.approx(list(expected(pts[ids[row["pg_id"]] - 1])), abs=1e-6)


@pytest.mark.parametrize("points", [
    [(0, 0, 1), (1, 1, 2), (2, 2, 3)],  # on one line in space: no area
    [(0, 0, 1), (0, 0, 1), (0, 0, 1)],
    [(0, 0, None), (1, 0, 2), (0, 1, 3)],
    [(0, 0, math.nan), (1, 0, 2), (0, 1, 3)],
])
def test_weights_without_a_value(spark, points):
    assert weights_of(spark, points) == [None, None, None]


def test_missing_vertex_keeps_the_triangle(spark):
    nodes = spark.createDataFrame([(1, 0.0, 0.0, 1.0), (2, 1.0, 0.0, 2.0)], NODES)
    row = wt.barycentric_weights(spark.createDataFrame([(1, 1, 2, 3)], ELEMENTS), nodes).first()
    assert row["node1_weight"] is None and row["node3_weight"] is None


WEIGHTS = ELEMENTS + ", node1_weight double, node2_weight double, node3_weight double"
WSE = "node_id bigint, long double, lat double, wse double"


def test_barycentric_null_rules(spark):
    third = 1 / 3
    weights = spark.createDataFrame([(1, 1, 2, 3, third, third, third), (2, 1, 2, 9, third, third, third),
                                     (3, 1, 2, 4, third, third, third)], WEIGHTS)
    nodes = spark.createDataFrame([(1, 0.0, 0.0, 1.0), (2, 3.0, 0.0, 2.0), (3, 0.0, 3.0, 3.0), (4, 0.0, 3.0, None)], WSE)
    got = {r["pg_id"]: r for r in wt.triangle_barycentric(weights, nodes).collect()}
    assert got[1]["wse_weighted_average"] == pytest.approx(2.0) and got[1]["centroid_long"] == pytest.approx(1.0)
    assert got[2]["wse_weighted_average"] is None and got[2]["centroid_long"] is None
    assert got[3]["wse_weighted_average"] is None and got[3]["centroid_lat"] == pytest.approx(1.0)
    assert wt.triangle_vertices(weights, nodes).count() == 2


COV = "pg_id bigint, cell bigint, coverage_fraction double, elevation double, mask boolean"
TRI = "pg_id bigint, wse_weighted_average double"


@pytest.fixture(scope="module")
def coverage(spark):
    return spark.createDataFrame([
        (1, 10, 0.5, 1.0, False), (2, 10, 0.5, 1.0, False),   # triangle 2 has no level: dilution
        (2, 11, 1.0, 1.0, False),                             # only NULL levels
        (1, 12, 0.25, None, False), (1, 13, 1.0, math.nan, False),
        (1, 14, 1.0, 5.0, True), (1, 15, 1.0, 5.0, None), (3, 16, 0.0, 1.0, False),
        (1, 17, 1.0, 4.0, False), (1, 18, 1.0, 3.9, False),
    ], COV)


@pytest.fixture(scope="module")
def triangles(spark):
    return spark.createDataFrame([(1, 4.0), (2, None), (3, 1.0)], TRI)


def test_strict_mask_filter(coverage):
    assert {r["cell"] for r in zo.filter_masked(coverage).collect()} == {10, 11, 16, 17, 18}
    assert {r["cell"] for r in zo.filter_masked(coverage, 3.9).collect()} == {17, 18}


def test_dilution_and_renormalisation(coverage, triangles):
    plain = {r["cell"]: r["wse_cell_weighted_average"] for r in zo.cell_wse(coverage, triangles).collect()}
    assert plain[10] == pytest.approx(2.0) and plain[11] is None and plain[16] is None
    full = {r["cell"]: r["wse_cell_weighted_average"] for r in zo.cell_wse(coverage, triangles, True).collect()}
    assert full[10] == pytest.approx(4.0) and full[11] is None


def test_depth_threshold_and_legacy(coverage, triangles):
    got = {r["cell"]: r["depth"] for r in zo.depth(coverage, triangles).collect()}
    assert set(got) == {10, 17, 18} and got[17] == 0.0
    assert {r["cell"] for r in zo.depth(coverage, triangles, 0.05).collect()} == {10, 18}
    legacy = {r["cell"]: r["depth"] for r in zo.depth_legacy(coverage, triangles).collect()}
    assert legacy == pytest.approx(got)


def test_constant_level_stays_constant(spark, sf):
    from fixtures import views

    cov = views.coverage(spark, sf)
    flat = cov.select("pg_id").distinct().withColumn("wse_weighted_average", F.lit(2.5))
    spread = zo.cell_wse(cov, flat).agg(F.min("wse_cell_weighted_average"), F.max("wse_cell_weighted_average")).first()
    assert spread[0] == pytest.approx(2.5) and spread[1] == pytest.approx(2.5)


def test_outputs_follow_the_flags(coverage, triangles):
    df = zo.depth(coverage, triangles)
    assert zo.select_outputs(df, False, False) is None
    assert zo.select_outputs(df, True, True).columns == ["cell", "wse_cell_weighted_average", "depth"]


def test_masked_depth_keeps_rows(coverage, triangles):
    df = zo.mask_depth(zo.depth(coverage, triangles), 0.5, -9999.0)
    assert {r["cell"]: r["depth"] for r in df.collect()}[17] == -9999.0 and df.count() == 3


def test_one_triangle_with_a_third_of_the_rows(spark):
    """A hot triangle: same result as the plain join, and its rows reach many tasks."""
    cov = spark.range(30000).select(
        F.when(F.col("id") % 3 == 0, F.lit(7)).otherwise(F.col("id")).cast("long").alias("pg_id"),
        (F.col("id") % 9000).alias("cell"), (F.rand(1) + 0.01).alias("coverage_fraction"), F.lit(0.5).alias("elevation"),
    )
    tri = spark.range(30000).select(F.col("id").alias("pg_id"), (F.col("id") % 17 + 1.0).alias("wse_weighted_average"))
    hot = skew.hot_keys(cov, "pg_id", 500)
    assert [(r["pg_id"], r["salts"]) for r in hot.collect()] == [(7, 21)]
    salted = skew.add_salt(cov, "pg_id", hot, "cell").where("pg_id = 7").groupBy(skew.SALT).count()
    assert max(r["count"] for r in salted.collect()) < 1000
    plain = {r["cell"]: r["depth"] for r in zo.depth(cov, tri).collect()}
    spread = {r["cell"]: r["depth"] for r in zo.depth(cov, tri, hot=hot).collect()}
    assert spread == pytest.approx(plain) and len(plain) == 9000


def test_many_runs_equal_single_runs(spark, sf):
    from fixtures import views
    from fixtures.queries_core import ready_nodes, slope_weights

    cov = zo.filter_masked(views.coverage(spark, sf))
    weights, ready = slope_weights(spark, sf), ready_nodes(spark, sf)
    runs = None
    for i, factor in enumerate((1.0, 0.7)):
        part = ready.where(F.col("node_id") % 10 != i).select(
            F.lit(f"r{i}").alias("run_id"), "node_id", "long", "lat", (F.col("wse") * factor).alias("wse"))
        runs = part if runs is None else runs.unionByName(part)
    many = zo.depth_runs(cov, zo.triangle_wse_runs(weights, runs))
    for i in (0, 1):
        single = zo.depth(cov, wt.triangle_barycentric(weights, runs.where(F.col("run_id") == f"r{i}")))
        want = {r["cell"]: r["depth"] for r in single.collect()}
        got = {r["cell"]: r["depth"] for r in many.where(F.col("run_id") == f"r{i}").collect()}
        assert len(want) > 100 and got == pytest.approx(want, abs=1e-9)


def test_first_per_key(spark):
    df = spark.createDataFrame([(1, 2, "b", None), (1, 1, None, None), (1, 3, "c", 5)], "k int, o int, s string, n int")
    assert tuple(zo.first_per_key(df, "k", "o").first()) == (1, 1, "b", 5)
    assert zo.first_per_key(df, "k").count() == 1


def test_generated_code_stays_compilable(spark, sf):
    """Methods over 8,000 bytes are interpreted by the JVM, and over 64 KB cannot be built."""
    from __spark_entry__ import queries

    spark.conf.set("spark.sql.adaptive.enabled", "false")
    try:
        for name in ("barycentric_weights", "triangle_barycentric", "coverage_fraction", "general_mask", "depth"):
            stages = queries()[name](spark, sf)._jdf.queryExecution().debug().codegenToSeq()
            sizes = [stages.apply(i)._3().maxMethodCodeSize() for i in range(stages.size())]
            assert 0 < max(sizes) < 8000, (name, max(sizes))
    finally:
        spark.conf.set("spark.sql.adaptive.enabled", "true")
