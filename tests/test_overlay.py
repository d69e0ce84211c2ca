"""Coverage fractions against polygon clipping, and their invariants."""

import math

import numpy as np
import pytest
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from tidegrid.functions.grid import GridMeta
from tidegrid.operators.overlay import attach_cell_attributes, coverage_fraction, tessellate

META = GridMeta(12, 9, (0.5, 0.0, -3.0, 0.0, -0.25, 2.0))
RINGS = "pg_id bigint, ring array<struct<x:double,y:double>>"


def clipped_area(ring, x0, y0, x1, y1):
    """Area of a polygon inside a rectangle, by successive half-plane clipping."""
    def clip(points, inside, cross):
        out = []
        for p, q in zip(points, points[1:] + points[:1]):
            if inside(p):
                out.append(p)
            if inside(p) != inside(q):
                out.append(cross(p, q))
        return out

    def at_x(x):
        return lambda p, q: (x, p[1] + (q[1] - p[1]) * (x - p[0]) / (q[0] - p[0]))

    def at_y(y):
        return lambda p, q: (p[0] + (q[0] - p[0]) * (y - p[1]) / (q[1] - p[1]), y)

    pts = list(ring)
    for inside, cross in (
        (lambda p: p[0] >= x0, at_x(x0)), (lambda p: p[0] <= x1, at_x(x1)),
        (lambda p: p[1] >= y0, at_y(y0)), (lambda p: p[1] <= y1, at_y(y1)),
    ):
        pts = clip(pts, inside, cross)
        if not pts:
            return 0.0
    return abs(sum(p[0] * q[1] - q[0] * p[1] for p, q in zip(pts, pts[1:] + pts[:1]))) / 2


def brute(ring, meta):
    out = {}
    area = abs(meta.a * meta.e)
    for r in range(meta.height):
        for c in range(meta.width):
            xs = sorted((meta.c + c * meta.a, meta.c + (c + 1) * meta.a))
            ys = sorted((meta.f + r * meta.e, meta.f + (r + 1) * meta.e))
            share = clipped_area(ring, xs[0], ys[0], xs[1], ys[1]) / area
            if share > 1e-9:
                out[r * meta.width + c + 1] = share
    return out


def check(spark, rings, meta=META):
    rows = [(i, [{"x": float(x), "y": float(y)} for x, y in ring]) for i, ring in enumerate(rings)]
    got = coverage_fraction(spark.createDataFrame(rows, RINGS), meta).collect()
    table = {(r["pg_id"], r["cell"]): r["coverage_fraction"] for r in got}
    assert len(table) == len(got)
    want = {(i, cell): share for i, ring in enumerate(rings) for cell, share in brute(ring, meta).items()}
    for key in set(table) | set(want):
        assert table.get(key, 0.0) == pytest.approx(want.get(key, 0.0), abs=2e-9), key


FIXED = {
    "covers the whole grid": [(-9, -9), (9, -9), (9, 9), (-9, 9)],
    "exactly one cell": [(-2.5, 1.75), (-2.0, 1.75), (-2.0, 1.5), (-2.5, 1.5)],
    "clockwise and counter-clockwise agree": [(-2.5, 1.5), (-2.0, 1.5), (-2.0, 1.75), (-2.5, 1.75)],
    "edges on grid lines": [(-3, 2), (0, 2), (0, 0)],
    "left of the grid": [(-9, 0), (-4, 0), (-4, 1)],
    "right of the grid": [(4, 0), (9, 0), (9, 1)],
    "straddles the left border": [(-6, -0.2), (-1.3, 0.9), (-5, 1.9)],
    "straddles the right border": [(2.2, 1.9), (6, 0.3), (1.1, -0.1)],
    "above and below": [(-1, 9), (0.7, -9), (1.3, 9)],
    "thin sliver": [(-2.9, 1.9), (2.9, -0.2), (2.9, -0.2000001)],
    "concave": [(-2, 1.8), (2, 1.8), (2, 0), (0, 1.4), (-2, 0)],
    "quad": [(-2.2, 1.7), (1.6, 1.1), (1.9, -0.1), (-1.1, 0.2)],
    "repeated closing vertex": [(-2.2, 1.7), (1.6, 1.1), (-1.1, 0.2), (-2.2, 1.7)],
    "zero area": [(-1, 1), (1, 1), (0, 1)],
    "vertical line": [(-1, 1), (-1, 0), (-1, 0.5)],
}


def test_fixed_shapes(spark):
    check(spark, list(FIXED.values()))


coordinate = st.floats(-5, 5, allow_nan=False).map(lambda v: round(v, 3))
triangle = st.lists(st.tuples(coordinate, coordinate), min_size=3, max_size=3)


@settings(max_examples=6, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(st.lists(triangle, min_size=20, max_size=20))
def test_random_triangles(spark, rings):
    check(spark, rings)


def test_grid_with_upward_rows(spark):
    check(spark, [FIXED["quad"], FIXED["concave"]], GridMeta(12, 9, (0.5, 0.0, -3.0, 0.0, 0.25, -0.25)))


def test_sum_of_cells_is_the_polygon_area(spark):
    ring = [(-2.2, 1.7), (1.6, 1.1), (1.9, -0.1), (-1.1, 0.2)]
    rows = [(1, [{"x": x, "y": y} for x, y in ring])]
    total = coverage_fraction(spark.createDataFrame(rows, RINGS), META).agg(F.sum("coverage_fraction")).first()[0]
    area = abs(sum(p[0] * q[1] - q[0] * p[1] for p, q in zip(ring, ring[1:] + ring[:1]))) / 2
    assert total * abs(META.a * META.e) == pytest.approx(area, rel=1e-12)


def test_mesh_covers_each_cell_at_most_once(spark, sf):
    from fixtures import views

    worst = views.overlay(spark, sf).groupBy("cell").agg(F.sum("coverage_fraction").alias("s")).agg(F.max("s")).first()[0]
    assert worst <= 1 + 1e-9


def test_one_huge_polygon_is_spread_over_tasks(spark):
    """A polygon over every cell must not be one task's work."""
    meta = GridMeta(400, 300, (1.0, 0.0, 0.0, 0.0, -1.0, 300.0))
    ring = [{"x": x, "y": y} for x, y in ((-1.0, -1.0), (401.0, -1.0), (401.0, 301.0), (-1.0, 301.0))]
    df = coverage_fraction(spark.createDataFrame([(1, ring)], RINGS), meta)
    assert df.count() == meta.cells
    sizes = [r["count"] for r in df.groupBy(F.spark_partition_id()).count().collect()]
    assert len(sizes) >= 6
    assert max(sizes) < meta.cells / 3


def test_empty_input(spark):
    empty = spark.createDataFrame([], RINGS)
    assert coverage_fraction(empty, META).count() == 0
    assert tessellate(empty).count() == 0


def test_null_and_empty_rings_give_no_rows(spark):
    df = spark.createDataFrame([(1, None), (2, [])], RINGS)
    assert coverage_fraction(df, META).count() == 0


def test_unmasked_cells_are_false_never_null(spark):
    overlay = spark.createDataFrame([(1, 1, 0.5), (1, 2, 0.5), (1, 3, 0.5)], "pg_id bigint, cell bigint, coverage_fraction double")
    cells = spark.createDataFrame([(1, 2.0, None), (2, 3.0, True)], "cell bigint, elevation double, mask boolean")
    hot = spark.createDataFrame([(1, 3)], "cell bigint, salts int")
    for listed in (None, hot):
        rows = attach_cell_attributes(overlay, cells, listed).collect()
        assert len(rows) == 3
        assert {r["cell"]: (r["elevation"], r["mask"]) for r in rows} == {
            1: (2.0, False), 2: (3.0, True), 3: (None, False)}


def test_tessellation_lists_a_feature_per_tile(spark):
    rows = [(1, [{"x": x, "y": y} for x, y in ((0.0, 0.0), (10.0, 0.0), (10.0, 10.0), (0.0, 10.0))]),
            (2, [{"x": x, "y": y} for x, y in ((0.1, 9.1), (0.9, 9.1), (0.5, 9.9))])]
    got = tessellate(spark.createDataFrame(rows, RINGS), 10).collect()
    assert sum(r["pg_id"] == 1 for r in got) == 100
    assert [r["tile_id"] for r in got if r["pg_id"] == 2] == [1]


def test_clipping_helper_itself():
    assert clipped_area([(0, 0), (2, 0), (2, 2), (0, 2)], 1, 1, 3, 3) == 1
    assert math.isclose(clipped_area([(0, 0), (1, 0), (0, 1)], 0, 0, 1, 1), 0.5)
    assert np.isclose(clipped_area([(5, 5), (6, 5), (5, 6)], 0, 0, 1, 1), 0)
