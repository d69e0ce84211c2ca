"""Mask runs against point tests on every cell centre."""

import math

import numpy as np
import pytest
from pyspark.sql import functions as F

from tidegrid.functions.geometry import wkt_rings
from tidegrid.functions.grid import GridMeta
from tidegrid.operators import masks as mk

META = GridMeta(40, 30, (0.25, 0.0, -5.03, 0.0, -0.2, 3.07))
SCHEMA = "layer string, feature_id bigint, ring array<struct<x:double,y:double>>"


def layer(spark, *rings, name="l"):
    rows = [(name, i, [{"x": float(x), "y": float(y)} for x, y in ring]) for i, ring in rings]
    return spark.createDataFrame(rows, SCHEMA)


def centers(meta):
    for r in range(meta.height):
        for c in range(meta.width):
            yield r, c, meta.c + (c + 0.5) * meta.a, meta.f + (r + 0.5) * meta.e


def edges(ring):
    return list(zip(ring, ring[1:] + ring[:1]))


def inside(x, y, rings):
    hits = 0
    for ring in rings:
        for (x1, y1), (x2, y2) in edges(ring):
            if min(y1, y2) <= y < max(y1, y2) and x1 + (y - y1) * (x2 - x1) / (y2 - y1) > x:
                hits += 1
    return hits % 2 == 1


def distance(x, y, rings):
    best = math.inf
    for ring in rings:
        for (x1, y1), (x2, y2) in edges(ring):
            length = (x2 - x1) ** 2 + (y2 - y1) ** 2
            t = 0 if length == 0 else min(max(((x - x1) * (x2 - x1) + (y - y1) * (y2 - y1)) / length, 0), 1)
            best = min(best, math.hypot(x - x1 - t * (x2 - x1), y - y1 - t * (y2 - y1)))
    return best


def cells(runs):
    rows = runs.select("row", F.explode(F.sequence("col_lo", "col_hi")).alias("col")).collect()
    found = [(r["row"], r["col"]) for r in rows]
    return found


SHAPES = {
    "star": [(-4, 2), (0, 0.3), (3.9, 2.6), (1, -0.7), (2.5, -2.6), (-0.4, -1.4), (-3.7, -2.2), (-1.6, -0.2)],
    "upright box": [(-2, 2), (1.1, 2), (1.1, -1), (-2, -1)],
    "beyond the grid": [(-20, 1.33), (20, 2.21), (20, -9), (-20, -8)],
    "tiny": [(0.01, 0.01), (0.02, 0.01), (0.02, 0.02)],
}


@pytest.mark.parametrize("shape", SHAPES)
def test_rasterize(spark, shape):
    ring = SHAPES[shape]
    got = cells(mk.rasterize_mask(layer(spark, (1, ring)), META))
    assert len(got) == len(set(got))
    assert set(got) == {(r, c) for r, c, x, y in centers(META) if inside(x, y, [ring])}


def test_holes_are_left_out(spark):
    outer, hole = SHAPES["beyond the grid"], SHAPES["upright box"]
    got = set(cells(mk.rasterize_mask(layer(spark, (1, outer), (1, hole)), META)))
    assert got == {(r, c) for r, c, x, y in centers(META) if inside(x, y, [outer, hole])}


def test_merged_runs_are_disjoint(spark):
    runs = mk.rasterize_mask(layer(spark, *[(i, s) for i, s in enumerate(SHAPES.values())]), META)
    got = cells(mk.merge_runs(runs))
    assert len(got) == len(set(got)) and set(got) == set(cells(runs))


@pytest.mark.parametrize("shape", SHAPES)
@pytest.mark.parametrize("radius", [0.11, 0.9, 3.0, 50.0])
def test_near_edge(spark, shape, radius):
    ring = SHAPES[shape]
    got = set(cells(mk.near_edge_runs(layer(spark, (1, ring)), META, radius)))
    assert got == {(r, c) for r, c, x, y in centers(META) if distance(x, y, [ring]) <= radius}


def test_general_mask(spark):
    state, domain, lake = SHAPES["upright box"], SHAPES["star"], SHAPES["tiny"]
    got = mk.general_mask(
        spark.range(1, META.cells + 1).withColumnRenamed("id", "cell"),
        [layer(spark, (1, domain)), layer(spark, (1, state))], [layer(spark, (1, lake))], META, 0.8,
    ).collect()
    assert len(got) == META.cells
    table = {r["cell"]: r["mask"] for r in got}
    for r, c, x, y in centers(META):
        want = inside(x, y, [lake]) or any(
            not inside(x, y, [s]) and distance(x, y, [s]) <= 0.8 for s in (state, domain))
        assert table[r * META.width + c + 1] == want


def test_no_interior_layers_mask_nothing(spark):
    got = mk.interior_mask(spark.range(1, 5).withColumnRenamed("id", "cell"), [], META)
    assert not any(r["mask"] for r in got.collect())


def test_a_mask_needs_layers():
    with pytest.raises(ValueError):
        mk.general_mask_runs([], [], META)


def test_mask_raster_rebases_cells(spark):
    dem = spark.range(1, META.cells + 1).select(F.col("id").alias("cell"), (F.col("id") * 1.0).alias("elevation"))
    ring = SHAPES["upright box"]
    masked, crop = mk.mask_raster(dem, layer(spark, (1, ring)), META)
    for row in masked.collect():
        r, c = divmod(row["cell"] - 1, crop.width)
        x, y = crop.c + (c + 0.5) * crop.a, crop.f + (r + 0.5) * crop.e
        assert inside(x, y, [ring])
        old = divmod(int(row["elevation"]) - 1, META.width)
        assert META.c + (old[1] + 0.5) * META.a == pytest.approx(x)
        assert META.f + (old[0] + 0.5) * META.e == pytest.approx(y)
    assert masked.count() == sum(inside(x, y, [ring]) for _, _, x, y in centers(META))
    assert (crop.width, crop.height) == (13, 16)


def test_one_wide_run_becomes_many_tasks(spark):
    """A few runs that stand for all the cells are spread before they are expanded."""
    meta = GridMeta(500, 400, (1.0, 0.0, 0.0, 0.0, -1.0, 400.0))
    runs = spark.range(400).select(F.col("id").alias("row"), F.lit(0).cast("long").alias("col_lo"),
                                   F.lit(499).cast("long").alias("col_hi"))
    sizes = [r["count"] for r in mk.run_cells(runs, meta).groupBy(F.spark_partition_id()).count().collect()]
    assert sum(sizes) == meta.cells and max(sizes) < meta.cells / 3


def test_wkt(spark):
    df = spark.createDataFrame([
        ("POLYGON ((0 0, 4 0, 4 4, 0 0), (1 1, 2 1, 2 2, 1 1))",),
        ("MULTIPOLYGON (((0 0, 1 0, 1 1, 0 0)), ((5 5, 6.5 5, 6 -6e0, 5 5)))",),
    ], "wkt string")
    got = [r["r"] for r in df.select(wkt_rings("wkt").alias("r")).collect()]
    assert [len(g) for g in got] == [2, 2]
    assert (got[1][1][1]["x"], got[1][1][2]["y"]) == (6.5, -6.0)


def test_clean_and_stack(spark):
    a = spark.createDataFrame([(1, "p", None), (2, None, "q"), (3, None, None)], "id int, geometry string, geom string")
    assert {r["id"] for r in mk.clean_layer(a).collect()} == {1, 2}
    b = spark.createDataFrame([(4, "r")], "id int, geom string")
    stacked = mk.stack_layers([mk.clean_layer(a), mk.clean_layer(b)])
    assert stacked.count() == 3 and stacked.columns == ["id", "geometry"]


def test_a_long_coastline_makes_few_pairs(spark):
    """100,000 edges, first with a ring wider than the grid, then with a rim inside it."""
    meta = GridMeta(300, 400, (0.01, 0.0, 0.0, 0.0, -0.01, 4.0))
    n = 100_000
    angle = F.col("id") * (2 * math.pi / n)
    wobble = 1 + 0.02 * F.sin(angle * 977)
    ring = spark.range(n).select("id", F.struct((1.5 + wobble * F.cos(angle)).alias("x"), (2 + wobble * F.sin(angle)).alias("y")).alias("p"))
    ring = ring.agg(F.array_sort(F.collect_list(F.struct("id", "p"))).alias("v")).select(F.col("v.p").alias("ring"))
    layer = ring.select(F.lit("coast").alias("layer"), F.lit(1).alias("feature_id"), F.concat("ring", F.slice("ring", 1, 1)).alias("ring"))
    layer = layer.cache()
    points = np.array([(p["x"], p["y"]) for p in layer.first()["ring"]])
    rows, cols = np.meshgrid(np.arange(0, 400, 7), np.arange(0, 300, 7), indexing="ij")
    x, y = (cols.ravel() + 0.5) * 0.01, 4.0 - (rows.ravel() + 0.5) * 0.01
    distance = np.array([np.hypot(points[:, 0] - a, points[:, 1] - b).min() for a, b in zip(x, y)])
    for radius, share in ((10.0, 0.0), (0.5, 0.2)):
        _, pairs = mk.near_edge_work(layer, meta, radius)
        assert pairs.count() <= share * n * 400
        runs = mk.near_edge_runs(layer, meta, radius)
        near = {(r["row"], r["col"]) for r in runs.where("row % 7 = 0").select(
            "row", F.explode(F.sequence("col_lo", "col_hi")).alias("col")).collect()}
        for a, b, d in zip(rows.ravel().tolist(), cols.ravel().tolist(), distance):
            if abs(d - radius) > 1e-3:  # the edges between the points come a little closer
                assert ((a, b) in near) == (d < radius)
    layer.unpersist()


def test_edges_in_one_box_make_few_pairs(spark):
    """100,000 short edges in one top box: a row meets the few that reach furthest, not all of them."""
    meta = GridMeta(300, 400, (0.01, 0.0, 0.0, 0.0, -0.01, 4.0))
    n, radius = 100_000, 0.8
    x, y = (1.5 + 0.04 * F.rand(1)), (2.0 + 0.04 * F.rand(2))
    points = spark.range(n).select(x.alias("x"), y.alias("y")).cache()
    far = F.struct((F.col("x") + 1e-6).alias("x"), F.col("y").alias("y"))
    rings = points.select(F.array(F.struct("x", "y"), far).alias("ring"))
    _, pairs = mk.near_edge_work(rings, meta, radius)
    rows = pairs.select("row").distinct().count()
    assert rows > 100
    assert pairs.count() < 25 * rows * math.log2(n)  # of 100,000 edges a row meets some 350, those along the front
    got = {r["row"]: (r["lo"], r["hi"]) for r in mk.near_edge_runs(rings, meta, radius).groupBy("row").agg(
        F.min("col_lo").alias("lo"), F.max("col_hi").alias("hi")).collect()}
    at = np.array(points.collect())
    for row in range(100, 300, 9):
        yc = 4.0 - (row + 0.5) * 0.01
        near = np.abs(at[:, 1] - yc) <= radius
        half = np.sqrt(np.maximum(radius**2 - (at[:, 1] - yc) ** 2, 0))[near]
        if near.any():
            lo, hi = (at[near, 0] - half).min() / 0.01 - 0.5, (at[near, 0] + 1e-6 + half).max() / 0.01 - 0.5
            assert got[row] == (max(math.ceil(lo), 0), min(math.floor(hi), 299))
    points.unpersist()


def jobs_of(spark, build):
    """How many jobs Spark starts while ``build`` runs."""
    group = f"watched-{id(build)}"
    spark.sparkContext.setJobGroup(group, "watched")
    try:
        out = build()
        return len(spark.sparkContext.statusTracker().getJobIdsForGroup(group)), out
    finally:
        spark.sparkContext.setLocalProperty("spark.jobGroup.id", None)


def test_no_job_runs_while_a_mask_is_planned(spark):
    cells = spark.range(1, META.cells + 1).withColumnRenamed("id", "cell")
    outer = [layer(spark, (1, SHAPES["star"])), layer(spark, (1, SHAPES["upright box"]))]
    jobs, mask = jobs_of(spark, lambda: mk.general_mask(cells, outer, [layer(spark, (1, SHAPES["tiny"]))], META, 0.8))
    assert jobs == 0
    plan = mask._jdf.queryExecution().executedPlan().toString()
    assert "explode(sequence(col_lo" not in plan.replace("cast(", "")


def test_flags_by_sweep(spark, monkeypatch):
    """Cells in a few narrow blocks, twice, outside the grid and without an id; runs over several blocks."""
    monkeypatch.setattr(mk, "BLOCK", 7)
    meta = GridMeta(40, 4, META.transform)
    ids = [*range(1, 161), 5, 161, 400, None]
    cells_in = spark.createDataFrame([(i, f"c{i}", True) for i in ids], "cell long, name string, mask boolean")
    runs = spark.createDataFrame([(0, 0, 39), (1, 3, 3), (1, 6, 22), (3, 38, 39)], "row long, col_lo long, col_hi long")
    want = [(r, c) for r, lo, hi in [(0, 0, 39), (1, 3, 3), (1, 6, 22), (3, 38, 39)] for c in range(lo, hi + 1)]
    got = mk.flag_cells(cells_in, runs, meta)
    assert got.columns == ["cell", "name", "mask"]
    found = sorted(map(tuple, got.collect()), key=repr)
    inside = lambda i: i is not None and divmod(i - 1, 40) in want
    assert found == sorted([(i, f"c{i}", inside(i)) for i in ids], key=repr)
    assert not any(r["mask"] for r in mk.flag_cells(cells_in, runs.limit(0), meta).collect())
