"""Mesh text, crosswalks, tables and layers, on hand-made files."""

import os
from contextlib import nullcontext

import pytest
from pyspark.sql import functions as F

from tidegrid.functions import geometry, scalars
from tidegrid.functions.grid import GridMeta, cell_at
from tidegrid.operators import elements as el
from tidegrid.operators import nodes as nd
from tidegrid.operators import positions as ps
from tidegrid.operators import quality as ql
from tidegrid.operators import tiles as tl
from tidegrid.sinks.store import TableStore
from tidegrid.sources import filesystem, layers, mesh_text, tables

MESH = """a title 4 words
3 5
1 0.0 0.0 1.5
2 1.0 0.0 2.5
 3   0.0\t1.0   3.5
4 1.0 1.0 -1e-3
5 2.0 1.0 nan
1 3 1 2 3
2 4 2 5 4 3
3 3 2 4 9
trailing words that make no row of any kind here
"""


@pytest.fixture
def mesh(tmp_path):
    path = tmp_path / "mesh.gr3"
    path.write_text(MESH)
    return str(path)


def test_loose_mesh_skips_the_first_line_only(spark, mesh):
    nodes, elements, extra = mesh_text.read_mesh_text(spark, mesh)
    assert sorted(r["node_id"] for r in nodes.collect()) == [1, 2, 3, 4, 5]
    assert [tuple(r) for r in elements.orderBy("pg_id").collect()] == [(1, 3, 1, 2, 3), (3, 3, 2, 4, 9)]
    assert extra.count() == 2  # the quad and the trailing line
    assert tuple(ql.mesh_profile(nodes, elements, extra).first()) == (5, 5, 2, 2)


def test_strict_mesh_and_polygons(spark, mesh):
    nodes, raw = mesh_text.read_mesh_strict(spark, mesh)
    assert nodes.count() == 5
    assert [(r["index"], r["element_id"], r["raw"]) for r in raw.orderBy("index").collect()] == [
        (0, 1, [3, 1, 2, 3]), (1, 2, [4, 2, 5, 4, 3]), (2, 3, [3, 2, 4, 9])]
    good, bad = el.validate_elements(raw, nodes)
    assert [(r["index"], r["error"]) for r in bad.collect()] == [(2, "vertex id outside 1..5: 9")]
    polygons = {r["pg_id"]: r for r in el.element_polygons(good, nodes).collect()}
    assert polygons[1]["node_id_4"] is None and polygons[2]["node_id_4"] == 3
    assert [(p["x"], p["y"]) for p in polygons[2]["ring"]] == [(1, 0), (2, 1), (1, 1), (0, 1)]
    assert polygons[1]["mean_wse"] == pytest.approx(2.5)


def test_element_failures(spark):
    nodes = spark.createDataFrame([(i, 0.0, 0.0, 0.0) for i in (1, 2, 3, 6)], "node_id bigint, long double, lat double, wse double")
    raw = spark.createDataFrame([
        (0, 10, [3, 1, 2, 3]), (1, 11, []), (2, 12, [2, 1, 2]), (3, 13, [3, 1, 2, 5]), (4, 14, [3, 0, 2, 3]),
        (5, 15, [4, 1, 2, 3]), (6, 16, [-1, 1, 2, 3]), (7, 17, [3, 1, 7, 5]),
    ], "index bigint, element_id bigint, raw array<bigint>")
    good, bad = el.validate_elements(raw, nodes)
    assert {r["pg_id"]: r["node_ids"] for r in good.collect()} == {10: [1, 2, 3], 15: [1, 2, 3]}
    errors = {r["index"]: r["error"] for r in bad.collect()}
    assert errors == {
        1: "no vertex list", 2: "needs 3 vertices or more, has 2", 3: "vertex id without a node: 5",
        4: "vertex id outside 1..6: 0", 6: "needs 3 vertices or more, has 0", 7: "vertex id outside 1..6: 7"}
    assert [r["index"] for r in el.top_failures(bad, 2).collect()] == [1, 2]


def test_2dm(spark, tmp_path):
    path = tmp_path / "m.2dm"
    path.write_text("MESH2D\n\nND 1 0 0 1.25\nND 2 1 0 2\nE3T 7 1 2 3 1\nE4Q 8 1 2 3 4 1\n")
    nodes, elements = mesh_text.read_2dm(spark, str(path))
    assert [tuple(r) for r in nodes.orderBy("node_id").collect()] == [(1, 0, 0, 1.25), (2, 1, 0, 2)]
    assert [tuple(r) for r in elements.collect()] == [(7, 1, 2, 3)]


def test_line_numbers_across_splits_and_files(spark, tmp_path):
    for part in range(3):
        lines = [f"{part * 4000 + i}" for i in range(4000)]
        (tmp_path / f"part-{part:05d}").write_text("\n".join(lines) + "\n")
    spark.conf.set("spark.sql.files.maxPartitionBytes", "4096")
    try:
        lines = ps.numbered_lines(spark, str(tmp_path))
        assert lines.select(F.spark_partition_id()).distinct().count() > 4
        assert lines.where("cast(value AS bigint) <> line_no").count() == 0
        assert lines.count() == 12000
    finally:
        spark.conf.unset("spark.sql.files.maxPartitionBytes")


def test_crosswalk_positions_ignore_blank_lines(spark, tmp_path):
    path = tmp_path / "ids.csv"
    path.write_text("11\n\n7\n 9 \n")
    got = mesh_text.read_crosswalk(spark, str(path)).orderBy("node_id_nc").collect()
    assert [tuple(r) for r in got] == [(1, 11), (2, 7), (3, 9)]


def test_unmatched_and_duplicate_crosswalk(spark):
    nodes = spark.createDataFrame([(1, 0.0, 0.0, 1.0), (2, 0.0, 0.0, 2.0)], "node_id bigint, long double, lat double, wse double")
    xwalk = spark.createDataFrame([(1, 50), (1, 51)], "node_id_nc bigint, node_id_gr3 bigint")
    got = nd.crosswalk_nodes(nodes, xwalk).collect()
    assert sorted((r["original_id"], r["node_id"] or -1) for r in got) == [(1, 50), (1, 51), (2, -1)]


def test_pages(spark):
    df = spark.range(1000).select((F.col("id") * 3).alias("cell"))
    assert sorted(r["cell"] for r in ps.page(df, 70, 3).collect()) == [3 * i for i in range(210, 280)]
    assert ps.page(df, 70, 14).count() == 20


def test_snapshot_rules(spark, capsys):
    df = spark.createDataFrame([("t", 0, 1.0, float("nan"))], "time string, nSCHISM_hgrid_node long, SCHISM_hgrid_node_x double, elevation double")
    got = tables.normalize_node_wse(df)
    assert got.columns == ["node_id", "long", "wse"] and tuple(got.first()) == (1, 1.0, None)
    assert "SCHISM_hgrid_node_y" in capsys.readouterr().out
    assert tables.normalize_node_wse(spark.range(3)).columns == []


def test_zonal_mask_coercion(spark, tmp_path):
    schema = "pg_id bigint, cell bigint, coverage_fraction double, elevation double, mask double"
    spark.createDataFrame([(1, 1, 1.0, 1.0, None), (1, 2, 1.0, 1.0, 1.0), (1, 3, 1.0, 1.0, 0.0)], schema).write.parquet(str(tmp_path / "z"))
    got = {r["cell"]: r["mask"] for r in tables.read_zonal(spark, str(tmp_path / "z")).collect()}
    assert got == {1: False, 2: True, 3: False}


def test_register_frame_wants_one_source(spark, tmp_path):
    with pytest.raises(ValueError):
        tables.register_frame(spark)
    with pytest.raises(ValueError):
        tables.register_frame(spark, [(1,)], "a int", path="x")
    tables.register_frame(spark, [(1,), (2,)], "a int", name="registered")
    assert spark.sql("SELECT sum(a) FROM registered").first()[0] == 3


def test_a_bad_layer_does_not_stop_the_others(spark, tmp_path):
    (tmp_path / "broken.parquet").write_text("not parquet")
    (tmp_path / "odd.json").write_text('{"feature_id": 1, "name": "no polygon"}\n')
    (tmp_path / "lakes.json").write_text('{"feature_id": 4, "geometry": "POLYGON ((0 0, 1 0, 1 1, 0 0))"}\n')
    stacked, lineage, failures = layers.register_layers(spark, str(tmp_path))
    assert [r["layer"] for r in stacked.collect()] == ["lakes_atlgulf"]
    assert [tuple(r) for r in lineage.collect()] == [("lakes_atlgulf", "EPSG:4326")]
    assert sorted(name for name, _ in failures) == ["broken", "odd"]
    stacked, lineage, _ = layers.register_layers(spark, str(tmp_path), suffix="_pacific")
    assert {r["layer"] for r in stacked.collect()} == {r["table_name"] for r in lineage.collect()} == {"lakes_pacific"}


def test_convert_elements_passes_unknown_schema(spark):
    assert tables.convert_elements(spark.range(2)).columns == ["id"]


def test_missing_inputs_stop_the_job(spark, mesh):
    filesystem.validate_inputs(spark, mesh)
    with pytest.raises(FileNotFoundError):
        filesystem.validate_inputs(spark, mesh, "/nowhere/at/all")
    with pytest.raises(FileNotFoundError):
        filesystem.validate_inputs(spark, "")


def test_cells_do_not_wrap_to_the_next_row(spark):
    meta = GridMeta(10, 5, (1.0, 0.0, 0.0, 0.0, -1.0, 5.0))
    df = spark.createDataFrame([(0.0, 5.0), (9.99, 0.01), (10.0, 2.5), (-0.01, 2.5), (3.5, 5.01), (3.5, 0.0),
                                (float("nan"), 1.0)], "x double, y double")
    assert [r[0] for r in df.select(cell_at("x", "y", meta)).collect()] == [1, 50, None, None, None, None, None]


def test_grid_rejects_rotation():
    with pytest.raises(ValueError):
        GridMeta(1, 1, (1.0, 0.1, 0.0, 0.0, -1.0, 0.0))


def test_metadata_round_trip(spark):
    meta = GridMeta(34724, 21000, (0.1, 0.0, -82.0, 0.0, -0.1, 30.0), "EPSG:5070", -9999.0)
    assert tables.load_dem_metadata(tables.metadata_row(spark, meta)) == meta
    with pytest.raises(LookupError):
        tables.load_dem_metadata(tables.metadata_row(spark, meta), "other")


def test_albers_known_values(spark):
    df = spark.createDataFrame([(-96.0, 23.0), (-80.0, 27.0)], "long double, lat double")
    rows = geometry.to_crs(df, "EPSG:4326", "EPSG:5070").collect()
    assert rows[0]["long"] == pytest.approx(0, abs=1e-6) and rows[0]["lat"] == pytest.approx(0, abs=1e-6)
    assert 1.5e6 < rows[1]["long"] < 1.7e6 and 0.4e6 < rows[1]["lat"] < 0.7e6
    with pytest.raises(ValueError):
        geometry.to_crs(df, "EPSG:4326", "EPSG:26917")


def test_run_names_and_flags(spark):
    df = spark.createDataFrame([("/a/b/nwm.t00z.analysis.nc",), ("plain",), ("s3://x/y.tar.gz",)], "p string")
    assert [r[0] for r in df.select(scalars.run_name("p", "_wse")).collect()] == [
        "nwm.t00z.analysis_wse", "plain_wse", "y.tar_wse"]
    words = spark.createDataFrame([("YES",), ("0",)], "w string")
    assert [r[0] for r in words.select(scalars.parse_flag("w")).collect()] == [True, False]
    with pytest.raises(Exception, match="maybe"):
        spark.createDataFrame([("maybe",)], "w string").select(scalars.parse_flag("w")).collect()


def test_dem_cells_keep_nodata_rows(spark):
    meta = GridMeta(3, 2, (1.0, 0.0, 0.0, 0.0, -1.0, 2.0))
    strips = spark.createDataFrame([(0, 0, 3, [1.0, -9.0, float("nan")]), (1, 0, 3, [4.0, 5.0, 6.0])],
                                   "row_off bigint, col_off bigint, n_cols int, values array<double>")
    got = [tuple(r) for r in tl.dem_cells(strips, meta, -9.0).orderBy("cell").collect()]
    assert got == [(1, 1.0), (2, None), (3, None), (4, 4.0), (5, 5.0), (6, 6.0)]


def test_expectations(spark, capsys):
    df = spark.createDataFrame([(1, None), (None, None)], "a int, b int")
    with pytest.raises(ValueError, match="missing columns: c"):
        ql.expect(df, ["c"])
    for table, rows, wrong in ((df, 2, None), (df, None, None), (df, 3, "expected 3"), (df.limit(0), None, "empty"), (df.limit(0), 1, "found 0")):
        checked, verdict = ql.expect(table, ["a"], rows)
        assert checked.count() == table.count()
        with pytest.raises(ValueError, match=wrong) if wrong else nullcontext():
            assert verdict.verify() == 2
    assert ql.warn_on_nulls(ql.null_report(df)) == 3
    assert "b = 2" in capsys.readouterr().out
    counted, seen = ql.observed_nan_points(spark.createDataFrame([(float("nan"), 1.0), (1.0, 1.0)], "long double, lat double"), "nans")
    counted.collect()
    assert seen.get["nan_points"] == 1


def test_prefix_sums_over_all_levels(spark):
    """Keys from one end of the longs to the other, in dense and in lonely groups."""
    import random

    rng = random.Random(4)
    keys = sorted({rng.randrange(-(1 << 63), 1 << 63) for _ in range(50)} | set(range(-30, 30)) | {(5 << 20) + k for k in range(40)})
    counts = [(k, rng.randrange(1, 9)) for k in keys]
    got = dict(map(tuple, ps.prefix_sums(spark.createDataFrame(counts, "key long, n long"), 3).collect()))
    before = 0
    for k, n in counts:
        assert got[k] == before
        before += n


def test_positions_keep_nothing_and_have_no_single_task_window(spark, tmp_path):
    times = spark.range(2000).select(F.timestamp_seconds((F.col("id") * 7919) % 2003 * 1000).alias("at"))
    found = ps.row_positions(times, "at")
    assert [r["position"] for r in found.orderBy("at").collect()] == list(range(2000))
    with pytest.raises(TypeError):
        ps.row_positions(spark.createDataFrame([("a",)], "s string"), "s")
    for k in range(3):
        (tmp_path / f"part-{k} x.txt").write_text("".join(f"{k}-{i}\n" for i in range(100 * k + 1)))
    lines = ps.numbered_lines(spark, str(tmp_path))
    assert [r["line_no"] for r in lines.orderBy(F.split("value", "-")[0], F.split("value", "-")[1].cast("int")).collect()] == list(range(303))
    for frame in (found, lines):
        assert "InMemoryRelation" not in frame._jdf.queryExecution().executedPlan().toString()
    assert not spark.sparkContext._jsc.getPersistentRDDs()


def test_line_numbers_over_several_groups_of_files(spark, tmp_path, monkeypatch):
    monkeypatch.setattr(ps, "GROUP_BITS", 1)
    for part in range(7):
        (tmp_path / f"part-{part}").write_text("".join(f"{part * 50 + i}\n" for i in range(50)))
    lines = ps.numbered_lines(spark, str(tmp_path))
    assert lines.where("cast(value AS bigint) <> line_no").count() == 0 and lines.count() == 350


def test_line_numbers_with_more_splits_than_are_broadcast(spark, tmp_path, monkeypatch):
    monkeypatch.setattr(ps, "BROADCAST_SPLITS", 0)
    for part in range(2):
        (tmp_path / f"part-{part}").write_text("".join(f"{part * 50 + i}\n" for i in range(50)))
    lines = ps.numbered_lines(spark, str(tmp_path))
    assert "Broadcast" not in lines._jdf.queryExecution().optimizedPlan().toString()
    assert lines.where("cast(value AS bigint) <> line_no").count() == 0 and lines.count() == 100


def test_expectations_compute_their_input_once(spark, tmp_path):
    """Rows pass a counter of this process's tasks: a table that is checked is computed no second time."""
    passed = spark.sparkContext.accumulator(0)

    def count(batches):
        for b in batches:
            passed.add(len(b))
            yield b

    rows = spark.range(100).mapInPandas(count, "id long")
    store = TableStore(spark, str(tmp_path))
    assert store.write(rows, "t", ["id"], 100).count() == 100 and passed.value == 100
    with pytest.raises(ValueError, match="expected 99"):
        store.write(rows, "t", rows=99)
    # The table that failed was never committed, and its files are gone.
    assert store.read("t").count() == 100 and store.latest("t") == 1 and len(os.listdir(tmp_path / "t")) == 2


def test_points_meet_bitmaps_of_valid_cells(spark):
    """Against sets, over cells at the borders of bytes and blocks, off the grid and with null places."""
    import random

    rng = random.Random(8)
    meta = GridMeta(400, 300, (1.0, 0.0, 0.0, 0.0, -1.0, 300.0), "EPSG:4326")
    edges = [1, 2, 8, 9, 32768, 32769, 65536, 65537, 98304, 98305, 120000]
    cells = sorted(set(edges) | {rng.randrange(1, 120001) for _ in range(3000)})
    kind = {c: rng.choice([1.0, None, float("nan")]) for c in cells}
    dem = spark.createDataFrame(list(kind.items()), "cell bigint, elevation double")
    around = [c + d for c in edges for d in (-1, 0, 1) if 1 <= c + d <= 120000]
    wanted = cells + around + [rng.randrange(1, 120001) for _ in range(2000)]
    points = [(k, (c - 1) % 400 + 0.5, 300 - (c - 1) // 400 - 0.5) for k, c in enumerate(wanted)]
    points += [(10**6, -5.0, 5.0), (10**6 + 1, None, 5.0), (10**6 + 2, 500.0, 5.0)]
    nodes = spark.createDataFrame(points, "node_id bigint, long double, lat double")
    got = nd.points_outside_dem(nodes, dem, meta)
    expected = {k for k, c in enumerate(wanted) if kind.get(c) != 1.0} | {10**6, 10**6 + 1, 10**6 + 2}
    assert sorted(r["node_id"] for r in got.collect()) == sorted(expected)
    blocks = nd.valid_bitmaps(dem)
    assert blocks.count() == 4 and blocks.select(F.sum(F.bitmap_count("bits"))).first()[0] == sum(v == 1.0 for v in kind.values())
