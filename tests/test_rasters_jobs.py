"""Tiles, chunk store, table store, jobs and incremental runs."""

import json
import math
import os
from contextlib import nullcontext

import numpy as np
import pytest
from pyspark.sql import functions as F

from fixtures import views as v
from fixtures.queries_jobs import prepared
from fixtures.registry import QUERIES
from tidegrid.functions.grid import GridMeta
from tidegrid.operators import tiles as tl
from tidegrid.operators import zonal as zo
from tidegrid.operators.skew import salt_copies
from tidegrid.plans import forecast
from tidegrid.plans.config import JobConfig
from tidegrid.plans.domain import bucket_count, store_coverage
from tidegrid.session import colocated_joins
from tidegrid.sinks import rasters as rs
from tidegrid.sinks.store import CommitConflict, TableStore, export_mesh, materialize_result
from tidegrid.streaming.runs import runs_depth, stream_runs

META = GridMeta(1100, 600, (1.0, 0.0, 0.0, 0.0, -1.0, 600.0))


def cell(row, col):
    return row * META.width + col + 1


@pytest.fixture(scope="module")
def sparse(spark):
    """Values on both sides of a tile seam, in the last partial tile, and a NULL."""
    rows = [(cell(0, 0), 1.0), (cell(511, 511), 2.0), (cell(511, 512), 3.0), (cell(512, 511), 4.0),
            (cell(599, 1099), 5.0), (cell(3, 3), None), (cell(7, 7), 0.05)]
    return spark.createDataFrame(rows, "cell bigint, depth double")


def test_tiles_are_sparse_cropped_and_complete(sparse):
    tiles = {(r["tile_row"], r["tile_col"]): r for r in tl.build_tiles(sparse, META, "depth").collect()}
    assert set(tiles) == {(0, 0), (0, 1), (1, 0), (1, 2)}
    last = tiles[(1, 2)]
    assert (last["n_rows"], last["n_cols"]) == (88, 76) and len(last["data"]) == 88 * 76 * 4
    first = np.frombuffer(tiles[(0, 0)]["data"], "<f4").reshape(512, 512)
    assert first[0, 0] == 1 and first[511, 511] == 2 and first[3, 3] == -9999
    assert (first != -9999).sum() == 3


def test_tiles_round_trip_and_threshold(sparse):
    got = {r["cell"]: r["value"] for r in tl.tiles_to_cells(tl.build_tiles(sparse, META, "depth"), META).collect()}
    assert got == pytest.approx({r["cell"]: r["depth"] for r in sparse.collect() if r["depth"] is not None})
    cut = tl.tiles_to_cells(tl.build_tiles(sparse, META, "depth", depth_threshold=0.1), META)
    assert {r["cell"] for r in cut.collect()} == set(got) - {cell(7, 7)}
    legacy = tl.build_tiles(sparse, META, "depth", 1000, math.nan)
    assert tl.tiles_to_cells(legacy, META, math.nan).count() == len(got)


def test_repeated_cells_do_not_grow_a_tile(spark, sparse):
    many = sparse.withColumn("k", F.explode(F.sequence(F.lit(1), F.lit(500)))).drop("k")
    got = tl.tiles_to_cells(tl.build_tiles(many, META, "depth"), META)
    assert got.count() == 6


def test_chunk_store_layout_and_rerun(spark, sparse, tmp_path):
    store = str(tmp_path / "fim.zarr")
    assert rs.write_chunk_store(sparse, META, "depth", store, "run1_depth") == 4
    rs.write_chunk_store(sparse.limit(0), META, "depth", store, "run2_depth")
    info, attrs = rs.store_attributes(store, "run1_depth")
    assert info["shape"] == [600, 1100] and info["chunks"] == [512, 512] and info["compressor"] is None
    assert attrs == {"geotransform": list(META.transform), "crs": "EPSG:4326", "nodata": -9999.0,
                     "_ARRAY_DIMENSIONS": ["lat", "lon"]}
    assert sorted(f for f in os.listdir(f"{store}/run1_depth") if not f.startswith(".")) == ["0.0", "0.1", "1.0", "1.2"]
    assert os.path.getsize(f"{store}/run1_depth/1.2") == 512 * 512 * 4
    listed = json.load(open(f"{store}/.zmetadata"))["metadata"]
    assert {"run1_depth/.zarray", "run2_depth/.zattrs", ".zgroup"} <= set(listed)
    assert rs.read_chunk_store(spark, store, "run1_depth").count() == 6
    only = sparse.where(F.col("cell") == cell(0, 0))
    rs.write_chunk_store(only, META, "depth", store, "run1_depth")
    assert [r["cell"] for r in rs.read_chunk_store(spark, store, "run1_depth").collect()] == [1]
    assert rs.read_chunk_store(spark, f"file://{store}", "run1_depth").count() == 1


def test_overviews_average_valid_pixels_only(spark):
    meta = GridMeta(5, 3, (1.0, 0.0, 0.0, 0.0, -1.0, 3.0))
    df = spark.createDataFrame([(1, 2.0), (2, 4.0), (6, None), (7, 6.0), (15, 8.0)], "cell bigint, depth double")
    got = {(r["level"], r["row"], r["col"]): r["value"] for r in tl.overviews(df, meta, "depth", 2).collect()}
    assert got == {(1, 0, 0): 4.0, (1, 1, 2): 8.0, (2, 0, 0): 4.0, (2, 0, 1): 8.0}
    assert tl.overview_levels(GridMeta(34724, 100, META.transform)) == 7
    assert tl.overviews(df, meta, "depth").count() == 0


def test_overviews_are_written_by_level(spark, sparse, tmp_path):
    stored = rs.write_overviews(sparse, META, "depth", str(tmp_path / "ov"))
    assert {r["level"] for r in stored.select("level").distinct().collect()} == {1, 2}


def test_store_replaces_what_it_reads(spark, tmp_path):
    store = TableStore(spark, str(tmp_path))
    store.write(spark.range(10), "t")
    for limit in (8, 5, 2):
        store.write(store.read("t").where(F.col("id") < limit), "t")
    # Older versions stay for those who still read them, until they are dropped explicitly.
    assert store.read("t").count() == 2 and len(store._versions("t")) == 4
    store.vacuum("t", keep=2)
    assert store.read("t").count() == 2 and len(store._versions("t")) == 2
    os.makedirs(tmp_path / "t" / "unfinished")  # a write that never got to its commit
    assert store.read("t").count() == 2
    with pytest.raises(LookupError):
        store.read("absent")


def test_lineage_keeps_one_row_per_table(spark, tmp_path):
    store = TableStore(spark, str(tmp_path))
    for crs in ("EPSG:4326", "EPSG:5070"):
        store.record_crs("triangle_weights", crs)
    store.record_crs("masks", "EPSG:4326")
    assert {tuple(r) for r in store.read("metadata").collect()} == {("triangle_weights", "EPSG:5070"), ("masks", "EPSG:4326")}


def test_bucketed_table_joins_without_a_shuffle(spark, tmp_path):
    store = TableStore(spark, str(tmp_path))
    rows = spark.range(5000).select((F.col("id") % 700).alias("pg_id"), F.lit(0).alias("_salt"), "id")
    stored = store.write_bucketed(rows, "b", ["pg_id", "_salt"], 4, ["id"])
    assert stored.count() == 5000
    small = spark.range(700).select(F.col("id").alias("pg_id"), F.rand(3).alias("x"))
    small = store.write(salt_copies(small, "pg_id", spark.createDataFrame([(3, 1)], "pg_id bigint, salts int")), "small")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        joined = store.read("b").join(small, ["pg_id", "_salt"], "left")
        plan = joined._jdf.queryExecution().executedPlan().toString()
        assert plan.count("Exchange hashpartitioning") == 1 and joined.where("x IS NOT NULL").count() == 5000
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")


def test_bucketed_table_without_its_catalog_entry(spark, tmp_path):
    """A later application reads the same rows from the files; an older version leaves no entry behind."""
    store = TableStore(spark, str(tmp_path))
    for n in (50, 70):
        store.write_bucketed(spark.range(n), "apart", ["id"], 3)
    entries = [t.name for t in spark.catalog.listTables() if t.name.startswith("apart_")]
    assert len(entries) == 2 and store.bytes_per_bucket("apart") > 0
    store.vacuum("apart")
    assert [t.name for t in spark.catalog.listTables() if t.name.startswith("apart_")] == [store._newest("apart")["table"]]
    spark.sql(f"DROP TABLE {store._newest('apart')['table']}")
    assert store.read("apart").count() == 70


def test_two_writers_of_one_version(spark, tmp_path):
    first, second = TableStore(spark, str(tmp_path)), TableStore(spark, str(tmp_path))
    first.write(spark.range(3), "t")
    base = second.latest("t")
    record = second._write_new(spark.range(9), "t")
    first.write(spark.range(4), "t")
    with pytest.raises(CommitConflict):
        second.commit("t", record, base)
    assert second.read("t").count() == 4
    assert second.commit("t", record, second.latest("t")) == 3 and first.read("t").count() == 9
    assert not [x for x in os.listdir(tmp_path / "t" / "_commits") if "draft" in x and not x.startswith(".")]


def test_upsert_is_built_again_on_what_came_between(spark, tmp_path, monkeypatch):
    """Another writer commits while rows are merged: neither's rows are lost."""
    row = lambda k: spark.createDataFrame([(k, k.upper())], "k string, v string")
    store, other = TableStore(spark, str(tmp_path)), TableStore(spark, str(tmp_path))
    store.upsert(row("a"), "t", "k")
    plain, between = store._write_new, [row("b"), row("c")]

    def slow(df, name):
        record = plain(df, name)
        if between:
            other.upsert(between.pop(0), "t", "k")
        return record

    monkeypatch.setattr(store, "_write_new", slow)
    store.upsert(row("d"), "t", "k")
    assert sorted(r["k"] for r in store.read("t").collect()) == ["a", "b", "c", "d"]


def test_bucket_counts():
    assert bucket_count(0, 8) == 1 and bucket_count(120_000, 8) == 3
    assert bucket_count(1_000_000, 8) == 8 and bucket_count(10**9, 8) == 1000
    assert bucket_count(10**13, 8) == 100_000


def test_materialize_counts_while_writing(spark, tmp_path):
    assert materialize_result(spark.range(123), str(tmp_path / "r")) == 123
    assert materialize_result(spark.range(0), str(tmp_path / "e")) == 0


def test_empty_tables_are_not_exported(spark, tmp_path):
    written = export_mesh(spark.range(3), spark.range(0), str(tmp_path / "n"), str(tmp_path / "e"))
    assert written == [str(tmp_path / "n")]


# --- jobs -------------------------------------------------------------------------------


def test_defaults():
    cfg = JobConfig(store="s")
    assert (cfg.generate_depth, cfg.generate_wse, cfg.execute, cfg.preprocess, cfg.generate_mask) == (True, False, True, False, False)
    assert cfg.low_memory and cfg.depth_threshold is None and cfg.format() == "COG"
    with pytest.raises(ValueError):
        JobConfig(store="s", output_format="PNG").format()


@pytest.fixture(scope="module")
def domain_cfg(spark, sf):
    return prepared(spark, sf, generate_wse=True)


def test_rasters_agree_with_the_result_table(spark, sf, domain_cfg):
    count, tiles = forecast.execute(spark, domain_cfg)
    assert tiles is None and count > 300
    result = spark.read.parquet(f"{domain_cfg.store}/result/run_0600z")
    assert result.columns == ["cell", "wse_cell_weighted_average", "depth"] and result.count() == count
    for name, column in (("wse", "wse_cell_weighted_average"), ("depth", "depth")):
        stored = spark.read.parquet(f"{domain_cfg.output_path}/run_0600z_{name}")
        got = tl.tiles_to_cells(stored, v.grid(spark, sf))
        joined = got.join(result, "cell")
        assert joined.count() == count == got.count()
        assert joined.where(F.abs(F.col("value") - F.col(column)) > 1e-5).count() == 0


def test_no_output_when_both_flags_are_off(spark, domain_cfg):
    cfg = JobConfig(store=domain_cfg.store, generate_depth=False, generate_wse=False)
    assert forecast.interpolate_and_rasterize(spark, cfg, "x.nc") == (0, None)


def test_job_without_inputs_stops(spark, tmp_path):
    with pytest.raises(ValueError):
        forecast.run_job(spark, JobConfig(store=str(tmp_path), preprocess=True))
    assert forecast.run_job(spark, JobConfig(store=str(tmp_path), execute=False)) == (0, None)


def test_mesh_levels_can_drive_a_run(spark, domain_cfg):
    cfg = JobConfig(store=domain_cfg.store, mesh_path=domain_cfg.mesh_path, output_path=domain_cfg.output_path,
                    output_format="IN_MEMORY")
    count, tiles = forecast.execute(spark, cfg)
    assert set(tiles) == {"depth"} and count > 300


def test_incremental_runs_equal_the_batch_result(spark, sf, domain_cfg, tmp_path):
    """Runs landing one after the other, one of them in two pieces, and a second start."""
    levels = v.nodes(spark, sf).select("node_id", "wse")
    landing, out, progress = str(tmp_path / "in"), str(tmp_path / "out"), str(tmp_path / "progress")

    def land(run_id, part):
        part.write.mode("append").parquet(f"{landing}/run_id={run_id}")

    def drain():
        job = stream_runs(spark, landing, domain_cfg.store, out, progress)
        job.awaitTermination()
        assert job.exception() is None

    def stored(run_id):
        df = spark.read.parquet(out).where(F.col("run_id") == run_id)
        return {r["cell"]: r["depth"] for r in df.collect()}

    land("a", levels)
    land("b", levels.where("node_id % 2 = 0"))
    drain()
    before = stored("a")
    land("b", levels.where("node_id % 2 = 1"))
    land("c", levels.withColumn("wse", F.col("wse") / 2))
    drain()
    drain()  # nothing new
    store = TableStore(spark, domain_cfg.store)
    batch = runs_depth(store, levels.withColumn("run_id", F.lit("x")))
    want = {r["cell"]: r["depth"] for r in batch.collect()}
    assert len(want) > 300
    assert stored("a") == pytest.approx(want) and before == pytest.approx(want)
    assert stored("b") == pytest.approx(want)
    assert 0 < len(stored("c")) < len(want)


@pytest.mark.parametrize("renormalize", [False, True])
def test_a_hot_cell_is_salted_and_still_exact(spark, tmp_path, renormalize):
    """A third of all coverage rows in one cell, triangles without a level among them."""
    meta = GridMeta(64, 64, (1.0, 0.0, 0.0, 0.0, -1.0, 64.0))
    cov = spark.range(9000).select(
        F.col("id").alias("pg_id"),
        F.when(F.col("id") % 3 == 0, F.lit(700)).otherwise(F.col("id") % 4096 + 1).alias("cell"),
        (F.rand(2) + 0.01).alias("coverage_fraction"), F.lit(0.25).alias("elevation"), F.lit(False).alias("mask"))
    cov.write.parquet(str(tmp_path / "cov"))
    cov = spark.read.parquet(str(tmp_path / "cov"))
    tri = spark.range(9000).where("id % 5 <> 1").select(
        F.col("id").alias("pg_id"), F.when(F.col("id") % 7 != 2, F.col("id") % 13 + 0.5).alias("wse_weighted_average"))
    store = TableStore(spark, str(tmp_path / "store"))
    stored = store_coverage(store, cov, meta, tile=16, hot_rows=1000)
    assert store.read("hot_tiles").count() == 1
    assert max(r["count"] for r in stored.groupBy("tile", "_salt").count().collect()) < 1400
    want = {r["cell"]: r["depth"] for r in zo.depth(cov, tri, renormalize=renormalize).collect()}
    for settings in (nullcontext(), colocated_joins(spark)):
        with settings:
            got = zo.depth_by_tile(stored, store.read("triangle_tiles"), tri, renormalize=renormalize).collect()
        assert {r["cell"]: r["depth"] for r in got} == pytest.approx(want) and len(got) == len(want) > 2000


def test_a_run_does_not_shuffle_coverage(spark, domain_cfg):
    store = TableStore(spark, domain_cfg.store)
    tri = store.read("triangle_weights").select("pg_id", F.rand(1).alias("wse_weighted_average"))
    with colocated_joins(spark):
        df = zo.depth_by_tile(store.read("masked_coverage_fraction"), store.read("triangle_tiles"), tri)
        plan = df._jdf.queryExecution().executedPlan().toString()
    first = plan[plan.index("SortAggregate"):plan.index("FileScan")]
    assert "Exchange" not in first and "Sort [" not in first
    with colocated_joins(spark):
        once = zo.depth_by_tile(store.read("masked_coverage_fraction"), store.read("triangle_tiles"), tri, any_hot=False)
        plan = once._jdf.queryExecution().executedPlan().toString()
    assert sum("coverage_fraction" in line for line in plan.splitlines() if "FileScan" in line) == 1
    assert once.exceptAll(df).count() == df.exceptAll(once).count() == 0


@pytest.mark.parametrize("runs", [False, True])
def test_coverage_stays_in_few_buckets_beside_many_partitions(spark, domain_cfg, runs):
    """Fewer buckets than shuffle partitions, and triangle places too large to broadcast."""
    store = TableStore(spark, domain_cfg.store)
    tri = store.read("triangle_weights").select("pg_id", (F.col("pg_id") % 13).cast("double").alias("wse_weighted_average"))
    if runs:
        tri = tri.withColumn("run_id", F.explode(F.array(F.lit("a"), F.lit("b"))))
    cov, places = store.read("masked_coverage_fraction"), store.read("triangle_tiles")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        with colocated_joins(spark):
            df = zo.depth_by_tile(cov, places, tri, any_hot=False)
            plan = df._jdf.queryExecution().executedPlan().toString()
            got = {(r["run_id"] if runs else "a", r["cell"]): r["depth"] for r in df.collect()}
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
    lines = plan.splitlines()
    scan = next(i for i, line in enumerate(lines) if "FileScan" in line and "coverage_fraction" in line)
    assert "Bucketed: true" in lines[scan]
    join = max(i for i, line in enumerate(lines[:scan]) if "Join" in line)
    assert not any("Exchange" in line for line in lines[:scan])
    assert join < scan
    want = {r["cell"]: r["depth"] for r in zo.depth(cov, tri.select("pg_id", "wse_weighted_average").distinct()).collect()}
    assert got == pytest.approx({(run, c): d for run in ("ab" if runs else "a") for c, d in want.items()}) and len(want) > 300


def test_the_tile_query_lays_out_stored_coverage(spark, sf, monkeypatch):
    """The layout reads its input several times, which must not be an overlay each time."""
    seen = []

    def watched(store, raw, *args, **kwargs):
        seen.append(raw.inputFiles())
        return store_coverage(store, raw, *args, **kwargs)

    monkeypatch.setattr("fixtures.queries_jobs.domain.store_coverage", watched)
    assert QUERIES["depth_by_tile"](spark, sf).count() > 300
    assert len(seen) == 1 and seen[0] and not any(f"{sf}/" in name for name in seen[0])


def test_a_run_in_many_batches_is_computed_once(spark, sf, domain_cfg, tmp_path, monkeypatch):
    """Two runs in six files, a file per batch; one that lands later is news again."""
    levels = v.nodes(spark, sf).select("node_id", "wse")
    landing, out, computed = str(tmp_path / "in"), str(tmp_path / "out"), []

    def watched(store, rows, *args):
        computed.append(sorted(r["run_id"] for r in rows.select("run_id").distinct().collect()))
        return runs_depth(store, rows, *args)

    def drain():
        computed.clear()
        job = stream_runs(spark, landing, domain_cfg.store, out, str(tmp_path / "progress"), max_files=1)
        job.awaitTermination()
        assert job.exception() is None

    def stored(run_id):
        return {r["cell"]: r["depth"] for r in spark.read.parquet(out).where(F.col("run_id") == run_id).collect()}

    monkeypatch.setattr("tidegrid.streaming.runs.runs_depth", watched)
    for k in range(3):
        for run in ("a", "b"):
            if run == "a" or k < 2:
                levels.where(F.col("node_id") % 3 == k).coalesce(1).write.mode("append").parquet(f"{landing}/run_id={run}")
    drain()
    assert sorted(computed) == [["a"], ["b"]]
    part = stored("b")
    levels.where("node_id % 3 = 2").coalesce(1).write.mode("append").parquet(f"{landing}/run_id=b")
    drain()
    assert computed == [["b"]]
    whole = runs_depth(TableStore(spark, domain_cfg.store), levels.withColumn("run_id", F.lit("x")))
    want = {r["cell"]: r["depth"] for r in whole.collect()}
    assert len(want) > 300 and stored("a") == pytest.approx(want) and stored("b") == pytest.approx(want) != part


def test_stored_coverage_gives_the_plain_depth(spark, sf, domain_cfg):
    store = TableStore(spark, domain_cfg.store)
    plain = zo.filter_masked(v.coverage(spark, sf))
    stored = store.read("masked_coverage_fraction")
    assert stored.select(plain.columns).exceptAll(plain).count() == 0 and stored.count() == plain.count()


def test_chunk_store_by_bare_and_by_uri_path(spark, sparse, tmp_path):
    bare, uri = str(tmp_path / "a.zarr"), f"file:{tmp_path}/b.zarr"
    rs.write_chunk_store(sparse, META, "depth", bare, "x")
    rs.write_chunk_store(sparse, META, "depth", uri, "x")
    assert rs.read_chunk_store(spark, f"file:{bare}", "x").count() == 6
    assert rs.read_chunk_store(spark, str(tmp_path / "b.zarr"), "x").count() == 6


def test_leftovers_and_failures_leave_the_array_whole(spark, sparse, tmp_path):
    store = str(tmp_path / "fim.zarr")
    rs.write_chunk_store(sparse, META, "depth", store, "x")
    (tmp_path / "fim.zarr" / "x" / "0.0.1234abcd.part").write_bytes(b"half a chunk")
    assert rs.read_chunk_store(spark, store, "x").count() == 6
    broken = sparse.withColumn("depth", F.raise_error(F.lit("lost")).cast("double"))
    with pytest.raises(Exception, match="lost"):
        rs.write_chunk_store(broken, META, "depth", store, "x")
    assert rs.read_chunk_store(spark, store, "x").count() == 6
    assert not [n for n in os.listdir(store) if n.startswith("_")]


def test_cached_tiles_are_released(spark, sparse):
    tiles = rs.tiles_in_memory(sparse, META)
    assert tiles["depth"].count() > 0 and tiles["depth"].storageLevel.useMemory
    rs.release_tiles(tiles)
    assert not tiles["depth"].storageLevel.useMemory


def test_deep_overviews_equal_plain_halving(spark):
    """More levels than one square holds."""
    meta = GridMeta(3000, 2000, (1.0, 0.0, 0.0, 0.0, -1.0, 2000.0))
    df = spark.range(4000).select((F.col("id") * 1499 % 6_000_000 + 1).alias("cell"), (F.col("id") % 17).cast("double").alias("depth"))
    got = {(r["level"], r["row"], r["col"]): r["value"] for r in tl.overviews(df, meta, "depth", 11).collect()}
    level = {((c - 1) // 3000, (c - 1) % 3000): d for c, d in df.collect()}
    want = {}
    for k in range(1, 12):
        groups = {}
        for (r, c), d in level.items():
            groups.setdefault((r // 2, c // 2), []).append(d)
        level = {rc: sum(d) / len(d) for rc, d in groups.items()}
        want.update({(k, *rc): d for rc, d in level.items()})
    assert got == pytest.approx(want)


def test_tasks_follow_the_rows_a_row_stands_for(spark):
    from tidegrid.operators.skew import spread

    before = spark.conf.get("spark.sql.shuffle.partitions")
    spark.conf.set("spark.sql.shuffle.partitions", "2")
    try:
        runs = spark.range(1000).select(F.col("id").alias("row"), F.lit(0).alias("lo"))
        assert spread(runs, "row", stands_for=F.lit(100_000)).rdd.getNumPartitions() == 50
        assert spread(runs, "row", stands_for=F.lit(1)).rdd.getNumPartitions() == 1
        assert spread(runs, "row").rdd.getNumPartitions() >= spark.sparkContext.defaultParallelism
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", before)


def test_a_run_that_turns_dry_leaves_empty_arrays(spark, sf, domain_cfg, tmp_path):
    """Snapshots land as the model writes them; the second landing of a run takes its water away."""
    landing, out, zarr = (str(tmp_path / n) for n in ("landing", "out", "runs.zarr"))
    snapshot = v.snapshot(spark, sf).select("nSCHISM_hgrid_node", F.col("elevation") + 50.0)
    snapshot = snapshot.toDF("nSCHISM_hgrid_node", "elevation")

    def drain():
        job = stream_runs(spark, landing, domain_cfg.store, out, str(tmp_path / "progress"), snapshots=True, chunk_store=zarr)
        job.awaitTermination()
        assert job.exception() is None

    for run in ("r1", "r2"):
        snapshot.write.parquet(f"{landing}/run_id={run}")
    drain()
    wet = rs.read_chunk_store(spark, zarr, "r1_depth").count()
    assert wet > 0 and rs.read_chunk_store(spark, zarr, "r2_depth").count() == wet
    assert spark.read.parquet(out).where("run_id = 'r1'").count() == wet
    snapshot.withColumn("elevation", F.lit(-1e6)).write.mode("overwrite").parquet(f"{landing}/run_id=r1")
    drain()
    assert rs.read_chunk_store(spark, zarr, "r1_depth").count() == 0
    assert rs.read_chunk_store(spark, zarr, "r2_depth").count() == wet
    assert spark.read.parquet(out).where("run_id = 'r1'").count() == 0


def test_overviews_take_one_exchange_and_no_python(spark, sparse):
    plan = tl.overviews(sparse, META, "depth", 7)._jdf.queryExecution().executedPlan().toString()
    assert plan.count("Exchange") == 1 and "Python" not in plan and "Pandas" not in plan
