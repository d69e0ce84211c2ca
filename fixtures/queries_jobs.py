"""Queries that run whole jobs over stored inputs and read their results back."""

from __future__ import annotations

from pyspark.sql import functions as F

from fixtures import views as v
from fixtures.oracle_views import barycentric_view, depth_view, rnd, view, with_views
from fixtures.queries_core import DEPTH_OUT, WEIGHT_OUT, ready_nodes
from fixtures.queries_io import RASTER
from fixtures.registry import query, rounded
from fixtures.scratch import scratch_dir
from tidegrid.functions.geometry import ring_wkt
from tidegrid.operators import elements as el
from tidegrid.operators import masks as mk
from tidegrid.operators import tiles as tl
from tidegrid.operators import zonal as zo
from tidegrid.operators.weights import barycentric_weights, triangle_barycentric
from tidegrid.plans import domain, forecast
from tidegrid.plans.config import JobConfig
from tidegrid.session import colocated_joins
from tidegrid.sinks import rasters as rs
from tidegrid.sinks.store import TableStore, export_node_ids
from tidegrid.sources.filesystem import validate_inputs
from tidegrid.streaming.runs import stream_runs

# --- oracle views of the jobs -------------------------------------------------------------

view("job_elements", ["elements", "masked_coverage"], """
SELECT * FROM elements WHERE pg_id IN (SELECT pg_id FROM masked_coverage)""")
view("job_weights", ["weights", "job_elements"], """
SELECT * FROM weights WHERE pg_id IN (SELECT pg_id FROM job_elements)""")
view("job_nodes", ["snapshot_nodes", "crosswalk", "ready_nodes"], """
SELECT c.node_id_gr3 AS node_id, n.long, n.lat, n.wse FROM snapshot_nodes n
JOIN crosswalk c ON n.node_id = c.node_id_nc
WHERE c.node_id_gr3 IN (SELECT node_id FROM ready_nodes)""")
barycentric_view("job_barycentric", "job_weights", "job_nodes")
depth_view("job_depth", "masked_coverage", "job_barycentric")


# --- inputs ---------------------------------------------------------------------------------


def prepared(spark, sf, **switches):
    """A preprocessed domain in a fresh store, and the configuration to run it with."""
    root = scratch_dir(spark, "domain")
    cfg = JobConfig(
        store=f"{root}/tables", mesh_path=f"{root}/mesh", crosswalk_path=f"{root}/crosswalk",
        coverage_path=f"{root}/coverage", snapshot_path=f"{root}/run_0600z.parquet",
        output_path=f"{root}/out", **switches,
    )
    v.mesh_lines(spark, sf).write.text(cfg.mesh_path)
    export_node_ids(v.land_mask(spark, sf), cfg.crosswalk_path)
    v.coverage(spark, sf).write.parquet(cfg.coverage_path)
    v.snapshot(spark, sf).write.parquet(cfg.snapshot_path)
    domain.preprocess(spark, cfg, v.dem(spark, sf), v.grid(spark, sf))
    return cfg


@query("preprocess", with_views(["job_weights"], f"SELECT {WEIGHT_OUT} FROM job_weights"))
def _(spark, sf):
    return rounded(TableStore(spark, prepared(spark, sf).store).read("triangle_weights"))


@query("execute", with_views(["job_depth"], RASTER + "job_depth WHERE depth >= 0"))
def _(spark, sf):
    cfg = prepared(spark, sf, output_format="ZARR")
    forecast.execute(spark, cfg)
    cells = rs.read_chunk_store(spark, f"{cfg.output_path}/depth.zarr", "run_0600z_depth")
    return rounded(cells, 3)


@query("depth_by_tile", with_views(["slope_depth"], f"SELECT {DEPTH_OUT} FROM slope_depth WHERE depth >= 0"))
def _(spark, sf):
    store = TableStore(spark, scratch_dir(spark, "tiled"))
    # Stored first, as jobs find them: the layout reads its input several times, the weights their nodes.
    raw = store.write(v.coverage(spark, sf), "coverage_fraction")
    ready = store.write(ready_nodes(spark, sf), "nodes")
    # Small tiles and a low limit, so that some tiles are salted and others are not.
    cov = domain.store_coverage(store, raw, v.grid(spark, sf), tile=16, hot_rows=500)
    weights = barycentric_weights(el.filter_valid_elements(v.elements(spark, sf), ready), ready)
    triangles = store.write(triangle_barycentric(weights, ready), "triangles")
    with colocated_joins(spark):
        cells = store.write(zo.depth_by_tile(cov, store.read("triangle_tiles"), triangles), "depth")
    return rounded(cells)


@query("execute_legacy", with_views(["job_depth"], RASTER + "job_depth WHERE depth >= 0.1524::double"))
def _(spark, sf):
    cfg = prepared(spark, sf, low_memory=False, depth_threshold=0.1524)
    forecast.execute(spark, cfg)
    tiles = spark.read.parquet(f"{cfg.output_path}/run_0600z_depth")
    return rounded(tl.tiles_to_cells(tiles, v.grid(spark, sf)), 3)


@query("interpolate_and_rasterize", with_views(["job_depth"], f"""
SELECT cell, round(CAST(CAST(wse_cell_weighted_average AS FLOAT) AS DOUBLE), 3) + 0.0::double AS value
FROM job_depth WHERE depth >= 0"""))
def _(spark, sf):
    cfg = prepared(spark, sf, output_format="IN_MEMORY", generate_wse=True)
    _, tiles = forecast.execute(spark, cfg)
    return rounded(tl.tiles_to_cells(tiles["wse"], v.grid(spark, sf)), 3)


def _stored_layers(spark, sf):
    folder = scratch_dir(spark, "mask-layers")
    for name in v.LAYERS:
        part = v.interior_layers(spark, sf).where(F.col("layer") == name)
        part.select("feature_id", "ring").write.parquet(f"{folder}/{name}.parquet")
    for name in ("domain", "state"):
        v.exterior_layer(spark, sf, name).select("feature_id", "ring").write.parquet(f"{folder}/{name}.parquet")
    return folder


def _mask_config(spark, sf):
    return JobConfig(
        store=scratch_dir(spark, "mask-store"), layers_path=_stored_layers(spark, sf),
        exterior_layers=("domain_atlgulf", "state_atlgulf"),
        interior_layers=tuple(f"{n}_atlgulf" for n in v.LAYERS),
    )


@query("build_mask", with_views(["general_masked"], "SELECT cell FROM general_masked WHERE mask"))
def _(spark, sf):
    meta = v.grid(spark, sf)
    return mk.run_cells(domain.build_mask(spark, _mask_config(spark, sf), meta), meta)


@query("build_coverage", with_views(["coverage", "general_masked"], f"""
SELECT c.pg_id, c.cell, {rnd('c.coverage_fraction', 'coverage_fraction')}, {rnd('c.elevation', 'elevation')}, g.mask
FROM coverage c JOIN general_masked g ON c.cell = g.cell"""))
def _(spark, sf):
    cfg, meta = _mask_config(spark, sf), v.grid(spark, sf)
    domain.build_mask(spark, cfg, meta)
    return rounded(domain.build_coverage(spark, cfg, v.rings(spark, sf), v.dem(spark, sf), meta))


@query("convert_mesh", with_views(["elements", "nodes"], f"""
SELECT e.pg_id, e.num_nodes, e.node_id_1, e.node_id_2, e.node_id_3, {rnd('(a.wse + b.wse + c.wse) / 3', 'mean_wse')}
FROM elements e JOIN nodes a ON a.node_id = e.node_id_1 JOIN nodes b ON b.node_id = e.node_id_2
JOIN nodes c ON c.node_id = e.node_id_3"""))
def _(spark, sf):
    root = scratch_dir(spark, "convert")
    v.mesh_lines(spark, sf).write.text(f"{root}/mesh")
    domain.convert_mesh(spark, f"{root}/mesh", f"{root}/nodes", f"{root}/elements")
    stored = spark.read.parquet(f"{root}/elements")
    return rounded(stored.select("pg_id", "num_nodes", "node_id_1", "node_id_2", "node_id_3", "mean_wse"))


@query("build_crosswalk", with_views(["crosswalk"], "SELECT * FROM crosswalk"))
def _(spark, sf):
    root = scratch_dir(spark, "xwalk")
    return domain.build_crosswalk(v.land_mask(spark, sf), f"{root}/mask", f"{root}/ids")


@query("validate_inputs", """
SELECT 'orders' AS name, true AS found, count(*) AS rows FROM orders UNION ALL SELECT 'lineitem', true, count(*) FROM lineitem
UNION ALL SELECT 'events', true, count(*) FROM events UNION ALL SELECT 'no such table', false, 0""")
def _(spark, sf):
    rows = []
    for name in ("orders", "lineitem", "events", "no such table"):
        path = f"{sf}/{name}.parquet"
        try:
            validate_inputs(spark, path)
            rows.append(v.table(spark, sf, name).agg(F.lit(name).alias("name"), F.lit(True).alias("found"), F.count(F.lit(1)).alias("rows")))
        except FileNotFoundError:
            rows.append(spark.range(1).select(F.lit(name).alias("name"), F.lit(False).alias("found"), F.lit(0).cast("long").alias("rows")))
    first, *rest = rows
    for more in rest:
        first = first.unionByName(more)
    return first


@query("execute_overviews", with_views(["job_depth"], f"""
, l0 AS (SELECT (cell-1)//150 AS row, (cell-1)%150 AS col, depth AS value FROM job_depth WHERE depth >= 0),
l1 AS (SELECT row//2 AS row, col//2 AS col, avg(value) AS value FROM l0 GROUP BY 1, 2)
SELECT 1 AS level, row, col, {rnd('value', 'value')} FROM l1"""))
def _(spark, sf):
    cfg = prepared(spark, sf, overview_levels=1)  # a raster of one tile has none by default
    forecast.execute(spark, cfg)
    stored = spark.read.parquet(f"{cfg.output_path}/run_0600z_depth_overviews")
    return rounded(stored.select("level", "row", "col", "value"))


# --- incremental runs -------------------------------------------------------------------


# Runs as the model writes them: positions from 0, of the nodes that the crosswalk knows.
view("known_runs", ["runs", "crosswalk"], "SELECT * FROM runs WHERE node_id IN (SELECT node_id_gr3 FROM crosswalk)")
view("known_run_depth", ["known_runs", "weights", "masked_coverage"], """
SELECT w.run_id, w.cell, w.wse - e.elevation AS depth FROM (
  SELECT r1.run_id, c.cell, sum((w.node1_weight * r1.wse + w.node2_weight * r2.wse + w.node3_weight * r3.wse) * c.coverage_fraction)
    / any_value(t.total) AS wse
  FROM weights w JOIN known_runs r1 ON w.node_id_1 = r1.node_id
  JOIN known_runs r2 ON w.node_id_2 = r2.node_id AND r2.run_id = r1.run_id
  JOIN known_runs r3 ON w.node_id_3 = r3.node_id AND r3.run_id = r1.run_id
  JOIN masked_coverage c ON c.pg_id = w.pg_id
  JOIN (SELECT cell, sum(coverage_fraction) AS total FROM masked_coverage GROUP BY cell) t ON t.cell = c.cell
  GROUP BY r1.run_id, c.cell) w
JOIN (SELECT cell, max(elevation) AS elevation FROM masked_coverage GROUP BY cell) e ON w.cell = e.cell
WHERE w.wse - e.elevation >= 0""")


@query("stream_runs_rasters", with_views(["known_run_depth"], """
SELECT run_id, cell, round(CAST(CAST(depth AS FLOAT) AS DOUBLE), 3) + 0.0::double AS value FROM known_run_depth"""))
def _(spark, sf):
    cfg = prepared(spark, sf)
    root = scratch_dir(spark, "snapshots")
    known = v.runs(spark, sf).join(v.crosswalk(spark, sf), F.col("node_id") == F.col("node_id_gr3"))
    landed = known.select("run_id", (F.col("node_id_nc") - 1).alias("nSCHISM_hgrid_node"), F.col("wse").alias("elevation"))
    landed.write.partitionBy("run_id").parquet(f"{root}/landed")
    job = stream_runs(spark, f"{root}/landed", cfg.store, f"{root}/depth", f"{root}/progress", snapshots=True,
                      chunk_store=f"{root}/depth.zarr")
    job.awaitTermination()
    if job.exception() is not None:
        raise job.exception()
    runs = sorted(r["run_id"] for r in landed.select("run_id").distinct().collect())  # one per day of events
    parts = [rs.read_chunk_store(spark, f"{root}/depth.zarr", f"{run}_depth").withColumn("run_id", F.lit(run)) for run in runs]
    if not parts:
        return spark.createDataFrame([], "run_id string, cell bigint, value double")
    whole = parts[0]
    for part in parts[1:]:
        whole = whole.unionByName(part)
    return rounded(whole.select("run_id", "cell", "value"), 3)


@query("stream_runs", with_views(["run_depth"], f"SELECT run_id, {DEPTH_OUT} FROM run_depth"))
def _(spark, sf):
    cfg = prepared(spark, sf)
    root = scratch_dir(spark, "landing")
    v.runs(spark, sf).write.partitionBy("run_id").parquet(f"{root}/landed")
    job = stream_runs(spark, f"{root}/landed", cfg.store, f"{root}/depth", f"{root}/progress")
    job.awaitTermination()
    schema = "run_id string, cell bigint, wse_cell_weighted_average double, elevation double, depth double"
    if job.lastProgress is None:
        return spark.createDataFrame([], schema)
    return rounded(spark.read.schema(schema).parquet(f"{root}/depth").select(
        "run_id", "cell", "wse_cell_weighted_average", "elevation", "depth"))
