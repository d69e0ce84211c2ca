"""Queries over sources and sinks: what is written is read back and compared."""

from __future__ import annotations

from pyspark.sql import functions as F

from fixtures import views as v
from fixtures.oracle_views import rnd, view, with_views
from fixtures.queries_core import COV_OUT, DEPTH_OUT, NODE_OUT, cheap_masked
from fixtures.registry import query, rounded, vertices
from fixtures.scratch import scratch_dir
from tidegrid.functions.geometry import ring_wkt
from tidegrid.operators import positions as ps
from tidegrid.operators import tiles as tl
from tidegrid.operators import zonal as zo
from tidegrid.sinks import rasters as rs
from tidegrid.sinks import store as st
from tidegrid.sources import layers as ly
from tidegrid.sources import mesh_text as mt
from tidegrid.sources import tables as tb

# --- sources ----------------------------------------------------------------------------


@query("load_table", f"SELECT o_orderkey, o_custkey, {rnd('o_totalprice', 'o_totalprice')} FROM orders")
def _(spark, sf):
    return rounded(tb.load_table(spark, f"{sf}/orders.parquet").select("o_orderkey", "o_custkey", "o_totalprice"))


@query("register_frame", with_views(["node_box"], "SELECT " + ", ".join(rnd(c, c) for c in ("x0", "y0", "x1", "y1")) + " FROM node_box"))
def _(spark, sf):
    box = v.nodes(spark, sf).selectExpr("min(long) AS x0", "min(lat) AS y0", "max(long) AS x1", "max(lat) AS y1")
    rows = [tuple(r) for r in box.collect()]  # one summary row
    return rounded(tb.register_frame(spark, rows, "x0 double, y0 double, x1 double, y1 double"))


def _mesh_file(spark, sf, counts):
    path = scratch_dir(spark, "mesh")
    v.mesh_lines(spark, sf, counts).write.text(path)
    return path


@query("read_mesh_text_nodes", with_views(["nodes"], f"SELECT {NODE_OUT} FROM nodes"))
def _(spark, sf):
    return rounded(mt.read_mesh_text(spark, _mesh_file(spark, sf, True))[0])


@query("read_mesh_text_elements", with_views(["elements"], "SELECT * FROM elements"))
def _(spark, sf):
    return mt.read_mesh_text(spark, _mesh_file(spark, sf, False))[1]


@query("read_mesh_strict_nodes", with_views(["nodes"], f"SELECT {NODE_OUT} FROM nodes"))
def _(spark, sf):
    return rounded(mt.read_mesh_strict(spark, _mesh_file(spark, sf, True))[0])


@query("read_mesh_strict_elements", with_views(["elements"], """
SELECT row_number() OVER (ORDER BY pg_id) - 1 AS index, pg_id AS element_id,
  num_nodes || ',' || node_id_1 || ',' || node_id_2 || ',' || node_id_3 AS raw FROM elements"""))
def _(spark, sf):
    elements = mt.read_mesh_strict(spark, _mesh_file(spark, sf, True))[1]
    return elements.select("index", "element_id", F.concat_ws(",", F.col("raw").cast("array<string>")).alias("raw"))


def _2dm_file(spark, sf):
    path = scratch_dir(spark, "mesh2dm")
    n = v.nodes(spark, sf).selectExpr("concat_ws(' ', 'ND', node_id, long, lat, wse) AS value")
    e = v.elements(spark, sf).selectExpr("concat_ws('  ', 'E3T', pg_id, node_id_1, node_id_2, node_id_3, 1) AS value")
    n.unionByName(e).write.text(path)
    return path


@query("read_2dm_nodes", with_views(["nodes"], f"""
SELECT node_id, {rnd('long', 'x')}, {rnd('lat', 'y')}, {rnd('wse', 'z')} FROM nodes"""))
def _(spark, sf):
    return rounded(mt.read_2dm(spark, _2dm_file(spark, sf))[0])


@query("read_2dm_elements", with_views(["elements"], """
SELECT pg_id AS element_id, node_id_1 AS node1, node_id_2 AS node2, node_id_3 AS node3 FROM elements"""))
def _(spark, sf):
    return mt.read_2dm(spark, _2dm_file(spark, sf))[1]


view("snapshot_nodes", ["nodes"], """
SELECT node_id, long, lat, CASE WHEN (node_id - 1) % 50 = 9 THEN NULL ELSE wse END AS wse FROM nodes""")


@query("normalize_node_wse", with_views(["snapshot_nodes"], f"SELECT {NODE_OUT} FROM snapshot_nodes"))
def _(spark, sf):
    return rounded(tb.normalize_node_wse(v.snapshot(spark, sf)))


@query("read_crosswalk", with_views(["crosswalk"], "SELECT * FROM crosswalk"))
def _(spark, sf):
    path = scratch_dir(spark, "crosswalk")
    st.export_node_ids(v.land_mask(spark, sf), path)
    return mt.read_crosswalk(spark, path)


@query("read_zonal", with_views(["cheap_coverage"], f"""
SELECT {COV_OUT.replace(', mask', '')}, coalesce(mask, false) AS mask FROM cheap_coverage"""))
def _(spark, sf):
    path = scratch_dir(spark, "zonal")
    numeric = F.when(F.col("mask"), F.lit(1.0)).when(~F.col("mask"), F.lit(0.0))
    v.cheap_coverage(spark, sf).withColumn("mask", numeric).write.parquet(path)
    return rounded(tb.read_zonal(spark, path))


@query("register_layers", with_views(["diamonds"], f"""
SELECT layer || '_atlgulf' AS layer, feature_id, pos, {rnd('x', 'x', 5)}, {rnd('y', 'y', 5)} FROM (
  SELECT layer, feature_id, 0 AS pos, cx - 0.01035::double AS x, cy AS y FROM diamonds
  UNION ALL SELECT layer, feature_id, 1, cx, cy - 0.01035::double FROM diamonds
  UNION ALL SELECT layer, feature_id, 2, cx + 0.01035::double, cy FROM diamonds
  UNION ALL SELECT layer, feature_id, 3, cx, cy + 0.01035::double FROM diamonds
  UNION ALL SELECT layer, feature_id, 4, cx - 0.01035::double, cy FROM diamonds)"""))
def _(spark, sf):
    folder = scratch_dir(spark, "layers")
    for name in v.LAYERS:
        part = v.interior_layers(spark, sf).where(F.col("layer") == name)
        part.select("feature_id", ring_wkt("ring").alias("geometry")).write.parquet(f"{folder}/{name}.parquet")
    layers, _, _ = ly.register_layers(spark, folder)
    flat = layers.select("layer", "feature_id", F.posexplode("ring").alias("pos", "p"))
    return rounded(flat.select("layer", "feature_id", "pos", F.col("p.x").alias("x"), F.col("p.y").alias("y")), 5)


@query("convert_elements", with_views(["elements", "nodes"], f"""
SELECT pg_id, pos, {rnd('long', 'x')}, {rnd('lat', 'y')} FROM (
  SELECT pg_id, 0 AS pos, node_id_1 AS node_id FROM elements
  UNION ALL SELECT pg_id, 1, node_id_2 FROM elements UNION ALL SELECT pg_id, 2, node_id_3 FROM elements) e
JOIN nodes USING (node_id)"""))
def _(spark, sf):
    raw = v.rings(spark, sf).selectExpr("pg_id AS elementID", "ring AS geometry", "1 AS num_nodes")
    return vertices(tb.convert_elements(raw), ["pg_id"], "geometry")


@query("dem_cells", with_views(["dem"], f"SELECT cell, {rnd('elevation', 'elevation')} FROM dem"))
def _(spark, sf):
    return rounded(tl.dem_cells(v.dem_tiles(spark, sf), v.grid(spark, sf), -9999.0))


view("type_grids", [], """
SELECT 'grid ' || event_type AS dem_metadata, count(*) AS height, CAST(max(event_id) AS BIGINT) AS width,
  round(min(value), 2) AS x, round(max(value), 2) AS y FROM events GROUP BY event_type""")


def _meta_sql(grids):
    return with_views([grids], f"""
SELECT dem_metadata, 'EPSG:4326' AS crs, CAST(height AS INTEGER) AS height, CAST(width AS INTEGER) AS width, x, y FROM {grids}""")


def _corner(df):
    parsed = df.withColumn("t", F.from_json("transform", "array<double>"))
    return parsed.select("dem_metadata", "crs", "height", "width", F.col("t")[2].alias("x"), F.col("t")[5].alias("y"))


@query("store_dem_metadata", _meta_sql("user_grids"))
def _(spark, sf):
    store = st.TableStore(spark, scratch_dir(spark, "meta"))
    for _ in range(2):  # storing again replaces the records
        store.upsert(v.event_grids(spark, sf, "user_id"), "dem_metadata", "dem_metadata")
    return _corner(store.read("dem_metadata"))


@query("load_dem_metadata", _meta_sql("type_grids"))
def _(spark, sf):
    stored = v.event_grids(spark, sf, "event_type")
    keys = [r[0] for r in stored.select("dem_metadata").collect()]  # one per kind of event
    rows = [tb.metadata_row(spark, tb.load_dem_metadata(stored, key), key) for key in keys]
    whole = rows[0]
    for more in rows[1:]:
        whole = whole.unionByName(more)
    return _corner(whole)


# --- table sinks ------------------------------------------------------------------------


def cheap_depth(spark, sf):
    return zo.depth(cheap_masked(spark, sf), v.triangle_values(spark, sf))


CHEAP = with_views(["cheap_depth"], f"SELECT {DEPTH_OUT} FROM cheap_depth WHERE depth >= 0")


@query("write_table", with_views(["cheap_depth"], f"SELECT {DEPTH_OUT} FROM cheap_depth WHERE depth >= 0.25::double"))
def _(spark, sf):
    root = scratch_dir(spark, "store")
    stored = st.write_table(cheap_depth(spark, sf), root, "depth")
    # The second write replaces the table it reads.
    return rounded(st.write_table(zo.filter_depth(stored, 0.25), root, "depth"))


@query("record_crs", with_views(["diamonds"], "SELECT DISTINCT layer AS table_name, 'EPSG:4326' AS crs FROM diamonds"))
def _(spark, sf):
    store = st.TableStore(spark, scratch_dir(spark, "crs"))
    names = v.interior_layers(spark, sf).select(F.col("layer").alias("table_name")).distinct()
    for _ in range(2):
        store.upsert(names.withColumn("crs", F.lit("EPSG:4326")), "metadata", "table_name")
    return store.read("metadata")


@query("materialize_result", CHEAP)
def _(spark, sf):
    path = scratch_dir(spark, "result")
    st.materialize_result(cheap_depth(spark, sf), path)
    return rounded(tb.load_result(spark, path))


@query("observed_row_count", with_views(["cheap_depth"], "SELECT count(*) AS rows FROM cheap_depth WHERE depth >= 0"))
def _(spark, sf):
    rows = st.materialize_result(cheap_depth(spark, sf), scratch_dir(spark, "counted"))
    return spark.range(1).select(F.lit(rows).cast("long").alias("rows"))


@query("load_result", CHEAP)
def _(spark, sf):
    path = scratch_dir(spark, "loaded")
    cheap_depth(spark, sf).write.parquet(path)
    return rounded(tb.load_result(spark, path))


@query("export_node_ids", with_views(["crosswalk"], "SELECT node_id_gr3 AS node_id FROM crosswalk"))
def _(spark, sf):
    path = scratch_dir(spark, "ids")
    st.export_node_ids(v.land_mask(spark, sf), path)
    return spark.read.text(path).select(F.col("value").cast("long").alias("node_id"))


@query("export_land_mask", with_views(["land_mask"], "SELECT pos, CAST(Mask AS INTEGER) AS Mask FROM land_mask"))
def _(spark, sf):
    path = scratch_dir(spark, "mask")
    st.export_land_mask(v.land_mask(spark, sf), path)
    return spark.read.parquet(path)


@query("export_mesh", with_views(["nodes", "elements"], f"""
SELECT 'node' AS kind, node_id AS id, {rnd('long', 'a')}, {rnd('lat', 'b')}, {rnd('wse', 'c')} FROM nodes
UNION ALL SELECT 'element', pg_id, node_id_1, node_id_2, node_id_3 FROM elements"""))
def _(spark, sf):
    base = scratch_dir(spark, "export")
    st.export_mesh(v.nodes(spark, sf), v.elements(spark, sf), f"{base}/nodes", f"{base}/elements")
    nodes = spark.read.parquet(f"{base}/nodes").selectExpr("'node' AS kind", "node_id AS id", "long AS a", "lat AS b", "wse AS c")
    ids = [f"CAST(node_id_{k} AS double) AS {c}" for k, c in ((1, "a"), (2, "b"), (3, "c"))]
    return rounded(nodes.unionByName(spark.read.parquet(f"{base}/elements").selectExpr("'element' AS kind", "pg_id AS id", *ids)))


@query("read_mesh_text_nan", with_views(["nodes"], f"""
SELECT node_id, {rnd('long', 'long')}, {rnd('lat', 'lat')}, CASE WHEN node_id % 5 <> 2 THEN {rnd('wse', 'wse').rsplit(' AS ', 1)[0]} END AS wse
FROM nodes"""))
def _(spark, sf):
    path = scratch_dir(spark, "nan")
    level = F.when(F.col("node_id") % 5 == 2, F.lit("NaN")).otherwise(F.col("wse").cast("string"))
    lines = v.nodes(spark, sf).select(F.concat_ws(" ", "node_id", "long", "lat", level).alias("value"), F.col("node_id").alias("i"))
    header = lines.limit(1).select(F.lit("a header").alias("value"), F.lit(-1).cast("long").alias("i"))
    header.unionByName(lines).orderBy("i").select("value").write.text(path)
    return rounded(mt.read_mesh_text(spark, path)[0])


# --- raster sinks -----------------------------------------------------------------------

RASTER = "SELECT cell, round(CAST(CAST(depth AS FLOAT) AS DOUBLE), 3) + 0.0::double AS value FROM "


@query("write_tiles", with_views(["terrain"], RASTER + "terrain"))
def _(spark, sf):
    meta = v.grid(spark, sf)
    tiles = rs.write_tiles(v.terrain_raster(spark, sf), meta, "depth", scratch_dir(spark, "tiles"), tile=64)
    return rounded(tl.tiles_to_cells(tiles, meta), 3)


@query("write_tiles_legacy", with_views(["terrain"], RASTER + "terrain WHERE depth >= 0.5::double"))
def _(spark, sf):
    meta = v.grid(spark, sf)
    tiles = rs.write_tiles(v.terrain_raster(spark, sf), meta, "depth", scratch_dir(spark, "tiles"), 1000,
                           float("nan"), depth_threshold=0.5)
    return rounded(tl.tiles_to_cells(tiles, meta, float("nan")), 3)


@query("tile_index", with_views(["terrain", "grid"], """
SELECT CAST(((cell-1)//150)//64 AS INTEGER) AS tile_row, CAST(((cell-1)%150)//64 AS INTEGER) AS tile_col,
  CAST(least(64, height - 64 * (((cell-1)//150)//64)) AS INTEGER) AS n_rows,
  CAST(least(64, 150 - 64 * (((cell-1)%150)//64)) AS INTEGER) AS n_cols
FROM terrain, grid GROUP BY ALL"""))
def _(spark, sf):
    tiles = tl.build_tiles(v.terrain_raster(spark, sf), v.grid(spark, sf), "depth", tile=64)
    return tiles.select("tile_row", "tile_col", "n_rows", "n_cols")


@query("write_chunk_store", with_views(["terrain"], RASTER + "terrain WHERE depth >= 0.25::double"))
def _(spark, sf):
    meta, store = v.grid(spark, sf), scratch_dir(spark, "chunks")
    cells = v.terrain_raster(spark, sf)
    rs.write_chunk_store(cells, meta, "depth", store, "r2_depth", 64, unique=True)
    # The second write of the same array replaces it.
    for threshold in (0.0, 0.25):
        rs.write_chunk_store(zo.filter_depth(cells, threshold), meta, "depth", store, "r1_depth", 64, unique=True)
    return rounded(rs.read_chunk_store(spark, store, "r1_depth"), 3)


@query("tiles_in_memory", with_views(["terrain"], RASTER + "terrain"))
def _(spark, sf):
    tiles = rs.tiles_in_memory(v.terrain_raster(spark, sf), v.grid(spark, sf))
    return rounded(tl.tiles_to_cells(tiles["depth"], v.grid(spark, sf)), 3)


def _overview_sql() -> str:
    views = ["l0 AS (SELECT (cell-1)//150 AS row, (cell-1)%150 AS col, depth AS value FROM terrain)"]
    for k in (1, 2, 3):
        views.append(f"l{k} AS (SELECT row//2 AS row, col//2 AS col, avg(value) AS value FROM l{k-1} GROUP BY 1, 2)")
    body = " UNION ALL ".join(f"SELECT {k} AS level, row, col, {rnd('value', 'value')} FROM l{k}" for k in (1, 2, 3))
    return with_views(["terrain"], ", " + ", ".join(views) + " " + body)


@query("overviews", _overview_sql())
def _(spark, sf):
    return rounded(tl.overviews(v.terrain_raster(spark, sf), v.grid(spark, sf), "depth", levels=3))


@query("ordered_result", CHEAP)
def _(spark, sf):
    return rounded(tl.ordered_result(cheap_depth(spark, sf)))


@query("page", with_views(["dem"], f"SELECT cell, {rnd('elevation', 'elevation')} FROM dem ORDER BY cell LIMIT 500 OFFSET 500"))
def _(spark, sf):
    return rounded(ps.page(v.dem(spark, sf), 500, 1))


@query("row_positions", "SELECT o_orderkey, row_number() OVER (ORDER BY o_orderkey) - 1 AS position FROM orders")
def _(spark, sf):
    return ps.row_positions(v.table(spark, sf, "orders").select("o_orderkey"), "o_orderkey")
