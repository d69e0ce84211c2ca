"""Queries over nodes, triangles, coverage and depth."""

from __future__ import annotations

from pyspark.sql import functions as F

from fixtures import views as v
from fixtures.oracle_views import rnd, view, with_views
from fixtures.registry import query, rounded, vertices
from fixtures.scratch import scratch_dir
from tidegrid.functions import geometry, grid, scalars
from tidegrid.operators import elements as el
from tidegrid.operators import nodes as nd
from tidegrid.operators import quality as ql
from tidegrid.operators import skew
from tidegrid.operators import weights as wt
from tidegrid.operators import zonal as zo
from tidegrid.operators.overlay import attach_cell_attributes, coverage_fraction, tessellate
from tidegrid.sinks.store import TableStore

NODE_OUT = f"node_id, {rnd('long', 'long')}, {rnd('lat', 'lat')}, {rnd('wse', 'wse')}"
NODE_ELEV = f"node_id, {rnd('long', 'long')}, {rnd('lat', 'lat')}, {rnd('elevation', 'elevation')}"
DEPTH_OUT = (
    f"cell, {rnd('wse_cell_weighted_average', 'wse_cell_weighted_average')}, "
    f"{rnd('elevation', 'elevation')}, {rnd('depth', 'depth')}"
)
WEIGHT_OUT = "pg_id, num_nodes, node_id_1, node_id_2, node_id_3, " + ", ".join(
    rnd(f"node{k}_weight", f"node{k}_weight") for k in (1, 2, 3)
)
BARY_OUT = f"{WEIGHT_OUT}, " + ", ".join(
    rnd(c, c) for c in ("centroid_long", "centroid_lat", "wse_weighted_average")
)


# --- helpers shared by the Spark sides --------------------------------------------------


def ready_nodes(spark, sf):
    return nd.add_elevation(v.nodes(spark, sf), v.nodes_elevation(spark, sf))


def equal_triangles(spark, sf):
    return wt.triangle_barycentric(wt.equal_weights(v.elements(spark, sf)), ready_nodes(spark, sf))


def slope_weights(spark, sf):
    ready = ready_nodes(spark, sf)
    return wt.barycentric_weights(el.filter_valid_elements(v.elements(spark, sf), ready), ready)


def cheap_masked(spark, sf):
    return zo.filter_masked(v.cheap_coverage(spark, sf))


# --- projections ------------------------------------------------------------------------


@query("add_point", with_views(["nodes"], f"SELECT {NODE_OUT}, {rnd('long', 'x')}, {rnd('lat', 'y')} FROM nodes"))
def _(spark, sf):
    df = geometry.add_point(v.nodes(spark, sf))
    return rounded(df.select("node_id", "long", "lat", "wse", F.col("geometry.x").alias("x"),
                             F.col("geometry.y").alias("y")))


@query("node_points", with_views(["nodes"], f"SELECT {NODE_OUT}, {rnd('long', 'x')}, {rnd('lat', 'y')} FROM nodes"))
def _(spark, sf):
    df = nd.node_points(v.nodes(spark, sf))
    return rounded(df.select("node_id", "long", "lat", "wse", "geometry.x", "geometry.y"))


@query("cell_to_rowcol", with_views(["dem"], "SELECT cell, (cell-1)//150 AS row, (cell-1)%150 AS col FROM dem"))
def _(spark, sf):
    return grid.cell_to_rowcol(v.dem(spark, sf), v.WIDTH).select("cell", "row", "col")


@query("tile_key", with_views(["dem"], """
SELECT cell, ((cell-1)//150) - ((cell-1)//150) % 64 AS row_off, ((cell-1)%150) - ((cell-1)%150) % 64 AS col_off,
  CAST(((cell-1)//150) % 64 AS INTEGER) AS tile_r, CAST(((cell-1)%150) % 64 AS INTEGER) AS tile_c FROM dem"""))
def _(spark, sf):
    placed = grid.tile_key(grid.cell_to_rowcol(v.dem(spark, sf), v.WIDTH), 64)
    return placed.select("cell", "row_off", "col_off", "tile_r", "tile_c")


@query("index_triangles", with_views(["elements"], "SELECT pg_id + 1 AS pg_id, node_id_1 FROM elements"))
def _(spark, sf):
    return el.index_triangles(v.elements(spark, sf).select(F.col("pg_id").alias("FID"), "node_id_1"))


@query("run_name", """
SELECT event_id, event_type || '.t' || CAST(user_id AS VARCHAR) || 'z_depth' AS run_name FROM events""")
def _(spark, sf):
    path = F.concat(F.lit("/data/run/"), "event_type", F.lit(".t"), F.col("user_id").cast("string"), F.lit("z.nc"))
    return v.table(spark, sf, "events").select("event_id", scalars.run_name(path, "_depth").alias("run_name"))


@query("parse_flag", "SELECT l_orderkey, l_linenumber, l_linenumber % 2 = 0 AS flag FROM lineitem")
def _(spark, sf):
    word = F.element_at(
        F.array(*[F.lit(w) for w in ("Yes", "no", "TRUE", "f", "1", "0")]),
        F.when(F.col("l_linenumber") % 2 == 0, 1 + 2 * (F.col("l_orderkey") % 3))
        .otherwise(2 + 2 * (F.col("l_orderkey") % 3)).cast("int"),
    )
    return v.table(spark, sf, "lineitem").select("l_orderkey", "l_linenumber", scalars.parse_flag(word).alias("flag"))


@query("vertex_slope", with_views(["slopes"], f"SELECT pg_id, {rnd('s1', 'slope')} FROM slopes"))
def _(spark, sf):
    ready = ready_nodes(spark, sf)
    t = el.filter_valid_elements(v.elements(spark, sf), ready)
    for k in (1, 2, 3):
        t = t.join(ready.select(F.col("node_id").alias(f"node_id_{k}"), F.col("long").alias(f"x{k}"),
                                F.col("lat").alias(f"y{k}"), F.col("elevation").alias(f"z{k}")), f"node_id_{k}")
    corner = lambda k: tuple(F.col(f"{a}{k}") for a in "xyz")
    return rounded(t.select("pg_id", wt.vertex_slope(corner(1), corner(2), corner(3)).alias("slope")))


# One grid per user of the events: as many rows as events, its corner from their values.
view("user_grids", [], """
SELECT 'grid ' || user_id AS dem_metadata, count(*) AS height, CAST(max(event_id) AS BIGINT) AS width,
  round(min(value), 2) AS x, round(max(value), 2) AS y FROM events GROUP BY user_id""")


@query("geotransform", with_views(["user_grids"], """
SELECT dem_metadata, 'EPSG:4326' AS crs, CAST(height AS INTEGER) AS height, CAST(width AS INTEGER) AS width,
  x AS gt_origin_x, 0.5::double AS gt_pixel_w, 0.0::double AS gt_row_rot,
  y AS gt_origin_y, 0.0::double AS gt_col_rot, -0.25::double AS gt_pixel_h FROM user_grids"""))
def _(spark, sf):
    return grid.geotransform(v.event_grids(spark, sf, "user_id"))


@query("to_crs_mercator", with_views(["nodes"], f"""
SELECT node_id, {rnd('radians(long) * 6378137', 'long', 3)},
  {rnd('ln(tan(pi()/4 + radians(lat)/2)) * 6378137', 'lat', 3)} FROM nodes"""))
def _(spark, sf):
    moved = geometry.to_crs(v.nodes(spark, sf), "EPSG:4326", "EPSG:3857")
    return rounded(moved.select("node_id", "long", "lat"), 3)


@query("to_crs_round_trip", with_views(["nodes"], f"SELECT {NODE_OUT} FROM nodes"))
def _(spark, sf):
    there = geometry.to_crs(v.nodes(spark, sf), "EPSG:4326", "EPSG:3857")
    return rounded(geometry.to_crs(there, "EPSG:3857", "EPSG:4326"))


@query("to_crs_albers", with_views(["nodes"], f"""
, k AS (SELECT 0.006694380022900787::double AS e2, sqrt(0.006694380022900787::double) AS e),
q AS (SELECT p.id, (1-e2) * (sin(p.la)/(1-e2*sin(p.la)**2) - ln((1-e*sin(p.la))/(1+e*sin(p.la)))/(2*e)) AS q,
    cos(p.la)/sqrt(1-e2*sin(p.la)**2) AS m
  FROM k, (SELECT * FROM (VALUES (0, radians(23.0::double)), (1, radians(29.5::double)), (2, radians(45.5::double))) t(id, la)) p),
cone AS (SELECT q0.q AS q0, q1.q AS q1, (q1.m**2 - q2.m**2)/(q2.q - q1.q) AS n, q1.m AS m1
  FROM q q0, q q1, q q2 WHERE q0.id = 0 AND q1.id = 1 AND q2.id = 2),
setup AS (SELECT n, m1**2 + n*q1 AS c, q0 FROM cone),
pts AS (SELECT node_id, radians(long + 96) AS dl,
    (1-e2) * (sin(radians(lat))/(1-e2*sin(radians(lat))**2)
      - ln((1-e*sin(radians(lat)))/(1+e*sin(radians(lat))))/(2*e)) AS q FROM nodes, k)
SELECT node_id, {rnd('6378137 * sqrt(c - n*q)/n * sin(n*dl)', 'long', 3)},
  {rnd('6378137 * sqrt(c - n*q0)/n - 6378137 * sqrt(c - n*q)/n * cos(n*dl)', 'lat', 3)}
FROM pts, setup"""))
def _(spark, sf):
    moved = geometry.to_crs(v.nodes(spark, sf), "EPSG:4326", "EPSG:5070")
    return rounded(moved.select("node_id", "long", "lat"), 3)


# --- node and element filters -----------------------------------------------------------

view("crosswalked", ["nodes", "crosswalk"], """
SELECT n.node_id AS original_id, c.node_id_gr3 AS node_id, n.long, n.lat, n.wse
FROM nodes n LEFT JOIN crosswalk c ON n.node_id = c.node_id_nc""")


@query("crosswalk_nodes", with_views(["crosswalked"], f"SELECT original_id, {NODE_OUT} FROM crosswalked"))
def _(spark, sf):
    return rounded(nd.crosswalk_nodes(v.nodes(spark, sf), v.crosswalk(spark, sf)))


@query("extract_elevation", with_views(["nodes_elevation"], f"SELECT {NODE_ELEV} FROM nodes_elevation"))
def _(spark, sf):
    return rounded(v.nodes_elevation(spark, sf))


@query("add_elevation", with_views(["ready_nodes"], f"SELECT {NODE_OUT}, {rnd('elevation', 'elevation')} FROM ready_nodes"))
def _(spark, sf):
    return rounded(ready_nodes(spark, sf))


@query("add_elevation_threshold", with_views(["ready_nodes"], f"""
SELECT {NODE_OUT}, {rnd('elevation', 'elevation')} FROM ready_nodes WHERE elevation >= 0.25::double"""))
def _(spark, sf):
    return rounded(nd.add_elevation(v.nodes(spark, sf), v.nodes_elevation(spark, sf), 0.25))


@query("points_outside_dem", with_views(["located_nodes", "dem"], f"""
SELECT {NODE_OUT} FROM located_nodes WHERE cell IS NULL
  OR cell NOT IN (SELECT cell FROM dem WHERE elevation IS NOT NULL)"""))
def _(spark, sf):
    return rounded(nd.points_outside_dem(v.nodes(spark, sf), v.dem(spark, sf), v.grid(spark, sf)))


@query("valid_cells", with_views(["dem"], "SELECT cell FROM dem WHERE elevation IS NOT NULL"))
def _(spark, sf):
    return nd.valid_cells(v.dem(spark, sf))


@query("mask_triangles", with_views(["elements", "cheap_masked"], """
SELECT pg_id, node_id_1 FROM elements WHERE pg_id IN (SELECT pg_id FROM cheap_masked)"""))
def _(spark, sf):
    return el.mask_triangles(v.elements(spark, sf).select("pg_id", "node_id_1"), cheap_masked(spark, sf))


view("cheap_elements", ["elements", "cheap_masked"], """
SELECT * FROM elements WHERE pg_id IN (SELECT pg_id FROM cheap_masked)""")


@query("mask_elements", with_views(["cheap_elements"], "SELECT * FROM cheap_elements"))
def _(spark, sf):
    return el.mask_elements(v.elements(spark, sf), cheap_masked(spark, sf))


@query("mask_nodes", with_views(["nodes", "cheap_elements"], f"""
SELECT {NODE_OUT} FROM nodes WHERE node_id IN (SELECT node_id_1 FROM cheap_elements
  UNION SELECT node_id_2 FROM cheap_elements UNION SELECT node_id_3 FROM cheap_elements)"""))
def _(spark, sf):
    inside = el.mask_elements(v.elements(spark, sf), cheap_masked(spark, sf))
    return rounded(nd.mask_nodes(v.nodes(spark, sf), inside))


@query("filter_valid_elements", with_views(["valid_elements"], "SELECT * FROM valid_elements"))
def _(spark, sf):
    return el.filter_valid_elements(v.elements(spark, sf), ready_nodes(spark, sf))


@query("filter_nodes", with_views(["nodes", "nodes_elevation"], f"""
SELECT {NODE_OUT} FROM nodes WHERE node_id IN (SELECT node_id FROM nodes_elevation WHERE elevation IS NOT NULL)"""))
def _(spark, sf):
    valid = v.nodes_elevation(spark, sf).where("elevation IS NOT NULL")
    return rounded(nd.filter_nodes(v.nodes(spark, sf), valid))


@query("resample_nearest", with_views(["nodes", "dem", "grid"], f"""
, box AS (SELECT radians(-82.005::double) * 6378137 AS x0, ln(tan(pi()/4 + radians(30.0025::double)/2)) * 6378137 AS y0),
t AS (SELECT r * 100 + c + 1 AS cell, x0 + (c + 0.5::double) * 350 AS x, y0 - (r + 0.5::double) * 700 AS y
  FROM (SELECT unnest(range(0, height)) AS r FROM grid), (SELECT unnest(range(0, 100)) AS c), box),
p AS (SELECT cell, CAST(floor((degrees(x / 6378137) + 82.005::double) / 0.002::double) AS BIGINT) AS sc,
  CAST(floor((degrees(2 * atan(exp(y / 6378137)) - pi()/2) - 30.0025::double) / -0.005::double) AS BIGINT) AS sr FROM t)
SELECT p.cell, {rnd('d.elevation', 'elevation')} FROM p, grid LEFT JOIN dem d
  ON d.cell = CASE WHEN sr >= 0 AND sr < height AND sc >= 0 AND sc < 150 THEN sr * 150 + sc + 1 END"""))
def _(spark, sf):
    import math

    src = v.grid(spark, sf)
    x0 = math.radians(src.c) * geometry.MERCATOR_RADIUS
    y0 = math.log(math.tan(math.pi / 4 + math.radians(src.f) / 2)) * geometry.MERCATOR_RADIUS
    dst = grid.GridMeta(100, src.height, (350.0, 0.0, x0, 0.0, -700.0, y0), "EPSG:3857")
    return rounded(nd.resample_nearest(v.dem(spark, sf), src, dst))


# --- weights and triangles --------------------------------------------------------------


@query("triangle_vertices", with_views(["equal_weights", "ready_nodes"], """
SELECT t.pg_id, t.node_id_1, t.node_id_2, t.node_id_3, """ + ", ".join(
    [rnd(f"t.node{k}_weight", f"node{k}_weight") for k in (1, 2, 3)]
    + [rnd(f"n{k}.{c}", f"node{k}_{c}") for k in (1, 2, 3) for c in ("long", "lat", "wse")]
) + """ FROM equal_weights t JOIN ready_nodes n1 ON t.node_id_1 = n1.node_id
JOIN ready_nodes n2 ON t.node_id_2 = n2.node_id JOIN ready_nodes n3 ON t.node_id_3 = n3.node_id"""))
def _(spark, sf):
    return rounded(wt.triangle_vertices(wt.equal_weights(v.elements(spark, sf)), ready_nodes(spark, sf)))


@query("barycentric_weights", with_views(["weights"], f"SELECT {WEIGHT_OUT} FROM weights"))
def _(spark, sf):
    return rounded(slope_weights(spark, sf))


@query("barycentric_weights_missing", with_views(["elements", "weights"], """
SELECT e.*, """ + ", ".join(rnd(f"w.node{k}_weight", f"node{k}_weight") for k in (1, 2, 3)) + """
FROM elements e LEFT JOIN weights w ON e.pg_id = w.pg_id"""))
def _(spark, sf):
    return rounded(wt.barycentric_weights(v.elements(spark, sf), ready_nodes(spark, sf)))


@query("triangle_barycentric", with_views(["slope_barycentric"], f"SELECT {BARY_OUT} FROM slope_barycentric"))
def _(spark, sf):
    return rounded(wt.triangle_barycentric(slope_weights(spark, sf), ready_nodes(spark, sf)))


@query("triangle_barycentric_missing", with_views(["equal_barycentric"], f"SELECT {BARY_OUT} FROM equal_barycentric"))
def _(spark, sf):
    return rounded(equal_triangles(spark, sf))


# --- overlay ----------------------------------------------------------------------------


@query("coverage_fraction", with_views(["overlay"], f"""
SELECT pg_id, cell, {rnd('coverage_fraction', 'coverage_fraction')} FROM overlay"""))
def _(spark, sf):
    return rounded(v.overlay(spark, sf))


@query("attach_cell_attributes", with_views(["overlay", "dem", "diamond_cells"], f"""
SELECT o.pg_id, o.cell, {rnd('o.coverage_fraction', 'coverage_fraction')}, {rnd('d.elevation', 'elevation')},
  o.cell IN (SELECT cell FROM diamond_cells) AS mask
FROM overlay o LEFT JOIN dem d ON o.cell = d.cell"""))
def _(spark, sf):
    from tidegrid.operators.masks import interior_mask

    cells = interior_mask(v.dem(spark, sf), [v.interior_layers(spark, sf)], v.grid(spark, sf))
    return rounded(attach_cell_attributes(v.overlay(spark, sf), cells))


view("tess_box", ["elements", "nodes"], """
SELECT min(long) AS x0, max(long) AS x1, min(lat) AS y0, max(lat) AS y1 FROM nodes WHERE node_id IN (
  SELECT node_id_1 FROM elements UNION SELECT node_id_2 FROM elements UNION SELECT node_id_3 FROM elements)""")
view("tess_units", ["tri_units", "tess_box"], """
SELECT pg_id, """ + ", ".join(
    f"(-82.005::double + 0.002::double * u{k} - x0) / ((x1 - x0) / 10) AS u{k}, "
    f"(30.0025::double - 0.005::double * v{k} - y1) / (-(y1 - y0) / 10) AS v{k}" for k in (1, 2, 3)
) + " FROM tri_units, tess_box")

from fixtures.oracle_views import overlay_views  # noqa: E402

overlay_views("tess", "tess_units", "10", "10", [], "1e-9")


@query("tessellate", with_views(["tess"], "SELECT pg_id, cell AS tile_id FROM tess"))
def _(spark, sf):
    return tessellate(v.rings(spark, sf), 10)


# --- coverage filter, zonal mean, depth ---------------------------------------------------

COV_OUT = f"pg_id, cell, {rnd('coverage_fraction', 'coverage_fraction')}, {rnd('elevation', 'elevation')}, mask"


@query("filter_masked", with_views(["cheap_masked"], f"SELECT {COV_OUT} FROM cheap_masked"))
def _(spark, sf):
    return rounded(cheap_masked(spark, sf))


@query("filter_masked_threshold", with_views(["cheap_masked"], f"""
SELECT {COV_OUT} FROM cheap_masked WHERE elevation >= 1.5::double"""))
def _(spark, sf):
    return rounded(zo.filter_masked(v.cheap_coverage(spark, sf), 1.5))


def _mean_sql(base: str) -> str:
    return with_views(["cheap_masked", "triangle_values"], "SELECT c.cell, " + rnd(
        f"sum(t.wse_weighted_average * c.coverage_fraction) / nullif(sum({base}), 0)", "wse_cell_weighted_average"
    ) + " FROM cheap_masked c LEFT JOIN triangle_values t ON c.pg_id = t.pg_id GROUP BY c.cell")


@query("cell_wse", _mean_sql("c.coverage_fraction"))
def _(spark, sf):
    return rounded(zo.cell_wse(cheap_masked(spark, sf), v.triangle_values(spark, sf)))


@query("cell_wse_renormalized", _mean_sql(
    "CASE WHEN t.wse_weighted_average IS NOT NULL THEN c.coverage_fraction END"))
def _(spark, sf):
    return rounded(zo.cell_wse(cheap_masked(spark, sf), v.triangle_values(spark, sf), renormalize=True))


@query("cell_wse_salted", _mean_sql("c.coverage_fraction"))
def _(spark, sf):
    cov = cheap_masked(spark, sf)
    hot = skew.hot_keys(cov, "pg_id", 15)
    return rounded(zo.cell_wse(cov, v.triangle_values(spark, sf), hot=hot))


@query("hot_keys", with_views(["cheap_masked"], """
SELECT pg_id, CAST(ceil(count(*) / 15.0::double) AS INTEGER) AS salts FROM cheap_masked
GROUP BY pg_id HAVING count(*) > 15"""))
def _(spark, sf):
    return skew.hot_keys(cheap_masked(spark, sf), "pg_id", 15)


@query("cell_elevation", with_views(["cheap_coverage"], f"""
SELECT cell, {rnd('max(elevation)', 'elevation')} FROM cheap_coverage GROUP BY cell HAVING max(elevation) IS NOT NULL"""))
def _(spark, sf):
    return rounded(zo.cell_elevation(v.cheap_coverage(spark, sf)))


view("cheap_depth", ["cheap_masked", "triangle_values"], """
SELECT c.cell, sum(t.wse_weighted_average * c.coverage_fraction) / sum(c.coverage_fraction) AS wse_cell_weighted_average,
  max(c.elevation) AS elevation,
  sum(t.wse_weighted_average * c.coverage_fraction) / sum(c.coverage_fraction) - max(c.elevation) AS depth
FROM cheap_masked c LEFT JOIN triangle_values t ON c.pg_id = t.pg_id GROUP BY c.cell""")


@query("with_depth", with_views(["cheap_depth"], f"SELECT {DEPTH_OUT} FROM cheap_depth"))
def _(spark, sf):
    cov = cheap_masked(spark, sf)
    wse = zo.cell_wse(cov, v.triangle_values(spark, sf))
    return rounded(zo.with_depth(wse.join(zo.cell_elevation(cov), "cell")))


@query("depth_cheap", with_views(["cheap_depth"], f"SELECT {DEPTH_OUT} FROM cheap_depth WHERE depth >= 0"))
def _(spark, sf):
    return rounded(zo.depth(cheap_masked(spark, sf), v.triangle_values(spark, sf)))


@query("depth", with_views(["equal_depth"], f"SELECT {DEPTH_OUT} FROM equal_depth WHERE depth >= 0"))
def depth(spark, sf):
    return rounded(zo.depth(v.coverage(spark, sf), equal_triangles(spark, sf)))


@query("depth_threshold", with_views(["equal_depth"], f"""
SELECT {DEPTH_OUT} FROM equal_depth WHERE depth >= 0.1524::double"""))
def _(spark, sf):
    return rounded(zo.depth(v.coverage(spark, sf), equal_triangles(spark, sf), 0.1524))


@query("depth_slope_weights", with_views(["slope_depth"], f"SELECT {DEPTH_OUT} FROM slope_depth WHERE depth >= 0"))
def depth_slope_weights(spark, sf):
    triangles = wt.triangle_barycentric(slope_weights(spark, sf), ready_nodes(spark, sf))
    return rounded(zo.depth(zo.filter_masked(v.coverage(spark, sf)), triangles))


@query("depth_legacy", with_views(["equal_depth"], f"SELECT {DEPTH_OUT} FROM equal_depth WHERE depth >= 0"))
def _(spark, sf):
    return rounded(zo.depth_legacy(v.coverage(spark, sf), equal_triangles(spark, sf)))


@query("filter_depth", with_views(["cheap_depth"], f"SELECT {DEPTH_OUT} FROM cheap_depth WHERE depth >= 0.5::double"))
def _(spark, sf):
    all_cells = zo.depth(cheap_masked(spark, sf), v.triangle_values(spark, sf), float("-inf"))
    return rounded(zo.filter_depth(all_cells, 0.5))


@query("mask_depth", with_views(["cheap_depth"], f"""
SELECT cell, {rnd('CASE WHEN depth < 0.5::double THEN -9999 ELSE depth END', 'depth')} FROM cheap_depth WHERE depth >= 0"""))
def _(spark, sf):
    cells = zo.depth(cheap_masked(spark, sf), v.triangle_values(spark, sf))
    return rounded(zo.mask_depth(cells, 0.5, -9999.0).select("cell", "depth"))


@query("select_outputs", with_views(["cheap_depth"], f"""
SELECT cell, {rnd('wse_cell_weighted_average', 'wse_cell_weighted_average')} FROM cheap_depth WHERE depth >= 0"""))
def _(spark, sf):
    cells = zo.depth(cheap_masked(spark, sf), v.triangle_values(spark, sf))
    return rounded(zo.select_outputs(cells, generate_wse=True, generate_depth=False))


@query("first_per_key", """
SELECT l_orderkey, arg_min(l_partkey, o) AS l_partkey, arg_min(l_linenumber, o) AS l_linenumber, min(o) AS o,
  arg_min(l_shipmode, o) AS l_shipmode
FROM (SELECT l_orderkey, l_partkey, l_linenumber, CASE WHEN l_returnflag = 'N' THEN NULL ELSE l_linestatus END AS l_shipmode,
  l_linenumber * 1000000000::bigint + l_partkey * 1000 + l_suppkey % 1000 AS o FROM lineitem) GROUP BY l_orderkey""")
def _(spark, sf):
    # Line numbers repeat within an order; part and supplier make the order complete.
    items = v.table(spark, sf, "lineitem").select(
        "l_orderkey", "l_partkey", "l_linenumber",
        F.when(F.col("l_returnflag") != "N", F.col("l_linestatus")).alias("l_shipmode"),
        F.expr("l_linenumber * 1000000000L + l_partkey * 1000 + l_suppkey % 1000").alias("o"),
    )
    return zo.first_per_key(items, "l_orderkey", "o")


view("run_depth", ["runs", "weights", "masked_coverage"], """
SELECT w.run_id, w.cell, w.wse AS wse_cell_weighted_average, e.elevation, w.wse - e.elevation AS depth FROM (
  SELECT ids.run_id, c.cell, sum(t.wse * c.coverage_fraction) / sum(c.coverage_fraction) AS wse
  FROM (SELECT DISTINCT run_id FROM runs) ids CROSS JOIN masked_coverage c LEFT JOIN (
    SELECT r1.run_id, w.pg_id, w.node1_weight * r1.wse + w.node2_weight * r2.wse + w.node3_weight * r3.wse AS wse
    FROM weights w JOIN runs r1 ON w.node_id_1 = r1.node_id
    JOIN runs r2 ON w.node_id_2 = r2.node_id AND r2.run_id = r1.run_id
    JOIN runs r3 ON w.node_id_3 = r3.node_id AND r3.run_id = r1.run_id) t
  ON t.pg_id = c.pg_id AND t.run_id = ids.run_id GROUP BY ids.run_id, c.cell) w
JOIN (SELECT cell, max(elevation) AS elevation FROM masked_coverage GROUP BY cell) e ON w.cell = e.cell
WHERE w.wse - e.elevation >= 0""")


@query("depth_runs", with_views(["run_depth"], f"SELECT run_id, {DEPTH_OUT} FROM run_depth"))
def _(spark, sf):
    triangles = zo.triangle_wse_runs(slope_weights(spark, sf), v.runs(spark, sf))
    return rounded(zo.depth_runs(zo.filter_masked(v.coverage(spark, sf)), triangles))


# --- counts and checks ------------------------------------------------------------------


@query("null_report", with_views(["cheap_coverage"], " UNION ALL ".join(
    f"SELECT '{c}' AS column_name, count(*) - count({c}) AS null_count FROM cheap_coverage"
    for c in ("pg_id", "cell", "coverage_fraction", "elevation", "mask"))))
def _(spark, sf):
    return ql.null_report(v.cheap_coverage(spark, sf))


@query("mesh_profile", with_views(["nodes", "elements"], """
SELECT max(node_id) AS max_node_id, count(*) AS node_count, (SELECT count(*) FROM elements) AS element_count,
  (SELECT count(*) FROM lineitem) AS extra_count FROM nodes"""))
def _(spark, sf):
    return ql.mesh_profile(v.nodes(spark, sf), v.elements(spark, sf), v.table(spark, sf, "lineitem"))


@query("extent", with_views(["diamonds"], "SELECT " + ", ".join([
    rnd("min(cx) - 0.01035::double", "min_x"), rnd("min(cy) - 0.01035::double", "min_y"),
    rnd("max(cx) + 0.01035::double", "max_x"), rnd("max(cy) + 0.01035::double", "max_y")]) + " FROM diamonds"))
def _(spark, sf):
    return rounded(ql.extent(v.interior_layers(spark, sf)))


@query("expect", with_views(["nodes"], f"SELECT {NODE_OUT} FROM nodes"))
def _(spark, sf):
    nodes = v.nodes(spark, sf)
    rows = v.table(spark, sf, "customer").count()
    store = TableStore(spark, scratch_dir(spark, "expect"))
    return rounded(store.write(nodes, "nodes", ["node_id", "wse"], rows))


# --- mesh elements ----------------------------------------------------------------------

view("raw_elements", ["elements"], """
SELECT pg_id - 1 AS index, pg_id AS element_id, node_id_1, node_id_2,
  CASE WHEN pg_id % 13 = 5 THEN node_id_3 + 100000000 WHEN pg_id % 17 = 4 THEN 0 ELSE node_id_3 END AS node_id_3,
  CASE WHEN pg_id % 11 = 2 THEN 2 ELSE 3 END AS n FROM elements""")


def raw_elements(spark, sf):
    """Elements as a strict mesh reader gives them, some with bad ids or two vertices."""
    third = F.when(F.col("pg_id") % 13 == 5, F.col("node_id_3") + 100000000).when(
        F.col("pg_id") % 17 == 4, F.lit(0).cast("long")
    ).otherwise(F.col("node_id_3"))
    n = F.when(F.col("pg_id") % 11 == 2, F.lit(2)).otherwise(F.lit(3)).cast("long")
    return v.elements(spark, sf).select(
        (F.col("pg_id") - 1).alias("index"), F.col("pg_id").alias("element_id"),
        F.array(n, "node_id_1", "node_id_2", third).alias("raw"),
    )


GOOD = "n = 3 AND node_id_3 BETWEEN 1 AND (SELECT max(node_id) FROM nodes)"


@query("validate_elements_good", with_views(["raw_elements", "nodes"], f"""
SELECT element_id AS pg_id, CAST(n AS INTEGER) AS num_nodes, node_id_1, node_id_2, node_id_3 FROM raw_elements WHERE {GOOD}"""))
def _(spark, sf):
    good, _ = el.validate_elements(raw_elements(spark, sf), v.nodes(spark, sf))
    return good.select("pg_id", "num_nodes", *[F.get("node_ids", F.lit(i)).alias(f"node_id_{i + 1}") for i in range(3)])


BAD_SQL = f"""
SELECT index, element_id, CASE WHEN n < 3 THEN 'needs 3 vertices or more, has 2'
  ELSE 'vertex id outside 1..' || CAST((SELECT max(node_id) FROM nodes) AS VARCHAR) || ': ' || CAST(node_id_3 AS VARCHAR)
  END AS error FROM raw_elements WHERE NOT ({GOOD})"""


@query("validate_elements_bad", with_views(["raw_elements", "nodes"], BAD_SQL))
def _(spark, sf):
    _, bad = el.validate_elements(raw_elements(spark, sf), v.nodes(spark, sf))
    return bad.select("index", "element_id", "error")


@query("top_failures", with_views(["raw_elements", "nodes"], f"SELECT * FROM ({BAD_SQL}) ORDER BY index LIMIT 15"))
def _(spark, sf):
    _, bad = el.validate_elements(raw_elements(spark, sf), v.nodes(spark, sf))
    return el.top_failures(bad).select("index", "element_id", "error")


@query("element_polygons", with_views(["elements", "nodes"], f"""
SELECT pg_id, pos, {rnd('long', 'x')}, {rnd('lat', 'y')} FROM (
  SELECT pg_id, 0 AS pos, node_id_1 AS node_id FROM elements
  UNION ALL SELECT pg_id, 1, node_id_2 FROM elements UNION ALL SELECT pg_id, 2, node_id_3 FROM elements) e
JOIN nodes USING (node_id)"""))
def _(spark, sf):
    lists = v.elements(spark, sf).select(
        "pg_id", "num_nodes", F.array("node_id_1", "node_id_2", "node_id_3").alias("node_ids"))
    return vertices(el.element_polygons(lists, v.nodes(spark, sf)), ["pg_id"])


view("ngons", [], """
SELECT c_custkey AS pg_id, 3 + c_custkey % 4 AS num_nodes, m FROM customer, (SELECT max(c_custkey) AS m FROM customer)""")


view("ngon_ids", ["ngons"], """
SELECT pg_id, num_nodes, list_transform(range(num_nodes), lambda k: (pg_id + 7 * k) % m + 1) AS node_ids FROM ngons""")


@query("element_polygons_ngon", with_views(["ngon_ids", "nodes"], f"""
SELECT pg_id, num_nodes, array_to_string(node_ids, ' ') AS node_ids, {rnd('avg(wse)', 'mean_wse', 3)}
FROM (SELECT pg_id, num_nodes, node_ids, unnest(node_ids) AS node_id FROM ngon_ids) JOIN nodes USING (node_id)
GROUP BY pg_id, num_nodes, array_to_string(node_ids, ' ')"""))
def _(spark, sf):
    customers = v.table(spark, sf, "customer")
    top = customers.agg(F.max("c_custkey")).first()[0]
    ngons = customers.selectExpr("c_custkey AS pg_id", "3 + c_custkey % 4 AS num_nodes").withColumn(
        "node_ids", F.transform(F.sequence(F.lit(0).cast("long"), F.col("num_nodes") - 1),
                                lambda k: (F.col("pg_id") + 7 * k) % top + 1))
    polygons = el.element_polygons(ngons, v.nodes(spark, sf))
    return rounded(polygons.select("pg_id", "num_nodes", F.array_join(F.col("node_ids").cast("array<string>"), " ").alias("node_ids"), "mean_wse"), 3)


@query("element_mean_wse", with_views(["elements", "nodes"], f"""
SELECT e.pg_id, e.num_nodes, e.node_id_1, e.node_id_2, e.node_id_3, NULL::bigint AS node_id_4,
  {rnd('(a.wse + b.wse + c.wse) / 3', 'mean_wse')}
FROM elements e JOIN nodes a ON a.node_id = e.node_id_1 JOIN nodes b ON b.node_id = e.node_id_2
JOIN nodes c ON c.node_id = e.node_id_3"""))
def _(spark, sf):
    lists = v.elements(spark, sf).select(
        "pg_id", "num_nodes", F.array("node_id_1", "node_id_2", "node_id_3").alias("node_ids"))
    polygons = el.element_polygons(lists, v.nodes(spark, sf))
    return rounded(polygons.drop("ring", "node_ids"))
