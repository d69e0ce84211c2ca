"""Queries over mask layers and raster masks."""

from __future__ import annotations

from pyspark.sql import functions as F

from fixtures import views as v
from fixtures.oracle_views import rnd, view, with_views
from fixtures.registry import query, rounded
from tidegrid.functions.geometry import ring_wkt
from tidegrid.operators import masks as mk

ROW_COL = "(cell - 1) // 150 AS row, (cell - 1) % 150 AS col"


def run_membership(runs, keys):
    """Runs spelled out cell by cell, so that any equal run splitting compares equal."""
    return runs.select(*keys, "row", F.explode(F.sequence("col_lo", "col_hi")).alias("col"))


@query("rasterize_mask", with_views(["diamond_cells"], "SELECT layer, feature_id, r AS row, c AS col FROM diamond_cells"))
def _(spark, sf):
    runs = mk.rasterize_mask(v.interior_layers(spark, sf), v.grid(spark, sf))
    return run_membership(runs, ["layer", "feature_id"])


@query("merge_runs", with_views(["diamond_cells"], "SELECT DISTINCT r AS row, c AS col FROM diamond_cells"))
def _(spark, sf):
    runs = mk.rasterize_mask(v.interior_layers(spark, sf), v.grid(spark, sf))
    return run_membership(mk.merge_runs(runs), [])


view("combined_cells", ["diamond_cells", "domain_test"], """
SELECT cell FROM diamond_cells UNION SELECT cell FROM domain_test WHERE inside""")


@query("combine_masks", with_views(["combined_cells"], f"SELECT {ROW_COL} FROM combined_cells"))
def _(spark, sf):
    meta = v.grid(spark, sf)
    parts = [mk.rasterize_mask(layer, meta) for layer in
             (v.interior_layers(spark, sf), v.exterior_layer(spark, sf, "domain"))]
    return run_membership(mk.combine_masks(parts), [])


@query("near_edge_runs", with_views(["domain_test"], "SELECT DISTINCT r AS row, c AS col FROM domain_test WHERE distance <= 0.013"))
def _(spark, sf):
    runs = mk.near_edge_runs(v.exterior_layer(spark, sf, "domain"), v.grid(spark, sf), 0.013)
    return run_membership(mk.merge_runs(runs), [])


@query("exterior_mask", with_views(["domain_test"], "SELECT cell, NOT inside AND distance <= 10 AS mask FROM domain_test"))
def _(spark, sf):
    cells = v.dem(spark, sf).select("cell")
    return mk.exterior_mask(cells, v.exterior_layer(spark, sf, "domain"), v.grid(spark, sf))


@query("exterior_mask_state", with_views(["state_test"], "SELECT cell, NOT inside AND distance <= 10 AS mask FROM state_test"))
def _(spark, sf):
    cells = v.dem(spark, sf).select("cell")
    return mk.exterior_mask(cells, v.exterior_layer(spark, sf, "state"), v.grid(spark, sf))


@query("exterior_mask_narrow_ring", with_views(["domain_test"], """
SELECT cell, NOT inside AND distance <= 0.021 AS mask FROM domain_test"""))
def _(spark, sf):
    cells = v.dem(spark, sf).select("cell")
    return mk.exterior_mask(cells, v.exterior_layer(spark, sf, "domain"), v.grid(spark, sf), ring_deg=0.021)


@query("interior_mask", with_views(["dem", "diamond_cells"], """
SELECT cell, cell IN (SELECT cell FROM diamond_cells) AS mask FROM dem"""))
def _(spark, sf):
    layers = v.interior_layers(spark, sf)
    chosen = [layers.where(F.col("layer") == name) for name in v.LAYERS]
    return mk.interior_mask(v.dem(spark, sf).select("cell"), chosen, v.grid(spark, sf))


@query("general_mask", with_views(["general_masked"], "SELECT cell, mask FROM general_masked"))
def _(spark, sf):
    exterior = [v.exterior_layer(spark, sf, name) for name in ("domain", "state")]
    return mk.general_mask(v.dem(spark, sf).select("cell"), exterior, [v.interior_layers(spark, sf)], v.grid(spark, sf))


view("mask_extent", ["diamonds", "grid"], """
SELECT greatest(CAST(floor((min(cx) - 0.01035::double + 82.005::double) / 0.002::double) AS BIGINT), 0) AS c0,
  least(CAST(ceil((max(cx) + 0.01035::double + 82.005::double) / 0.002::double) AS BIGINT), 150) AS c1,
  greatest(CAST(floor((max(cy) + 0.01035::double - 30.0025::double) / -0.005::double) AS BIGINT), 0) AS r0
FROM diamonds""")


@query("mask_raster", with_views(["mask_extent", "diamond_cells", "dem"], f"""
SELECT (((d.cell - 1) // 150) - r0) * (c1 - c0) + ((d.cell - 1) % 150) - c0 + 1 AS cell, {rnd('elevation', 'elevation')}
FROM dem d, mask_extent WHERE d.cell IN (SELECT cell FROM diamond_cells)"""))
def _(spark, sf):
    masked, _ = mk.mask_raster(v.dem(spark, sf), v.interior_layers(spark, sf), v.grid(spark, sf))
    return rounded(masked)


@query("clean_layer", "SELECT s_suppkey AS feature_id FROM supplier WHERE s_suppkey % 9 <> 4")
def _(spark, sf):
    layer = v.interior_layers(spark, sf).select(
        "feature_id", F.when(F.col("feature_id") % 9 != 4, ring_wkt("ring")).alias("geom")
    )
    return mk.clean_layer(layer).where("geometry IS NOT NULL").select("feature_id")


@query("stack_layers", """
SELECT s_suppkey AS feature_id, s_name AS name, NULL::double AS balance FROM supplier
UNION ALL SELECT s_suppkey, NULL, s_acctbal FROM supplier""")
def _(spark, sf):
    s = v.table(spark, sf, "supplier")
    return mk.stack_layers([
        s.selectExpr("s_suppkey AS feature_id", "s_name AS name"),
        s.selectExpr("s_suppkey AS feature_id", "s_acctbal AS balance"),
    ])


@query("extract_mask", with_views(["diamonds"], f"""
SELECT {rnd('cx - 0.01035::double', 'x0', 5)}, {rnd('cx + 0.01035::double', 'x1', 5)},
  {rnd('cy - 0.01035::double', 'y0', 5)}, {rnd('cy + 0.01035::double', 'y1', 5)} FROM diamonds"""))
def _(spark, sf):
    from tidegrid.sources.tables import extract_mask

    layer = v.interior_layers(spark, sf).select(F.col("ring").alias("geometry"), "layer", "feature_id")
    least, most = (lambda c: F.array_min(f"geometry.{c}")), (lambda c: F.array_max(f"geometry.{c}"))
    return rounded(extract_mask(layer).select(
        least("x").alias("x0"), most("x").alias("x1"), least("y").alias("y0"), most("y").alias("y1")), 5)
