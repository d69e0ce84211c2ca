"""Mask layers as runs of grid columns.

A mask is never built as geometry. Per grid row it is a set of column runs, and the
set algebra (union, difference, "near but not inside") is one sweep along the row over
run starts and ends. Starts and ends are summed per (row, col) on the map side first, so
a row never holds more than grid-width + 1 entries however many features overlap there.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tidegrid.functions.geometry import explode_edges
from tidegrid.functions.grid import GridMeta, cell_col, cell_id, cell_row, int_div
from tidegrid.operators.near_edges import candidate_rows, near_edge_spans, near_edge_work  # noqa: F401
from tidegrid.operators.overlay import ring_extent
from tidegrid.operators.skew import spread

FEATURE = ["layer", "feature_id"]


def clean_layer(layer: DataFrame) -> DataFrame:
    """One geometry column named ``geometry`` and no features without geometry."""
    if "geom" in layer.columns and "geometry" in layer.columns:
        layer = layer.withColumn("geometry", F.coalesce("geometry", "geom")).drop("geom")
    elif "geom" in layer.columns:
        layer = layer.withColumnRenamed("geom", "geometry")
    return layer.dropna(subset=["geometry"])


def stack_layers(layers: list[DataFrame]) -> DataFrame:
    """Layers below each other; a column missing from one layer is NULL there."""
    return reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), layers)


def _clip_runs(runs: DataFrame, keys: list[str], meta: GridMeta) -> DataFrame:
    clipped = runs.select(
        *keys, "row",
        F.greatest("col_lo", F.lit(0)).alias("col_lo"),
        F.least("col_hi", F.lit(meta.width - 1)).alias("col_hi"),
    )
    return clipped.where("col_lo <= col_hi")


def rasterize_mask(layers: DataFrame, meta: GridMeta, keys: list[str] = FEATURE) -> DataFrame:
    """Runs of cells whose centre lies in a feature: layer, feature_id, row, col_lo, col_hi.

    ``layers`` has one row per ring (layer, feature_id, ring). Rings of one feature (of equal
    ``keys``) are filled even-odd, so holes and multi-part features work. An edge counts on a row when
    ``min(y) <= centre < max(y)``, which leaves every row an even number of crossings.
    """
    hits = candidate_rows(explode_edges(layers, keys), meta).where(
        "least(y1, y2) <= yc AND yc < greatest(y1, y2)"
    )
    hits = hits.select(
        *keys, "row",
        (F.col("x1") + (F.col("yc") - F.col("y1")) * (F.col("x2") - F.col("x1"))
         / (F.col("y2") - F.col("y1"))).alias("x"),
    )
    hits = hits.withColumn("w", (F.col("x") - F.lit(meta.c)) / F.lit(meta.a))
    along = Window.partitionBy(*keys, "row").orderBy("w")
    pairs = hits.select(
        *keys, "row", "w",
        F.lead("w").over(along).alias("w_next"), F.row_number().over(along).alias("n"),
    ).where("n % 2 = 1")
    runs = pairs.select(
        *keys, "row",
        F.ceil(F.col("w") - F.lit(0.5)).alias("col_lo"),
        (F.ceil(F.col("w_next") - F.lit(0.5)) - 1).alias("col_hi"),
    )
    return _clip_runs(runs, keys, meta)


def near_edge_runs(layers: DataFrame, meta: GridMeta, radius: float) -> DataFrame:
    """Runs of cells whose centre is within ``radius`` of an edge, disjoint per row."""
    return merge_runs(near_edge_spans(layers.select("ring", F.lit(0).alias("part")), meta, radius))


def _sweep(events: DataFrame, names: list[str], keep: Column) -> DataFrame:
    """Runs where ``keep`` holds; inside it each name is a column saying "in a run of that set".

    ``events`` has row, col and, per name, what a run's start (1) or end (-1) adds to its set.
    """
    steps = events.groupBy("row", "col").agg(*[F.sum(n).alias(n) for n in names])
    along = Window.partitionBy("row").orderBy("col")
    state = steps.select("row", "col", *[(F.sum(n).over(along) > 0).alias(n) for n in names])
    state = state.select("row", "col", keep.alias("on"))
    state = state.withColumn("was_on", F.lag("on", 1, False).over(along))
    turns = state.where("on <> was_on")
    runs = turns.select(
        "row", F.col("col").alias("col_lo"), (F.lead("col").over(along) - 1).alias("col_hi"), "on"
    )
    return runs.where("on").select("row", "col_lo", "col_hi")


def _events(runs: DataFrame, member: dict[str, Column], names: list[str]) -> DataFrame:
    """Starts and ends of runs; ``member`` says which sets a run belongs to."""
    ends = runs.select("*", F.inline(F.array(
        F.struct(F.col("col_lo").alias("col"), F.lit(1).alias("delta")),
        F.struct((F.col("col_hi") + 1).alias("col"), F.lit(-1).alias("delta")),
    )))
    own = [(F.when(member[n], F.col("delta")).otherwise(0) if n in member else F.lit(0)).alias(n) for n in names]
    return ends.select("row", "col", *own)


def merge_runs(runs: DataFrame) -> DataFrame:
    """Union of overlapping runs as disjoint runs: row, col_lo, col_hi."""
    return _sweep(_events(runs, {"any": F.lit(True)}, ["any"]), ["any"], F.col("any"))


def exterior_mask_runs(layer: DataFrame, meta: GridMeta, ring_deg: float = 10.0) -> DataFrame:
    """Runs outside every polygon of a layer yet within ``ring_deg`` of an edge."""
    return general_mask_runs([layer], [], meta, ring_deg)


def general_mask_runs(
    exterior_layers: list[DataFrame],
    interior_layers: list[DataFrame],
    meta: GridMeta,
    ring_deg: float = 10.0,
) -> DataFrame:
    """Runs of the general mask: every exterior ring, or inside any interior feature.

    All layers go through one plan: the exterior ones are numbered from 0 on, the interior
    ones share the number behind them.
    """
    if not exterior_layers and not interior_layers:
        raise ValueError("a mask needs at least one layer")
    outer = len(exterior_layers)
    numbered = [x.select(*FEATURE, "ring", F.lit(min(i, outer)).alias("part")) for i, x in enumerate(exterior_layers + interior_layers)]
    inside = {f"inside_{i}": F.col("part") == i for i in range(outer + bool(interior_layers))}
    near = {f"near_{i}": F.col("part") == i for i in range(outer)}
    names = [*inside, *near]
    events = _events(rasterize_mask(stack_layers(numbered), meta, ["part", *FEATURE]), inside, names)
    if outer:
        spans = near_edge_spans(stack_layers(numbered[:outer]), meta, ring_deg)
        events = events.unionByName(_events(spans, near, names))
    keep = [F.col(f"near_{i}") & ~F.col(f"inside_{i}") for i in range(outer)]
    if interior_layers:
        keep.append(F.col(f"inside_{outer}"))
    return _sweep(events, names, reduce(Column.__or__, keep))


def run_cells(runs: DataFrame, meta: GridMeta) -> DataFrame:
    """The cells of disjoint runs, one row per cell."""
    cells = spread(runs, "row").select("row", F.explode(F.sequence("col_lo", "col_hi")).alias("col"))
    return cells.select(cell_id("row", "col", meta.width).alias("cell"))


#: Columns of a block: the share of a grid row that is swept as one group.
BLOCK = 4096


def flag_cells(cells: DataFrame, runs: DataFrame, meta: GridMeta, flag: str = "mask") -> DataFrame:
    """Cells with a column ``flag``: whether a cell lies in a run. The runs of a row are disjoint.

    A sweep join: run starts and cells of a row stand in one stream sorted by column, and the
    end of the run that began last says whether a cell is in it. Rows are cut into blocks
    of columns and a run is repeated once per block, so neither a wide row nor a run over a
    whole row is ever one group, and no run is spelled out as cells.
    """
    kept = [c for c in cells.columns if c != flag]
    row, col = cell_row("cell", meta.width), cell_col("cell", meta.width)
    placed = cells.select(row.alias("row"), col.alias("col"), F.lit(1).alias("kind"), F.lit(None).cast("long").alias("last"),
                          F.struct(*kept).alias("of")).withColumn("block", int_div(F.col("col"), BLOCK))
    spans = runs.select("row", "col_lo", "col_hi", F.explode(F.sequence(
        int_div(F.col("col_lo"), BLOCK), int_div(F.col("col_hi"), BLOCK))).alias("block"))
    nobody = F.lit(None).cast(placed.schema["of"].dataType)
    starts = spans.select("row", F.greatest(F.col("col_lo"), F.col("block") * BLOCK).cast("long").alias("col"), F.lit(0).alias("kind"),
                          F.col("col_hi").cast("long").alias("last"), nobody.alias("of"), "block")
    along = Window.partitionBy("row", "block").orderBy("col", "kind").rowsBetween(Window.unboundedPreceding, 0)
    swept = placed.unionByName(starts).select("kind", "col", "of", F.last("last", ignorenulls=True).over(along).alias("last"))
    inside = F.coalesce(F.col("col") <= F.col("last"), F.lit(False))
    return swept.where("kind = 1").select(*[F.col("of")[c].alias(c) for c in kept], inside.alias(flag))


def combine_masks(run_sets: list[DataFrame]) -> DataFrame:
    """All mask parts as one disjoint set of runs."""
    parts = [r.select("row", "col_lo", "col_hi") for r in run_sets]
    return merge_runs(reduce(DataFrame.unionByName, parts))


def exterior_mask(cells: DataFrame, layer: DataFrame, meta: GridMeta, ring_deg: float = 10.0) -> DataFrame:
    """Cells with ``mask`` true outside the layer's polygons (within the ring)."""
    return flag_cells(cells, exterior_mask_runs(layer, meta, ring_deg), meta)


def interior_mask(cells: DataFrame, layers: list[DataFrame], meta: GridMeta) -> DataFrame:
    """Cells with ``mask`` true inside any feature; no layers means nothing is masked."""
    if not layers:
        return cells.withColumn("mask", F.lit(False))
    stacked = stack_layers([x.select(*FEATURE, "ring") for x in layers])
    return flag_cells(cells, merge_runs(rasterize_mask(stacked, meta)), meta)


def general_mask(
    cells: DataFrame,
    exterior_layers: list[DataFrame],
    interior_layers: list[DataFrame],
    meta: GridMeta,
    ring_deg: float = 10.0,
) -> DataFrame:
    """Cells with the general mask: outside an exterior layer or inside an interior one."""
    return flag_cells(cells, general_mask_runs(exterior_layers, interior_layers, meta, ring_deg), meta)


def mask_raster(dem: DataFrame, layers: DataFrame, meta: GridMeta) -> tuple[DataFrame, GridMeta]:
    """Raster cells inside the polygons, on a grid cropped to the polygons' extent.

    Cell ids and the transform are re-based to the crop window. Reads one summary row (the
    layer extent) to size the window.
    """
    box = ring_extent(layers).first()
    if box is None or box["min_x"] is None:
        raise ValueError("cannot crop a raster to a layer without geometry")
    us = sorted((box[k] - meta.c) / meta.a for k in ("min_x", "max_x"))
    vs = sorted((box[k] - meta.f) / meta.e for k in ("min_y", "max_y"))
    col_lo, col_hi = max(int(us[0] // 1), 0), min(int(-(-us[1] // 1)), meta.width)
    row_lo, row_hi = max(int(vs[0] // 1), 0), min(int(-(-vs[1] // 1)), meta.height)
    if col_lo >= col_hi or row_lo >= row_hi:
        raise ValueError("the polygons do not overlap the raster")
    crop = meta.window(row_lo, col_lo, row_hi - row_lo, col_hi - col_lo)
    kept = flag_cells(dem, merge_runs(rasterize_mask(layers, meta)), meta, "_inside").where("_inside").drop("_inside")
    row, col = cell_row("cell", meta.width), cell_col("cell", meta.width)
    moved = kept.withColumn("cell", cell_id(row - row_lo, col - col_lo, crop.width))
    return moved, crop
