"""Columns of each grid row that lie within a radius of an edge, without pairing rows with all edges.

Edges stand in a quadtree whose nodes know the box around their edges. On a grid row, the
cells within the radius of a whole box are certain and those within the radius of any point
of it are possible. At the top, a box of which the certain cells of all boxes together hold
what it makes possible is done. What stays open, the rim, goes down the tree: of the children
of a node only those are followed that may reach further left or right than their siblings
surely do. So a row meets the edges in the finest boxes along its two ends and no others: some
350 of 100,000 edges scattered over one top box, and a handful where the front is slanted.

All of it is one stream of rows: certain runs ride along to the end, so no part of the plan is
computed twice, and no step is run while the plan is built. The formulas are SQL text, because a
plan of some hundred column calls takes longer to put together than to run on a small grid.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidegrid.functions.geometry import explode_edges
from tidegrid.functions.grid import GridMeta
from tidegrid.operators.skew import spread

#: Boxes per radius at the top, along each axis; levels below it, and the bits of a place that each
#: adds per axis: a box has 16 x 16 boxes in it, and the finest ones are a 4096th of the radius wide.
BOXES_PER_RADIUS = 16
LEVELS = 2
BITS = 4

#: Levels of runs that ride along; they meet no box.
_PASSING = -1
_NODE = ["part", "level", "ix", "iy"]


def _num(x: float) -> str:
    """A number as a double literal of SQL."""
    return f"{float(x)!r}D"


def candidate_rows(edges: DataFrame, meta: GridMeta, pad: float = 0.0) -> DataFrame:
    """Edges with every grid row whose centre may lie within ``pad`` of their y extent."""
    v = lambda y: f"(({y} - {_num(meta.f)}) / {_num(meta.e)} - 0.5D)"
    reach = _num(pad / abs(meta.e))
    spans = edges.selectExpr(
        "*", f"greatest(floor(least({v('y1')}, {v('y2')}) - {reach}), 0) AS row_lo",
        f"least(ceil(greatest({v('y1')}, {v('y2')}) + {reach}), {meta.height - 1}) AS row_hi").where("row_lo <= row_hi")
    rows = spans.selectExpr("*", "explode(sequence(row_lo, row_hi)) AS row").drop("row_lo", "row_hi")
    return rows.selectExpr("*", f"{_num(meta.f)} + (CAST(row AS DOUBLE) + 0.5D) * {_num(meta.e)} AS yc")


def _columns_between(x_lo: str, x_hi: str, meta: GridMeta, widen: int) -> tuple[str, str]:
    """First and last column whose centre lies between two x, each moved out by ``widen`` cells and clipped."""
    w = lambda x: f"(({x} - {_num(meta.c)}) / {_num(meta.a)} - 0.5D)"
    left, right = (x_lo, x_hi) if meta.a > 0 else (x_hi, x_lo)
    return f"greatest(ceil({w(left)}) - ({widen}), 0)", f"least(floor({w(right)}) + ({widen}), {meta.width - 1})"


def _half(r: float, d: str) -> str:
    """Half the width of a disc at height ``d`` above its middle."""
    return f"sqrt(greatest({_num(r * r)} - {d} * {d}, 0D))"


def _with_leaf(edges: DataFrame, radius: float) -> DataFrame:
    """Edges with the finest box of the tree that holds their middle."""
    side = radius / BOXES_PER_RADIUS / (1 << BITS * LEVELS)
    at = lambda c: f"floor(({c}1 + {c}2) / {_num(2 * side)})"
    return edges.selectExpr("part", "x1", "y1", "x2", "y2", f"{at('x')} AS ix", f"{at('y')} AS iy")


def _boxes(edges: DataFrame, levels: str) -> DataFrame:
    """The boxes of the tree at the given levels, each drawn tightly around its edges."""
    upper = lambda c: f"shiftright({c}, CAST({BITS} * ({LEVELS} - level) AS INT)) AS {c}"
    placed = edges.selectExpr("*", f"explode({levels}) AS level").selectExpr("part", "x1", "y1", "x2", "y2", "level", upper("ix"), upper("iy"))
    return placed.groupBy(*_NODE).agg(F.expr("min(least(x1, x2)) AS x_lo"), F.expr("max(greatest(x1, x2)) AS x_hi"),
                                      F.expr("min(least(y1, y2)) AS y1"), F.expr("max(greatest(y1, y2)) AS y2"))


def _tree(edges: DataFrame) -> DataFrame:
    """Each box above the finest level with the boxes in it, 256 at the most."""
    child = "struct(ix, iy, x_lo, x_hi, y1, y2) AS child"
    boxes = _boxes(edges, f"sequence(1, {LEVELS})").selectExpr(
        "part", "level - 1 AS level", f"shiftright(ix, {BITS}) AS ix", f"shiftright(iy, {BITS}) AS iy", child)
    return boxes.groupBy(*_NODE).agg(F.collect_list("child").alias("children"))


def _top(edges: DataFrame, meta: GridMeta, radius: float) -> DataFrame:
    """Rows of the top boxes that are open, and certain runs (``sure_lo``, ``sure_hi``) that ride along.

    Along a grid row a running count of the certain runs says where the stretch that covers
    the present column began; a box whose possible columns begin no earlier is done. Certain
    runs are a cell short at either end and possible ones a cell longer, so that rounding never
    decides.
    """
    boxes = spread(_boxes(edges, "array(0)"), "part", "ix", "iy")
    rows = candidate_rows(boxes, meta, pad=radius).selectExpr(
        "part", "ix", "iy", "row", "yc", "x_lo", "x_hi",
        "greatest(abs(yc - y1), abs(yc - y2)) AS far", "greatest(y1 - yc, yc - y2, 0D) AS close")
    rows = rows.selectExpr("part", "ix", "iy", "row", "yc", "x_lo", "x_hi", f"far <= {_num(radius)} AS whole",
                           f"{_half(radius, 'far')} AS h_far", f"{_half(radius, 'close')} AS h_close")
    sure = _columns_between("(x_hi - h_far)", "(x_lo + h_far)", meta, -1)
    maybe = _columns_between("(x_lo - h_close)", "(x_hi + h_close)", meta, 1)
    rows = rows.selectExpr("part", "ix", "iy", "row", "yc", f"if(whole, {sure[0]}, NULL) AS sure_lo", f"{sure[1]} AS sure_hi",
                           f"{maybe[0]} AS p_lo", f"{maybe[1]} AS p_hi")
    event = lambda when, col, kind, delta: f"if({when}, struct({col} AS col, {kind} AS kind, {delta} AS delta), NULL)"
    rows = rows.selectExpr("*", f"""inline(array_compact(array(
        {event('sure_lo <= sure_hi', 'sure_lo', 0, 1)}, {event('sure_lo <= sure_hi', 'sure_hi + 1', 1, -1)},
        {event('p_lo <= p_hi', 'p_hi', 2, 0)})))""")
    along = "OVER (PARTITION BY part, row ORDER BY col, kind ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW)"
    rows = rows.selectExpr("*", f"sum(delta) {along} AS n")
    rows = rows.selectExpr("*", f"last(if(delta = 1 AND n = 1, col, NULL), true) {along} AS begun")
    rows = rows.where("kind = 0 OR (kind = 2 AND (n = 0 OR begun > p_lo))")
    # A passing run has a place of its own, so that joins spread it.
    return rows.selectExpr(
        "part", f"if(kind = 0, {_PASSING}, 0) AS level", "if(kind = 0, row, ix) AS ix", "if(kind = 0, col, iy) AS iy",
        "row", "yc", "if(kind = 0, sure_lo, NULL) AS sure_lo", "if(kind = 0, sure_hi, NULL) AS sure_hi")


def _descend(rows: DataFrame, tree: DataFrame, radius: float) -> DataFrame:
    """From open boxes to those of their children that may hold the ends of the near columns.

    Where the certain cells of all children have a cell in common, together they are one
    stretch. A child is followed only if it may reach an end of that stretch; the children that
    reach it for certain are among those, so what the others make certain is never lost.
    """
    carried = ["part", "row", "yc", "sure_lo", "sure_hi", "level", "ix", "iy"]
    rows = rows.join(tree, _NODE, "left").selectExpr(*carried, """transform(children, c -> struct(
        c.ix AS ix, c.iy AS iy, c.x_lo AS x_lo, c.x_hi AS x_hi, greatest(abs(yc - c.y1), abs(yc - c.y2)) AS far,
        greatest(c.y1 - yc, yc - c.y2, 0D) AS close)) AS kids""")
    rows = rows.selectExpr(*carried, f"""transform(kids, k -> struct(
        k.ix AS ix, k.iy AS iy, k.x_lo AS x_lo, k.x_hi AS x_hi, k.close <= {_num(radius)} AS reached,
        if(k.far <= {_num(radius)}, {_half(radius, 'k.far')}, NULL) AS h_far, {_half(radius, 'k.close')} AS h_close)) AS kids""")
    rows = rows.selectExpr(*carried, """transform(kids, k -> struct(
        k.ix AS ix, k.iy AS iy, k.reached AS reached, k.x_lo - k.h_close AS p_lo, k.x_hi + k.h_close AS p_hi,
        if(k.x_hi - k.x_lo <= 2 * k.h_far, k.x_hi - k.h_far, NULL) AS c_lo,
        if(k.x_hi - k.x_lo <= 2 * k.h_far, k.x_lo + k.h_far, NULL) AS c_hi)) AS kids""")
    rows = rows.selectExpr(*carried, "kids", "array_min(kids.c_lo) AS first", "array_max(kids.c_hi) AS last",
                           "coalesce(array_max(kids.c_lo) <= array_min(kids.c_hi), false) AS joined")
    slack = _num(1e-9 * radius)
    rows = rows.selectExpr(*carried, f"""explode_outer(filter(kids, k -> k.reached AND (
        NOT joined OR k.p_lo <= first + {slack} OR k.p_hi >= last - {slack}))) AS kid""")
    rows = rows.where(f"level = {_PASSING} OR kid IS NOT NULL")
    return rows.selectExpr("part", f"if(level = {_PASSING}, level, level + 1) AS level", "coalesce(kid.ix, ix) AS ix",
                           "coalesce(kid.iy, iy) AS iy", "row", "yc", "sure_lo", "sure_hi")


def _stream(edges: DataFrame, meta: GridMeta, radius: float) -> DataFrame:
    """Certain runs (``sure_lo``, ``sure_hi``; no edge) and the (row, edge) pairs that are still open, in one stream."""
    placed = _with_leaf(edges, radius)
    rows, tree = _top(placed, meta, radius), _tree(placed)
    for _ in range(LEVELS):
        rows = _descend(rows, tree, radius)
    leaves = placed.selectExpr("*", f"{LEVELS} AS level")
    return rows.join(leaves, _NODE, "left").select("part", "row", "yc", "x1", "y1", "x2", "y2", "sure_lo", "sure_hi")


def near_edge_work(layers: DataFrame, meta: GridMeta, radius: float) -> tuple[DataFrame, DataFrame]:
    """Columns that are near whatever a box's edges are, and the (edge, row) pairs that are looked at."""
    rows = _stream(explode_edges(layers, []).withColumn("part", F.lit(0)), meta, radius)
    certain = rows.where("x1 IS NULL").selectExpr("row", "sure_lo AS col_lo", "sure_hi AS col_hi")
    return certain, rows.where("x1 IS NOT NULL").select("row", "yc", "x1", "y1", "x2", "y2")


def near_edge_spans(layers: DataFrame, meta: GridMeta, radius: float) -> DataFrame:
    """Per part and grid row, columns within ``radius`` of an edge: part, row, col_lo, col_hi (overlapping).

    ``layers`` has rings with a number ``part``; parts are kept apart. All points within a
    radius of a segment form a convex capsule, so an edge contributes one span per grid row, in
    closed form; no cell is ever paired with an edge. A span without a cell centre comes out with
    col_hi = col_lo - 1, which a sweep cancels. It is not filtered here: the optimizer would
    inline the whole formula into the filter.
    """
    r = _num(radius)
    near = _stream(explode_edges(layers, ["part"]), meta, radius).where(
        f"x1 IS NULL OR abs(yc - y1) <= {r} OR abs(yc - y2) <= {r} OR yc BETWEEN least(y1, y2) AND greatest(y1, y2)")
    kept = ["part", "row", "sure_lo", "sure_hi"]
    half = lambda q: f"if(abs({q}) <= {r}, {_half(radius, q)}, NULL)"
    unit = lambda c: f"coalesce({c} / nullif(len, 0D), 0D)"
    near = near.selectExpr(*kept, "x1", "x2", "yc - y1 AS q1", "yc - y2 AS q2", "x2 - x1 AS ex", "y2 - y1 AS ey")
    near = near.selectExpr(*kept, "x1", "x2", "q1", "ex", "ey", f"{half('q1')} AS h1", f"{half('q2')} AS h2", "hypot(ex, ey) AS len")
    near = near.selectExpr(*kept, "x1", "x2", "q1", "h1", "h2", "len", f"{unit('ex')} AS dx", f"{unit('ey')} AS dy")
    # Positions s along the segment whose normal through the row stays within the radius.
    near = near.selectExpr("*", f"(q1 - {r} * abs(dx)) / nullif(dy, 0D) AS sa", f"(q1 + {r} * abs(dx)) / nullif(dy, 0D) AS sb")
    level = f"if(abs(q1) <= {r}, len, NULL)"
    near = near.selectExpr(
        *kept, "x1", "x2", "q1", "h1", "h2", "len", "dx", "dy", f"if(dy = 0, {level} * 0, greatest(least(sa, sb), 0D)) AS s_lo",
        f"if(dy = 0, {level}, least(greatest(sa, sb), len)) AS s_hi")
    # The foot of the normal at s meets the row at x; a vertical segment spans x1 -+ radius.
    near = near.selectExpr(
        *kept, "x1", "x2", "h1", "h2", "dx", "s_lo <= s_hi AND len > 0 AS on_body",
        "x1 + (s_lo - dy * q1) / nullif(dx, 0D) AS xa", "x1 + (s_hi - dy * q1) / nullif(dx, 0D) AS xb")
    near = near.selectExpr(
        *kept, "x1", "x2", "h1", "h2", f"CASE WHEN on_body THEN if(dx = 0, x1 - {r}, least(xa, xb)) END AS b_lo",
        f"CASE WHEN on_body THEN if(dx = 0, x1 + {r}, greatest(xa, xb)) END AS b_hi")
    near = near.selectExpr(*kept, "least(b_lo, x1 - h1, x2 - h2) AS x_lo", "greatest(b_hi, x1 + h1, x2 + h2) AS x_hi")
    w = lambda x: f"(({x} - {_num(meta.c)}) / {_num(meta.a)} - 0.5D)"
    left, right = ("x_lo", "x_hi") if meta.a > 0 else ("x_hi", "x_lo")
    near = near.selectExpr(*kept, f"greatest(least(ceil({w(left)}), {meta.width}), 0) AS lo", f"least(floor({w(right)}), {meta.width - 1}) AS hi")
    return near.selectExpr("part", "row", "coalesce(sure_lo, lo) AS col_lo", "coalesce(sure_hi, greatest(hi, lo - 1)) AS col_hi")
