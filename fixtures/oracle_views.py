"""The domain tables as DuckDB SQL, assembled into WITH clauses on demand.

The overlay is written in a different way than in Spark: closed-form integration over
polygon x cell candidates instead of a running sum over edge pieces.
"""

from __future__ import annotations

A, C, E, Y0, W = "0.002::double", "(-82.005)::double", "(-0.005)::double", "30.0025::double", "150"

VIEWS: dict[str, tuple[list[str], str]] = {}


def view(name: str, deps: list[str], sql: str) -> None:
    VIEWS[name] = (deps, sql)


def with_views(names: list[str], body: str) -> str:
    """``body`` preceded by the named views and everything they need, in order."""
    ordered: list[str] = []

    def visit(name: str) -> None:
        if name in ordered:
            return
        for dep in VIEWS[name][0]:
            visit(dep)
        ordered.append(name)

    for name in names:
        visit(name)
    ctes = ",\n".join(f"{n} AS ({VIEWS[n][1]})" for n in ordered)
    return f"WITH {ctes}\n{body}"


def rnd(expr: str, name: str, digits: int = 6) -> str:
    """A double rounded for comparison; the addition turns -0.0 into 0.0."""
    return f"round({expr}, {digits}) + 0.0::double AS {name}"


view("nodes", [], """
SELECT c_custkey + 1 AS node_id,
  -82 + 0.01::double * (c_custkey % 30) + 0.003::double * ((c_custkey * 37) % 11) / 11 AS long,
  30 - 0.01::double * (c_custkey // 30) - 0.003::double * ((c_custkey * 53) % 13) / 13 AS lat,
  c_acctbal / 2000 AS wse
FROM customer""")

view("elements", ["nodes"], """
SELECT e.pg_id, 3 AS num_nodes, e.node_id_1, e.node_id_2, e.node_id_3 FROM (
  SELECT 2*a-1 AS pg_id, a AS node_id_1, a+1 AS node_id_2, a+30 AS node_id_3
  FROM (SELECT c_custkey + 1 AS a FROM customer WHERE c_custkey % 30 < 29)
  UNION ALL
  SELECT 2*a, a+1, a+31, a+30
  FROM (SELECT c_custkey + 1 AS a FROM customer WHERE c_custkey % 30 < 29)
) e WHERE greatest(e.node_id_1, e.node_id_2, e.node_id_3) IN (SELECT node_id FROM nodes)""")

view("grid", [], "SELECT count(*) // 150 AS height FROM orders")

view("dem", [], """
SELECT o_orderkey + 1 AS cell,
  CASE WHEN o_orderkey % 97 = 0 THEN NULL ELSE o_totalprice / 125000 - 1 END AS elevation
FROM orders""")

view("located_nodes", ["nodes", "grid"], f"""
SELECT n.*, CASE WHEN r >= 0 AND r < height AND c >= 0 AND c < {W} THEN r * {W} + c + 1 END AS cell FROM (
  SELECT nodes.*, height,
    CAST(floor((lat - {Y0}) / {E}) AS BIGINT) AS r, CAST(floor((long - {C}) / {A}) AS BIGINT) AS c
  FROM nodes, grid) n""")

view("nodes_elevation", ["located_nodes", "dem"], """
SELECT node_id, long, lat, elevation FROM located_nodes LEFT JOIN dem USING (cell)""")

view("tri_units", ["elements", "nodes"], f"""
SELECT e.pg_id,
  (n1.long - {C})/{A} AS u1, (n1.lat - {Y0})/{E} AS v1,
  (n2.long - {C})/{A} AS u2, (n2.lat - {Y0})/{E} AS v2,
  (n3.long - {C})/{A} AS u3, (n3.lat - {Y0})/{E} AS v3
FROM elements e JOIN nodes n1 ON n1.node_id = e.node_id_1
JOIN nodes n2 ON n2.node_id = e.node_id_2 JOIN nodes n3 ON n3.node_id = e.node_id_3""")


def overlay_views(prefix: str, units: str, width: str, height: str, extra: list[str], eps: str) -> None:
    """Views computing coverage of triangles ``units`` on a grid of the given size."""
    view(f"{prefix}_rows", [units, *extra], f"""
SELECT t.*, unnest(range(
    greatest(CAST(floor(least(v1, v2, v3)) AS BIGINT), 0),
    least(CAST(floor(greatest(v1, v2, v3)) AS BIGINT), {height} - 1) + 1)) AS r
FROM {units} t{''.join(', ' + x for x in extra)}""")
    view(f"{prefix}_cand", [f"{prefix}_rows"], f"""
SELECT pg_id, r, c, u1 - c AS u1, v1 - r AS v1, u2 - c AS u2, v2 - r AS v2, u3 - c AS u3, v3 - r AS v3
FROM (SELECT t.*, unnest(range(
    greatest(CAST(floor(least(u1, u2, u3)) AS BIGINT), 0),
    least(CAST(floor(greatest(u1, u2, u3)) AS BIGINT), {width} - 1) + 1)) AS c
  FROM {prefix}_rows t)""")
    view(f"{prefix}_edges", [f"{prefix}_cand"], f"""
SELECT pg_id, r, c, u1 AS ua, v1 AS va, u2 AS ub, v2 AS vb FROM {prefix}_cand
UNION ALL SELECT pg_id, r, c, u2, v2, u3, v3 FROM {prefix}_cand
UNION ALL SELECT pg_id, r, c, u3, v3, u1, v1 FROM {prefix}_cand""")
    view(f"{prefix}_clip", [f"{prefix}_edges"], f"""
SELECT pg_id, r, c, sign(ub - ua) AS s, lo, hi, b, va + b * (lo - ua) AS p, va + b * (hi - ua) AS q FROM (
  SELECT *, greatest(0.0::double, least(ua, ub)) AS lo, least(1.0::double, greatest(ua, ub)) AS hi,
    (vb - va) / nullif(ub - ua, 0) AS b
  FROM {prefix}_edges) WHERE hi > lo""")
    g = lambda v: (
        f"(CASE WHEN {v} < 0 THEN 0 WHEN {v} <= 1 THEN {v} * {v} / 2 ELSE {v} - 0.5::double END)"
    )
    view(prefix, [f"{prefix}_clip"], f"""
SELECT pg_id, r * {width} + c + 1 AS cell, cov AS coverage_fraction FROM (
  SELECT pg_id, r, c, abs(sum(s * CASE
      WHEN abs(q - p) < 1e-9 THEN least(greatest((p + q) / 2, 0), 1) * (hi - lo)
      ELSE ({g('q')} - {g('p')}) / b END)) AS cov
  FROM {prefix}_clip GROUP BY pg_id, r, c) WHERE cov > {eps}""")


overlay_views("overlay", "tri_units", W, "grid.height", ["grid"], "1e-9")

view("coverage", ["overlay", "dem"], """
SELECT o.*, d.elevation, false AS mask FROM overlay o LEFT JOIN dem d USING (cell)""")

view("cheap_coverage", [], """
SELECT l_partkey AS pg_id, (l_orderkey % 400) * 200 + l_suppkey % 200 + 1 AS cell,
  l_quantity / 50 AS coverage_fraction,
  CASE WHEN l_orderkey % 17 = 0 THEN NULL ELSE ((l_orderkey * 13) % 97) / 20.0::double - 1 END AS elevation,
  CASE WHEN l_linenumber = 7 THEN NULL ELSE l_returnflag = 'R' END AS mask
FROM lineitem""")

view("cheap_masked", ["cheap_coverage"], """
SELECT * FROM cheap_coverage WHERE mask IS FALSE AND elevation IS NOT NULL AND NOT isnan(elevation)""")

view("triangle_values", [], """
SELECT p_partkey AS pg_id,
  CASE WHEN p_partkey % 11 <> 3 THEN p_retailprice / 487.31::double END AS wse_weighted_average FROM part""")

view("terrain", ["dem"], "SELECT cell, elevation * 1.07317::double AS depth FROM dem WHERE elevation IS NOT NULL")

view("crosswalk", [], """
SELECT row_number() OVER (ORDER BY c_custkey) AS node_id_nc, c_custkey + 1 AS node_id_gr3
FROM customer WHERE c_custkey % 7 <> 0""")

view("land_mask", [], """
SELECT c_custkey AS pos, c_custkey + 1 AS Node, CASE WHEN c_custkey % 7 = 0 THEN 0 ELSE 1 END AS Mask
FROM customer""")

view("ready_nodes", ["nodes", "nodes_elevation"], """
SELECT n.node_id, n.long, n.lat, n.wse, e.elevation FROM nodes n
JOIN nodes_elevation e ON n.node_id = e.node_id WHERE e.elevation IS NOT NULL""")

view("valid_elements", ["elements", "ready_nodes"], """
SELECT * FROM elements WHERE node_id_1 IN (SELECT node_id FROM ready_nodes)
  AND node_id_2 IN (SELECT node_id FROM ready_nodes) AND node_id_3 IN (SELECT node_id FROM ready_nodes)""")

# Slope weights by the two-step form: for a triangle that is neither flat nor degenerate the
# sub-triangle areas equal the normalised slopes.
view("corner", ["valid_elements", "ready_nodes"], """
SELECT e.*, a.long AS x1, a.lat AS y1, a.elevation AS z1, b.long AS x2, b.lat AS y2, b.elevation AS z2,
  c.long AS x3, c.lat AS y3, c.elevation AS z3
FROM valid_elements e JOIN ready_nodes a ON a.node_id = e.node_id_1
JOIN ready_nodes b ON b.node_id = e.node_id_2 JOIN ready_nodes c ON c.node_id = e.node_id_3""")
_g = lambda i, j: (
    f"coalesce(abs(z{i} - z{j}) / nullif(sqrt((x{i}-x{j})*(x{i}-x{j}) + (y{i}-y{j})*(y{i}-y{j})), 0), 0)"
)
view("slopes", ["corner"], f"""
SELECT *, ({_g(1, 2)} + {_g(1, 3)}) / 2 AS s1, ({_g(2, 1)} + {_g(2, 3)}) / 2 AS s2,
  ({_g(3, 1)} + {_g(3, 2)}) / 2 AS s3 FROM corner""")
view("weights", ["slopes"], """
SELECT pg_id, num_nodes, node_id_1, node_id_2, node_id_3,
  s1 / (s1 + s2 + s3) AS node1_weight, s2 / (s1 + s2 + s3) AS node2_weight, s3 / (s1 + s2 + s3) AS node3_weight
FROM slopes""")

view("equal_weights", ["elements"], """
SELECT *, 1.0::double/3 AS node1_weight, 1.0::double/3 AS node2_weight, 1.0::double/3 AS node3_weight
FROM elements""")


def barycentric_view(name: str, weights: str, nodes: str) -> None:
    total = lambda v: " + ".join(f"t.node{k}_weight * n{k}.{v}" for k in (1, 2, 3))
    view(name, [weights, nodes], f"""
SELECT t.*, w.centroid_long, w.centroid_lat, w.wse_weighted_average FROM {weights} t LEFT JOIN (
  SELECT t.pg_id, {total('long')} AS centroid_long, {total('lat')} AS centroid_lat,
    {total('wse')} AS wse_weighted_average
  FROM {weights} t JOIN {nodes} n1 ON t.node_id_1 = n1.node_id
  JOIN {nodes} n2 ON t.node_id_2 = n2.node_id JOIN {nodes} n3 ON t.node_id_3 = n3.node_id
) w ON t.pg_id = w.pg_id""")


barycentric_view("equal_barycentric", "equal_weights", "ready_nodes")
barycentric_view("slope_barycentric", "weights", "ready_nodes")


def depth_view(name: str, cov: str, tri: str) -> None:
    view(name, [cov, tri], f"""
SELECT w.cell, w.wse AS wse_cell_weighted_average, e.elevation, w.wse - e.elevation AS depth FROM (
  SELECT c.cell, sum(t.wse_weighted_average * c.coverage_fraction) / sum(c.coverage_fraction) AS wse
  FROM {cov} c LEFT JOIN {tri} t ON c.pg_id = t.pg_id GROUP BY c.cell) w
JOIN (SELECT cell, max(elevation) AS elevation FROM {cov} GROUP BY cell) e ON w.cell = e.cell
WHERE e.elevation IS NOT NULL AND NOT isnan(e.elevation)""")


view("masked_coverage", ["coverage"], """
SELECT * FROM coverage WHERE mask IS FALSE AND elevation IS NOT NULL AND NOT isnan(elevation)""")
depth_view("equal_depth", "coverage", "equal_barycentric")
depth_view("slope_depth", "masked_coverage", "slope_barycentric")
view("first_elevation", ["cheap_masked"], "SELECT cell, max(elevation) AS elevation FROM cheap_masked GROUP BY cell")

view("diamonds", [], """
SELECT ['levee', 'lakes', 'water'][CAST(s_suppkey % 3 AS INTEGER) + 1] AS layer, s_suppkey AS feature_id,
  -82 + 0.29::double * ((s_suppkey * 29) % 100) / 100 AS cx, 30 - 0.005::double * s_suppkey AS cy
FROM supplier""")
view("centers", ["grid"], f"""
SELECT r, c, r * {W} + c + 1 AS cell,
  {C} + (c + 0.5::double) * {A} AS x, {Y0} + (r + 0.5::double) * {E} AS y
FROM (SELECT unnest(range(0, height)) AS r FROM grid) CROSS JOIN (SELECT unnest(range(0, {W})) AS c)""")
# A diamond is the set |dx| + |dy| < h, so membership is a direct point test.
view("diamond_cells", ["diamonds", "centers"], """
SELECT d.layer, d.feature_id, p.r, p.c, p.cell FROM diamonds d JOIN centers p
  ON abs(p.x - d.cx) + abs(p.y - d.cy) < 0.01035::double""")
view("node_box", ["nodes"], """
SELECT min(long) AS x0, min(lat) AS y0, max(long) AS x1, max(lat) AS y1 FROM nodes""")


def _ring_view(name: str, corners: list[tuple[float, float]]) -> None:
    vertex = lambda i: (
        f"x0 + {corners[i][0]}::double * (x1 - x0)", f"y0 + {corners[i][1]}::double * (y1 - y0)"
    )
    parts = []
    for i in range(len(corners)):
        (xa, ya), (xb, yb) = vertex(i), vertex((i + 1) % len(corners))
        parts.append(f"SELECT {xa} AS xa, {ya} AS ya, {xb} AS xb, {yb} AS yb FROM node_box")
    view(f"{name}_edges", ["node_box"], " UNION ALL ".join(parts))
    # Ray casting to the right of the centre, and the distance to the nearest segment.
    view(f"{name}_test", [f"{name}_edges", "centers"], f"""
SELECT cell, r, c, sum(CASE WHEN least(ya, yb) <= y AND y < greatest(ya, yb)
    AND xa + (y - ya) * (xb - xa) / (yb - ya) > x THEN 1 ELSE 0 END) % 2 = 1 AS inside,
  min(sqrt((x - xa - t * (xb - xa)) ** 2 + (y - ya - t * (yb - ya)) ** 2)) AS distance
FROM (SELECT *, least(greatest(((x - xa) * (xb - xa) + (y - ya) * (yb - ya))
    / nullif((xb - xa) ** 2 + (yb - ya) ** 2, 0), 0), 1) AS t
  FROM centers CROSS JOIN {name}_edges) GROUP BY cell, r, c""")


_ring_view("domain", [(0.03, 0.5), (0.25, 0.03), (0.75, 0.03), (0.97, 0.5), (0.75, 0.97), (0.25, 0.97)])
_ring_view("state", [(0.05, 0.05), (0.95, 0.05), (0.95, 0.95), (0.05, 0.95)])

view("general_masked", ["domain_test", "state_test", "diamond_cells"], """
SELECT d.cell, (NOT d.inside AND d.distance <= 10) OR (NOT s.inside AND s.distance <= 10)
  OR d.cell IN (SELECT cell FROM diamond_cells) AS mask
FROM domain_test d JOIN state_test s ON d.cell = s.cell""")

view("runs", [], """
SELECT strftime(ts, '%Y%m%d') AS run_id, user_id + 1 AS node_id, avg(value) / 100 AS wse
FROM events GROUP BY ALL""")
