"""Coverage-weighted means per cell and flood depth."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidegrid.functions.grid import GridMeta, cell_to_rowcol, int_div
from tidegrid.operators.skew import HOT, SALT, salted_join


def filter_masked(cov: DataFrame, threshold: float | None = None) -> DataFrame:
    """Coverage rows to keep: mask strictly false, elevation present, optional threshold.

    A NULL mask is dropped like a true one.
    """
    kept = cov.where(F.col("mask").eqNullSafe(F.lit(False))).where(
        F.col("elevation").isNotNull() & ~F.isnan("elevation")
    )
    if threshold is not None:
        kept = kept.where(F.col("elevation") >= F.lit(float(threshold)))
    return kept


def _joined(cov: DataFrame, tri: DataFrame, hot: DataFrame | None) -> DataFrame:
    return salted_join(
        cov.select("pg_id", "cell", "coverage_fraction", "elevation"),
        tri.select("pg_id", "wse_weighted_average"),
        "pg_id", hot, spread_by="cell",
    )


def _weighted_mean(renormalize: bool) -> Column:
    """Weighted mean water level of a cell.

    A triangle without a water level adds nothing to the numerator while its coverage stays
    in the denominator; ``renormalize`` leaves that coverage out as well.
    """
    wse, cov = F.col("wse_weighted_average"), F.col("coverage_fraction")
    base = F.when(wse.isNotNull(), cov) if renormalize else cov
    return F.sum(wse * cov) / F.nullif(F.sum(base), F.lit(0.0))


def cell_wse(
    cov: DataFrame, tri: DataFrame, renormalize: bool = False, hot: DataFrame | None = None
) -> DataFrame:
    """Coverage-weighted mean water level per cell: cell, wse_cell_weighted_average."""
    return _joined(cov, tri, hot).groupBy("cell").agg(
        _weighted_mean(renormalize).alias("wse_cell_weighted_average")
    )


def cell_elevation(cov: DataFrame) -> DataFrame:
    """One elevation per cell, cells without one left out.

    Elevation is a function of the cell, so ``max`` picks the same value as "any row" would,
    whatever the row order.
    """
    per_cell = cov.groupBy("cell").agg(F.max("elevation").alias("elevation"))
    return per_cell.where(F.col("elevation").isNotNull() & ~F.isnan("elevation"))


def with_depth(df: DataFrame) -> DataFrame:
    """Add depth = water level - elevation."""
    return df.withColumn("depth", F.col("wse_cell_weighted_average") - F.col("elevation"))


def filter_depth(df: DataFrame, threshold: float | None = None) -> DataFrame:
    """Rows at or above a depth threshold (0 when not given)."""
    return df.where(F.col("depth") >= F.lit(0.0 if threshold is None else float(threshold)))


def mask_depth(df: DataFrame, threshold: float, nodata: float) -> DataFrame:
    """Depth below the threshold replaced by nodata; the row stays."""
    return df.withColumn(
        "depth", F.when(F.col("depth") < F.lit(float(threshold)), F.lit(nodata)).otherwise(F.col("depth"))
    )


def depth(
    cov: DataFrame,
    tri: DataFrame,
    threshold: float | None = None,
    renormalize: bool = False,
    hot: DataFrame | None = None,
) -> DataFrame:
    """Depth per cell: cell, wse_cell_weighted_average, elevation, depth.

    The mean and the elevation come from one aggregation, so coverage is shuffled to its
    triangles once and partial sums to their cells once; no cell-level join follows.
    """
    per_cell = _joined(cov, tri, hot).groupBy("cell").agg(
        _weighted_mean(renormalize).alias("wse_cell_weighted_average"),
        F.max("elevation").alias("elevation"),
    )
    per_cell = per_cell.where(F.col("elevation").isNotNull() & ~F.isnan("elevation"))
    return filter_depth(with_depth(per_cell), threshold)


def depth_legacy(cov: DataFrame, tri: DataFrame, hot: DataFrame | None = None) -> DataFrame:
    """Depth per cell at or above zero, from separately named sums.

    The older form joined both sums back to the detail rows and took the first per cell; a
    sum divided per group is the same value without the joins.
    """
    wse, cov_col = F.col("wse_weighted_average"), F.col("coverage_fraction")
    sums = _joined(cov, tri, hot).groupBy("cell").agg(
        F.sum(wse * cov_col).alias("weighted_sum"),
        F.sum(cov_col).alias("coverage_sum"),
        F.max("elevation").alias("elevation"),
    )
    mean = sums.select(
        "cell",
        (F.col("weighted_sum") / F.nullif(F.col("coverage_sum"), F.lit(0.0))).alias("wse_cell_weighted_average"),
        "elevation",
    ).where(F.col("elevation").isNotNull() & ~F.isnan("elevation"))
    return filter_depth(with_depth(mean), 0.0)


def first_per_key(df: DataFrame, key: str, order_col: str | None = None) -> DataFrame:
    """First non-NULL value of every other column per key; ordered when a column is named."""
    def pick(c: str) -> Column:
        if order_col is None:
            return F.first(c, ignorenulls=True).alias(c)
        return F.min_by(c, F.when(F.col(c).isNotNull(), F.col(order_col))).alias(c)

    return df.groupBy(key).agg(*[pick(c) for c in df.columns if c != key])


def select_outputs(df: DataFrame, generate_wse: bool, generate_depth: bool) -> DataFrame | None:
    """Result columns chosen by the flags; None when both are off."""
    if not generate_wse and not generate_depth:
        return None
    wanted = ["cell"]
    if generate_wse:
        wanted.append("wse_cell_weighted_average")
    if generate_depth:
        wanted.append("depth")
    return df.select(*wanted)


# --- many runs over one static domain -------------------------------------------------


def with_coverage_sum(cov: DataFrame, hot: DataFrame | None = None) -> DataFrame:
    """Coverage rows with the total coverage of their cell, a static fact of the domain.

    Sums are partly aggregated before the shuffle and joined back, the rows of ``hot`` cells
    spread over several tasks, so a cell under very many triangles is never gathered in one.
    """
    sums = cov.groupBy("cell").agg(F.sum("coverage_fraction").alias("coverage_sum"))
    joined = salted_join(cov, sums, "cell", hot, spread_by="pg_id", how="inner")
    return joined.select(*cov.columns, "coverage_sum")


def with_tile(cov: DataFrame, meta: GridMeta, size: int = 512) -> DataFrame:
    """Coverage rows with the number of the raster tile their cell lies in."""
    across = -(-meta.width // size)
    tile = int_div(F.col("row"), size) * across + int_div(F.col("col"), size)
    return cell_to_rowcol(cov, meta.width).select(*cov.columns, tile.alias("tile"))


def triangle_wse_runs(weights: DataFrame, node_wse: DataFrame) -> DataFrame:
    """Water level per run and complete triangle: run_id, pg_id, wse_weighted_average.

    The three vertices are unpivoted, so node values are shuffled once, with one row per
    vertex use. Products are added in vertex order, as the single-run form does.
    """
    uses = weights.select("pg_id", F.inline(F.array(*[
        F.struct(F.lit(k).alias("k"), F.col(f"node_id_{k}").alias("node_id"),
                 F.col(f"node{k}_weight").alias("w")) for k in (1, 2, 3)
    ])))
    terms = uses.join(node_wse.select("run_id", "node_id", "wse"), "node_id").select(
        "run_id", "pg_id", "k", (F.col("w") * F.col("wse")).alias("term")
    )
    by_vertex = terms.groupBy("run_id", "pg_id").agg(
        *[F.max(F.when(F.col("k") == k, F.col("term"))).alias(f"t{k}") for k in (1, 2, 3)]
    )
    total = F.col("t1") + F.col("t2") + F.col("t3")
    return by_vertex.select("run_id", "pg_id", total.alias("wse_weighted_average")).where(
        "wse_weighted_average IS NOT NULL"
    )


def depth_runs(
    cov: DataFrame, tri_runs: DataFrame, threshold: float | None = None, hot: DataFrame | None = None
) -> DataFrame:
    """Depth per run and cell for many runs in one job.

    The denominator is static, so a run needs only its own non-NULL numerators; cells no
    triangle reaches in a run have no water level and would fail the depth filter anyway.
    """
    if "coverage_sum" not in cov.columns:
        cov = with_coverage_sum(cov)
    joined = salted_join(
        cov.select("pg_id", "cell", "coverage_fraction", "coverage_sum", "elevation"),
        tri_runs, "pg_id", hot, spread_by="cell", how="inner",
    )
    sums = joined.groupBy("run_id", "cell").agg(*_cell_sums(renormalize=False))
    return _depth_of_sums(sums, ["run_id"], threshold)


def _cell_sums(renormalize: bool) -> list[Column]:
    wse, cov = F.col("wse_weighted_average"), F.col("coverage_fraction")
    base = F.sum(cov) if renormalize else F.max("coverage_sum")
    return [F.sum(wse * cov).alias("weighted_sum"), base.alias("base"), F.max("elevation").alias("elevation")]


def _depth_of_sums(sums: DataFrame, run: list[str], threshold: float | None) -> DataFrame:
    mean = F.col("weighted_sum") / F.nullif(F.col("base"), F.lit(0.0))
    cells = sums.select(*run, "cell", mean.alias("wse_cell_weighted_average"), "elevation")
    cells = cells.where(F.col("elevation").isNotNull() & ~F.isnan("elevation"))
    return filter_depth(with_depth(cells), threshold)


def depth_by_tile(
    cov: DataFrame,
    places: DataFrame,
    tri: DataFrame,
    threshold: float | None = None,
    renormalize: bool = False,
    bounded_buckets: bool = True,
    any_hot: bool = True,
) -> DataFrame:
    """Depth per cell (and run) from coverage laid out by raster tile, without moving it.

    ``cov`` is stored bucketed by (tile, salt), ``places`` says in which of those each
    triangle has coverage. Only the triangle values are shuffled, to the buckets holding
    their coverage; the join and the sums per cell then both run inside a bucket. Tiles
    with exceptionally many rows are salted, and only their partial sums are added up
    across buckets. ``tri`` may hold many runs (a ``run_id`` column).

    A triangle without a level adds nothing to a numerator and the denominator is static,
    so an inner join gives what a left join and the depth filter would.

    ``bounded_buckets`` says that a bucket's triangles fit a task's memory (the store knows the
    bytes per bucket): they are then hashed, and the stored order of the coverage serves the
    sums. Otherwise Spark picks a join that can spill. ``any_hot=False`` says that no tile is
    salted; the coverage is then scanned once. The result is the same.
    """
    run = [c for c in ("run_id",) if c in tri.columns]
    known = tri.where("wse_weighted_average IS NOT NULL").select(*run, "pg_id", "wse_weighted_average")
    # Dealt out by bucket at the very top: as the join leaves them (by triangle, in as many parts as
    # shuffles have), the planner would follow them and move the coverage instead.
    placed = places.select("pg_id", "tile", SALT).join(known, "pg_id").repartition("tile", SALT)
    if not run and bounded_buckets:
        placed = placed.hint("shuffle_hash")

    def sums(part: Column) -> DataFrame:
        rows = cov.where(part).select(
            "tile", SALT, "pg_id", "cell", "coverage_fraction", "coverage_sum", "elevation"
        )
        joined = rows.join(placed, ["tile", SALT, "pg_id"])
        return joined.groupBy("tile", SALT, "cell", *run).agg(*_cell_sums(renormalize))

    if not any_hot:
        return _depth_of_sums(sums(F.lit(True)), run, threshold)
    across = sums(F.col(HOT)).groupBy(*run, "cell").agg(
        F.sum("weighted_sum").alias("weighted_sum"),
        (F.sum("base") if renormalize else F.max("base")).alias("base"),
        F.max("elevation").alias("elevation"),
    )
    settled = sums(~F.col(HOT)).select(*across.columns)
    return _depth_of_sums(settled.unionByName(across), run, threshold)
