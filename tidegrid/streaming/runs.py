"""Incremental processing: each forecast run that lands gets its own depth partition and rasters.

The landing folder holds one ``run_id=...`` partition per run. A micro-batch only says
which runs have news; each of those runs is computed again from everything it has landed
and replaces its own partition and arrays, so a repeated or split batch gives the same
tables. Files that a run has been computed from already, ahead of their own batch, are no news
when their batch comes: a run whose files fill many batches is computed once. A run without wet
cells leaves no partition, and arrays without chunks.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from tidegrid.functions.scalars import nan_to_null
from tidegrid.operators.positions import _plain
from tidegrid.operators.zonal import depth_by_tile, triangle_wse_runs
from tidegrid.session import colocated_joins
from tidegrid.sinks.rasters import write_run_arrays
from tidegrid.sinks.store import TableStore
from tidegrid.sources.filesystem import _resolve, list_paths, path_exists
from tidegrid.sources.tables import SNAPSHOT_NODE, load_dem_metadata

NODE_WSE_SCHEMA = "node_id bigint, wse double, run_id string"
SNAPSHOT_SCHEMA = f"{SNAPSHOT_NODE} bigint, elevation double, run_id string"
DEPTH_SCHEMA = "cell bigint, wse_cell_weighted_average double, elevation double, depth double, run_id string"


def _files(spark: SparkSession, folder: str) -> set[str]:
    """Data files of a partition; every write names its files anew."""
    return set(list_paths(spark, folder)) if path_exists(spark, folder) else set()


def snapshot_levels(store: TableStore, rows: DataFrame) -> DataFrame:
    """Levels on mesh nodes from snapshot rows of many runs: positions from 0 are renumbered through the crosswalk."""
    numbered = rows.select("run_id", (F.col(SNAPSHOT_NODE) + 1).alias("node_id_nc"), F.col("elevation").alias("wse"))
    joined = numbered.join(store.read("node_cross_walk"), "node_id_nc")
    return joined.select(F.col("node_id_gr3").alias("node_id"), "wse", "run_id")


def runs_depth(
    store: TableStore, node_wse: DataFrame, threshold: float | None = None
) -> DataFrame:
    """Depth per run and cell for node water levels of one or many runs."""
    clean = node_wse.select("run_id", "node_id", nan_to_null("wse").alias("wse"))
    triangles = triangle_wse_runs(store.read("triangle_weights"), clean)
    return depth_by_tile(
        store.read("masked_coverage_fraction"), store.read("triangle_tiles"), triangles, threshold,
        any_hot=not store.read("hot_tiles").isEmpty(),
    )


def stream_runs(
    spark: SparkSession,
    landing_dir: str,
    store_root: str,
    output_dir: str,
    checkpoint_dir: str,
    threshold: float | None = None,
    max_files: int = 1000,
    snapshots: bool = False,
    chunk_store: str | None = None,
    variables: tuple[str, ...] = ("depth",),
) -> StreamingQuery:
    """Start the job over everything that has landed and not been processed yet.

    ``snapshots`` says that files land as the model writes them (positions and model names)
    and not renumbered. With ``chunk_store``, each run's variables are written as arrays
    ``<run_id>_<variable>``.
    """
    schema = SNAPSHOT_SCHEMA if snapshots else NODE_WSE_SCHEMA
    landed = spark.readStream.schema(schema).option("maxFilesPerTrigger", max_files).parquet(landing_dir)
    landed = landed.select("run_id", F.col("_metadata.file_path").alias("file"))
    # Files computed from whose batches are still to come.
    ahead: set[str] = set()

    def process(batch: DataFrame, batch_id: int) -> None:
        session = batch.sparkSession
        # One row per file of the batch, so never more than files of a trigger.
        news = [(r["run_id"], r["file"]) for r in batch.distinct().collect()]
        touched = {run: file.rsplit("/", 1)[0] for run, file in news if _plain(file) not in ahead}
        if touched:
            ahead.update(compute(session, touched))
        ahead.difference_update(_plain(file) for _, file in news)

    def compute(session: SparkSession, touched: dict[str, str]) -> set[str]:
        """Replace what is stored of the runs, given with their folders; returns the files read."""
        store = TableStore(session, store_root)
        rows = session.read.schema(schema).option("basePath", landing_dir).parquet(*touched.values())
        levels = snapshot_levels(store, rows) if snapshots else rows
        result = runs_depth(store, levels, threshold)
        # A run keeps its old cells until the new ones are there; one that has become dry loses them then.
        partition = lambda run: f"{output_dir}/run_id={run}"
        before = {run: _files(session, partition(run)) for run in touched}
        placed = result.repartition("run_id", F.floor(F.col("cell") / F.lit(4_000_000)))
        with colocated_joins(session):
            (
                placed.write.mode("overwrite").option("partitionOverwriteMode", "dynamic")
                .partitionBy("run_id").parquet(output_dir)
            )
        for run in touched:
            if _files(session, partition(run)) <= before[run]:
                fs, folder = _resolve(session, partition(run))
                fs.delete(folder, True)
        files = {_plain(file) for file in rows.inputFiles()}
        if chunk_store is None:
            return files
        meta = load_dem_metadata(store.read("dem_metadata"))
        depth = session.read.schema(DEPTH_SCHEMA).parquet(output_dir).where(F.col("run_id").isin(list(touched)))
        write_run_arrays(depth, meta, list(variables), chunk_store, list(touched))
        return files

    return (
        landed.writeStream.foreachBatch(process)
        .option("checkpointLocation", checkpoint_dir)
        .trigger(availableNow=True)
        .start()
    )
