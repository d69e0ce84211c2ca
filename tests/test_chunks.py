"""The chunk store on an object store, and with a fault at every step of a replacement."""

import itertools
import json
import os

import numpy as np
import pytest
import stub_store
from pyspark.sql import Row
from pyspark.sql import functions as F

from tidegrid.functions.grid import GridMeta
from tidegrid.sinks import chunks as ch
from tidegrid.sinks import rasters as rs

META = GridMeta(8, 4, (1.0, 0.0, 0.0, 0.0, -1.0, 4.0))


def writer(root, version, arrays=("a",)):
    info = {"zarr_format": 2, "shape": [4, 8], "chunks": [4, 4], "dtype": "<f4", "fill_value": -9999.0}
    return ch.ChunkWriter({"uri": f"objects://{root}", "version": version, "opener": "stub_store:open_store", "arrays": json.dumps(list(arrays)),
                           "info": json.dumps(info), "attributes": json.dumps({"geotransform": [1, 0, 0, 0, -1, 4], "crs": "", "nodata": -9999.0})})


def tile(col, value, array="a"):
    return Row(array=array, tile_row=0, tile_col=col, n_rows=4, n_cols=4, data=np.full((4, 4), value, "<f4").tobytes())


def replace(root, version, rows, arrays=("a",)):
    """What Spark and ``write_arrays`` do, one step after another in this process."""
    fs, _ = stub_store.open_store(str(root))
    before = {a: ch.read_current(fs, str(root), a) for a in arrays}
    job, done = writer(root, version, arrays), []
    try:
        done = [job.write(iter([row])) for row in rows]
        job.commit(done)
    except stub_store.Fault:
        stub_store.STEPS_LEFT = None  # Spark aborts when the store answers again
        job.abort(done)
        raise
    for a in arrays:
        state = ch.read_current(fs, str(root), a)
        for place, name in state["chunks"].items():
            ch.publish_chunk(fs, str(root), a, version, place, name)
        ch.publish_header(fs, str(root), a, state)
        if before[a]:
            ch.drop_version(fs, str(root), a, before[a]["version"])


def content(root, array="a"):
    """Value per chunk, as our reader finds it."""
    fs, _ = stub_store.open_store(str(root))
    state = ch.array_state(fs, str(root), array)
    return {place: float(np.fromfile(path, "<f4")[0]) for place, path in state["chunks"].items()}


def test_a_fault_at_any_step_leaves_the_old_or_the_new_array(tmp_path):
    old, new = {"0.0": 1.0, "0.1": 2.0}, {"0.1": 3.0, "0.2": 4.0}
    outcomes = []
    for steps in itertools.count():
        root = tmp_path / str(steps)
        replace(root, "v1", [tile(0, 1.0), tile(1, 2.0)])
        assert content(root) == old
        stub_store.STEPS_LEFT = steps
        try:
            replace(root, "v2", [tile(1, 3.0), tile(2, 4.0)])
        except stub_store.Fault:
            pass
        finally:
            whole, stub_store.STEPS_LEFT = stub_store.STEPS_LEFT is not None and stub_store.STEPS_LEFT >= 0, None
        found = content(root)
        assert found in (old, new)
        outcomes.append(found)
        # A later write makes everything right again.
        replace(root, "v3", [tile(0, 9.0)])
        assert content(root) == {"0.0": 9.0}
        assert sorted(n for n in os.listdir(root / "a") if n[0] != ".") == ["0.0"]
        if whole:
            break
    assert old in outcomes and outcomes[-1] == new and len(outcomes) > 10


def test_attempts_that_are_not_reported_do_not_count(tmp_path):
    job = writer(tmp_path, "v1")
    job.write(iter([tile(0, 5.0)]))  # killed before it reported
    job.commit([job.write(iter([tile(0, 6.0)])), None])
    assert content(tmp_path) == {"0.0": 6.0}


@pytest.fixture(scope="module")
def with_stub(spark):
    spark.sparkContext.addPyFile(stub_store.__file__)


def test_object_store(spark, with_stub, tmp_path):
    cells = spark.range(1, 33).select(F.col("id").alias("cell"), F.col("id").cast("double").alias("depth"))
    store, how = f"objects://{tmp_path}/s", {"chunk": 4, "opener": "stub_store:open_store"}
    assert rs.write_chunk_store(cells, META, "depth", store, "x", **how) == 2
    assert rs.write_chunk_store(cells.where("cell = 1"), META, "depth", store, "x", **how) == 1
    found = rs.read_chunk_store(spark, store, "x", opener=how["opener"])
    assert [(r["cell"], r["value"]) for r in found.collect()] == [(1, 1.0)]
    assert sorted(os.listdir(tmp_path / "s" / "x")) == [".zarray", ".zattrs", "0.0"]
    assert json.loads((tmp_path / "s" / ".zmetadata").read_text())["metadata"]["x/.zarray"]["shape"] == [4, 8]
    broken = cells.withColumn("depth", F.raise_error(F.lit("lost")).cast("double"))
    with pytest.raises(Exception, match="lost"):
        rs.write_chunk_store(broken, META, "depth", store, "x", **how)
    assert rs.read_chunk_store(spark, store, "x", opener=how["opener"]).count() == 1


def test_plain_arrays_are_read_and_taken_over(spark, tmp_path):
    """An array that another writer laid out, without versions."""
    store = str(tmp_path / "s")
    cells = spark.range(1, 33).select(F.col("id").alias("cell"), F.col("id").cast("double").alias("depth"))
    rs.write_chunk_store(cells, META, "depth", store, "x", chunk=4)
    os.rename(f"{store}/.current/x.json", f"{store}/.current/gone")
    assert rs.read_chunk_store(spark, store, "x").count() == 32
    rs.write_chunk_store(cells.where("cell > 30"), META, "depth", store, "x", chunk=4)
    assert {r["cell"] for r in rs.read_chunk_store(spark, store, "x").collect()} == {31, 32}


def test_many_runs_in_one_job(spark, tmp_path):
    store = str(tmp_path / "s")
    cells = spark.range(64).select(
        (F.col("id") % 32 + 1).alias("cell"), F.concat(F.lit("r"), (F.col("id") / 32).cast("int")).alias("run_id"),
        F.col("id").cast("double").alias("depth"), (F.col("id") + 100).cast("double").alias("wse_cell_weighted_average"))
    runs = [f"r{k}" for k in range(3)]
    written = rs.write_run_arrays(cells, META, ["wse", "depth"], store, runs, chunk=4)
    assert written == {f"r{k}_{v}": 2 if k < 2 else 0 for k in range(3) for v in ("wse", "depth")}
    assert {(r["cell"], r["value"]) for r in rs.read_chunk_store(spark, store, "r1_wse").collect()} == {(k + 1, 132.0 + k) for k in range(32)}
    assert rs.read_chunk_store(spark, store, "r2_depth").count() == 0
