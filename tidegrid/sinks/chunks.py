"""A store of chunked arrays, written through a Spark data source with a commit.

    <store>/.zgroup, .zmetadata
    <store>/<array>/.zarray, .zattrs, <row>.<col>       plain layout, for any reader of the format
    <store>/.versions/<array>/<version>/...             chunks as the tasks wrote them
    <store>/.current/<array>.json                       the version that counts, with its chunks

Tasks write chunks into the folder of a new version, each under a name of its own, and report
the names; what a failed or repeated attempt leaves is never reported. When all have reported,
the driver replaces one small file, which says what counts from then on. Our reader follows that
file. The plain layout is brought up to it afterwards, file by file, and the folder of the
version before goes last. No folder is ever moved, and every file appears whole, so this works
on object stores as well; whatever fails, the array is the old one or the new one.
"""

from __future__ import annotations

import importlib
import json
import math
import uuid
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, Row, SparkSession
from pyspark.sql.datasource import DataSource, DataSourceWriter, WriterCommitMessage

from tidegrid.functions.grid import GridMeta
from tidegrid.operators.tiles import tiles_to_cells
from tidegrid.session import ship_package
from tidegrid.sources.filesystem import qualify

FORMAT = "tidegrid_chunks"


def open_store(uri: str, opener: str | None = None):
    """File system and root folder of a store; ``opener`` names a function ``module:name`` for stores of another kind."""
    if opener:
        module, name = opener.split(":")
        return getattr(importlib.import_module(module), name)(uri)
    from pyarrow import fs as pafs

    return pafs.FileSystem.from_uri(uri)


def _exists(fs, path: str) -> bool:
    from pyarrow import fs as pafs

    return fs.get_file_info(path).type == pafs.FileType.File


def _listed(fs, folder: str) -> list[str]:
    from pyarrow import fs as pafs

    found = fs.get_file_info(pafs.FileSelector(folder, allow_not_found=True))
    return [f.base_name for f in found if f.type == pafs.FileType.File]


def put(fs, path: str, payload: bytes, parts: str) -> None:
    """Write a whole file or nothing: the bytes go to a file in ``parts``, which is then moved."""
    fs.create_dir(parts, recursive=True)
    part = f"{parts}/{uuid.uuid4().hex}"
    with fs.open_output_stream(part) as out:
        out.write(payload)
    fs.create_dir(path.rsplit("/", 1)[0], recursive=True)
    fs.move(part, path)


def _version_folder(root: str, array: str, version: str) -> str:
    return f"{root}/.versions/{array}/{version}"


def read_current(fs, root: str, array: str) -> dict | None:
    """What counts of an array: version, chunk file by place, description, attributes; None for an array without versions."""
    path = f"{root}/.current/{array}.json"
    if not _exists(fs, path):
        return None
    with fs.open_input_stream(path) as stream:
        return json.loads(stream.read())


@dataclass
class ChunksWritten(WriterCommitMessage):
    """Names of the chunk files of one task: (array, row.col, file)."""

    chunks: list[tuple[str, str, str]]


class ChunkWriter(DataSourceWriter):
    """Writes tile rows as chunks of a new version of each array, and makes the versions count."""

    def __init__(self, options: dict[str, str]):
        self.uri, self.version, self.opener = options["uri"], options["version"], options.get("opener")
        self.arrays, self.info, self.attributes = (json.loads(options[k]) for k in ("arrays", "info", "attributes"))

    def write(self, iterator: Iterator[Row]) -> ChunksWritten:
        fs, root = open_store(self.uri, self.opener)
        side, fill = self.info["chunks"][0], float(self.info["fill_value"])
        attempt, chunks = uuid.uuid4().hex[:12], []
        for t in iterator:
            block = np.full((side, side), fill, dtype="<f4")
            block[: t.n_rows, : t.n_cols] = np.frombuffer(t.data, dtype="<f4").reshape(t.n_rows, t.n_cols)
            place = f"{t.tile_row}.{t.tile_col}"
            folder = _version_folder(root, t.array, self.version)
            fs.create_dir(folder, recursive=True)
            with fs.open_output_stream(f"{folder}/{place}-{attempt}") as out:
                out.write(block.tobytes())
            chunks.append((t.array, place, f"{place}-{attempt}"))
        return ChunksWritten(chunks)

    def commit(self, messages: list[ChunksWritten | None]) -> None:
        fs, root = open_store(self.uri, self.opener)
        chunks: dict[str, dict[str, str]] = {a: {} for a in self.arrays}
        for message in messages:
            for array, place, name in message.chunks if message else ():
                chunks[array][place] = name
        for array in self.arrays:
            state = {"version": self.version, "info": self.info, "attributes": self.attributes, "chunks": chunks[array]}
            put(fs, f"{root}/.current/{array}.json", json.dumps(state).encode(), f"{_version_folder(root, array, self.version)}/parts")

    def abort(self, messages: list[ChunksWritten | None]) -> None:
        fs, root = open_store(self.uri, self.opener)
        for array in self.arrays:
            state = read_current(fs, root, array)
            if state is None or state["version"] != self.version:  # a commit that failed half-way keeps what counts
                drop_version(fs, root, array, self.version)


class ChunkSource(DataSource):
    """``df.write.format("tidegrid_chunks")``; see :func:`write_arrays` for the options."""

    @classmethod
    def name(cls) -> str:
        return FORMAT

    def writer(self, schema, overwrite: bool) -> ChunkWriter:
        return ChunkWriter(dict(self.options))


def drop_version(fs, root: str, array: str, version: str) -> None:
    from pyarrow import fs as pafs

    folder = _version_folder(root, array, version)
    if fs.get_file_info(folder).type == pafs.FileType.Directory:
        fs.delete_dir(folder)


def publish_header(fs, root: str, array: str, state: dict) -> None:
    """Description and attributes of the plain layout, and no chunk that the version does not have."""
    parts = f"{_version_folder(root, array, state['version'])}/parts"
    for name in _listed(fs, f"{root}/{array}"):
        if not name.startswith(".") and name not in state["chunks"]:
            fs.delete_file(f"{root}/{array}/{name}")
    put(fs, f"{root}/{array}/.zattrs", json.dumps(state["attributes"]).encode(), parts)
    put(fs, f"{root}/{array}/.zarray", json.dumps(state["info"]).encode(), parts)


def publish_chunk(fs, root: str, array: str, version: str, place: str, name: str) -> None:
    folder = _version_folder(root, array, version)
    fs.create_dir(f"{folder}/parts", recursive=True)
    part = f"{folder}/parts/{uuid.uuid4().hex}"
    fs.copy_file(f"{folder}/{name}", part)
    fs.create_dir(f"{root}/{array}", recursive=True)
    fs.move(part, f"{root}/{array}/{place}")


def publish(spark: SparkSession, store: str, arrays: list[str], opener: str | None = None) -> None:
    """Bring the plain layout of arrays up to the versions that count; may be repeated at any time."""
    uri = store if opener else qualify(spark, store).rstrip("/")
    fs, root = open_store(uri, opener)
    states = {a: state for a in arrays if (state := read_current(fs, root, a))}
    rows = [(a, s["version"], place, name) for a, s in states.items() for place, name in s["chunks"].items()]

    def copy(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        target, folder = open_store(uri, opener)
        for batch in batches:
            for row in batch.itertuples(index=False):
                publish_chunk(target, folder, *row)
            yield pd.DataFrame({"n": [len(batch)]})

    if rows:
        tasks = min(len(rows), 4 * spark.sparkContext.defaultParallelism)
        table = spark.createDataFrame(rows, "array string, version string, place string, name string")
        table.repartition(tasks).mapInPandas(copy, "n bigint").agg({"n": "sum"}).collect()
    for array, state in states.items():
        publish_header(fs, root, array, state)
    if states:
        put(fs, f"{root}/.zgroup", json.dumps({"zarr_format": 2}).encode(), f"{root}/.current/parts")


def write_arrays(
    tiles: DataFrame, meta: GridMeta, store: str, arrays: list[str], chunk: int = 512, nodata: float = -9999.0,
    opener: str | None = None,
) -> dict[str, int]:
    """Write tiles (``array``, tile_row, tile_col, n_rows, n_cols, data) of any number of arrays in one job.

    Every array named in ``arrays`` is replaced; one without tiles reads as nodata. Returns
    chunks written per array.
    """
    spark = tiles.sparkSession
    uri = store if opener else qualify(spark, store).rstrip("/")
    ship_package(spark)
    # Keys and encodings that readers of the format expect.
    info = {
        "zarr_format": 2, "shape": [meta.height, meta.width], "chunks": [chunk, chunk],
        "dtype": "<f4", "compressor": None, "fill_value": nodata if not math.isnan(nodata) else "NaN",
        "order": "C", "filters": None,
    }
    attributes = {
        "geotransform": list(meta.transform), "crs": meta.crs, "nodata": nodata,
        "_ARRAY_DIMENSIONS": ["lat", "lon"],
    }
    fs, root = open_store(uri, opener)
    before = {a: read_current(fs, root, a) for a in arrays}
    version = uuid.uuid4().hex
    spark.dataSource.register(ChunkSource)
    options = {"uri": uri, "version": version, "arrays": json.dumps(arrays), "info": json.dumps(info), "attributes": json.dumps(attributes)}
    writer = tiles.select("array", "tile_row", "tile_col", "n_rows", "n_cols", "data").write.format(FORMAT).mode("append")
    writer.options(**options, **({"opener": opener} if opener else {})).save()
    publish(spark, store, arrays, opener)
    for array, state in before.items():
        if state is not None:
            drop_version(fs, root, array, state["version"])
    return {a: len(read_current(fs, root, a)["chunks"]) for a in arrays}


def consolidate_store(spark: SparkSession, store: str, opener: str | None = None) -> None:
    """Write the store-level metadata file listing every array."""
    from pyarrow import fs as pafs

    fs, root = open_store(store if opener else qualify(spark, store).rstrip("/"), opener)
    documents = {".zgroup": {"zarr_format": 2}}
    for entry in fs.get_file_info(pafs.FileSelector(root)):
        name = entry.path.rstrip("/").rsplit("/", 1)[-1]
        if entry.type != pafs.FileType.Directory or name.startswith((".", "_")):
            continue
        for part in (".zarray", ".zattrs"):
            if _exists(fs, f"{entry.path}/{part}"):
                with fs.open_input_stream(f"{entry.path}/{part}") as stream:
                    documents[f"{name}/{part}"] = json.loads(stream.read())
    payload = {"zarr_consolidated_format": 1, "metadata": documents}
    put(fs, f"{root}/.zmetadata", json.dumps(payload).encode(), f"{root}/.current/parts")


def array_state(fs, root: str, array: str) -> dict:
    """Description, attributes and chunk files (whole paths, by place) of an array, by its version or as laid out plainly."""
    state = read_current(fs, root, array)
    if state is not None:
        folder = _version_folder(root, array, state["version"])
        return {**state, "chunks": {place: f"{folder}/{name}" for place, name in state["chunks"].items()}}
    documents = []
    for part in (".zarray", ".zattrs"):
        with fs.open_input_stream(f"{root}/{array}/{part}") as stream:
            documents.append(json.loads(stream.read()))
    # Anything that is not named like a chunk is none.
    places = [n for n in _listed(fs, f"{root}/{array}") if len(p := n.split(".")) == 2 and all(x.isdigit() for x in p)]
    return {"info": documents[0], "attributes": documents[1], "chunks": {n: f"{root}/{array}/{n}" for n in places}}


def store_attributes(store: str, array_name: str, opener: str | None = None) -> tuple[dict, dict]:
    """Array description and attributes of one array of a store."""
    fs, root = open_store(store if opener else qualify(SparkSession.active(), store).rstrip("/"), opener)
    state = array_state(fs, root, array_name)
    return state["info"], state["attributes"]


def read_chunk_store(spark: SparkSession, store: str, array_name: str, opener: str | None = None) -> DataFrame:
    """Cells of one array of a chunk store: cell, value. Chunks are read and decoded in parallel."""
    uri = store if opener else qualify(spark, store).rstrip("/")
    fs, root = open_store(uri, opener)
    state = array_state(fs, root, array_name)
    (height, width), (chunk, _) = state["info"]["shape"], state["info"]["chunks"]
    attributes = state["attributes"]
    meta = GridMeta(width, height, tuple(attributes["geotransform"][:6]), attributes["crs"], attributes["nodata"])
    places = [(int(r) * chunk, int(c) * chunk, path) for place, path in state["chunks"].items() for r, c in [place.split(".")]]
    names = spark.createDataFrame(places, "row_off bigint, col_off bigint, path string")
    names = names.repartition(max(min(len(places), 4 * spark.sparkContext.defaultParallelism), 1))
    ship_package(spark)

    def load(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        source, _ = open_store(uri, opener)
        for batch in batches:
            for row in batch.itertuples(index=False):
                with source.open_input_stream(row.path) as stream:
                    yield pd.DataFrame({"row_off": [row.row_off], "col_off": [row.col_off], "n_rows": [chunk], "n_cols": [chunk],
                                        "data": [stream.read()]})

    tiles = names.mapInPandas(load, "row_off bigint, col_off bigint, n_rows int, n_cols int, data binary")
    return tiles_to_cells(tiles, meta, float(attributes["nodata"]))
