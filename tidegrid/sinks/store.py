"""A folder of named Parquet tables with create-or-replace and optimistic commits.

Several steps replace a table they read. Spark refuses to overwrite a path it is reading,
so every write goes to a folder of its own, and a table is what its newest commit names. A commit
is one small file with the next number, moved into place by a rename that refuses to replace:
of two writers that take the same number one gets it, the other sees that and tries again on top
of it. That holds where the file system renames in one step, as HDFS does; a local disk looks first
and moves then. A write that was cut short, or that failed its checks, has no commit and is never seen.
"""

from __future__ import annotations

import json
import uuid

from py4j.protocol import Py4JJavaError
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidegrid.operators.quality import expect, observed_count
from tidegrid.sources.filesystem import _resolve

COMMITS = "_commits"


class CommitConflict(RuntimeError):
    """Another writer has taken the version."""


class TableStore:
    """Named tables under one root folder on the shared file system.

    A bucketed table is a table of the session's catalog as well, which is where Spark keeps
    buckets and order. Its commit names it; a session whose catalog does not know it (without a
    metastore, any later application) reads the same files and shuffles them like any other.
    """

    def __init__(self, spark: SparkSession, root: str) -> None:
        self.spark = spark
        self.root = root.rstrip("/")

    # --- commits ------------------------------------------------------------------------

    def _commit_path(self, name: str, version: int) -> str:
        return f"{self.root}/{name}/{COMMITS}/{version:08d}.json"

    def _versions(self, name: str) -> list[int]:
        """Committed versions of a table, oldest first."""
        fs, folder = _resolve(self.spark, f"{self.root}/{name}/{COMMITS}")
        if not fs.exists(folder):
            return []
        labels = [status.getPath().getName() for status in fs.listStatus(folder)]
        return sorted(int(x[:-5]) for x in labels if x.endswith(".json") and x[:-5].isdigit())

    def latest(self, name: str) -> int:
        """Newest version of a table, 0 for one that does not exist."""
        return max(self._versions(name), default=0)

    def _record(self, name: str, version: int) -> dict:
        fs, path = _resolve(self.spark, self._commit_path(name, version))
        stream = fs.open(path)
        try:
            return json.loads(bytes(stream.readAllBytes()).decode())
        finally:
            stream.close()

    def _newest(self, name: str) -> dict:
        version = self.latest(name)
        if not version:
            raise LookupError(f"no table {name} in {self.root}")
        return self._record(name, version)

    def commit(self, name: str, record: dict, after: int) -> int:
        """Make ``record`` the version that follows ``after``; :class:`CommitConflict` if that is taken."""
        jvm = self.spark.sparkContext._jvm
        fs, draft = _resolve(self.spark, f"{self.root}/{name}/{COMMITS}/draft-{uuid.uuid4().hex}")
        _, target = _resolve(self.spark, self._commit_path(name, after + 1))
        stream = fs.create(draft, False)
        try:
            stream.write(bytearray(json.dumps(record).encode()))
        finally:
            stream.close()
        context = jvm.org.apache.hadoop.fs.FileContext.getFileContext(
            fs.makeQualified(draft).toUri(), self.spark.sparkContext._jsc.hadoopConfiguration())
        options = self.spark.sparkContext._gateway.new_array(jvm.org.apache.hadoop.fs.Options.Rename, 1)
        options[0] = jvm.org.apache.hadoop.fs.Options.Rename.valueOf("NONE")
        try:
            context.rename(draft, target, options)
        except Py4JJavaError as error:
            fs.delete(draft, False)
            if "FileAlreadyExistsException" in error.java_exception.getClass().getName():
                raise CommitConflict(f"{name}: version {after + 1} is taken") from error
            raise
        return after + 1

    def _replace(self, name: str, record: dict) -> None:
        """Commit on top of whatever is newest: a whole replacement does not depend on what it replaces."""
        while True:
            try:
                self.commit(name, record, self.latest(name))
                return
            except CommitConflict:
                continue

    def _discard(self, record: dict) -> None:
        if record.get("table"):
            self.spark.sql(f"DROP TABLE IF EXISTS `{record['table']}`")
        fs, folder = _resolve(self.spark, record["path"])
        fs.delete(folder, True)

    def vacuum(self, name: str, keep: int = 1) -> None:
        """Delete all but the newest versions. Only the caller knows that no job reads them any more."""
        for version in self._versions(name)[:-keep]:
            record = self._record(name, version)
            fs, commit = _resolve(self.spark, self._commit_path(name, version))
            fs.delete(commit, False)
            self._discard(record)

    # --- tables -------------------------------------------------------------------------

    def exists(self, name: str) -> bool:
        return bool(self._versions(name))

    def path(self, name: str) -> str:
        return self._newest(name)["path"]

    def read(self, name: str) -> DataFrame:
        record = self._newest(name)
        if record.get("table") and self.spark.catalog.tableExists(record["table"]):
            return self.spark.table(record["table"])
        return self.spark.read.parquet(record["path"])

    def _write_new(self, df: DataFrame, name: str) -> dict:
        record = {"path": f"{self.root}/{name}/{uuid.uuid4().hex}"}
        df.write.parquet(record["path"])
        return record

    def write(self, df: DataFrame, name: str, columns: list[str] | None = None, rows: int | None = None) -> DataFrame:
        """Create or replace a table and return it as stored; ``vacuum`` drops older versions.

        With ``columns`` or ``rows``, the table is checked by :func:`expect` while it is written and
        committed only if it holds what it must.
        """
        if columns is None and rows is None:
            record = self._write_new(df, name)
        else:
            checked, verdict = expect(df, columns, rows)
            record = self._write_new(checked, name)
            try:
                verdict.verify()
            except ValueError:
                self._discard(record)
                raise
        self._replace(name, record)
        return self.spark.read.schema(df.schema).parquet(record["path"])

    def write_bucketed(
        self, df: DataFrame, name: str, keys: list[str], buckets: int, order: list[str] | None = None
    ) -> DataFrame:
        """Create or replace a table bucketed by keys and sorted by keys and ``order``.

        There is one file per bucket, so joins and aggregations on the keys need no shuffle
        of this table, and those that follow its order need no sort or hash table either.
        """
        by = [*keys, *(order or [])]
        label = uuid.uuid4().hex
        record = {"path": f"{self.root}/{name}/{label}", "table": f"{name}_{label}", "buckets": buckets, "sorted_by": by}
        writer = df.repartition(buckets, *keys).write.format("parquet").option("path", record["path"])
        writer.bucketBy(buckets, *keys).sortBy(*by).saveAsTable(record["table"])
        self._replace(name, record)
        return self.spark.table(record["table"])

    def bytes_per_bucket(self, name: str) -> float:
        """Stored bytes of a bucketed table over its number of buckets."""
        record = self._newest(name)
        fs, folder = _resolve(self.spark, record["path"])
        return fs.getContentSummary(folder).getLength() / record["buckets"]

    def upsert(self, rows: DataFrame, name: str, key: str) -> DataFrame:
        """Add rows to a small table, replacing rows with the same key.

        Built on the version it read: if another writer commits meanwhile, it is built again on that.
        """
        while True:
            base = self.latest(name)
            merged = rows
            if base:
                kept = self.spark.read.parquet(self._record(name, base)["path"]).join(rows.select(key), key, "left_anti")
                merged = kept.select(*rows.columns).unionByName(rows)
            record = self._write_new(merged, name)
            try:
                self.commit(name, record, base)
            except CommitConflict:
                self._discard(record)
                continue
            return self.spark.read.schema(merged.schema).parquet(record["path"])

    def record_crs(self, table: str, crs: str) -> DataFrame:
        """Record the coordinate system of a table, one row per table name."""
        row = self.spark.createDataFrame([(table, crs)], "table_name string, crs string")
        return self.upsert(row, "metadata", "table_name")


def write_table(df: DataFrame, root: str, name: str) -> DataFrame:
    """Create or replace one table of a store; safe for a table derived from itself."""
    return TableStore(df.sparkSession, root).write(df, name)


def materialize_result(df: DataFrame, path: str) -> int:
    """Write a result as Parquet and return its row count, taken while writing."""
    counted, seen = observed_count(df, "materialized")
    counted.write.mode("overwrite").parquet(path)
    return seen.get["rows"]


def export_node_ids(df: DataFrame, path: str, filter_value: int = 0, order: str = "pos") -> None:
    """Ids of nodes whose mask differs from a value, as text in input order.

    Readers use line positions, so the rows are range-sorted into ordered part files.
    """
    kept = df.where(F.col("Mask") != filter_value).orderBy(order)
    kept.select(F.col("Node").cast("long").cast("string").alias("value")).write.mode("overwrite").text(path)


def export_land_mask(df: DataFrame, path: str, order: str = "pos") -> None:
    """Land mask of every node as int32, in node order."""
    df.select(F.col(order), F.col("Mask").cast("int").alias("Mask")).orderBy(order).write.mode(
        "overwrite"
    ).parquet(path)


def export_mesh(nodes: DataFrame, elements: DataFrame, nodes_path: str, elements_path: str) -> list[str]:
    """Node and element tables as Parquet; an empty table is skipped. Returns paths written.

    Each table is computed once: its rows are counted while they are written.
    """
    written = []
    for df, path in ((elements, elements_path), (nodes, nodes_path)):
        if not path:
            continue
        counted, seen = observed_count(df, "exported")
        counted.write.mode("overwrite").parquet(path)
        if seen.get["rows"]:
            written.append(path)
        else:
            fs, folder = _resolve(df.sparkSession, path)
            fs.delete(folder, True)
    return written
