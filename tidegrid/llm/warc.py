"""WARC archives: records written and read by Spark, and a merged index of capture histories.

Writing: a record is one string, built by column functions, and the text sink writes it with the
blank lines that end a record as its line separator. So any file system will do, files are
gzipped, and a lost executor leaves no half file. Equal payloads are found by digest: the smallest
page id is a response, the others revisit it.

Reading: the text source splits at the version line that begins a record and streams; a payload
that contains that line itself is put together again by Content-Length. Payload digests and
lengths of responses are taken from the payload read. Each reader emits its index entries as sorted
runs of bounded length.

Merging: the runs are cut by key ranges, and each range is merged by a loser tree over its pieces of
runs. Range and row number give the global order by URL key and time.

Defined results: null html is an empty payload; a null URL has an empty key; rows of null page id
revisit a response that has an id, else they are responses; rows that repeat the response's id are
responses too; an empty table gives an empty result; further columns are ignored.
"""

from __future__ import annotations

import base64
import hashlib
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tidegrid.llm.common import shared_folder, store, text_of
from tidegrid.session import ship_package

# Fixed values of the format.
VERSION = "WARC/1.1\r\n"
RECORD_END = "\r\n\r\n"
PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"
BASE32 = "ABCDEFGHIJKLMNOPQRSTUVWXYZ234567"

#: Index entries per sorted run, per merged range, and records per file at most.
RUN_ROWS, RANGE_ROWS, FILE_RECORDS = 20_000, 100_000, 10_000


def sha1_base32(payload: Column) -> Column:
    """Upper-case base32 of the SHA-1: five hexadecimal digits make four symbols."""
    digest = F.sha1(payload)
    parts = []
    for k in range(0, 40, 5):
        number = F.conv(F.substring(digest, k + 1, 5), 16, 10).cast("int")
        parts += [F.substring(F.lit(BASE32), F.shiftright(number, s).bitwiseAND(31) + 1, F.lit(1)) for s in (15, 10, 5, 0)]
    return F.concat(*parts)


def url_key(url: Column) -> Column:
    """Sort key of a URL: host labels from the top down, then path and query; fragment, port and www dropped."""
    host = F.regexp_replace(F.lower(F.regexp_extract(url, r"^[A-Za-z][A-Za-z0-9+.-]*://(?:[^/?#@]*@)?([^/:?#]*)", 1)), r"^www\d*\.", "")
    rest = F.regexp_extract(url, r"^[A-Za-z][A-Za-z0-9+.-]*://[^/?#]*([^#]*)", 1)
    key = F.concat(F.array_join(F.reverse(F.split(host, r"\.")), ","), F.lit(")"), rest)
    return F.coalesce(F.when(host == "", url).otherwise(key), F.lit(""))


def _header(name: str, value: Column) -> Column:
    """A header line; line breaks inside the value are percent-encoded, a null value has no line."""
    safe = F.replace(F.replace(value, F.lit("\r"), F.lit("%0D")), F.lit("\n"), F.lit("%0A"))
    return F.coalesce(F.concat(F.lit(f"{name}: "), safe, F.lit("\r\n")), F.lit(""))


def _urn(*parts: Column) -> Column:
    h = F.md5(F.concat_ws("|", *parts).cast("binary"))
    cut = [F.substring(h, a, n) for a, n in ((1, 8), (9, 4), (13, 4), (17, 4), (21, 12))]
    return F.concat(F.lit("<urn:uuid:"), F.concat_ws("-", *cut), F.lit(">"))


def write_archives(pages: DataFrame, folder: str, least_bytes: int = 0, id_col: str = "page_id", url_col: str = "url",
                   html_col: str = "html", time_col: str | None = None) -> None:
    """WARC files of all rows under ``folder``.

    Payloads under ``least_bytes`` are never revisits. Without ``time_col`` a capture has the time
    2024-01-01 plus its id in seconds (modulo a year), so that histories have an order.
    """
    clock = (F.col(time_col).cast("timestamp") if time_col else
             F.timestamp_seconds(F.lit(1704067200) + F.pmod(F.coalesce(F.col(id_col).cast("long"), F.lit(0)), F.lit(31536000))))
    rows = pages.select(F.col(id_col).alias("id"), F.col(url_col).cast("string").alias("url"), text_of(html_col).alias("html"),
                        F.date_format(clock, "yyyy-MM-dd'T'HH:mm:ss'Z'").alias("time"))
    digest = sha1_base32(F.col("html").cast("binary"))
    size = F.octet_length("html")
    responses = store(rows.select("id", digest.alias("digest"), size.alias("size")).filter(F.col("size") >= least_bytes)
                      .groupBy("digest").agg(F.min("id").alias("response_id"), F.count("*").alias("n"))
                      .filter("n > 1").select("digest", "response_id"))
    typed = rows.withColumns({"digest": digest, "size": size}).join(responses, "digest", "left")
    revisits = F.col("response_id").isNotNull() & ~F.col("id").eqNullSafe(F.col("response_id")) & (F.col("size") >= least_bytes)
    typed = typed.withColumn("revisit", revisits)
    http = F.concat(F.lit("HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: "),
                    F.col("size").cast("string"), F.lit("\r\n\r\n"))
    block = F.when(F.col("revisit"), http).otherwise(F.concat(http, F.col("html")))
    identity = F.col("id").cast("string")
    record = F.concat(
        F.lit(VERSION), _header("WARC-Type", F.when(F.col("revisit"), "revisit").otherwise("response")),
        _header("WARC-Record-ID", _urn(F.coalesce(identity, F.lit("")), F.coalesce("url", F.lit("")), F.col("digest"))),
        _header("WARC-Date", F.col("time")), _header("WARC-Target-URI", F.col("url")),
        _header("WARC-Payload-Digest", F.concat(F.lit("sha1:"), F.col("digest"))),
        _header("WARC-Profile", F.when(F.col("revisit"), F.lit(PROFILE))),
        _header("X-Page-ID", identity), _header("X-Refers-To-Page-ID", F.when(F.col("revisit"), F.col("response_id").cast("string"))),
        _header("X-URL-Key", url_key(F.col("url"))),
        _header("Content-Type", F.lit("application/http; msgtype=response")),
        _header("Content-Length", F.octet_length(block).cast("string")), F.lit("\r\n"), block)
    (typed.select(record.alias("value")).write.option("lineSep", RECORD_END).option("compression", "gzip")
     .option("maxRecordsPerFile", FILE_RECORDS).text(folder))


def _records(chunks: Iterator[bytes]) -> Iterator[tuple[dict[str, str], bytes]]:
    """(headers, block) of each record, from what lies between version lines."""
    version = VERSION.encode()
    held: bytes | None = None
    for chunk in chunks:
        held = chunk if held is None else held + version + chunk
        head, sep, body = held.partition(b"\r\n\r\n")
        if not sep:
            held = held or None  # nothing stands before the first record
            continue
        headers = dict(line.split(": ", 1) for line in head.decode("utf-8", "replace").split("\r\n"))
        length = int(headers["Content-Length"])
        if len(body) < length:
            continue
        yield headers, body[:length]
        held = None


_ENTRY = pa.schema([("run", pa.string()), ("seq", pa.int64()), ("url_key", pa.string()), ("time", pa.string()),
                    ("page", pa.string()), ("payload_bytes", pa.int64()), ("payload_digest", pa.string()),
                    ("record_type", pa.string()), ("refers", pa.string())])
_ENTRY_SQL = ("run string, seq long, url_key string, time string, page string, payload_bytes long, payload_digest string, "
              "record_type string, refers string")


def read_runs(spark: SparkSession, folder: str) -> DataFrame:
    """Index entries of the archives as sorted runs ``(run, seq, url_key, time, page, ...)``."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        names: list[str] = []

        def chunks() -> Iterator[bytes]:
            for b in batches:
                for name, value in zip(b["file"].to_pylist(), b["value"].to_pylist()):
                    if not names or names[-1] != name:
                        names[:] = [name]
                    yield value

        entries, number = [], 0

        def flush() -> pa.RecordBatch:
            entries.sort(key=lambda e: e[:3])
            rows = [(f"{names[0]}#{number}", k, e[0], e[1], e[3], *e[4:]) for k, e in enumerate(entries)]
            return pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*rows), _ENTRY)], schema=_ENTRY)

        for headers, block in _records(chunks()):
            head, _, payload = block.partition(b"\r\n\r\n")
            revisit = headers["WARC-Type"] == "revisit"
            if revisit:
                size = int(head.rpartition(b"Content-Length: ")[2])
                digest = headers["WARC-Payload-Digest"].removeprefix("sha1:")
            else:
                size, digest = len(payload), base64.b32encode(hashlib.sha1(payload).digest()).decode()
            page = headers.get("X-Page-ID")
            entries.append((headers.get("X-URL-Key", ""), headers["WARC-Date"], _order(page), page, size, digest,
                            headers["WARC-Type"], headers.get("X-Refers-To-Page-ID")))
            if len(entries) == RUN_ROWS:
                yield flush()
                entries, number = [], number + 1
        if entries:
            yield flush()

    ship_package(spark)
    raw = spark.read.option("lineSep", VERSION).text(folder)
    return raw.select(F.input_file_name().alias("file"), F.col("value").cast("binary").alias("value")).mapInArrow(run, _ENTRY_SQL)


def _order(page: str | None) -> tuple:
    """Ids in numeric order where they are numbers, null first."""
    if page is None:
        return (0, 0, "")
    return (1, int(page), "") if page.lstrip("-").isdigit() else (2, 0, page)


class LoserTree:
    """Merges sorted lists: each inner node keeps the loser of its match, the overall winner is next.

    Taking the winner replays only its path to the root, one comparison per level.
    """

    def __init__(self, runs: list[list]) -> None:
        self.runs = [iter(r) for r in runs]
        self.k = max(len(runs), 1)
        self.heads = [next(r, None) for r in self.runs] or [None]
        self.losers = [-1] * self.k
        self.winner = self._build(1)

    def _beats(self, a: int, b: int) -> bool:
        x, y = self.heads[a], self.heads[b]
        return y is None or (x is not None and (x, a) <= (y, b))

    def _build(self, node: int) -> int:
        if node >= self.k:
            return node - self.k
        a, b = self._build(2 * node), self._build(2 * node + 1)
        first, second = (a, b) if self._beats(a, b) else (b, a)
        self.losers[node] = second
        return first

    def __iter__(self) -> Iterator:
        while self.heads[self.winner] is not None:
            at = self.winner
            yield self.heads[at]
            self.heads[at] = next(self.runs[at], None)
            node = (at + self.k) // 2
            while node >= 1:
                if self._beats(self.losers[node], at):
                    at, self.losers[node] = self.losers[node], at
                node //= 2
            self.winner = at


def merge_runs(runs: DataFrame) -> DataFrame:
    """All index entries in global order: ``range`` and ``row`` number them by URL key, time and page."""
    def merge(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        parts = [b for b in batches if b.num_rows]
        if not parts:
            return
        table = pa.Table.from_batches(parts).sort_by([("run", "ascending"), ("seq", "ascending")])
        slices: dict[str, list] = {}
        keys = zip(table["run"].to_pylist(), table["url_key"].to_pylist(), table["time"].to_pylist(), table["page"].to_pylist())
        for k, (name, url, time, page) in enumerate(keys):
            slices.setdefault(name, []).append((url, time, _order(page), k))
        order = [entry[3] for entry in LoserTree(list(slices.values()))]
        yield from table.take(pa.array(order)).append_column("row", pa.array(range(len(order)), pa.int64())).combine_chunks().to_batches()

    n = max(1, -(-runs.count() // RANGE_ROWS))
    # Every row has a place of its own in the range key, so that a hot URL can be cut as well.
    ranged = runs.repartitionByRange(n, "url_key", "time", "page", "run")
    return ranged.mapInArrow(merge, _ENTRY_SQL + ", row long").withColumn("range", F.spark_partition_id())


def capture_index(pages: DataFrame, folder: str | None = None, least_bytes: int = 0, **columns: str) -> DataFrame:
    """Write the archives of ``pages``, read them back, and return the merged index.

    ``(page_id, url_key, time, payload_bytes, payload_digest, record_type, refers_to, range, row)``
    """
    spark = pages.sparkSession
    folder = folder or f"{shared_folder(spark)}-warc"
    write_archives(pages, folder, least_bytes, **columns)
    kind = pages.schema[columns.get("id_col", "page_id")].dataType
    merged = merge_runs(store(read_runs(spark, folder)))
    return merged.select(F.col("page").cast(kind).alias("page_id"), "url_key", "time", "payload_bytes", "payload_digest",
                         "record_type", F.col("refers").cast(kind).alias("refers_to"), "range", "row")
