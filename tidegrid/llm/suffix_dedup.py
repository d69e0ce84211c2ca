"""Removal of repeated byte strings by suffix arrays over shards.

1. Shards are made by content. Every window of ``length`` bytes chooses an anchor gram by the bytes
   in it alone, so equal windows, wherever they stand, have the same anchor. The stretch of windows
   that share an anchor is a context. Anchors that occur once (almost all of a clean corpus) are
   dropped by a count; no text is moved for them.
2. Equal contexts are one context; if it occurs twice, all its windows are repeated.
3. Contexts that differ but share an anchor go to one shard. A suffix array (Larsson-Sadakane) and
   common prefixes (Kasai) over the shard tell which windows occur more than once.
4. The contexts of an anchor that has very many are dealt to several shards. The distinct windows of
   each, those it holds several times by one representative, are cut into key ranges by binary
   search in its sorted list. The lists of a range are put together once; what two shards hold
   is repeated, and each list is searched in that, again by binary search.
5. Touching ranges are joined per block of a text, and the covered bytes of each distinct text cut out.

Everything after the scan goes by a hash of the whole text, not by ``doc_id``.

Defined results: null counts as empty; repeated rows and ids are documents of their own (so their
texts repeat each other); texts shorter than a window keep all bytes; an empty table gives an
empty result; further columns are ignored.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tidegrid.llm.common import ids_and_texts, semi, store
from tidegrid.llm.suffix_arrays import PIECE, anchored, mix, prefix_sums, range_hash, repeated_windows
from tidegrid.session import ship_package

LENGTH = 200
#: Distinct contexts of one anchor that stay in one shard.
SHARD_CONTEXTS = 4096
#: Bytes of a text whose ranges are joined as one group.
JOIN_BYTES = 1 << 20
#: Bytes of contexts per task, and per suffix array within it.
TASK_BYTES, ARRAY_BYTES = 16 << 20, 1 << 20


def _key(sha: Column) -> Column:
    return F.unhex(F.substring(sha, 1, 32))


def _pieces(texts: list[bytes], length: int) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray]]:
    """(bytes, owner, offset) of some short texts together, or of a part of a long one.

    The parts of a long text share ``length - 1`` bytes: each window lies in exactly one.
    """
    data, owners, offsets, size = [], [], [], 0

    def joined():
        sizes = [len(d) for d in data]
        begin = np.concatenate([[0], np.cumsum(sizes)[:-1]])
        return (np.frombuffer(b"".join(data), np.uint8), np.repeat(owners, sizes),
                np.repeat(np.array(offsets) - begin, sizes))

    for k, text in enumerate(texts):
        if len(text) < length:
            continue
        step = PIECE - length + 1
        for lo in range(0, max(len(text) - length + 1, 1), step):
            part = text[lo:lo + PIECE]
            if size and size + len(part) > PIECE:
                yield joined()
                data, owners, offsets, size = [], [], [], 0
            data.append(part)
            owners.append(k)
            offsets.append(lo)
            size += len(part)
            if lo + PIECE < len(text):
                # The next part of this text must not join this one's bytes.
                yield joined()
                data, owners, offsets, size = [], [], [], 0
    if size:
        yield joined()


def _contexts(texts: DataFrame, length: int) -> DataFrame:
    """``(key, lo, hi, anchor, context)`` of every text."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for whole in batches:
            for at in range(0, whole.num_rows, 128):
                b = whole.slice(at, 128)
                for data, owner, offset in _pieces(b["text"].to_pylist(), length):
                    lo, hi, anchor, context = anchored(data, owner, length)
                    shift = offset[lo] if len(lo) else lo
                    yield pa.RecordBatch.from_pydict({
                        "key": b["key"].take(pa.array(owner[lo].astype(np.int64))), "lo": pa.array((lo + shift).astype(np.int64)),
                        "hi": pa.array((hi + shift).astype(np.int64)), "anchor": pa.array(anchor.view(np.int64)),
                        "context": pa.array(context.view(np.int64))})

    ship_package(texts.sparkSession)
    return texts.select("key", F.col("text").cast("binary").alias("text")).mapInArrow(
        run, "key binary, lo long, hi long, anchor long, context long")


def _bytes_of(texts: DataFrame, first: DataFrame, wanted: DataFrame) -> DataFrame:
    """``wanted(key, ...)`` with the text of each key, read from the one row ``first`` names."""
    rows = wanted.join(first, "key").withColumnRenamed("key", "wanted_key")
    found = texts.join(rows, texts["doc_id"].eqNullSafe(rows["first_id"]))
    return found.filter(_key(F.sha2(F.col("text").cast("binary"), 256)) == F.col("wanted_key")).drop("doc_id", "first_id")


def _shard_rows(texts: DataFrame, first: DataFrame, distinct: DataFrame) -> DataFrame:
    """``(anchor, salt, salts, context, body)`` of the contexts that are compared byte by byte."""
    per_anchor = distinct.groupBy("anchor").agg(F.count("*").alias("k")).filter("k > 1")
    salts = F.ceil(F.col("k") / SHARD_CONTEXTS).cast("int")
    rows = distinct.join(store(per_anchor.select("anchor", salts.alias("salts"))), "anchor")
    spans = store(rows.select("rep.key", F.struct("rep.lo", "rep.hi", "anchor", "context", "salts").alias("span")))
    per_text = spans.groupBy("key").agg(F.collect_list("span").alias("spans"))
    cut = _bytes_of(texts, first, per_text).select("spans", F.col("text").cast("binary").alias("text"))
    bodies = cut.select("text", F.explode("spans").alias("s")).select(
        "s.anchor", F.pmod(F.xxhash64("s.context"), F.col("s.salts")).cast("int").alias("salt"), "s.salts", "s.context",
        F.substring("text", F.col("s.lo").cast("int") + 1, (F.col("s.hi") - F.col("s.lo")).cast("int")).alias("body"))
    total = spans.agg(F.sum(F.expr("span.hi - span.lo")).alias("b")).first()["b"] or 0
    return bodies.repartition(max(1, -(-total // TASK_BYTES)), "anchor", "salt")


def _intervals(starts: np.ndarray, length: int) -> tuple[list[int], list[int]]:
    """Runs of consecutive window starts as covered ranges."""
    cut = np.flatnonzero(np.diff(starts) != 1) + 1
    return starts[np.concatenate([[0], cut])].tolist(), (starts[np.concatenate([cut - 1, [len(starts) - 1]])] + length).tolist()


_COVER = "anchor long, context long, starts array<long>, stops array<long>"
_SHARD = f"{_COVER}, range int, salt int, windows array<long>, contexts array<long>, offsets array<int>"


def _search_shards(rows: DataFrame, length: int) -> DataFrame:
    """Covered ranges per context and, of split anchors, the distinct windows of a shard, by key range.

    The offset of a window that the shard holds several times is -1: all its places are covered.
    """
    def arrays(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.Table]:
        """Whole shards, of about ARRAY_BYTES together. A task's shards are a bounded amount."""
        whole = pa.Table.from_batches(list(batches), batches_schema)
        if not whole.num_rows:
            return
        whole = whole.sort_by([("anchor", "ascending"), ("salt", "ascending"), ("context", "ascending")])
        anchor, salt, context = (whole[c].to_numpy() for c in ("anchor", "salt", "context"))
        keep = np.concatenate([[True], (np.diff(anchor) != 0) | (np.diff(context) != 0)])
        whole, anchor, salt = whole.filter(pa.array(keep)), anchor[keep], salt[keep]
        ends = np.concatenate([np.flatnonzero((np.diff(anchor) != 0) | (np.diff(salt) != 0)) + 1, [len(anchor)]])
        size = np.cumsum([len(x) for x in whole["body"].to_pylist()])
        lo = 0
        while lo < len(anchor):
            before = size[lo - 1] if lo else 0
            fits = ends[(ends > lo) & (size[ends - 1] - before <= ARRAY_BYTES)]
            hi = fits[-1] if len(fits) else ends[ends > lo][0]
            yield whole.slice(lo, hi - lo)
            lo = hi

    batches_schema = pa.schema([("anchor", pa.int64()), ("salt", pa.int32()), ("salts", pa.int32()),
                                ("context", pa.int64()), ("body", pa.binary())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in arrays(batches):
            bodies = part["body"].to_pylist()
            anchor, salt, salts, context = (part[c].to_numpy() for c in ("anchor", "salt", "salts", "context"))
            hi = np.cumsum([len(x) for x in bodies])
            lo = np.concatenate([[0], hi[:-1]])
            data = np.frombuffer(b"".join(bodies), np.uint8)
            repeated, group = repeated_windows(data, lo, hi, length)
            out = {name: [] for name in ("anchor", "context", "starts", "stops", "range", "salt", "windows", "contexts", "offsets")}

            def add(**values):
                for name, column in out.items():
                    column.append(values.get(name))

            for k in range(len(bodies)):
                found = np.flatnonzero(repeated[lo[k]:hi[k]])
                if len(found):
                    starts, stops = _intervals(found, length)
                    add(anchor=anchor[k], context=context[k], starts=starts, stops=stops)
            for a, s in sorted({(a, s) for a, s, n in zip(anchor, salt, salts) if n > 1}):
                mine = np.flatnonzero((anchor == a) & (salt == s))
                at = np.concatenate([np.arange(lo[k], hi[k]) for k in mine])
                of = np.repeat(mine, hi[mine] - lo[mine])
                at, of = at[group[at] >= 0], of[group[at] >= 0]
                _, once = np.unique(group[at], return_index=True)
                at, of = at[once], of[once]
                keys = _window_keys(data, at, length)
                order = np.argsort(keys)
                keys, at, of = keys[order], at[order], of[order]
                n = int(salts[mine[0]])
                bounds = np.array([(k << 64) // n - (1 << 63) for k in range(1, n)], np.int64)
                cuts = np.concatenate([[0], np.searchsorted(keys, bounds), [len(keys)]])
                for r in range(n):
                    piece = slice(cuts[r], cuts[r + 1])
                    if cuts[r + 1] > cuts[r]:
                        add(anchor=a, range=r, salt=s, windows=keys[piece], contexts=context[of[piece]],
                            offsets=np.where(repeated[at[piece]], -1, at[piece] - lo[of[piece]]).astype(np.int32))
            if out["anchor"]:
                yield pa.RecordBatch.from_pydict(
                    {name: pa.array(column, kind) for (name, column), kind in zip(out.items(), [
                        pa.int64(), pa.int64(), pa.list_(pa.int64()), pa.list_(pa.int64()), pa.int32(), pa.int32(),
                        pa.list_(pa.int64()), pa.list_(pa.int64()), pa.list_(pa.int32())])})

    return rows.mapInArrow(run, _SHARD)


def _window_keys(data: np.ndarray, at: np.ndarray, length: int) -> np.ndarray:
    """64-bit keys of the windows at ``at``, taken piece by piece."""
    keys = np.empty(len(at), np.uint64)
    step = PIECE - length
    for lo in range(0, len(data), step):
        inside = (at >= lo) & (at < lo + step)
        if inside.any():
            sums = prefix_sums(data[lo:lo + PIECE])
            keys[inside] = mix(range_hash(sums, at[inside] - lo, at[inside] - lo + length))
    return keys.view(np.int64)


def held_by_several(lists: list[np.ndarray]) -> list[np.ndarray]:
    """For each sorted list of distinct windows, which of them are in another list too.

    The lists are put together once; what stands there twice is kept, and each list is searched in that.
    """
    every = np.sort(np.concatenate(lists))
    several = np.unique(every[1:][every[1:] == every[:-1]])
    if not len(several):
        return [np.zeros(len(x), bool) for x in lists]
    return [several[np.minimum(np.searchsorted(several, x), len(several) - 1)] == x for x in lists]


def _merge_shards(slices: DataFrame, length: int) -> DataFrame:
    """Covered ranges of the windows that several shards of an anchor hold, one key range at a time.

    There are as many ranges as shards, so what comes together is about what one shard holds.
    """
    def run(group):
        found: dict[int, set[int]] = {}
        shared = held_by_several([np.asarray(w) for w in group["windows"]])
        for mine, contexts, offsets in zip(shared, group["contexts"], group["offsets"]):
            offsets = np.asarray(offsets)
            mine = mine & (offsets >= 0)
            for c, o in zip(np.asarray(contexts)[mine].tolist(), offsets[mine].tolist()):
                found.setdefault(c, set()).add(o)
        import pandas as pd

        rows = [(group["anchor"].iloc[0], c, *_intervals(np.array(sorted(o)), length)) for c, o in found.items()]
        return pd.DataFrame(rows, columns=["anchor", "context", "starts", "stops"])

    return slices.groupBy("anchor", "range").applyInPandas(run, _COVER)


def _joined_ranges(removed: DataFrame, block: int) -> DataFrame:
    """``(key, ranges)`` per text from ``(key, lo, hi)``, with touching ranges of a block of bytes joined.

    What is left of a block are ranges with gaps between them, each a window long at least.
    A text of one repeated byte has a range per byte before, and one per block behind.
    """
    placed = removed.withColumn("block", F.floor(F.col("lo") / block))
    along = Window.partitionBy("key", "block").orderBy("lo", "hi")
    before = F.max("hi").over(along.rowsBetween(Window.unboundedPreceding, -1))
    opened = placed.withColumn("opens", F.when(F.col("lo") <= before, 0).otherwise(1))
    numbered = opened.withColumn("island", F.sum("opens").over(along.rowsBetween(Window.unboundedPreceding, 0)))
    islands = numbered.groupBy("key", "block", "island").agg(F.min("lo").alias("lo"), F.max("hi").alias("hi"))
    return islands.groupBy("key").agg(F.collect_list(F.struct("lo", "hi")).alias("ranges"))


def _cut(pairs: Iterator[tuple[int, int]], text: bytes) -> tuple[bytes, int]:
    """What is left of a text without the union of some ranges, and the number of maximal ranges."""
    kept, upto, runs = [], 0, 0
    for lo, hi in sorted(pairs):
        if lo > upto or not runs:
            kept.append(text[upto:lo])
            runs += 1
        upto = max(upto, hi)
    return b"".join([*kept, text[upto:]]), runs


def remove_repeats(docs: DataFrame, length: int = LENGTH, id_col: str = "doc_id", text_col: str = "text",
                   with_bytes: bool = False) -> DataFrame:
    """``(doc_id, n_bytes, n_removed, n_spans, kept_sha256)`` for every row of ``docs``.

    ``with_bytes`` adds ``kept``, the remaining bytes.
    """
    texts = ids_and_texts(docs, id_col, text_col)
    sha = F.sha2(F.col("text").cast("binary"), 256)
    hashed = texts.select("doc_id", "text", sha.alias("sha"))
    rows = store(hashed.select("doc_id", "sha", F.octet_length("text").cast("long").alias("n_bytes")))
    rows = rows.withColumn("key", _key(F.col("sha")))
    first = store(rows.groupBy("key").agg(F.min("doc_id").alias("first_id")))

    everything = store(_contexts(hashed.select(_key(F.col("sha")).alias("key"), "text"), length))
    counts = store(everything.groupBy("anchor").agg(F.count("*").alias("n")).filter("n > 1").select("anchor"))
    candidates = store(semi(everything, counts, "anchor"))
    distinct = store(candidates.groupBy("anchor", "context").agg(
        F.count("*").alias("n"), F.min(F.struct("key", "lo", "hi")).alias("rep")))

    searched = store(_search_shards(_shard_rows(texts, first, distinct), length))
    merged = _merge_shards(searched.filter("range is not null"), length)
    covers = searched.filter("range is null").select("anchor", "context", "starts", "stops").unionByName(merged)
    whole = distinct.filter("n > 1").select(
        "anchor", "context", F.array(F.lit(0).cast("long")).alias("starts"), F.array(F.expr("rep.hi - rep.lo")).alias("stops"))
    ranges = store(covers.unionByName(whole).select(
        "anchor", "context", F.explode(F.arrays_zip("starts", "stops")).alias("r")).select("anchor", "context", "r.starts", "r.stops"))
    places = candidates.select("key", "lo", "anchor", "context").distinct()
    removed = places.join(ranges, ["anchor", "context"]).select(
        "key", (F.col("lo") + F.col("starts")).alias("lo"), (F.col("lo") + F.col("stops")).alias("hi"))
    per_text = store(_joined_ranges(removed, JOIN_BYTES))

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            left = [_cut(((r["lo"], r["hi"]) for r in ranges), text)
                    for text, ranges in zip(b["text"].to_pylist(), b["ranges"].to_pylist())]
            columns = {"key": b["wanted_key"], "n_kept": pa.array([len(k) for k, _ in left], pa.int64()),
                       "n_spans": pa.array([n for _, n in left], pa.int64()),
                       "kept_sha256": pa.array([hashlib.sha256(k).hexdigest() for k, _ in left])}
            if with_bytes:
                columns["kept"] = pa.array([k for k, _ in left], pa.binary())
            yield pa.RecordBatch.from_pydict(columns)

    source = _bytes_of(texts, first, per_text).select("wanted_key", "ranges", F.col("text").cast("binary").alias("text"))
    schema = "key binary, n_kept long, n_spans long, kept_sha256 string" + (", kept binary" if with_bytes else "")
    changed = store(source.mapInArrow(cut, schema).dropDuplicates(["key"]))
    out = rows.join(changed, "key", "left").select(
        "doc_id", "n_bytes", (F.col("n_bytes") - F.coalesce("n_kept", "n_bytes")).alias("n_removed"),
        F.coalesce("n_spans", F.lit(0)).cast("long").alias("n_spans"), F.coalesce("kept_sha256", "sha").alias("kept_sha256"),
        *(["kept"] if with_bytes else []))
    if not with_bytes:
        return out
    plain = texts.select("doc_id", F.col("text").cast("binary").alias("whole")).distinct()
    same = (out["doc_id"].eqNullSafe(plain["doc_id"])) & (F.sha2("whole", 256) == out["kept_sha256"])
    return out.join(plain, same, "left").select(*[out[c] for c in out.columns[:-1]], F.coalesce("kept", "whole").alias("kept"))
