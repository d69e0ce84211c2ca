"""Near-duplicates by b-bit MinHash.

1. Every text becomes the set of its word shingles (64-bit hashes), ``K`` minima of it, ``BANDS``
   band keys of ``ROWS`` minima each, and a packed signature of the ``BITS`` low bits of every minimum.
2. Texts with equal sets become one node.
3. Nodes that share a band key are candidates. Each node is first paired with one leader of its
   bands only (a star): the node with most neighbours, which in a group of copies is the text they
   were made from. Links that hold make components.
4. Then the bands that still hold several components are searched for links between these: the
   nodes outside the leader's component against all of another component. So copies of a group
   are never paired with each other, and no link between components is missed.
5. Before a pair is passed on, two bit counts judge it. The similarity is estimated from the
   signatures: equal low bits, less those that agree by chance, must reach the threshold less
   ``SIGMAS`` deviations. And each bit in which the parity sketches differ (``PARITY`` bits, each the
   parity of the shingles that fall on it) stands for a shingle that one set has and the other lacks,
   which bounds the similarity from above. The rest is confirmed on the whole sets.

A pair at the threshold of 0.8 shares no band with probability (1 - 0.8**5)**38 = 3e-7.

Defined results: white space and case as in the contract of the query; null, empty and wordless
texts have no shingle and link with nothing; rows are nodes by their sets, so repeated rows and
ids are no special case; a component whose ids are all null has a null id; an empty table gives an
empty result; further columns are ignored or kept.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidegrid.llm.common import anti, ids_and_texts, semi, store
from tidegrid.llm.graph import components, roots
from tidegrid.session import ship_package

BANDS, ROWS = 38, 5
K = BANDS * ROWS
BITS = 4
WORDS = -(-K // 64)
SIGMAS = 5
SIGNATURE = [f"s{i}" for i in range(BITS * WORDS)]
#: Bits of the parity sketch.
PARITY = 1024
SKETCH = [f"p{i}" for i in range(PARITY // 64)]

_CACHE = 400_000
_CHUNK = 1 << 15


class _Hashes(dict):
    def __missing__(self, word: bytes) -> int:
        h = xxhash.xxh3_64_intdigest(word)
        if len(self) > _CACHE:
            self.clear()
        self[word] = h
        return h


def _mix(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def shingle_set(text: bytes, size: int, hashes: dict[bytes, int]) -> np.ndarray:
    """Sorted distinct hashes of the shingles of a text; the whole text where it has fewer words."""
    words = text.lower().split()
    if not words:
        return np.zeros(0, np.uint64)
    h = np.fromiter(map(hashes.__getitem__, words), np.uint64, len(words))
    n = min(size, len(words))
    out = np.full(len(words) - n + 1, n, np.uint64)
    for k in range(n):
        out = _mix(out * np.uint64(0x9E3779B97F4A7C15) + h[k:len(h) - n + 1 + k])
    return np.unique(out)


def node_key(shingles: np.ndarray) -> bytes:
    """128 bits that stand for a set."""
    return (np.array([_mix(shingles).sum(), _mix(shingles ^ np.uint64(0xD6E8FEB86659FD93)).sum()], np.uint64)
            + np.uint64(len(shingles))).tobytes()


def _minima(sets: list[np.ndarray]) -> np.ndarray:
    """(K, sets) smallest value of each hash function over each set."""
    rng = np.random.default_rng(2)
    a = rng.integers(0, 1 << 32, K, np.uint32) | np.uint32(1)
    b = rng.integers(0, 1 << 32, K, np.uint32)
    out = np.empty((K, len(sets)), np.uint32)
    lo = 0
    while lo < len(sets):
        hi, total = lo, 0
        while hi < len(sets) and (total == 0 or total + len(sets[hi]) <= _CHUNK):
            total += len(sets[hi])
            hi += 1
        x = (np.concatenate(sets[lo:hi]) >> np.uint64(32)).astype(np.uint32)
        starts = np.cumsum([0, *(len(s) for s in sets[lo:hi - 1])])
        for k in range(K):
            out[k, lo:hi] = np.minimum.reduceat(x * a[k] + b[k], starts)
        lo = hi
    return out


def _band_keys(minima: np.ndarray) -> np.ndarray:
    """(sets, BANDS) key of each band, its number mixed in."""
    keys = np.empty((minima.shape[1], BANDS), np.uint64)
    for j in range(BANDS):
        h = np.full(minima.shape[1], j + 1, np.uint64)
        for m in minima[j * ROWS:(j + 1) * ROWS]:
            h = _mix(h * np.uint64(0x9E3779B97F4A7C15) + m)
        keys[:, j] = h
    return keys.view(np.int64)


def _signatures(minima: np.ndarray) -> np.ndarray:
    """(BITS * WORDS, sets): the low bits of the minima, one bit plane after the other."""
    out = np.empty((BITS * WORDS, minima.shape[1]), np.int64)
    padded = np.zeros((WORDS * 64, minima.shape[1]), np.uint8)
    for bit in range(BITS):
        padded[:K] = (minima >> np.uint32(bit)) & np.uint32(1)
        packed = np.packbits(padded, axis=0).reshape(WORDS, 8, -1)
        for w in range(WORDS):
            out[bit * WORDS + w] = np.ascontiguousarray(packed[w].T).view(np.int64).ravel()
    return out


def _parities(sets: list[np.ndarray]) -> np.ndarray:
    """(PARITY / 64, sets): whether an odd number of shingles falls on each bit."""
    owner = np.repeat(np.arange(len(sets)), [len(s) for s in sets])
    bit = np.concatenate([np.zeros(0, np.uint64), *sets]).view(np.int64) & (PARITY - 1)
    odd = (np.bincount(owner * PARITY + bit, minlength=len(sets) * PARITY) & 1).astype(np.uint8).reshape(len(sets), PARITY)
    return np.packbits(odd, axis=1).view(np.int64).T


def _sketches(docs: DataFrame, size: int) -> DataFrame:
    """``(doc_id, node, n, bands, s0...)`` of every row; node, bands and signature null without words."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        hashes = _Hashes()
        for whole in batches:
            for lo in range(0, whole.num_rows, 256):
                b = whole.slice(lo, 256)
                sets = [shingle_set(t, size, hashes) for t in b["text"].to_pylist()]
                some = [i for i, s in enumerate(sets) if len(s)]
                place = np.full(len(sets), -1)
                place[some] = np.arange(len(some))
                at = pa.array(place, mask=place < 0)
                minima = _minima([sets[i] for i in some]) if some else np.zeros((K, 0), np.uint32)
                keys = pa.FixedSizeListArray.from_arrays(pa.array(_band_keys(minima).ravel()), BANDS).cast(pa.list_(pa.int64()))
                columns = {"doc_id": b["doc_id"], "node": pa.array([node_key(s) if len(s) else None for s in sets], pa.binary()),
                           "n": pa.array([len(s) for s in sets], pa.int64()), "bands": keys.take(at)}
                planes = np.concatenate([_signatures(minima), _parities([sets[i] for i in some])])
                for name, plane in zip(SIGNATURE + SKETCH, planes):
                    columns[name] = pa.array(plane).take(at)
                yield pa.RecordBatch.from_pydict(columns)

    ship_package(docs.sparkSession)
    kind = docs.schema["doc_id"].dataType.simpleString()
    schema = f"doc_id {kind}, node binary, n long, bands array<long>, " + ", ".join(f"{s} long" for s in SIGNATURE + SKETCH)
    return docs.select("doc_id", F.col("text").cast("binary").alias("text")).mapInArrow(run, schema)


def _sets(docs: DataFrame, size: int) -> DataFrame:
    """``(node, shingles array<long>)``."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        hashes = _Hashes()
        for whole in batches:
            for lo in range(0, whole.num_rows, 256):
                sets = [shingle_set(t, size, hashes) for t in whole.slice(lo, 256)["text"].to_pylist()]
                yield pa.RecordBatch.from_pydict({
                    "node": pa.array([node_key(s) for s in sets], pa.binary()),
                    "shingles": pa.array([s.view(np.int64) for s in sets], pa.list_(pa.int64()))})

    return docs.select(F.col("text").cast("binary").alias("text")).mapInArrow(run, "node binary, shingles array<long>")


def _promising(percent: int) -> Column:
    """Whether sizes, parity sketches and signatures of sides ``l`` and ``r`` allow the similarity.

    A share ``p`` of equal low bits stands for a similarity of ``(p - c) / (1 - c)``, where
    ``c = 2**-BITS`` agree by chance. The bits that pad the last word are always equal.
    """
    similarity, chance = percent / 100, 2.0 ** -BITS
    p = chance + (1 - chance) * similarity
    least = K * (p - SIGMAS * (p * (1 - p) / K) ** 0.5) + (WORDS * 64 - K)
    equal = F.lit(0)
    for w in range(WORDS):
        differs = F.lit(0).cast("long")
        for bit in range(BITS):
            name = SIGNATURE[bit * WORDS + w]
            differs = differs.bitwiseOR(F.col(f"l.{name}").bitwiseXOR(F.col(f"r.{name}")))
        equal = equal + (64 - F.bit_count(differs))
    apart = F.lit(0)
    for name in SKETCH:
        apart = apart + F.bit_count(F.col(f"l.{name}").bitwiseXOR(F.col(f"r.{name}")))
    bounded = apart * (100 + percent) <= (F.col("l.n") + F.col("r.n")) * (100 - percent)
    sizes = (F.col("l.n") * 100 >= F.col("r.n") * percent) & (F.col("r.n") * 100 >= F.col("l.n") * percent)
    return sizes & bounded & (equal >= least)


def _confirmed(pairs: DataFrame, sets: DataFrame, percent: int) -> DataFrame:
    """The pairs ``(a, b)`` whose whole sets are as similar as asked."""
    left = sets.select(F.col("node").alias("a"), F.col("shingles").alias("of_a"))
    right = sets.select(F.col("node").alias("b"), F.col("shingles").alias("of_b"))
    both = pairs.join(left, "a").join(right, "b")
    common = F.size(F.array_intersect("of_a", "of_b"))
    total = F.size("of_a") + F.size("of_b") - common
    return both.filter(100 * common.cast("long") >= percent * total.cast("long")).select("a", "b")


def near_duplicates(docs: DataFrame, size: int = 5, percent: int = 80, id_col: str = "doc_id",
                    text_col: str = "text") -> DataFrame:
    """``(doc_id, n_shingles, component_id, kept)`` for every row of ``docs``.

    ``size`` words make a shingle; texts are linked at ``percent`` similarity or more; the component
    id is the smallest id that links lead to.
    """
    texts = ids_and_texts(docs, id_col, text_col)
    rows = store(_sketches(texts, size))
    nodes = store(rows.filter("node is not null").groupBy("node").agg(F.min("doc_id").alias("first_id")))
    # Rows of a node agree in all that follows from its set.
    one_each = store(rows.filter("node is not null").select("node", "n", "bands", *SIGNATURE, *SKETCH).dropDuplicates(["node"]))
    sketch = one_each.drop("bands")

    # Bands that several nodes share, and the node of each that has most neighbours in all its bands.
    banded = one_each.select("node", F.explode("bands").alias("band"))
    shared = store(banded.groupBy("band").agg(F.count("*").alias("members")).filter("members > 1"))
    met = store(banded.join(shared, "band"))
    degree = met.groupBy("node").agg(F.sum("members").alias("degree"))
    leaders = store(met.join(degree, "node").groupBy("band").agg(F.max(F.struct("degree", "node")).alias("leader"))
                    .select("band", F.col("leader.node").alias("leader"), "leader.degree"))
    members = store(met.select("band", "node").join(leaders, "band"))

    # Star: each node against the leader with most neighbours that looks similar. A leader comes
    # before its members by neighbours and node, so that no circle can arise.
    stars = members.filter("node <> leader").select("leader", "node", "degree").distinct()
    looks = (stars.join(sketch.alias("l"), F.col("leader") == F.col("l.node"))
             .join(sketch.alias("r"), stars["node"] == F.col("r.node")).filter(_promising(percent))
             .groupBy(stars["node"]).agg(F.max(F.struct("degree", "leader")).alias("best")))
    pairs1 = store(looks.select(F.col("best.leader").alias("a"), F.col("node").alias("b")))
    sets1 = store(_sets_of(texts, pairs1, nodes, size))
    links1 = _confirmed(pairs1, sets1, percent)
    labels1 = roots(links1.select(F.col("b").alias("node"), F.col("a").alias("parent")))

    # Between the components that share a band.
    labelled = members.join(labels1, "node", "left").select("band", "leader", "node", F.coalesce("label", "node").alias("label"))
    mixed = store(labelled.groupBy("band").agg(F.min("label").alias("least"), F.max("label").alias("most"),
                                               F.max(F.when(F.col("node") == F.col("leader"), F.col("label"))).alias("main"))
                  .filter("least <> most").select("band", "main"))
    spread = store(labelled.join(mixed, "band").join(sketch, "node")
                   .select("band", "node", "label", (F.col("label") != F.col("main")).alias("stray"), "n", *SIGNATURE, *SKETCH))
    between = spread.filter("stray").alias("l").join(
        spread.alias("r"),
        (F.col("l.band") == F.col("r.band")) & (F.col("l.label") != F.col("r.label"))
        & (~F.col("r.stray") | (F.col("l.node") < F.col("r.node"))) & _promising(percent))
    pairs2 = store(between.select(F.least("l.node", "r.node").alias("a"), F.greatest("l.node", "r.node").alias("b")).distinct())
    sets2 = store(_sets_of(texts, pairs2, nodes, size, sets1))
    links2 = _confirmed(pairs2, sets1.unionByName(sets2), percent)

    tree = labels1.select(F.col("node").alias("a"), F.col("label").alias("b"))
    labels = components(tree.unionByName(links2))
    lowest = store(labels.join(nodes, "node").groupBy("label").agg(F.min("first_id").alias("lowest")))
    component = store(labels.join(lowest, "label").select("node", "lowest"))

    found = rows.join(component, "node", "left").join(nodes.withColumnRenamed("first_id", "own"), "node", "left")
    least = F.coalesce("lowest", "own", "doc_id")
    return found.select("doc_id", F.col("n").alias("n_shingles"), least.alias("component_id"),
                        F.col("doc_id").eqNullSafe(least).alias("kept"))


def _sets_of(texts: DataFrame, pairs: DataFrame, nodes: DataFrame, size: int, known: DataFrame | None = None) -> DataFrame:
    """Whole sets of the nodes in ``pairs`` that are not in ``known``; only their texts are read out."""
    wanted = pairs.select(F.col("a").alias("node")).union(pairs.select(F.col("b").alias("node"))).distinct()
    if known is not None:
        wanted = wanted.join(known.select("node"), "node", "left_anti")
    wanted = store(wanted.join(nodes, "node"))
    ids = wanted.select(F.col("first_id").alias("doc_id")).distinct()
    sets = _sets(semi(texts, ids, "doc_id"), size)
    return semi(sets, wanted.select("node"), "node").dropDuplicates(["node"])


def drop_near_duplicates(docs: DataFrame, size: int = 5, percent: int = 80, id_col: str = "doc_id",
                         text_col: str = "text") -> DataFrame:
    """``docs`` with one document of each group; all columns stay.

    Rows go by id: an id goes where none of its rows is the one that stays; null ids never go.
    """
    found = near_duplicates(docs, size, percent, id_col, text_col)
    gone = store(found.filter(F.col("doc_id").isNotNull()).groupBy("doc_id").agg(F.max("kept").alias("stays"))
                 .filter(~F.col("stays")).select(F.col("doc_id").alias(id_col)))
    return anti(docs, gone, id_col)
