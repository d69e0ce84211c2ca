"""Quality scores: supervised subword embeddings.

A document is the average of its words and of its pairs of neighbouring words; a word is the average
of learned vectors, one for the word and one for each of its character n-grams, a pair has one. All
are hashed to the same ``BUCKETS`` rows, a pair by the difference of its words' hashes: a word that
follows itself is one and the same pair whatever the word, since repetition tells of quality. A softmax over the classes stands on the average. Vectors and
output are trained together by stochastic gradient descent.

Since the output is linear in the average, each row of the table adds a fixed amount to the
difference of the two class scores. These amounts (one number per bucket) are all that scoring
needs, and a word's amount and hash are computed once and remembered.

Defined results: a null or wordless text gets the score of the bias; every row gets one row,
repeated rows too; without labels every score is 0.5; an empty table gives an empty result;
further columns are ignored or kept. Only the text enters a score.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidegrid.llm.common import ids_and_texts, text_of
from tidegrid.llm.sampling import fold, labelled_sample, train
from tidegrid.session import ship_package

BUCKETS = 1 << 17
DIMENSIONS = 8
GRAMS = (3, 4)
#: Most labelled documents (expected number) that the model is fitted on.
SAMPLE_ROWS = 5_000
EPOCHS, BATCH, RATE = 10, 16, 8.0
THRESHOLD = 0.3

_BIAS = BUCKETS
_CACHE = 300_000


def _hashes(words: list[str]) -> np.ndarray:
    return np.fromiter((xxhash.xxh3_64_intdigest(w.encode("utf-8", "surrogatepass")) for w in words), np.uint64, len(words))


def _pairs(hashes: np.ndarray) -> np.ndarray:
    """Buckets of the neighbouring words of a text, given the hashes of its words in order."""
    with np.errstate(over="ignore"):
        h = hashes[1:] - hashes[:-1]
        h = (h ^ (h >> np.uint64(31))) * np.uint64(0x94D049BB133111EB)
    return ((h >> np.uint64(40)) % np.uint64(BUCKETS)).astype(np.int64)


def _grams(words: list[str], hashes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(word number, bucket) of every feature of single words: the word itself, its character n-grams.

    The words stand in one array of code points between spaces, which mark where a word begins and
    ends; n-grams with a space inside belong to no word.
    """
    codes = np.frombuffer(f" {' '.join(words)} ".encode("utf-32-le", "surrogatepass"), np.uint32).astype(np.uint64)
    space = codes == 32
    owner = np.cumsum(space) - 1
    owners = [np.arange(len(words))]
    buckets = [hashes % np.uint64(BUCKETS)]
    with np.errstate(over="ignore"):
        for n in GRAMS:
            m = len(codes) - n + 1
            if m <= 0:
                continue
            h = np.full(m, n, np.uint64)
            inside = np.zeros(m, bool)
            for k in range(n):
                h = h * np.uint64(0x100000001B3) + codes[k:k + m]
                if 0 < k < n - 1:
                    inside |= space[k:k + m]
            h = (h ^ (h >> np.uint64(31))) * np.uint64(0x94D049BB133111EB)
            ok = ~inside
            owners.append(owner[1:1 + m][ok])
            buckets.append(((h >> np.uint64(40)) % np.uint64(BUCKETS))[ok])
    return np.concatenate(owners), np.concatenate(buckets).astype(np.int64)


def _document(text: str) -> tuple[np.ndarray, np.ndarray]:
    """Buckets of a text and the share each has in its average."""
    words = text.split()
    if not words:
        return np.zeros(0, np.int32), np.zeros(0, np.float32)
    place: dict[str, int] = {}
    at = np.fromiter((place.setdefault(w, len(place)) for w in words), np.int64, len(words))
    hashes = _hashes(list(place))
    owner, bucket = _grams(list(place), hashes)
    share = np.bincount(at) / np.bincount(owner, minlength=len(place))
    pairs = _pairs(hashes[at])
    features, inverse = np.unique(np.concatenate([bucket, pairs]), return_inverse=True)
    shares = np.bincount(inverse, np.concatenate([share[owner], np.ones(len(pairs))])) / (len(words) + len(pairs))
    return features.astype(np.int32), shares.astype(np.float32)


def fit_embeddings(labels: np.ndarray, idx: list[np.ndarray], weight: list[np.ndarray]) -> dict[int, float]:
    """Embeddings and softmax by minibatch SGD; returns what each bucket adds to class 1 over class 0."""
    rng = np.random.default_rng(11)
    table = rng.uniform(-1, 1, (BUCKETS, DIMENSIONS)) / DIMENSIONS
    out, bias = np.zeros((DIMENSIONS, 2)), np.zeros(2)
    order = np.arange(len(labels))
    steps, done = EPOCHS * (len(labels) // BATCH + 1), 0
    for _ in range(EPOCHS):
        rng.shuffle(order)
        for lo in range(0, len(order), BATCH):
            part = order[lo:lo + BATCH]
            rate = RATE * (1 - done / steps)
            done += 1
            at = np.concatenate([idx[i] for i in part])
            w = np.concatenate([weight[i] for i in part])
            doc = np.repeat(np.arange(len(part)), [len(idx[i]) for i in part])
            hidden = np.stack([np.bincount(doc, w * table[at, d], len(part)) for d in range(DIMENSIONS)], 1)
            logits = hidden @ out + bias
            p = np.exp(logits - logits.max(1, keepdims=True))
            p /= p.sum(1, keepdims=True)
            p[np.arange(len(part)), (labels[part] > 0).astype(int)] -= 1
            back = (p @ out.T) / len(part) * rate
            out -= rate * hidden.T @ p / len(part)
            bias -= rate * 0.05 * p.mean(0)
            rows, inverse = np.unique(at, return_inverse=True)
            for d in range(DIMENSIONS):
                table[rows, d] -= np.bincount(inverse, w * back[doc, d]) * len(part)
    value = table @ (out[:, 1] - out[:, 0])
    return {**{i: float(v) for i, v in enumerate(value)}, _BIAS: float(bias[1] - bias[0])}


def train_quality(docs: DataFrame, labels: DataFrame, usable: Column | None = None,
                  rows: int = SAMPLE_ROWS) -> tuple[np.ndarray, np.ndarray]:
    """What each bucket adds, learned from the labels whose ``doc_id`` fulfils ``usable``."""
    def extract(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            found = [_document(t) for t in b["text"].to_pylist()]
            yield pa.RecordBatch.from_pydict({
                "order": b["order"], "label": b["label"], "idx": pa.array([x[0] for x in found], pa.list_(pa.int32())),
                "weight": pa.array([x[1] for x in found], pa.list_(pa.float32()))})

    sample = labelled_sample(docs, labels, "quality", F.lit(True) if usable is None else usable, rows)
    return train(sample.mapInArrow(extract, "order long, label int, idx array<int>, weight array<float>"), fit_embeddings)


def _scorer(model: tuple[np.ndarray, np.ndarray]):
    """A function from texts to scores, for one task."""
    dense = np.zeros(BUCKETS + 1)
    dense[model[0]] = model[1]
    known: dict[str, int] = {}
    hashes, added = np.zeros(0, np.uint64), np.zeros(0)

    def learn(words: list[str]) -> None:
        nonlocal hashes, added
        if len(known) > _CACHE:
            known.clear()
            hashes, added = hashes[:0], added[:0]
        fresh = list(dict.fromkeys(w for w in words if w not in known))
        if fresh:
            known.update(zip(fresh, range(len(known), len(known) + len(fresh))))
            new = _hashes(fresh)
            owner, bucket = _grams(fresh, new)
            hashes = np.concatenate([hashes, new])
            added = np.concatenate([added, np.bincount(owner, dense[bucket]) / np.bincount(owner)])

    def some(texts: list[str | None]) -> np.ndarray:
        split = [(text or "").split() for text in texts]
        learn([w for words in split for w in words])
        sums = np.full(len(texts), dense[_BIAS])
        for k, words in enumerate(split):
            if words:
                at = np.fromiter(map(known.__getitem__, words), np.int64, len(words))
                sums[k] += (added[at].sum() + dense[_pairs(hashes[at])].sum()) / (2 * len(words) - 1)
        return 1 / (1 + np.exp(-np.clip(sums, -35, 35)))

    def score(texts: list[str | None]) -> np.ndarray:
        parts = [some(texts[lo:lo + 256]) for lo in range(0, len(texts), 256)]
        return np.concatenate(parts) if parts else np.zeros(0)

    return score


def score_quality(docs: DataFrame, model: tuple[np.ndarray, np.ndarray], id_col: str = "doc_id",
                  text_col: str = "text") -> DataFrame:
    """``(doc_id, score)``: probability of the label 1."""
    ship_package(docs.sparkSession)
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        score = _scorer(model)
        for b in batches:
            yield pa.RecordBatch.from_pydict({"doc_id": b["doc_id"], "score": pa.array(score(b["text"].to_pylist()))})

    return ids_and_texts(docs, id_col, text_col).mapInArrow(run, f"doc_id {docs.schema[id_col].dataType.simpleString()}, score double")


def keep_good(docs: DataFrame, model: tuple[np.ndarray, np.ndarray], threshold: float = THRESHOLD,
              text_col: str = "text") -> DataFrame:
    """``docs`` without the rows scored under the threshold; all columns stay."""
    ship_package(docs.sparkSession)
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        score = _scorer(model)
        for b in batches:
            yield b.select(["row"]).filter(pa.array(score(b["text"].to_pylist()) >= threshold))

    rows = docs.select(F.struct("*").alias("row"), text_of(text_col).alias("text"))
    kept = rows.mapInArrow(run, T.StructType([rows.schema["row"]]))
    return kept.select("row.*")


def held_out(doc_id: Column) -> Column:
    """The fold of crc32(doc_id) mod 5 that the model never learns from."""
    return fold(doc_id, 5) == 0
