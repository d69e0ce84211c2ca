"""Toxicity scores: FTRL-proximal logistic regression over hashed word n-grams and skip-grams.

Features of a text (each counts once): its lower-cased words, their stems cut to four and five
letters, pairs of neighbouring words, and pairs with one word between them, hashed to ``2**BITS``
coordinates. FTRL keeps a rate per coordinate, and its L1 term leaves most coordinates at zero, so
the weights that are sent to the executors are a short list.

Defined results: a null or wordless text has no feature and gets the score of the bias; every row
gets one row, repeated rows too; without labels every score is 0.5; an empty table gives an empty
result; further columns are ignored. Only the text enters a score.
"""

from __future__ import annotations

import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidegrid.llm.common import ids_and_texts
from tidegrid.llm.sampling import fold, labelled_sample, train
from tidegrid.session import ship_package

BITS = 20
#: Most labelled documents (expected number) that the model is fitted on.
SAMPLE_ROWS = 10_000
EPOCHS = 5
ALPHA, BETA, L1, L2 = 1.0, 1.0, 3.0, 0.01

_WORD = re.compile(r"[^\W_]+")
_BIAS = (1 << BITS) - 1
_CACHE = 400_000


class _Words:
    """Hashes of words and of their stems, remembered for a bounded number of words."""

    def __init__(self) -> None:
        self.at: dict[str, int] = {}
        self.hashes = np.zeros((1024, 3), np.uint64)

    def rows(self, words: list[str]) -> np.ndarray:
        """(words, 3): hash of the word, of its first four and first five letters."""
        if len(self.at) > _CACHE:
            self.at.clear()
        at = self.at
        for w in set(words).difference(at):
            k = len(at)
            if k == len(self.hashes):
                self.hashes = np.concatenate([self.hashes, np.zeros_like(self.hashes)])
            self.hashes[k] = [xxhash.xxh3_64_intdigest(s) for s in (w, f"{w[:4]}*", f"{w[:5]}*")]
            at[w] = k
        return self.hashes[np.fromiter(map(at.__getitem__, words), np.int64, len(words))]


def _features(words: list[str], table: _Words) -> tuple[np.ndarray, ...]:
    """Coordinates of all n-grams of a text, repeated ones repeated."""
    h = table.rows(words)
    word = h[:, 0]
    with np.errstate(over="ignore"):
        pair = word[:-1] * np.uint64(0x9E3779B97F4A7C15) + word[1:]
        skip = word[:-2] * np.uint64(0xC2B2AE3D27D4EB4F) + word[2:]
        mixed = np.concatenate([word, h[:, 1], h[:, 2], pair, skip])
        mixed = (mixed ^ (mixed >> np.uint64(29))) * np.uint64(0xBF58476D1CE4E5B9)
    return (mixed >> np.uint64(64 - BITS)).astype(np.int64) % _BIAS


def _words(text: str) -> list[str]:
    return _WORD.findall(text.lower())


def fit_ftrl(labels: np.ndarray, idx: list[np.ndarray], weight: list[np.ndarray]) -> dict[int, float]:
    """FTRL-proximal: z and n per coordinate; the weight follows from them when it is needed."""
    z, n = np.zeros(1 << BITS), np.zeros(1 << BITS)

    def weights(at: np.ndarray | slice) -> np.ndarray:
        zs, ns = z[at], n[at]
        return np.where(np.abs(zs) <= L1, 0.0, -(zs - np.sign(zs) * L1) / ((BETA + np.sqrt(ns)) / ALPHA + L2))

    for _ in range(EPOCHS):
        for y, at in zip(labels, idx):
            at = np.append(at, _BIAS)
            w = weights(at)
            p = 1 / (1 + np.exp(-np.clip(w.sum(), -35, 35)))
            g = p - (y > 0)
            z[at] += g - (np.sqrt(n[at] + g * g) - np.sqrt(n[at])) / ALPHA * w
            n[at] += g * g
    w = weights(slice(None))
    return {int(i): float(w[i]) for i in np.flatnonzero(w)}


def train_toxicity(docs: DataFrame, labels: DataFrame, usable: Column | None = None,
                   rows: int = SAMPLE_ROWS) -> tuple[np.ndarray, np.ndarray]:
    """Sparse weights, learned from the labels whose ``doc_id`` fulfils ``usable``."""
    def extract(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        table = _Words()
        for b in batches:
            idx = [np.unique(_features(_words(t), table)).astype(np.int32) for t in b["text"].to_pylist()]
            yield pa.RecordBatch.from_pydict({
                "order": b["order"], "label": b["label"], "idx": pa.array(idx, pa.list_(pa.int32())),
                "weight": pa.array([[]] * len(idx), pa.list_(pa.float32()))})

    sample = labelled_sample(docs, labels, "toxic", F.lit(True) if usable is None else usable, rows)
    return train(sample.mapInArrow(extract, "order long, label int, idx array<int>, weight array<float>"), fit_ftrl)


def score_toxicity(docs: DataFrame, model: tuple[np.ndarray, np.ndarray], id_col: str = "doc_id",
                   text_col: str = "text") -> DataFrame:
    """``(doc_id, score)``: probability that a text is toxic."""
    ship_package(docs.sparkSession)
    at, value = model

    def score(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        dense = np.zeros(1 << BITS)
        dense[at] = value
        table = _Words()
        for b in batches:
            sums = np.full(b.num_rows, dense[_BIAS])
            for k, text in enumerate(b["text"].to_pylist()):
                found = _features(_words(text), table)
                sums[k] += dense[np.unique(found[dense[found] != 0])].sum()
            yield pa.RecordBatch.from_pydict({
                "doc_id": b["doc_id"], "score": pa.array(1 / (1 + np.exp(-np.clip(sums, -35, 35))))})

    return ids_and_texts(docs, id_col, text_col).mapInArrow(score, f"doc_id {docs.schema[id_col].dataType.simpleString()}, score double")


def held_out(doc_id: Column) -> Column:
    """The fold of crc32(doc_id) mod 3 that the model never learns from."""
    return fold(doc_id, 3) == 1
