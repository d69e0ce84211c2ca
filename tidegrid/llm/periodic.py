"""Periodic runs of words, found by block convolution at dyadic scales.

A run is a stretch of words with smallest period q that is at least ``max(24, 3 * q)`` words
long and cannot be extended. At scale L (8, 16, 32, ...) the words of a text are cut into
aligned blocks of L. A run of period q in [L, 2L), or below 16 at the first scale, holds a
whole block together with its copy q words on, as it is longer than q + 2L - 2. So each block
is laid over the window behind it: the squared differences, summed over the block for every
distance at once by a number-theoretic transform, are zero exactly where the block occurs
again. A sum of squares is below L times the square of the largest word number; as many primes
are used as that takes, so a zero is a zero. The distances found seed extensions to both
sides.

What cannot hold an occurrence is not transformed: a block with a word that does not come back
within the window, and a block whose whole window lies in a run that is already known (all
seeds in there are multiples of its period). Extensions are measured by binary search over
prefix hashes and each run is confirmed word by word; hashes that agree by chance
only cost another look.

Words of many texts are numbered apart and laid end to end, so that one transform serves
thousands of short texts; a long text makes an array of its own.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidegrid.llm.common import ids_and_texts
from tidegrid.session import ship_package

#: Shortest run, and how often its period has to fit.
LEAST_WORDS, LEAST_PERIODS = 24, 3

#: Block length of the first scale; it serves all periods below twice that.
FIRST_BLOCK = 8

#: Words laid end to end before they are searched, and cells of one batch of transforms.
ARRAY_WORDS = 1 << 18
TRANSFORM_CELLS = 1 << 20

#: Primes with a root of unity of order 2**27 and a primitive root of each. Fixed values.
PRIMES = ((2013265921, 31), (2281701377, 3), (3221225473, 5))

RUNS = "doc_id long, runs array<struct<start:long,length:long,period:long>>, collapsed string"


def _powers(base: int, count: int, p: int) -> np.ndarray:
    """base ** 0 .. base ** (count - 1) modulo p, by doubling."""
    out = np.ones(1, np.uint64)
    while len(out) < count:
        out = np.concatenate([out, out * np.uint64(pow(base, len(out), p)) % np.uint64(p)])
    return out[:count]


def _transform(rows: np.ndarray, p: int, g: int, inverse: bool) -> np.ndarray:
    """Transform along the rows: natural to bit-reversed order, or back (without the division by n)."""
    m, n = rows.shape
    prime = np.uint64(p)
    halves = [1 << k for k in range(n.bit_length() - 1)]
    for h in halves if inverse else reversed(halves):
        root = pow(g, (p - 1) // (2 * h), p)
        w = _powers(pow(root, -1, p) if inverse else root, h, p)
        pairs = rows.reshape(m, n // (2 * h), 2, h)
        a, b = pairs[:, :, 0], pairs[:, :, 1]
        if inverse:
            b = b * w % prime
            total, gap = a + b, a + (prime - b)
        else:
            total, gap = a + b, (a + (prime - b)) * w % prime
        np.subtract(total, prime, out=total, where=total >= prime)
        if inverse:
            np.subtract(gap, prime, out=gap, where=gap >= prime)
        pairs[:, :, 0], pairs[:, :, 1] = total, gap
    return rows


def zero_mismatches(blocks: np.ndarray, windows: np.ndarray, largest: int) -> np.ndarray:
    """Where each block occurs in its window: a boolean row per block, by offset.

    Word numbers run from 1 to ``largest``; 0 in a window stands for "behind the text".
    """
    length, shifts = blocks.shape[1], windows.shape[1] - blocks.shape[1] + 1
    n = 1 << (windows.shape[1] - 1).bit_length()
    zero, bound, product = None, length * largest * largest, 1
    for p, g in PRIMES:
        if product > bound:
            break
        product *= p
        prime = np.uint64(p)
        b, t = blocks.astype(np.uint64) % prime, windows.astype(np.uint64) % prime
        padded_b, padded_t = (np.zeros((len(blocks), n), np.uint64) for _ in range(2))
        # The block backwards, wrapped, so that offset s of the product is the sum over block[i] * window[s + i].
        padded_b[:, 0], padded_b[:, n - length + 1:] = b[:, 0], b[:, :0:-1]
        padded_t[:, : t.shape[1]] = t
        product_rows = _transform(padded_b, p, g, False) * _transform(padded_t, p, g, False) % prime
        both = _transform(product_rows, p, g, True)[:, :shifts] * np.uint64(pow(n, -1, p)) % prime
        squares = np.cumsum(np.pad(t * t % prime, ((0, 0), (1, 0))), axis=1, dtype=np.uint64)
        inside = (squares[:, length:] - squares[:, :shifts]) % prime
        own = (b * b % prime).sum(axis=1, dtype=np.uint64) % prime
        here = (inside + own[:, None]) % prime == both * np.uint64(2) % prime
        zero = here if zero is None else zero & here
    if product <= bound:
        raise ValueError("a text with so many different words needs another prime")
    return zero


class _Prefixes:
    """Prefix hashes of an array, to measure how far two places agree."""

    P, BASE = 2013265921, 1_000_003

    def __init__(self, words: np.ndarray):
        p = np.uint64(self.P)
        self.power = _powers(self.BASE, len(words) + 1, self.P)
        terms = words.astype(np.uint64) % p * self.power[: len(words)] % p
        self.sums = np.concatenate([np.zeros(1, np.uint64), np.cumsum(terms) % p])

    def _same(self, i: np.ndarray, d: np.ndarray, length: np.ndarray) -> np.ndarray:
        p = np.uint64(self.P)
        first = (self.sums[i + length] + p - self.sums[i]) % p * self.power[d] % p
        return first == (self.sums[i + d + length] + p - self.sums[i + d]) % p

    def agree(self, i: np.ndarray, d: np.ndarray, most: np.ndarray, back: bool) -> np.ndarray:
        """Words that agree at i and i + d, going forward or ending there, ``most`` at the most."""
        low, high = np.zeros_like(most), most.copy()
        while (low < high).any():
            middle = (low + high + 1) // 2
            same = self._same(i - middle if back else i, d, middle)
            low, high = np.where(same, middle, low), np.where(same, high, middle - 1)
        return low


def _stretch(words: np.ndarray, at: int, d: int, lo: int, hi: int) -> tuple[int, int]:
    """Largest stretch around ``at`` in [lo, hi) that repeats itself d words on, word by word."""
    differ = np.flatnonzero(words[lo : hi - d] != words[lo + d : hi]) + lo
    k = np.searchsorted(differ, at)
    return (int(differ[k - 1]) + 1 if k else lo), (int(differ[k]) if k < len(differ) else hi - d) + d


def find_runs(words: np.ndarray, starts: np.ndarray) -> np.ndarray:
    """All runs of texts laid end to end: rows (start, end, period), by start, then period.

    ``words`` are numbers from 1, no number in two texts; ``starts`` has the texts' borders.
    """
    n, largest = len(words), int(words.max(initial=0))
    known = np.empty((0, 3), np.int64)
    order = np.argsort(words, kind="stable")
    comes_back = np.full(n, np.iinfo(np.int64).max)
    again = words[order[1:]] == words[order[:-1]]
    comes_back[order[:-1][again]] = (order[1:] - order[:-1])[again]
    sizes = np.diff(starts)
    prefixes = None
    length = FIRST_BLOCK
    while len(sizes) and sizes.max() >= LEAST_PERIODS * length:
        nearest = 1 if length == FIRST_BLOCK else length
        at, end = _blocks(starts, sizes, length, nearest)
        lost = np.concatenate([[0], np.cumsum(comes_back >= 2 * length)])
        open_ = lost[at + length] == lost[at]
        at, end = at[open_], end[open_]
        reach = _reach(known, at)
        open_ = reach < np.minimum(at + 3 * length - 1, end)
        at, end, reach = at[open_], end[open_], reach[open_]
        if len(at):
            b, d = _occurrences(words, at, end, length, nearest, largest)
            at, end, reach, d = at[b], end[b], reach[b], d
            open_ = reach < at + length + d
            at, end, d = at[open_], end[open_], d[open_]
            prefixes = prefixes or _Prefixes(words)
            known = np.concatenate([known, _extend(words, prefixes, starts, at, end, d, length)])
            known = known[np.lexsort((known[:, 2], known[:, 0]))]
        length *= 2
    return known


def _blocks(starts: np.ndarray, sizes: np.ndarray, length: int, nearest: int) -> tuple[np.ndarray, np.ndarray]:
    """Starts of all aligned blocks that leave room for a copy, with the end of their text."""
    count = np.maximum((sizes - nearest) // length, 0)
    text = np.repeat(np.arange(len(sizes)), count)
    number = np.arange(len(text)) - np.repeat(np.cumsum(count) - count, count)
    return starts[text] + number * length, starts[text + 1]


def _reach(known: np.ndarray, at: np.ndarray) -> np.ndarray:
    """Largest end of a known run that starts at or before each place; 0 for none."""
    ends = np.concatenate([[0], np.maximum.accumulate(known[:, 1])]) if len(known) else np.zeros(1, np.int64)
    return ends[np.searchsorted(known[:, 0], at, side="right")]


def _occurrences(words: np.ndarray, at: np.ndarray, end: np.ndarray, length: int, nearest: int,
                 largest: int) -> tuple[np.ndarray, np.ndarray]:
    """(block, distance) of every occurrence of a block in the window behind it."""
    width = 2 * length - nearest + length - 1
    found_b, found_d = [], []
    step = max(TRANSFORM_CELLS // (4 * length), 1)
    for k in range(0, len(at), step):
        a, e = at[k : k + step, None], end[k : k + step, None]
        spots = a + nearest + np.arange(width)
        windows = np.where(spots < e, words[np.minimum(spots, len(words) - 1)], 0)
        b, shift = np.nonzero(zero_mismatches(words[a + np.arange(length)], windows, largest))
        found_b.append(b + k)
        found_d.append(shift + nearest)
    return np.concatenate(found_b), np.concatenate(found_d)


def _extend(words: np.ndarray, prefixes: _Prefixes, starts: np.ndarray, at: np.ndarray, end: np.ndarray,
            d: np.ndarray, length: int) -> np.ndarray:
    """The runs that seeds (place, distance) grow into, long enough, each with its smallest period."""
    # Of neighbouring blocks with the same distance the first one will do.
    order = np.lexsort((at, d))
    at, end, d = at[order], end[order], d[order]
    goes_on = (np.diff(at) == length) & (np.diff(d) == 0) & (np.diff(end) == 0)
    first = np.concatenate([[True], ~goes_on]) if len(at) else np.zeros(0, bool)
    at, end, d = at[first], end[first], d[first]
    begin = starts[np.searchsorted(starts, at, side="right") - 1]
    back = prefixes.agree(at, d, at - begin, True)
    on = prefixes.agree(at + length, d, end - at - length - d, False)
    lo, hi = at - back, at + length + d + on
    long = hi - lo >= np.maximum(LEAST_WORDS, LEAST_PERIODS * d)
    rows = {}
    for s, e, q, a, text_lo, text_hi in zip(*(x[long].tolist() for x in (lo, hi, d, at, begin, end))):
        if not np.array_equal(words[s : e - q], words[s + q : e]):
            s, e = _stretch(words, a, q, text_lo, text_hi)
        if e - s >= max(LEAST_WORDS, LEAST_PERIODS * q):
            rows[s, e] = min(q, rows.get((s, e), q))
    return np.array([(s, e, q) for (s, e), q in rows.items()], np.int64).reshape(-1, 3)


def _numbered(texts: list[list[bytes]]) -> tuple[np.ndarray, np.ndarray]:
    """Words of some texts as numbers from 1, none in two texts, and the texts' borders."""
    parts, taken = [], 1
    for w in texts:
        number = {x: k for k, x in enumerate(dict.fromkeys(w), taken)}
        parts.append(np.fromiter(map(number.__getitem__, w), np.int64, len(w)))
        taken += len(number)
    return np.concatenate([*parts, np.zeros(0, np.int64)]), np.concatenate([[0], np.cumsum([len(w) for w in texts], dtype=np.int64)])


def _results(texts: list[list[bytes]]) -> Iterator[tuple[list[tuple[int, int, int]], bytes]]:
    """Runs (start, length, period) and collapsed words of each text."""
    words, starts = _numbered(texts)
    runs = find_runs(words, starts)
    border = np.searchsorted(runs[:, 0], starts)
    for k, w in enumerate(texts):
        own = runs[border[k] : border[k + 1]] - [starts[k], starts[k], 0]
        if len(own):
            change = np.zeros(len(w) + 1, np.int64)
            np.add.at(change, own[:, 0] + own[:, 2], 1)
            np.add.at(change, own[:, 1], -1)
            w = [w[i] for i in np.flatnonzero(np.cumsum(change)[:-1] == 0)]
        yield [(s, e - s, q) for s, e, q in own.tolist()], b" ".join(w)


def periodic_runs(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Per row: doc_id, ``runs`` (start, length, period; by start, then period) and ``collapsed``.

    Words are separated by ASCII white space and numbered from 0. ``collapsed`` has the words
    that no run repeats, joined by one space: of a run, its first period stays. Null and empty
    texts have no runs; equal rows give equal rows, and null ids stay. Whole texts are searched,
    whatever their length. Other columns are not looked at.
    """
    ship_package(docs.sparkSession)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        schema = pa.schema([("doc_id", pa.int64()), ("runs", pa.list_(pa.struct([(n, pa.int64()) for n in ("start", "length", "period")]))),
                            ("collapsed", pa.string())])

        def done(ids: list, texts: list[list[bytes]]) -> pa.RecordBatch:
            found = list(_results(texts))
            runs = [[dict(zip(("start", "length", "period"), r)) for r in rs] for rs, _ in found]
            return pa.RecordBatch.from_pydict({"doc_id": ids, "runs": runs, "collapsed": [c.decode() for _, c in found]}, schema)

        for batch in batches:
            ids, texts, size = [], [], 0
            for i, text in zip(batch["doc_id"].to_pylist(), batch["text"]):
                # bytes.split() parts at exactly the six ASCII white-space characters.
                texts.append(text.as_py().split())
                ids.append(i)
                size += len(texts[-1])
                if size >= ARRAY_WORDS:
                    yield done(ids, texts)
                    ids, texts, size = [], [], 0
            if ids:
                yield done(ids, texts)

    rows = ids_and_texts(docs, id_col, text_col)
    return rows.select(F.col("doc_id").cast("long"), F.col("text").cast("binary").alias("text")).mapInArrow(run, RUNS)


def with_cycles(docs: DataFrame) -> DataFrame:
    """``(doc_id, text)`` in which the texts of one id in ten go in circles from some word on.

    With h the CRC-32 of the id in decimal and g = h // 10, a text of n > 0 words with h % 10 = 0
    repeats, from word g % n on, the next 1 + (n - g % n) // (3 + g % 8) words to its end.
    """
    h = F.crc32(F.col("doc_id").cast("string").cast("binary"))
    docs = ids_and_texts(docs).select("doc_id", "text", h.alias("h"), F.call_function("div", h, F.lit(10).cast("long")).alias("g"))
    words = F.regexp_extract_all("text", F.lit(r"[^\x20\x09-\x0D]+"), F.lit(0))
    docs = docs.withColumn("words", F.when(F.col("h") % 10 == 0, words))
    n = F.size("words")
    docs = docs.select("doc_id", "text", "words", "g", F.when(n > 0, F.col("g") % n).alias("a"), n.alias("n"))
    period = 1 + F.call_function("div", F.col("n") - F.col("a"), 3 + F.col("g") % 8)
    docs = docs.withColumn("p", period)
    turning = F.transform(F.sequence(F.col("a"), F.col("n") - 1), lambda i: F.col("words")[(F.col("a") + (i - F.col("a")) % F.col("p")).cast("int")])
    circled = F.concat(F.slice("words", F.lit(1), F.col("a").cast("int")), turning)
    return docs.select("doc_id", F.when(F.col("a").isNotNull(), F.array_join(circled, " ")).otherwise(F.col("text")).alias("text"))


def strongest(runs: Column) -> Column:
    """The run with the greatest exact length / period, the first of several; null for no runs."""
    better = lambda a, b: a["length"] * b["period"] < b["length"] * a["period"]
    return F.aggregate(F.slice(runs, 2, F.greatest(F.size(runs) - 1, F.lit(0))), F.get(runs, F.lit(0)),
                       lambda best, r: F.when(better(best, r), r).otherwise(best))
