"""Numpy parts of the suffix-array operator; none of them uses Spark.

Suffix arrays by prefix doubling that sorts only what is not yet in order, common prefixes in text
order with each one starting from the last less one, and content-determined anchors.
"""

from __future__ import annotations

import numpy as np

#: Length of the grams among which anchors are chosen.
GRAM = 32
#: Bytes that are handled at once; longer texts are taken in pieces that share a window less a byte.
PIECE = 1 << 17
_POSITION_BITS = np.uint64(18)
_POSITION = (np.uint64(1) << _POSITION_BITS) - np.uint64(1)

_BASE = np.uint64(0x2127599BF4325C37)
_rng = np.random.default_rng(9)
_VALUES = _rng.integers(1, 1 << 63, 256, np.uint64)


def _powers(base: np.uint64, n: int) -> np.ndarray:
    with np.errstate(over="ignore"):
        return np.cumprod(np.concatenate([[np.uint64(1)], np.full(n - 1, base, np.uint64)]), dtype=np.uint64)


_UP = _powers(_BASE, 2 * PIECE)
_DOWN = _powers(np.uint64(pow(int(_BASE), -1, 1 << 64)), 2 * PIECE)


def mix(x: np.ndarray) -> np.ndarray:
    with np.errstate(over="ignore"):
        x = (x ^ (x >> np.uint64(32))) * np.uint64(0xD6E8FEB86659FD93)
        return x ^ (x >> np.uint64(29))


def prefix_sums(data: np.ndarray) -> np.ndarray:
    """Sums from which the hash of any range follows by one subtraction and product."""
    with np.errstate(over="ignore"):
        return np.concatenate([[np.uint64(0)], np.cumsum(_VALUES[data] * _UP[:len(data)], dtype=np.uint64)])


def range_hash(sums: np.ndarray, lo: np.ndarray, hi: np.ndarray) -> np.ndarray:
    """Hashes of the ranges [lo, hi); equal for equal bytes wherever they stand."""
    with np.errstate(over="ignore"):
        return (sums[hi] - sums[lo]) * _DOWN[lo]


def _sliding_min(x: np.ndarray, w: int) -> np.ndarray:
    """Least value of every window of ``w`` elements."""
    n = len(x)
    padded = np.full(-(-n // w) * w, np.iinfo(np.uint64).max, np.uint64)
    padded[:n] = x
    blocks = padded.reshape(-1, w)
    ahead = np.minimum.accumulate(blocks, axis=1).ravel()
    behind = np.minimum.accumulate(blocks[:, ::-1], axis=1)[:, ::-1].ravel()
    return np.minimum(behind[:n - w + 1], ahead[w - 1:n])


def anchored(data: np.ndarray, owner: np.ndarray, length: int) -> tuple[np.ndarray, ...]:
    """The stretches of ``data`` whose windows of ``length`` bytes choose the same anchor.

    Each window chooses the gram of least hash inside it, the first of equal ones, so equal windows
    choose alike wherever they stand. Windows over a border between owners do not count. Returns
    first byte, end, anchor hash and context hash of each stretch.
    """
    empty = np.zeros(0, np.int64)
    if len(data) < length:
        return empty, empty, empty.astype(np.uint64), empty.astype(np.uint64)
    sums = prefix_sums(data)
    at = np.arange(len(data) - GRAM + 1)
    grams = mix(range_hash(sums, at, at + GRAM))
    chosen = _sliding_min((grams & ~_POSITION) | at.astype(np.uint64), length - GRAM + 1) & _POSITION
    starts = np.flatnonzero(owner[:len(chosen)] == owner[length - 1:])
    if not len(starts):
        return empty, empty, empty.astype(np.uint64), empty.astype(np.uint64)
    chosen = chosen[starts]
    cut = np.flatnonzero((np.diff(starts) != 1) | (np.diff(chosen) != 0)) + 1
    lo = starts[np.concatenate([[0], cut])]
    hi = starts[np.concatenate([cut - 1, [len(starts) - 1]])] + length
    anchor = chosen[np.concatenate([[0], cut])].astype(np.int64)
    with np.errstate(over="ignore"):
        context = mix(range_hash(sums, lo, hi) + (hi - lo).astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15)
                      + (anchor - lo).astype(np.uint64) * np.uint64(0xC2B2AE3D27D4EB4F))
    return lo, hi, grams[anchor], context


def _words(data: np.ndarray) -> np.ndarray:
    """The eight bytes from each position on as one number, zeros behind the end."""
    padded = np.concatenate([data, np.zeros(8, np.uint8)]).astype(np.uint64)
    out = np.zeros(len(data), np.uint64)
    for k in range(8):
        out = (out << np.uint64(8)) | padded[k:k + len(data)]
    return out


def suffix_array(data: np.ndarray, depth: int) -> np.ndarray:
    """Positions of all suffixes in the order of their first ``depth`` bytes.

    Larsson-Sadakane: suffixes sorted by their first h bytes have group numbers, and the number of
    the group h bytes on sorts them by 2h. Groups of one are in place and are not looked at again.
    """
    n = len(data)
    first = _words(data)
    sa = np.argsort(first, kind="stable")
    rank = np.zeros(n + depth, np.int64)  # 0 behind the end, else 1 + place of the group's first
    new = np.concatenate([[True], first[sa[1:]] != first[sa[:-1]]])
    group = np.maximum.accumulate(np.where(new, np.arange(n), 0))
    rank[sa] = group + 1
    h = 8
    while h < depth:
        alone = new & np.concatenate([new[1:], [True]])
        places = np.flatnonzero(~alone)
        if not len(places):
            break
        suffixes = sa[places]
        key = (group[places] << 32) | rank[suffixes + h]
        order = np.argsort(key, kind="stable")
        sa[places] = suffixes[order]
        key = key[order]
        new[places] = np.concatenate([[True], key[1:] != key[:-1]])
        group = np.maximum.accumulate(np.where(new, np.arange(n), 0))
        rank[sa] = group + 1
        h *= 2
    return sa


def common_prefixes(data: np.ndarray, order: np.ndarray, lo: np.ndarray, hi: np.ndarray, depth: int) -> np.ndarray:
    """For each suffix of ``order`` the bytes, ``depth`` at most, that it shares with the one before.

    Kasai: in text order a suffix shares at least one byte less than its left neighbour did. One
    lane per range [lo, hi) of the suffixes wanted walks through its range, all lanes in step. Where
    the partner's right neighbour does not come before (its range ends, or the two differ just
    behind ``depth``), the count starts anew.
    """
    n = len(data)
    place = np.full(n + 1, n, np.int64)  # in the order; behind all others where not in it
    place[order] = np.arange(len(order))
    before = np.full(n + 1, -1, np.int64)
    before[order[1:]] = order[:-1]
    words = _words(data)
    words = np.concatenate([words, np.zeros(depth + 8, np.uint64)])
    bytes_ = np.concatenate([data, np.zeros(depth + 8, np.uint8)])
    shared = np.zeros(n + 1, np.int64)
    i, end = lo.astype(np.int64), hi.astype(np.int64)
    keep = i < end
    i, end = i[keep], end[keep]
    h = np.zeros(len(i), np.int64)
    while len(i):
        j = before[i]
        some = j >= 0
        left, right = i + h, np.where(some, j, i) + h
        eight = some & (h + 8 <= depth) & (words[left] == words[right])
        one = some & ~eight & (h < depth) & (bytes_[left] == bytes_[right])
        on = ~(eight | one)
        h += 8 * eight + one
        # A lane that found a difference, or enough, notes it and moves on.
        shared[i[on]] = h[on]
        follows = some & (place[j + 1] < place[i + 1])
        h = np.where(on, np.where(follows, np.maximum(h - 1, 0), 0), h)
        i = i + on
        alive = i < end
        if not alive.all():
            i, end, h = i[alive], end[alive], h[alive]
    return shared[order]


def repeated_windows(data: np.ndarray, lo: np.ndarray, hi: np.ndarray, length: int) -> tuple[np.ndarray, np.ndarray]:
    """``(repeated, group)`` per position: whether the window that starts there, inside a range
    [lo, hi), also starts elsewhere, and a number that equal windows share (-1: no window)."""
    n = len(data)
    stop = np.maximum(hi - length + 1, lo)
    sizes = stop - lo
    valid = np.zeros(n, bool)
    valid[np.repeat(lo - np.concatenate([[0], np.cumsum(sizes)[:-1]]), sizes) + np.arange(sizes.sum())] = True
    sa = suffix_array(data, length)
    order = sa[valid[sa]]
    repeated, group = np.zeros(n, bool), np.full(n, -1, np.int64)
    if not len(order):
        return repeated, group
    same = common_prefixes(data, order, lo, stop, length) >= length
    same[0] = False
    repeated[order] = same | np.concatenate([same[1:], [False]])
    group[order] = np.cumsum(~same)
    return repeated, group
