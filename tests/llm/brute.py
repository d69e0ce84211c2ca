"""Plain reference versions of the corpus operators, for small inputs."""

import base64
import collections
import hashlib
import math
import re
import zlib

SPACE = re.compile(r"[\x20\x09-\x0D]+")


def ascii_lower(text):
    return "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or "")


def sha(text):
    return hashlib.sha256(text if isinstance(text, bytes) else text.encode()).hexdigest()


def exact(rows):
    """(doc_id, keep_id, group_size, kept, digest) per row."""
    groups = collections.defaultdict(list)
    digest = [sha(SPACE.sub(" ", t or "")) for _, t in rows]
    for (i, _), d in zip(rows, digest):
        groups[d].append(i)
    out = []
    for (i, _), d in zip(rows, digest):
        keep = min((x for x in groups[d] if x is not None), default=None)
        out.append((i, keep, len(groups[d]), i == keep, d))
    return out


def near(rows, size, percent):
    """(doc_id, shingles, component, kept) per row."""
    def shingles(t):
        w = [x for x in re.findall(r"[^\x20\x09-\x0D]+", ascii_lower(t))]
        n = min(size, len(w))
        return frozenset(tuple(w[k:k + n]) for k in range(len(w) - n + 1)) if w else frozenset()

    sets = [shingles(t) for _, t in rows]
    parent = list(range(len(rows)))

    def find(x):
        while parent[x] != x:
            x = parent[x]
        return x

    for a in range(len(rows)):
        for b in range(a):
            common = len(sets[a] & sets[b])
            if common and 100 * common >= percent * len(sets[a] | sets[b]):
                parent[find(a)] = find(b)
    lowest = collections.defaultdict(list)
    for k, (i, _) in enumerate(rows):
        lowest[find(k)].append(i)
    out = []
    for k, (i, _) in enumerate(rows):
        least = min((x for x in lowest[find(k)] if x is not None), default=None)
        out.append((i, len(sets[k]), least, i == least))
    return out


ASSIGN = re.compile(r"""(?:[Pp][Aa][Ss][Ss][Ww][Oo][Rr][Dd]|[Pp][Aa][Ss][Ss][Ww][Dd]|[Ss][Ee][Cc][Rr][Ee][Tt]|[Tt][Oo][Kk][Ee][Nn]"""
                    r"""|[Aa][Pp][Ii]_?[Kk][Ee][Yy])["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""")


def bits(w):
    return -sum(w.count(c) / len(w) * math.log2(w.count(c) / len(w)) for c in set(w))


def secrets(text, allowed):
    """[(start, rank, stop)] of the fixed patterns, and of the entropy windows.

    Every character is marked that lies in a whole hexadecimal part, or between the first and the
    last window of a candidate; marks go where a fixed pattern matches; stretches of 20 stay.
    """
    t = text or ""
    base = [(m.start(), 0, m.end()) for m in ASSIGN.finditer(t) if len(m[1]) >= 12]
    base += [(m.start(), 1, m.end()) for m in re.finditer(r"AKIA[A-Z0-9]+", t) if len(m[0]) >= 18]
    base += [(m.start(), 2, m.end()) for m in re.finditer(r"[0-9a-f]+", t) if len(m[0]) >= 16]
    more = []
    for m in re.finditer(r"[A-Za-z0-9+/_=-]{20,}", t):
        candidates = [(m.start() + p.start(), p[0]) for p in re.finditer(r"[^=/_-]+", m[0])]
        if len(candidates) != 1 or candidates[0][1] != m[0]:
            candidates.append((m.start(), m[0]))
        found = []
        for at, s in candidates:
            if len(s) < 20 or re.search(allowed, s):
                continue
            digits = re.fullmatch(r"[0-9A-Fa-f]+", s)
            hits = [k for k in range(len(s) - 19) if bits(s[k:k + 20]) >= (3.0 if digits else 3.7) - 1e-9]
            if hits:
                found.append((at, at + len(s)) if digits else (at + hits[0], at + hits[-1] + 20))
        marks = {}
        for lo, hi in found:  # spans that only touch stay two
            marks.update(dict.fromkeys(range(lo, hi - 1), True))
            marks.setdefault(hi - 1, False)
        for lo, _, hi in base:
            for k in range(max(lo, m.start()), min(hi, m.end())):
                marks.pop(k, None)
            if lo - 1 in marks:
                marks[lo - 1] = False
        k = m.start()
        while k < m.end():
            e = k
            while marks.get(e):
                e += 1
            e += e in marks
            if e - k >= 20:
                more.append((k, 3, e))
            k = max(e, k + 1)
    return sorted(base), sorted(more)


def repeats(rows, length):
    """(doc_id, bytes, removed, spans, digest) per row."""
    data = [(t or "").encode() for _, t in rows]
    counts = collections.Counter(b[k:k + length] for b in data for k in range(len(b) - length + 1))
    out = []
    for (i, _), b in zip(rows, data):
        covered, upto = bytearray(len(b)), 0
        for k in range(len(b) - length + 1):
            if counts[b[k:k + length]] > 1:
                lo = max(k, upto)
                upto = k + length
                covered[lo:upto] = b"\1" * (upto - lo)
        spans = sum(1 for k in range(len(b)) if covered[k] and (k == 0 or not covered[k - 1]))
        out.append((i, len(b), sum(covered), spans, sha(bytes(c for c, m in zip(b, covered) if not m))))
    return out


def contamination(rows, items, window):
    """(doc_id, words, hit, items) per row."""
    def split(t):
        return re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", ascii_lower(t))

    phrases = collections.defaultdict(set)
    for item, text in items:
        w = split(text)
        n = min(window, len(w))
        for k in range(len(w) - n + 1 if w else 0):
            phrases[tuple(w[k:k + n])].add(item)
    out = []
    for i, t in rows:
        w, hit, found = split(t), set(), set()
        for n in {len(p) for p in phrases}:
            for k in range(len(w) - n + 1):
                if tuple(w[k:k + n]) in phrases:
                    hit.update(range(k, k + n))
                    found |= phrases[tuple(w[k:k + n])]
        out.append((i, len(w), len(hit), sorted(str(x) for x in found if x is not None)))
    return out


def near_places(rows, items, window, slack, edits):
    """{(doc_id, start, stop, phrase)} by looking at every stretch of every text."""
    def split(t):
        return re.split(r"[\x00-\x2F\x3A-\x60\x7B-\x7F]+", ascii_lower(t))

    def common(a, b):
        above = [0] * (len(b) + 1)
        for x in a:
            row = [0]
            for k, y in enumerate(b):
                row.append(above[k] + 1 if x == y else max(row[-1], above[k + 1]))
            above = row
        return above[-1]

    phrases = set()
    for _, text in items:
        w = [x for x in split(text) if x]
        phrases |= {tuple(w[k:k + window]) for k in range(max(len(w) - window, 0) + 1) if w}
    out = set()
    for i, t in rows:
        w = split(t)
        for p in phrases:
            reach, needed, places = len(p) + slack, len(p) - min(edits, len(p) // 5), []
            for at in (k for k, x in enumerate(w) if x in p):
                part = w[at:at + reach]
                if common(part, p) >= needed:
                    stop = at + max(k for k, x in enumerate(part) if x in p) + 1
                    if places and at - places[-1][2] < reach:
                        places[-1][1:] = [max(stop, places[-1][1]), at]
                    else:
                        places.append([at, stop, at])
            out |= {(i, a, b, p) for a, b, _ in places}
    return out


def captures(rows):
    """{page_id: (bytes, digest, type, refers)}."""
    first, out = {}, {}
    for i, html in sorted(rows):
        b = (html or "").encode()
        d = base64.b32encode(hashlib.sha1(b).digest()).decode()
        out[i] = (len(b), d, "revisit" if d in first else "response", first.get(d))
        first.setdefault(d, i)
    return out


def runs(text):
    """Runs (start, length, period) of words, by start, then period, by comparing all words at all distances."""
    w = re.findall(r"[^\x20\x09-\x0D]+", text or "")
    n, found = len(w), {}
    for q in range(1, n // 3 + 1):
        i = 0
        while i + q < n:
            k = i
            while k + q < n and w[k] == w[k + q]:
                k += 1
            if k > i and k + q - i >= max(24, 3 * q):
                found.setdefault((i, k + q - i), q)
            i = k + 1
    return sorted((s, length, q) for (s, length), q in found.items())


def collapsed(text, found):
    w = re.findall(r"[^\x20\x09-\x0D]+", text or "")
    gone = {i for s, length, q in found for i in range(s + q, s + length)}
    return " ".join(x for i, x in enumerate(w) if i not in gone)


def circled(doc_id, text):
    """The text of an id whose checksum ends in 0, going in circles from some word on."""
    w = re.findall(r"[^\x20\x09-\x0D]+", text or "")
    h = None if doc_id is None else zlib.crc32(str(doc_id).encode())
    if h is None or h % 10 or not w:
        return text or ""
    g, n = h // 10, len(w)
    a = g % n
    p = 1 + (n - a) // (3 + g % 8)
    return " ".join(w[i] if i < a else w[a + (i - a) % p] for i in range(n))


def clusters(rows, k=16, rounds=3, dims=64):
    """(vec_id, cluster, distance, cluster_inertia, inertia, centroid) per kept vector."""
    kept = [(i, [math.floor(64 * float(x)) for x in v]) for i, v in rows
            if v is not None and len(v) == dims and all(x is not None and math.isfinite(x) for x in v)]
    order = sorted(kept, key=lambda r: (r[0] is None, sha(f"1:{r[0]}"), r[1]) if r[0] is not None else (True, "", r[1]))
    places = [v for _, v in order[:k]]

    def nearest(v):
        return min((sum((a - b) ** 2 for a, b in zip(v, p)), c) for c, p in enumerate(places))

    for _ in range(rounds):
        members = collections.defaultdict(list)
        for _, v in kept:
            members[nearest(v)[1]].append(v)
        places = [[sum(x) // len(members[c]) for x in zip(*members[c])] if members[c] else p for c, p in enumerate(places)]
    found = [(i, *nearest(v)[::-1]) for i, v in kept]
    share = collections.Counter()
    for _, c, d in found:
        share[c] += d
    return [(i, c, d, share[c], sum(share.values()), tuple(places[c])) for i, c, d in found]
