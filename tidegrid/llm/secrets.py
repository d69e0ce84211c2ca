"""Secret scan: fixed patterns, and sliding-window Shannon entropy over candidate strings.

Built-in functions only, one pass over the table, no shuffle. Texts without any candidate are
told apart by a plain search, and only the others are taken apart.

Entropy method: a run is a maximal string of token characters. Its parts, between the separators
``= / _ -``, are candidates, each with a class and an allow list check of its own, so a name or a
path before a key says nothing about the key; a run with separators is a candidate as a whole,
too, because encoded keys may contain them. A window of ``WINDOW`` characters slides over a
candidate. The counts of its symbols are kept incrementally (one symbol enters, one leaves), and
with them the sum of ``c * log2(c)``, which gives the window's entropy as ``log2(W) - sum / W``. Each
character class has its own threshold. A part of hexadecimal digits is a span as a whole if one
window reaches it; otherwise the span runs from the first to the end of the last window at or
over it. Candidates on the allow list (placeholders, identifiers, plain words and numbers) give
no span. Spans of a run that overlap are joined; what fixed patterns cover is cut out, and pieces
of at least ``WINDOW`` characters stay.

Defined results: null text counts as empty and gives no span; positions are code points, ends
exclusive; every row gives one row (repeated rows too); an empty table gives an empty result;
further columns are ignored.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidegrid.llm.common import ids_and_texts

# The patterns of the base kinds and their least lengths.
ASSIGN = (r"""(?i:password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", 12)
ACCESS = (r"AKIA[A-Z0-9]+", 18)
HEX = (r"[0-9a-f]+", 16)
KINDS = ("assign", "access", "hex", "entropy")

#: Entropy candidates: maximal runs of at least WINDOW of these characters.
CANDIDATE = r"(?<![A-Za-z0-9+/_=-])[A-Za-z0-9+/_=-]{20,}"
WINDOW = 20
#: What parts a run into candidates.
SEPARATOR = r"[=/_-]"
#: Least bits per symbol by class: hexadecimal digits alone; letters and digits mixed.
THRESHOLDS = {"hex": 3.0, "mixed": 3.7}
#: Strings that are no secrets: words, numbers, UUIDs, placeholders, counting sequences, paths of words.
ALLOWED = (r"^[A-Za-z+/_=-]+$|^[0-9+/_=-]+$"
           r"|^[0-9A-Fa-f]{8}-[0-9A-Fa-f]{4}-[0-9A-Fa-f]{4}-[0-9A-Fa-f]{4}-[0-9A-Fa-f]{12}$"
           r"|(?i:example|sample|placeholder|changeme|dummy|xxxx)|0123456789|abcdefgh|ABCDEFGH")

_CHUNK = 256
_SPAN = "array<struct<start:int,rank:int,stop:int,body:string>>"


def _positions(text: Column, pattern: str, rank: int, width: Column, bodies: Column) -> Column:
    """All matches in order as (start, rank, stop, body).

    The text between the matches gives the distances: a running sum over the pieces and widths.
    Spans are gathered in chunks, so that a text of very many matches costs no quadratic copying.
    """
    gaps = F.transform(F.split(text, pattern, -1), lambda p: F.length(p))
    steps = F.arrays_zip(gaps.alias("gap"), width.alias("width"), bodies.alias("body"))
    zero = F.struct(F.lit(0).alias("at"), F.array().cast(_SPAN).alias("chunk"),
                    F.array().cast(f"array<{_SPAN}>").alias("done"))

    def step(acc: Column, x: Column) -> Column:
        start = acc["at"] + x["gap"]
        span = F.struct(start.alias("start"), F.lit(rank).alias("rank"), (start + x["width"]).alias("stop"),
                        x["body"].alias("body"))
        full = F.size(acc["chunk"]) >= _CHUNK
        return F.struct(
            (start + F.coalesce(x["width"], F.lit(0))).alias("at"),
            F.when(x["width"].isNull(), acc["chunk"]).when(full, F.array(span))
            .otherwise(F.concat(acc["chunk"], F.array(span))).alias("chunk"),
            F.when(full, F.concat(acc["done"], F.array(acc["chunk"]))).otherwise(acc["done"]).alias("done"),
        )

    return F.aggregate(steps, zero, step, lambda acc: F.concat(F.flatten(acc["done"]), acc["chunk"]))


def _matches(pattern: str, least: int, rank: int, group: int = 0) -> Column:
    """Spans of a pattern whose group has the least length; null where the text has no match."""
    text = F.when(F.col("text").rlike(pattern), F.col("text"))
    all_of = F.regexp_extract_all(text, F.lit(pattern), F.lit(0))
    bodies = all_of if group == 0 else F.regexp_extract_all(text, F.lit(pattern), F.lit(group))
    spans = _positions(text, pattern, rank, F.transform(all_of, lambda m: F.length(m)), bodies)
    return F.filter(spans, lambda s: F.length(s["body"]) >= least)


def _entropy_range(body: Column) -> Column:
    """(first, last) index of the window starts whose entropy reaches the threshold of the class."""
    gain = F.array(*[F.lit(c * math.log2(c) - (c - 1) * math.log2(c - 1) if c > 1 else 0.0) for c in range(1, WINDOW + 2)])
    least = F.when(body.rlike(r"^[0-9A-Fa-f]+$"), F.lit(THRESHOLDS["hex"])).otherwise(F.lit(THRESHOLDS["mixed"]))
    # A window reaches the threshold while its sum of c log2 c stays at or under this.
    most = WINDOW * (F.lit(math.log2(WINDOW)) - least) + 1e-9
    symbols = F.filter(F.split(body, ""), lambda c: c != "")
    unseen = F.map_from_arrays(F.array_distinct(symbols), F.transform(F.array_distinct(symbols), lambda c: F.lit(0)))
    zero = F.struct(unseen.alias("counts"), F.lit(0.0).alias("sum"), F.lit(-1).alias("first"), F.lit(-1).alias("last"))

    def step(acc: Column, i: Column) -> Column:
        enters = F.substring(body, i, F.lit(1))
        full = i > WINDOW
        leaves = F.substring(body, F.greatest(i - WINDOW, F.lit(1)), F.lit(1))
        out = F.when(full, F.element_at(gain, F.element_at(acc["counts"], leaves))).otherwise(0.0)
        same = F.when(full & (enters == leaves), 1).otherwise(0)
        into = F.element_at(gain, F.element_at(acc["counts"], enters) - same + 1)
        total = acc["sum"] - out + into
        hit = (i >= WINDOW) & (total <= most)
        return F.struct(
            F.transform_values(acc["counts"], lambda k, v: v + F.when(k == enters, 1).otherwise(0)
                               - F.when(full & (k == leaves), 1).otherwise(0)).alias("counts"),
            total.alias("sum"),
            F.when(hit & (acc["first"] < 0), i - WINDOW).otherwise(acc["first"]).alias("first"),
            F.when(hit, i - WINDOW).otherwise(acc["last"]).alias("last"),
        )

    return F.aggregate(F.sequence(F.lit(1), F.length(body)), zero, step,
                       lambda acc: F.struct(acc["first"].alias("first"), acc["last"].alias("last")))


_RANGE = "array<struct<start:int,stop:int>>"


def _run_spans(body: Column) -> Column:
    """Spans inside one run, from 0, joined where they overlap and in order."""
    def judged(text: Column) -> Column:
        return F.when((F.length(text) >= WINDOW) & ~text.rlike(ALLOWED), _entropy_range(text))

    parts = F.transform(F.split(body, SEPARATOR, -1), lambda p: F.struct(
        F.length(p).alias("n"), p.rlike(r"^[0-9A-Fa-f]+$").alias("hex"), judged(p).alias("r")))
    zero = F.struct(F.lit(0).alias("at"), F.array().cast(_RANGE).alias("spans"))

    def step(acc: Column, x: Column) -> Column:
        start = acc["at"] + F.when(x["hex"], 0).otherwise(x["r"]["first"])
        stop = acc["at"] + F.when(x["hex"], x["n"]).otherwise(x["r"]["last"] + WINDOW)
        span = F.array(F.struct(start.alias("start"), stop.alias("stop")))
        return F.struct((acc["at"] + x["n"] + 1).alias("at"),
                        F.when(x["r"]["first"] >= 0, F.concat(acc["spans"], span)).otherwise(acc["spans"]).alias("spans"))

    own = F.transform(F.array(F.when(body.rlike(SEPARATOR), judged(body))), lambda r: F.struct(
        r["first"].alias("start"), (r["last"] + WINDOW).alias("stop")))
    spans = F.concat(F.filter(own, lambda s: s["start"] >= 0), F.aggregate(parts, zero, step, lambda acc: acc["spans"]))

    def join(acc: Column, x: Column) -> Column:
        """The last span of the list grows, or a new one begins."""
        last = F.element_at(acc, -1)
        grown = F.struct(last["start"].alias("start"), F.greatest(last["stop"], x["stop"]).alias("stop"))
        apart = (F.size(acc) == 0) | (x["start"] >= F.try_element_at(acc, F.lit(-1))["stop"])
        return F.when(apart, F.concat(acc, F.array(x))).otherwise(F.concat(F.slice(acc, 1, F.size(acc) - 1), F.array(grown)))

    return F.aggregate(F.array_sort(spans), F.array().cast(_RANGE), join)


def _entropy_spans() -> Column:
    runs = F.transform(_matches(CANDIDATE, WINDOW, 3), lambda s: F.struct(s["start"].alias("start"), _run_spans(s["body"]).alias("spans")))
    found = F.filter(runs, lambda r: F.size(r["spans"]) > 0)
    return F.flatten(F.transform(found, lambda r: F.transform(r["spans"], lambda s: F.struct(
        (r["start"] + s["start"]).alias("start"), F.lit(3).alias("rank"), (r["start"] + s["stop"]).alias("stop"), F.lit("").alias("body")))))


def _without(span: Column, taken: Column) -> Column:
    """What ``taken`` (in order) leaves of a span: pieces of at least WINDOW characters."""
    meeting = F.filter(taken, lambda b: (b["start"] < span["stop"]) & (span["start"] < b["stop"]))
    zero = F.struct(span["start"].alias("at"), F.array().cast(_RANGE).alias("pieces"))

    def piece(acc: Column, stop: Column) -> Column:
        one = F.array(F.struct(acc["at"].alias("start"), stop.alias("stop")))
        return F.when(stop - acc["at"] >= WINDOW, F.concat(acc["pieces"], one)).otherwise(acc["pieces"])

    def step(acc: Column, b: Column) -> Column:
        return F.struct(F.greatest(acc["at"], b["stop"]).alias("at"), piece(acc, b["start"]).alias("pieces"))

    pieces = F.aggregate(meeting, zero, step, lambda acc: piece(acc, span["stop"]))
    return F.transform(pieces, lambda p: F.struct(p["start"].alias("start"), F.lit(3).alias("rank"), p["stop"].alias("stop"), F.lit("").alias("body")))


def scan_secrets(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``(doc_id, assign, access, hex, entropy)``: arrays of spans per kind, each by start."""
    def named(spans: Column) -> Column:
        return F.coalesce(spans, F.array().cast(_SPAN))

    found = ids_and_texts(docs, id_col, text_col).select(
        "doc_id", named(_matches(*ASSIGN, 0, 1)).alias("assign"), named(_matches(*ACCESS, 1)).alias("access"),
        named(_matches(rf"{HEX[0][:-1]}{{{HEX[1]},}}", HEX[1], 2)).alias("hex"), named(_entropy_spans()).alias("entropy"))

    def bare(spans: Column) -> Column:
        return F.transform(spans, lambda s: F.struct(s["start"], s["rank"], s["stop"]))

    found = found.withColumn("base", F.array_sort(F.concat("assign", "access", "hex")))
    fresh = F.flatten(F.transform("entropy", lambda e: _without(e, F.col("base"))))
    return found.select("doc_id", bare(F.col("assign")).alias("assign"), bare(F.col("access")).alias("access"),
                        bare(F.col("hex")).alias("hex"), bare(fresh).alias("entropy"))


def spans_as_text(*columns: str) -> Column:
    """``kind:start:end`` by start, then kind in the order of KINDS, comma-joined."""
    names = F.array(*[F.lit(k) for k in KINDS])
    ordered = F.array_sort(F.concat(*columns))
    return F.array_join(F.transform(ordered, lambda s: F.concat_ws(
        ":", F.element_at(names, s["rank"] + 1), s["start"].cast("string"), s["stop"].cast("string"))), ",")
