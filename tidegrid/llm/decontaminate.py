"""Benchmark decontamination with a distributed positional inverted index.

Built-in functions only. Three passes over the documents:

1. occurrences of every benchmark term (summed before the shuffle, at most one row per term);
2. the index: postings ``(term, doc_id, position)`` of the terms that the search needs, the two
   rarest of each window, stored. Their lists are shifted by the term's offset in the window and
   intersected: where both give the same document and start, the window may stand there;
3. each document with candidates is compared with the whole windows, word by word, which makes the
   result exact whatever the index let through.

The benchmark is a query set: it is searched in blocks of at most ``BLOCK`` rows, and only a block
(a size that does not grow) is broadcast. Documents are never paired with each other.

Defined results: null texts have no words; an item of fewer words than a window is one window, an
item without words none; a null ``item_id`` marks words as hit and is not counted among the items;
rows of one ``item_id`` are one item; every document row is judged by its own text, also where
``doc_id`` is null or repeated; empty tables work; further columns are ignored or kept untouched.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tidegrid.llm.common import store, text_of

#: Rows of the query side (terms or windows) that are broadcast at once.
BLOCK = 200_000

#: What separates words, before lower-casing A-Z (after it, A-Z are separators too, but gone).
SEPARATORS = r"[\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+"
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


def _pieces(text: Column) -> Column:
    """Words in order, with an empty string where the text begins or ends with a separator."""
    return F.split(text, SEPARATORS, -1)


def _n_words(pieces: Column) -> Column:
    edges = F.when(pieces[0] == "", 1).otherwise(0) + F.when(F.element_at(pieces, -1) == "", 1).otherwise(0)
    return F.greatest(F.size(pieces) - edges, F.lit(0)).cast("long")


def _term(word: Column) -> Column:
    """Key of a word in the index. Equal words have equal keys; the final comparison is exact."""
    return F.xxhash64(F.lower(word))


def benchmark_windows(items: DataFrame, window: int, id_col: str = "item_id", text_col: str = "text") -> DataFrame:
    """Distinct windows: ``(phrase_id, phrase array<string>, items array<string>)``."""
    words = F.filter(_pieces(F.translate(text_of(text_col), UPPER, LOWER)), lambda w: w != "")
    rows = items.select(F.col(id_col).cast("string").alias("item"), words.alias("words")).filter(F.size("words") > 0)
    starts = F.sequence(F.lit(1), F.greatest(F.size("words") - window + 1, F.lit(1)))
    spread = rows.select("item", "words", F.explode(starts).alias("at"))
    phrases = spread.select("item", F.slice("words", F.col("at"), window).alias("phrase"))
    return phrases.groupBy("phrase").agg(F.collect_set("item").alias("items")).select(
        F.xxhash64("phrase").alias("phrase_id"), "phrase", "items")


def _blocks(df: DataFrame, key: str) -> Iterator[DataFrame]:
    """A stored query-side table in parts of about BLOCK rows at most, each small enough to broadcast."""
    n = -(-df.count() // BLOCK)
    for k in range(n):
        yield df if n == 1 else df.filter(F.pmod(F.xxhash64(key), F.lit(n)) == k)


def _tokens(docs: DataFrame, id_col: str, text_col: str) -> DataFrame:
    """``(doc_id, position, term)`` of every word."""
    words = docs.select(F.col(id_col).alias("doc_id"), F.posexplode(_pieces(text_of(text_col))).alias("position", "word"))
    return words.select("doc_id", "position", _term(F.col("word")).alias("term"))


def _union(parts: list[DataFrame]) -> DataFrame:
    return reduce(DataFrame.unionByName, parts)


def _edits_of(size: Column, edits: int) -> Column:
    """Words that may be missing of a window: ``edits``, but one of five at most."""
    return F.least(F.lit(edits), F.floor(size / 5).cast("int"))


def _marks(words: Column, phrase: Column) -> Column:
    """For each word, the places of the phrase where it stands, as bits."""
    places = F.transform(phrase, lambda w, k: F.struct(w.alias("w"), F.expr("1L").alias("one"), k.alias("k")))
    return F.transform(words, lambda word: F.aggregate(
        places, F.lit(0).cast("long"),
        lambda bits, p: F.when(p["w"] == word, bits.bitwiseOR(F.call_function("shiftleft", p["one"], p["k"]))).otherwise(bits)))


def _in_order(marks: Column, size: Column) -> Column:
    """Length of the longest common subsequence with a phrase, from the marks of some words: one sum per word."""
    ones = F.call_function("shiftleft", F.lit(1).cast("long"), size) - 1

    def word(open_bits: Column, mark: Column) -> Column:
        met = open_bits.bitwiseAND(mark)
        return (open_bits + met).bitwiseOR(open_bits - met).bitwiseAND(ones)

    return size - F.bit_count(F.aggregate(marks, ones, word))


def index_candidates(docs: DataFrame, windows: DataFrame, id_col: str = "doc_id", text_col: str = "text",
                     edits: int | None = None) -> DataFrame:
    """``(doc_id, start, phrase_id)`` where the two rarest terms of a window stand at its distances.

    With ``edits``, ``start`` is where one of the rarest terms stands: of the terms that occur, one more is
    looked up than may be missing, so each place with so many words missing is found by one at least.
    """
    spread = windows.select("phrase_id", F.posexplode("phrase").alias("offset", "word"))
    places = store(spread.select("phrase_id", "offset", _term(F.col("word")).alias("term")))
    terms = store(places.select("term").distinct())
    tokens = _tokens(docs, id_col, text_col)
    counted = [tokens.select("term").join(F.broadcast(block), "term").groupBy("term").count()
               for block in _blocks(terms, "term")]
    if not counted:
        return tokens.select("doc_id", F.col("position").alias("start"), F.col("term").alias("phrase_id")).limit(0)
    frequency = store(_union(counted))

    # The two rarest places of each window; a window with a term that never occurs cannot occur.
    ranked = places.join(frequency, "term", "left").groupBy("phrase_id").agg(
        F.array_sort(F.collect_list(F.struct(F.coalesce("count", F.lit(0)).alias("n"), "offset", "term"))).alias("by_count"))
    if edits is None:
        possible, looked_up = ranked.filter(F.col("by_count")[0]["n"] > 0), F.lit(2)
    else:
        # Terms that never occur are missing in any case.
        occurring = F.filter("by_count", lambda t: t["n"] > 0)
        left = _edits_of(F.size("by_count"), edits) - F.size("by_count") + F.size("occurring")
        possible = ranked.withColumn("occurring", occurring).withColumn("left", left).filter("left >= 0")
        possible, looked_up = possible.select("phrase_id", F.col("occurring").alias("by_count"), "left"), F.col("left") + 1
    seeds = store(possible.select("phrase_id", F.size("by_count").alias("size"),
                                  F.posexplode(F.slice("by_count", F.lit(1), looked_up)).alias("rank", "seed"))
                  .select("phrase_id", F.least("size", F.lit(2)).alias("needed"), "rank", "seed.offset", "seed.term"))

    wanted = store(seeds.select("term").distinct())
    lists = [tokens.join(F.broadcast(block), "term") for block in _blocks(wanted, "term")]
    if not lists:
        return tokens.select("doc_id", F.col("position").alias("start"), F.col("term").alias("phrase_id")).limit(0)
    postings = store(_union(lists))

    found = []
    for block in _blocks(seeds, "phrase_id"):
        start = (F.col("position") - F.col("offset")).alias("start")
        shifted = postings.join(F.broadcast(block), "term").select("doc_id", "phrase_id", "rank", "needed", start)
        if edits is not None:
            # Few bytes are dealt by document; what they multiply to stays where it is.
            found.append(postings.repartition("doc_id").join(F.broadcast(block), "term").select(
                "doc_id", F.col("position").alias("start"), "phrase_id"))
            continue
        flags = F.bit_or(F.col("rank") + 1)  # 1 for the rarest, 2 for the second
        both = shifted.groupBy("doc_id", "phrase_id", "start").agg(flags.alias("seen"), F.first("needed").alias("needed"))
        found.append(both.filter("seen = 2 * needed - 1").select("doc_id", "start", "phrase_id"))
    return _union(found)


def _searched(docs: DataFrame, items: DataFrame, window: int, id_col: str, text_col: str) -> DataFrame:
    """``(row, n_words, hits array<start, size, items>)`` for every row of ``docs``."""
    windows = store(benchmark_windows(items, window))
    candidates = store(index_candidates(docs, windows, id_col, text_col))
    named = [candidates.join(F.broadcast(block), "phrase_id") for block in _blocks(windows, "phrase_id")]
    rows = docs.select(F.struct("*").alias("row"), F.col(id_col).alias("id"), _pieces(text_of(text_col)).alias("pieces"))
    if not named:
        hits = F.array().cast("array<struct<start:int,size:int,items:array<string>>>")
        return rows.select("row", _n_words(F.col("pieces")).alias("n_words"), hits.alias("hits"))
    per_doc = _union(named).groupBy("doc_id").agg(F.collect_set(F.struct("start", "phrase", "items")).alias("places"))
    rows = docs.select(F.struct("*").alias("row"), F.col(id_col).alias("id"))
    joined = rows.join(per_doc, rows["id"].eqNullSafe(per_doc["doc_id"]), "left")
    split = joined.select("row", "places", _pieces(text_of(f"row.{text_col}")).alias("pieces"))

    def stands(place: Column) -> Column:
        there = F.slice("pieces", place["start"] + 1, F.size(place["phrase"]))
        return (place["start"] >= 0) & (F.transform(there, lambda w: F.translate(w, UPPER, LOWER)) == place["phrase"])

    hits = F.transform(F.filter("places", stands), lambda p: F.struct(
        p["start"].alias("start"), F.size(p["phrase"]).alias("size"), p["items"].alias("items")))
    return split.select("row", _n_words(F.col("pieces")).alias("n_words"),
                        F.coalesce(F.array_sort(hits), F.array()).alias("hits"))


def find_contamination(docs: DataFrame, items: DataFrame, window: int = 10, id_col: str = "doc_id",
                       text_col: str = "text") -> DataFrame:
    """``(doc_id, n_words, n_hit, items, hits)``: exact occurrences of benchmark windows.

    ``hits`` holds start (in pieces of the text), size in words and items of each; ``n_hit`` the
    words inside any of them.
    """
    found = _searched(docs, items, window, id_col, text_col)
    covered = F.aggregate(
        "hits", F.struct(F.lit(0).alias("upto"), F.lit(0).alias("n")),
        lambda acc, h: F.struct(
            F.greatest(acc["upto"], h["start"] + h["size"]).alias("upto"),
            (acc["n"] + F.greatest(h["start"] + h["size"] - F.greatest(acc["upto"], h["start"]), F.lit(0))).alias("n")),
        lambda acc: acc["n"].cast("long"))
    items_of = F.array_sort(F.array_distinct(F.flatten(F.transform("hits", lambda h: h["items"]))))
    return found.select(F.col(f"row.{id_col}").alias("doc_id"), "n_words", covered.alias("n_hit"),
                        items_of.alias("items"), "hits")


def drop_contaminated(docs: DataFrame, items: DataFrame, window: int = 10, id_col: str = "doc_id",
                      text_col: str = "text") -> DataFrame:
    """``docs`` without the rows in which a window of the benchmark occurs; all columns stay."""
    found = _searched(docs, items, window, id_col, text_col)
    return found.filter(F.size("hits") == 0).select("row.*")


def proximity_matches(docs: DataFrame, items: DataFrame, window: int = 10, slack: int = 3, edits: int = 2,
                      id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``(doc_id, start, stop, phrase, items)``: altered passages that no exact phrase finds, one row per place.

    A stretch of ``slack`` words more than the window counts where it begins with a word of the window and
    holds all its words but ``edits`` (one of five at most) in its order. Stretches that overlap
    are one place, from the first word to behind the last one that belongs to the window. Which places
    there are depends on text and window alone, not on which words are rare. Rows of one id with
    different texts have places of their own, equal rows have them once.
    """
    if window > 60:
        raise ValueError("a window has 60 words at most")
    windows = store(benchmark_windows(items, window))
    near = index_candidates(docs, windows, id_col, text_col, edits)
    blocks = list(_blocks(windows, "phrase_id"))
    if not blocks:
        nothing = F.array().cast("array<string>")
        return near.select("doc_id", "start", F.col("start").alias("stop"), nothing.alias("phrase"), nothing.alias("items"))
    # Texts and candidates meet by id alone; the phrases come to them behind the shuffle.
    per_doc = near.groupBy("doc_id").agg(F.collect_list(F.struct("start", "phrase_id")).alias("places"))
    texts = docs.select(F.col(id_col).alias("id"), text_of(text_col).alias("text"))
    lists = texts.join(per_doc, texts["id"].eqNullSafe(per_doc["doc_id"])).select(
        "doc_id", F.xxhash64("text").alias("of"), "places", _pieces(F.translate("text", UPPER, LOWER)).alias("pieces"))
    lists = lists.withColumn("terms", F.transform("pieces", lambda w: F.xxhash64(w)))
    reach, seed = window + slack, F.col("place.start")
    begin = F.greatest(seed - reach + 1, F.lit(0))
    around = lists.select("doc_id", "of", "pieces", "terms", F.explode("places").alias("place")).select(
        "doc_id", "of", "place.phrase_id", begin.alias("begin"), (seed - begin).alias("upto"),
        *[F.slice(c, begin + 1, seed - begin + reach).alias(name) for c, name in (("pieces", "words"), ("terms", "terms"))])

    def stretches(block: DataFrame) -> DataFrame:
        """``(doc_id, of, phrase_id, start, stop)`` of the stretches that hold a candidate's word."""
        phrases = block.select("phrase_id", "phrase", F.transform("phrase", lambda w: F.xxhash64(w)).alias("wanted"))
        near_it = around.join(F.broadcast(phrases), "phrase_id")
        # Most candidates lack more words than may be missing, which their keys tell at little cost.
        likely = F.size(F.array_except("wanted", "terms")) <= _edits_of(F.size("wanted"), edits)
        marked = near_it.filter(likely).select(
            "doc_id", "of", "phrase_id", "begin", "upto", F.size("phrase").alias("size"),
            _marks(F.col("words"), F.col("phrase")).alias("marks"))
        size = F.col("size")
        needed = size - _edits_of(size, edits)
        there = F.aggregate("marks", F.lit(0).cast("long"), lambda bits, m: bits.bitwiseOR(m))
        from_word = lambda at: F.slice("marks", at + 1, size + slack)
        first = F.greatest(F.lit(0), F.col("upto") - size - slack + 1)
        found = F.when(F.bit_count(there) >= needed, F.filter(
            F.sequence(first, F.col("upto")),
            lambda at: (F.get("marks", at) != 0) & (_in_order(from_word(at), size) >= needed)))
        ended = F.transform(found, lambda at: F.struct(at.alias("at"), (at + F.size(from_word(at)) + 1 - F.array_position(
            F.transform(F.reverse(from_word(at)), lambda m: m != 0), True)).alias("stop")))
        return marked.select("doc_id", "of", "phrase_id", "begin", "size", F.explode(ended).alias("s")).select(
            "doc_id", "of", "phrase_id", (F.col("begin") + F.col("s.at")).cast("long").alias("start"),
            (F.col("begin") + F.col("s.stop")).cast("long").alias("stop"), (size + slack).alias("reach"))

    every = _union([stretches(block) for block in blocks])
    along = Window.partitionBy("doc_id", "of", "phrase_id").orderBy("start")
    apart = F.coalesce(F.col("start") - F.lag("start").over(along) >= F.col("reach"), F.lit(True))
    numbered = every.withColumn("opens", apart.cast("int")).withColumn(
        "place", F.sum("opens").over(along.rowsBetween(Window.unboundedPreceding, 0)))
    places = numbered.groupBy("doc_id", "of", "phrase_id", "place").agg(F.min("start").alias("start"), F.max("stop").alias("stop"))
    return places.join(windows, "phrase_id").select("doc_id", "start", "stop", "phrase", "items").distinct()
