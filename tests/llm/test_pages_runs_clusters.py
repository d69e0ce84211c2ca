"""Main text of pages, periodic runs and centroid clusters on awkward and made tables."""

import html
import random
import re

import numpy as np
import pytest
from brute import circled, clusters, collapsed, runs
from pyspark.sql import functions as F

from tidegrid.llm import clustering, html_extract, periodic
from tidegrid.llm.common import ids_and_texts
from tidegrid.llm.html_blocks import Features, leaf_blocks
from tidegrid.llm.queries import QUERIES


def listed(rows):
    return sorted((tuple(tuple(x) if isinstance(x, list) else x for x in r) for r in rows), key=repr)


# --- main text ------------------------------------------------------------------------


@pytest.fixture(scope="session")
def model(spark):
    return html_extract.train_extractor(html_extract.labelled_pages(spark))


def blocks_of(page):
    return [text for text, _ in leaf_blocks(page, Features())]


def test_blocks_of_sloppy_markup():
    page = ("<!DOCTYPE html><title>no</title><!-- <p>no --><!--><body><P>one &amp&eacute; <b>bold<br><p>two\n\t three"
            "<ul><li>four<li>f<i>iv</i>e</ul></div>six<script>var t='</p>';</SCRIPT ><td>seven<th>eight</table>"
            "<p title='a > b'>nine &am<hr>ten<style>no")
    assert blocks_of(page) == ["one &é bold", "two three", "four", "five", "six", "seven", "eight", "nine &am", "ten"]
    assert blocks_of("") == blocks_of("<p></p><!-- never closed <p>no") == []
    assert blocks_of("plain < text <a href=\"x>cut") == ["plain < text cut"]


def test_deep_and_long_pages_are_linear(model):
    decoder = html_extract.Decoder(model)
    assert decoder.main_text("<div>" * 200_000 + "</p>" * 200_000) == ""
    page = "<article>" + "<p>A word, and another one.</p>" * 50_000 + "</article>"
    assert decoder.main_text(page).count("\n") == 49_999


def test_held_out_labelled_pages(model):
    """Pages the field has not seen: nearly every block has the right label."""
    decoder = html_extract.Decoder(model)
    right = total = 0
    for number in range(5000, 5200):
        page, main = html_extract._Page(number).build()
        chain = leaf_blocks(page, decoder.features)
        want = html_extract._labels(chain, main)
        assert want.sum() == len(main)
        got = html_extract._labels(chain, decoder.main_text(page).split("\n"))
        right, total = right + (got == want).sum(), total + len(want)
    assert right / total > 0.97


def test_labels_do_not_depend_on_arrival_and_empty_labels_train_nothing(spark):
    some = html_extract.labelled_pages(spark, 60)
    assert html_extract.train_extractor(some) == html_extract.train_extractor(some.repartition(7))
    assert html_extract.train_extractor(some.limit(0)) == {}
    assert html_extract.Decoder({}).main_text("<p>text") == ""


def article_of(page):
    """The text of a page of the supplied tables, whose main text stands in one article element."""
    inner = re.search(r"<article>(.*?)</article>", page or "", re.S)
    parts = re.split(r"</?(?:h1|p)>", inner[1]) if inner else []
    return "\n".join(x for x in (" ".join(html.unescape(re.sub(r"<[^>]*>", "", part)).split()) for part in parts) if x)


def test_supplied_pages(spark, sf):
    pages = {r["page_id"]: r["html"] for r in spark.read.parquet(f"{sf}/pages.parquet").collect()}
    found = QUERIES["op11_html_extract"](spark, sf).collect()
    assert len(found) == len(pages)
    assert all(r["text"] == article_of(pages[r["page_id"]]) and r["n_chars"] == len(r["text"]) for r in found)


def test_awkward_pages(spark, model):
    page = "<nav><a href=1>Menu</a></nav><article><h1>Head</h1><p>Body, with words.</p></article>"
    rows = [(1, "u", page), (1, "u", page), (2, None, None), (None, "v", ""), (3, "w", "<div"), (4, "x", page + "<p>" + "z" * 300_000)]
    pages = spark.createDataFrame(rows, "page_id long, url string, html string").withColumn("text", F.lit("extra"))
    found = listed(html_extract.extract_text(pages, model).select("page_id", "url", "text").collect())
    want = [(i, u, "Head\nBody, with words." if h and h.startswith("<nav") else "") for i, u, h in rows]
    assert [r[:2] for r in found] == [r[:2] for r in listed(want)]
    assert listed(r for r in found if r[0] in (1, 2, 3, None)) == listed(r for r in want if r[0] in (1, 2, 3, None))
    assert html_extract.extract_text(pages.limit(0), model).collect() == []


# --- periodic runs --------------------------------------------------------------------


def runs_by_words(text, **patched):
    return next(periodic._results([text.encode().split()]))


@pytest.mark.parametrize("seed", range(40))
def test_runs_of_random_words(seed):
    """Small alphabets, planted periods with slips, nested and neighbouring runs."""
    rng = random.Random(seed)
    parts = []
    for _ in range(rng.randint(1, 5)):
        p = rng.choice((1, 2, 3, 5, 7, 8, 9, 13, 15, 16, 17, 31, 32, 33, 50))
        unit = [rng.choice("abc" if rng.random() < 0.5 else "abcdefghij") for _ in range(p)]
        if rng.random() < 0.4 and p > 8:
            unit[: p - 1] = [unit[0]] * (p - 1)
        parts += (unit * 60)[: int(p * rng.choice((2.5, 3, 3.4, 4, 7)) + rng.choice((0, 1, 20)))]
        parts += [rng.choice("abcxyz") for _ in range(rng.randint(0, 30))]
    text = " ".join(parts)
    want = runs(text)
    got, left = runs_by_words(text)
    assert got == want
    assert left.decode() == collapsed(text, want)


def test_runs_with_hashes_that_collide(monkeypatch):
    """Hashes only spare work: with useless ones the runs are the same."""
    monkeypatch.setattr(periodic._Prefixes, "_same", lambda self, i, d, length: np.ones(len(i), bool))
    text = " ".join(["x"] + ["a", "b", "c"] * 9 + ["y", "a"] * 13 + ["z"])
    assert runs_by_words(text)[0] == runs(text)


def test_a_very_long_repetition_is_fast():
    words = b"w " * 400_000 + b"end"
    (found, left), = periodic._results([words.split()])
    assert found == [(0, 400_000, 1)] and left == b"w end"


@pytest.mark.parametrize("largest", [3, 60_000, 1 << 40])
def test_transform_finds_exactly_the_copies(largest):
    """One, two and three primes; word numbers that differ by a multiple of the first prime."""
    rng = np.random.default_rng(1)
    blocks = rng.integers(1, min(largest, 4), (50, 8))
    windows = rng.integers(1, min(largest, 4), (50, 22))
    blocks[:, 0] = windows[:, 5] = largest
    windows[:, 9] = max(largest - periodic.PRIMES[0][0], 1)
    windows[3, 12:20], windows[4, 5:13] = blocks[3], blocks[4]
    want = np.array([[np.array_equal(b, w[s : s + 8]) for s in range(15)] for b, w in zip(blocks, windows)])
    assert want.any() and np.array_equal(periodic.zero_mismatches(blocks, windows, largest), want)


def test_runs_of_awkward_texts(spark, awkward, nothing):
    docs = awkward.unionByName(awkward.limit(3)).withColumn("runs", F.lit("extra"))
    got = [(r["doc_id"], tuple(map(tuple, r["runs"])), r["collapsed"]) for r in periodic.periodic_runs(docs).collect()]
    want = []
    for i, t in map(tuple, ids_and_texts(docs).collect()):
        found = runs(t) if len(t) < 50_000 else []
        want.append((i, tuple(found), collapsed(t, found)))
    assert sorted(got, key=repr) == sorted(want, key=repr)
    assert periodic.periodic_runs(nothing).collect() == []


def test_cycles_and_strongest_run(spark, sf):
    docs = spark.read.parquet(f"{sf}/documents.parquet")
    rows = [tuple(r) for r in ids_and_texts(docs).collect()] + [(None, "a b"), (6, None), (6, "one"), (51, "")]
    table = spark.createDataFrame(rows, "doc_id long, text string")
    want = [(i, circled(i, t)) for i, t in rows]
    assert sorted(map(tuple, periodic.with_cycles(table).collect()), key=repr) == sorted(want, key=repr)
    found = {r["doc_id"]: r for r in QUERIES["op12_periodic_runs"](spark, sf).collect()}
    for i, t in want[: len(rows) - 4]:
        if len(t) > 20_000:
            continue
        all_runs = runs(t)
        best = min(all_runs, key=lambda r: (-r[1] / r[2], r[0], r[2]), default=(None,) * 3)
        assert found[i]["n_runs"] == len(all_runs) and tuple(found[i])[2:5] == best
    assert any(r["n_runs"] for r in found.values())


# --- centroid clusters ----------------------------------------------------------------


def vectors(seed=1):
    """Groups of vectors, copies, ties half-way between others, and rows that are no whole vectors."""
    rng = random.Random(seed)
    centres = [[rng.uniform(-1, 1) for _ in range(64)] for _ in range(9)]
    rows = []
    for i in range(260):
        c = centres[0 if i % 3 == 0 else rng.randrange(9)]
        rows.append((i, [x + rng.gauss(0, 0.2) for x in c]))
    rows += [(300 + k, rows[k][1]) for k in range(40)] + [(5, rows[7][1]), (5, rows[5][1]), (None, rows[9][1]), (None, rows[2][1])]
    rows += [(400 + k, [(a + b) / 2 for a, b in zip(rows[k][1], rows[k + 1][1])]) for k in range(30)]
    bad = [None, [], [0.0] * 63, [0.0] * 65, [None] + [0.0] * 63, [float("nan")] + [0.0] * 63, [float("-inf")] + [0.0] * 63]
    return rows + [(500 + k, v) for k, v in enumerate(bad)]


def clustered(df, **how):
    found = clustering.cluster_vectors(df, **how)
    return sorted(((r["vec_id"], r["cluster"], r["distance"], r["cluster_inertia"], r["inertia"], tuple(r["centroid"])) for r in found.collect()), key=repr)


@pytest.mark.parametrize("k,rounds", [(16, 3), (16, 0), (1, 2), (5, 8), (2, 3), (1000, 1)])
def test_clusters(spark, k, rounds):
    rows = vectors()
    df = spark.createDataFrame(rows, "vec_id long, embedding array<double>").repartition(5)
    df = df.withColumns({c: F.lit("extra") for c in ("q", "near", "x", "cluster", "distance")})
    assert clustered(df, k=k, rounds=rounds) == sorted(clusters(rows, k, rounds), key=repr)


def test_clusters_of_equal_vectors_and_of_none(spark):
    rows = [(i, [0.25] * 64) for i in range(40)]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<float>")
    assert clustered(df) == sorted(clusters(rows), key=repr)
    assert clustered(df.limit(0)) == []


def test_search_measures_few_distances():
    """The ball and the bounds spare most of the distances a plain scan would measure."""
    rng = np.random.default_rng(2)
    places = rng.integers(-500, 500, (16, 64))
    x = places[rng.integers(0, 16, 5000)] + rng.integers(-40, 40, (5000, 64))
    near, second = np.zeros(5000, np.int32), np.ones(5000, np.int32)
    upper, lower = np.full(5000, np.inf), np.full(5000, -np.inf)
    clustering.shallot(x, near, second, upper, lower, clustering.Centroids(places))
    moved = places + rng.integers(-3, 3, places.shape)
    to = clustering.Centroids(moved, places)
    upper, lower = upper + to.moved[near], lower - to.others_moved[near]
    own, measured = clustering.shallot(x, near, second, upper, lower, to, exact=True)
    plain = ((x[:, None, :] - moved[None]) ** 2).sum(axis=2)
    assert np.array_equal(near, plain.argmin(axis=1)) and np.array_equal(own, plain.min(axis=1))
    assert measured < 5000
