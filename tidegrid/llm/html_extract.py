"""Main text of web pages by a linear-chain conditional random field over leaf blocks.

A page is a chain of leaf blocks, each either main text or not. The field weighs the features
of a block (tags and class words of its ancestors, its own tag, length, share of links, end of
sentence) and the labels of neighbouring blocks. It is trained on labelled pages by maximum
likelihood (forward and backward sums, gradient steps with a quadratic penalty) and decoded by
Viterbi. Weights are rounded to integers, so decoding is exact and ties are ties.

Labelled pages are a table ``(html, blocks)``, ``blocks`` being the texts of the page's main
part in order. :func:`labelled_pages` makes such a table by rule: layouts, markup and class
words as sites use them around invented words of no language.
"""

from __future__ import annotations

import random
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidegrid.llm.common import text_of
from tidegrid.llm.html_blocks import Features, leaf_blocks
from tidegrid.session import ship_package

#: Labelled pages the field is fitted on at most; they are held by one task.
TRAINING_PAGES = 1000

#: Pages with a feature that training asks for, gradient steps, step size, penalty, and units per weight.
LEAST_PAGES, STEPS, RATE, PENALTY, UNITS = 3, 250, 0.15, 1.0, 1024

# --- labelled pages by rule -----------------------------------------------------------
# Names that sites give to parts of their pages.
MAIN_NAMES = ("content", "main-content", "post", "post-content", "entry", "entry-content", "article", "article-body", "story",
              "story-body", "text", "page-content", "body-text", "single-post", "blog-post", "news-article")
SIDE_NAMES = {
    "nav": ("nav", "navbar", "navigation", "menu", "main-menu", "breadcrumb", "breadcrumbs", "topnav", "toc", "pagination", "pager", "tabs"),
    "header": ("header", "masthead", "site-header", "banner", "branding", "top-bar", "logo", "tagline"),
    "footer": ("footer", "site-footer", "copyright", "bottom", "colophon", "legal", "imprint"),
    "aside": ("sidebar", "side", "widget", "related", "related-posts", "recommended", "popular", "recent", "more", "infobox", "right-column"),
    "notice": ("notice", "cookie", "cookie-banner", "consent", "gdpr", "alert", "message", "announcement", "paywall", "warning", "popup", "modal"),
    "ad": ("ad", "ads", "advert", "advertisement", "sponsor", "sponsored", "promo", "promotion", "banner-ad", "adsbygoogle", "commercial"),
    "form": ("form", "search", "search-form", "login", "newsletter", "subscribe", "signup", "contact", "newsletter-signup"),
    "comments": ("comments", "comment", "comment-list", "commentlist", "responses", "replies", "discussion", "disqus", "reader-comments"),
    "share": ("share", "social", "social-links", "sharing", "tags", "meta", "byline", "tools", "print"),
}
SIDE_TAGS = {"nav": "nav", "header": "header", "footer": "footer", "aside": "aside", "form": "form"}


class _Page:
    """One labelled page: its HTML, and the texts of its main blocks."""

    def __init__(self, number: int):
        self.rng = random.Random(f"labelled page {number}")
        self.out: list[str] = []
        self.main: list[str] = []

    def words(self, low: int, high: int, sentence: bool) -> str:
        rng = self.rng
        n = rng.choice((low, rng.randint(low, high), rng.randint(low, max(low, high // 4))))
        w = ["".join(rng.choice("abcdefghijklmnopqrstuvwxyzéüñ") for _ in range(rng.randint(2, 9))) for _ in range(n)]
        if n > 6 and rng.random() < 0.8:
            w[n // 2] += ","
        text = " ".join(w)
        return text[0].upper() + text[1:] + (rng.choice(".......!?") if sentence else "")

    def link(self, text: str) -> str:
        return f'<a href="/{self.rng.randrange(999)}">{text}</a>'

    def block(self, tag: str, text: str, main: bool, close: bool = True) -> None:
        rng, shown = self.rng, text
        if main:
            self.main.append(text)
            if tag == "p" and rng.random() < 0.2:
                w = shown.split(" ")
                k = rng.randrange(len(w))
                w[k] = self.link(w[k]) if rng.random() < 0.5 else f"<em>{w[k]}</em>"
                shown = " ".join(w)
            if tag == "p" and rng.random() < 0.1:
                shown, close = f"<b>{shown}<br>", False
        self.out.append(f"<{tag}>{shown}" + (f"</{tag}>" if close else ""))

    def opened(self, kind: str | None, names: tuple[str, ...], tag: str) -> str:
        """Start tag of a part of the page, plain or with a telling name; returns the tag."""
        rng = self.rng
        semantic = kind in SIDE_TAGS and rng.random() < 0.6
        tag = SIDE_TAGS[kind] if semantic else tag
        if semantic and rng.random() < 0.5:
            self.out.append(f"<{tag}>")
        else:
            name = rng.choice(names)
            if rng.random() < 0.3:
                name += f" {rng.choice(('clearfix', 'row', 'wrap', 'box', 'inner', 'col', 'block'))}"
            self.out.append(f'<{tag} {rng.choice(("class", "class", "id"))}="{name}">')
        return tag

    def side(self, kind: str) -> None:
        """A part that is no main text."""
        rng = self.rng
        tag = self.opened(kind, SIDE_NAMES[kind], rng.choice(("div", "div", "section")))
        if kind in ("nav", "share") or (kind == "aside" and rng.random() < 0.5):
            items = [self.link(self.words(1, 5, False)) for _ in range(rng.randint(2, 9))]
            self.out.append("<ul>" + "".join(f"<li>{x}</li>" for x in items) + "</ul>" if rng.random() < 0.8 else " | ".join(items))
        elif kind == "comments":
            self.block("h3", self.words(1, 3, False), False)
            for _ in range(rng.randint(1, 6)):
                one = rng.choice(("li", "div", "article")) if rng.random() < 0.6 else None
                if one:
                    self.out.append(f'<{one} class="comment">')
                if rng.random() < 0.6:
                    self.block(rng.choice(("span", "cite", "h4")), self.words(1, 3, False), False)
                self.block("p", self.words(2, 60, True), False)
                if one:
                    self.out.append(f"</{one}>")
        elif kind == "form":
            for _ in range(rng.randint(1, 3)):
                self.block(rng.choice(("label", "p", "div")), self.words(1, 12, rng.random() < 0.5), False)
                self.out.append('<input type="text">')
            self.block("button", self.words(1, 2, False), False)
        elif kind == "footer":
            text = self.words(1, 14, rng.random() < 0.5)
            self.out.append(f"&copy; {text}" if rng.random() < 0.6 else f"<p>{text}</p>")
            if rng.random() < 0.4:
                self.out.append(" &middot; ".join(self.link(self.words(1, 2, False)) for _ in range(4)))
        else:
            long = kind in ("ad", "notice", "aside")
            for _ in range(rng.randint(1, 3)):
                text = self.words(1, 45 if long else 10, rng.random() < 0.7)
                self.block(rng.choice(("p", "div", "h2", "span")), self.link(text) if rng.random() < 0.25 else text, False)
        self.out.append(f"</{tag}>")

    def body(self, inner: float) -> None:
        """The main text, with other parts strewn in at the given rate."""
        rng = self.rng
        in_header = rng.random() < 0.2
        if in_header:
            self.out.append("<header>")
        self.block("h1", self.words(1, 14, rng.random() < 0.3), True)
        if in_header:
            self.out.append("</header>")
        for _ in range(rng.choice((1, 2, 3, 5, 8, 13, 20))):
            kind = rng.random()
            if kind < 0.78:
                self.block("p", self.words(1, 90, True), True, close=rng.random() < 0.85)
            elif kind < 0.86:
                self.block(rng.choice(("h2", "h3")), self.words(1, 8, False), True)
            elif kind < 0.92:
                tag = rng.choice(("ul", "ol"))
                self.out.append(f"<{tag}>")
                for _ in range(rng.randint(2, 6)):
                    self.block("li", self.words(1, 20, rng.random() < 0.5), True, close=rng.random() < 0.8)
                self.out.append(f"</{tag}>")
            elif kind < 0.96:
                self.out.append("<blockquote>")
                self.block("p", self.words(3, 50, True), True)
                self.out.append("</blockquote>")
            else:
                self.out.append("<table>")
                for _ in range(rng.randint(1, 4)):
                    self.out.append("<tr>")
                    for _ in range(2):
                        self.block("td", self.words(1, 6, False), True)
                    self.out.append("</tr>")
                self.out.append("</table>")
            if rng.random() < inner:
                self.side(rng.choice(("ad", "aside", "notice", "form", "share", "nav")))

    def build(self) -> tuple[str, list[str]]:
        rng = self.rng
        self.out.append(f"<!DOCTYPE html><html><head><title>{self.words(1, 8, False)}</title><style>p{{}}</style></head><body>")
        before = [k for k in ("header", "nav", "notice", "ad", "share", "form") if rng.random() < 0.4]
        after = [k for k in ("aside", "comments", "share", "ad", "form", "notice", "nav", "footer") if rng.random() < 0.4]
        rng.shuffle(before)
        for kind in before:
            self.side(kind)
        wrap = rng.random()
        outer = ["<main>", "</main>"] if wrap < 0.25 else [f'<div class="{rng.choice(("container", "wrapper", "page", "row"))}">', "</div>"] if wrap < 0.6 else ["", ""]
        self.out.append(outer[0])
        style = rng.random()
        if style < 0.45:
            tag = "article"
            self.out.append("<article>" if rng.random() < 0.6 else f'<article class="{rng.choice(MAIN_NAMES)}">')
        elif style < 0.85:
            tag = self.opened(None, MAIN_NAMES, rng.choice(("div", "div", "section", "td")))
        else:
            tag = None
        self.body(rng.choice((0, 0, 0.1, 0.3)))
        if rng.random() < 0.25:
            self.side(rng.choice(("comments", "aside", "share", "footer")))
        self.out += [f"</{tag}>" if tag else "", outer[1]]
        for kind in after:
            self.side(kind)
        if rng.random() < 0.8:
            self.out.append("</body></html>")
        return "".join(self.out), self.main


def labelled_pages(spark: SparkSession, count: int = TRAINING_PAGES) -> DataFrame:
    """``(html, blocks)`` of ``count`` pages made by rule, the same ones every time."""
    ship_package(spark)

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            yield pd.DataFrame([_Page(i).build() for i in batch["id"]], columns=["html", "blocks"])

    return spark.range(count).mapInPandas(run, "html string, blocks array<string>")


# --- the field ------------------------------------------------------------------------


def _labels(blocks: list[tuple[str, int]], main: list[str]) -> np.ndarray:
    """1 for the blocks that are, in order, the texts of ``main``."""
    out, k = np.zeros(len(blocks), np.int64), 0
    for i, (text, _) in enumerate(blocks):
        if k < len(main) and text == " ".join(main[k].split()):
            out[i], k = 1, k + 1
    return out


def _log_sum(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    return np.logaddexp(a, b)


def fit(pages: list[tuple[str, list[str]]]) -> dict[str, int]:
    """Integer weights by name: features of a block, ``step 00`` to ``step 11``, ``first 0/1``, ``last 0/1``.

    A feature's weight speaks for "main text"; a feature of fewer than three pages has none.
    """
    features = Features()
    chains = [leaf_blocks(page, features) for page, _ in pages]
    kept = [(c, _labels(c, main)) for c, (_, main) in zip(chains, pages) if c]
    names = list(features.bits)
    if not kept:
        return {}
    longest = max(len(c) for c, _ in kept)
    x = np.zeros((len(kept), longest, len(names)), np.float32)
    gold, there = np.zeros((len(kept), longest), np.int64), np.zeros((len(kept), longest), bool)
    for k, (chain, labels) in enumerate(kept):
        gold[k, : len(chain)], there[k, : len(chain)] = labels, True
        for i, (_, bits) in enumerate(chain):
            x[k, i] = [bits >> j & 1 for j in range(len(names))]
    common = (x.max(axis=1).sum(axis=0) >= LEAST_PAGES)
    x, names = x[:, :, common], [n for n, c in zip(names, common) if c]
    rows = x.reshape(-1, len(names))
    last = there.sum(axis=1) - 1
    every = np.arange(len(kept))
    pair = there[:, 1:] & there[:, :-1]
    seen = np.zeros((2, 2))
    for a in (0, 1):
        for b in (0, 1):
            seen[a, b] = (pair & (gold[:, :-1] == a) & (gold[:, 1:] == b)).sum()
    w = np.zeros(len(names) + 8)  # features, then steps, first, last
    mean, spread = np.zeros_like(w), np.zeros_like(w)
    for step in range(1, STEPS + 1):
        n = len(names)
        score = np.zeros((len(kept), longest, 2))
        score[:, :, 1] = (rows @ w[:n].astype(np.float32)).reshape(len(kept), longest)
        turn, first, end = w[n : n + 4].reshape(2, 2), w[n + 4 : n + 6], w[n + 6 :]
        ahead, back = np.zeros_like(score), np.zeros_like(score)
        ahead[:, 0] = score[:, 0] + first
        for t in range(1, longest):
            ahead[:, t] = score[:, t] + _log_sum(ahead[:, t - 1, :1] + turn[0], ahead[:, t - 1, 1:] + turn[1])
        back[every, last] = end
        for t in range(longest - 2, -1, -1):
            on = back[:, t + 1] + score[:, t + 1]
            back[:, t] = np.where((last > t)[:, None], _log_sum(on[:, :1] + turn[:, 0], on[:, 1:] + turn[:, 1]), back[:, t])
        total = np.logaddexp(*(ahead[every, last] + end).T)
        share = np.exp(np.minimum(ahead + back - total[:, None, None], 0)) * there[:, :, None]
        grad = np.zeros_like(w)
        grad[:n] = ((gold * there - share[:, :, 1]).reshape(-1).astype(np.float32) @ rows)
        for a in (0, 1):
            for b in (0, 1):
                both = ahead[:, :-1, a] + turn[a, b] + score[:, 1:, b] + back[:, 1:, b] - total[:, None]
                grad[n + 2 * a + b] = seen[a, b] - (np.exp(np.minimum(both, 0)) * pair).sum()
            grad[n + 4 + a] = (gold[:, 0] == a).sum() - share[:, 0, a].sum()
            grad[n + 6 + a] = (gold[every, last] == a).sum() - share[every, last, a].sum()
        grad -= PENALTY * w
        mean, spread = 0.9 * mean + 0.1 * grad, 0.999 * spread + 0.001 * grad * grad
        w += RATE * (mean / (1 - 0.9**step)) / (np.sqrt(spread / (1 - 0.999**step)) + 1e-8)
    all_names = names + ["step 00", "step 01", "step 10", "step 11", "first 0", "first 1", "last 0", "last 1"]
    return {name: int(round(v * UNITS)) for name, v in zip(all_names, w)}


def train_extractor(labelled: DataFrame) -> dict[str, int]:
    """The field fitted to labelled pages ``(html, blocks)``, of which it takes :data:`TRAINING_PAGES` by hash.

    That bound lets one task hold the sample; the pages are sorted, so the weights do not depend
    on how they arrive. Null pages and null lists count as empty.
    """
    ship_package(labelled.sparkSession)
    blocks = F.coalesce(F.col("blocks").cast("array<string>"), F.array().cast("array<string>"))
    rows = labelled.select(text_of("html").alias("html"), blocks.alias("blocks"))
    rows = rows.orderBy(F.xxhash64("html"), "html").limit(TRAINING_PAGES)

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        pages = [(page, [b for b in main if b is not None]) for batch in batches for page, main in zip(batch["html"], batch["blocks"])]
        model = fit(sorted(pages))
        yield pd.DataFrame({"name": list(model), "weight": list(model.values())})

    found = rows.repartition(1).mapInPandas(run, "name string, weight long").collect()
    return {r["name"]: r["weight"] for r in found}


class Decoder:
    """Viterbi decoding with a model's weights."""

    def __init__(self, model: dict[str, int]):
        pick = lambda *names: [model.get(n, 0) for n in names]
        self.turn = (pick("step 00", "step 01"), pick("step 10", "step 11"))
        self.first, self.last = pick("first 0", "first 1"), pick("last 0", "last 1")
        names = [n for n in model if not n.startswith(("step ", "first ", "last "))]
        self.features, self.weights = Features(names), [model[n] for n in names]
        self._scores: dict[int, int] = {}

    def score(self, bits: int) -> int:
        found = self._scores.get(bits)
        if found is None:
            found = sum(w for k, w in enumerate(self.weights) if bits >> k & 1)
            if len(self._scores) > 100_000:
                self._scores.clear()
            self._scores[bits] = found
        return found

    def main_text(self, page: str) -> str:
        """The blocks on the best path that are main text, a line each."""
        blocks = leaf_blocks(page, self.features)
        if not blocks:
            return ""
        (t00, t01), (t10, t11) = self.turn
        came = bytearray(len(blocks))  # for each label, the best label before it: bits 0 and 1
        no, yes = self.first[0], self.first[1] + self.score(blocks[0][1])
        for i in range(1, len(blocks)):
            s = self.score(blocks[i][1])
            from_yes_0, from_yes_1 = yes + t10 > no + t00, yes + t11 > no + t01
            came[i] = from_yes_0 | from_yes_1 << 1
            no, yes = (yes + t10 if from_yes_0 else no + t00), (yes + t11 if from_yes_1 else no + t01) + s
        label = int(yes + self.last[1] > no + self.last[0])
        kept = []
        for i in range(len(blocks) - 1, -1, -1):
            if label:
                kept.append(blocks[i][0])
            label = came[i] >> label & 1
        return "\n".join(reversed(kept))


def extract_text(pages: DataFrame, model: dict[str, int], id_col: str = "page_id", url_col: str = "url",
                 html_col: str = "html") -> DataFrame:
    """``(page_id, url, text)``: the main text of every page, blocks in page order, a line each.

    A null or empty page, and one without main text, has an empty text. Pages are read whole.
    Repeated rows give repeated rows, null ids and urls stay, other columns are not looked at.
    """
    ship_package(pages.sparkSession)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        decoder = Decoder(model)
        for batch in batches:
            texts = pa.array([decoder.main_text(page.as_py()) for page in batch["html"]], pa.string())
            yield pa.RecordBatch.from_arrays([batch["page_id"], batch["url"], texts], names=["page_id", "url", "text"])

    rows = pages.select(F.col(id_col).alias("page_id"), F.col(url_col).cast("string").alias("url"), text_of(html_col).alias("html"))
    kind = rows.schema["page_id"].dataType.simpleString()
    return rows.mapInArrow(run, f"page_id {kind}, url string, text string")
