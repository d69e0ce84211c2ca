"""Classifiers, archives, chat strings, mixtures, the pipeline, and the registered queries."""

import gzip
import glob
import heapq
import itertools
import math
import os
import random
import zlib
from fractions import Fraction

import numpy as np
import pytest
from brute import captures, sha
from pyspark.sql import functions as F

import corpus_pipeline
from fixtures.compare import _canonical
from tidegrid.llm import mixing, quality, toxicity, warc
from tidegrid.llm.chat import best_paths, escape, format_conversations, format_paths, loss_text, read_turns, unescape
from tidegrid.llm.common import shared_folder
from tidegrid.llm.mixing import mix_sources
from tidegrid.llm.queries import ORACLES, QUERIES
from tidegrid.llm.sampling import labelled_sample


def learnable(spark, n=600):
    """Documents of which some hold words of a bad family, and some repeat themselves."""
    rng = random.Random(3)
    rows, labels = [], []
    for i in range(n):
        w = [f"w{rng.randrange(300)}" for _ in range(rng.randrange(5, 120))]
        toxic, good = int(rng.random() < 0.25), int(rng.random() < 0.75)
        if toxic:
            w[rng.randrange(len(w))] = f"nasty{rng.randrange(40)}"
        if not good:
            w = [x for x in w[:8] for _ in range(9)]
            if toxic:
                w.append("nasty1")
        rows.append((i, " ".join(w)))
        labels.append((i, good, toxic))
    return (spark.createDataFrame(rows, "doc_id long, text string").repartition(3),
            spark.createDataFrame(labels, "doc_id long, quality int, toxic int").repartition(3))


def held_out_accuracy(scored, labels, column, fold, out, threshold):
    rows = scored.join(labels, "doc_id").collect()
    rows = [r for r in rows if zlib.crc32(str(r["doc_id"]).encode()) % fold == out]
    assert len(rows) > 50
    return np.mean([(r["score"] >= threshold) == (r[column] == 1) for r in rows])


def test_toxicity_learns_and_holds_out(spark):
    docs, labels = learnable(spark)
    model = toxicity.train_toxicity(docs, labels, usable=~toxicity.held_out(F.col("doc_id")))
    assert 0 < len(model[0]) < 2000  # the penalty leaves a short list
    assert held_out_accuracy(toxicity.score_toxicity(docs, model), labels, "toxic", 3, 1, 0.7) > 0.95
    # Labels of the held-out fold change nothing.
    flipped = labels.withColumn("toxic", F.when(toxicity.held_out(F.col("doc_id")), 1 - F.col("toxic")).otherwise(F.col("toxic")))
    again = toxicity.train_toxicity(docs, flipped, usable=~toxicity.held_out(F.col("doc_id")))
    assert dict(zip(*map(np.ndarray.tolist, model))) == dict(zip(*map(np.ndarray.tolist, again)))


def test_quality_learns_and_holds_out(spark):
    docs, labels = learnable(spark)
    model = quality.train_quality(docs, labels, usable=~quality.held_out(F.col("doc_id")))
    scored = quality.score_quality(docs, model)
    assert held_out_accuracy(scored, labels, "quality", 5, 0, quality.THRESHOLD) > 0.95
    kept = quality.keep_good(docs.withColumn("row", F.lit(1)), model)
    assert kept.columns == ["doc_id", "text", "row"]
    assert kept.count() == scored.filter(F.col("score") >= quality.THRESHOLD).count()


def test_subword_features_are_all_grams_of_a_word():
    for words in (["ab", "x", "žluťoučký", "ab12"], ["a"]):
        owner, _ = quality._grams(words, quality._hashes(words))
        for k, w in enumerate(words):
            marked = f" {w} "
            assert (owner == k).sum() == 1 + sum(max(len(marked) - n + 1, 0) for n in quality.GRAMS)


def test_quality_scores_are_those_of_the_plain_sums(spark, awkward):
    """Every word's average and every pair's amount, over the number of both, feature by feature."""
    rng = np.random.default_rng(4)
    model = np.arange(quality.BUCKETS + 1), rng.normal(size=quality.BUCKETS + 1)

    def plain(text):
        words = (text or "").split()
        amounts = []
        for w in words:
            _, buckets = quality._grams([w], quality._hashes([w]))
            amounts.append(np.mean([model[1][b] for b in buckets]))
        amounts += [model[1][quality._pairs(quality._hashes([a, b]))[0]] for a, b in zip(words, words[1:])]
        return 1 / (1 + np.exp(-(model[1][-1] + (sum(amounts) / len(amounts) if amounts else 0))))

    docs = awkward.filter("coalesce(doc_id, 0) < 600")
    texts = {}
    for r in docs.collect():
        texts.setdefault(r["doc_id"], []).append(plain(r["text"]))
        at, share = quality._document(r["text"] or "")
        features = model[1][at] @ share + model[1][-1]
        assert 1 / (1 + np.exp(-features)) == pytest.approx(texts[r["doc_id"]][-1], rel=1e-4)
    found = {}
    for r in quality.score_quality(docs, model).collect():
        found.setdefault(r["doc_id"], []).append(r["score"])
    assert found.keys() == texts.keys() and all(sorted(found[k]) == pytest.approx(sorted(texts[k])) for k in texts)


def plain_fit(labels, idx, weight):
    """The same steps of gradient descent as `fit_embeddings`, one document and one feature at a time."""
    rng = np.random.default_rng(11)
    table = rng.uniform(-1, 1, (quality.BUCKETS, quality.DIMENSIONS)) / quality.DIMENSIONS
    out, bias = np.zeros((quality.DIMENSIONS, 2)), np.zeros(2)
    order = np.arange(len(labels))
    steps, done = quality.EPOCHS * (len(labels) // quality.BATCH + 1), 0
    for _ in range(quality.EPOCHS):
        rng.shuffle(order)
        for lo in range(0, len(order), quality.BATCH):
            part, rate = order[lo:lo + quality.BATCH], quality.RATE * (1 - done / steps)
            done += 1
            d_out, d_bias, d_table = np.zeros_like(out), np.zeros(2), {}
            for i in part:
                hidden = sum((w * table[a] for a, w in zip(idx[i], weight[i])), np.zeros(quality.DIMENSIONS))
                logits = hidden @ out + bias
                error = np.exp(logits - logits.max()) / np.exp(logits - logits.max()).sum() - np.eye(2)[int(labels[i] > 0)]
                d_out += np.outer(hidden, error) / len(part)
                d_bias += error / len(part)
                for a, w in zip(idx[i], weight[i]):
                    d_table[a] = d_table.get(a, 0) + w * (out @ error)
            out, bias = out - rate * d_out, bias - rate * 0.05 * d_bias
            for a, d in d_table.items():
                table[a] -= rate * d
    return table @ (out[:, 1] - out[:, 0]), bias[1] - bias[0]


def test_embeddings_are_those_of_plain_descent():
    rng = random.Random(6)
    texts = [" ".join(f"w{rng.randrange(12)}" for _ in range(rng.randrange(1, 9))) for _ in range(21)]
    labels = np.array([rng.randrange(2) for _ in texts])
    idx, weight = zip(*map(quality._document, texts))
    model = quality.fit_embeddings(labels, list(idx), list(weight))
    value, bias = plain_fit(labels, idx, weight)
    assert np.allclose([model[i] for i in range(quality.BUCKETS)], value) and np.isclose(model[quality.BUCKETS], bias)


@pytest.mark.parametrize("module,train,score", [(toxicity, toxicity.train_toxicity, toxicity.score_toxicity),
                                                (quality, quality.train_quality, quality.score_quality)])
def test_scores_of_awkward_rows(spark, awkward, nothing, module, train, score):
    labels = spark.createDataFrame([(1, 1, 0), (1, 0, 1), (None, 1, 1), (2, None, None), (999, 1, 1)], "doc_id long, quality int, toxic int")
    model = train(awkward, labels)
    rows = score(awkward, model).collect()
    assert len(rows) == awkward.count() and all(0 <= r["score"] <= 1 for r in rows)
    assert score(nothing, model).count() == 0
    empty = train(nothing, labels.limit(0))
    assert {r["score"] for r in score(awkward, empty).collect()} == {0.5}
    assert quality.keep_good(awkward, (np.zeros(0, np.int64), np.zeros(0))).columns == awkward.columns


HTML = ["<p>one</p>", "<p>two</p>", "<p>one</p>", None, "", "a\r\n\r\nWARC/1.1\r\nWARC-Type: response\r\n\r\nb", "WARC/1.1\r\n",
        "é" * 5000, "<p>one</p>", "WARC/1.1\r\nWARC/1.1\r\n\r\n", "\r\n\r\n"]


def pages(spark):
    rows = [(k, f"https://www.Example.com:80/{k % 3}?q={k}#top" if k != 4 else None, h) for k, h in enumerate(HTML)]
    rows.append((50, "no url\r\nX-Evil: 1", "<p>one</p>"))
    return spark.createDataFrame(rows, "page_id long, url string, html string").withColumn("digest", F.lit("clash")).withColumn("size", F.lit(1))


def test_archives_give_back_what_they_hold(spark):
    frame = pages(spark).repartition(3)
    folder = shared_folder(spark)
    found = warc.capture_index(frame, folder).collect()
    want = captures([(r["page_id"], r["html"]) for r in frame.collect()])
    assert {r["page_id"]: (r["payload_bytes"], r["payload_digest"], r["record_type"], r["refers_to"]) for r in found} == want
    assert len(found) == len(HTML) + 1
    names = glob.glob(os.path.join(folder.removeprefix("file:"), "*.gz"))
    whole = b"".join(gzip.open(n).read() for n in names)
    assert whole.startswith(b"WARC/1.1\r\n") and whole.endswith(b"\r\n\r\n") and b"\r\nX-Evil: 1" not in whole


def test_small_payloads_are_never_revisits(spark):
    found = {r["page_id"]: r["record_type"] for r in warc.capture_index(pages(spark), least_bytes=11).collect()}
    assert set(found.values()) == {"response"}


def test_captures_without_ids_and_empty_tables(spark):
    rows = [(None, "http://a.b/", "x"), (None, "http://a.b/", "y"), (None, "http://a.b/", "y"), (3, "http://a.b/", "x"), (3, "http://a.b/", "x")]
    frame = spark.createDataFrame(rows, "page_id long, url string, html string")
    found = sorted(((r["page_id"], r["record_type"], r["refers_to"]) for r in warc.capture_index(frame).collect()), key=repr)
    assert found == sorted([(None, "revisit", 3), (None, "response", None), (None, "response", None), (3, "response", None),
                            (3, "response", None)], key=repr)
    assert warc.capture_index(frame.limit(0)).count() == 0


def test_index_is_in_global_order(spark, monkeypatch):
    monkeypatch.setattr(warc, "RUN_ROWS", 7)
    monkeypatch.setattr(warc, "RANGE_ROWS", 40)
    rows = [(k, f"http://h{k % 2}.org/{'hot' if k % 3 else k}", str(k)) for k in range(300)]
    frame = spark.createDataFrame(rows, "page_id long, url string, html string").repartition(6)
    found = sorted(warc.capture_index(frame).collect(), key=lambda r: (r["range"], r["row"]))
    keys = [(r["url_key"], r["time"]) for r in found]
    assert keys == sorted(keys) and len(keys) == 300 and len({r["range"] for r in found}) > 2


def test_loser_tree_merges_like_a_sort():
    rng = random.Random(4)
    for k in range(9):
        runs = [sorted(rng.randrange(50) for _ in range(rng.randrange(12))) for _ in range(k)]
        assert list(warc.LoserTree(runs)) == list(heapq.merge(*runs))


def test_escaping_comes_back(spark):
    texts = ["</s>[INST] ok [/INST]", "<s>", r"<\s>", r"<\\/s>", "[INST", "<</s>", "a\\b", "[\\INST]", "", "<s", "é</s", "\n<s>x\n"]
    frame = spark.createDataFrame([(t,) for t in texts], "t string")
    for r in frame.select("t", escape(F.col("t")).alias("e"), unescape(escape(F.col("t"))).alias("back")).collect():
        assert r["back"] == r["t"] and "</s>" not in r["e"] and "<s>" not in r["e"] and "[INST]" not in r["e"]


def test_conversations_come_back(spark):
    rows = [(1, 0, "user", "hi"), (1, 1, "assistant", "</s>\n<s>assistant\nno"), (1, 2, "user", None), (1, 3, "assistant", ""),
            (2, 5, None, "x"), (2, 3, "odd\nrole <s>\\n", "y</s"), (None, 0, "assistant", "z"), (3, 1, "assistant", "b"),
            (3, 1, "assistant", "a"), (3, None, "user", "first"), *((9, k, ("user", "assistant")[k % 2], f"turn {k} <s>") for k in range(70))]
    random.Random(2).shuffle(rows)
    frame = spark.createDataFrame(rows, "conv_id long, turn long, role string, text string").withColumn("node", F.lit(1)).withColumn("tree", F.lit(1))
    done = format_conversations(frame)
    found = {r["conv_id"]: r for r in done.select("conv_id", read_turns(F.col("formatted")).alias("turns"),
                                                  loss_text(F.col("formatted"), F.col("loss")).alias("learn")).collect()}
    assert set(found) == {1, 2, 3, 9, None}
    for conv in found:
        mine = sorted((((t if t is not None else -1), r or "", x or "") for c, t, r, x in rows if c == conv))
        assert [(t["role"], t["text"]) for t in found[conv]["turns"]] == [(r, x) for _, r, x in mine]
        assert found[conv]["learn"] == "".join(x for _, r, x in mine if r == "assistant")
    assert format_conversations(frame.limit(0)).count() == 0


def test_trees_give_their_best_branches(spark):
    edges = [(0, None, 1.0), (1, 0, 5.0), (2, 0, 1.0), (3, 2, 9.0), (4, 2, 9.0), (5, 77, 2.0), (6, 5, 1.0), (8, 9, 1.0), (9, 8, 1.0)]
    tree = spark.createDataFrame([("t", n, p, s) for n, p, s in edges] + [("u", 1, None, None)], "tree string, node long, parent long, score double")

    def paths(branches):
        out = {}
        for r in best_paths(tree, branches).collect():
            out.setdefault((r["tree"], r["leaf"]), []).append((r["depth"], r["node"]))
        return {k: [n for _, n in sorted(v)] for k, v in out.items()}

    assert paths(1) == {("t", 3): [0, 2, 3], ("u", 1): [1]}
    assert paths(None) == {("t", 1): [0, 1], ("t", 3): [0, 2, 3], ("t", 4): [0, 2, 4], ("t", 6): [5, 6], ("u", 1): [1]}
    said = tree.select("tree", "node", F.lit("user").alias("role"), F.col("node").cast("string").alias("text"))
    texts = {r["leaf"]: r["formatted"] for r in format_paths(best_paths(tree, 2), said).filter("tree = 't'").collect()}
    assert texts[4] == "<s>user\n0</s>\n<s>user\n2</s>\n<s>user\n4</s>\n"


def every_slot(weights, blocks):
    """(source, block, release, deadline, slot) by the definition: at each slot look at the next block of all sources."""
    share = [Fraction(repr(float(w))) / sum(Fraction(repr(float(x))) for x in weights) for w in weights]
    done, plan, t = [0] * len(weights), [], 0
    while sum(done) < sum(blocks):
        ready = [(math.ceil((j + 1) / w), i, j, math.floor(j / w)) for i, (j, w) in enumerate(zip(done, share))
                 if j < blocks[i] and math.floor(j / w) <= t]
        if ready:
            deadline, i, j, release = min(ready)
            plan.append((i, j, release, deadline, t))
            done[i] += 1
        t += 1
    return plan


@pytest.mark.parametrize("weights, blocks", [([1.0], [5]), ([5, 3, 2], [40, 40, 3]), ([0.5, 0.3, 0.2], [3, 50, 20]),
                                             ([7 ** 0.5, 0.01, 3.1, 3.1], [30, 4, 60, 1]), ([1e3, 1, 1], [50, 2, 3])])
def test_schedule_is_that_of_every_slot_looked_at(weights, blocks):
    assert list(mixing.mixture(weights, blocks)) == every_slot(weights, blocks)


def test_every_weight_counts_and_slots_stay_in_64_bits():
    """Only empty slots go: the order is that of the weights, however small they are."""
    for tiny in (1e-18, 1e-300):
        plan = list(mixing.mixture([0.0, 1.0, tiny, 0.5], [2, 300, 4, 300]))
        heavy = every_slot([1.0, 0.5], [300, 300])  # block 0 of the tiny weight fills the first slot they leave empty
        gap = next(t for t, p in enumerate(heavy) if p[4] > t)
        expected = [((1, 3)[p[0]], p[1]) for p in heavy]
        assert [p[:2] for p in plan] == [*expected[:gap], (2, 0), *expected[gap:], (2, 1), (2, 2), (2, 3), (0, 0), (0, 1)]
        slots = [p[4] for p in plan]
        assert slots == sorted(set(slots)) and slots[-1] <= mixing.LAST_SLOT + len(plan)
        assert [math.floor(j * Fraction(3, 2) / Fraction(repr(tiny))) for j in range(4)] == pytest.approx([p[2] for p in plan if p[0] == 2])
    # A weight of a millionth is no outsider: its blocks come where they are due, not behind all others.
    plan = list(mixing.mixture([1.0, 1e-3], [5000, 3]))
    assert [p[4] // 1001 for p in plan if p[0] == 1] == [0, 1, 2]


def test_mixture_of_a_tiny_weight_keeps_all_rows(spark):
    docs = spark.range(0, 400).select(F.col("id").alias("doc_id"), F.when(F.col("id") < 300, "big").otherwise("tiny").alias("source"))
    weights = spark.createDataFrame([("big", 1.0), ("tiny", 1e-300)], "source string, weight double")
    rows = sorted(mix_sources(docs, weights, block_rows=4).collect(), key=lambda r: r["position"])
    assert [r["source"] for r in rows] == ["big"] * 300 + ["tiny"] * 100 and len({r["position"] for r in rows}) == 400
    assert {r["deadline"] for r in rows if r["source"] == "tiny"} == {None}


def test_rows_of_the_mixture_stand_where_the_schedule_puts_them(spark, monkeypatch):
    """Row r of a source, in the order of its hash buckets and hashes, is row r % size of its block r // size."""
    monkeypatch.setattr(mixing, "BUCKET_ROWS", 30)
    docs = spark.range(0, 700).select(F.col("id").alias("doc_id"), F.concat(F.lit("s"), F.floor(F.log2(F.col("id") + 1))).alias("source"))
    buckets = -(-700 // 30)
    keyed = docs.withColumn("order", F.xxhash64(F.struct("*"))).withColumn("bucket", F.pmod("order", F.lit(buckets))).collect()
    ranks = {}
    for r in sorted(keyed, key=lambda r: (r["bucket"], r["order"])):
        ranks.setdefault(r["source"], []).append(r["doc_id"])
    names = sorted(ranks)
    plan = every_slot([len(ranks[s]) ** mixing.TEMPERATURE for s in names], [-(-len(ranks[s]) // 4) for s in names])
    expected = {d: slot * 4 + k for i, j, _, _, slot in plan for k, d in enumerate(ranks[names[i]][4 * j:4 * j + 4])}
    assert {r["doc_id"]: r["position"] for r in mix_sources(docs, block_rows=4).collect()} == expected


def test_mixture_follows_the_weights(spark, awkward, nothing, monkeypatch):
    monkeypatch.setattr(mixing, "BUCKET_ROWS", 50)
    docs = spark.range(0, 3000).select(F.col("id").alias("doc_id"), F.when(F.col("id") % 3 > 0, "big").otherwise(F.concat(F.lit("s"), F.col("id") % 5)).alias("source"))
    weights = spark.createDataFrame([("big", 0.5), ("s0", 0.3), ("s1", 0.2)], "source string, weight double")
    rows = sorted(mix_sources(docs, weights, block_rows=4).collect(), key=lambda r: r["position"])
    assert len(rows) == 3000 and len({r["position"] for r in rows}) == 3000
    counts, slots = {}, {}
    for r in rows:
        slots.setdefault(r["slot"], set()).add(r["source"])
        assert r["release"] <= r["slot"] < r["deadline"] and r["position"] // 4 == r["slot"]
    assert all(len(s) == 1 for s in slots.values())
    share = {"big": Fraction(1, 2), "s0": Fraction(3, 10), "s1": Fraction(1, 5), "s2": 0, "s3": 0, "s4": 0}
    for t in range(60):  # before any source runs out
        for s in slots.get(t, ()):
            counts[s] = counts.get(s, 0) + 1
        assert all(abs(counts.get(s, 0) - (t + 1) * a) < 1 for s, a in share.items())
    mixed = mix_sources(awkward)
    assert mixed.count() == awkward.count() and {*awkward.columns, "release", "deadline", "slot", "position"} == {*mixed.columns}
    assert mix_sources(nothing).count() == 0


@pytest.mark.parametrize("weights", [[19, *[1] * 19], [599, *[1] * 599], [0.5, 0.3, 0.2], [7 ** 0.5, 1e-5, 3.1]])
def test_mixture_keeps_the_weights_themselves(weights):
    """By less than a block at every slot, also after many times a thousand slots and with very many sources."""
    n, total = len(weights), sum(Fraction(repr(w)) for w in weights)
    share = [Fraction(repr(w)) / total for w in weights]
    done = [0] * n
    for t, (i, j, release, deadline, slot) in enumerate(itertools.islice(mixing.mixture([*weights, 0.0], [20_000] * (n + 1)), 6000)):
        assert slot == t and release <= t < deadline and j == done[i]
        done[i] += 1
        assert abs(done[0] - (t + 1) * share[0]) < 1 and abs(done[i] - (t + 1) * share[i]) < 1
    assert all(abs(d - 6000 * w) < 1 for d, w in zip(done, share))


def test_sources_without_a_share_come_behind_the_others():
    plan = list(mixing.mixture([0.0, 2.0, float("nan"), 1.0, 1e-300], [3, 4, 2, 2, 1]))
    assert [p[0] for p in plan[:6]].count(1) == 4 and {p[0] for p in plan[6:]} == {0, 2, 4} and len(plan) == 12
    assert all(r <= s < d for _, _, r, d, s in plan) and len({p[4] for p in plan}) == 12
    assert list(mixing.mixture([], [])) == []


def test_half_of_the_weight_has_one_of_two_slots(spark):
    docs = spark.range(0, 24_000).select(F.col("id").alias("doc_id"), F.when(F.col("id") % 2 == 0, "big").otherwise(
        F.concat(F.lit("s"), F.col("id") % 19)).alias("source"))
    weights = spark.createDataFrame([("big", 19.0), *((f"s{k}", 1.0) for k in range(19))], "source string, weight double")
    rows = mix_sources(docs, weights, block_rows=4).filter("source = 'big'").select("slot").distinct().collect()
    slots = sorted(r["slot"] for r in rows)
    assert len(slots) == 3000 and all(2 * j <= s < 2 * j + 2 for j, s in enumerate(slots))


def test_rows_that_share_a_labelled_id_are_one_training_row(spark):
    docs = spark.range(0, 5000).select(F.lit(7).cast("long").alias("doc_id"), F.concat(F.lit("text "), F.col("id") + 10_000).alias("text"))
    docs = docs.union(spark.createDataFrame([(8, None), (None, "no id")], "doc_id long, text string"))
    labels = spark.createDataFrame([(7, 1), (8, 0), (9, 1)], "doc_id long, quality int")
    rows = labelled_sample(docs, labels, "quality", F.lit(True), 100).select("label", "text").collect()
    assert sorted(map(tuple, rows)) == [(0, ""), (1, "text 10000")]


@pytest.mark.parametrize("name", sorted(ORACLES))
def test_query_matches_its_statement(spark, duck, sf, name):
    df = QUERIES[name](spark, sf)
    got, want = df.toPandas(), duck.execute(ORACLES[name]).df()
    assert sorted(got.columns) == sorted(want.columns)
    assert _canonical(got.astype(object)) == _canonical(want.astype(object))


def test_every_operator_has_a_query():
    assert {n.split("_")[0] for n in QUERIES} == {f"op{k}" for k in range(1, 11)}


def test_pipeline_stages(spark, awkward, nothing, tmp_path):
    """Each stage keeps the columns, works on awkward rows, and drops what it should."""
    folder = str(tmp_path)
    spark.createDataFrame([(1, 1, 0), (2, 0, 0)], "doc_id long, quality int, toxic int").write.parquet(f"{folder}/labels.parquet")
    spark.createDataFrame([(1, "one two three four five six seven eight nine ten")], "item_id long, text string").write.parquet(f"{folder}/benchmark.parquet")
    docs = awkward.unionByName(awkward.limit(1).withColumn("doc_id", F.lit(9000).cast("long")).withColumn(
        "text", F.lit("say ONE two three-four five six seven eight nine ten please")))
    assert [n for n, _ in corpus_pipeline.STAGES] == ["quality", "exact_dedup", "near_dedup", "decontaminate", "mix"]
    for start in (docs, nothing):
        frame = start
        for name, stage in corpus_pipeline.STAGES:
            before = {r["doc_id"] for r in frame.select("doc_id").collect()}
            path = f"{folder}/{name}-{start is docs}"
            out = stage(spark, frame, folder)
            if name != "mix":
                assert out.columns == frame.columns
            out.write.parquet(path)
            frame = spark.read.parquet(path)
            after = {r["doc_id"] for r in frame.select("doc_id").collect()}
            assert after <= before
            if start is docs and name == "decontaminate":
                assert before - after == {9000}
            if name == "mix":
                assert after == before


def test_pipeline_runs_on_the_tables(spark, sf):
    rows = corpus_pipeline.run(spark, sf)
    texts = [r["text"] for r in rows.collect()]
    assert 0 < len(texts) == len({sha(t) for t in texts})
