"""Small tables with every awkward case, for the corpus operators."""

import random

import pytest

CLASHING = ("key", "n", "row", "bucket", "order", "size", "length", "prefix", "label", "node", "band", "of", "id",
            "keep_id", "kept", "component_id", "pieces", "places", "slot", "position", "sha", "first_id", "item_id")


def words(rng, n, vocabulary=400):
    return " ".join(f"w{rng.randrange(vocabulary)}x" for _ in range(n))


def awkward_texts(seed=5):
    """(doc_id, text): nulls, empties, white space, copies, near copies, shared passages, long texts, repeated rows."""
    rng = random.Random(seed)
    base = [words(rng, rng.choice([1, 2, 3, 30, 80, 150])) for _ in range(40)]
    passage = words(rng, 70)
    rows = [(i, t) for i, t in enumerate(base)]
    for k in range(12):  # near copies: a few words changed
        w = base[k + 4].split()
        for _ in range(rng.choice([1, 2, 4, 12])):
            w[rng.randrange(len(w))] = "changed"
        rows.append((100 + k, " ".join(w)))
    rows += [(200 + k, base[7].replace(" ", "  \n")) for k in range(5)] + [(210, base[7]), (211, base[7].upper())]
    rows += [(300 + k, f"{words(rng, 40)} {passage} {words(rng, 30)}") for k in range(6)]
    rows += [(400, None), (401, ""), (402, " \t\n"), (403, None), (404, ""), (405, "é"), (406, "É"), (407, "a b"), (408, "A\tB")]
    rows += [(500, base[9]), (500, base[9]), (None, base[10]), (None, "only here"), (None, None), (501, "x" * 250), (502, "x" * 900)]
    rows += [(600, " ".join([words(rng, 30_000), base[11]])), (601, "ab" * 150_000)]
    return rows


@pytest.fixture(scope="session")
def awkward(spark):
    """The awkward texts in a shuffled order, with columns whose names the operators use inside."""
    from pyspark.sql import functions as F

    rows = awkward_texts()
    random.Random(1).shuffle(rows)
    docs = spark.createDataFrame([(i, t, f"s{(i or 0) % 3}" if i != 3 else None) for i, t in rows], "doc_id long, text string, source string")
    return docs.select("*", *[F.lit(f"extra {c}").alias(c) for c in CLASHING]).repartition(5)


@pytest.fixture(scope="session")
def nothing(awkward):
    return awkward.limit(0)
