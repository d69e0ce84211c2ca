"""The registered queries of the corpus operators and, where SQL can say it, their DuckDB statements."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidegrid.llm import quality, toxicity
from tidegrid.llm.chat import format_conversations, loss_text, read_turns
from tidegrid.llm.clustering import cluster_vectors
from tidegrid.llm.common import table
from tidegrid.llm.decontaminate import find_contamination, proximity_matches
from tidegrid.llm.exact_dedup import exact_duplicates
from tidegrid.llm.html_extract import extract_text, labelled_pages, train_extractor
from tidegrid.llm.minhash import near_duplicates
from tidegrid.llm.mixing import mix_sources
from tidegrid.llm.periodic import periodic_runs, strongest, with_cycles
from tidegrid.llm.secrets import KINDS, scan_secrets, spans_as_text
from tidegrid.llm.suffix_dedup import remove_repeats
from tidegrid.llm.warc import capture_index

Query = Callable[[SparkSession, str], DataFrame]

QUERIES: dict[str, Query] = {}
ORACLES: dict[str, str] = {}


def query(name: str, oracle: str | None = None) -> Callable[[Query], Query]:
    def register(fn: Query) -> Query:
        QUERIES[name] = fn
        if oracle is not None:
            ORACLES[name] = oracle
        return fn

    return register


@query("op1_exact_dedup", r"""
    WITH hashed AS (
        SELECT doc_id, sha256(regexp_replace(coalesce(text, ''), '[\x20\x09-\x0D]+', ' ', 'g')) AS text_sha256
        FROM documents)
    SELECT doc_id, min(doc_id) OVER g AS keep_id, count(*) OVER g AS group_size,
           doc_id = min(doc_id) OVER g AS kept, text_sha256
    FROM hashed WINDOW g AS (PARTITION BY text_sha256)""")
def op1(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = exact_duplicates(table(spark, sf_dir, "documents"), digests=True)
    return found.select("doc_id", "keep_id", "group_size", "kept", "text_sha256")


@query("op3_secret_scan")
def op3(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = scan_secrets(table(spark, sf_dir, "documents"))
    counts = [F.size(kind).cast("long").alias(f"n_{kind}") for kind in KINDS]
    return found.select("doc_id", *counts,
                        F.sha2(spans_as_text("assign", "access", "hex").cast("binary"), 256).alias("base_sha256"),
                        spans_as_text(*KINDS).alias("spans"))


@query("op10_decontaminate", r"""
    WITH d AS (
        SELECT doc_id, regexp_extract_all(
                   translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                   '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w
        FROM documents),
    i AS (
        SELECT item_id, regexp_extract_all(
                   translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                   '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w
        FROM benchmark),
    spots AS (SELECT item_id, w, unnest(range(1, greatest(len(w) - 9, 1) + 1)) AS s FROM i WHERE len(w) > 0),
    wins AS (
        SELECT DISTINCT item_id, least(len(w), 10) AS n, array_to_string(list_slice(w, s, s + 9), ' ') AS phrase
        FROM spots),
    places AS (
        SELECT doc_id, w, n, unnest(range(1, len(w) - n + 2)) AS s
        FROM d CROSS JOIN (SELECT DISTINCT n FROM wins)),
    grams AS (SELECT doc_id, n, s, array_to_string(list_slice(w, s, s + n - 1), ' ') AS phrase FROM places),
    hits AS (SELECT g.doc_id, g.s, g.n, wins.item_id FROM grams g JOIN wins USING (n, phrase)),
    covered AS (SELECT doc_id, count(DISTINCT p) AS n_hit
                FROM (SELECT doc_id, unnest(range(s, s + n)) AS p FROM hits) GROUP BY doc_id),
    listed AS (SELECT doc_id, count(*) AS n_items, string_agg(id, ',' ORDER BY id) AS ids
               FROM (SELECT DISTINCT doc_id, item_id::VARCHAR AS id FROM hits) GROUP BY doc_id)
    SELECT d.doc_id, len(d.w)::BIGINT AS n_words, coalesce(n_hit, 0)::BIGINT AS n_hit,
           coalesce(n_items, 0)::BIGINT AS n_items, sha256(coalesce(ids, '')) AS items_sha256,
           coalesce(n_hit, 0) > 0 AS contaminated
    FROM d LEFT JOIN covered USING (doc_id) LEFT JOIN listed USING (doc_id)""")
def op10(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = find_contamination(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))
    return found.select("doc_id", "n_words", "n_hit", F.size("items").cast("long").alias("n_items"),
                        F.sha2(F.array_join("items", ",").cast("binary"), 256).alias("items_sha256"),
                        (F.col("n_hit") > 0).alias("contaminated"))


@query("op10_proximity")
def op10_proximity(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = proximity_matches(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))
    return found.select("doc_id", "start", "stop", F.array_join("phrase", " ").alias("phrase"), F.array_join(F.array_sort("items"), ",").alias("items"))


@query("op4_toxicity")
def op4(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    out = toxicity.held_out(F.col("doc_id"))
    model = toxicity.train_toxicity(docs, table(spark, sf_dir, "labels"), usable=~out)
    return toxicity.score_toxicity(docs, model).select(
        "doc_id", out.alias("held_out"), "score", (F.col("score") >= 0.7).cast("int").alias("predicted"))


@query("op7_quality")
def op7(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    out = quality.held_out(F.col("doc_id"))
    model = quality.train_quality(docs, table(spark, sf_dir, "labels"), usable=~out)
    return quality.score_quality(docs, model).select(
        "doc_id", out.alias("held_out"), "score", (F.col("score") >= quality.THRESHOLD).cast("int").alias("predicted"))


@query("op2_minhash")
def op2(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = near_duplicates(table(spark, sf_dir, "documents"), size=2, percent=80)
    return found.select("doc_id", "n_shingles", "component_id", "kept")


@query("op9_suffix_dedup")
def op9(spark: SparkSession, sf_dir: str) -> DataFrame:
    return remove_repeats(table(spark, sf_dir, "documents"))


@query("op8_warc")
def op8(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = capture_index(table(spark, sf_dir, "pages"))
    return found.select("page_id", "payload_bytes", "payload_digest", "record_type", "refers_to", "url_key", "time")


@query("op5_chat_format", r"""
    WITH turns AS (
        SELECT conv_id, turn, coalesce(role, '') AS role, coalesce(text, '') AS text FROM conversations
        UNION ALL SELECT -7, 0, 'user', '</s>[INST] ok [/INST]'
        UNION ALL SELECT -7, 1, 'assistant', '</s>[INST] ok [/INST]'),
    joined AS (
        SELECT conv_id, count(*) AS n_turns,
               string_agg(role || chr(10) || text || chr(10), '' ORDER BY turn, role, text) AS turns,
               coalesce(string_agg(text, '' ORDER BY turn, role, text) FILTER (role = 'assistant'), '') AS loss,
               sum(3 + length(role) + 1 + length(regexp_replace(text, '(<|\[)(\\*)(/?(?:s>|INST\]))', '\1\\\2\3', 'g')) + 5)
                   AS formatted_chars
        FROM turns GROUP BY conv_id)
    SELECT conv_id, n_turns, sha256(turns) AS turns_sha256, length(loss)::BIGINT AS loss_chars,
           sha256(loss) AS loss_sha256, formatted_chars::BIGINT AS formatted_chars
    FROM joined""")
def op5(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = table(spark, sf_dir, "conversations").select("conv_id", "turn", "role", "text")
    said = "</s>[INST] ok [/INST]"
    extra = spark.createDataFrame([(-7, 0, "user", said), (-7, 1, "assistant", said)], "conv_id long, turn long, role string, text string")
    done = format_conversations(rows.unionByName(extra))
    turns = read_turns(F.col("formatted"))
    spoken = F.array_join(F.transform("turns", lambda t: F.concat(t["role"], F.lit("\n"), t["text"], F.lit("\n"))), "")
    found = done.select("conv_id", turns.alias("turns"), loss_text(F.col("formatted"), F.col("loss")).alias("learned"),
                        F.length("formatted").cast("long").alias("formatted_chars"))
    return found.select("conv_id", F.size("turns").cast("long").alias("n_turns"), F.sha2(spoken.cast("binary"), 256).alias("turns_sha256"),
                        F.length("learned").cast("long").alias("loss_chars"),
                        F.sha2(F.col("learned").cast("binary"), 256).alias("loss_sha256"), "formatted_chars")


@query("op6_mix_sources")
def op6(spark: SparkSession, sf_dir: str) -> DataFrame:
    mixed = mix_sources(table(spark, sf_dir, "documents").select("doc_id", "source"))
    return mixed.select("doc_id", "source", "release", "deadline", "slot", "position")


@query("op11_html_extract")
def op11(spark: SparkSession, sf_dir: str) -> DataFrame:
    model = train_extractor(labelled_pages(spark))
    found = extract_text(table(spark, sf_dir, "pages"), model)
    return found.select("page_id", "url", "text", F.length("text").cast("long").alias("n_chars"))


@query("op12_periodic_runs")
def op12(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = periodic_runs(with_cycles(table(spark, sf_dir, "documents"))).withColumn("best", strongest(F.col("runs")))
    line = lambda r: F.concat_ws(",", r["start"].cast("string"), r["length"].cast("string"), r["period"].cast("string"))
    lines = F.array_join(F.transform("runs", lambda r: F.concat(line(r), F.lit("\n"))), "")
    milli = F.call_function("div", F.col("best.length") * 1000, F.col("best.period"))
    return found.select(
        "doc_id", F.size("runs").cast("long").alias("n_runs"), F.col("best.start").alias("start"), F.col("best.length").alias("length"),
        F.col("best.period").alias("period"), milli.alias("exponent_milli"),
        F.sha2(lines.cast("binary"), 256).alias("runs_sha256"), F.sha2(F.col("collapsed").cast("binary"), 256).alias("collapsed_sha256"))


def _clusters_sql(rounds: int = 3, k: int = 16) -> str:
    """The rounds of op13 written out one after another."""
    nearest = """
    a{r} AS (SELECT row, (m % {k})::INT AS c, (m // {k})::BIGINT AS d FROM (
        SELECT row, min(list_sum([(q[i] - p[i]) * (q[i] - p[i]) for i in range(1, 65)]) * {k} + c) AS m
        FROM kept CROSS JOIN c{r} GROUP BY row))"""
    means = """
    m{r} AS (SELECT c, list(((s - ((s % n) + n) % n) // n)::BIGINT ORDER BY i) AS p FROM (
        SELECT c, i, sum(v)::BIGINT AS s, count(*)::BIGINT AS n FROM (
            SELECT c, unnest(q) AS v, generate_subscripts(q, 1) AS i FROM a{r} JOIN kept USING (row)) GROUP BY c, i) GROUP BY c),
    c{s} AS (SELECT c, coalesce(m{r}.p, c{r}.p) AS p FROM c{r} LEFT JOIN m{r} USING (c))"""
    steps = []
    for r in range(rounds + 1):
        steps.append(nearest.format(r=r, k=k))
        if r < rounds:
            steps.append(means.format(r=r, s=r + 1))
    return f"""
    WITH kept AS (
        SELECT row_number() OVER () AS row, vec_id, [floor(64 * x::DOUBLE)::BIGINT for x in embedding] AS q
        FROM embeddings WHERE len(embedding) = 64 AND len([x for x in embedding if x IS NULL OR NOT isfinite(x)]) = 0),
    c0 AS (
        SELECT row_number() OVER (ORDER BY sha256('1:' || vec_id), q) - 1 AS c, q AS p
        FROM kept QUALIFY row_number() OVER (ORDER BY sha256('1:' || vec_id), q) <= {k}),{",".join(steps)}
    SELECT vec_id, c AS cluster, d AS distance, (sum(d) OVER (PARTITION BY c))::BIGINT AS cluster_inertia,
           (sum(d) OVER ())::BIGINT AS inertia, sha256(array_to_string(p, ',')) AS centroid_sha256
    FROM a{rounds} JOIN kept USING (row) JOIN c{rounds} USING (c)"""


@query("op13_centroid_clusters", _clusters_sql())
def op13(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = cluster_vectors(table(spark, sf_dir, "embeddings"))
    digest = F.sha2(F.array_join("centroid", ",").cast("binary"), 256)
    return found.select("vec_id", "cluster", "distance", "cluster_inertia", "inertia", digest.alias("centroid_sha256"))
