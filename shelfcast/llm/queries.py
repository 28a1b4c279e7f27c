"""The operators over their whole tables, as registered queries."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession, functions as F

from . import (
    bwt_dedup,
    decontaminate,
    html_paths,
    line_dedup,
    mixing,
    periodic_runs,
    pseudo_likelihood,
    ranked_search,
    sketch_dedup,
    substring_dedup,
    toxicity,
    url_rules,
    vector_forest,
)

Query = Callable[[SparkSession, str], DataFrame]

QUERIES: dict[str, Query] = {}

#: SQL of the expected rows, where SQL can express them over whole tables.
EXPECTED: dict[str, str] = {}

#: Given host-path rules with their verdicts.
URL_RULES = (
    ("com/", "allow"),
    ("example.com/en/", "block"),
    ("www.example.com/en/", "allow"),
    ("net/es/", "block"),
    ("net/fr/", "block"),
)


def query(name: str, expected: str | None = None):
    def register(function: Query) -> Query:
        QUERIES[name] = function
        if expected:
            EXPECTED[name] = expected
        return function

    return register


def table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{folder}/{name}.parquet")


@query("op1_line_dedup")
def line_duplicates(spark: SparkSession, folder: str) -> DataFrame:
    docs = table(spark, folder, "documents").select("doc_id", "text")
    return line_dedup.without_repeated_lines(docs).select(
        "doc_id", "n_lines", "n_removed", "removed", F.sha2("text", 256).alias("kept_sha256")
    )


@query("op2_source_mix")
def source_mix(spark: SparkSession, folder: str) -> DataFrame:
    plan = mixing.mix(table(spark, folder, "documents"), with_spans=False)
    return plan.select("doc_id", "source", "size", "source_size", "target", "taken")


@query("op3_benchmark_leaks")
def benchmark_leaks(spark: SparkSession, folder: str) -> DataFrame:
    docs = table(spark, folder, "documents").select("doc_id", "text")
    found = decontaminate.find_leaks(docs, table(spark, folder, "benchmark"), keep_text=False)
    return found.select("doc_id", F.explode("leaks").alias("leak")).select("doc_id", "leak.*")


@query("op4_main_text")
def main_text(spark: SparkSession, folder: str) -> DataFrame:
    return html_paths.main_texts(table(spark, folder, "pages")).select("page_id", "url", "text", "n_chars")


@query("op5_near_copies")
def near_copies(spark: SparkSession, folder: str) -> DataFrame:
    return sketch_dedup.near_copies(table(spark, folder, "documents"), n=4, percent=80)


@query("op6_nearest_vectors")
def nearest_vectors(spark: SparkSession, folder: str) -> DataFrame:
    return vector_forest.nearest(table(spark, folder, "embeddings"), k=20, every=20)


@query("op7_url_rules")
def url_verdicts(spark: SparkSession, folder: str) -> DataFrame:
    pages = table(spark, folder, "pages").select("page_id", "url")
    return url_rules.judge(pages, URL_RULES).select("page_id", "host", "path", "rule", "verdict")


@query("op8_toxicity")
def toxicity_scores(spark: SparkSession, folder: str) -> DataFrame:
    docs = table(spark, folder, "documents").select("doc_id", "text")
    scored = toxicity.toxicity(docs, table(spark, folder, "labels"))
    return scored.select(
        "doc_id",
        toxicity.held_out(F.col("doc_id")).alias("held_out"),
        "score",
        (F.col("score") >= 0.5).cast("int").alias("predicted"),
    )


@query("op9_repeated_passages")
def repeated_passages(spark: SparkSession, folder: str) -> DataFrame:
    cut = substring_dedup.without_repeats(table(spark, folder, "documents"))
    return cut.select("doc_id", "n_words", "n_removed", F.sha2("kept", 256).alias("kept_sha256"))


@query("op10_pseudo_likelihood")
def document_scores(spark: SparkSession, folder: str) -> DataFrame:
    docs = table(spark, folder, "documents").select("doc_id", "text")
    return pseudo_likelihood.pseudo_likelihood(docs)


def with_periodic_tails(docs: DataFrame) -> DataFrame:
    """Every tenth document by the CRC-32 of its doc_id repeats a stretch of its words to its end.

    With g the rest of that number: from word a = g mod n on, the p = 1 + (n - a) div (3 + g mod 8) words
    after it repeat. Other texts, and texts without words, stay as they are.
    """
    h = F.crc32(F.col("doc_id").cast("long").cast("string"))
    words = F.regexp_extract_all("text", F.lit(r"[^\x20\x09-\x0D]+"), F.lit(0))
    marked = docs.select(
        "doc_id", "text", F.floor(h / 10).alias("g"), F.when(h % 10 == 0, words).alias("words")
    ).withColumn("n", F.size("words"))
    a = F.expr("CAST(g % n AS INT)")
    placed = marked.withColumn("a", F.when(F.col("n") > 0, a))
    placed = placed.withColumn("p", F.expr("1 + CAST(floor((n - a) / (3 + g % 8)) AS INT)"))
    repeated = F.expr(
        "array_join(slice(concat(slice(words, 1, a), "
        "flatten(array_repeat(slice(words, a + 1, p), CAST(ceil((n - a) / p) AS INT)))), 1, n), ' ')"
    )
    return placed.select("doc_id", F.when(F.col("n") > 0, repeated).otherwise(F.col("text")).alias("text"))


@query("op11_periodic_runs")
def periods(spark: SparkSession, folder: str) -> DataFrame:
    docs = with_periodic_tails(table(spark, folder, "documents").select("doc_id", "text"))
    found = periodic_runs.periodic_runs(docs)
    longest = F.expr("array_max(transform(runs, r -> struct(r.length AS length, -r.start AS s, -r.period AS p)))")
    lines = F.expr("concat_ws('', transform(runs, r -> concat(r.start, ',', r.length, ',', r.period, '\n')))")
    return found.withColumn("top", longest).select(
        "doc_id",
        F.size("runs").cast("long").alias("n_runs"),
        (-F.col("top.s")).alias("start"),
        F.col("top.length").alias("length"),
        (-F.col("top.p")).alias("period"),
        F.expr("(1000 * top.length) div (-top.p)").alias("exponent_milli"),
        F.sha2(lines, 256).alias("runs_sha256"),
        F.sha2("collapsed", 256).alias("collapsed_sha256"),
    )


RANKED_SQL = r"""
WITH d AS (SELECT doc_id, unnest(regexp_extract_all(
             translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
             '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+')) AS term FROM documents),
counts AS (SELECT doc_id, term, count(*) AS tf FROM d GROUP BY ALL),
lengths AS (SELECT doc_id, count(*) AS n FROM d GROUP BY ALL),
whole AS (SELECT count(*) AS docs, CAST(sum(n) AS BIGINT) AS words FROM lengths),
weights AS (SELECT term, CAST(floor(1000 * ln((2 * docs + 2) / (2 * count(*) + 1))) AS BIGINT) AS w
            FROM counts, whole GROUP BY term, docs),
items AS (SELECT DISTINCT item_id, unnest(regexp_extract_all(
             translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
             '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+')) AS term FROM benchmark),
scores AS (SELECT item_id, doc_id,
             CAST(sum(w * ((1000000000 * tf) // (1000 * tf + 20 * (50 + (50 * n * docs) // words)))) AS BIGINT) AS score
           FROM items JOIN counts USING (term) JOIN weights USING (term) JOIN lengths USING (doc_id), whole
           GROUP BY ALL),
ranked AS (SELECT item_id, CAST(row_number() OVER (PARTITION BY item_id ORDER BY score DESC, doc_id) AS INT) AS rank,
             doc_id, score FROM scores WHERE score > 0)
SELECT * FROM ranked WHERE rank <= 50
"""


@query("op12_ranked_search", RANKED_SQL)
def ranked(spark: SparkSession, folder: str) -> DataFrame:
    docs = table(spark, folder, "documents").select("doc_id", "text")
    return ranked_search.rank(docs, table(spark, folder, "benchmark").select("item_id", "text"))


@query("op13_repeated_bytes")
def repeated_bytes(spark: SparkSession, folder: str) -> DataFrame:
    cut = bwt_dedup.without_repeated_bytes(table(spark, folder, "documents").select("doc_id", "text"))
    return cut.select("doc_id", "n_bytes", "n_removed", "n_spans", F.sha2("kept", 256).alias("kept_sha256"))
