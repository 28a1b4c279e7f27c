"""From raw documents to a training mix, in stages that each write a table the next one reads.

toxicity -> near-duplicate lines -> near-duplicate documents -> benchmark leaks -> source mix.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession, functions as F

from shelfcast.llm.decontaminate import find_leaks
from shelfcast.llm.line_dedup import without_repeated_lines
from shelfcast.llm.mixing import mix
from shelfcast.llm.sketch_dedup import near_copies
from shelfcast.llm.toxicity import toxicity
from shelfcast.session import fresh_path

COLUMNS = ["doc_id", "text", "lang", "source", "n_chars"]


def _table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{folder}/{name}.parquet")


def toxicity_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents scored 0.5 or more go; the model learns from the labels that aren't held out."""
    return toxicity(docs.select(COLUMNS), _table(spark, sf_dir, "labels")).where("score < 0.5").select(COLUMNS)


def line_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Lines near an earlier one go; a document that loses every line goes with them.

    A document that keeps a line of any length stays, and so does one that had no text to begin with.
    """
    rows = without_repeated_lines(docs.select(COLUMNS))
    emptied = (F.col("n_removed") > 0) & (F.trim(F.col("text"), F.lit(" \t\r\n\x0b\x0c")) == "")
    n_chars = F.when(F.col("n_removed") > 0, F.length("text").cast("long")).otherwise(F.col("n_chars"))
    return rows.where(~F.coalesce(emptied, F.lit(False))).withColumn("n_chars", n_chars).select(COLUMNS)


def near_copy_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group stays: the smallest doc_id of those linked at 0.8 on five words.

    Documents without doc_id take no part and stay.
    """
    kept = near_copies(docs, n=5, percent=80).where("kept AND doc_id IS NOT NULL").select("doc_id").distinct()
    # A row without doc_id has no match among the documents that go, so the two cases are joined apart.
    named = docs.select(COLUMNS).join(kept, "doc_id", "left_semi").select(COLUMNS)
    return named.union(docs.where("doc_id IS NULL").select(COLUMNS))


def leak_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that hold a benchmark item go."""
    found = find_leaks(docs.select(COLUMNS), _table(spark, sf_dir, "benchmark"))
    return found.where(F.size("leaks") == 0).select(COLUMNS)


def mixing_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The plan of the mix: what each document gives, as word spans with their repeats."""
    return mix(docs)


STAGES: list[tuple[str, Callable[[SparkSession, DataFrame, str], DataFrame]]] = [
    ("toxicity", toxicity_stage),
    ("line_dedup", line_stage),
    ("near_copies", near_copy_stage),
    ("benchmark_leaks", leak_stage),
    ("source_mix", mixing_stage),
]

#: The stages train models and align texts, which SQL cannot express.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``; each result is written to the shared folder and read again."""
    docs = _table(spark, sf_dir, "documents")
    for name, stage in STAGES:
        path = fresh_path(spark, f"pipeline-{name}")
        stage(spark, docs, sf_dir).write.parquet(path)
        docs = spark.read.parquet(path)
    return docs


PIPELINE = {"pipeline": run}
