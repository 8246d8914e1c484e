"""Documents to a training mix in five stages.

Each stage takes (spark, docs, sf_dir), works on all rows its predecessor kept,
and returns a table that is written as Parquet and read again as the next one's
`docs`. All but the last return the columns of `documents`; the last adds domain,
n_tokens and epochs (how often to read the row).
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from chargestream.llm import decontaminate, mixing, ngram_join, quality_rules, substring_dedup
from chargestream.llm.queries import settings, table
from chargestream.llm.shared import set_aside
from chargestream.session import stage

Stage = Callable[[SparkSession, DataFrame, str], DataFrame]


def quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the rules keep.

    Null and empty texts have no words and go. Each row is judged by itself:
    repeated rows and ids stay or go together. Columns keep their names and values, also those the rules use.
    """
    settings(spark)
    named, back = set_aside(docs)
    return back(quality_rules.apply_rules(named, keep=tuple(named.columns)).where("kept"))


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of each group of near duplicates the document with the least doc_id. Rows without an id stay.

    Rows of one id are looked at by their texts: one with a near duplicate of a smaller id goes, the others stay.
    """
    settings(spark)
    return ngram_join.without_later(docs, ngram_join.join_rows(docs, n=5, threshold=0.8), n=5)


def repeated_passages(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without the passages that an earlier one has.

    A row whose words are all repeated goes; null and empty texts stay. n_chars
    becomes the length of what is left. Of equal texts the one of the smallest
    doc_id keeps its passages.
    """
    settings(spark)
    left = substring_dedup.without_passages(docs, substring_dedup.passages(docs))
    return left.withColumn("n_chars", F.length("text").cast(docs.schema["n_chars"].dataType))


def benchmark_free(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without a window of the benchmark. Null and empty texts have none and stay, as all do if the benchmark is empty."""
    settings(spark)
    return decontaminate.remove(docs, table(spark, sf_dir, "benchmark"))


def mixed(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents of the mix. Null and empty texts have no tokens and are not chosen; null languages and sources are leaves of their own."""
    settings(spark)
    return mixing.choose(docs)


STAGES: list[tuple[str, Stage]] = [
    ("quality_rules", quality),
    ("near_duplicates", near_duplicates),
    ("substring_dedup", repeated_passages),
    ("decontamination", benchmark_free),
    ("mixing", mixed),
]

# Near-duplicate passages are beyond SQL; tests/llm holds the passages found and their stage against brute force, the rest against planted cases.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(settings(spark), sf_dir, "documents")
    for name, step in STAGES[:-1]:
        docs = stage(step(spark, docs, sf_dir), f"pipeline-{name}")
    return STAGES[-1][1](spark, docs, sf_dir)
