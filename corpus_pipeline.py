"""The corpus pipeline: documents that are not toxic, one of each group of near copies,
without shared passages, free of benchmark texts, packed into sequences.

Every stage takes (spark, docs, sf_dir) and works on all that the stage before
it kept; `run` writes each result as Parquet to the folder that
`spark.checkpoint.dir` names and reads it again for the next one.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from gleanery.llm import chain, queries, seeds, simhash, substring
from gleanery.scale import written
from gleanery.sources.tables import read_table


def toxicity(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the classifier chain does not reject, unchanged."""
    labels = read_table(spark, sf_dir, "labels")
    model = chain.fit(docs, labels, "doc_id", "text", chain.corpus_categories())
    scored = chain.scored(docs, "text", model, "_categories")
    kept = scored.filter(F.col("_categories.toxic") < chain.REJECT_FROM)
    return kept.select(*docs.columns)


def near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of every group of documents linked by SimHash the one with the least doc_id, unchanged."""
    return simhash.one_per_group(docs, "doc_id", "text")


def shared_passages(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without the passages they share with earlier ones; n_chars is brought up to date.

    A document that consists of such passages is left with an empty text and goes.
    """
    cut = substring.without_copies(docs, "doc_id", "text")
    touched = F.size("removed") > 0
    left = cut.filter(~touched | (F.btrim("text") != ""))
    if "n_chars" in docs.columns:
        kind = docs.schema["n_chars"].dataType
        count = F.when(touched, F.length("text").cast(kind)).otherwise(F.col("n_chars"))
        left = left.withColumn("n_chars", count)
    return left.select(*docs.columns)


def decontamination(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that overlap no text of the benchmark, unchanged."""
    benchmark = read_table(spark, sf_dir, "benchmark")
    return seeds.without_overlaps(docs, "doc_id", "text", benchmark, "item_id", "text")


def packing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pieces of the sequences that the documents fill."""
    return queries.packed_pieces(docs)


STAGES: list[tuple[str, Callable[[SparkSession, DataFrame, str], DataFrame]]] = [
    ("toxicity", toxicity),
    ("near_copies", near_copies),
    ("shared_passages", shared_passages),
    ("decontamination", decontamination),
    ("packing", packing),
]

# Trained models and tokenizers are beyond SQL; the tests check every stage by brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over the documents of `sf_dir`."""
    docs = read_table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = written(stage(spark, docs, sf_dir), name)
    return written(STAGES[-1][1](spark, docs, sf_dir), STAGES[-1][0])
