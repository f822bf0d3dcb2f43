"""The training-text pipeline over ``documents``: each stage works on what the last kept."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from goldweft.llm import decontaminate, line_dedup, mixing, ngram_join, quality
from goldweft.llm.common import count_words, read, stage


def quality_classifier(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the classifier, fitted on the labelled ones among them, takes for good."""
    return quality.keep_good(docs, quality.train(docs, read(spark, sf_dir, "labels")))


def line_deduplication(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Texts without the lines that an earlier document or line has; n_chars follows the
    text.  A document of which no word is left was a copy, and goes."""
    left = line_dedup.dedup_lines(docs, counts=("__lines", "__removed"))
    cut = F.col("__removed") > 0
    chars = F.when(cut, F.length("text").cast("long")).otherwise(F.col("n_chars"))
    kept = left.filter(~cut | (count_words("text") > 0)).withColumn("n_chars", chars)
    return kept.select(*[F.col(f"`{c}`") for c in docs.columns])


def ngram_jaccard_join(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of each group of linked documents the one with the smallest doc_id.  Rows without a
    doc_id link with nothing and stay."""
    groups = ngram_join.join(docs)
    first = groups.filter("component_id = doc_id").select("doc_id").distinct()
    return docs.join(first, "doc_id", "left_semi").unionByName(docs.filter("doc_id IS NULL"))


def benchmark_decontamination(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without a window that is near to a benchmark item."""
    return decontaminate.remove_leaks(docs, read(spark, sf_dir, "benchmark"))


def mixing_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The documents the mix takes, with how many words of each it takes (``taken``)."""
    return mixing.mix(docs, F.array("source"), keep=tuple(docs.columns)).filter("taken > 0")


STAGES = [
    ("quality classifier", quality_classifier),
    ("line dedup", line_deduplication),
    ("n-gram Jaccard join", ngram_jaccard_join),
    ("benchmark decontamination", benchmark_decontamination),
    ("mixing sources to target weights", mixing_sources),
]

#: A compression classifier cannot be written in SQL; tests/llm hold a brute-force version.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``; each result is written as Parquet and read again."""
    docs = read(spark, sf_dir, "documents")
    for name, function in STAGES:
        docs = stage(function(spark, docs, sf_dir), name.replace(" ", "-"))
    return docs
