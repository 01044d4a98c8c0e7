"""From raw documents to packed training sequences, stage by stage.

Each stage takes (spark, docs, sf_dir) and works on all rows that the one before it kept; ``run`` writes every stage
to the shared folder and reads it again. All but the last return the columns of ``documents``; extra columns pass.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.llm import decontaminate, jaccard, packing, quality, secret_scan
from tidemark.llm.common import free_name, kept, table
from tidemark.llm.queries import packing_length


def quality_filter(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the quality classifier accepts.

    Each row is judged by its text, null as empty, so rows that repeat stay or go together; no other column matters.
    """
    model = quality.train(docs, table(spark, sf_dir, "labels"))
    score = free_name(docs, "score")
    scored = docs.withColumn(score, quality.score_of(docs, model))
    return scored.where(F.col(score) >= quality.ACCEPT).drop(score)


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each class of near copies: that with the smallest id."""
    return jaccard.one_of_each_class(docs)


def decontamination(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without a benchmark passage; null texts hold none, rows that repeat stay or go together."""
    hits = free_name(docs, "hits")
    found = docs.withColumn(hits, decontaminate.matches(docs, table(spark, sf_dir, "benchmark")))
    return found.where(F.size(hits) == 0).drop(hits)


def secret_redaction(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents, each secret replaced by a mark; ``n_chars`` follows where the text changed."""
    spans = free_name(docs, "spans")
    found = secret_scan.found_spans(docs, into=spans)
    some = F.size(spans) > 0
    changed = found.withColumn("text", F.when(some, secret_scan.redacted(spans=spans)).otherwise(F.col("text")))
    if "n_chars" in docs.columns:
        kind = docs.schema["n_chars"].dataType
        changed = changed.withColumn("n_chars", F.when(some, F.length("text").cast(kind)).otherwise(F.col("n_chars")))
    return changed.select(*docs.columns)


def best_fit_packing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pieces of all documents in sequences of the permitted lengths."""
    return packing.pack_documents(docs, packing_length())


STAGES = [
    ("quality classifier", quality_filter),
    ("n-gram Jaccard join", near_duplicates),
    ("benchmark decontamination", decontamination),
    ("secret scans", secret_redaction),
    ("best-fit packing", best_fit_packing),
]

# Boosted trees, alignment and packing cannot be told in SQL; tests/llm holds a brute-force version.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES:
        docs = kept(stage(spark, docs, sf_dir), name.replace(" ", "-"))
    return docs
