"""Corpus pipeline: toxicity, quality, exact dedup, near-dedup and packing over the documents table."""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from riskloom.llm import exact_dedup, minhash, packing, quality, toxicity
from riskloom.llm.common import fold, fresh, matching_rows, stage, table

#: Words of a shingle and percent of similarity of the near-duplicate stage.
SHINGLE, PERCENT = 5, 80


def toxicity_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents at a chance of being toxic of one half or more go."""
    labels = table(spark, sf_dir, "labels").where(fold(F.col("doc_id"), 5) != 0)
    score = fresh(docs, "toxic_score")
    scored = toxicity.toxicity_scores(
        docs, labels.select("doc_id", F.col("toxic").alias("label")), score_col=score
    )
    return scored.where(F.col(score) < 0.5).select(docs.columns)


def quality_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents at a chance of good quality under one half go."""
    labels = table(spark, sf_dir, "labels").where(fold(F.col("doc_id"), 3) != 1)
    scores = quality.quality_scores(docs, labels.select("doc_id", F.col("quality").alias("label")))
    kept = scores.where("score >= 0.5")
    return matching_rows(docs, kept, doc_id=F.col("doc_id"), text_hash=F.xxhash64("text"))


def exact_dedup_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One row of each text stays."""
    return exact_dedup.exact_dedup(docs)


def near_dedup_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The document with the smallest id of each group of near copies stays."""
    kept = minhash.near_duplicates(docs, size=SHINGLE, percent=PERCENT).where("kept")
    return matching_rows(docs, kept, doc_id=F.col("doc_id"))


def packing_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The token pieces of all documents that are left."""
    return packing.pack(
        docs, public_tokenizers.path("byte_bpe_50k.json"), public_tokenizers.PATTERN, end_id=1
    )


STAGES = [
    ("toxicity", toxicity_stage),
    ("quality", quality_stage),
    ("exact_dedup", exact_dedup_stage),
    ("near_dedup", near_dedup_stage),
    ("packing", packing_stage),
]

#: Trained models decide the first stages and a tokenizer's pieces end it: SQL states neither.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over `documents`; each one's result is a table that the next one reads."""
    docs = table(spark, sf_dir, "documents")
    for name, step in STAGES:
        docs = stage(step(spark, docs, sf_dir), f"pipeline-{name}")
    return docs
