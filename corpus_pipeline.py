"""A training-corpus pipeline of five operators over the table ``documents``.

Every stage takes (spark, docs, sf_dir) and works on all that its predecessor kept; its
result is written as Parquet and read again. All stages but the last return the columns
of ``documents``.
"""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tristrata.llm import bpe, decontaminate, jaccard, learning, linededup, quality
from tristrata.llm.queries import ship, table
from tristrata.shared import remove, scratch_path, scratch_scope


def drop_poor(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the quality classifier rejects go."""
    ship(spark)
    machine = quality.train(docs, table(spark, sf_dir, "labels"), ~learning.in_fold(F.col("doc_id"), 5, 0))
    return quality.accept(docs, machine)


def drop_repeated_lines(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Passages that repeat an earlier one go, and documents of which nothing is left."""
    return linededup.strip(docs)


def drop_near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of each group of near copies the document with the smallest id stays."""
    ship(spark)
    return jaccard.one_of_each(docs)


def drop_contaminated(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that hold a benchmark item go."""
    ship(spark)
    return decontaminate.clean(docs, table(spark, sf_dir, "benchmark"))


def encode(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token counts and digests of the ids and of what they decode to."""
    ship(spark)
    return bpe.digests(docs, public_tokenizers.path("byte_bpe_50k.tiktoken"), public_tokenizers.PATTERN)


STAGES = [
    ("quality", drop_poor),
    ("line_dedup", drop_repeated_lines),
    ("near_copies", drop_near_copies),
    ("decontaminate", drop_contaminated),
    ("bpe", encode),
]

#: A classifier and a tokenizer are beyond SQL; tests compare with brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The rows of the last stage; what stages and their inputs wrote meanwhile is deleted."""
    docs, before = table(spark, sf_dir, "documents"), None
    for name, stage in STAGES:
        path = scratch_path(spark, f"pipeline-{name}")
        with scratch_scope(spark):
            stage(spark, docs, sf_dir).write.parquet(path)
        if before is not None:
            remove(spark, before)
        docs, before = spark.read.parquet(path), path
    return docs
