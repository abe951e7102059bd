"""One registered query per operator of this package, over its whole table."""

from __future__ import annotations

import tempfile
import zipfile
from collections.abc import Callable
from pathlib import Path

from pyspark.sql import DataFrame, SparkSession

from . import bpe, decontaminate, jaccard, katz, language, linededup, neighbours, quality, spelling, suffixes, toxicity, urls, vertical

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLES: dict[str, str] = {}

_SHIPPED: dict[str, str] = {}


def ship(spark: SparkSession) -> None:
    """Give executors this package's source, whatever their own search path holds."""
    app = spark.sparkContext.applicationId
    if app in _SHIPPED:
        return
    package = Path(__file__).resolve().parents[1]
    target = Path(tempfile.mkdtemp(prefix="tristrata-code-")) / "tristrata_code.zip"
    with zipfile.ZipFile(target, "w") as out:
        for source in sorted(package.rglob("*.py")):
            out.write(source, source.relative_to(package.parent))
    spark.sparkContext.addPyFile(str(target))
    _SHIPPED[app] = str(target)


def register(fn: Callable[[SparkSession, str], DataFrame]) -> Callable[[SparkSession, str], DataFrame]:
    def query(spark: SparkSession, sf_dir: str) -> DataFrame:
        ship(spark)
        return fn(spark, sf_dir)

    query.__doc__ = fn.__doc__
    QUERIES[fn.__name__] = query
    return query


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


@register
def op1_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Quality score of every document."""
    return quality.classify(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


@register
def op2_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Byte-level BPE ids of every document, and back."""
    import public_tokenizers

    return bpe.digests(table(spark, sf_dir, "documents"), public_tokenizers.path("byte_bpe_50k.tiktoken"), public_tokenizers.PATTERN)


@register
def op3_urls(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Verdict on every page's URL."""
    return urls.judge(table(spark, sf_dir, "pages"))


@register
def op5_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Toxicity score of every document."""
    return toxicity.classify(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


@register
def op6_jaccard(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Near-duplicate component of every document: 3-word shingles, similarity of 0.9."""
    return jaccard.link(table(spark, sf_dir, "documents"), width=3, num=90, den=100).drop("text_print")


@register
def op8_language(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Language of every document."""
    return language.classify(table(spark, sf_dir, "documents"))


@register
def op9_katz(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Log probability of every document under a Katz bigram model."""
    return katz.classify(table(spark, sf_dir, "documents"))


@register
def op10_neighbours(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The 20 nearest vectors of every twentieth vector."""
    return neighbours.nearest(table(spark, sf_dir, "embeddings"))


@register
def op4_decontaminate(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Documents that hold benchmark items, with the items."""
    return decontaminate.match(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


@register
def op7_linededup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document without passages that repeat an earlier one."""
    return linededup.dedup(table(spark, sf_dir, "documents"))


@register
def op11_spelling(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Spelling variants: every frequent word with the form it is probably meant to have."""
    return spelling.variants(spelling.word_counts(table(spark, sf_dir, "documents")))


@register
def op12_repeats(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document without the 400-byte strings that stand elsewhere too."""
    return suffixes.repeats(table(spark, sf_dir, "documents")).drop("kept")


@register
def op13_negatives(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Hard negatives of every hundredth vector."""
    return vertical.hard_negatives(vertical.scaled(table(spark, sf_dir, "embeddings")))


ORACLES["op13_negatives"] = vertical.ORACLE
