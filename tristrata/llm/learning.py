"""Shared by the trained operators: folds, labelled samples, fitting in one task."""

from __future__ import annotations

import pickle
from collections.abc import Callable, Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

FIT_ROWS = 10_000


def fold(doc_id: Column, parts: int) -> Column:
    """crc32 of the id as text, modulo ``parts``; a null id falls in no fold."""
    return F.crc32(doc_id.cast("string").cast("binary")) % parts


def in_fold(doc_id: Column, parts: int, held: int) -> Column:
    return F.coalesce(fold(doc_id, parts) == held, F.lit(False))


def labelled_sample(docs: DataFrame, labels: DataFrame, label: str, keep: Column, columns: list[str], rows: int) -> DataFrame:
    """About ``rows`` labelled documents, chosen by a hash of the id: columns and ``label``.

    Null ids and labels are left out, as are ids whose labels disagree. Of documents
    that share an id the least text is taken.
    """
    one = (
        labels.select("doc_id", F.col(label).cast("int").alias("label"))
        .where(F.col("doc_id").isNotNull() & F.col("label").isNotNull() & keep)
        .groupBy("doc_id")
        .agg(F.min("label").alias("label"), F.max("label").alias("other"))
        .where("label = other")
        .drop("other")
    )
    there = one.count()
    share = min(1.0, rows / max(there, 1))
    spread = F.pmod(F.xxhash64("doc_id", F.lit(label)), F.lit(1 << 30))
    # At most about ``rows`` pairs of numbers: small whatever the table holds.
    chosen = F.broadcast(one.where(spread < int(share * (1 << 30))))
    kept = [c for c in columns if c != "doc_id"]
    return (
        docs.select("doc_id", *kept)
        .join(chosen, "doc_id")
        .groupBy("doc_id", "label")
        .agg(F.min_by(F.struct(*kept), F.coalesce("text", F.lit(""))).alias("row"))
        .select("doc_id", "label", "row.*")
    )


def fit_in_task(sample: DataFrame, fit: Callable[[pa.Table], object]):
    """Run ``fit`` on a bounded sample in one task and return its (small) model."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held = list(batches)
        if held:
            yield pa.RecordBatch.from_pydict({"model": [pickle.dumps(fit(pa.Table.from_batches(held).sort_by("doc_id")))]})

    got = sample.repartition(1).mapInArrow(run, "model binary").collect()
    return pickle.loads(bytes(got[0].model)) if got else None
