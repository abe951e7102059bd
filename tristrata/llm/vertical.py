"""Hard negatives by a vertical scan: columns first, rows only as far as they can still matter.

Vectors lie in blocks of rows, stored one dimension after the other with the least and
greatest value of each. For an anchor the dimensions of a block are read by descending
magnitude of the anchor's component. After every few, a row's score is known up to the
contributions of the dimensions still ahead, which the block's extremes bound; rows whose
bounds rule them out leave the candidate bitmap. What is left after the last dimension has
exact scores.

The first scan finds the best positives of every anchor, the second the best negatives
within the score window of each positive. Anchors are dealt into bands and rows into
blocks, both of bounded size; a task holds one band and one block.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..shared import materialize

SCALE = 256
BLOCK_ROWS = 16384
BAND_ROWS = 4096
READ_AHEAD = 4  # dimensions between two looks at the bounds
KINDS = ("<i2", "<i4", "<i8")


def _finite(x: Column) -> Column:
    return x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf"))


def scaled(vectors: DataFrame, every: int = 7, labels: int = 10) -> DataFrame:
    """(vec_id, label, v): the rows of ``vectors`` (vec_id, embedding, label) that take part, components as whole numbers.

    Rows with a null vec_id, label or vector, or with a null or non-finite component, are left
    out, as are vectors whose scaled squared length does not fit 62 bits (no long could hold
    their scores). Where ``every`` divides vec_id the label is moved on by one. Of rows that
    share a vec_id the one with the least label, then least vector, counts.
    """
    wide = F.transform("embedding", lambda x: x.cast("double") * SCALE)
    label = F.col("label").cast("bigint")
    fits = F.aggregate("wide", F.lit(0.0), lambda a, x: a + x * x) < float(1 << 61)
    return (
        vectors.where(F.col("vec_id").isNotNull() & F.col("label").isNotNull() & F.col("embedding").isNotNull() & F.forall("embedding", _finite))
        .select("vec_id", F.when(F.col("vec_id") % every == 0, (label + 1) % labels).otherwise(label).alias("label"), wide.alias("wide"))
        .where(fits)
        .select("vec_id", F.struct("label", F.transform("wide", lambda x: F.floor(x).cast("bigint")).alias("v")).alias("row"))
        .groupBy("vec_id").agg(F.min("row").alias("row"))
        .select("vec_id", "row.label", "row.v")
    )


@dataclass
class Block:
    """Rows stored by dimension."""

    ids: np.ndarray
    labels: np.ndarray
    columns: np.ndarray  # dimension x row
    low: np.ndarray
    high: np.ndarray

    def ahead(self, q: np.ndarray, order: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Least and greatest contribution of the dimensions order[i:], for every i, rounded outwards."""
        ends = np.stack([q[order] * self.low[order].astype(float), q[order] * self.high[order].astype(float)])
        slack = 1 + 1e-9 * np.abs(ends).sum()
        tail = lambda x: np.append(np.cumsum(x[::-1])[::-1], 0.0)
        return tail(ends.min(axis=0)) - slack, tail(ends.max(axis=0)) + slack


def _scan(q: np.ndarray, block: Block, rows: np.ndarray, needed) -> tuple[np.ndarray, np.ndarray]:
    """Rows that stay candidates to the end and their exact scores; ``needed`` judges bounds."""
    order = np.argsort(-np.abs(q), kind="stable")
    least, most = block.ahead(q, order)
    score = np.zeros(len(rows), dtype=np.int64)
    for at in range(0, len(q) + 1, READ_AHEAD):
        if not len(rows):
            break
        keep = needed(score + least[at], score + most[at])
        if not keep.all():
            rows, score = rows[keep], score[keep]
        for d in order[at : at + READ_AHEAD]:
            score += q[d] * block.columns[d][rows].astype(np.int64)
    return rows, score


def _best(ids: np.ndarray, score: np.ndarray, k: int) -> np.ndarray:
    return np.lexsort((ids, -score))[:k]


def best_rows(q: np.ndarray, block: Block, rows: np.ndarray, k: int) -> tuple[np.ndarray, np.ndarray]:
    """The ``k`` rows with the largest scores, ties to the smaller id, and these scores."""

    def needed(low: np.ndarray, high: np.ndarray) -> np.ndarray:
        if len(low) <= k:
            return np.ones(len(low), dtype=bool)
        return high >= np.partition(low, len(low) - k)[len(low) - k]

    rows, score = _scan(q, block, rows, needed)
    best = _best(block.ids[rows], score, k)
    return rows[best], score[best]


def rows_within(q: np.ndarray, block: Block, rows: np.ndarray, windows: list[tuple[int, int]], k: int) -> list[tuple[np.ndarray, np.ndarray]]:
    """For each window of scores, both ends included, the ``k`` rows with the largest scores in it."""

    def needed(low: np.ndarray, high: np.ndarray) -> np.ndarray:
        out = np.zeros(len(low), dtype=bool)
        for bottom, top in windows:
            may = (high >= bottom) & (low <= top)
            sure = low[(low >= bottom) & (high <= top)]
            if len(sure) > k:
                may &= high >= np.partition(sure, len(sure) - k)[len(sure) - k]
            out |= may
        return out

    rows, score = _scan(q, block, rows, needed)
    found = []
    for bottom, top in windows:
        inside = np.flatnonzero((score >= bottom) & (score <= top))
        best = inside[_best(block.ids[rows[inside]], score[inside], k)]
        found.append((rows[best], score[best]))
    return found


def blocks_of(rows: DataFrame, blocks: int) -> DataFrame:
    """(dim, block, ids, labels, kind, columns): rows (vec_id, label, v) by dimension, ``blocks`` in all."""

    def store(table: pa.Table) -> pa.Table:
        dim = table.column("dim")[0].as_py()
        v = table.column("v").combine_chunks().flatten().to_numpy(zero_copy_only=False).reshape(table.num_rows, dim)
        most = int(np.abs(v).max(initial=0))
        kind = next(k for k in KINDS if most <= np.iinfo(k).max)
        binary = lambda x: pa.array([x.tobytes()], pa.binary())
        return pa.table({
            "dim": table.column("dim")[:1], "block": table.column("block")[:1], "ids": binary(table.column("vec_id").to_numpy()),
            "labels": binary(table.column("label").to_numpy()), "kind": pa.array([kind]), "columns": binary(np.ascontiguousarray(v.T.astype(kind))),
        })

    placed = rows.select("vec_id", "label", "v", F.size("v").alias("dim"), F.pmod(F.xxhash64("vec_id"), F.lit(blocks)).cast("int").alias("block"))
    return placed.groupBy("dim", "block").applyInArrow(store, "dim int, block int, ids binary, labels binary, kind string, columns binary")


def _block(table: pa.Table) -> Block:
    row = {c: table.column(c)[0].as_py() for c in table.column_names}
    ids = np.frombuffer(row["ids"], "<i8")
    columns = np.frombuffer(row["columns"], row["kind"]).reshape(row["dim"], len(ids))
    return Block(ids, np.frombuffer(row["labels"], "<i8"), columns, columns.min(axis=1).astype(np.int64), columns.max(axis=1).astype(np.int64))


def _meet(anchors: DataFrame, blocks: DataFrame, n_bands: int, n_blocks: int, run, schema: str) -> DataFrame:
    """Every band of anchors with every block of rows: the stated query set against all rows."""
    band = F.pmod(F.xxhash64("vec_id", F.lit(1)), F.lit(n_bands)).cast("int")
    left = anchors.select("*", F.size("v").alias("dim"), band.alias("band"), F.explode(F.sequence(F.lit(0), F.lit(n_blocks - 1))).alias("block"))
    right = blocks.withColumn("band", F.explode(F.sequence(F.lit(0), F.lit(n_bands - 1))))
    key = ["dim", "band", "block"]

    def both(asked: pa.Table, block: pa.Table) -> pa.Table:
        rows = list(run(asked, _block(block))) if asked.num_rows and block.num_rows else []
        columns = [c.split()[0] for c in schema.split(", ")]
        return pa.table({c: pa.array([r[i] for r in rows], pa.int64()) for i, c in enumerate(columns)})

    return left.groupBy(*key).cogroup(right.groupBy(*key)).applyInArrow(both, schema)


def _asked(table: pa.Table) -> Iterator[tuple[int, int, np.ndarray]]:
    dim = table.column("dim")[0].as_py()
    v = table.column("v").combine_chunks().flatten().to_numpy(zero_copy_only=False).reshape(table.num_rows, dim)
    yield from zip(table.column("vec_id").to_pylist(), table.column("label").to_pylist(), v)


def hard_negatives(rows: DataFrame, every: int = 100, positives: int = 5, negatives: int = 5, low: int = 80, high: int = 100) -> DataFrame:
    """anchor_id, positive_id, rank, negative_id, positive_score, negative_score over ``rows`` (vec_id, label, v).

    Anchors are the rows whose vec_id ``every`` divides. Scores are exact inner products;
    higher ones come first, ties by smaller vec_id. An anchor's positives are its first other
    rows of the same label; for each, the first rows of other labels follow whose score is at
    least ``low`` and at most ``high`` hundredths of the positive's. Rows of another length
    than the anchor's do not meet it. Ids are unique in ``rows`` (see ``scaled``).
    """
    rows = materialize(rows, "scaled-vectors")
    count = rows.count()
    n_blocks = max(1, -(-count // BLOCK_ROWS))
    anchors = rows.where(F.col("vec_id") % every == 0)
    n_bands = max(1, -(-anchors.count() // BAND_ROWS))
    blocks = materialize(blocks_of(rows, n_blocks), "vector-columns")

    def closest(asked: pa.Table, block: Block) -> Iterator[tuple]:
        for number, label, q in _asked(asked):
            found, score = best_rows(q, block, np.flatnonzero((block.labels == label) & (block.ids != number)), positives)
            yield from ((number, int(i), int(s)) for i, s in zip(block.ids[found], score))

    near = _meet(anchors, blocks, n_bands, n_blocks, closest, "anchor_id bigint, positive_id bigint, positive_score bigint")
    order = Window.partitionBy("anchor_id").orderBy(F.col("positive_score").desc(), "positive_id")
    near = near.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= positives)
    # At most ``positives`` in a row.
    near = near.groupBy(F.col("anchor_id").alias("vec_id")).agg(F.sort_array(F.collect_list(F.struct("rank", "positive_id", "positive_score"))).alias("near"))
    known = materialize(anchors.join(near, "vec_id"), "anchors")

    def farther(asked: pa.Table, block: Block) -> Iterator[tuple]:
        for (number, label, q), near in zip(_asked(asked), asked.column("near").to_pylist()):
            windows = [(-(-low * p["positive_score"] // 100), high * p["positive_score"] // 100) for p in near]
            for p, (found, score) in zip(near, rows_within(q, block, np.flatnonzero(block.labels != label), windows, negatives)):
                yield from ((number, p["positive_id"], p["positive_score"], int(i), int(s)) for i, s in zip(block.ids[found], score))

    schema = "anchor_id bigint, positive_id bigint, positive_score bigint, negative_id bigint, negative_score bigint"
    hard = _meet(known, blocks, n_bands, n_blocks, farther, schema)
    order = Window.partitionBy("anchor_id", "positive_id").orderBy(F.col("negative_score").desc(), "negative_id")
    return (
        hard.withColumn("rank", F.row_number().over(order).cast("int")).where(F.col("rank") <= negatives)
        .select("anchor_id", "positive_id", "rank", "negative_id", "positive_score", "negative_score")
    )


ORACLE = """
WITH usable AS (
  SELECT vec_id, CASE WHEN vec_id % 7 = 0 THEN (CAST(label AS BIGINT) + 1) % 10 ELSE CAST(label AS BIGINT) END AS label,
         list_transform(embedding, lambda x: CAST(floor(256 * CAST(x AS DOUBLE)) AS BIGINT)) AS v
  FROM embeddings
  WHERE vec_id IS NOT NULL AND label IS NOT NULL AND embedding IS NOT NULL
    AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0
),
scored AS (
  SELECT a.vec_id AS anchor_id, b.vec_id, a.label = b.label AS same,
         CAST(list_sum(list_transform(list_zip(a.v, b.v), lambda z: z[1] * z[2])) AS BIGINT) AS score
  FROM usable a JOIN usable b ON a.vec_id <> b.vec_id AND len(a.v) = len(b.v) WHERE a.vec_id % 100 = 0
),
positives AS (
  SELECT anchor_id, vec_id AS positive_id, score AS positive_score FROM scored WHERE same
  QUALIFY row_number() OVER (PARTITION BY anchor_id ORDER BY score DESC, vec_id) <= 5
)
SELECT p.anchor_id, p.positive_id,
       CAST(row_number() OVER (PARTITION BY p.anchor_id, p.positive_id ORDER BY s.score DESC, s.vec_id) AS INTEGER) AS rank,
       s.vec_id AS negative_id, p.positive_score, s.score AS negative_score
FROM positives p JOIN scored s ON p.anchor_id = s.anchor_id AND NOT s.same
 AND 80 * p.positive_score <= 100 * s.score AND 100 * s.score <= 100 * p.positive_score
QUALIFY row_number() OVER (PARTITION BY p.anchor_id, p.positive_id ORDER BY s.score DESC, s.vec_id) <= 5
"""
