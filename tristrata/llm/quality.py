"""Quality classifier: a factorisation machine over words, structure and metadata.

score = w0 + sum_i w_i x_i + 1/2 sum_f [(sum_i v_if x_i)^2 - sum_i (v_if x_i)^2],
that is, all pairwise interactions in time linear in the number of features.
Features of a text: its distinct hashed words (weight 1/sqrt of their number),
binned structure statistics and the binned ``n_chars`` column (null: a bin of its own).
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from . import learning, textual

WORD_BITS = 16
BINS = 32
STATISTICS = 13
SIZE = (1 << WORD_BITS) + (STATISTICS + 1) * BINS


def _classes() -> np.ndarray:
    """Byte classes: 0 upper, 1 lower, 2 digit, 3 space, 4 line feed, 5 full stop or comma, 6 other ASCII, 7 beyond."""
    out = np.full(256, 6, dtype=np.uint8)
    out[128:] = 7
    out[ord("A") : ord("Z") + 1] = 0
    out[ord("a") : ord("z") + 1] = 1
    out[ord("0") : ord("9") + 1] = 2
    out[[9, 11, 12, 13, 32]] = 3
    out[10] = 4
    out[[ord("."), ord(",")]] = 5
    return out


CLASSES = _classes()


def _share_bin(part: np.ndarray, whole: np.ndarray) -> np.ndarray:
    """Shares on a square-root scale, so that small shares are told apart."""
    return np.minimum(np.sqrt(part / np.maximum(whole, 1)) * BINS, BINS - 1).astype(np.int64)


def _size_bin(size: np.ndarray) -> np.ndarray:
    return np.minimum(np.log2(np.maximum(size, 0) + 1.0) * 1.5, BINS - 1).astype(np.int64)


def features(texts: pa.Array, n_chars: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(text, feature, value) triples ordered by text."""
    w = textual.words_of(texts)
    n = len(w.counts)
    size = np.diff(w.offsets)
    text = w.texts
    bucket = (w.hashes() >> np.uint64(64 - WORD_BITS)).astype(np.int64)
    pair, times = np.unique((text << WORD_BITS) | bucket, return_counts=True)
    of, word = pair >> WORD_BITS, pair & ((1 << WORD_BITS) - 1)
    distinct = np.bincount(of, minlength=n)
    # Bytes per text and class: differences of running counts at the text borders.
    kinds = []
    codes = CLASSES[w.raw]
    for k in range(8):
        run = np.concatenate([[0], np.cumsum(codes == k, dtype=np.int64)])
        kinds.append(run[w.offsets[1:]] - run[w.offsets[:-1]])
    top = np.zeros(n, dtype=np.int64)
    np.maximum.at(top, of, times)
    long = np.bincount(text[w.lengths > 12], minlength=n) if len(text) else np.zeros(n)
    stats = [
        _size_bin(size),
        _size_bin(w.counts),
        _share_bin(distinct, w.counts),
        _share_bin(top, w.counts),
        _share_bin(kinds[0], size),
        _share_bin(kinds[2], size),
        _share_bin(kinds[4], w.counts),
        _share_bin(kinds[5], w.counts),
        _share_bin(kinds[6], size),
        _share_bin(kinds[7], size),
        np.minimum(size / np.maximum(w.counts, 1) * 2, BINS - 1).astype(np.int64),
        _share_bin(long, w.counts),
        np.minimum(np.log2(w.counts / np.maximum(kinds[4] + 1, 1) + 1) * 3, BINS - 1).astype(np.int64),
        np.where(np.isnan(n_chars), BINS - 1, np.minimum(_size_bin(np.nan_to_num(n_chars)), BINS - 2)),
    ]
    base = 1 << WORD_BITS
    extra = np.stack([base + i * BINS + s for i, s in enumerate(stats)], axis=1).ravel()
    of = np.concatenate([of, np.repeat(np.arange(n), len(stats))])
    idx = np.concatenate([word, extra])
    val = np.concatenate([1.0 / np.sqrt(distinct[pair >> WORD_BITS]), np.ones(len(extra))])
    order = np.argsort(of, kind="stable")
    return of[order], idx[order], val[order]


@dataclass
class Machine:
    bias: float
    linear: np.ndarray
    factors: np.ndarray


def raw_scores(m: Machine, of: np.ndarray, idx: np.ndarray, val: np.ndarray, n: int) -> tuple[np.ndarray, np.ndarray]:
    """Scores before the logistic function, and the sums that the gradient needs."""
    starts = np.searchsorted(of, np.arange(n))
    vx = m.factors[idx] * val[:, None]
    sums = np.add.reduceat(vx, starts, axis=0)
    squares = np.add.reduceat(vx * vx, starts, axis=0)
    lin = np.add.reduceat(m.linear[idx] * val, starts)
    return m.bias + lin + 0.5 * (sums * sums - squares).sum(axis=1), sums


def fit_machine(of, idx, val, y, rank: int, epochs: int, seed: int = 7, rate: float = 0.1, decay: float = 1e-5) -> Machine:
    """Logistic loss, mini-batches, AdaGrad."""
    rng = np.random.default_rng(seed)
    n = len(y)
    m = Machine(float(np.log((y.sum() + 1) / (n - y.sum() + 1))), np.zeros(SIZE), rng.normal(0, 0.03, (SIZE, rank)))
    sum_lin, sum_fac = np.full(SIZE, 1e-3), np.full((SIZE, rank), 1e-3)
    bounds = np.searchsorted(of, np.arange(n + 1))
    for _ in range(epochs):
        order = rng.permutation(n)
        for at in range(0, n, 128):
            rows = order[at : at + 128]
            take = np.concatenate([np.arange(bounds[r], bounds[r + 1]) for r in rows])
            o = np.repeat(np.arange(len(rows)), bounds[rows + 1] - bounds[rows])
            i, x = idx[take], val[take]
            s, sums = raw_scores(m, o, i, x, len(rows))
            g = (1 / (1 + np.exp(-np.clip(s, -30, 30))) - y[rows]) / len(rows)
            used, back = np.unique(i, return_inverse=True)
            gl = np.bincount(back, g[o] * x, len(used)) + decay * m.linear[used]
            gf = np.zeros((len(used), rank))
            np.add.at(gf, back, (g[o] * x)[:, None] * (sums[o] - m.factors[i] * x[:, None]))
            gf += decay * m.factors[used]
            sum_lin[used] += gl * gl
            sum_fac[used] += gf * gf
            m.linear[used] -= rate * gl / np.sqrt(sum_lin[used])
            m.factors[used] -= rate * 0.5 * gf / np.sqrt(sum_fac[used])
            m.bias -= rate * g.sum()
    return m


def _n_chars(batch) -> np.ndarray:
    return np.array(batch.column("n_chars").cast(pa.float64()).to_numpy(zero_copy_only=False), dtype=float)


def train(docs: DataFrame, labels: DataFrame, keep: Column, rows: int = learning.FIT_ROWS, rank: int = 6, epochs: int = 5) -> Machine:
    """Fit on about ``rows`` labelled documents (chosen by hash) for which ``keep`` holds.

    Without any labelled document the machine scores 0.5 everywhere.
    """
    sample = learning.labelled_sample(_wanted(docs), labels, "quality", keep, ["doc_id", "text", "n_chars"], rows)

    def fit(table: pa.Table) -> Machine:
        parts, at = [], 0
        for s in textual.slices(table.to_batches()):
            of, idx, val = features(s.column("text"), _n_chars(s))
            parts.append((of + at, idx, val))
            at += s.num_rows
        of, idx, val = (np.concatenate(p) for p in zip(*parts))
        return fit_machine(of, idx, val, np.array(table.column("label").to_pylist(), dtype=float), rank, epochs)

    return learning.fit_in_task(sample, fit) or Machine(0.0, np.zeros(SIZE), np.zeros((SIZE, rank)))


def _wanted(docs: DataFrame) -> DataFrame:
    there = F.col("n_chars").cast("double") if "n_chars" in docs.columns else F.lit(None).cast("double")
    return docs.select("doc_id", "text", there.alias("n_chars"))


def score(docs: DataFrame, machine: Machine) -> DataFrame:
    """doc_id, score (0 to 1, higher is better) of every row; null and empty texts score by their statistics."""
    shared = docs.sparkSession.sparkContext.broadcast(machine)  # a few MB, fixed by its parameters

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        m = shared.value
        for s in textual.slices(batches):
            of, idx, val = features(s.column("text"), _n_chars(s))
            raw, _ = raw_scores(m, of, idx, val, s.num_rows)
            yield pa.RecordBatch.from_arrays(
                [s.column("doc_id"), pa.array(1 / (1 + np.exp(-np.clip(raw, -30, 30))))], ["doc_id", "score"]
            )

    wanted = _wanted(docs)
    return wanted.mapInArrow(run, f"doc_id {wanted.schema['doc_id'].dataType.simpleString()}, score double")


def accept(docs: DataFrame, machine: Machine, threshold: float = 0.3) -> DataFrame:
    """The rows of ``docs``, all columns, that score ``threshold`` or more."""
    shared = docs.sparkSession.sparkContext.broadcast(machine)
    given = "n_chars" in docs.columns

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        m = shared.value
        for s in textual.slices(batches):
            of, idx, val = features(s.column("text"), _n_chars(s) if given else np.full(s.num_rows, np.nan))
            raw, _ = raw_scores(m, of, idx, val, s.num_rows)
            yield s.filter(pa.array(1 / (1 + np.exp(-np.clip(raw, -30, 30))) >= threshold))

    return docs.mapInArrow(run, docs.schema)


def classify(docs: DataFrame, labels: DataFrame, parts: int = 5, held: int = 0, threshold: float = 0.3) -> DataFrame:
    """doc_id, held_out, score, predicted for every row of ``docs``.

    Labels are learned from ids outside the held-out fold only.
    """
    machine = train(docs, labels, ~learning.in_fold(F.col("doc_id"), parts, held))
    return score(docs, machine).select(
        "doc_id",
        learning.in_fold(F.col("doc_id"), parts, held).alias("held_out"),
        "score",
        (F.col("score") >= threshold).cast("int").alias("predicted"),
    )
