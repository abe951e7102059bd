"""Toxicity: a word and word-stem classifier with counterfactual regularisation.

Logistic regression on the presence of hashed words and word stems (first 4, 5 and 6
bytes). During training every labelled text is paired with a copy in which its identity
terms are swapped for others (a text without any gets one inserted); the squared change
of the score is part of the loss, so neutral group mentions do not move a score.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from . import learning, textual

BITS = 18
STEMS = (4, 5, 6)

#: Neutral words for groups of people; a caller may pass others.
IDENTITY_TERMS = (
    "women", "men", "girls", "boys", "gay", "lesbian", "straight", "trans", "black", "white", "asian",
    "latino", "christians", "muslims", "jews", "hindus", "buddhists", "atheists", "immigrants", "refugees",
    "frauen", "schwule", "christen", "muslime", "juden", "femmes", "juifs", "musulmans", "mujeres", "judíos",
)


def features(texts: pa.Array) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(text, feature) pairs with repeats, and the number of words per text."""
    w = textual.words_of(texts)
    text = w.texts
    shift = np.uint64(64 - BITS)
    found = [(w.hashes() >> shift).astype(np.int64)]
    of = [text]
    for n in STEMS:
        there = w.lengths > n  # a shorter word is its own stem
        found.append((textual.mix(w.hashes(n)[there] + np.uint64(n)) >> shift).astype(np.int64))
        of.append(text[there])
    return np.concatenate(of), np.concatenate(found), w.counts


@dataclass
class Model:
    bias: float
    weights: np.ndarray


def counterfactual_changes(of, idx, n, terms, rng) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Change of the features of each text under its swap: (text, feature, +1 or -1)."""
    of_term = [np.unique(features(pa.array([t]))[1]) for t in terms]
    first = np.array([features(pa.array([t]))[1][0] for t in terms])
    there = np.zeros((n, len(terms)), dtype=bool)
    for k, f in enumerate(first):
        there[of[idx == f], k] = True
    rows, feats, signs = [], [], []
    for r in range(n):
        new = int(rng.integers(len(terms)))
        old = np.flatnonzero(there[r])
        for k in old[old != new]:
            rows += [r] * len(of_term[k])
            feats += of_term[k].tolist()
            signs += [-1.0] * len(of_term[k])
        if not there[r, new]:
            rows += [r] * len(of_term[new])
            feats += of_term[new].tolist()
            signs += [1.0] * len(of_term[new])
    return np.array(rows, dtype=np.int64), np.array(feats, dtype=np.int64), np.array(signs)


def fit_model(of, idx, y, terms=IDENTITY_TERMS, steps: int = 250, sparsity: float = 2e-4, fairness: float = 1.0, least: int = 3) -> Model:
    """Proximal gradient with momentum: logistic loss, L1, and the counterfactual penalty."""
    n = len(y)
    pair = np.unique(of * (1 << BITS) + idx)
    of, idx = pair >> BITS, pair & ((1 << BITS) - 1)
    rows, feats, signs = counterfactual_changes(of, idx, n, terms, np.random.default_rng(11)) if terms else (np.zeros(0, int), np.zeros(0, int), np.zeros(0))
    # Only features that some toxic texts hold can speak for toxicity; the rest would be noise.
    seen = np.bincount(idx[y[of] > 0], minlength=1 << BITS)
    all_seen = np.bincount(idx, minlength=1 << BITS)
    useful = (seen >= least) & (seen / max(y.sum(), 1) > 1.5 * (all_seen - seen) / max(n - y.sum(), 1))
    useful[feats] |= seen[feats] >= least
    place = np.cumsum(useful) - 1
    keep = useful[idx]
    of, idx = of[keep], place[idx[keep]]
    keep = useful[feats]
    rows, feats, signs = rows[keep], place[feats[keep]], signs[keep]
    width = int(useful.sum())
    w, b = np.zeros(width), float(np.log((y.sum() + 1) / (n - y.sum() + 1)))
    z, zb, t = w.copy(), b, 1.0
    # The step is one over the largest curvature, found by power iteration.
    v = np.ones(width + 1)
    size = 1.0
    for _ in range(20):
        along = np.bincount(of, v[idx], n) + v[width]
        u = np.append(np.bincount(idx, along[of], width), along.sum()) / (4 * max(n, 1))
        if len(rows):
            u[:width] += fairness * 2 / n * np.bincount(feats, np.bincount(rows, v[feats] * signs, n)[rows] * signs, width)
        size = max(float(np.linalg.norm(u) / max(np.linalg.norm(v), 1e-12)), 1e-6)
        v = u / max(np.linalg.norm(u), 1e-12)
    step = 0.95 / size
    for _ in range(steps):
        s = zb + np.bincount(of, z[idx], n)
        g = (1 / (1 + np.exp(-np.clip(s, -30, 30))) - y) / n
        change = np.bincount(rows, z[feats] * signs, n) if len(rows) else np.zeros(n)
        gw = np.bincount(idx, g[of], width)
        if len(rows):
            gw += fairness * 2 / n * np.bincount(feats, change[rows] * signs, width)
        nw = z - step * gw
        nw = np.sign(nw) * np.maximum(np.abs(nw) - sparsity * step, 0)
        nb = zb - step * g.sum()
        nt = (1 + np.sqrt(1 + 4 * t * t)) / 2
        z, zb = nw + (t - 1) / nt * (nw - w), nb + (t - 1) / nt * (nb - b)
        w, b, t = nw, nb, nt
    full = np.zeros(1 << BITS)
    full[useful] = w
    return Model(b, full)


def raw_scores(model: Model, texts: pa.Array) -> np.ndarray:
    of, idx, counts = features(texts)
    keep = model.weights[idx] != 0
    pair = np.unique(of[keep] * (1 << BITS) + idx[keep])
    return model.bias + np.bincount(pair >> BITS, model.weights[pair & ((1 << BITS) - 1)], len(counts))


def train(docs: DataFrame, labels: DataFrame, keep: Column, rows: int = learning.FIT_ROWS, terms: tuple[str, ...] = IDENTITY_TERMS) -> Model:
    """Fit on about ``rows`` labelled documents (chosen by hash) for which ``keep`` holds.

    Without any labelled document every score is 0.5.
    """
    sample = learning.labelled_sample(docs, labels, "toxic", keep, ["doc_id", "text"], rows)

    def fit(table: pa.Table) -> Model:
        parts, at = [], 0
        for s in textual.slices(table.to_batches()):
            of, idx, _ = features(s.column("text"))
            pair = np.unique((of + at) * (1 << BITS) + idx)
            parts.append(pair)
            at += s.num_rows
        pair = np.concatenate(parts)
        return fit_model(pair >> BITS, pair & ((1 << BITS) - 1), np.array(table.column("label").to_pylist(), dtype=float), terms)

    return learning.fit_in_task(sample, fit) or Model(0.0, np.zeros(1 << BITS))


def score(docs: DataFrame, model: Model) -> DataFrame:
    """doc_id and score (0 to 1, higher is more toxic) of every row; null and empty texts get the bias."""
    shared = docs.sparkSession.sparkContext.broadcast(model)  # 2 MB, fixed by BITS

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for s in textual.slices(batches):
            raw = raw_scores(shared.value, s.column("text"))
            yield pa.RecordBatch.from_arrays(
                [s.column("doc_id"), pa.array(1 / (1 + np.exp(-np.clip(raw, -30, 30))))], ["doc_id", "score"]
            )

    wanted = docs.select("doc_id", "text")
    return wanted.mapInArrow(run, f"doc_id {wanted.schema['doc_id'].dataType.simpleString()}, score double")


def classify(docs: DataFrame, labels: DataFrame, parts: int = 4, held: int = 2, threshold: float = 0.3, terms: tuple[str, ...] = IDENTITY_TERMS) -> DataFrame:
    """doc_id, held_out, score, predicted for every row of ``docs``.

    Labels are learned from ids outside the held-out fold only.
    """
    model = train(docs, labels, ~learning.in_fold(F.col("doc_id"), parts, held), terms=terms)
    return score(docs, model).select(
        "doc_id",
        learning.in_fold(F.col("doc_id"), parts, held).alias("held_out"),
        "score",
        (F.col("score") >= threshold).cast("int").alias("predicted"),
    )
