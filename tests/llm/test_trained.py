from __future__ import annotations

import random
import zlib

import numpy as np
import pyarrow as pa
import pytest
from conftest import ODD_TEXTS
from pyspark.sql import functions as F

from tristrata.llm import language, learning, quality, toxicity


def held(doc_id, parts, rest):
    return doc_id is not None and zlib.crc32(str(doc_id).encode()) % parts == rest


@pytest.fixture(scope="module")
def labelled(spark, docs_of, prose):
    rows, labels = [], []
    for i in range(400):
        good, toxic = i % 4 != 0, i % 5 == 0
        text = prose("en", 60, i)
        if not good:
            text = " ".join(w.upper() + "!!" for w in text.split())
        if toxic:
            words = text.split()
            words[i % 50] = random.Random(i).choice(["idiot", "scumlike", "scumful"])
            text = " ".join(words)
        rows.append((i, text))
        labels.append((i, int(good), int(toxic)))
    labels += [(401, None, None), (None, 1, 1), (7, 1, 1), (7, 0, 0)]
    return docs_of(rows), spark.createDataFrame(labels, "doc_id bigint, quality int, toxic int")


@pytest.mark.parametrize("fn,column,parts,rest", [(quality.classify, 1, 5, 0), (toxicity.classify, 2, 4, 2)])
def test_held_out_accuracy(labelled, fn, column, parts, rest):
    docs, labels = labelled
    got = fn(docs, labels).toPandas().set_index("doc_id")
    truth = {r[0]: r[column] for r in labels.collect() if r[0] is not None and r[0] < 400 and r[0] != 7}
    assert (got.held_out == [held(i, parts, rest) for i in got.index]).all()
    assert got.score.between(0, 1).all() and (got.predicted == (got.score >= 0.3)).all()
    out = got[got.held_out & (got.index != 7)]
    assert np.mean([out.predicted[i] == truth[i] for i in out.index]) > 0.95


@pytest.mark.parametrize("fn", [quality.classify, toxicity.classify])
def test_odd_rows_and_empty_tables(labelled, odd, none, fn):
    docs, labels = labelled
    learned = fn(docs.unionByName(odd.select(docs.columns)), labels)
    assert learned.count() == 400 + len(ODD_TEXTS)
    got = fn(odd, labels.limit(0)).toPandas()
    assert len(got) == len(ODD_TEXTS) and (got.score == 0.5).all() and not got.held_out[got.doc_id.isna()].any()
    assert fn(none, labels).count() == 0


def test_machine_equals_all_pairs():
    rng = np.random.default_rng(0)
    m = quality.Machine(0.3, rng.normal(size=quality.SIZE), rng.normal(size=(quality.SIZE, 4)))
    of, idx, val = quality.features(pa.array(["some words of some text", "", None, "X Y"]), np.array([1.0, np.nan, 2.0, 3.0]))
    got, _ = quality.raw_scores(m, of, idx, val, 4)
    for t in range(4):
        i, x = idx[of == t], val[of == t]
        pairs = sum(m.factors[i[a]] @ m.factors[i[b]] * x[a] * x[b] for a in range(len(i)) for b in range(a))
        assert got[t] == pytest.approx(0.3 + m.linear[i] @ x + pairs)


def test_sample_is_bounded_and_leaves_out_the_fold(labelled):
    docs, labels = labelled
    keep = ~learning.in_fold(F.col("doc_id"), 5, 0)
    some = learning.labelled_sample(docs, labels, "quality", keep, ["doc_id", "text"], 50).toPandas()
    assert 20 < len(some) < 90 and not any(held(i, 5, 0) for i in some.doc_id) and 7 not in set(some.doc_id)


def test_swapped_identity_terms_hardly_move_a_score(prose):
    """Group mentions that stand mostly in toxic texts must not become signs of toxicity."""
    rng = random.Random(3)
    texts, y = [], []
    for i in range(600):
        toxic = i % 4 == 0
        words = prose("en", 30, i).split()
        if rng.random() < (0.8 if toxic else 0.1):
            words[3] = rng.choice(["women", "muslims"])
        if toxic and rng.random() < 0.5:
            words[9] = "idiot"
        texts.append(" ".join(words))
        y.append(float(toxic))
    of, idx, _ = toxicity.features(pa.array(texts))
    neutral = [prose("en", 30, 9_000 + i) for i in range(50)]
    mention = [t + " women" for t in neutral]

    def change(fairness):
        m = toxicity.fit_model(of, idx, np.array(y), ("women", "muslims", "men", "jews"), fairness=fairness)
        return np.mean(toxicity.raw_scores(m, pa.array(mention)) - toxicity.raw_scores(m, pa.array(neutral))), m

    plain, _ = change(0.0)
    fair, model = change(1.0)
    assert plain > 0.5 and abs(fair) < 0.5 * plain
    assert toxicity.raw_scores(model, pa.array([t + " idiot" for t in neutral])).mean() > toxicity.raw_scores(model, pa.array(neutral)).mean() + 2


def naive_phrases(text: bytes, sample: bytes) -> int:
    count = 0
    for at in range(0, len(text), language.WINDOW):
        now = b""
        for c in text[at : at + language.WINDOW]:
            if now + bytes([c]) in sample:
                now += bytes([c])
            else:
                count += 1
                now = bytes([c]) if bytes([c]) in sample else b""
        count += 1
    return count


def test_phrases_equal_a_plain_cross_parse(prose):
    samples = {x: language.letters_of(pa.array([prose(x, 300, 1)]))[0].tobytes() for x in ("en", "fr")}
    parser = language.Parser(samples)
    texts = [prose("en", 500, 2), prose("fr", 20, 3), "zz öö 日本 zz", "", None, "a", "The, END!"]
    stream, offsets = language.letters_of(pa.array(texts))
    got = parser.phrases(stream, offsets)
    for t in range(len(texts)):
        piece = stream[offsets[t] : offsets[t + 1]].tobytes()
        assert got[t].tolist() == [naive_phrases(piece, samples[x]) if piece else 0 for x in parser.names]


def test_language_of_held_out_documents(docs_of, prose, odd, none):
    rows = [(i, prose("en" if i % 3 else "fr", 40, i), "en" if i % 3 else "fr") for i in range(200)]
    rows += [(300, "123 456", "en"), (301, None, "fr"), (302, "no label", None)]
    got = language.classify(docs_of(rows)).toPandas().set_index("doc_id")
    out = got[got.held_out & (got.index < 200)]
    assert len(out) > 20 and (out.lang_pred == ["en" if i % 3 else "fr" for i in out.index]).mean() > 0.97
    assert got.lang_pred[300] == got.lang_pred[301] == "und" and got.score.between(0, 1).all()
    unknown = language.classify(odd).toPandas()
    assert len(unknown) == len(ODD_TEXTS) and (unknown.lang_pred == "und").all()
    assert language.classify(none).count() == 0


def test_toxicity_model_is_the_minimum_of_the_dense_loss(prose):
    """Loss, counterfactual penalty and gradient written out over dense matrices; the fit satisfies their conditions."""
    rng = random.Random(5)
    terms = ("women", "muslims", "men")
    texts, y = [], []
    for i in range(200):
        words = prose("en", 12, i).split()
        if i % 3 == 0:
            words[2] = rng.choice(["idiot", "scum"])
        if rng.random() < 0.4:
            words[5] = rng.choice(terms)
        texts.append(" ".join(words))
        y.append(float(i % 3 == 0 and rng.random() < 0.9))
    y = np.array(y)
    of, idx, _ = toxicity.features(pa.array(texts))
    sparsity, fairness, n = 1e-3, 1.0, len(y)
    m = toxicity.fit_model(of, idx, y, terms, steps=4000, sparsity=sparsity, fairness=fairness)
    pair = np.unique(of * (1 << toxicity.BITS) + idx)
    of, idx = pair >> toxicity.BITS, pair & ((1 << toxicity.BITS) - 1)
    rows, feats, signs = toxicity.counterfactual_changes(of, idx, n, terms, np.random.default_rng(11))
    names = np.unique(np.concatenate([idx, feats]))
    x, d = np.zeros((n, len(names))), np.zeros((n, len(names)))
    x[of, np.searchsorted(names, idx)] = 1
    np.add.at(d, (rows, np.searchsorted(names, feats)), signs)
    w = m.weights[names]
    s = x @ w + m.bias
    np.testing.assert_allclose(toxicity.raw_scores(m, pa.array(texts)), s, atol=1e-9)
    # Features that were left out of the fit as noise have weight 0 and say nothing here.
    used = w != 0
    loss = lambda w, b: np.mean(np.logaddexp(0, x @ w + b) - y * (x @ w + b)) + fairness / n * ((d @ w) ** 2).sum() + sparsity * np.abs(w).sum()
    gradient = x.T @ (1 / (1 + np.exp(-s)) - y) / n + 2 * fairness / n * d.T @ (d @ w)
    assert used.sum() >= 3 and np.abs(gradient[used] + sparsity * np.sign(w[used])).max() < 2e-5
    assert abs((1 / (1 + np.exp(-s)) - y).mean()) < 2e-5
    noise = np.random.default_rng(1)
    assert all(loss(w + used * noise.normal(size=len(w)) * 0.05, m.bias) > loss(w, m.bias) for _ in range(20))


def test_accept_keeps_columns_and_bears_odd_rows(labelled, odd, none):
    docs, labels = labelled
    machine = quality.train(docs, labels, ~learning.in_fold(F.col("doc_id"), 5, 0))
    kept = quality.accept(odd, machine)
    assert kept.columns == odd.columns and kept.count() <= len(ODD_TEXTS)
    assert quality.accept(none, machine).count() == 0
    scores = {(r.doc_id, r.n_chars): r.score for r in quality.score(docs, machine).select("doc_id", "score").join(docs, "doc_id").select("doc_id", "n_chars", "score").collect()}
    assert {r.doc_id for r in quality.accept(docs, machine).collect()} == {d for (d, _), s in scores.items() if s >= 0.3}
