from __future__ import annotations

import math

import numpy as np
import pytest

from tristrata.llm import neighbours

VECTORS = "vec_id bigint, embedding array<float>, label int, score double, shard int"


@pytest.fixture(scope="module")
def clustered(spark):
    rng = np.random.default_rng(1)
    middle = rng.normal(size=(6, 16))
    x = (middle[rng.integers(6, size=1500)] + rng.normal(size=(1500, 16)) * 0.6).astype(np.float32)
    x *= rng.uniform(0.5, 2, size=(1500, 1)).astype(np.float32)  # lengths matter for inner products
    x[700:1100] = x[700]  # a third of the rows is one vector
    rows = [(i, v.tolist(), 0, 0.0, 0) for i, v in enumerate(x)]
    return x.astype(float), spark.createDataFrame(rows, VECTORS)


def exact(x, q, k):
    s = (x * x[q]).sum(axis=1)
    s[q] = -np.inf
    order = np.lexsort((np.arange(len(x)), -s))[:k]
    return order.tolist(), s[order]


@pytest.mark.parametrize("shard_rows", [8192, 300])
def test_recall_and_exact_scores(clustered, shard_rows):
    x, df = clustered
    index = neighbours.build_index(df, 20, shard_rows)
    got = neighbours.search(index, df.where("vec_id % 20 = 0"), 20).orderBy("query_id", "rank").toPandas()
    assert (got.groupby("query_id")["rank"].apply(list).map(lambda r: r == list(range(1, 21)))).all() and got.query_id.nunique() == 75
    hits = 0
    for q, rows in got.groupby("query_id"):
        ids, _ = exact(x, q, 20)
        hits += len(set(ids) & set(rows.vec_id))
        assert q not in set(rows.vec_id)
        np.testing.assert_allclose(rows.score, (x[rows.vec_id] * x[q]).sum(axis=1), rtol=1e-12)
        assert sorted(zip(-rows.score, rows.vec_id)) == list(zip(-rows.score, rows.vec_id))
    assert hits / len(got) >= 0.9


def test_copies_and_ties_go_to_the_smaller_id(clustered):
    _, df = clustered
    got = neighbours.nearest(df).where("query_id = 700").orderBy("rank").collect()
    ids = [r.vec_id for r in got if 700 <= r.vec_id < 1100]
    assert ids == [701 + i for i in range(len(ids))] and ids


def test_odd_vectors(spark):
    rows = [
        (0, [1.0, 0.0], 1, 0.0, 0), (0, [1.0, 0.0], 1, 0.0, 0), (1, [0.5, 0.5], 1, 0.0, 0), (20, [0.0, 1.0], 1, 0.0, 0), (2, None, 1, 0.0, 0),
        (40, [], 1, 0.0, 0), (60, [0.0, -0.0], 1, 0.0, 0), (3, [1.0, None], 1, 0.0, 0), (4, [math.nan, 1.0], 1, 0.0, 0), (5, [math.inf, 1.0], 1, 0.0, 0),
        (80, [1.0, 2.0, 3.0], 1, 0.0, 0), (None, [1.0, 1.0], 1, 0.0, 0), (6, [-0.0, 1.0], 1, 0.0, 0),
    ]
    got = [tuple(r) for r in neighbours.nearest(spark.createDataFrame(rows, VECTORS)).orderBy("query_id", "rank").collect()]
    assert got == [(0, 1, 1, 0.5), (0, 2, 6, 0.0), (0, 3, 20, 0.0), (20, 1, 6, 1.0), (20, 2, 1, 0.5), (20, 3, 0, 0.0)]
    assert neighbours.nearest(spark.createDataFrame([], VECTORS)).count() == 0


def test_pruning_keeps_diverse_edges():
    x = np.array([[0.0, 0], [1, 0], [1.1, 0], [0, 1], [0, 1.05], [-3, 0], [0, 0]])
    out = neighbours.robust_prune(np.array([0]), np.array([[1, 2, 3, 4, 5, -1]]), x, 4, 1.2)
    assert out[0].tolist() == [1, 3, 5, -1]
