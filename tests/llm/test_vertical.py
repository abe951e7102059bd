"""Hard negatives against a plain search and against their SQL."""

from __future__ import annotations

import math

import duckdb
import numpy as np
import pytest

from tristrata.llm import vertical

VECTORS = "vec_id bigint, embedding array<float>, label int, score double, block int, rank int"


def plain(rows):
    """Python integers over rows (vec_id, embedding, label)."""
    use = {}
    for i, e, label in rows:
        if i is None or label is None or e is None or any(x is None or not math.isfinite(x) for x in e):
            continue
        row = ((label + 1) % 10 if i % 7 == 0 else label, [math.floor(256 * float(np.float32(x))) for x in e])
        use[i] = min(use.get(i, row), row)
    out = []
    for a, (label, q) in use.items():
        if a % 100:
            continue
        scored = sorted((-sum(x * y for x, y in zip(q, v)), i, other) for i, (other, v) in use.items() if i != a and len(v) == len(q))
        for ps, p, _ in [s for s in scored if s[2] == label][:5]:
            fit = [s for s in scored if s[2] != label and 80 * -ps <= 100 * -s[0] <= 100 * -ps][:5]
            out += [(a, p, r, n, -ps, -ns) for r, (ns, n, _) in enumerate(fit, 1)]
    return sorted(out)


@pytest.mark.parametrize(("block", "band"), [(16384, 4096), (100, 2)])
def test_equals_a_plain_search_and_sql(spark, monkeypatch, block, band):
    monkeypatch.setattr(vertical, "BLOCK_ROWS", block)
    monkeypatch.setattr(vertical, "BAND_ROWS", band)
    rng = np.random.default_rng(3)
    middle = rng.normal(size=(10, 12)) * 0.4
    rows = []
    for i in range(700):
        k = int(rng.integers(10))
        rows.append((i, (middle[k] + rng.normal(size=12) * 0.2).astype(np.float32).tolist(), k, 0.0, 0, 0))
    rows += [(i + 1000, rows[200][1], int(i % 4), 0.0, 0, 0) for i in range(300)]  # a third of the rows is one vector
    df = spark.createDataFrame(rows, VECTORS)
    got = vertical.hard_negatives(vertical.scaled(df))
    assert got.columns == ["anchor_id", "positive_id", "rank", "negative_id", "positive_score", "negative_score"]
    found = sorted(tuple(r) for r in got.collect())
    assert found == plain([r[:3] for r in rows]) and len(found) > 100
    if block == 100:
        embeddings = df.select("vec_id", "embedding", "label").toPandas()  # noqa: F841
        assert sorted(map(tuple, duckdb.sql(vertical.ORACLE).fetchall())) == found


def test_odd_rows(spark):
    rows = [
        (0, [1.0, 0.5], 1), (0, [1.0, 0.5], 1), (1, [0.5, 0.5], 1), (2, [0.9, 0.1], 1), (3, [0.5, 0.25], 2), (4, [0.4, 0.4], 3), (7, [0.5, 0.5], 0),
        (14, [0.5, 0.5], None), (100, [0.0, 0.0], 4), (101, [0.0, 1.0], 4), (102, [-1.0, 1.0], 5), (None, [1.0, 1.0], 1), (200, None, 1), (300, [1.0, None], 1),
        (400, [math.nan, 1.0], 1), (500, [math.inf, 1.0], 1), (600, [], 6), (601, [], 6), (602, [], 7), (700, [1.0, 2.0, 3.0], 1), (800, [3e38, 1.0], 1),
        (900, [-1.0, -1.0], 1), (5, [0.5, 0.5], 1), (6, [0.5, 0.5], 2), (8, [0.5, 0.5], 2),
    ]
    df = spark.createDataFrame([(*r, 0.0, 0, 0) for r in rows], VECTORS)
    got = sorted(tuple(r) for r in vertical.hard_negatives(vertical.scaled(df)).collect())
    assert got == plain([r for r in rows if r[0] != 800]) and {r[0] for r in got} >= {0, 100, 600}
    assert vertical.hard_negatives(vertical.scaled(spark.createDataFrame([], VECTORS))).count() == 0


def test_scan_reads_fewer_rows_than_it_meets():
    rng = np.random.default_rng(0)
    x = rng.normal(size=(16, 2000)) * 200 * (0.6 ** np.arange(16))[:, None]
    x = x.astype(np.int64)
    block = vertical.Block(np.arange(2000), np.zeros(2000, dtype=np.int64), x, x.min(axis=1), x.max(axis=1))
    left = []
    vertical._scan(x[:, 0], block, np.arange(2000), lambda low, high: left.append(len(low)) or high >= np.sort(low)[-5])
    assert left[0] == 2000 and left[-1] < 100
