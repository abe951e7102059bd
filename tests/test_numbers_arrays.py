from __future__ import annotations

import math

import numpy as np
import pytest
from pyspark.sql import functions as F

from tristrata.functions import arrays as A
from tristrata.functions.numbers import clean_code, na_to_null, parse_value, parse_year


def values(spark, texts, fn):
    df = spark.createDataFrame([(i, t) for i, t in enumerate(texts)], "i int, t string")
    return [r[1] for r in df.select("i", fn(F.col("t"))).orderBy("i").collect()]


def test_parse_year(spark):
    texts = ["2001", "2001.7", "-3.9", " 1999 ", "1e3", "inf", "nan", "x", "", None, "12d", "0x10", "1_000", "9999999999"]
    assert values(spark, texts, parse_year) == [
        2001, 2001, -3, 1999, 1000, None, None, None, None, None, None, None, None, 9999999999,
    ]


def test_parse_value(spark):
    texts = ["1.5", ".5", "5.", "+7", "-Infinity", "inf", "NaN", "1d", "1.f", "1_000", "abc", None, "1e-3", "0x1p3"]
    got = values(spark, texts, parse_value)
    assert got == [1.5, 0.5, 5.0, 7.0, -math.inf, math.inf, None, None, None, None, None, None, 0.001, None]


def test_na_tokens_and_codes(spark):
    assert values(spark, ["NA", "n/a", "", "Nano", "null"], na_to_null) == [None, None, None, "Nano", None]
    assert values(spark, ["007", " 2 ", "2.0", "A1", None], clean_code) == ["7", "2", "2.0", "A1", None]


def entropy(v):
    counts, _ = np.histogram(v, bins=min(20, max(2, int(np.sqrt(len(v))))))
    p = counts / (counts.sum() + 1e-12)
    return float(-(p[p > 0] * np.log2(p[p > 0])).sum())


def series(seed):
    rng = np.random.default_rng(seed)
    kind = seed % 5
    n = int(rng.integers(1, 120))
    if kind == 0:
        return rng.normal(size=n)
    if kind == 1:
        return rng.integers(0, 5, size=n).astype(float)
    if kind == 2:
        return np.full(n, float(rng.integers(0, 3)))
    if kind == 3:
        return rng.lognormal(3, 4, size=n)
    return np.round(rng.uniform(-1, 1, size=n), 1)


def arrays(spark, lists):
    rows = [(i, [float(x) for x in v]) for i, v in enumerate(lists)]
    return spark.createDataFrame(rows, "i int, v array<double>")


def test_statistics_equal_numpy(spark):
    lists = [series(s) for s in range(150)]
    v = F.col("v")
    rows = arrays(spark, lists).select(
        "i", A.entropy_of(v), A.mean_of(v), A.median_of(v), A.variance_of(v), A.quantile_sorted(F.array_sort(v), 0.25)
    ).orderBy("i").collect()
    for r, x in zip(rows, lists):
        want = [entropy(x), x.mean(), np.median(x), x.var(), np.percentile(x, 25)]
        assert np.allclose(r[1:], want, rtol=1e-9, atol=1e-9), (r, want)


@pytest.mark.parametrize("bins", [20, "auto"])
def test_histogram_equals_numpy(spark, bins):
    lists = [series(s) for s in range(120)]
    v = F.col("v")
    n = A.auto_bin_count(v) if bins == "auto" else F.lit(bins)
    rows = arrays(spark, lists).select("i", A.histogram(v, n).alias("h")).orderBy("i").collect()
    for r, x in zip(rows, lists):
        counts, edges = np.histogram(x, bins=bins)
        assert r["h"]["counts"] == counts.tolist()
        assert np.allclose(r["h"]["edges"], edges, rtol=1e-12)


def test_degenerate_statistics(spark):
    df = arrays(spark, [[], [math.inf, 1.0], [1e300, 1e300], [7.0]])
    v = F.col("v")
    got = [tuple(r) for r in df.select(A.entropy_of(v), A.mean_of(v), A.variance_of(v)).collect()]
    assert got[0] == (None, None, None)
    assert got[1][0] is None and got[1][1] == math.inf and got[1][2] is None
    assert got[2][0] is None
    assert 0 < got[3][0] < 1e-11
