from __future__ import annotations

import numpy as np
import pytest
from pyspark.sql import functions as F

from tristrata.functions.vectors import HashedTokens, embed_distinct, embed_text, l2_normalize
from tristrata.operators import projection as M


def frame(spark, x, label=None):
    rows = [(i, [float(v) for v in r], (label or "l")) for i, r in enumerate(x)]
    return spark.createDataFrame(rows, "id int, embedding array<float>, label string").repartition(3)


def numpy_pca(x):
    x = np.asarray(x, dtype=np.float32).astype(float)
    c = x - x.mean(axis=0)
    _, s, vt = np.linalg.svd(c, full_matrices=False)
    vt = vt[:2] * np.array([[np.sign(v[np.argmax(np.abs(v))])] for v in vt[:2]])
    return c @ vt.T, (s**2 / (s**2).sum())[:2]


def coordinates(df):
    rows = df.orderBy("id").collect()
    return np.array([[r[a] for a in M.AXES] for r in rows])


def test_pca_equals_svd(spark):
    x = np.random.default_rng(1).normal(size=(200, 8)) * np.arange(1, 9) + 50
    p = M.pca_2d(frame(spark, x))
    want, ratio = numpy_pca(x)
    assert np.allclose(coordinates(p.rows), want, atol=1e-3)
    assert np.allclose(p.explained_variance_ratio, ratio, atol=1e-6) and p.n_used == 200


def test_pca_small_inputs(spark):
    assert M.pca_2d(frame(spark, [])).rows.count() == 0
    assert coordinates(M.pca_2d(frame(spark, [[1.0, 2.0]])).rows).tolist() == [[0.0, 0.0]]
    bad = frame(spark, [[1.0, 2.0], [2.0, 1.0], [np.nan, 1.0], [3.0, 5.0]])
    assert M.pca_2d(bad).n_used == 3


def test_joint_fit(spark):
    rng = np.random.default_rng(2)
    x, y = rng.normal(size=(40, 5)), rng.normal(size=(7, 5)) + 3
    a, b = M.pca_2d_joint(frame(spark, x), frame(spark, y), "id", "id")
    want, _ = numpy_pca(np.vstack([x, y]))
    assert np.allclose(coordinates(a), want[:40], atol=1e-3) and np.allclose(coordinates(b), want[40:], atol=1e-3)
    a, b = M.pca_2d_joint(frame(spark, []), frame(spark, y), "id", "id")
    assert a.count() == 0 and np.allclose(coordinates(b), numpy_pca(y)[0], atol=1e-3)
    with pytest.raises(KeyError):
        M.pca_2d_joint(frame(spark, x).drop("embedding"), frame(spark, y), "id", "id")


def test_jitter_only_when_collapsed(spark):
    key = F.col("id").cast("string")
    spread = M.pca_2d(frame(spark, np.random.default_rng(3).normal(size=(30, 4)))).rows
    assert np.array_equal(coordinates(M.jitter_if_degenerate(spread, key)), coordinates(spread))
    same = M.pca_2d(frame(spark, np.tile([1.0, 2.0, 3.0], (500, 1)))).rows
    moved = coordinates(M.jitter_if_degenerate(same, key))
    assert len(np.unique(moved, axis=0)) == 500
    assert np.allclose(moved.std(axis=0), 1e-4, rtol=0.2) and np.abs(moved.mean(axis=0)).max() < 2e-5
    assert np.array_equal(moved, coordinates(M.jitter_if_degenerate(same.repartition(5), key)))


def test_map_needs_ten(spark):
    x = np.random.default_rng(4).normal(size=(12, 4))
    key = F.col("id").cast("string")
    assert M.embedding_map(frame(spark, x[:9]), key) is None
    rows, facts = M.embedding_map(frame(spark, x), key, sample_n=11)
    assert rows.count() == facts["n_used"] == 11 and facts["n_total_embeddings"] == 12


def test_scatter(spark):
    points = M.pca_2d(frame(spark, np.random.default_rng(5).normal(size=(12, 3)))).rows
    points = points.withColumn("Area", F.when(F.col("id") < 7, "a").when(F.col("id") < 10, "b").otherwise("c"))
    rows = M.scatter_table(points.drop("label"), "Area", k=1).groupBy("label", "label_count").count().collect()
    assert {tuple(r) for r in rows} == {("a", 7, 7), ("(other)", 5, 5)}
    with pytest.raises(ValueError):
        M.scatter_table(points, "Colour")


def test_normalize(spark):
    df = spark.createDataFrame([([3.0, 4.0],), ([0.0, 0.0],), ([],)], "v array<float>")
    got = [r[0] for r in df.select(l2_normalize(F.col("v"))).collect()]
    assert np.allclose(got[0], [0.6, 0.8]) and got[1] == [0.0, 0.0] and got[2] == []


def test_encoders(spark):
    df = spark.createDataFrame([(1, "a b a"), (2, "A  B\tA"), (3, ""), (4, "c")], "id int, t string")
    rows = {r["id"]: r["v"] for r in embed_text(df, "t", "v", HashedTokens(16)).collect()}
    assert rows[1] == rows[2] and len(rows[1]) == 16 and set(rows[3]) == {0.0}
    assert rows[1] != rows[4] and np.isclose(np.linalg.norm(rows[1]), 1.0)
    joined = {r["id"]: r["v"] for r in embed_distinct(df, "t", "v", HashedTokens(16)).collect()}
    assert joined == rows

    def factory():
        return lambda texts: np.array([[len(t), 0.0] for t in texts])

    custom = embed_text(df, "t", "v", factory, normalize=False, batch_size=2).orderBy("id").collect()
    assert [r["v"] for r in custom] == [[5.0, 0.0], [6.0, 0.0], [0.0, 0.0], [1.0, 0.0]]
    assert embed_text(df.limit(0), "t", "v", factory).count() == 0


def test_maps_keep_every_row_unless_asked(spark):
    """More rows than any built-in sample ever had."""
    rng = np.random.default_rng(4)
    x = rng.normal(size=(10_500, 3))
    df = frame(spark, x)
    rows, facts = M.embedding_map(df, F.col(df.columns[0]).cast("string"))
    assert rows.count() == facts["n_used"] == 10_500 and facts["sample_n"] is None
    assert M.embedding_map(df, F.col(df.columns[0]).cast("string"), sample_n=100)[0].count() == 100


def test_encoding_is_spread_by_measured_work(spark, tmp_path):
    from tristrata.functions.vectors import spread

    count = lambda df: df.select(F.spark_partition_id().alias("p")).distinct().count()
    long = F.repeat(F.lit("word "), 20_000)
    one = spark.range(40).select("id", F.repeat(F.lit("word "), 2000).alias("t")).coalesce(1)
    one.write.parquet(str(tmp_path / "one"))
    group = spark.read.parquet(str(tmp_path / "one"))
    cores = spark.sparkContext.defaultParallelism
    assert count(spread(group, "t")) == cores  # one row group reaches all cores
    wide = spark.range(0, 4000, 1, 16).select("id", F.repeat(F.lit("word "), 200).alias("t"))
    assert spread(wide, "t") is wide
    few = spark.range(10).select("id", F.lit("short").alias("t")).coalesce(1)
    assert spread(few, "t") is few and spread(few.limit(0), "t").count() == 0
    mixed = one.select("id", F.when(F.col("id") < 4, long).otherwise(F.col("t")).alias("t"))
    dealt = spread(mixed, "t")
    per = dealt.where("id < 4").groupBy(F.spark_partition_id()).count().collect()
    assert dealt.count() == 40 and max(r[1] for r in per) == 1  # long texts lie apart
