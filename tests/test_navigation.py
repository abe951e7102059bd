from __future__ import annotations

import numpy as np
import pytest
from pyspark.sql import functions as F

from tristrata.operators import lookup as L
from tristrata.operators import profile as P
from tristrata.operators import sampling as A
from tristrata.operators.histograms import value_histogram, value_histogram_auto
from tristrata.operators import quantiles as Q
from tristrata.operators.quantiles import exact_quantiles
from tristrata.operators.timeline import run_summary, stage_seconds
from tristrata.plans.build import build_catalogue
from tristrata.plans.preview import series_preview


@pytest.fixture(scope="module")
def catalogue(spark, make_facts, tmp_path_factory):
    rows = [
        (f"a{i:02d}", f"i{i % 3}", "e", "u" if i % 4 else None, str(2000 + y), str((i * y) % 7))
        for i in range(40)
        for y in range(1 + i % 5)
    ]
    built = build_catalogue(make_facts(rows))
    root = tmp_path_factory.mktemp("nav")
    for level in ("l3", "l2", "l1"):
        getattr(built, level).write.parquet(str(root / level))
        setattr(built, level, spark.read.parquet(str(root / level)))
    return built


def keys(df):
    return [r[0] for r in df.select("identity.series_key").collect()]


def ranked(catalogue, descending):
    rows = catalogue.l2.select("identity.series_key", "properties.n_members").collect()
    return [k for k, n in sorted(rows, key=lambda r: (-r[1] if descending else r[1], r[0]))]


@pytest.mark.parametrize("descending", [True, False])
def test_rank(catalogue, descending):
    want = ranked(catalogue, descending)
    for rank in (1, 2, 9, 17, 40):
        assert keys(A.series_by_rank(catalogue.l2, rank, descending)) == [want[rank - 1]]
    assert keys(A.series_by_rank(catalogue.l2, 41, descending)) == []
    # Without adaptive stages, which are jobs of their own: one job locates the row, one reads it.
    spark = catalogue.l2.sparkSession
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    spark.sparkContext.setJobGroup(f"rank {descending}", "rank")
    A.series_by_rank(catalogue.l2, 7, descending).collect()
    spark.sparkContext.setJobGroup("", "")
    spark.conf.unset("spark.sql.adaptive.enabled")
    assert len(spark.sparkContext.statusTracker().getJobIdsForGroup(f"rank {descending}")) <= 3
    with pytest.raises(ValueError):
        A.series_by_rank(catalogue.l2, 0)


@pytest.mark.parametrize("k", [1, 7, 40, 60])
def test_sample_size_and_stability(catalogue, k):
    one = keys(A.sample_series(catalogue.l2, k, seed=3))
    assert len(one) == len(set(one)) == min(k, 40)
    assert keys(A.sample_series(catalogue.l2.repartition(9), k, seed=3)) == one
    if k == 7:
        assert keys(A.sample_series(catalogue.l2, k, seed=4)) != one


def test_lookups(catalogue):
    key = ranked(catalogue, True)[0]
    assert L.lookup_records(catalogue.l1, key, strict=True).count() == 1
    found = L.lookup_series(catalogue.l2, catalogue.l3, key, strict=True).first()
    assert found["l3"]["Domain"] == "D"
    orphan = L.lookup_series(catalogue.l2, catalogue.l3.limit(0), key).first()
    assert orphan["l3"] == {}
    for absent in (lambda: L.lookup_records(catalogue.l1, "no", strict=True),
                   lambda: L.lookup_series(catalogue.l2, catalogue.l3, "no", strict=True)):
        with pytest.raises(KeyError):
            absent()


def test_records_for_keys_forms(spark, catalogue):
    wanted = ranked(catalogue, True)[:5]
    frame = spark.createDataFrame([(k,) for k in wanted * 2], "k string")
    assert sorted(keys(L.records_for_keys(catalogue.l1, wanted))) == sorted(wanted)
    assert sorted(keys(L.records_for_keys(catalogue.l1, frame))) == sorted(wanted)


def test_unknown_domain_labels(catalogue):
    row = L.label_series(catalogue.l2, catalogue.l3.limit(0)).first()
    assert row["Domain"] == row["Domain_table"] == ""
    row = L.label_series_with_fallback(catalogue.l2, catalogue.l3.limit(0)).first()
    assert row["Domain"] == "" and row["Domain_table"] == row["domain_key"]


def test_expand_keeps_empty_series(catalogue):
    emptied = catalogue.l1.withColumn("data", F.slice("data", 1, 0))
    flat = L.expand_hierarchy(catalogue.l3, catalogue.l2, emptied)
    assert flat.count() == 40 and flat.filter("Year is not null").count() == 0


def test_points(spark):
    df = spark.sql(
        "select array(named_struct('Year', 2002, 'Value', 1.0D), named_struct('Year', 2000, 'Value', double('inf')),"
        " named_struct('Year', 2001, 'Value', double('nan')), named_struct('Year', null, 'Value', 1.0D),"
        " named_struct('Year', 1999, 'Value', 2.0D)) as d"
    )
    assert [tuple(p) for p in df.select(L.finite_points(F.col("d"))).first()[0]] == [(1999, 2.0), (2002, 1.0)]
    assert df.select(L.finite_points(F.slice("d", 1, 2))).first()[0] == []


def test_cards(catalogue):
    cards = L.series_cards(A.sample_series(catalogue.l2, 10), catalogue.l3, catalogue.l1, "X").collect()
    assert len(cards) == 10
    for c in cards:
        members = c["properties"]["n_members"]
        assert c["n_points"] == (members if members >= 2 else 0) == len(c["points"])
        assert c["properties"]["trainable"] is None and c["dims_l3"]["Domain"] == "D"
        assert c["header"].startswith("X series | Domain: D | ")


def test_preview(catalogue):
    p = series_preview(catalogue, rank=1)
    assert p.title.first()["series_key"] == ranked(catalogue, True)[0]
    assert p.points.count() == 5 and p.histogram.count() == 20
    assert p.histogram.agg(F.sum("count")).first()[0] == 5
    for bad in (dict(), dict(series_key="a", rank=1), dict(rank=99)):
        with pytest.raises(ValueError):
            series_preview(catalogue, **bad)
    with pytest.raises(KeyError):
        series_preview(catalogue, series_key="no")


def test_histograms_sum_to_points(catalogue):
    want = {r[0]: r[1] for r in catalogue.l2.select("identity.series_key", F.col("properties.n_members") - F.col("properties.nulls")).collect()}
    rows = value_histogram(catalogue.l1, 6).groupBy("series_key").agg(F.sum("count"), F.count("*")).collect()
    assert {r[0]: (r[1], r[2]) for r in rows} == {k: (n, 6) for k, n in want.items()}
    auto = value_histogram_auto(catalogue.l1).groupBy("series_key").agg(F.sum("count")).collect()
    assert {r[0]: r[1] for r in auto} == {k: n for k, n in want.items() if n >= 2}


@pytest.mark.parametrize("bound", [10_000, 40])
@pytest.mark.parametrize("kind", ["normal", "ties", "constant", "skewed", "tiny"])
def test_exact_quantiles(spark, monkeypatch, kind, bound):
    """With the small bound intervals are narrowed in several passes."""
    monkeypatch.setattr(Q, "ROW_BOUND", bound)
    rng = np.random.default_rng(8)
    data = {
        "normal": rng.normal(size=5000), "ties": rng.integers(0, 4, 5000).astype(float), "constant": np.full(300, 2.5),
        "skewed": np.concatenate([np.zeros(4000), rng.lognormal(0, 5, 900)]), "tiny": np.array([3.0, -1.0]),
    }[kind]
    rows = [(("x", "y")[i % 3 == 0], float(v)) for i, v in enumerate(data)] + [("x", None), ("x", float("nan"))]
    df = spark.createDataFrame(rows, "g string, v double").repartition(5)
    probs = [0.0, 0.1, 0.25, 0.5, 0.75, 0.999, 1.0]
    found = exact_quantiles(df, "v", probs, ["g"])
    assert "Window" not in found._jdf.queryExecution().optimizedPlan().toString()
    got = {r["g"]: r for r in found.collect()}
    for g in {r[0] for r in rows}:
        v = np.array([r[1] for r in rows if r[0] == g and r[1] is not None and r[1] == r[1]])
        if len(v):
            assert got[g]["n"] == len(v)
            assert np.allclose([got[g][f"q{i}"] for i in range(len(probs))], np.quantile(v, probs), rtol=1e-12)


def test_quantiles_survive_a_poor_sketch(spark, monkeypatch):
    monkeypatch.setattr(Q, "SKETCH_ACCURACY", 1)
    monkeypatch.setattr(Q, "ROW_BOUND", 20)
    df = spark.range(3001).select(F.lit("g").alias("g"), (F.col("id") * F.col("id")).cast("double").alias("v")).repartition(6)
    row = exact_quantiles(df, "v", [0.25, 0.5], ["g"]).first()
    assert (row["q0"], row["q1"]) == (750.0**2, 1500.0**2)


def test_quantiles_of_infinite_values_and_many_groups(spark, monkeypatch):
    monkeypatch.setattr(Q, "ROW_BOUND", 5)
    inf = float("inf")
    rows = [(g, float(v)) for g in range(30) for v in (*range(g, 40), -inf, inf, 7.0, 7.0)]
    got = {r["g"]: r for r in exact_quantiles(spark.createDataFrame(rows, "g int, v double"), "v", [0.5], ["g"]).collect()}
    for g in range(30):
        assert got[g]["q0"] == np.quantile([v for k, v in rows if k == g and abs(v) < inf] + [-1e9, 1e9], 0.5)


def test_numeric_rule_and_stats(spark):
    rows = [(i, float(i), None if i % 2 else 1.0, float(i) if i < 61 else None) for i in range(100)]
    props = spark.createDataFrame(rows, "series_key int, prop__a double, prop__b double, prop__c double")
    assert [(r["property"], r["n"]) for r in P.numeric_properties(props).collect()] == [("a", 100), ("c", 61)]
    row = {r["property"]: r for r in P.property_stats(props).collect()}["a"]
    v = np.arange(100.0)
    assert np.allclose(
        [row[c] for c in ("min", "p25", "median", "mean", "p75", "max", "std")],
        [0, np.quantile(v, 0.25), 49.5, 49.5, np.quantile(v, 0.75), 99, v.std(ddof=1)],
    )


def test_box_whiskers_leave_outliers_out(spark):
    v = [*map(float, range(60)), 500.0, -300.0]
    props = spark.createDataFrame([(x, "t") for x in v], "prop__a double, Domain_table string")
    q1, q3 = np.quantile(v, [0.25, 0.75])
    inside = [x for x in v if q1 - 1.5 * (q3 - q1) <= x <= q3 + 1.5 * (q3 - q1)]
    for row in (P.box_stats(props).first(), P.box_stats_by_table(props).first()):
        assert (row["whisker_low"], row["whisker_high"]) == (min(inside), max(inside))


def test_collapse_topk(spark):
    rows = [(x,) for x in ["a"] * 5 + ["b"] * 4 + ["d"] * 2 + ["c"] * 2 + [None, ""]]
    df = spark.createDataFrame(rows, "x string")

    def counts(**kw):
        return {r[0]: r[1] for r in P.category_counts(P.collapse_topk(df, "x", **kw)).collect()}

    assert counts(k=5) == {"a": 5, "b": 4, "c": 2, "d": 2, "(empty)": 2}
    assert counts(k=3) == {"a": 5, "b": 4, "(empty)": 2, "Other": 4}
    assert counts(k=4, other="(other)", empty=None) == {"a": 5, "b": 4, "": 2, "c": 2, "(other)": 2}


def test_stage_seconds(spark):
    log = [
        ("r", 1, "x.done", 0.5), ("r", 2, "x.start", 1.0), ("r", 3, "x.start", 2.0), ("r", 4, "x.done", 4.0),
        ("r", 5, "x.done", 7.0), ("r", 6, "y.start", 8.0), ("r", 7, "y.error", 9.0), ("r", 8, "z.done", 10.0),
        ("s", 9, "x.start", None), ("s", 10, "x.done", 3.0),
    ]
    df = spark.createDataFrame(log, "run_id string, position int, name string, t_seconds double")
    got = {(r[0], r[1]): r[2] for r in stage_seconds(df, "position").collect()}
    assert got == {("r", "x"): 6.0, ("s", "x"): 3.0}
    assert {tuple(r) for r in run_summary(df, "position").collect()} == {("r", 8, 10.0), ("s", 2, 3.0)}
