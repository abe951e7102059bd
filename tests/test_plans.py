"""The shape of the physical plans is part of the contract."""

from __future__ import annotations

import re
import sys
from pathlib import Path

import pytest
from pyspark.sql import functions as F

from tristrata.config import BuildSpec
from tristrata.operators import profile, validate
from tristrata.operators.sampling import sample_series
from tristrata.plans.build import build_catalogue

ROOT = Path(__file__).resolve().parents[1]
ROWS = [(a, "i", "e", "u", str(y), "1") for a in "AB" for y in range(2000, 2004)]


def plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


def exchanges(text):
    return len(re.findall(r"Exchange hashpartitioning", text))


def test_build_plan(make_facts):
    c = build_catalogue(make_facts(ROWS))
    text = plan(c.l2)
    # Duplicates combine before the first exchange, in a hash map rather than by sorting.
    assert exchanges(text) == 2
    assert "SortAggregate" not in text and "PythonUDF" not in text and "Window" not in text
    assert exchanges(plan(c.l1)) == 2
    assert exchanges(plan(build_catalogue(make_facts(ROWS), BuildSpec(shuffle="colocate")).l1)) == 1


def test_scan_reads_needed_columns_only(spark, make_facts, tmp_path):
    path = str(tmp_path / "facts")
    make_facts(ROWS).withColumn("Note 1", F.lit("x")).write.parquet(path)
    schema = re.search(r"ReadSchema: (\S+)", plan(build_catalogue(spark.read.parquet(path)).l1)).group(1)
    assert "Note" not in schema and "Code" not in schema


def test_statistics_are_computed_once(make_facts):
    """Filters read the point array, so the property struct is not evaluated to filter."""
    text = plan(build_catalogue(make_facts(ROWS)).l2)
    conditions = re.findall(r"Filter (.*)", text)
    assert conditions and all("log2" not in c.lower() for c in conditions)


def test_sample_is_a_top_k(make_facts):
    assert "TakeOrderedAndProject" in plan(sample_series(build_catalogue(make_facts(ROWS)).l2, 3))


def test_no_cross_join_and_local_top_errors(spark):
    errors = spark.createDataFrame([("l1", 1, "e")], "level string, line int, error string")
    assert "WindowGroupLimit" in plan(validate.error_limit(errors, 5))
    l2 = spark.createDataFrame([("s", "d", 1, 1, 1, [])], "series_key string, domain_key string, line bigint, n_members bigint, embedding_dim bigint, errors array<string>")
    l1 = spark.createDataFrame([("s", 1, 1, [])], "series_key string, line bigint, n_points bigint, errors array<string>")
    l3 = spark.createDataFrame([("d", 1, 1, [])], "domain_key string, line bigint, embedding_dim bigint, errors array<string>")
    text = plan(validate.validation_summary({"l3": l3, "l2": l2, "l1": l1}))
    assert "CartesianProduct" not in text and "NestedLoopJoin" not in text
    assert "Join" not in text


def test_no_side_of_unknown_size_is_hinted(spark):
    df = spark.createDataFrame([("a",)], "x string")
    assert "strategy=broadcast" not in profile.collapse_topk(df, "x", 3)._jdf.queryExecution().analyzed().toString()


def test_no_banned_calls():
    sources = [*ROOT.glob("tristrata/**/*.py"), *ROOT.glob("catalogue_queries/*.py")]
    for path in (p for p in sources if "llm" not in p.parts):  # the optional part has tests of its own
        text = path.read_text(encoding="utf-8")
        for banned in ("localCheckpoint", "crossJoin", ".rdd", "toPandas", ".toLocalIterator"):
            assert banned not in text, (path, banned)


def test_registry_is_consistent():
    sys.path.insert(0, str(ROOT))
    import __spark_entry__ as entry

    queries, oracles = entry.queries(), entry.oracle_sql()
    assert set(oracles) <= set(queries) and len(queries) >= 80


def test_scratch_requires_shared_folder_on_a_cluster():
    from tristrata.shared import scratch_root

    class Conf(dict):
        def get(self, key, default=None):
            return dict.get(self, key, default)

    class Fake:
        class sparkContext:  # noqa: N801
            master = "spark://host:7077"

            @staticmethod
            def getConf():
                return Conf()

        conf = Conf()

    with pytest.raises(RuntimeError):
        scratch_root(Fake())


def test_unread_properties_are_not_computed(spark, make_facts):
    from tristrata.operators.series import record_bundles, dedup_keep_last, series_stats
    from tristrata.operators.columns import prepare_facts
    from pyspark.sql import functions as F

    facts = prepare_facts(make_facts([("A", "i", "e", "u", "2000", "1"), ("A", "i", "e", "u", "2001", "2")]))
    bundles = record_bundles(dedup_keep_last(facts))
    stats = series_stats(bundles)
    optimized = lambda df: df._jdf.queryExecution().optimizedPlan().toString()
    assert "LOG2" in optimized(stats)
    few = series_stats(bundles, ["year_min", "n_members", "zeros"]).select("properties.*")
    assert "LOG2" not in optimized(few)
    assert "LOG2" not in optimized(stats.agg(F.sum("properties.n_members")))
    assert few.first() == (2000, 2, 0)


def test_point_stats_equal_the_array_form(spark, make_facts):
    import random

    from tristrata.operators.columns import prepare_facts
    from tristrata.operators.series import dedup_keep_last, point_stats, record_bundles, series_stats

    rng = random.Random(3)
    rows = [("A", "i", "e", "u", str(1000 + k), str(round(rng.gauss(0, 9), 3))) for k in range(3000)]
    rows += [("B", "i", "e", "u", str(k), "5") for k in range(1, 40)] + [("C", "i", "e", "u", "7", None), ("C", "i", "e", "u", "8", "0")]
    rows += [("D", "i", "e", "u", "7", None), ("E", "i", "e", "u", "x", "1"), ("F", "i", "e", "u", "1", "1"), ("F", "i", "e", "u", "2", "2"), ("F", "i", "e", "u", "3", "inf")]
    points = dedup_keep_last(prepare_facts(make_facts(rows)))
    near = lambda x: "-" if x is None else round(x, 6)
    want, got = (
        {r["Area"]: [near(x) for x in r["properties"]] for r in df.select("Area", "properties").collect()}
        for df in (series_stats(record_bundles(points)), point_stats(points))
    )
    assert got == want and set(got) == {"A", "B", "C", "D", "F"}


def test_one_series_of_ten_million_points(spark):
    from tristrata.operators.series import point_stats
    from tristrata.schema import SERIES_DIMS

    n = 10_000_000
    value = F.pmod(F.col("id") * 7919, F.lit(1000)).cast("double")
    points = spark.range(0, n, 1, 8).select(*[F.lit("x").alias(d) for d in SERIES_DIMS], F.col("id").alias("Year"), value.alias("Value"))
    p = point_stats(points).first()["properties"]
    assert (p["n_members"], p["year_min"], p["year_max"], p["zeros"], p["min"], p["max"], p["median"]) == (n, 0, n - 1, n // 1000, 0.0, 999.0, 499.5)
    assert abs(p["mean"] - 499.5) < 1e-6 and abs(p["variance"] - (1000**2 - 1) / 12) < 1e-3 and 4.3 < p["entropy"] <= 4.3220
