from __future__ import annotations

import json
import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from tristrata.config import BuildSpec, CatalogueConfig, EmbeddingSpec, Filters, SourceSpec, load_config
from tristrata.operators.columns import drop_columns_matching, prepare_facts, require_domain_columns, resolve_column
from tristrata.operators.series import dedup_keep_last, record_bundles
from tristrata.plans.build import build_catalogue, read_catalogue, run, write_catalogue

ROWS = [
    ("A", "i", "e", "u", "2001", "1", "01"),
    ("A", "i", "e", "u", "2003", "5", "02"),
    ("A ", "i", "e", "u", "2002", "0"),
    ("A", "i", "e", "u", "2001", "3"),
    ("A", "i", "e", "u", "2003", None),
    ("B", "i", "e", None, "x", "9", "7"),
    ("B", "i", "e", None, "2000", "4"),
    ("C", "i", "e", "u", None, "4"),
    ("D", "i", "e", "u", "2000", "bad"),
    ("E", "i", "e", "u", "2000.9", "2"),
    ("E", "i", "e", "u", "2001", "2"),
]


def by_area(l2):
    return {r["dims"]["Area"]: r for r in l2.collect()}


def test_build_semantics(make_facts):
    c = build_catalogue(make_facts(ROWS))
    l2 = by_area(c.l2)
    assert set(l2) == {"A", "B", "D", "E"}
    a = l2["A"]["properties"].asDict()
    assert (a["year_min"], a["year_max"], a["n_members"], a["zeros"], a["nulls"]) == (2001, 2003, 3, 1, 1)
    assert (a["min"], a["max"], a["mean"], a["median"], a["variance"]) == (0.0, 3.0, 1.5, 1.5, 2.25)
    d = l2["D"]["properties"].asDict()
    assert d["nulls"] == 1 and d["mean"] is None and d["entropy"] is None
    assert l2["B"]["dims"]["Unit"] == ""
    data = {r["identity"]["series_key"]: r["data"] for r in c.l1.collect()}
    assert [tuple(p) for p in data[l2["A"]["identity"]["series_key"]]] == [(2001, 3.0), (2002, 0.0), (2003, None)]
    assert c.counts().first().asDict() == {"domains": 1, "series": 4, "records": 7}


def test_cards_ignore_filters(make_facts):
    spec = BuildSpec(filters=Filters(min_points=100))
    c = build_catalogue(make_facts(ROWS), spec)
    assert (c.l3.count(), c.l2.count(), c.l1.count()) == (1, 0, 0)


@pytest.mark.parametrize(
    ("filters", "areas"),
    [
        (Filters(min_points=2), {"A", "E"}),
        (Filters(drop_if_zeros_pct_gte=0.5), {"B", "D", "E"}),
        (Filters(drop_if_zeros_pct_gte=0.51), {"A", "B", "D", "E"}),
        (Filters(drop_constant=True), {"A", "D"}),
    ],
)
def test_filters(make_facts, filters, areas):
    assert set(by_area(build_catalogue(make_facts(ROWS), BuildSpec(filters=filters)).l2)) == areas


def test_codes_come_from_first_row(make_facts):
    keep = r".*(Source|Flag|Note|Unnamed).*"
    spec = BuildSpec(include_codes=True, drop_columns_regex=keep)
    l2 = by_area(build_catalogue(make_facts(ROWS), spec).l2)
    assert l2["A"]["dims"]["Area_code"] == "1"
    assert l2["B"]["dims"]["Area_code"] == "7"
    assert l2["D"]["dims"]["Area_code"] == ""
    silent = by_area(build_catalogue(make_facts(ROWS), BuildSpec(include_codes=True)).l2)
    assert "Area_code" not in silent["A"]["dims"]
    assert silent["A"]["identity"] == l2["A"]["identity"]


@pytest.mark.parametrize("shuffle", ["spread", "colocate"])
def test_layout_does_not_change_result(spark, make_facts, shuffle):
    rng = random.Random(5)
    rows = [
        (f"a{rng.randrange(3)}", "i", f"e{rng.randrange(2)}", "u", str(2000 + rng.randrange(6)), str(rng.randrange(4)))
        for _ in range(400)
    ]
    base = make_facts(rows)
    want = sorted(build_catalogue(base).l2.toJSON().collect())
    mixed = base.repartition(7, F.rand(3))
    assert sorted(build_catalogue(mixed, BuildSpec(shuffle=shuffle)).l2.toJSON().collect()) == want
    staged = build_catalogue(mixed, BuildSpec(shuffle=shuffle), stage=True)
    assert sorted(staged.l2.toJSON().collect()) == want
    assert staged.counts().first()["records"] == staged.l1.select(F.sum(F.size("data"))).first()[0]
    years = staged.l1.select(F.transform("data", lambda p: p["Year"]).alias("y")).collect()
    assert all(list(r["y"]) == sorted(set(r["y"])) for r in years)


def test_dedup_is_idempotent(make_facts):
    once = dedup_keep_last(prepare_facts(make_facts(ROWS))).withColumnRenamed("__first__", "__order__")
    assert sorted(map(str, dedup_keep_last(once).select("Area", "Year", "Value").collect())) == sorted(
        map(str, once.select("Area", "Year", "Value").collect())
    )


def test_ordered_levels_follow_first_appearance(make_facts):
    rows = [(a, "i", "e", "u", "2000", "1") for a in "zmbza"]
    c = build_catalogue(make_facts(rows), ordered=True)
    assert [r["dims"]["Area"] for r in c.l2.collect()] == ["z", "m", "b", "a"]


def test_columns(spark):
    df = spark.createDataFrame([(1, 2, 3)], "` AREA` int, Area int, `Item Code` int")
    assert resolve_column(df, "area") == " AREA"
    assert resolve_column(df, "nope", optional=True) is None
    with pytest.raises(KeyError):
        resolve_column(df, "nope")
    assert drop_columns_matching(df, r".*(Code).*").columns == [" AREA", "Area"]
    assert drop_columns_matching(df, r".*(code).*").columns == df.columns
    with pytest.raises(KeyError):
        require_domain_columns(df)
    fixed = require_domain_columns(spark.createDataFrame([(1, 2, 3)], "domain int, SUB_DOMAIN int, Domain_table int"))
    assert fixed.columns == ["Domain", "Sub_domain", "Domain_table"]


def test_regex_on_mandatory_column_fails(make_facts):
    with pytest.raises(KeyError):
        prepare_facts(make_facts(ROWS), BuildSpec(drop_columns_regex="Value"))


def test_embeddings_fill_chosen_levels(make_facts):
    c = build_catalogue(make_facts(ROWS), embeddings=EmbeddingSpec(enabled=True, levels=["l2"]))
    row, card = c.l2.first(), c.l3.first()
    assert row["embedding_meta"]["embedding_dim"] == len(row["description"]["embedding"]) == 64
    assert sum(x * x for x in row["description"]["embedding"]) == pytest.approx(1.0, abs=1e-5)
    assert card["description"]["embedding"] is None and card["embedding_meta"]["embedding_dim"] == 0
    assert row["embedding_meta"]["embedding_model"] == card["embedding_meta"]["embedding_model"] == "hashed-tokens-64"


def test_jsonl_round_trip_keeps_nulls(spark, make_facts, tmp_path):
    c = build_catalogue(make_facts(ROWS))
    write_catalogue(c, str(tmp_path / "out"))
    back = read_catalogue(spark, str(tmp_path / "out"))
    for level in ("l3", "l2", "l1"):
        assert sorted(getattr(back, level).toJSON().collect()) == sorted(getattr(c, level).toJSON().collect())
    line = json.loads(spark.read.text(str(tmp_path / "out" / "l2")).first()[0])
    assert line["description"]["embedding"] is None and "embedding" in line["description"]


def test_run_from_files(spark, tmp_path):
    (tmp_path / "a.csv").write_text(
        " area ,ITEM,Element,Unit,Year,Value,Flag,Area Code\n"
        '"X, Y",i,e,u,2000,1,E,001\n"X, Y",i,e,u,2000,2,E,001\nNA,i,e,u,2001.7,1d,,\n"say ""hi""",i,e,u,2001,1_000,,3\n',
        encoding="utf-8",
    )
    (tmp_path / "b.csv").write_text("Area,Item,Element,Unit,Year,Value\nX,i,e,u,2000,5\n", encoding="utf-8")
    raw = {
        "run": {"run_id": "r1"},
        "build": {"include_codes": True, "drop_columns_regex": ".*(Source|Flag|Note|Unnamed).*"},
        "sources": [
            {"table": 1, "url": str(tmp_path / "a.csv"), "meta": {"Domain": "D", "Sub_domain": "S", "Domain_table": "T"}},
            {"table": 2, "url": str(tmp_path / "b.csv"), "meta": {"Domain": "D", "Sub_domain": "S", "Domain_table": "U"}},
        ],
    }
    (tmp_path / "config.json").write_text(json.dumps(raw), encoding="utf-8")
    out = run(spark, load_config(str(tmp_path / "config.json")), str(tmp_path / "levels"))
    assert out["counts"] == {"domains": 2, "series": 4, "records": 4}
    l2 = {r["dims"]["Area"]: r for r in read_catalogue(spark, str(tmp_path / "levels")).l2.collect()}
    assert set(l2) == {"X, Y", "", 'say "hi"', "X"}
    assert l2["X, Y"]["properties"]["mean"] == 2.0 and l2["X, Y"]["dims"]["Area_code"] == "1"
    assert l2[""]["properties"]["year_min"] == 2001 and l2[""]["properties"]["nulls"] == 1
    assert l2['say "hi"']["properties"]["nulls"] == 1 and l2["X"]["dims"]["Area_code"] == ""


def test_config_refuses_unknown_and_empty():
    with pytest.raises(ValueError):
        CatalogueConfig.from_dict({"sources": []})
    with pytest.raises(ValueError):
        CatalogueConfig.from_dict({"sources": [{"table": 1, "url": "x", "colour": 1}]})
    with pytest.raises(ValueError):
        CatalogueConfig.from_dict({"sources": [{"table": 1, "url": "x"}], "extra": {}})
    with pytest.raises(ValueError):
        EmbeddingSpec(levels=["l1"])
    assert CatalogueConfig(sources=[SourceSpec(1, "x")]).build.filters == Filters()


def test_bundles_keep_series_without_years(make_facts):
    bundles = record_bundles(dedup_keep_last(prepare_facts(make_facts(ROWS))))
    empty = [r["Area"] for r in bundles.collect() if not r["data"]]
    assert empty == ["C"]


def test_unknown_model_needs_an_encoder():
    from tristrata.config import EmbeddingSpec
    from tristrata.plans.build import resolve_encoder

    with pytest.raises(ValueError, match="no encoder"):
        resolve_encoder(EmbeddingSpec(enabled=True, model_name="some/model"))
    encoder, name = resolve_encoder(EmbeddingSpec(enabled=True, model_name="hashed-tokens-128"))
    assert encoder.dim == 128 and name == "hashed-tokens-128"
    assert resolve_encoder(EmbeddingSpec(enabled=True, model_name="m"), lambda: None)[1] == "m"
    assert resolve_encoder(EmbeddingSpec()) == (None, None)


def test_catalogue_with_a_callers_encoder(spark, make_facts):
    from tristrata.config import EmbeddingSpec

    facts = make_facts([("A", "i", "e", "u", "2000", "1"), ("B", "i", "e", "u", "2000", "2")])
    spec = EmbeddingSpec(enabled=True, model_name="letters", l2_normalize=False)
    c = build_catalogue(facts, embeddings=spec, encoder=lambda: lambda texts: np.array([[len(t), 1.0] for t in texts]))
    for row in [*c.l2.collect(), *c.l3.collect()]:
        assert row["description"]["embedding"] == [float(len(row["description"]["string"])), 1.0]
        assert row["embedding_meta"]["embedding_model"] == "letters" and row["embedding_meta"]["embedding_dim"] == 2


def scanned_rows(df):
    """Rows that the scan of ``df`` handed on, and the result."""
    found = df.collect()
    leaf = df._jdf.queryExecution().executedPlan().collectLeaves().head()
    return leaf.metrics().apply("numOutputRows").value(), found


def test_run_leaves_only_its_outputs(spark, tmp_path):
    from pathlib import Path

    from tristrata.shared import scratch_root

    (tmp_path / "t.csv").write_text("Area,Item,Element,Unit,Year,Value\n" + "".join(f"a{i % 7},i,e,u,{2000 + i},{i}\n" for i in range(90)))
    folder = Path(scratch_root(spark).removeprefix("file://")) / "tristrata"
    before = set(folder.glob("*")) if folder.exists() else set()
    meta = {"Domain": "D", "Sub_domain": "S", "Domain_table": "T"}
    done = run(spark, CatalogueConfig([SourceSpec(1, str(tmp_path / "t.csv"), meta)]), str(tmp_path / "out"))
    assert set(folder.glob("*")) == before and done["counts"]["series"] == 7
    assert {p.name for p in (tmp_path / "out").iterdir()} == {"l1", "l2", "l3", "keyed", "manifest"}


def test_keyed_lookups_read_few_row_groups(spark, make_facts, tmp_path):
    """A lookup in the columnar form reads one row group; an absent key mostly none."""
    import pyarrow.parquet as pq

    from tristrata.operators.lookup import lookup_records, lookup_series
    from tristrata.plans.build import read_keyed
    from tristrata.sources.levels import write_keyed_level

    rows = [(f"area {i}", "item", "element", "unit", str(2000 + k), str(i * k)) for i in range(3000) for k in range(2)]
    built = build_catalogue(make_facts(rows), stage=True)
    for level in ("l3", "l2", "l1"):
        write_keyed_level(getattr(built, level), f"{tmp_path}/keyed/{level}", level, row_group_bytes=20_000)
    groups = [pq.ParquetFile(f).metadata for f in (tmp_path / "keyed" / "l1").glob("*.parquet")]
    assert sum(g.num_row_groups for g in groups) > 8
    largest = max(g.row_group(i).num_rows for g in groups for i in range(g.num_row_groups))
    cat = read_keyed(spark, f"{tmp_path}/keyed")
    keys = sorted(r[0] for r in cat.l1.select("identity.series_key").collect())
    assert len(keys) == 3000
    for key in (keys[0], keys[1500], keys[-1]):
        read, found = scanned_rows(lookup_records(cat.l1, key))
        assert [r.identity.series_key for r in found] == [key] and read <= largest
        assert lookup_series(cat.l2, cat.l3, key).count() == 1
    absent = [scanned_rows(lookup_records(cat.l1, keys[i][:-1] + "~")) for i in range(0, 3000, 300)]
    assert all(found == [] for _, found in absent) and sum(read == 0 for read, _ in absent) >= 8


def test_catalogue_is_read_from_its_columnar_form_if_there_is_one(spark, make_facts, tmp_path):
    built = build_catalogue(make_facts(ROWS), stage=True)
    write_catalogue(built, f"{tmp_path}/both")
    write_catalogue(built, f"{tmp_path}/lines", keyed=False)
    both, lines = (read_catalogue(spark, f"{tmp_path}/{x}") for x in ("both", "lines"))
    for level in ("l3", "l2", "l1"):
        rows = [sorted(map(str, getattr(c, level).collect())) for c in (built, both, lines)]
        assert rows[0] == rows[1] == rows[2]
    assert "parquet" in both.l1._jdf.queryExecution().optimizedPlan().toString()
    assert "json" in lines.l1._jdf.queryExecution().optimizedPlan().toString()


def test_no_sort_aggregate_with_codes(make_facts):
    spec = BuildSpec(include_codes=True, drop_columns_regex=".*(Source|Flag|Note|Unnamed).*")
    built = build_catalogue(make_facts(ROWS), spec)
    plan = built.l2._jdf.queryExecution().sparkPlan().toString()
    assert "SortAggregate" not in plan and "HashAggregate" in plan
