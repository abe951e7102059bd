from __future__ import annotations

import json

import pytest
from pyspark.sql import functions as F

from tristrata.config import CatalogueConfig, EmbeddingSpec, SourceSpec
from tristrata.operators.validate import error_limit, validate_level
from tristrata.plans.build import build_catalogue, write_catalogue
from tristrata.plans.validation import repro_manifest, validate_lines


@pytest.fixture(scope="module")
def documents(make_facts):
    rows = [(a, "i", "e", "u", str(y), str(y % 3)) for a in "ABCD" for y in range(2000, 2003)]
    c = build_catalogue(make_facts(rows), embeddings=EmbeddingSpec(enabled=True))
    dump = {}
    for level in ("l3", "l2", "l1"):
        df = getattr(c, level).select(F.to_json(F.struct("*"), {"ignoreNullFields": "false"}))
        dump[level] = sorted(r[0] for r in df.collect())
    return dump


def parsed(documents):
    return {level: [json.loads(x) for x in lines] for level, lines in documents.items()}


def check(spark, docs):
    frames = {
        level: spark.createDataFrame(
            [(i, d if isinstance(d, str) else json.dumps(d, ensure_ascii=False)) for i, d in enumerate(rows, 1)],
            "line bigint, value string",
        )
        for level, rows in docs.items()
    }
    v = validate_lines(frames)
    return v.summary.first().asDict(), [tuple(r) for r in v.errors.orderBy("level", "line").collect()]


def test_valid_catalogue_passes(spark, documents):
    summary, errors = check(spark, parsed(documents))
    assert summary["ok"] and not errors
    assert (summary["n_domains_l3"], summary["n_series_l2"], summary["n_series_l1"]) == (1, 4, 4)
    assert summary["embedding_dim_l3"] == summary["embedding_dim_l2"] == 64


def drop(d, *path):
    for p in path[:-1]:
        d = d[p]
    del d[path[-1]]


def put(value, *path):
    def change(d):
        for p in path[:-1]:
            d = d[p]
        d[path[-1]] = value

    return change


BROKEN = [
    ("l2", put(1, "extra"), "unknown_field"),
    ("l2", put(1, "identity", "extra"), "identity"),
    ("l2", put("sereis", "kind"), "kind"),
    ("l2", put(None, "kind"), "kind"),
    ("l2", put(3, "schema_version"), "schema_version"),
    ("l2", lambda d: drop(d, "identity"), "domain_key,identity,series_key"),
    ("l2", put("md5:x", "identity", "series_key"), "series_key"),
    ("l2", put("", "identity", "domain_key"), "domain_key"),
    ("l2", lambda d: drop(d, "dims"), "dims"),
    ("l2", put(5, "description", "string"), "description"),
    ("l2", put(["x"], "description", "embedding"), "embedding"),
    ("l2", put([1.0, None], "description", "embedding"), "embedding"),
    ("l2", put(None, "properties", "n_members"), "properties"),
    ("l2", put(1.5, "properties", "year_min"), "properties"),
    ("l2", put("x", "properties", "mean"), "properties"),
    ("l2", put(1, "properties", "trainable"), "properties"),
    ("l2", lambda d: drop(d, "properties"), "properties"),
    ("l2", put(None, "embedding_meta", "embedding_model"), "embedding_model"),
    ("l2", put(None, "embedding_meta", "embedding_dim"), "embedding_meta"),
    ("l3", put(None, "embedding_meta"), "embedding_meta"),
    ("l3", put(1, "identity", "series_key"), "identity"),
    ("l1", put(None, "data", 0, "Year"), "year"),
    ("l1", put("abc", "data", 0, "Year"), "year"),
    ("l1", lambda d: drop(d, "data", 0, "Year"), "year"),
    ("l1", put("abc", "data", 0, "Value"), "value"),
    ("l1", put([1], "data", 1, "Value"), "value"),
    ("l1", put(1, "data", 2, "extra"), "data_item"),
    ("l1", put(7, "data", 0), "data_item"),
    ("l1", put(None, "data"), "data"),
    ("l1", put({}, "data"), "data"),
]


@pytest.fixture(scope="module")
def broken_codes(spark, documents):
    """All broken documents of a level checked in one job."""
    out = {}
    for level in ("l3", "l2", "l1"):
        rows = []
        for i, (lv, change, _) in enumerate(BROKEN):
            if lv == level:
                d = json.loads(documents[level][0])
                change(d)
                rows.append((i, json.dumps(d)))
        rows += [(1000, "{broken"), (1001, "[1]"), (1002, "7")]
        checked = validate_level(spark.createDataFrame(rows, "line bigint, value string"), level)
        out |= {(level, r["line"]): ",".join(r["errors"]) for r in checked.collect()}
    return out


@pytest.mark.parametrize("i", range(len(BROKEN)))
def test_broken_document(broken_codes, i):
    level, _, code = BROKEN[i]
    assert broken_codes[level, i] == code


@pytest.mark.parametrize("level", ["l3", "l2", "l1"])
def test_unreadable_lines(broken_codes, level):
    assert {broken_codes[level, i] for i in (1000, 1001, 1002)} == {"unparseable"}


ACCEPTED = [
    ("l2", lambda d: drop(d, "kind")),
    ("l2", lambda d: drop(d, "schema_version")),
    ("l2", put({}, "properties")),
    ("l2", put("3", "properties", "n_members")),
    ("l2", put(3.0, "properties", "zeros")),
    ("l2", put(None, "dims")),
    ("l2", put([1, 2], "dims")),
    ("l2", put(None, "description", "embedding")),
    ("l2", lambda d: d["identity"].update(series_key="  " + d["identity"]["series_key"] + " ")),
    ("l1", lambda d: drop(d, "data")),
    ("l1", put("2001.7", "data", 0, "Year")),
    ("l1", put(True, "data", 0, "Value")),
    ("l1", put(" ", "data", 0, "Value")),
    ("l1", put("1.5", "data", 0, "Value")),
    ("l1", lambda d: drop(d, "data", 0, "Value")),
]


def test_tolerated_documents(spark, documents):
    for level in ("l2", "l1"):
        rows = []
        for i, (lv, change) in enumerate(ACCEPTED):
            if lv == level:
                d = json.loads(documents[level][0])
                change(d)
                rows.append((i, json.dumps(d)))
        checked = validate_level(spark.createDataFrame(rows, "line bigint, value string"), level).collect()
        assert {r["line"]: r["errors"] for r in checked} == {i: [] for i, _ in rows}


LINKS = [
    ("n_members_mismatch", lambda d: d["l2"][0]["properties"].update(n_members=9)),
    ("missing_series_in_l1", lambda d: d["l1"].pop()),
    ("missing_series_in_l2", lambda d: d["l2"].pop()),
    ("missing_domain_in_l3", lambda d: d["l2"][1]["identity"].update(domain_key="sha256:other")),
    ("errors_l1", lambda d: d["l1"].append("{")),
]


@pytest.mark.parametrize("flag", [f for f, _ in LINKS])
def test_broken_links(spark, documents, flag):
    docs = parsed(documents)
    dict(LINKS)[flag](docs)
    summary, _ = check(spark, docs)
    counters = [f for f, _ in LINKS] + ["errors_l2", "errors_l3"]
    assert not summary["ok"]
    assert {c: summary[c] for c in counters} == {c: int(c == flag) for c in counters}
    assert summary["series_keys_match"] is (flag not in ("missing_series_in_l1", "missing_series_in_l2"))
    assert summary["domain_keys_covered"] is (flag != "missing_domain_in_l3")


def test_mixed_embedding_size(spark, documents):
    docs = parsed(documents)
    docs["l2"][2]["description"]["embedding"] = [1.0, 2.0]
    summary, errors = check(spark, docs)
    assert not summary["ok"] and not errors and summary["embedding_dim_l2"] == 64


def test_last_duplicate_wins(spark, documents):
    docs = parsed(documents)
    again = json.loads(json.dumps(docs["l1"][0]))
    docs["l1"][0]["data"] = []
    docs["l1"].append(again)
    assert check(spark, docs)[0]["ok"]
    docs["l1"].append(json.loads(json.dumps(again)))
    docs["l1"][-1]["data"] = []
    assert check(spark, docs)[0]["n_members_mismatch"] == 1


def test_errors_are_limited_per_level(spark, documents):
    docs = {level: ["{"] * 30 + rows for level, rows in parsed(documents).items()}
    summary, errors = check(spark, docs)
    assert summary["errors_l2"] == 30
    assert [(lv, ln) for lv, ln, _ in errors] == [(lv, i) for lv in ("l1", "l2", "l3") for i in range(1, 31)]
    every = spark.createDataFrame([("l1", i, "e") for i in range(50)], "level string, line int, error string")
    assert [r["line"] for r in error_limit(every.repartition(4), 3).orderBy("line").collect()] == [0, 1, 2]


def test_manifest_document(spark, make_facts, tmp_path):
    c = build_catalogue(make_facts([("A", "i", "e", "u", "2000", "1")]))
    paths = write_catalogue(c, str(tmp_path / "levels"))
    config = CatalogueConfig([SourceSpec(1, "x")])
    doc = json.loads(repro_manifest(spark, paths, config).first()[0])
    assert doc["validation"]["summary"]["ok"] is True and doc["validation"]["errors"] == []
    assert [(a["artefact"], a["rows"]) for a in doc["artefacts"]] == [("l1", 1), ("l2", 1), ("l3", 1)]
    assert json.loads(doc["config"])["seed"] == 42
    assert doc["contract"]["schema_version"] == "v_0_1_0"


def test_tokens_for_missing_numbers(spark):
    from tristrata.operators.validate import plain_json

    given = [
        '{"a": NaN, "b":[-Infinity,Infinity,1]}', '{"NaN": "NaN, Infinity", "c": "\\"NaN"}', '{"a": xNaN}', '{"a": 1}',
        '{"a": "' + "x\\n" * 50_000 + '", "b": NaN}',
    ]
    df = spark.createDataFrame([(i, x) for i, x in enumerate(given)], "i int, value string")
    got = [r[0] for r in df.select("i", plain_json(F.col("value")).alias("v")).orderBy("i").select("v").collect()]
    assert got[:4] == ['{"a": null, "b":[null,null,1]}', *given[1:4]]
    assert got[4] == given[4].replace("NaN", "null")
