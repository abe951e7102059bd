from __future__ import annotations

import hashlib
import json

import pytest
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from tristrata.functions import text as K
from tristrata.schema import L2_DIMS, L3_DIMS, SERIES_DIMS


def expected_key(dims):
    clean = {k: ("" if v is None else str(v).strip()) for k, v in dims.items()}
    payload = {"dims_l3": {k: clean[k] for k in L3_DIMS}, "dims_l2": {k: clean[k] for k in L2_DIMS}}
    text = json.dumps(payload, ensure_ascii=False, sort_keys=True, separators=(",", ":"))
    return "sha256:" + hashlib.sha256(text.encode()).hexdigest()


TEXTS = [
    "plain", 'quo"te', "back\\slash", "tab\tin", "ñandú <>&'", "\x0b\x1f mid \x0e x", "\\u001F literal", "\\\x1b",
    "  padded　", "\x85\xa0edge ", "日本", "", None, "a\x00b", "\x7f", " mid x",
]


def keys_of(spark, rows):
    df = spark.createDataFrame([(i, *r) for i, r in enumerate(rows)], "i int, " + ", ".join(f"{d} string" for d in SERIES_DIMS))
    source = {d: F.col(d) for d in SERIES_DIMS}
    return [r[1] for r in df.select("i", K.series_key(source)).orderBy("i").collect()]


def test_series_keys_equal_hashlib(spark):
    rows = [tuple(TEXTS[(i + j) % len(TEXTS)] for j in range(7)) for i in range(len(TEXTS))]
    assert keys_of(spark, rows) == [expected_key(dict(zip(SERIES_DIMS, r))) for r in rows]


@settings(max_examples=8, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(st.lists(st.tuples(*[st.text(st.characters(exclude_categories=["Cs"]), max_size=8)] * 7), min_size=1, max_size=30))
def test_series_keys_equal_hashlib_random(spark, rows):
    assert keys_of(spark, rows) == [expected_key(dict(zip(SERIES_DIMS, r))) for r in rows]


def test_clean_str_strips_what_python_strips(spark):
    spaces = [chr(c) for c in range(0x3100) if chr(c).isspace()]
    rows = [(c + "a b" + c + c,) for c in spaces] + [("​x",), (None,)]
    got = [r[0] for r in spark.createDataFrame(rows, "x string").select(K.clean_str(F.col("x"))).collect()]
    assert got == ["" if r[0] is None else r[0].strip() for r in rows]


def test_canonical_dims(spark):
    entries = ["Area", " X ", "Item", None, " Z", " z", "", "no", "Unit ", "shadow", "Z", "second"]
    full = F.create_map(*[F.lit(x).cast("string") for x in entries])
    df = spark.range(2).select(F.when(F.col("id") == 0, full).alias("d")).orderBy("id")
    got = [r[0] for r in df.select(K.canonical_dims(F.col("d"), L2_DIMS)).collect()]
    assert got[0] == {"Area": "X", "Item": "", "Element": "", "Unit": "", "Z": "z"}
    assert got[1] == {"Area": "", "Item": "", "Element": "", "Unit": ""}
    bare = df.select(K.canonical_dims(F.col("d"), L2_DIMS, keep_extras=False)).first()[0]
    assert set(bare) == set(L2_DIMS)


@pytest.mark.parametrize(
    ("dims", "text"),
    [
        (("D", "S", "T", "A", "I", "E", "U"),
         "Statistics series | Domain: D | Sub-domain: S | Domain-table: T | Area: A | Item: I | Element: E | Unit: U"),
        (("D", None, "T", " ", "I", "E", None), "Statistics series | Domain: D | Domain-table: T | Item: I | Element: E"),
    ],
)
def test_series_description(spark, dims, text):
    source = {k: F.lit(v).cast("string") for k, v in zip(SERIES_DIMS, dims)}
    assert spark.range(1).select(K.series_description("Statistics", source)).first()[0] == text


def test_headers(spark):
    l3 = F.create_map(F.lit("Domain"), F.lit("D"))
    l2 = F.create_map(F.lit("Area"), F.lit("A"), F.lit("Unit"), F.lit(""))
    row = spark.range(1).select(
        K.plot_header("X", l3, l2), K.plot_title("X", l3, l2), K.plot_title("X", l3, l2, 10)
    ).first()
    assert row[0] == "X series | Domain: D | Sub-domain:  | Domain-table:  | Area: A | Item:  | Element:  | Unit: "
    assert row[1] == "X series | Domain: D | Area: A"
    assert row[2] == "X series |…"


def test_extra_dims_sorted(spark):
    dims = F.create_map(*[F.lit(x) for x in ("Area", "a", "zeta", "1", "alpha", "2", "empty", "")])
    got = spark.range(1).select(K.extra_dims(dims)).first()[0]
    assert [tuple(e) for e in got] == [("alpha", "2"), ("zeta", "1")]
