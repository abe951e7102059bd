"""Queries that write text in order: files of bounded size, the same results."""

from __future__ import annotations

import datetime as dt
import hashlib

import pytest

from catalogue_queries import ingest


@pytest.fixture()
def tables(spark, tmp_path):
    """60 orders and 200 events of four days and ten user groups."""
    day = dt.date(1995, 3, 1)
    orders = [(k, 1 + k % 3, "OFP"[k % 3], float(100 + k), day, "1-URGENT") for k in range(1, 61)]
    events = [(k, k % 10, ("view", "error")[k % 2], float(k) / 8, dt.datetime(2024, 1, 1 + k % 4)) for k in range(1, 201)]
    made = {
        "nation": ([(0, "FRANCE", 0)], "n_nationkey int, n_name string, n_regionkey int"),
        "customer": ([(k, 0, "AUTO") for k in (1, 2, 3)], "c_custkey bigint, c_nationkey int, c_mktsegment string"),
        "orders": (orders, "o_orderkey bigint, o_custkey bigint, o_orderstatus string, o_totalprice double, o_orderdate date, o_orderpriority string"),
        "events": (events, "event_id bigint, user_id bigint, event_type string, value double, ts timestamp"),
    }
    for name, (rows, schema) in made.items():
        spark.createDataFrame(rows, schema).write.parquet(f"{tmp_path}/{name}.parquet")
    return str(tmp_path)


def test_long_csv_is_written_by_many_tasks(spark, tables, tmp_path, monkeypatch):
    whole = sorted(map(tuple, ingest.read_long_csv(spark, tables).collect()), key=str)
    monkeypatch.setattr(ingest, "FILE_ROWS", 20, raising=False)
    monkeypatch.setattr(ingest, "scratch_path", lambda spark, label: f"{tmp_path}/{label}")
    assert sorted(map(tuple, ingest.read_long_csv(spark, tables).collect()), key=str) == whole
    # 230 rows but for the last 30, and a header in each file.
    lengths = [len(p.read_text().splitlines()) - 1 for p in sorted((tmp_path / "long-csv" / "00").glob("part-*"))]
    assert sum(lengths) == 230 and max(lengths) <= 60
    assert [r[-1] for r in whole if r[3] == "u1" and r[7] == 2] == [7.5]


def test_manifest_of_artefacts_in_many_files(spark, tables, tmp_path, monkeypatch):
    whole = sorted(map(tuple, ingest.dataset_manifest(spark, tables).collect()))
    monkeypatch.setattr(ingest, "FILE_ROWS", 20, raising=False)
    monkeypatch.setattr(ingest, "scratch_path", lambda spark, label: f"{tmp_path}/{label}-text")
    assert sorted(map(tuple, ingest.dataset_manifest(spark, tables).collect())) == whole
    files = [p.read_text().splitlines() for p in sorted((tmp_path / "orders-text").glob("part-*"))]
    assert max(map(len, files)) <= 40
    lines = [f"{k}|1-URGENT|{1 + k % 3}" for k in range(1, 61)]
    assert sum(files, []) == lines
    digest = hashlib.sha256("".join(hashlib.sha256(x.encode()).hexdigest() for x in lines).encode()).hexdigest()
    for _ in range(2):
        digest = hashlib.sha256(digest.encode()).hexdigest()
    assert whole[1] == ("orders", 60, sum(len(x) + 1 for x in lines), digest)
