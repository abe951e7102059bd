from __future__ import annotations

import hashlib

import pytest
from pyspark.sql import functions as F

from tristrata.config import SourceSpec
from tristrata.schema import ORDER
from tristrata.sources.levels import content_digest, dataset_manifest, read_lines, write_csv
from tristrata.sources.tables import load_source, read_long_csv, trim_headers, union_sources


@pytest.mark.parametrize("split", [300, 4096, 10_000_000])
def test_order_key_restores_file_order(spark, tmp_path, split):
    for part, base in (("a", 0), ("b", 500), ("c", 1200)):
        rows = "\n".join(f"{i},x{'y' * (i % 17)}" for i in range(base, base + 500 + 100 * (part == "b")))
        (tmp_path / f"{part}.csv").write_text("n,t\n" + rows + "\n", encoding="utf-8")
    spark.conf.set("spark.sql.files.maxPartitionBytes", split)
    spark.conf.set("spark.sql.files.openCostInBytes", 0 if split == 300 else 4096)
    try:
        df = read_long_csv(spark, str(tmp_path))
        got = [r[0] for r in df.repartition(5, F.rand(1)).orderBy(ORDER).select(F.col("n").cast("int")).collect()]
    finally:
        spark.conf.unset("spark.sql.files.maxPartitionBytes")
        spark.conf.unset("spark.sql.files.openCostInBytes")
    assert got == [*range(500), *range(500, 1100), *range(1200, 1700)]


def test_order_key_of_files_packed_into_one_task(spark, tmp_path):
    """Spark packs the largest file first: rows after it must not be numbered from its end."""
    (tmp_path / "a00.csv").write_text("Area,Year,Value\n" + "".join(f"X,2000,{i}\n" for i in range(20_000)), encoding="utf-8")
    for k in range(1, 12):
        (tmp_path / f"a{k:02}.csv").write_text("Area,Year,Value\n" + "".join(f"X,2000,{20_000 + 3 * (k - 1) + i}\n" for i in range(3)), encoding="utf-8")
    df = read_long_csv(spark, str(tmp_path))
    assert df.select(F.spark_partition_id()).distinct().count() < 12
    assert df.groupBy(ORDER).count().where("count > 1").isEmpty()
    assert df.agg(F.max_by("Value", ORDER)).first()[0] == "20032"
    got = [int(r[0]) for r in df.orderBy(ORDER).select("Value").collect()]
    assert got == list(range(20_033))


def test_order_key_of_compressed_and_whole_files(spark, tmp_path):
    import gzip

    (tmp_path / "a.csv").write_text("n\n" + "".join(f"{i}\n" for i in range(50)), encoding="utf-8")
    with gzip.open(tmp_path / "b.csv.gz", "wt") as out:
        out.write("n\n" + "".join(f"{i}\n" for i in range(50, 40_000)))
    (tmp_path / "c.csv").write_text("n\n" + "".join(f"{i}\n" for i in range(40_000, 40_003)), encoding="utf-8")
    for multi_line in (False, True):
        df = read_long_csv(spark, str(tmp_path), multi_line)
        assert [int(r[0]) for r in df.orderBy(ORDER).select("n").collect()] == list(range(40_003))


def test_sources_follow_each_other(spark, tmp_path):
    for name in ("x", "y"):
        (tmp_path / f"{name}.csv").write_text(f"n\n{name}1\n{name}2\n", encoding="utf-8")
    both = union_sources([read_long_csv(spark, str(tmp_path / f"{n}.csv")) for n in ("y", "x")])
    assert [r["n"] for r in both.orderBy(ORDER).collect()] == ["y1", "y2", "x1", "x2"]


def test_ragged_rows_and_names_that_differ_in_case(spark, tmp_path):
    (tmp_path / "r.csv").write_text('Area,Year,Value\na,2000,1,9,9\n', encoding="utf-8")
    with pytest.raises(Exception, match="more than 3 cells"):
        read_long_csv(spark, str(tmp_path / "r.csv")).collect()
    cut = read_long_csv(spark, str(tmp_path / "r.csv"), ragged="cut").collect()
    assert [(r["Area"], r["Value"]) for r in cut] == [("a", "1")]
    (tmp_path / "s.csv").write_text('Area,area, AREA ,Year\n"a,b","c ""d"", e",x\nf,g,h,2000\n', encoding="utf-8")
    df = read_long_csv(spark, str(tmp_path / "s.csv"))
    assert df.columns == ["Area", "area_2", "AREA_3", "Year", ORDER]
    assert [(r["Area"], r["area_2"], r["Year"]) for r in df.orderBy(ORDER).collect()] == [("a,b", 'c "d", e', None), ("f", "g", "2000")]


def test_csv_quotes_and_missing(spark, tmp_path):
    (tmp_path / "x.csv").write_text(' A ,b\n"q ""1"", x",NA\n,NULL\n', encoding="utf-8")
    df = read_long_csv(spark, str(tmp_path / "x.csv"))
    assert df.columns == ["A", "b", ORDER]
    assert [tuple(r) for r in df.orderBy(ORDER).select("A", "b").collect()] == [('q "1", x', None), (None, None)]


def test_load_and_union(spark):
    a = spark.createDataFrame([("1", "x", 0)], f" v string, Domain string, {ORDER} bigint")
    b = spark.createDataFrame([("2", "c", 0)], f"v string, code string, {ORDER} bigint")
    la = load_source(a, SourceSpec(1, "ua", {"Domain": "D", "Note": None}))
    lb = load_source(b, SourceSpec(2, "ub", {"Domain": "E"}))
    rows = union_sources([la, lb]).orderBy(ORDER).collect()
    assert [r["Domain"] for r in rows] == ["D", "E"]
    assert rows[0]["code"] is None and rows[1]["code"] == "c"
    assert rows[0]["__source_url__"] == "ua" and rows[1]["__source_table__"] == 2
    assert union_sources([], spark).count() == 0
    assert trim_headers(a).columns[0] == "v"


@pytest.mark.parametrize("split", [64, 1_000_000])
def test_line_numbers_skip_blank_lines(spark, tmp_path, split):
    for part, lines in (("a", ["l1", "", "  ", "l2"]), ("b", ["", "l3"] + [f"l{i}" for i in range(4, 60)])):
        (tmp_path / f"{part}.txt").write_text("\n".join(lines) + "\n", encoding="utf-8")
    spark.conf.set("spark.sql.files.maxPartitionBytes", split)
    try:
        got = {r["value"]: r["line"] for r in read_lines(spark, str(tmp_path)).collect()}
    finally:
        spark.conf.unset("spark.sql.files.maxPartitionBytes")
    assert got == {f"l{i}": i for i in range(1, 60)}


def test_manifest_equals_hashlib(spark, tmp_path):
    df = spark.range(1000).withColumn("t", F.concat(F.lit("é"), "id"))
    write_csv(df.repartition(3), str(tmp_path / "out"))
    rows = dataset_manifest(spark, {"table": str(tmp_path / "out")}).collect()
    assert len(rows) == 3
    for r in rows:
        content = open(r["path"].replace("file:", ""), "rb").read()
        assert (r["sha256"], r["bytes"]) == (hashlib.sha256(content).hexdigest(), len(content))
        assert r["mtime_utc"].endswith("+00:00")
        level = [hashlib.sha256(x).hexdigest() for x in content.split(b"\n")[:-1]]
        assert r["lines"] == len(level)
        for _ in range(3):
            level = [hashlib.sha256("".join(level[i : i + 4096]).encode()).hexdigest() for i in range(0, len(level), 4096)]
        assert [r["tree_sha256"]] == level


def test_digest_trees_read_split_files(spark, tmp_path, monkeypatch):
    """A file read in many splits has the tree of its whole line order; content is not read above the limit."""
    from tristrata.sources import levels

    monkeypatch.setattr(levels, "FAN_OUT", 8)
    monkeypatch.setattr(levels, "WHOLE_BYTES", 10)
    lines = [f"line {i * i}" for i in range(300)]
    (tmp_path / "part-0.txt").write_text("\n".join(lines) + "\n")
    spark.conf.set("spark.sql.files.maxPartitionBytes", "200")
    try:
        row = dataset_manifest(spark, {"t": str(tmp_path)}).first()
    finally:
        spark.conf.unset("spark.sql.files.maxPartitionBytes")
    level = [hashlib.sha256(x.encode()).hexdigest() for x in lines]
    for _ in range(3):
        level = [hashlib.sha256("".join(level[i : i + 8]).encode()).hexdigest() for i in range(0, len(level), 8)]
    assert [row["tree_sha256"]] == level and row["sha256"] is None and row["lines"] == 300


def test_level_files_are_cut_by_bytes(spark, tmp_path):
    from tristrata.sources.levels import write_jsonl_level

    df = spark.range(2000).select(F.col("id"), F.repeat(F.lit("x"), F.when(F.col("id") % 500 == 0, 3000).otherwise(40)).alias("t"))
    write_jsonl_level(df.coalesce(1), str(tmp_path / "out"), file_bytes=20_000)
    sizes = [f.stat().st_size for f in (tmp_path / "out").glob("part-*")]
    assert max(sizes) <= 20_000 and len(sizes) < 40
    assert spark.read.json(str(tmp_path / "out")).count() == 2000
    write_jsonl_level(df.limit(0), str(tmp_path / "none"))
    assert spark.read.schema("id bigint").json(str(tmp_path / "none")).count() == 0


def test_digest_ignores_layout(spark):
    df = spark.range(500).withColumn("v", F.col("id") * 1.5)
    one, other = content_digest(df.coalesce(1)), content_digest(df.repartition(9, F.rand(2)))
    assert one.first() == other.first()
    assert content_digest(df.filter("id <> 7")).first() != one.first()
    assert content_digest(df.limit(0)).first()["rows"] == 0
