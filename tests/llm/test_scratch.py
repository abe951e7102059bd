"""What operators leave in shared storage while their result is read."""

from __future__ import annotations

from tristrata import shared
from tristrata.llm import linededup


def test_line_dedup_writes_only_the_texts_that_it_cuts(spark, tmp_path, monkeypatch):
    monkeypatch.setattr(shared, "_SCOPES", [str(tmp_path)])
    passage = "\n".join(" ".join(f"w{i}x{j}" for j in range(12)) for i in range(6))
    rows = [(i, f"only line {i} of this text\nand its second {i * i}") for i in range(40)]
    rows += [(50, f"head\n{passage}\ntail"), (51, f"other head\n{passage}\nother tail"), (None, "a"), (60, None)]
    docs = spark.createDataFrame(rows, "doc_id bigint, text string")
    got = {r["doc_id"]: r["text"] for r in linededup.dedup(docs).collect()}
    assert got == dict(rows) | {51: "other head\nother tail"}
    left = {p.name[:-33]: str(p) for p in tmp_path.iterdir()}
    assert set(left) == {"suspect-keys", "suspects", "lost-lines"}
    assert spark.read.parquet(left["suspects"]).count() == 2


def test_marks_lose_no_key(spark):
    """Every key is marked, null parts too; of other rows only a few."""
    rows = spark.range(20_000).selectExpr("if(id = 7, null, cast(id as string)) as a", "id * 31 as b")
    keys = rows.where("b % 3 = 0").toDF("x", "y")
    marked = linededup._marked(rows, ["a", "b"], keys, ["x", "y"])
    assert marked.columns == ["a", "b", "marked"] and marked.count() == 20_000
    assert marked.where("b % 3 = 0 and not marked").isEmpty()
    assert marked.where("b % 3 <> 0 and marked").count() < 100
