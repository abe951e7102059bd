from __future__ import annotations

import hashlib
import re
import struct
from pathlib import Path

import public_tokenizers
import pytest
import tiktoken

import corpus_pipeline
from conftest import ODD_TEXTS
from test_documents import plain_components
from tristrata.llm import bpe
from tristrata.llm.queries import QUERIES


@pytest.fixture(scope="module")
def folder(tmp_path_factory, docs_of, spark, prose):
    """Good and poor documents, copies, near copies, shared passages and benchmark passages."""
    at = tmp_path_factory.mktemp("tables")
    item = prose("en", 30, "item")
    shared = "\n".join(prose("fr", 15, f"shared{k}") for k in range(8))
    rows, labels = [], []
    for i in range(300):
        text = "\n".join(prose("en", 20, f"{i}/{k}") for k in range(4))
        if i % 10 == 9:
            text = " ".join(w.upper() + "!!" for w in text.split())
        elif i % 10 == 1:
            text += " " + item
        elif i % 10 == 2:
            text += "\n" + shared
        rows.append((i, text, "en"))
        labels.append((i, int(i % 10 != 9), 0))
    rows += [(1000 + i, rows[i][1], "en") for i in range(0, 60, 10)]  # copies
    near = [(2000 + i, rows[i][1].replace("\n", " ") + " more", "en") for i in range(3, 63, 10)]
    docs = docs_of([*rows, *near, *((d, t, None) for d, t in ODD_TEXTS if d is None or d < 5)])
    docs.write.parquet(f"{at}/documents.parquet")
    spark.createDataFrame(labels, "doc_id bigint, quality int, toxic int").write.parquet(f"{at}/labels.parquet")
    spark.createDataFrame([(1, item)], "item_id bigint, text string").write.parquet(f"{at}/benchmark.parquet")
    return str(at)


def test_stages_take_effect(spark, folder, tmp_path):
    docs = spark.read.parquet(f"{folder}/documents.parquet")
    ids = lambda df: {r.doc_id for r in df.select("doc_id").collect() if r.doc_id is not None}
    kept = {}
    columns = docs.columns
    for name, stage in corpus_pipeline.STAGES:
        before, path = docs, f"{tmp_path}/{name}"
        stage(spark, docs, folder).write.parquet(path)
        docs = spark.read.parquet(path)
        kept[name] = ids(docs)
        if name != "bpe":
            assert docs.columns == columns
        if name == "near_copies":
            rows = [(r.doc_id, r.text) for r in before.collect()]
            expected = {d for d, _, c in plain_components(rows, 5, 80, 100) if d is not None and d == c}
            assert kept[name] == expected
    poor = {i for i in range(300) if i % 10 == 9}
    good = {i for i in range(300) if i % 10 != 9}
    assert good <= kept["quality"] and len(kept["quality"] & poor) <= 1
    assert not any(1000 + i in kept["line_dedup"] for i in range(0, 60, 10)) and good <= kept["line_dedup"]
    assert not any(2000 + i in kept["near_copies"] for i in range(3, 63, 10)) and good <= kept["near_copies"]
    leaked = {i for i in range(5, 300) if i % 10 == 1}  # smaller ids also stand for odd rows
    assert not kept["decontaminate"] & leaked and good - leaked <= kept["decontaminate"]
    assert kept["bpe"] == kept["decontaminate"]


def test_run_equals_its_stages_and_tokens(spark, folder):
    got = corpus_pipeline.run(spark, folder)
    assert got.columns == ["doc_id", "n_tokens", "ids_sha256", "decoded_sha256"]
    encoding = tiktoken.Encoding("own", pat_str=public_tokenizers.PATTERN, mergeable_ranks=bpe.load(public_tokenizers.path("byte_bpe_50k.tiktoken")).ranks, special_tokens={})
    text = {r.doc_id: r.text for r in spark.read.parquet(f"{folder}/documents.parquet").collect()}
    checked = 0
    for r in got.collect():
        if r.doc_id is not None and r.doc_id % 10 in (0, 4, 5, 6, 7, 8) and r.doc_id > 5:
            ids = encoding.encode_ordinary(text[r.doc_id])
            assert r.ids_sha256 == hashlib.sha256(struct.pack(f"<{len(ids)}I", *ids)).hexdigest()
            checked += 1
    assert checked > 100


def test_one_query_per_operator():
    assert sorted(int(re.match(r"op(\d+)_", n)[1]) for n in QUERIES) == list(range(1, 14))


def test_no_banned_calls():
    root = Path(corpus_pipeline.__file__).parent
    for path in [*root.glob("tristrata/llm/*.py"), root / "corpus_pipeline.py"]:
        text = path.read_text(encoding="utf-8")
        for banned in ("localCheckpoint", "crossJoin", ".rdd", "toPandas", "ImportError", ".cache(", ".persist("):
            assert banned not in text, (path, banned)


def test_native_operators_run_no_python():
    root = Path(corpus_pipeline.__file__).parent
    for name in ("urls", "linededup"):
        text = (root / f"tristrata/llm/{name}.py").read_text(encoding="utf-8")
        assert not re.search(r"mapIn|applyIn|udf|numpy|pyarrow|collect\(\)|toLocal", text), name


def test_run_on_empty_tables(spark, folder, none, tmp_path):
    none.write.parquet(f"{tmp_path}/documents.parquet")
    for name in ("labels", "benchmark"):
        spark.read.parquet(f"{folder}/{name}.parquet").limit(0).write.parquet(f"{tmp_path}/{name}.parquet")
    got = corpus_pipeline.run(spark, str(tmp_path))
    assert got.columns == ["doc_id", "n_tokens", "ids_sha256", "decoded_sha256"] and got.count() == 0
