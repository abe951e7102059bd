from __future__ import annotations

import random

import pytest

DOCS = "doc_id bigint, text string, lang string, source string, n_chars bigint"


@pytest.fixture(scope="session", autouse=True)
def shipped(spark):
    from tristrata.llm.queries import ship

    ship(spark)


@pytest.fixture(scope="session")
def docs_of(spark):
    """A documents table from (doc_id, text[, lang]) tuples."""

    def make(rows):
        full = [(r[0], r[1], r[2] if len(r) > 2 else None, "s", None if r[1] is None else len(r[1])) for r in rows]
        return spark.createDataFrame(full, DOCS)

    return make


ODD_TEXTS = [
    (1, "One two three four five six seven eight nine ten.\nAnd more of it."),
    (1, "One two three four five six seven eight nine ten.\nAnd more of it."),
    (1, "the same id with another text"),
    (2, None),
    (3, ""),
    (4, " \n\t \r\n"),
    (5, "a" * 120_000),
    (6, "word " * 30_000),
    (7, "É ñ 日本語 😀 ½ naïve"),
    (8, "\x00\x01 \x1f"),
    (9, "one TWO three"),
    (10, "ONE two Three"),
    (11, "\n" * 50),
    (None, "a text without an id"),
    (None, None),
]


@pytest.fixture(scope="session")
def odd(docs_of):
    """Nulls, empty and long texts, repeated rows, and columns whose names clash with the operators' own."""
    from pyspark.sql import functions as F

    clash = ["label", "score", "print", "lines", "chunks", "n", "name", "block", "words", "row", "gone", "idx", "digest", "key", "item_id"]
    return docs_of(ODD_TEXTS).select("*", *[F.lit(i).alias(c) for i, c in enumerate(clash)])


@pytest.fixture(scope="session")
def none(docs_of):
    return docs_of([])


@pytest.fixture(scope="session")
def prose():
    """Sentences of invented words, alike within a language."""
    parts = {"en": "th er on an re he in ed nd ha at en es or ti".split(), "fr": "ou ai eau ç é è re ment qu le au ch".split()}

    def make(lang, words, seed):
        rng = random.Random(f"{lang}{seed}")
        return " ".join("".join(rng.choice(parts[lang]) for _ in range(rng.randint(1, 4))) for _ in range(words))

    return make
