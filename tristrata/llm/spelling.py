"""Spelling variants by reduced words.

Every letter is hashed to one of a few symbols. Words that one edit apart are, or stay
equal as reduced words, or differ by one edit there. So each word generates the full
one-edit neighbourhood of its reduced word (itself, every deletion, replacement and
insertion of a symbol) as names that follow from prefix hashes in constant time each; the
names are joined with those of the reduced vocabulary, and the words behind a hit are
compared letter by letter.

Words are counted per task before they move. A bitmap of fixed size over the names of the
vocabulary only saves moving names that no word has.
"""

from __future__ import annotations

import re
import zlib
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..shared import materialize
from . import textual
from .jaccard import _marked, bitmap

LETTERS = "A-Za-zÀ-ÿ"
LEAST_LETTERS = 6
LEAST_TIMES = 5
FLAW_EVERY = 199
RATIO = 5
SYMBOLS = 8
HELD_LETTERS = 8 << 20
#: Letters of the words whose neighbourhoods are generated at once.
BATCH_LETTERS = 1 << 17
LONG_TEXT = 4 << 20

_LOWER = {i: i + 32 for i in range(ord("A"), ord("Z") + 1)}
_BASE = np.uint64(0x9E3779B97F4A7C15)
_INVERSE = np.uint64(pow(0x9E3779B97F4A7C15, -1, 1 << 64))


def word_counts(docs: DataFrame, flaw_every: int = FLAW_EVERY, letters: int = LEAST_LETTERS, times: int = LEAST_TIMES) -> DataFrame:
    """(word, n): words of ``letters`` letters or more that occur ``times`` times or more in ``docs`` (doc_id, text).

    Words are maximal runs of letters with A-Z lower-cased. Where the crc32 of
    ``<doc_id>:<word>`` is divisible by ``flaw_every``, the letter at crc32 modulo the
    word's length is left out. A null text has no words, a null doc_id is written as nothing.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        # A letter may be left out, never added: shorter runs cannot count.
        find = re.compile(f"[{LETTERS}]{{{letters},}}")
        total: Counter[str] = Counter()
        held = 0

        def out() -> pa.RecordBatch:
            return pa.RecordBatch.from_arrays([pa.array(list(total), pa.string()), pa.array(list(total.values()), pa.int64())], ["word", "n"])

        for batch in textual.slices(batches):
            for key, text in zip(batch.column("key").to_pylist(), batch.column("text").to_pylist()):
                if not text:
                    continue
                seed = zlib.crc32(f"{key}:".encode())
                text = text.translate(_LOWER)
                runs = find.findall(text) if len(text) < LONG_TEXT else (m[0] for m in find.finditer(text))
                for word, n in Counter(runs).items():
                    h = zlib.crc32(word.encode(), seed)
                    if h % flaw_every == 0:
                        at = h % len(word)
                        word = word[:at] + word[at + 1 :]
                        if len(word) < letters:
                            continue
                    if word not in total:
                        held += len(word) + 16
                    total[word] += n
                if held > HELD_LETTERS:
                    yield out()
                    total.clear()
                    held = 0
        if total:
            yield out()

    found = docs.select(F.coalesce(F.col("doc_id").cast("string"), F.lit("")).alias("key"), "text").mapInArrow(run, "word string, n bigint")
    return found.groupBy("word").agg(F.sum("n").alias("n")).where(F.col("n") >= times)


class Reduced:
    """Reduced forms of a batch of words, as prefix hashes."""

    def __init__(self, words: list[str], symbols: int):
        self.length = np.array([len(w) for w in words], dtype=np.int64)
        points = np.frombuffer("".join(words).encode("utf-32-le"), dtype="<u4").astype(np.uint64)
        self.symbols = symbols
        self.symbol = textual.mix(points * _BASE) % np.uint64(symbols) + np.uint64(1)
        self.of = np.repeat(np.arange(len(words)), self.length)
        self.start = np.cumsum(self.length) - self.length
        self.place = np.arange(len(points)) - np.repeat(self.start, self.length)
        longest = int(self.length.max(initial=0))
        self.power = np.cumprod(np.concatenate([[np.uint64(1)], np.full(longest + 1, _BASE)]), dtype=np.uint64)
        sums = np.concatenate([np.zeros(1, np.uint64), np.cumsum(self.symbol * self.power[self.place], dtype=np.uint64)])
        first = sums[self.start]
        self.before = sums[:-1] - first[self.of]  # hash of the symbols before each letter
        self.whole = sums[self.start + self.length] - first

    @staticmethod
    def named(value: np.ndarray, length: np.ndarray) -> np.ndarray:
        return textual.mix(value ^ (length.astype(np.uint64) * textual._MIX1)).view(np.int64)

    def names(self) -> np.ndarray:
        return self.named(self.whole, self.length)

    def neighbourhood(self) -> tuple[np.ndarray, np.ndarray]:
        """(word, name) of each word's reduced form and of all forms one edit away, without repeats."""
        whole, length, power = self.whole[self.of], self.length[self.of], self.power[self.place]
        here = self.symbol * power
        rest = whole - self.before - here
        of, value, size = [np.arange(len(self.length))], [self.whole], [self.length]

        def add(who: np.ndarray, what: np.ndarray, many: np.ndarray) -> None:
            of.append(who)
            value.append(what)
            size.append(many)

        add(self.of, self.before + rest * _INVERSE, length - 1)
        last = self.power[self.length]
        for s in range(1, self.symbols + 1):
            s = np.uint64(s)
            other = self.symbol != s
            add(self.of[other], (whole - here + s * power)[other], length[other])
            add(self.of, self.before + s * power + (whole - self.before) * _BASE, length + 1)
            add(np.arange(len(self.length)), self.whole + s * last, self.length + 1)
        of, name = np.concatenate(of), self.named(np.concatenate(value), np.concatenate(size))
        order = np.lexsort((name, of))
        of, name = of[order], name[order]
        new = np.ones(len(of), dtype=bool)
        new[1:] = (of[1:] != of[:-1]) | (name[1:] != name[:-1])
        return of[new], name[new]


def _batches(batch: pa.RecordBatch) -> Iterator[list[str]]:
    words = batch.column("word").to_pylist()
    ends = np.cumsum([len(w) for w in words])
    at = 0
    while at < len(words):
        to = max(at + 1, int(np.searchsorted(ends, (ends[at - 1] if at else 0) + BATCH_LETTERS, "right")))
        yield words[at:to]
        at = to


def near_words(words: DataFrame, symbols: int = SYMBOLS) -> DataFrame:
    """(word, other, other_n): ordered pairs of ``words`` (word, n) that differ by one inserted, deleted or replaced letter."""
    spark = words.sparkSession

    def reduce(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            at = 0
            for some in _batches(batch):
                part = batch.slice(at, len(some))
                at += len(some)
                yield pa.RecordBatch.from_arrays([*part.columns, pa.array(Reduced(some, symbols).names())], ["other", "other_n", "key"])

    reduced = words.select("word", "n").mapInArrow(lambda b: reduce(b), "other string, other_n bigint, key bigint")
    shared = spark.sparkContext.broadcast(bitmap(reduced.select("key")))

    def generate(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for some in _batches(batch):
                of, name = Reduced(some, symbols).neighbourhood()
                there = _marked(shared.value, name).to_numpy(zero_copy_only=False)
                yield pa.RecordBatch.from_arrays([pa.array(some, pa.string()).take(pa.array(of[there])), pa.array(name[there])], ["word", "key"])

    asked = words.select("word").mapInArrow(generate, "word string, key bigint")
    return asked.join(reduced, "key").where(F.levenshtein("word", "other", 1) == 1).select("word", "other", "other_n")


def _roots(links: DataFrame) -> DataFrame:
    """(word, root): the end of the path of ``links`` (word, form) from each word, by doubling.

    A form occurs several times as often as its word, so there are no circles and paths
    are as long as the logarithm of the largest count at most.
    """
    now = materialize(links.select("word", F.col("form").alias("root")), "roots")
    while True:
        ahead = now.select(F.col("word").alias("root"), F.col("root").alias("farther"))
        after = materialize(now.join(ahead, "root", "left").select("word", F.coalesce("farther", "root").alias("root"), F.col("farther").isNotNull().alias("moved")), "roots")
        if after.where("moved").isEmpty():
            return after.select("word", "root")
        now = after.select("word", "root")


def variants(words: DataFrame, ratio: int = RATIO, symbols: int = SYMBOLS) -> DataFrame:
    """word, form, root, n, n_near and form_n of every row of ``words`` (word, n; words are distinct).

    A word's form is the most frequent of its near words (ties: smallest in code-point
    order) if that is at least ``ratio`` times as frequent, else null; its root the last
    word reached by following forms, itself if there is none; n_near counts near words.
    """
    words = materialize(words.select("word", "n"), "words")
    near = near_words(words, symbols)
    best = near.groupBy("word").agg(F.count(F.lit(1)).alias("n_near"), F.min(F.struct((-F.col("other_n")).alias("less"), "other")).alias("best"))
    told = words.join(best, "word", "left")
    fits = -F.col("best.less") >= F.col("n") * ratio
    told = materialize(
        told.select(
            "word", "n", F.coalesce("n_near", F.lit(0)).cast("bigint").alias("n_near"),
            F.when(fits, F.col("best.other")).alias("form"), F.when(fits, -F.col("best.less")).alias("form_n"),
        ),
        "forms",
    )
    roots = _roots(told.where("form is not null"))
    return told.join(roots, "word", "left").select("word", "form", F.coalesce("root", "word").alias("root"), "n", "n_near", "form_n")
