"""Benchmark decontamination by the pigeonhole principle and bit-parallel edit distance.

A test item may occur with up to ``rate`` of its bytes edited. Cut into one piece more
than that budget, at least one piece must occur unchanged. An automaton of all pieces
finds their exact hits; the stretch of text around a hit is then searched with Myers'
bit-parallel algorithm. A short item has no room for edits: it must stand as it is between
word borders. Texts and items are compared in lower case with runs of anything
but letters and digits as one space; distances count bytes.
"""

from __future__ import annotations

from collections.abc import Iterator

import ahocorasick
import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import to_arrow_type

from . import textual

RATE = 0.08
#: A shorter item occurs unchanged and as whole words, or not at all.
SHORT_ITEM = 24
#: A block of items ends at so many items or bytes; its index takes some tens of bytes per byte.
BLOCK_ITEMS = 20_000
BLOCK_BYTES = 4 << 20

_SIGN = np.zeros(256, dtype=bool)
_SIGN[ord("a") : ord("z") + 1] = True
_SIGN[ord("0") : ord("9") + 1] = True
_SIGN[128:] = True


def plain(texts: pa.Array) -> list[str]:
    """Normalised texts, one character per byte."""
    raw, offsets = textual.raw_bytes(pc.utf8_lower(texts.cast(pa.large_string())))
    n = len(raw)
    sign = _SIGN[raw]
    first = np.zeros(n + 1, dtype=bool)
    first[offsets] = True
    space = ~sign
    space[1:] &= sign[:-1]
    space &= ~first[:n]
    keep = sign | space
    data = np.where(sign, raw, np.uint8(32))[keep].tobytes().decode("latin-1")
    at = np.concatenate([[0], np.cumsum(keep)])[offsets].tolist()
    return [data[a:b].rstrip(" ") for a, b in zip(at, at[1:])]


def masks(item: str) -> dict[str, int]:
    out: dict[str, int] = {}
    for i, c in enumerate(item):
        out[c] = out.get(c, 0) | (1 << i)
    return out


def best_end(mask: dict[str, int], size: int, text: str) -> tuple[int, int]:
    """Least edit distance between the item and any part of ``text``, and where that part first ends."""
    full, high = (1 << size) - 1, 1 << (size - 1)
    up, down, score = full, 0, size
    best, end = size, 0
    for at, c in enumerate(text, 1):
        eq = mask.get(c, 0)
        v = eq | down
        h = (((eq & up) + up) ^ up) | eq
        plus = down | (full & ~(h | up))
        minus = up & h
        if plus & high:
            score += 1
        elif minus & high:
            score -= 1
        plus = (plus << 1) & full
        minus = (minus << 1) & full
        up = minus | (full & ~(v | plus))
        down = plus & v
        if score < best:
            best, end = score, at
    return best, end


class Items:
    """Pieces of a block of test items in one automaton."""

    def __init__(self, items: list[tuple[int, str]], rate: float):
        self.texts: dict[str, list[int]] = {}
        for number, text in items:
            if text:
                self.texts.setdefault(text, []).append(number)
        short = [t for t in self.texts if len(t) < SHORT_ITEM]
        self.long = [(t, int(len(t) * rate), masks(t)) for t in self.texts if len(t) >= SHORT_ITEM]
        pieces: dict[str, list[tuple[int, int]]] = {}
        for k, (text, budget, _) in enumerate(self.long):
            cuts = [len(text) * i // (budget + 1) for i in range(budget + 2)]
            for a, b in zip(cuts, cuts[1:]):
                pieces.setdefault(text[a:b], []).append((k, a))
        # A short item with its borders; texts are searched with a space at either end.
        words = {f" {t} ": t for t in short}
        self.automaton = ahocorasick.Automaton()
        for piece in pieces.keys() | words.keys():
            self.automaton.add_word(piece, (len(piece), pieces.get(piece, []), words.get(piece)))
        self.some = bool(pieces or words)
        if self.some:
            self.automaton.make_automaton()

    def matches(self, text: str) -> list[tuple[int, int, int]]:
        """(item_id, distance, end) of every item within its budget."""
        out = []
        spans: dict[int, list[tuple[int, int]]] = {}
        if self.some:
            ends: dict[str, int] = {}
            for last, (size, where, word) in self.automaton.iter(f" {text} "):
                if word is not None:
                    ends.setdefault(word, last - 1)
                for k, offset in where:
                    item, budget, _ = self.long[k]
                    begin = last - size - offset
                    spans.setdefault(k, []).append((max(0, begin - budget), begin + len(item) + budget))
            out += [(number, 0, end) for word, end in ends.items() for number in self.texts[word]]
        for k, found in spans.items():
            item, budget, mask = self.long[k]
            found.sort()
            best = (budget + 1, 0)
            at, to = found[0]
            for a, b in [*found[1:], (len(text) + len(item) * 9, 0)]:
                if a <= to:
                    to = max(to, b)
                    continue
                distance, end = best_end(mask, len(item), text[at:to])
                best = min(best, (distance, at + end))
                at, to = a, b
            if best[0] <= budget:
                out += [(number, *best) for number in self.texts[item]]
        return out


def blocks_of(items: DataFrame, size: int = BLOCK_ITEMS, most: int = BLOCK_BYTES) -> Iterator[list[tuple[int, str]]]:
    """The normalised test items in blocks of at most ``size`` items and ``most`` bytes, one item at least.

    Rows without id or text are left out. Texts are normalised by tasks.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for s in textual.slices(batches):
            data = [t.encode("latin-1") for t in plain(s.column("text"))]
            yield pa.RecordBatch.from_arrays([s.column("item_id"), pa.array(data, pa.binary())], ["item_id", "data"])

    rows = items.select("item_id", "text").where("item_id is not null and text is not null").dropDuplicates(["item_id", "text"])
    kind = rows.schema["item_id"].dataType.simpleString()
    held: list[tuple[int, str]] = []
    weight = 0
    for row in rows.mapInArrow(run, f"item_id {kind}, data binary").toLocalIterator():
        if held and (len(held) == size or weight + len(row.data) > most):
            yield held
            held, weight = [], 0
        held.append((row.item_id, bytes(row.data).decode("latin-1")))
        weight += len(row.data)
    if held:
        yield held


def match(docs: DataFrame, items: DataFrame, rate: float = RATE) -> DataFrame:
    """doc_id, item_id, distance, end: each test item that a row of ``docs`` holds within its edit budget.

    ``distance`` is the least over the text and ``end`` the byte of the normalised text
    where such a part first ends. Null and empty texts hold nothing. A pair of document
    row and item gives one row; an item_id with several texts may give several.
    """
    spark = docs.sparkSession
    wanted = docs.select("doc_id", "text")
    kind = wanted.schema["doc_id"].dataType.simpleString()
    item_kind = items.schema["item_id"].dataType
    item_type = to_arrow_type(item_kind)
    schema = f"doc_id {kind}, item_id {item_kind.simpleString()}, distance int, end bigint"
    out = spark.createDataFrame([], schema)
    for block in blocks_of(items):
        shared = spark.sparkContext.broadcast(block)  # at most BLOCK_ITEMS items and BLOCK_BYTES

        def run(batches: Iterator[pa.RecordBatch], shared=shared) -> Iterator[pa.RecordBatch]:
            index = Items(shared.value, rate)
            for s in textual.slices(batches):
                rows = [(r, *m) for r, text in enumerate(plain(s.column("text"))) if text for m in index.matches(text)]
                if rows:
                    row, item, distance, end = zip(*rows)
                    yield pa.RecordBatch.from_arrays(
                        [s.column("doc_id").take(pa.array(row)), pa.array(item, item_type), pa.array(distance, pa.int32()), pa.array(end, pa.int64())],
                        ["doc_id", "item_id", "distance", "end"],
                    )

        out = out.unionByName(wanted.mapInArrow(run, schema))
    return out


def clean(docs: DataFrame, items: DataFrame, rate: float = RATE) -> DataFrame:
    """The rows of ``docs``, all columns, that hold no test item."""
    out = docs
    for block in blocks_of(items):
        shared = docs.sparkSession.sparkContext.broadcast(block)

        def run(batches: Iterator[pa.RecordBatch], shared=shared) -> Iterator[pa.RecordBatch]:
            index = Items(shared.value, rate)
            for s in textual.slices(batches):
                yield s.filter(pa.array([not (text and index.matches(text)) for text in plain(s.column("text"))], pa.bool_()))

        out = out.mapInArrow(run, docs.schema)
    return out
