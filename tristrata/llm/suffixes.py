"""Removal of repeated byte strings by merging shard Burrows-Wheeler transforms.

Bytes are first read as phrases: of every ``window`` neighbouring grams the one with the
least hash is an anchor, so equal strings have equal anchors inside, and the text from one
anchor to the next is one symbol. A 400-byte string holds several.

1. Sieve. Every 400-byte string has an anchor within its first ``window`` bytes, so at
   least ``core`` bytes follow it. Documents without an anchor whose ``core`` bytes stand
   twice lose nothing and are done. The others form shards of bounded size.
2. Each shard sorts the suffixes of its phrase sequences once and keeps their
   Burrows-Wheeler transform with its mapping from a suffix to the one before.
3. Merge. The interleave of all shards is held as blocks of suffixes with a common prefix,
   named by hashes. A shard refines the names of its suffixes one phrase at a time along its
   transform; only counts per block and shard travel, and no suffix is sorted again. Blocks
   of one suffix are resolved. A block of two or more whose common prefix spans a phrase and
   400 bytes is a repeated interval: every 400-byte string that starts in that phrase is
   repeated.
4. Where a repeated interval begins or ends inside a phrase, the block does not say at
   which byte. There the 400-byte strings themselves are counted by name, 96 bits wide.

Work on a block is a count per shard, so a passage that a third of all documents share is
one row per shard and never gathered.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..shared import materialize
from . import textual
from .jaccard import _marked, bitmap

LENGTH = 400
SHARD_BYTES = 1 << 19
#: What a mark for a shard holds: proven starts from a to b, a core with unproven starts at distances a to b, a repeated string (a: its check).
PROVEN, OPEN, START = 0, 1, 2

_BASE = np.uint64(0x9E3779B97F4A7C15)
_INVERSE = np.uint64(pow(0x9E3779B97F4A7C15, -1, 1 << 64))
_OTHER = np.uint64(0xD6E8FEB86659FD93)
_NEVER = np.uint64(0xFFFFFFFFFFFFFFFF)
_KINDS = {"core": np.uint64(0x51ED270B), "half": np.uint64(0x2545F491), "interval": np.uint64(0x9FB21C65)}


@dataclass(frozen=True)
class Shape:
    """Sizes that follow from the length of a repeat."""

    length: int

    @property
    def gram(self) -> int:
        return 16 if self.length >= 64 else 1 << max((self.length // 4).bit_length() - 1, 0)

    @property
    def window(self) -> int:
        """A power of two, at most a third of the grams of a repeat."""
        return 1 << (max((self.length - self.gram + 1) // 3, 1).bit_length() - 1)

    @property
    def core(self) -> int:
        """Bytes that follow the anchor of every repeat, itself included."""
        return self.length - self.window + 1

    @property
    def half(self) -> int:
        """The same for repeats that start at most half a window before their anchor."""
        return self.length - self.window // 2


_POWERS: dict[int, np.ndarray] = {}


def _powers(n: int, step: np.uint64) -> np.ndarray:
    """step ** 0 .. step ** n; kept for the next shard unless a very long text asks for many."""
    held = _POWERS.get(int(step))
    if held is None or len(held) <= n:
        out = np.full(max(n, SHARD_BYTES) + 1, step, dtype=np.uint64)
        out[0] = 1
        held = np.cumprod(out, dtype=np.uint64)
        if n <= 2 * SHARD_BYTES:
            _POWERS[int(step)] = held
    return held[: n + 1]


def _slide(x: np.ndarray, n: int, best) -> np.ndarray:
    """``best`` of x[i : i + n] for every i that has as many; n is a power of two."""
    k = 1
    while k < n:
        x = best(x[: len(x) - k], x[k:])
        k *= 2
    return x


@dataclass
class Prints:
    """Hashes of a run of texts: grams, anchors, and names of any substring."""

    shape: Shape
    raw: np.ndarray
    offsets: np.ndarray
    gram: np.ndarray = field(init=False)  # hash of the gram at each byte, odd; _NEVER where the text ends before
    low: np.ndarray = field(init=False)  # least gram hash of the window at each byte, 0 where the text ends before
    anchors: np.ndarray = field(init=False)
    end: np.ndarray = field(init=False)  # end of the text that holds each byte

    def __post_init__(self) -> None:
        n, k, w = len(self.raw), self.shape.gram, self.shape.window
        self.end = np.repeat(self.offsets[1:], np.diff(self.offsets))
        left = self.end - np.arange(n)
        h, size, step = self.raw.astype(np.uint64) + np.uint64(1), 1, _BASE
        with np.errstate(over="ignore"):
            while size < k:
                h = h[: max(len(h) - size, 0)] * step + h[size:]
                size, step = size * 2, step * step
        self.gram = np.full(n, _NEVER)
        self.gram[: len(h)] = textual.mix(h) | np.uint64(1)
        self.gram[left < k] = _NEVER
        self.low = _slide(np.concatenate([self.gram, np.full(w - 1, _NEVER)]), w, np.minimum)
        self.low[left < k + w - 1] = 0
        self.anchors = np.flatnonzero(_slide(np.concatenate([np.zeros(w - 1, np.uint64), self.low]), w, np.maximum) == self.gram)
        value = np.where(self.gram == _NEVER, np.uint64(0), self.gram)
        self._sums = [self._cumulated(value, _BASE)]
        self._value = value

    def _cumulated(self, value: np.ndarray, step: np.uint64) -> np.ndarray:
        return np.concatenate([np.zeros(1, np.uint64), np.cumsum(value * _powers(len(value), step)[:-1], dtype=np.uint64)])

    def names(self, at: np.ndarray, size, other: bool = False) -> np.ndarray:
        """Name of the ``size`` bytes from each place, at least one gram long and within one text."""
        step, inverse = (_OTHER, np.uint64(pow(int(_OTHER), -1, 1 << 64))) if other else (_BASE, _INVERSE)
        if other and len(self._sums) < 2:
            self._sums.append(self._cumulated(self._value, _OTHER))
        sums = self._sums[int(other)]
        size = np.asarray(size, dtype=np.int64)
        part = sums[at + size - self.shape.gram + 1] - sums[at]
        return textual.mix(part * _powers(len(self.raw), inverse)[at] + size.astype(np.uint64) * _OTHER)


def _named(kind: str, name: np.ndarray) -> np.ndarray:
    return textual.mix(name ^ _KINDS[kind]).view(np.int64)


def core_names(p: Prints) -> np.ndarray:
    """Name of the core of each anchor; 0 where the text ends before."""
    room = p.end[p.anchors] - p.anchors >= p.shape.core
    out = np.zeros(len(p.anchors), dtype=np.int64)
    out[room] = _named("core", p.names(p.anchors[room], p.shape.core))
    return out


def sieve_keys(docs: DataFrame, shape: Shape) -> DataFrame:
    """(key) of the cores that stand at two places or more."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for s in textual.slices(batches, most=SHARD_BYTES):
            p = Prints(shape, *textual.raw_bytes(s.column("text")))
            key, n = np.unique(core_names(p), return_counts=True)
            yield pa.RecordBatch.from_arrays([pa.array(key), pa.array(np.minimum(n, 2).astype(np.int8))], ["key", "n"])

    found = docs.select("text").mapInArrow(run, "key bigint, n tinyint")
    return found.where("key <> 0").groupBy("key").agg(F.sum("n").alias("n")).where("n > 1").select("key")


#: Turns of a key's bits that give the places it is marked at: few texts are kept by chance.
TURNS = (0, 17, 31, 47)


def _turned(keys: DataFrame) -> DataFrame:
    turn = lambda n: F.shiftleft("key", n).bitwiseOR(F.shiftrightunsigned("key", 64 - n)) if n else F.col("key")
    return keys.select(F.explode(F.array(*[turn(n) for n in TURNS])).alias("key"))


def _likely(bits: np.ndarray, key: np.ndarray) -> np.ndarray:
    """Whether each key is marked at all its places: true for every key that was."""
    bare = key.view(np.uint64)
    out = np.ones(len(key), dtype=bool)
    for n in TURNS:
        turned = (bare << np.uint64(n)) | (bare >> np.uint64(64 - n)) if n else bare
        out[out] = _marked(bits, turned[out].view(np.int64)).to_numpy(zero_copy_only=False)
    return out


@dataclass
class Transform:
    """Suffixes of a shard's phrase sequences in order, without their texts."""

    order: np.ndarray  # suffixes by their phrases
    before: np.ndarray  # the transform: phrase before each suffix of ``order`` (0: none)
    back: np.ndarray  # place in ``order`` of the suffix one phrase longer (-1: none)


def transform(phrase: np.ndarray, text: np.ndarray) -> Transform:
    """Suffix sort by doubling: ``phrase`` and number of the text of each suffix."""
    n = len(phrase)
    rank = np.unique(phrase, return_inverse=True)[1].astype(np.int64) + 1
    h = 1
    while h < n:
        there = np.minimum(np.arange(n) + h, n - 1)
        next_rank = np.where((np.arange(n) + h < n) & (text[there] == text), rank[there], 0)
        fresh = np.unique(rank * (n + 1) + next_rank, return_inverse=True)[1].astype(np.int64) + 1
        if fresh.max() == rank.max():
            break
        rank, h = fresh, h * 2
    order = np.argsort(rank, kind="stable")
    place = np.empty(n, dtype=np.int64)
    place[order] = np.arange(n)
    first = np.ones(n, dtype=bool)
    first[1:] = text[1:] != text[:-1]
    before = np.where(first[order], np.uint64(0), phrase[order - 1])
    return Transform(order, before, np.where(first[order], -1, place[order - 1]))


def refined(t: Transform, depth: np.ndarray) -> np.ndarray:
    """Name of the first ``depth`` phrases of each suffix (0: no such prefix).

    One step of the interleave: the suffix one phrase longer takes the name of its rest,
    with the transform's phrase in front.
    """
    n = len(t.order)
    out = np.zeros(n, dtype=np.uint64)
    name = np.full(n, _BASE, dtype=np.uint64)  # by place in the order, of the empty prefix
    ready = np.ones(n, dtype=bool)
    wanted = depth[t.order]
    goes = t.back >= 0
    # The last phrase of a text has no suffix behind it that could hand a name on: it starts from the empty prefix.
    for step in range(1, int(depth.max(initial=0)) + 1):
        fresh, live = np.zeros(n, dtype=np.uint64), np.zeros(n, dtype=bool)
        move = goes & ready
        fresh[t.back[move]] = textual.mix(name[move] * _OTHER + t.before[move])
        live[t.back[move]] = True
        name, ready = fresh, live
        here = ready & (wanted == step)
        out[t.order[here]] = name[here]
        if not (wanted > step).any():
            break
    return out


def shard_row(s: pa.RecordBatch, p: Prints, number: int) -> pa.RecordBatch:
    """One shard: its documents, anchors, and names of blocks.

    Phrases also begin and end with the text, so that copies of a whole text share all of
    them; the end itself is one more, empty, phrase.
    """
    shape = p.shape
    begins = p.offsets[:-1][np.diff(p.offsets) > 0]
    at = np.unique(np.concatenate([p.anchors, begins]))
    text = np.searchsorted(p.offsets, at, "right") - 1
    last = np.concatenate([text[1:] != text[:-1], [True]])
    stop = np.append(at[1:], 0)
    stop[last] = p.offsets[text[last] + 1]
    size = stop - at
    phrase = _short_names(p.raw, at, size)
    phrase[last] = textual.mix(phrase[last] ^ np.uint64(7))  # the end of the text belongs to it
    # An empty phrase after each text: the names of its last phrase are handed on from there.
    closing = np.flatnonzero(last) + 1
    t = transform(np.insert(phrase, closing, np.uint64(1)), np.insert(text, closing, text[last]))
    real = np.insert(np.ones(len(at), dtype=bool), closing, False)
    # Phrases of an interval: through the first anchor a phrase and LENGTH bytes ahead, or the end of the text.
    reach = np.minimum(stop + shape.length, p.offsets[text + 1])
    upto = np.searchsorted(at, reach)
    of_text = np.searchsorted(at, p.offsets[text + 1])
    upto = np.minimum(upto, of_text)
    depth = np.where(p.offsets[text + 1] - at >= shape.length, upto - np.arange(len(at)), 0)
    asked = np.zeros(len(real), dtype=np.int64)
    asked[real] = depth
    name = refined(t, asked)[real]
    close = np.append(at, len(p.raw))[upto]
    close = np.where(upto == of_text, p.offsets[text + 1], close)
    is_anchor = np.isin(at, p.anchors)
    core, half = np.zeros(len(at), dtype=np.int64), np.zeros(len(at), dtype=np.int64)
    core[is_anchor] = core_names(p)
    room = is_anchor & (p.offsets[text + 1] - at >= shape.half)
    half[room] = _named("half", p.names(at[room], shape.half))
    interval = np.where(name > 0, _named("interval", name), 0)
    whole = lambda x, t=None: pa.ListArray.from_arrays(pa.array([0, len(x)], pa.int32()), pa.array(x, t))
    values = [pa.array([number], pa.int64()), whole(s.column("doc_id")), whole(p.offsets, pa.int64()), pa.array([p.raw.tobytes()], pa.binary())]
    lists = {"at": at, "close": close, "core": core, "half": half, "interval": interval}
    return pa.RecordBatch.from_arrays([*values, *[whole(lists[c], t) for c, t in SHARD_LISTS.items()]], SHARD_COLUMNS)


def _short_names(raw: np.ndarray, at: np.ndarray, size: np.ndarray) -> np.ndarray:
    """Names of phrases that together cover all of ``raw``, of any length."""
    if not len(at):
        return np.zeros(0, dtype=np.uint64)
    place = np.arange(len(raw)) - np.repeat(at, size)
    terms = (textual.mix(raw.astype(np.uint64) + np.uint64(1))) * _powers(int(size.max()), _BASE)[place]
    return textual.mix(np.add.reduceat(terms, at) + size.astype(np.uint64))


SHARD_LISTS = {"at": pa.int32(), "close": pa.int32(), "core": pa.int64(), "half": pa.int64(), "interval": pa.int64()}
SHARD_COLUMNS = ["shard", "docs", "offsets", "raw", *SHARD_LISTS]


def shard_table(docs: DataFrame, shape: Shape, bits: np.ndarray) -> DataFrame:
    """Shards of the documents that the sieve leaves, and the results of all others (``shard`` null)."""
    kind = docs.schema["doc_id"].dataType.simpleString()
    shared = docs.sparkSession.sparkContext.broadcast(bits)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        number = TaskContext.get().partitionId() << 32
        held: list[pa.RecordBatch] = []
        size, kinds = 0, None

        def close() -> pa.RecordBatch:
            nonlocal number
            together = pa.Table.from_batches(held).combine_chunks().to_batches()[0]
            number += 1
            row = shard_row(together, Prints(shape, *textual.raw_bytes(together.column("text"))), number)
            return pa.RecordBatch.from_arrays([*row.columns, pa.nulls(1, together.column("doc_id").type), *[pa.nulls(1, t) for t in RESULT_TYPES]], names)

        names = [*SHARD_COLUMNS, "doc_id", *RESULT_COLUMNS]
        for s in textual.slices(batches, most=SHARD_BYTES):
            p = Prints(shape, *textual.raw_bytes(s.column("text")))
            core = core_names(p)
            hit = core != 0
            hit[hit] = _likely(shared.value, core[hit])
            left = np.zeros(s.num_rows, dtype=bool)
            left[np.searchsorted(p.offsets, p.anchors[hit], "right") - 1] = True
            done = s.filter(pa.array(~left))
            kinds = kinds or [pa.int64(), pa.list_(s.schema.field("doc_id").type), pa.list_(pa.int64()), pa.binary(), *[pa.list_(t) for t in SHARD_LISTS.values()]]
            if done.num_rows:
                yield pa.RecordBatch.from_arrays(
                    [*[pa.nulls(done.num_rows, t) for t in kinds], done.column("doc_id"), *results(done.column("text"), None, shape)], names
                )
            if left.any():
                held.append(s.filter(pa.array(left)))
                size += textual.raw_bytes(held[-1].column("text"))[0].size
            if size >= SHARD_BYTES:
                yield close()
                held, size = [], 0
        if held:
            yield close()

    arrays = ", ".join(f"{c} array<{'int' if t == pa.int32() else 'bigint'}>" for c, t in SHARD_LISTS.items())
    return docs.select("doc_id", "text").mapInArrow(
        run, f"shard bigint, docs array<{kind}>, offsets array<bigint>, raw binary, {arrays}, doc_id {kind}, {RESULT_DDL}"
    )


RESULT_COLUMNS = ["n_bytes", "n_removed", "n_spans", "kept_sha256", "kept"]
RESULT_TYPES = [pa.int64(), pa.int64(), pa.int64(), pa.string(), pa.binary()]
RESULT_DDL = "n_bytes bigint, n_removed bigint, n_spans bigint, kept_sha256 string, kept binary"


def results(texts: pa.Array, starts: np.ndarray | None, shape: Shape) -> list[pa.Array]:
    """The columns of RESULT_COLUMNS of each text; ``starts`` marks where a repeat begins."""
    raw, offsets = textual.raw_bytes(texts)
    rows = []
    gone = np.zeros(len(raw) + 1, dtype=np.int32)
    if starts is not None:
        at = np.flatnonzero(starts)
        np.add.at(gone, at, 1)
        np.add.at(gone, at + shape.length, -1)
    gone = np.cumsum(gone[:-1]) > 0
    for a, b in zip(offsets[:-1], offsets[1:]):
        lost = gone[a:b]
        kept = raw[a:b][~lost].tobytes()
        spans = int(lost[0]) + int((lost[1:] & ~lost[:-1]).sum()) if b > a else 0
        rows.append((int(b - a), int(lost.sum()), spans, hashlib.sha256(kept).hexdigest(), kept if lost.any() else None))
    return [pa.array([r[i] for r in rows], t) for i, t in enumerate(RESULT_TYPES)]


def _list(row: pa.Table, column: str) -> np.ndarray:
    return row.column(column).combine_chunks().flatten().to_numpy(zero_copy_only=False)


def _held(names: pa.Table) -> np.ndarray:
    return names.column("name").to_numpy() if names.num_rows else np.zeros(0, dtype=np.int64)


def _blocks(rows: DataFrame) -> DataFrame:
    """(name, shard) of the rows (name, shard, n) whose name counts two or more over all shards."""
    total = F.sum("n").over(Window.partitionBy("name"))
    return rows.withColumn("total", total).where("total > 1").select("name", "shard")


def _counted(shard: int, *names: np.ndarray) -> pa.Table:
    name, n = np.unique(np.concatenate(names), return_counts=True)
    keep = name != 0
    return pa.table({"name": pa.array(name[keep]), "shard": pa.array(np.full(int(keep.sum()), shard)), "n": pa.array(n[keep], pa.int64())})


def _covered(row: pa.Table, held: np.ndarray, n: int, length: int) -> np.ndarray:
    """Starts that the repeated intervals prove."""
    at, close, interval = (_list(row, c) for c in ("at", "close", "interval"))
    size = np.diff(np.append(at, n))
    out = np.zeros(n + 1, dtype=np.int32)
    yes = (interval != 0) & np.isin(interval, held)
    upto = np.minimum(at + size, close - length)  # last start whose string lies in the interval
    yes &= upto >= at
    np.add.at(out, at[yes], 1)
    np.add.at(out, upto[yes] + 1, -1)
    return np.cumsum(out[:-1]) > 0


def repeats(docs: DataFrame, length: int = LENGTH) -> DataFrame:
    """doc_id, n_bytes, n_removed, n_spans, kept_sha256 and kept of every row of ``docs`` (doc_id, text).

    Every byte covered by a string of ``length`` bytes that starts at two places or more
    goes; places count over all rows, rows that repeat one another included, and a match
    lies within one text. ``kept`` holds the bytes left where any is lost, else null. A null
    or empty text has no bytes. Phrases and blocks are named by 64-bit hashes of their
    bytes, strings at the edges of intervals by 96 bits.
    """
    shape = Shape(length)
    bits = bitmap(_turned(sieve_keys(docs, shape)))
    kind = docs.schema["doc_id"].dataType.simpleString()
    table = materialize(shard_table(docs, shape, bits), "shards")
    shards = table.where("shard is not null")

    def coarse(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for i in range(batch.num_rows):
                row = pa.Table.from_batches([batch.slice(i, 1)])
                yield from _counted(row.column("shard")[0].as_py(), _list(row, "core"), _list(row, "half")).to_batches()

    # First round of the merge: blocks by the bytes that every repeat has behind its anchor.
    coarse_blocks = materialize(_blocks(shards.select("shard", "core", "half").mapInArrow(coarse, "name bigint, shard bigint, n bigint")), "blocks")

    def fine(row: pa.Table, names: pa.Table) -> pa.Table:
        if not row.num_rows or not names.num_rows:
            return _counted(0, np.zeros(0, dtype=np.int64))
        live = np.isin(_list(row, "core"), _held(names))
        # A text's first phrase may be no anchor: it lives if the next one does.
        live[:-1] |= live[1:]
        return _counted(row.column("shard")[0].as_py(), _list(row, "interval")[live])

    # Second round: of the suffixes in such blocks, those that share whole intervals.
    narrow = shards.select("shard", "core", "interval")
    rounds = narrow.groupBy("shard").cogroup(coarse_blocks.groupBy("shard")).applyInArrow(fine, "name bigint, shard bigint, n bigint")
    blocks = coarse_blocks.union(materialize(_blocks(rounds), "blocks"))
    mark_fields = {"name": pa.int64(), "shard": pa.int64(), "a": pa.int32(), "b": pa.int32(), "kind": pa.int32()}

    def judged(row: pa.Table, names: pa.Table) -> pa.Table:
        """Proven starts, and the cores in blocks with the distances at which starts before them are not proven (a > b: none)."""
        if not row.num_rows or not names.num_rows:
            return pa.table({k: pa.array([], t) for k, t in mark_fields.items()})
        number = row.column("shard")[0].as_py()
        held, at, offsets, core = _held(names), _list(row, "at").astype(np.int64), _list(row, "offsets"), _list(row, "core")
        n = int(offsets[-1])
        sure = np.append(_covered(row, held, n, length), False)
        edges = np.flatnonzero(np.diff(np.concatenate([[0], sure.astype(np.int8)])))
        begins, ends = edges[::2], edges[1::2] - 1
        ahead = np.minimum.accumulate(np.where(sure, n + 1, np.arange(n + 1))[::-1])[::-1]
        sure[n] = True
        behind = np.maximum.accumulate(np.where(sure, -1, np.arange(n + 1)))
        text = np.searchsorted(offsets, at, "right") - 1
        live = np.isin(core, held) & (core != 0)
        # Starts close before an anchor need more bytes behind it.
        wide = np.isin(_list(row, "half")[live], held)
        at, text, core = at[live], text[live], core[live]
        first, last = np.maximum(at - shape.window + 1, offsets[text]), np.minimum(np.where(wide, at, at - shape.window // 2 - 1), offsets[text + 1] - length)
        some = (last >= first) & (ahead[np.minimum(first, n)] <= last)
        name, of = np.unique(core, return_inverse=True)
        near, far = np.full(len(name), shape.window), np.full(len(name), -1)
        np.minimum.at(near, of[some], (at - behind[np.maximum(last, 0)])[some])
        np.maximum.at(far, of[some], (at - ahead[np.minimum(first, n)])[some])
        count = len(begins) + len(name)
        values = [
            np.concatenate([np.zeros(len(begins), np.int64), name]), np.full(count, number), np.concatenate([begins, near]), np.concatenate([ends, far]),
            np.repeat([PROVEN, OPEN], [len(begins), len(name)]),
        ]
        return pa.table({k: pa.array(v, t) for (k, t), v in zip(mark_fields.items(), values)})

    places = shards.select("shard", "offsets", "at", "close", "core", "half", "interval")
    found = places.groupBy("shard").cogroup(blocks.groupBy("shard")).applyInArrow(judged, "name bigint, shard bigint, a int, b int, kind int")
    found = materialize(found, "judged")
    # Every shard that has a core with unproven starts takes part, whether its own are proven or not.
    same = Window.partitionBy("name")
    opened = found.where(F.col("kind") == OPEN).withColumns({"near": F.min("a").over(same), "far": F.max("b").over(same)}).where("near <= far")
    marks = found.where(F.col("kind") == PROVEN).union(opened.select("name", "shard", F.col("near").alias("a"), F.col("far").alias("b"), "kind"))

    def edge_starts(row: pa.Table, marks: pa.Table) -> tuple[Prints, np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
        """Proven starts, and the starts to be counted with their names."""
        offsets = _list(row, "offsets")
        p = Prints(shape, np.frombuffer(row.column("raw")[0].as_py(), dtype=np.uint8), offsets)
        n = len(p.raw)
        kinds, a, b = (marks.column(c).to_numpy() for c in ("kind", "a", "b"))
        proven = np.zeros(n + 1, dtype=np.int32)
        np.add.at(proven, a[kinds == PROVEN], 1)
        np.add.at(proven, b[kinds == PROVEN] + 1, -1)
        sure = np.cumsum(proven[:-1]) > 0
        opened = marks.column("name").to_numpy()[kinds == OPEN]
        order = np.argsort(opened)
        near, far = a[kinds == OPEN][order], b[kinds == OPEN][order]
        opened = opened[order]
        core = core_names(p)
        number = np.minimum(np.searchsorted(opened, core), max(len(opened) - 1, 0))
        live = (opened[number] == core) & (core != 0) if len(opened) else np.zeros(len(core), dtype=bool)
        at = p.anchors[live]
        nearest, farthest = (x[number[live]].astype(np.int64) for x in (near, far))
        # Starts that an open core may belong to, and their anchor: the leftmost least gram of the window.
        some = np.zeros(n + 1, dtype=np.int32)
        np.add.at(some, np.maximum(at - farthest, 0), 1)
        np.add.at(some, at - nearest + 1, -1)
        start = np.flatnonzero((np.cumsum(some[:-1]) > 0) & (p.end - np.arange(n) >= length))
        anchor = np.searchsorted(p.anchors, start)
        wrong = p.gram[p.anchors[anchor]] != p.low[start]
        while wrong.any():
            anchor[wrong] += 1
            wrong = p.gram[p.anchors[anchor]] != p.low[start]
        place = np.cumsum(live) - 1
        mine = live[anchor]
        start, of = start[mine], place[anchor[mine]]
        distance = at[of] - start
        keep = (distance >= nearest[of]) & (distance <= farthest[of])
        start = start[keep]
        name = p.names(start, length).view(np.int64)
        check = (p.names(start, length, other=True) >> np.uint64(32)).astype(np.uint32).view(np.int32)
        return p, sure, start, name, check

    def emit(row: pa.Table, marks: pa.Table) -> pa.Table:
        fields = {"name": pa.int64(), "check": pa.int32(), "shard": pa.int64(), "n": pa.int8(), "asks": pa.bool_()}
        if not row.num_rows or not marks.num_rows:
            return pa.table({k: pa.array([], t) for k, t in fields.items()})
        _, sure, start, name, check = edge_starts(row, marks)
        order = np.lexsort((check, name))
        name, check, asks = name[order], check[order], ~sure[start[order]]
        new = np.ones(len(name), dtype=bool)
        new[1:] = (name[1:] != name[:-1]) | (check[1:] != check[:-1])
        first = np.flatnonzero(new)
        n = np.diff(np.append(first, len(name)))
        asked = np.logical_or.reduceat(asks, first) if len(first) else asks
        values = [name[new], check[new], np.full(len(first), row.column("shard")[0].as_py()), np.minimum(n, 2).astype(np.int8), asked]
        return pa.table({k: pa.array(v, t) for (k, t), v in zip(fields.items(), values)})

    with_text = shards.select("shard", "docs", "offsets", "raw").groupBy("shard")
    strings = with_text.cogroup(marks.groupBy("shard")).applyInArrow(emit, "name bigint, check int, shard bigint, n tinyint, asks boolean")
    total = F.sum("n").over(Window.partitionBy("name", "check"))
    twice = strings.withColumn("total", total).where("total > 1 and asks")
    twice = twice.select("name", "shard", F.col("check").alias("a"), F.lit(0).alias("b"), F.lit(START).alias("kind"))

    def finish(row: pa.Table, marks: pa.Table) -> pa.Table:
        if not row.num_rows:
            return pa.table({"doc_id": pa.array([], doc_type), **{c: pa.array([], t) for c, t in zip(RESULT_COLUMNS, RESULT_TYPES)}})
        p, sure, start, name, check = edge_starts(row, marks)
        asked = marks.column("kind").to_numpy() == START
        pairs = np.empty(int(asked.sum()), dtype=[("name", "<i8"), ("check", "<i4")])
        pairs["name"], pairs["check"] = marks.column("name").to_numpy()[asked], marks.column("a").to_numpy()[asked]
        mine = np.empty(len(name), dtype=pairs.dtype)
        mine["name"], mine["check"] = name, check
        pairs = pairs[np.lexsort((pairs["check"], pairs["name"]))]
        at = np.searchsorted(pairs["name"], name)
        hit = np.zeros(len(name), dtype=bool)
        while len(pairs):  # names that differ in the check only follow one another
            there = np.minimum(at, len(pairs) - 1)
            same = (at < len(pairs)) & (pairs["name"][there] == name)
            hit |= same & (pairs["check"][there] == check)
            if not (same & ~hit).any():
                break
            at = at + 1
        sure[start[hit]] = True
        texts = pa.LargeBinaryArray.from_buffers(
            pa.large_binary(), len(p.offsets) - 1, [None, pa.py_buffer(p.offsets.astype(np.int64).tobytes()), pa.py_buffer(p.raw.tobytes())]
        )
        out = results(texts, sure, shape)
        return pa.table({"doc_id": row.column("docs").combine_chunks().flatten(), **dict(zip(RESULT_COLUMNS, out))})

    doc_type = pa.schema([pa.field("x", _arrow_type(docs, "doc_id"))])[0].type
    # Both passes over the shards read one exchange of their texts.
    cut = with_text.cogroup(marks.union(twice).groupBy("shard")).applyInArrow(finish, f"doc_id {kind}, {RESULT_DDL}")
    return table.where("shard is null").select("doc_id", *RESULT_COLUMNS).unionByName(cut)


def _arrow_type(df: DataFrame, column: str) -> pa.DataType:
    from pyspark.sql.pandas.types import to_arrow_type

    return to_arrow_type(df.schema[column].dataType)
