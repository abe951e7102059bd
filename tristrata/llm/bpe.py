"""Byte-level BPE by merge replay over a block of texts.

The distinct pieces of a block form one corpus. An inverted index leads from the rank of a
pair to the places of that pair in the corpus; the lowest rank of the index is applied
place by place, and only the pairs beside a merge are looked up anew and filed again.
Nothing is trained here.
"""

from __future__ import annotations

import base64
import re
from array import array
from collections.abc import Iterator
from dataclasses import dataclass
from functools import lru_cache
from heapq import heappop, heappush

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from . import textual

#: Bytes of pieces and ids that a worker remembers of earlier blocks.
KEPT_BYTES = 24 << 20
#: What a remembered piece takes besides its letters and ids.
PIECE_COST = 150
#: Ids of pieces met before by this worker, and their bytes, of each vocabulary.
_KNOWN: dict[tuple[str, str], tuple[dict[str, bytes], list[int]]] = {}
SLICE_BYTES = 1 << 20
#: From so many places on, a rank is applied to all of them in one step.
MANY = 24
#: A rank that no pair has.
NO_MERGE = (1 << 31) - 1


@dataclass
class Merges:
    """Ranks of a vocabulary: two neighbours merge if their bytes together are a token."""

    ranks: dict[bytes, int]
    names: list[bytes]
    keys: np.ndarray  # left * size + right of every mergeable pair, ascending
    made: np.ndarray  # the id that the pair of each key becomes
    safe: np.ndarray  # no pair with this id has a lower rank than the id
    single: np.ndarray  # the id of each byte

    def look_up(self, left: np.ndarray, right: np.ndarray) -> np.ndarray:
        key = left.astype(np.int64) * len(self.names) + right
        at = np.minimum(np.searchsorted(self.keys, key), len(self.keys) - 1)
        return np.where(self.keys[at] == key, self.made[at], NO_MERGE)


def merges_of(ranks: dict[bytes, int]) -> Merges:
    names = [b""] * (max(ranks.values(), default=-1) + 1)
    for token, rank in ranks.items():
        names[rank] = token
    left, right, made = [], [], []
    for token, rank in ranks.items():
        for cut in range(1, len(token)):
            a, b = ranks.get(token[:cut]), ranks.get(token[cut:])
            if a is not None and b is not None:
                left.append(a)
                right.append(b)
                made.append(rank)
    left, right, made = (np.array(x, dtype=np.int64) for x in (left, right, made))
    safe = np.ones(len(names) + 1, dtype=bool)
    safe[left[made <= left]] = False
    safe[right[made <= right]] = False
    keys = left * len(names) + right
    order = np.argsort(keys)
    if not len(order):
        keys, made, order = np.array([-1]), np.array([0]), np.array([0])
    single = np.array([ranks.get(bytes([b]), -1) for b in range(256)], dtype=np.int32)
    return Merges(ranks, names, keys[order], made[order].astype(np.int32), safe, single)


@lru_cache(maxsize=4)
def load(path: str) -> Merges:
    """Merges of a ``.tiktoken`` rank file."""
    with open(path, "rb") as lines:
        return merges_of({base64.b64decode(a): int(b) for a, b in map(bytes.split, lines)})


def replay(pieces: list[bytes], m: Merges) -> tuple[np.ndarray, np.ndarray]:
    """Ids of all pieces run together, and the end of each piece.

    Every piece sees its lowest rank first, leftmost among equals. A piece that is a
    token itself is that token. Time grows as n log n, also in one unbroken piece.
    """
    whole = [m.ranks.get(p, -1) for p in pieces]
    work = [i for i, p in enumerate(pieces) if p and whole[i] < 0]
    corpus = np.frombuffer(b"".join(pieces[i] for i in work), dtype=np.uint8)
    ends = np.cumsum([len(pieces[i]) for i in work], dtype=np.int64)
    symbols = m.single[corpus]
    if len(symbols) and symbols.min() < 0:
        raise ValueError("a byte of the text has no id of its own")
    ranks = np.full(len(corpus), NO_MERGE, dtype=np.int32)
    ranks[:-1] = m.look_up(symbols[:-1], symbols[1:])
    ranks[ends - 1] = NO_MERGE
    merged = merge_in_order(symbols, ranks, ends, m)
    alive = np.flatnonzero(merged >= 0)
    cuts = np.searchsorted(alive, np.concatenate([[0], ends]))
    lengths = np.array([int(w >= 0) for w in whole], dtype=np.int64)
    lengths[work] = np.diff(cuts)
    stops = np.cumsum(lengths)
    ids = np.empty(int(lengths.sum()), dtype="<u4")
    tokens = np.flatnonzero(np.array(whole, dtype=np.int64) >= 0)
    ids[stops[tokens] - 1] = np.array(whole, dtype=np.int64)[tokens]
    shift = np.repeat((stops - lengths)[work] - cuts[:-1], np.diff(cuts))
    ids[np.arange(len(alive)) + shift] = merged[alive]
    return ids, stops


def merge_in_order(symbols: np.ndarray, ranks: np.ndarray, ends: np.ndarray, m: Merges) -> np.ndarray:
    """The symbols after all merges, at the place of their first byte; -1 elsewhere.

    ``ranks`` holds the rank of the pair that begins at each place. The index leads from a
    rank to its places, a heap each, and the lowest rank of the index is applied: at all its
    places in one step if they are many and no pair that this makes ranks lower, else at the
    leftmost place. Only the two pairs beside a merge get new ranks; a place
    whose pair changed since it was filed is passed over.
    """
    count, names, find = len(symbols), m.names, m.ranks.get
    before, after = np.arange(-1, count - 1), np.arange(1, count + 1)
    before[np.append(0, ends)[: len(ends)]] = -1
    after[ends - 1] = -1
    # Numbers are read one by one from the arrays and many at once from the views on them.
    symbol, rank = array("i", symbols.tobytes()), array("i", ranks.tobytes())
    before, after = array("q", before.tobytes()), array("q", after.tobytes())
    symbols, ranks = np.frombuffer(symbol, dtype=np.int32), np.frombuffer(rank, dtype=np.int32)
    befores, afters = np.frombuffer(before, dtype=np.int64), np.frombuffer(after, dtype=np.int64)

    filed = np.argsort(ranks, kind="stable")[: np.count_nonzero(ranks < NO_MERGE)]
    waiting, starts = np.unique(ranks[filed], return_index=True)
    waiting = waiting.tolist()
    index = {r: x.tolist() for r, x in zip(waiting, np.split(filed, starts[1:]))}

    def file(places: list[int], made: list[int]) -> None:
        for place, new in zip(places, made):
            if new in index:
                heappush(index[new], place)
            else:
                index[new] = [place]
                heappush(waiting, new)

    single_steps = set()
    while waiting:
        low = waiting[0]
        places = index[low]
        if not places:
            del index[heappop(waiting)]
            continue
        if len(places) >= MANY and low not in single_steps:
            at = np.sort(np.array(places))
            at = at[ranks[at] == low]
            at = every_second(at[np.diff(at, prepend=-1) > 0], afters)
            gone = afters[at]
            right = afters[gone]
            inner = right >= 0
            left = befores[at]
            if not m.safe[low] and lowest_beside(low, symbols[left[left >= 0]], symbols[right[inner]], m) < low:
                single_steps.add(low)
                continue
            places.clear()
            symbols[at], symbols[gone], ranks[gone], ranks[at], afters[at] = low, -1, NO_MERGE, NO_MERGE, right
            befores[right[inner]] = at[inner]
            left = befores[at]
            touched = np.concatenate([at[inner], left[left >= 0]])
            new = m.look_up(symbols[touched], symbols[afters[touched]])
            ranks[touched] = new
            found = new < NO_MERGE
            file(touched[found].tolist(), new[found].tolist())
            continue
        at = heappop(places)
        if rank[at] != low:
            continue
        gone = after[at]
        left, right = before[at], after[gone]
        symbol[at], symbol[gone], rank[gone], rank[at], after[at] = low, -1, NO_MERGE, NO_MERGE, right
        if right >= 0:
            before[right] = at
            rank[at] = new = find(names[low] + names[symbol[right]], NO_MERGE)
            if new < NO_MERGE:
                file((at,), (new,))
        if left >= 0:
            rank[left] = new = find(names[symbol[left]] + names[low], NO_MERGE)
            if new < NO_MERGE:
                file((left,), (new,))
    return symbols


def lowest_beside(low: int, left: np.ndarray, right: np.ndarray, m: Merges) -> int:
    """The lowest rank that ``low`` has with itself, behind ``left`` or before ``right``."""
    one = np.array([low])
    beside = (m.look_up(left, one), m.look_up(one, right), m.look_up(one, one))
    return min(int(x.min(initial=NO_MERGE)) for x in beside)


def every_second(at: np.ndarray, after: np.ndarray) -> np.ndarray:
    """Ascending places without those whose left symbol is taken: every second one of a run of neighbours, from the left."""
    fresh = np.concatenate([[True], at[1:] != after[at[:-1]]]) if len(at) else np.ones(0, dtype=bool)
    run = np.flatnonzero(fresh)
    return at[(np.arange(len(at)) - np.repeat(run, np.diff(np.append(run, len(at))))) % 2 == 0]


def ascii_form(pattern: str) -> str | None:
    """The same pattern for ASCII texts in the faster standard matcher, or None if it has other classes."""
    if re.search(r"\\[pP]\{(?![LN]\})|\\[wWdDbBXR]|\(\?[^:!=]|\[\[", pattern):
        return None

    def inside(found: re.Match) -> str:
        return found[0].replace(r"\p{L}", "A-Za-z").replace(r"\p{N}", "0-9")

    classes = re.sub(r"\[(?:\\.|[^\]\\])*\]", inside, pattern)
    return classes.replace(r"\p{L}", "[A-Za-z]").replace(r"\p{N}", "[0-9]")


def splitter(pattern: str):
    """The pieces of a text: all matches of ``pattern``."""
    general = regex.compile(pattern).findall
    simple = ascii_form(pattern)
    if simple is None:
        return general
    quick = re.compile(simple, re.ASCII).findall
    return lambda text: quick(text) if text.isascii() else general(text)


def _encoder(path: str, pattern: str):
    """A function from texts to their ids as little-endian 32-bit integers run together.

    Pieces of earlier blocks are remembered up to KEPT_BYTES, which changes no result.
    """
    merges = load(path)
    find = splitter(pattern)
    known, held = _KNOWN.setdefault((path, pattern), ({}, [0]))

    def ids_of(texts: list[str | None]) -> list[bytes]:
        rows = [find(t) if t else [] for t in texts]
        new = list(set().union(*rows).difference(known))
        if held[0] > KEPT_BYTES:
            known.clear()
            held[0] = 0
            new = list(set().union(*rows))
        if new:
            ids, ends = replay([p.encode() for p in new], merges)
            flat, ends = ids.tobytes(), (ends * 4).tolist()
            known.update((p, flat[a:b]) for p, a, b in zip(new, [0, *ends], ends))
            held[0] += len(flat) + sum(map(len, new)) + PIECE_COST * len(new)
        return [b"".join(map(known.__getitem__, r)) for r in rows]

    return ids_of


@lru_cache(maxsize=4)
def names_of(path: str) -> list[bytes]:
    """The bytes of each id of a rank file, without its merges."""
    with open(path, "rb") as lines:
        ranks = {int(b): base64.b64decode(a) for a, b in map(bytes.split, lines)}
    return [ranks.get(i, b"") for i in range(max(ranks, default=-1) + 1)]


def _decoded(ids: bytes | None, names: list[bytes]) -> bytes:
    return b"".join(map(names.__getitem__, np.frombuffer(ids or b"", "<u4").tolist()))


def encode(docs: DataFrame, path: str, pattern: str, key: str = "doc_id", back: bool = False) -> DataFrame:
    """Key, n_tokens and ids (little-endian 32-bit integers run together) of each row.

    Each match of ``pattern`` is encoded separately; a null text is empty. ``path`` is a
    rank file that every executor has. ``back`` adds ``decoded``, the bytes that the ids
    stand for, in the same worker.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        ids_of, names = _encoder(path, pattern), load(path).names
        for s in textual.slices(batches, "text", SLICE_BYTES):
            ids = ids_of(s.column("text").to_pylist())
            columns = {key: s.column(key), "n_tokens": pa.array([len(x) // 4 for x in ids], pa.int64()), "ids": pa.array(ids, pa.binary())}
            if back:
                columns["decoded"] = pa.array([_decoded(x, names) for x in ids], pa.binary())
            yield pa.RecordBatch.from_pydict(columns)

    wanted = docs.select(key, "text")
    schema = f"{key} {wanted.schema[key].dataType.simpleString()}, n_tokens bigint, ids binary" + (", decoded binary" if back else "")
    return wanted.mapInArrow(run, schema)


def decode(encoded: DataFrame, path: str, key: str = "doc_id") -> DataFrame:
    """The rows of ``encode`` with the bytes that their ids stand for (null ids: empty)."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        names = names_of(path)
        for s in textual.slices(batches, "ids", SLICE_BYTES):
            back = [_decoded(x, names) for x in s.column("ids").to_pylist()]
            yield pa.RecordBatch.from_arrays([*s.columns, pa.array(back, pa.binary())], [*s.schema.names, "decoded"])

    wanted = encoded.select(key, "n_tokens", "ids")
    kind = wanted.schema[key].dataType.simpleString()
    return wanted.mapInArrow(run, f"{key} {kind}, n_tokens bigint, ids binary, decoded binary")


def digests(docs: DataFrame, path: str, pattern: str) -> DataFrame:
    """doc_id, n_tokens, ids_sha256, decoded_sha256: encoded, then decoded from the ids, by one worker per task."""
    back = encode(docs, path, pattern, back=True)
    return back.select(
        "doc_id", "n_tokens", F.sha2("ids", 256).alias("ids_sha256"), F.sha2("decoded", 256).alias("decoded_sha256")
    )
