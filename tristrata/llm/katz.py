"""Katz backoff: a bigram model with Good-Turing discounts, learned and evaluated in blocks.

Texts are read once into blocks of tokens (about BLOCK_BYTES of text). What a block needs
to know it asks for once per distinct key, so a frequent key travels once per block:

1. words: buckets of word hashes count the training words of all blocks, give each word
   an id and answer every block with ids and counts;
2. pairs: buckets of (history, word) count the training pairs and answer; they also add
   up, per history, the pairs of each count and the unigram mass of its seen words;
3. weights: buckets of histories turn these sums into exactly normalised backoff weights
   and answer for the histories of held-out texts (a training text has no unseen pair).

A pair seen r times after h has d(r) r / c(h); an unseen one has weight(h) p(w), with
p(w) = d(c) c / N for a known word and the left-over mass for an unknown one. A history
with many pairs is split over buckets in proportion to its count.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..shared import scratch_path
from . import learning, textual

BLOCK_BYTES = 12 << 20
CUTOFF = 5
#: Discount of counts above the cutoff, so that every history leaves some mass.
REST = 0.05


def pack(a: np.ndarray) -> bytes:
    """Non-negative integers as byte planes without the empty high ones."""
    a = np.ascontiguousarray(a, dtype="<u8")
    width = max(1, (int(a.max()).bit_length() + 7) // 8) if len(a) else 1
    return bytes([width]) + a.view(np.uint8).reshape(-1, 8)[:, :width].T.tobytes()


def unpack(data: bytes) -> np.ndarray:
    width = data[0]
    planes = np.frombuffer(data, dtype=np.uint8, offset=1).reshape(width, -1)
    out = np.zeros((planes.shape[1], 8), dtype=np.uint8)
    out[:, :width] = planes.T
    return out.view("<u8").ravel().astype(np.int64)


def discounts(seen: np.ndarray) -> np.ndarray:
    """Katz discount of counts 0 to CUTOFF from the numbers of types seen 1 to CUTOFF + 1 times.

    The largest cutoff whose discounts lie between 0 and 1 is used; counts above it
    lose REST, as all do when no cutoff fits.
    """
    d = 1 - REST / np.maximum(np.arange(CUTOFF + 1), 1)
    n = np.concatenate([[0.0], seen.astype(float)])
    for k in range(CUTOFF, 0, -1):
        if (n[1 : k + 2] > 0).all():
            r = np.arange(1, k + 1)
            common = (k + 1) * n[k + 1] / n[1]
            if common < 1:
                found = ((r + 1) * n[r + 1] / (r * n[r]) - common) / (1 - common)
                if (found > 0).all() and (found < 1).all():
                    d[1 : k + 1] = found
                    break
    return d


def discounted(count: np.ndarray, d: np.ndarray) -> np.ndarray:
    """d(r) r for counts r."""
    small = d[np.minimum(count, CUTOFF)] * count
    return np.where(count > CUTOFF, count - REST, small)


def _write(df: DataFrame, label: str) -> DataFrame:
    path = scratch_path(df.sparkSession, label)
    df.write.option("compression", "zstd").parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def block_table(docs: DataFrame, train: Column) -> DataFrame:
    """One row per block: ids and word counts of its texts, tokens by place in its words, words, training counts."""
    kind = docs.schema["doc_id"].dataType.simpleString()
    names = ["block", "docs", "sizes", "learn", "tokens", "words", "counts"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        part, nth = TaskContext.get().partitionId(), 0
        ids, hashes, sizes, learn, held = [], [], [], [], 0

        def out() -> pa.RecordBatch:
            nonlocal nth
            size, flag, value = np.concatenate(sizes), np.concatenate(learn), np.concatenate(hashes)
            words, token, times = np.unique(value, return_inverse=True, return_counts=True)
            order = np.argsort(-times, kind="stable")
            place = np.empty(len(order), dtype=np.int64)
            place[order] = np.arange(len(order))
            token, words = place[token], words[order]
            counts = np.bincount(token[np.repeat(flag, size)], minlength=len(words))
            doc = pa.concat_arrays(ids)
            lists = pa.ListArray.from_arrays(pa.array([0, len(doc)], pa.int32()), doc)
            cell = [pa.array([x], pa.binary()) for x in (pack(size), flag.astype(np.uint8).tobytes(), pack(token), words.tobytes(), pack(counts))]
            nth += 1
            return pa.RecordBatch.from_arrays([pa.array([(part << 24) + nth], pa.int64()), lists, *cell], names)

        for s in textual.slices(batches):
            w = textual.words_of(s.column("text"))
            ids.append(s.column("doc_id"))
            hashes.append(w.hashes())
            sizes.append(w.counts)
            learn.append(s.column("learn").to_numpy(zero_copy_only=False).astype(bool))
            held += len(w.raw)
            if held > BLOCK_BYTES:
                yield out()
                ids, hashes, sizes, learn, held = [], [], [], [], 0
        if ids:
            yield out()

    wanted = docs.select("doc_id", "text", F.coalesce(train, F.lit(False)).alias("learn"))
    return wanted.mapInArrow(run, f"block bigint, docs array<{kind}>, sizes binary, learn binary, tokens binary, words binary, counts binary")


def _cut(key: np.ndarray) -> Iterator[tuple[int, np.ndarray]]:
    """Places of each bucket number, in order."""
    order = np.argsort(key, kind="stable")
    used, first = np.unique(key[order], return_index=True)
    yield from zip(used.tolist(), np.split(order, first[1:]))


WORD_REPLY = "block bigint, bucket int, ids binary, counts binary, total binary"


def word_replies(blocks: DataFrame, buckets: int) -> DataFrame:
    """Ids and training counts of the words of each block; a row without block holds a bucket's totals."""

    def ask(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for block, words, counts in zip(*(c.to_pylist() for c in batch.columns)):
                word, count = np.frombuffer(words, dtype="<u8"), unpack(counts)
                rows = [(b, block, word[at].tobytes(), pack(count[at])) for b, at in _cut((word % np.uint64(buckets)).astype(np.int64))]
                if rows:
                    yield pa.RecordBatch.from_arrays(
                        [pa.array(c, t) for c, t in zip(zip(*rows), (pa.int32(), pa.int64(), pa.binary(), pa.binary()))],
                        ["bucket", "block", "words", "counts"],
                    )

    def answer(table: pa.Table) -> pa.Table:
        bucket = table.column("bucket")[0].as_py()
        asked = [np.frombuffer(x, dtype="<u8") for x in table.column("words").to_pylist()]
        word, back = np.unique(np.concatenate(asked), return_inverse=True)
        count = np.bincount(back, np.concatenate([unpack(x) for x in table.column("counts").to_pylist()]), len(word)).astype(np.int64)
        order = np.argsort(-count, kind="stable")
        ident = np.empty(len(word), dtype=np.int64)
        ident[order] = 1 + bucket + buckets * np.arange(len(word))
        ends = np.cumsum([len(a) for a in asked])[:-1]
        ids = [pack(x) for x in np.split(ident[back], ends)] + [None]
        counts = [pack(x) for x in np.split(count[back], ends)] + [None]
        seen = np.bincount(np.minimum(count, CUTOFF + 2), minlength=CUTOFF + 3)[1 : CUTOFF + 2]
        total = np.append(seen, [(count > 0).sum(), count.sum()]).astype("<i8").tobytes()
        return pa.table({
            "block": pa.array([*table.column("block").to_pylist(), None], pa.int64()),
            "bucket": pa.array([bucket] * len(ids), pa.int32()), "ids": pa.array(ids, pa.binary()),
            "counts": pa.array(counts, pa.binary()), "total": pa.array([None] * len(asked) + [total], pa.binary()),
        })

    asked = blocks.select("block", "words", "counts").mapInArrow(ask, "bucket int, block bigint, words binary, counts binary")
    return asked.groupBy("bucket").applyInArrow(answer, WORD_REPLY)


def _totals(rows: DataFrame) -> np.ndarray:
    """Sum of the totals of all buckets: a few numbers per bucket."""
    out = np.zeros(CUTOFF + 3, dtype=np.int64)
    for row in rows.where("total is not null").select("total").toLocalIterator():
        out += np.frombuffer(bytes(row.total), dtype="<i8")
    return out


class Unigrams:
    """Counts of all training tokens, the end of a text among them (word 0)."""

    def __init__(self, totals: np.ndarray, texts: int):
        seen = totals[: CUTOFF + 1].copy()
        if 0 < texts <= CUTOFF + 1:
            seen[texts - 1] += 1
        self.texts = texts
        self.types = int(totals[CUTOFF + 1]) + (texts > 0)
        self.tokens = int(totals[CUTOFF + 2]) + texts
        self.d = discounts(seen)
        r = np.arange(1, CUTOFF + 1)
        few = seen[:CUTOFF]
        mass = (self.d[1:] * r * few).sum() + (self.tokens - (r * few).sum()) - REST * (self.types - few.sum())
        self.unknown = max(1 - mass / self.tokens, 1e-12) if self.tokens else 1.0

    def probability(self, count: np.ndarray) -> np.ndarray:
        return np.where(count > 0, discounted(count, self.d) / max(self.tokens, 1), self.unknown)


class Block:
    """A block's tokens with ids and counts, each text closed by its end."""

    def __init__(self, rows: dict[str, list], buckets: int, texts: int):
        at = rows["kind"].index(0)
        self.docs = rows["docs"][at]
        sizes = unpack(rows["sizes"][at])[: len(self.docs)]
        self.learn = np.frombuffer(rows["learn"][at], dtype=np.uint8).astype(bool)
        words = np.frombuffer(rows["words"][at], dtype="<u8")
        ids, counts = np.zeros(len(words), dtype=np.int64), np.zeros(len(words), dtype=np.int64)
        where = dict(_cut((words % np.uint64(buckets)).astype(np.int64)))
        for k, kind in enumerate(rows["kind"]):
            if kind == 1:
                ids[where[rows["bucket"][k]]] = unpack(rows["ids"][k])
                counts[where[rows["bucket"][k]]] = unpack(rows["counts"][k])
        token = unpack(rows["tokens"][at])[: sizes.sum()]
        self.text = np.repeat(np.arange(len(sizes)), sizes + 1)
        ends = np.cumsum(sizes + 1) - 1
        inner = np.ones(len(self.text), dtype=bool)
        inner[ends] = False
        self.word, self.count = np.zeros(len(inner), dtype=np.int64), np.full(len(inner), texts, dtype=np.int64)
        self.word[inner], self.count[inner] = ids[token], counts[token]
        self.history, self.history_count = np.roll(self.word, 1), np.roll(self.count, 1)
        begins = np.roll(~inner, 1)
        self.history[begins], self.history_count[begins] = 0, texts
        # Pairs that can have been seen, once each, in the order of history and word.
        known = np.flatnonzero((self.count > 0) & (self.history_count > 0))
        order = known[np.lexsort((self.word[known], self.history[known]))]
        h, w = self.history[order], self.word[order]
        new = np.ones(len(order), dtype=bool)
        new[1:] = (h[1:] != h[:-1]) | (w[1:] != w[:-1])
        self.pair = np.full(len(self.word), -1)
        self.pair[order] = np.cumsum(new) - 1
        first = order[new]
        self.pair_history, self.pair_word = self.history[first], self.word[first]
        self.pair_history_count, self.pair_word_count = self.history_count[first], self.count[first]
        self.pair_count = np.bincount(self.pair[order], self.learn[self.text[order]], len(first)).astype(np.int64)

    def pair_buckets(self, buckets: int, tokens: int) -> np.ndarray:
        """The bucket of a pair follows its history; a frequent history has several."""
        shares = 1 + 4 * buckets * self.pair_history_count // max(tokens, 1)
        turn = textual.mix(self.pair_word.astype(np.uint64)) % shares.astype(np.uint64)
        return (textual.mix(textual.mix(self.pair_history.astype(np.uint64)) + turn) % np.uint64(buckets)).astype(np.int64)

    def open_histories(self) -> np.ndarray:
        """Known histories of texts that may hold unseen pairs."""
        return np.unique(self.history[~self.learn[self.text] & (self.history_count > 0)])


ROW = "block bigint, bucket int, kind int, a binary, b binary, c binary, d binary"
COLUMNS = ("block", "bucket", "kind", "a", "b", "c", "d")
_TYPES = (pa.int64(), pa.int32(), pa.int32(), pa.binary(), pa.binary(), pa.binary(), pa.binary())


def _table(rows: list[tuple]) -> pa.Table:
    columns = zip(*rows) if rows else [[] for _ in COLUMNS]
    return pa.table([pa.array(c, t) for c, t in zip(columns, _TYPES)], list(COLUMNS))


def _gaps(h: np.ndarray) -> bytes:
    return pack(np.diff(h, prepend=0))


def answer_pairs(table: pa.Table, u: Unigrams, buckets: int) -> pa.Table:
    """Counts of the pairs of one bucket for every block that asked, sums per history, open histories passed on.

    Kinds: 2 a block's pairs and their counts, 3 histories whose weight a block wants,
    4 sums per history, 5 totals.
    """
    rows = table.select(list(COLUMNS)).to_pylist()
    bucket = rows[0]["bucket"]
    asked = [r for r in rows if r["kind"] == 2]
    out = [(r["block"], r["bucket"], 3, r["a"], None, None, None) for r in rows if r["kind"] == 3]
    total = np.zeros(CUTOFF + 3, dtype=np.int64)
    if asked:
        h = [np.cumsum(unpack(r["a"])) for r in asked]
        ends = np.cumsum([len(x) for x in h])[:-1]
        h, w, times, of_word = (np.concatenate(x) for x in (h, *([unpack(r[k]) for r in asked] for k in "bcd")))
        order = np.lexsort((w, h))
        new = np.ones(len(order), dtype=bool)
        new[1:] = (h[order][1:] != h[order][:-1]) | (w[order][1:] != w[order][:-1])
        back = np.empty(len(order), dtype=np.int64)
        back[order] = np.cumsum(new) - 1
        count = np.bincount(back, times).astype(np.int64)
        for r, mine in zip(asked, np.split(count[back], ends)):
            out.append((r["block"], bucket, 2, pack(mine), None, None, None))
        seen = count > 0
        h, of_word, count = h[order[new]][seen], of_word[order[new]][seen], count[seen]
        total[: CUTOFF + 1] = np.bincount(np.minimum(count, CUTOFF + 2), minlength=CUTOFF + 3)[1 : CUTOFF + 2]
        if len(h):
            starts = np.flatnonzero(np.concatenate([[True], h[1:] != h[:-1]]))
            group = np.repeat(np.arange(len(starts)), np.diff(np.append(starts, len(h))))
            mass = np.bincount(group, u.probability(of_word))
            shape = np.bincount(group * (CUTOFF + 2) + np.minimum(count, CUTOFF + 1), minlength=len(starts) * (CUTOFF + 2)).reshape(-1, CUTOFF + 2)
            many = np.bincount(group, np.where(count > CUTOFF, count, 0)).astype(np.int64)
            first = h[starts]
            for b, at in _cut(first % buckets):
                out.append((None, b, 4, pack(first[at]), mass[at].astype("<f8").tobytes(), pack(shape[at, 1:].T.ravel()), pack(many[at])))
    out.append((None, bucket, 5, total.astype("<i8").tobytes(), None, None, None))
    return _table(out)


def answer_weights(table: pa.Table, d: np.ndarray) -> pa.Table:
    """log10 of the backoff weights that blocks asked for."""
    rows = table.select(list(COLUMNS)).to_pylist()
    sums = [r for r in rows if r["kind"] == 4]
    if not sums:
        return _table([])
    h = np.concatenate([unpack(r["a"]) for r in sums])
    mass = np.concatenate([np.frombuffer(r["b"], dtype="<f8") for r in sums])
    shape = np.concatenate([unpack(r["c"]).reshape(CUTOFF + 1, -1) for r in sums], axis=1)
    many = np.concatenate([unpack(r["d"]) for r in sums])
    known, back = np.unique(h, return_inverse=True)
    add = lambda x: np.bincount(back, x, len(known))
    r = np.arange(1, CUTOFF + 1)[:, None]
    total = add((shape[:CUTOFF] * r).sum(axis=0) + many)
    kept = add((shape[:CUTOFF] * r * d[1:, None]).sum(axis=0) + many - REST * shape[CUTOFF])
    weight = np.log10(np.maximum(1 - kept / total, 1e-300) / np.maximum(1 - add(mass), 1e-12))
    out = []
    for row in rows:
        if row["kind"] == 3:
            wanted = np.cumsum(unpack(row["a"]))
            out.append((row["block"], row["bucket"], 3, weight[np.searchsorted(known, wanted)].astype("<f8").tobytes(), None, None, None))
    return _table(out)


def score(docs: DataFrame, train: Column) -> DataFrame:
    """doc_id, n_tokens, n_known, train_tokens, base_score, score of every row of ``docs`` (doc_id, text).

    The model learns from the rows where ``train`` holds (null: it does not). A null text
    is empty; an empty text is its end alone. ``score`` is the log10 probability of the
    text, ``base_score`` that of add-0.1 unigrams. Words are named by 64-bit hashes.
    """
    spark = docs.sparkSession
    buckets = int(spark.conf.get("spark.sql.shuffle.partitions"))
    kind = docs.schema["doc_id"].dataType.simpleString()
    texts = docs.where(F.coalesce(train, F.lit(False))).count()
    blocks = _write(block_table(docs, train), "katz-blocks")
    words = _write(word_replies(blocks, buckets), "katz-words")
    u = Unigrams(_totals(words), texts)
    empty = lambda names: [F.lit(None).cast("binary").alias(n) for n in names]
    block_columns = ["block", "docs", "sizes", "learn", "tokens", "words", "ids", "counts", "a"]
    told = blocks.select("block", F.lit(0).alias("kind"), F.lit(0).alias("bucket"), *block_columns[1:6], *empty(["ids", "counts", "a"])).unionByName(
        words.where("block is not null").select(
            "block", F.lit(1).alias("kind"), "bucket", F.lit(None).cast(f"array<{kind}>").alias("docs"), *empty(block_columns[2:6]), "ids", "counts", *empty(["a"])
        )
    )

    def ask_pairs(table: pa.Table) -> pa.Table:
        rows = table.to_pydict()
        number = rows["block"][0]
        b = Block(rows, buckets, u.texts)
        out = []
        for k, at in _cut(b.pair_buckets(buckets, u.tokens)):
            out.append((number, k, 2, _gaps(b.pair_history[at]), pack(b.pair_word[at]), pack(b.pair_count[at]), pack(b.pair_word_count[at])))
        wanted = b.open_histories()
        for k, at in _cut(wanted % buckets):
            out.append((number, k, 3, _gaps(wanted[at]), None, None, None))
        return _table(out)

    def count_pairs(table: pa.Table) -> pa.Table:
        return answer_pairs(table, u, buckets)

    pairs = _write(told.groupBy("block").applyInArrow(ask_pairs, ROW).groupBy("bucket").applyInArrow(count_pairs, ROW), "katz-pairs")
    d = discounts(_totals(pairs.where("kind = 5").select(F.col("a").alias("total")))[: CUTOFF + 1])
    weights = pairs.where("kind in (3, 4)").groupBy("bucket").applyInArrow(lambda table: answer_weights(table, d), ROW)
    replies = pairs.where("kind = 2").unionByName(weights).select(
        "block", F.when(F.col("kind") == 2, 2).otherwise(3).alias("kind"), "bucket",
        F.lit(None).cast(f"array<{kind}>").alias("docs"), *empty(block_columns[2:8]), "a",
    )

    def evaluate(table: pa.Table) -> pa.Table:
        rows = table.to_pydict()
        b = Block(rows, buckets, u.texts)
        count = np.zeros(len(b.pair_word), dtype=np.int64)
        where = dict(_cut(b.pair_buckets(buckets, u.tokens)))
        wanted = b.open_histories()
        weight = np.zeros(len(wanted))
        of_history = dict(_cut(wanted % buckets))
        for k, what in enumerate(rows["kind"]):
            if what == 2:
                count[where[rows["bucket"][k]]] = unpack(rows["a"][k])
            elif what == 3:
                weight[of_history[rows["bucket"][k]]] = np.frombuffer(rows["a"][k], dtype="<f8")
        single = np.log10(u.probability(b.count))
        times = np.where(b.pair >= 0, count[b.pair], 0) if len(count) else np.zeros(len(b.pair), dtype=np.int64)
        seen = times > 0
        value = single.copy()
        value[seen] = np.log10(discounted(times[seen], d) / b.history_count[seen])
        back = ~seen & (b.history_count > 0)
        value[back] += weight[np.searchsorted(wanted, b.history[back])]
        base = np.log10((b.count + 0.1) / (u.tokens + 0.1 * (u.types + 1)))
        n = len(b.docs)
        return pa.table({
            "doc_id": pa.array(b.docs, table.schema.field("docs").type.value_type),
            "n_tokens": pa.array(np.bincount(b.text, minlength=n), pa.int64()),
            "n_known": pa.array(np.bincount(b.text, b.count > 0, n).astype(np.int64)),
            "train_tokens": pa.array(np.full(n, u.tokens), pa.int64()),
            "base_score": pa.array(np.bincount(b.text, base, n)), "score": pa.array(np.bincount(b.text, value, n)),
        })

    return told.unionByName(replies).groupBy("block").applyInArrow(
        evaluate, f"doc_id {kind}, n_tokens bigint, n_known bigint, train_tokens bigint, base_score double, score double"
    )


def classify(docs: DataFrame, parts: int = 10, held: int = 0) -> DataFrame:
    """Scores of all rows of a model learned outside the held-out fold (a null id is not learned from)."""
    return score(docs, F.col("doc_id").isNotNull() & ~learning.in_fold(F.col("doc_id"), parts, held))
