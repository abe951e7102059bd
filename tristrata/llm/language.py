"""Language identification by cross-parsing.

For each language a suffix automaton of labelled text accepts exactly the strings that
occur in it. A text is cut, from the left, into the longest phrases that the automaton
knows; the language that needs the fewest phrases, weighted by the bits that name a place
in its text, wins. A text is read in windows of WINDOW bytes, each parsed from its start;
all windows of a block advance together, one byte per step.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..shared import materialize
from . import learning, textual

WINDOW = 1024
SAMPLE_BYTES = 32_768
SAMPLE_DOCS = 64
UNDETERMINED = "und"

_LETTER = np.zeros(256, dtype=bool)
_LETTER[ord("a") : ord("z") + 1] = True
_LETTER[128:] = True


def letters_of(texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """Lower-cased bytes of the letters of all texts, runs of anything else as one space; and offsets."""
    raw, offsets = textual.raw_bytes(pc.utf8_lower(texts.cast(pa.large_string())))
    n = len(raw)
    letter = _LETTER[raw]
    first = np.zeros(n + 1, dtype=bool)
    first[offsets] = True
    # A space stands after a letter only, never at the start of a text.
    space = ~letter
    space[1:] &= letter[:-1]
    space &= ~first[:n]
    keep = letter | space
    stream = np.where(letter, raw, np.uint8(32))[keep]
    count = np.concatenate([[0], np.cumsum(keep)])
    return stream, count[offsets]


def automaton(text: bytes) -> list[dict[int, int]]:
    """Transitions of the suffix automaton of ``text``; state 0 is the start."""
    step: list[dict[int, int]] = [{}]
    link, length = [-1], [0]
    last = 0
    for c in text:
        now = len(step)
        step.append({})
        length.append(length[last] + 1)
        link.append(0)
        p = last
        while p >= 0 and c not in step[p]:
            step[p][c] = now
            p = link[p]
        if p >= 0:
            q = step[p][c]
            if length[p] + 1 == length[q]:
                link[now] = q
            else:
                twin = len(step)
                step.append(dict(step[q]))
                length.append(length[p] + 1)
                link.append(link[q])
                while p >= 0 and step[p].get(c) == q:
                    step[p][c] = twin
                    p = link[p]
                link[q] = link[now] = twin
        last = now
    return step


class Parser:
    """Automata of all languages in one table; an entry is a premultiplied next state, negative if a phrase ends."""

    def __init__(self, samples: dict[str, bytes]):
        self.names = sorted(samples)
        self.bits = np.array([np.log2(max(len(samples[x]), 2)) for x in self.names])
        used = sorted({b for x in samples.values() for b in x})
        self.code = np.zeros(256, dtype=np.int64)
        self.code[used] = np.arange(1, len(used) + 1)
        width = len(used) + 1
        tables, self.start, base = [], [], 0
        for name in self.names:
            steps = automaton(samples[name])
            table = np.full((len(steps), width), -1, dtype=np.int64)
            state = np.repeat(np.arange(len(steps)), [len(s) for s in steps])
            byte = np.fromiter((c for s in steps for c in s), dtype=np.int64)
            to = np.fromiter((t for s in steps for t in s.values()), dtype=np.int64)
            table[state, self.code[byte]] = (to + base) * width
            # A byte without a way on ends the phrase and begins the next one.
            again = np.where(table[0] < 0, base * width, table[0])
            table = np.where(table < 0, ~again, table)
            tables.append(table.astype(np.int32 if (base + len(steps)) * width < 2**31 else np.int64))
            self.start.append(base * width)
            base += len(steps)
        self.table = np.concatenate(tables).ravel() if tables else np.zeros(0, dtype=np.int32)

    def phrases(self, stream: np.ndarray, offsets: np.ndarray) -> np.ndarray:
        """Phrases of each text by language: the cuts, and one for what is left at the end of a window."""
        sizes = np.diff(offsets)
        windows = -(-sizes // WINDOW)
        text = np.repeat(np.arange(len(sizes)), windows)
        nth = np.arange(len(text)) - np.repeat(np.cumsum(windows) - windows, windows)
        begin = offsets[:-1][text] + nth * WINDOW
        length = np.minimum(WINDOW, sizes[text] - nth * WINDOW)
        order = np.argsort(-length, kind="stable")
        begin, length, text = begin[order], length[order], text[order]
        active = np.searchsorted(-length, -np.arange(1, (length[0] if len(length) else 0) + 1), "right")
        codes = self.code[stream].astype(self.table.dtype)
        state = np.repeat(np.array(self.start, dtype=self.table.dtype)[:, None], len(begin), axis=1)
        count = np.zeros(state.shape, dtype=np.int32)
        for t, k in enumerate(active.tolist()):
            c = codes[begin[:k] + t]
            for i in range(len(self.names)):
                to = self.table[state[i, :k] + c]
                ended = to < 0
                count[i, :k] += ended
                np.bitwise_xor(to, -ended.astype(to.dtype), out=to)
                state[i, :k] = to
        out = np.zeros((len(sizes), len(self.names)), dtype=np.int64)
        for i in range(len(self.names)):
            out[:, i] = np.bincount(text, count[i] + 1, len(sizes))
        return out

    def predict(self, texts: pa.Array) -> tuple[list[str], np.ndarray]:
        """Language and score: the share of the winner when each language weighs 2^(-bits/16)."""
        spoken = pc.fill_null(pc.match_substring_regex(texts.cast(pa.large_string()), r"\p{L}"), False).to_numpy(zero_copy_only=False)
        if not self.names:
            return [UNDETERMINED] * len(texts), np.zeros(len(texts))
        cost = self.phrases(*letters_of(texts)) * self.bits
        best = cost.argmin(axis=1)
        share = 1 / np.exp2(-(cost - cost.min(axis=1, keepdims=True)) / 16).sum(axis=1)
        return [self.names[b] if s else UNDETERMINED for b, s in zip(best, spoken)], np.where(spoken, share, 0.0)


_PARSERS: dict[str, Parser] = {}


def parser_of(samples: dict[str, bytes]) -> Parser:
    """The parser of these samples, built once per worker."""
    key = hashlib.sha256(repr(sorted(samples.items())).encode()).hexdigest()
    if key not in _PARSERS:
        _PARSERS.clear()
        _PARSERS[key] = Parser(samples)
    return _PARSERS[key]


def train(docs: DataFrame, keep, docs_each: int = SAMPLE_DOCS, bytes_each: int = SAMPLE_BYTES) -> dict[str, bytes]:
    """Labelled text of each language: whole documents in hash order, ``docs_each`` and ``bytes_each`` at most.

    A language whose sampled documents are all longer than ``bytes_each`` is learned
    from that many bytes of one of them. Rows without language or text are left out.
    """
    known = docs.select("doc_id", "text", "lang").where(
        F.col("lang").isNotNull() & F.col("text").rlike(r"\p{L}") & keep
    )
    order = Window.partitionBy("lang").orderBy("spread", "doc_id")
    ids = (
        known.select("doc_id", "lang", F.xxhash64("doc_id").alias("spread"))
        .withColumn("rank", F.row_number().over(order))
        .where(F.col("rank") <= docs_each)
        .select("doc_id", "lang", "rank")
    )
    # Written, so that the planner sees how few they are and does not move texts.
    ids = materialize(ids, "language-samples")
    sample = known.join(ids, ["doc_id", "lang"]).groupBy("doc_id", "lang", "rank").agg(F.min("text").alias("text"))

    def fit(table: pa.Table) -> dict[str, bytes]:
        out: dict[str, bytes] = {}
        held: dict[str, list[bytes]] = {}
        table = table.sort_by([("lang", "ascending"), ("rank", "ascending"), ("doc_id", "ascending")])
        stream, offsets = letters_of(table.column("text").combine_chunks())
        for k, lang in enumerate(table.column("lang").to_pylist()):
            text = stream[offsets[k] : offsets[k + 1]].tobytes()
            out.setdefault(lang, text[:bytes_each])
            taken = held.setdefault(lang, [])
            if text not in taken and sum(map(len, taken)) + len(text) <= bytes_each:
                taken.append(text)
        return {lang: b" ".join(held[lang]) or text for lang, text in out.items()}

    return learning.fit_in_task(sample, fit) or {}


def identify(docs: DataFrame, samples: dict[str, bytes]) -> DataFrame:
    """doc_id, lang_pred, score of every row; ``und`` with score 0 where a text is null or has no letter."""
    shared = docs.sparkSession.sparkContext.broadcast(samples)  # at most SAMPLE_BYTES a language

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        parser = parser_of(shared.value)
        for s in textual.slices(batches):
            lang, score = parser.predict(s.column("text"))
            yield pa.RecordBatch.from_arrays(
                [s.column("doc_id"), pa.array(lang, pa.string()), pa.array(score)], ["doc_id", "lang_pred", "score"]
            )

    wanted = docs.select("doc_id", "text")
    return wanted.mapInArrow(run, f"doc_id {wanted.schema['doc_id'].dataType.simpleString()}, lang_pred string, score double")


def classify(docs: DataFrame, parts: int = 4, held: int = 2) -> DataFrame:
    """doc_id, held_out, lang_pred, score; languages are learned outside the held-out fold only."""
    samples = train(docs, ~learning.in_fold(F.col("doc_id"), parts, held))
    return identify(docs, samples).select(
        "doc_id", learning.in_fold(F.col("doc_id"), parts, held).alias("held_out"), "lang_pred", "score"
    )
