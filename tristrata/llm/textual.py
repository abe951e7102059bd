"""Whole texts as arrays: words of an Arrow batch without a Python loop per word.

A word is a run of bytes outside space, tab, line feed, vertical tab, form feed and
carriage return, with A-Z lower-cased. Words are named by 64-bit hashes.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa

SPACE = np.zeros(256, dtype=bool)
SPACE[[0x20, 0x09, 0x0A, 0x0B, 0x0C, 0x0D]] = True
LOWER = np.arange(256, dtype=np.uint8)
LOWER[ord("A") : ord("Z") + 1] += 32

_STEP = np.uint64(0x9E3779B97F4A7C15)
_MIX1 = np.uint64(0xBF58476D1CE4E5B9)
_MIX2 = np.uint64(0x94D049BB133111EB)

SLICE_BYTES = 2 << 20


def mix(x: np.ndarray) -> np.ndarray:
    """A 64-bit finaliser: every input bit reaches every output bit."""
    x = (x ^ (x >> np.uint64(30))) * _MIX1
    x = (x ^ (x >> np.uint64(27))) * _MIX2
    return x ^ (x >> np.uint64(31))


def powers(n: int) -> np.ndarray:
    out = np.full(n, _STEP, dtype=np.uint64)
    return np.cumprod(out, dtype=np.uint64)


@dataclass
class Words:
    """Words of a batch of texts: bytes run together, one span per word."""

    letters: np.ndarray  # lower-cased bytes of all words, run together
    ends: np.ndarray  # end of each word in letters
    lengths: np.ndarray  # bytes per word
    counts: np.ndarray  # words per text
    raw: np.ndarray  # bytes of all texts
    offsets: np.ndarray  # start of each text in raw, and the end

    @property
    def texts(self) -> np.ndarray:
        """Number of the text that holds each word."""
        return np.repeat(np.arange(len(self.counts)), self.counts)

    def hashes(self, limit: int | None = None) -> np.ndarray:
        """64-bit hash of each word, or of its first ``limit`` bytes."""
        if not len(self.ends):
            return np.zeros(0, dtype=np.uint64)
        starts = self.ends - self.lengths
        place = np.arange(len(self.letters)) - np.repeat(starts, self.lengths)
        terms = (self.letters.astype(np.uint64) + np.uint64(1)) * powers(int(self.lengths.max()))[place]
        lengths = self.lengths
        if limit is not None:
            terms[place >= limit] = 0
            lengths = np.minimum(lengths, limit)
        return mix(np.add.reduceat(terms, starts) + lengths.astype(np.uint64) * _MIX1)


def raw_bytes(texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """Bytes of all texts run together and their offsets; a null text is empty."""
    if isinstance(texts, pa.ChunkedArray):
        texts = texts.combine_chunks()
    if texts.null_count:
        texts = texts.fill_null("" if pa.types.is_string(texts.type) or pa.types.is_large_string(texts.type) else b"")
    texts = texts.cast(pa.large_string() if "string" in str(texts.type) else pa.large_binary())
    if not len(texts):
        return np.zeros(0, dtype=np.uint8), np.zeros(1, dtype=np.int64)
    _, where, data = texts.buffers()
    offsets = np.frombuffer(where, dtype=np.int64)[texts.offset : texts.offset + len(texts) + 1]
    if data is None or offsets[-1] == offsets[0]:
        return np.zeros(0, dtype=np.uint8), np.zeros(len(texts) + 1, dtype=np.int64)
    return np.frombuffer(data, dtype=np.uint8)[offsets[0] : offsets[-1]], offsets - offsets[0]


def words_of(texts: pa.Array) -> Words:
    raw, offsets = raw_bytes(texts)
    n = len(raw)
    inside = ~SPACE[raw]
    first = np.zeros(n + 1, dtype=bool)
    first[offsets] = True
    begins, closes = inside.copy(), inside.copy()
    begins[1:] &= ~inside[:-1] | first[1:n]
    closes[:-1] &= ~inside[1:] | first[1:n]
    starts, stops = np.flatnonzero(begins), np.flatnonzero(closes) + 1
    lengths = stops - starts
    counts = np.diff(np.searchsorted(starts, offsets))
    return Words(LOWER[raw[inside]], np.cumsum(lengths), lengths, counts, raw, offsets)


def slices(batches: Iterator[pa.RecordBatch], column: str = "text", most: int = SLICE_BYTES) -> Iterator[pa.RecordBatch]:
    """Cut batches so that a slice holds about ``most`` bytes of text, one row at least."""
    for batch in batches:
        if not batch.num_rows:
            continue
        _, offsets = raw_bytes(batch.column(column))
        at = 0
        while at < batch.num_rows:
            to = max(at + 1, int(np.searchsorted(offsets, offsets[at] + most, "right")) - 1)
            yield batch.slice(at, to - at)
            at = to


def shingles(words: np.ndarray, counts: np.ndarray, width: int) -> tuple[np.ndarray, np.ndarray]:
    """Distinct shingle hashes of each text, ordered by text and hash: (text, hash).

    A text with fewer words than ``width`` has its whole sequence as one shingle, a text
    without words has none.
    """
    ends = np.cumsum(counts)
    text = np.repeat(np.arange(len(counts)), counts)
    have = ends[text] - np.arange(len(words))  # words from here to the end of the text
    whole = have >= width
    seed = np.zeros(len(words), dtype=np.uint64)
    for k in range(width):
        there = np.minimum(np.arange(len(words)) + k, max(len(words) - 1, 0))
        seed = np.where(have > k, mix(seed * _STEP + words[there] + np.uint64(k + 1)), seed) if len(words) else seed
    first = np.zeros(len(words), dtype=bool)
    first[(ends - counts)[counts > 0]] = True
    keep = whole | (first & (counts[text] < width))
    text, seed = text[keep], seed[keep]
    order = np.lexsort((seed, text))
    text, seed = text[order], seed[order]
    new = np.ones(len(text), dtype=bool)
    new[1:] = (text[1:] != text[:-1]) | (seed[1:] != seed[:-1])
    return text[new], seed[new]
