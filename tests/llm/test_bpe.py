from __future__ import annotations

import hashlib
import random
import struct
import time

import public_tokenizers
import pytest
import tiktoken
from conftest import ODD_TEXTS
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st

from tristrata.llm import bpe

PATH = public_tokenizers.path("byte_bpe_50k.tiktoken")


@pytest.fixture(scope="module")
def reference():
    return tiktoken.Encoding("own", pat_str=public_tokenizers.PATTERN, mergeable_ranks=bpe.load(PATH).ranks, special_tokens={})


@given(st.lists(st.text(alphabet=st.one_of(st.characters(codec="utf-8"), st.sampled_from("aab e'st\n 1é")), max_size=40), max_size=12))
@settings(max_examples=150, deadline=None)
def test_ids_equal_the_tokenizer_library(reference, texts):
    find = bpe.splitter(public_tokenizers.PATTERN)
    for text in texts:
        pieces = find(text)
        ids, ends = bpe.replay([p.encode() for p in pieces], bpe.load(PATH))
        assert ids.tolist() == reference.encode_ordinary(text)
        assert len(ends) == len(pieces)


def test_a_merge_may_bring_up_a_lower_rank():
    ranks = {bytes([b]): b for b in range(256)} | {b"abc": 256, b"bc": 257, b"abcb": 258, b"cb": 259}
    m = bpe.merges_of(ranks)
    small = tiktoken.Encoding("small", pat_str=r"[\s\S]+", mergeable_ranks=ranks, special_tokens={})
    assert not m.safe[257]
    for text in ("abcbcb", "bcbcabcb", "abcabcbcbc", "cbabcbabcbc" * 9):
        assert bpe.replay([text.encode()], m)[0].tolist() == small.encode_ordinary(text)


def test_long_pieces(reference):
    for text in ("a" * 5000, "ab" * 3000, " " * 700, "é" * 900):
        for piece in bpe.splitter(public_tokenizers.PATTERN)(text):
            assert bpe.replay([piece.encode()], bpe.load(PATH))[0].tolist() == reference.encode_ordinary(piece)


def test_one_long_piece_of_varied_letters(reference):
    draw = random.Random(5)
    piece = "".join(draw.choice("etaoinshrdlué") for _ in range(60_000))
    started = time.process_time()
    ids, ends = bpe.replay([piece.encode(), b"", b" the", piece[:999].encode()], bpe.load(PATH))
    assert time.process_time() - started < 5
    first = reference.encode_ordinary(piece)
    assert ids.tolist() == first + reference.encode_ordinary(" the") + reference.encode_ordinary(piece[:999])
    assert ends.tolist()[:3] == [len(first), len(first), len(first) + 1]


@given(st.lists(st.text(alphabet="abc", max_size=30).map(str.encode), max_size=9), st.lists(st.text(alphabet="abc", min_size=2, max_size=4).map(str.encode), unique=True, max_size=14), st.sampled_from([1, 3, 24]))
@settings(max_examples=300, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
def test_any_ranks_whether_in_one_step_or_place_by_place(monkeypatch, pieces, tokens, many):
    monkeypatch.setattr(bpe, "MANY", many)
    ranks = {bytes([b]): b for b in range(256)} | {t: 256 + i for i, t in enumerate(tokens)}
    expected = []
    for piece in pieces:
        parts = [piece] if piece in ranks else [bytes([b]) for b in piece]
        while True:
            pairs = [(ranks[a + b], i) for i, (a, b) in enumerate(zip(parts, parts[1:])) if a + b in ranks]
            if not pairs:
                break
            at = min(pairs)[1]
            parts[at : at + 2] = [parts[at] + parts[at + 1]]
        expected += [ranks[x] for x in parts]
    ids, ends = bpe.replay(pieces, bpe.merges_of(ranks))
    assert ids.tolist() == expected
    assert len(ends) == len(pieces)


def test_digests_and_round_trip(spark, odd, none, reference):
    got = bpe.digests(odd, PATH, public_tokenizers.PATTERN).collect()
    expected = []
    for doc_id, text in ODD_TEXTS:
        ids = reference.encode_ordinary(text or "")
        packed = struct.pack(f"<{len(ids)}I", *ids)
        expected.append((doc_id, len(ids), hashlib.sha256(packed).hexdigest(), hashlib.sha256((text or "").encode()).hexdigest()))
    assert sorted(map(str, (tuple(r) for r in got))) == sorted(map(str, expected))
    assert bpe.digests(none, PATH, public_tokenizers.PATTERN).count() == 0


def test_other_patterns_have_no_ascii_form():
    assert bpe.ascii_form(r"\p{Lu}+|\w") is None
    assert bpe.ascii_form(r" ?\p{L}+|[^\s\p{N}]") == r" ?[A-Za-z]+|[^\s0-9]"
