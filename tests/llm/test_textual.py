from __future__ import annotations

import re

import numpy as np
import pyarrow as pa
from hypothesis import given, settings
from hypothesis import strategies as st

from tristrata.llm import textual

TEXTS = st.lists(st.one_of(st.none(), st.text(alphabet="aAbB é\t\n\x0b\x1c.", max_size=30)), max_size=8)


def plain_words(text):
    lower = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
    return re.findall("[^\x20\x09-\x0d]+", (text or "").translate(lower))


@given(TEXTS)
@settings(max_examples=150, deadline=None)
def test_words_and_shingles_follow_the_definition(texts):
    words = textual.words_of(pa.array(texts, pa.string()))
    expected = [plain_words(t) for t in texts]
    assert words.counts.tolist() == [len(w) for w in expected]
    named: dict[str, int] = {}
    for word, value in zip((w for ws in expected for w in ws), words.hashes().tolist()):
        assert named.setdefault(word, value) == value
    assert len(set(named.values())) == len(named)
    of, _ = textual.shingles(words.hashes(), words.counts, 3)
    sets = [{tuple(w[i : i + 3]) for i in range(max(1, len(w) - 2))} if w else set() for w in expected]
    assert np.bincount(of, minlength=len(texts)).tolist() == [len(s) for s in sets]


def test_slices_keep_every_row_and_cut_by_bytes():
    batch = pa.record_batch({"text": ["x" * n for n in (0, 10, 5, 50, 1, 0)]})
    parts = list(textual.slices(iter([batch]), most=16))
    assert [t for p in parts for t in p.column("text").to_pylist()] == batch.column("text").to_pylist()
    assert max(p.num_rows for p in parts) > 1 and len(parts) > 2


def test_prefix_hash_names_the_stem():
    words = textual.words_of(pa.array(["lowering lowest low lower"]))
    stems = words.hashes(4)
    assert stems[0] == stems[1] == stems[3] != stems[2]
