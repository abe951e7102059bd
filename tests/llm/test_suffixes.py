"""Repeated byte strings against a plain search of every string."""

from __future__ import annotations

import collections
import hashlib
import random

import pytest

from tristrata.llm import suffixes


def plain(rows, length):
    seen = collections.Counter()
    raws = [(d, (t or "").encode()) for d, t in rows]
    for _, b in raws:
        seen.update(b[i : i + length] for i in range(len(b) - length + 1))
    out = []
    for d, b in raws:
        gone = [False] * len(b)
        for i in range(len(b) - length + 1):
            if seen[b[i : i + length]] > 1:
                gone[i : i + length] = [True] * length
        kept = bytes(c for c, g in zip(b, gone) if not g)
        spans = sum(g and not before for g, before in zip(gone, [False, *gone]))
        out.append((d, len(b), sum(gone), spans, hashlib.sha256(kept).hexdigest()))
    return out


def same(docs, length):
    rows = [(r.doc_id, r.text) for r in docs.select("doc_id", "text").collect()]
    got = suffixes.repeats(docs, length)
    assert got.columns == ["doc_id", "n_bytes", "n_removed", "n_spans", "kept_sha256", "kept"]
    got = [tuple(r)[:5] for r in got.collect()]
    assert sorted(map(str, got)) == sorted(map(str, plain(rows, length)))
    return got


@pytest.mark.parametrize(("length", "shard"), [(40, 3000), (400, 6000), (7, 2 << 20)])
def test_repeats_equal_a_plain_search(docs_of, monkeypatch, length, shard):
    monkeypatch.setattr(suffixes, "SHARD_BYTES", shard)
    rng = random.Random(length)
    text = lambda n: "".join(rng.choice("abcdé \n") for _ in range(n))
    passages = [text(rng.randint(length // 2, 3 * length)) for _ in range(6)]
    rows = []
    for i in range(60):
        parts = [text(rng.randint(0, 2 * length))]
        for p in rng.sample(passages, rng.randint(0, 3)):
            cut = rng.randint(0, len(p) // 3) if rng.random() < 0.5 else 0
            parts += [p[cut:], text(rng.randint(0, 2 * length))]
        rows.append((i, "".join(parts)))
    rows += [(100, rows[3][1]), (101, rows[3][1] + "x"), (102, "y" + rows[4][1]), (103, rows[5][1][1:-1])]
    rows += [(104, "ab" * length), (105, "z" * (2 * length)), (106, "z" * length), (107, text(5) + "q" * (length + 1)), (108, "w" * (length + 1))]
    got = same(docs_of(rows), length)
    assert sum(r[2] > 0 for r in got) > 20 and (length < 40 or any(r[2] == 0 for r in got))


def test_odd_rows(odd, none):
    same(odd, 400)
    assert suffixes.repeats(none).count() == 0
    with_columns = suffixes.repeats(odd)
    assert with_columns.count() == odd.count()


def test_kept_bytes(docs_of):
    rng = random.Random(2)
    text = lambda n: "".join(rng.choice("abcdefgh ") for _ in range(n))
    shared = text(450)
    left = {r.doc_id: r for r in suffixes.repeats(docs_of([(1, "1" + shared + "3"), (2, "4" + shared + "6"), (3, text(900))])).collect()}
    assert bytes(left[1].kept) == b"13" and bytes(left[2].kept) == b"46" and left[3].kept is None and left[1].n_spans == 1


def test_refinement_follows_the_transform():
    import numpy as np

    phrase = np.array([5, 6, 7, 1, 6, 7, 5, 6, 1], dtype=np.uint64)
    text = np.array([0, 0, 0, 0, 1, 1, 1, 1, 1])
    t = suffixes.transform(phrase, text)
    tails = [(phrase[i : (4 if i < 4 else 9)]).tolist() for i in range(9)]
    assert [tails[i] for i in t.order] == sorted(tails)
    inside = [0, 1, 4, 5, 6]  # two phrases before the closing one
    two = suffixes.refined(t, np.where(np.isin(np.arange(9), inside), 2, 0))
    assert all((two[i] == two[j]) == (tails[i][:2] == tails[j][:2]) for i in inside for j in inside) and not two[[2, 3, 7, 8]].any()
