"""Spelling variants against all pairs."""

from __future__ import annotations

import random
import re
import zlib
from collections import Counter

from tristrata.llm import spelling

LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def one_edit(a, b):
    if a == b or abs(len(a) - len(b)) > 1:
        return False
    if len(a) == len(b):
        return sum(x != y for x, y in zip(a, b)) == 1
    a, b = sorted((a, b), key=len)
    return any(a == b[:i] + b[i + 1 :] for i in range(len(b)))


def plain(rows):
    n = Counter()
    for doc_id, text in rows:
        for run in re.findall("[A-Za-zÀ-ÿ]+", text or ""):
            run = run.translate(LOWER)
            h = zlib.crc32(f"{'' if doc_id is None else doc_id}:{run}".encode())
            n[run[: h % len(run)] + run[h % len(run) + 1 :] if h % 199 == 0 else run] += 1
    words = {w: c for w, c in n.items() if len(w) >= 6 and c >= 5}
    near = {w: [o for o in words if one_edit(w, o)] for w in words}
    form = {}
    for w, c in words.items():
        best = min(near[w], key=lambda o: (-words[o], o), default=None)
        form[w] = best if best is not None and words[best] >= 5 * c else None
    out = []
    for w, c in words.items():
        root = w
        while form[root]:
            root = form[root]
        out.append((w, form[w], root, c, len(near[w]), form[w] and words[form[w]]))
    return out


def same(docs):
    rows = [(r.doc_id, r.text) for r in docs.select("doc_id", "text").collect()]
    got = spelling.variants(spelling.word_counts(docs))
    assert got.columns == ["word", "form", "root", "n", "n_near", "form_n"]
    got = [tuple(r) for r in got.collect()]
    assert sorted(map(str, got)) == sorted(map(str, plain(rows)))
    return got


def test_variants_equal_all_pairs(docs_of, monkeypatch):
    monkeypatch.setattr(spelling, "BATCH_LETTERS", 300)
    rng = random.Random(4)
    letters = "abcdefgéèÉÀ×÷ÿ"
    base = ["".join(rng.choice(letters) for _ in range(rng.randint(6, 11))) for _ in range(40)] + ["colours", "aaaaaa", "aaaaaaa"]
    words = []
    for w in base:
        words += [w] * rng.choice([30, 150, 900])
        for _ in range(4):
            i, c = rng.randrange(len(w) + 1), rng.choice(letters)
            v = rng.choice([w[:i] + c + w[i:], w[:i] + w[i + 1 :], w[:i] + c + w[i + 1 :]])
            words += [v] * rng.choice([5, 6, 30])
            if rng.random() < 0.3:
                words += [v[1:] + "z"] * 5
    rng.shuffle(words)
    rows = [(i, " ".join(w.upper() if rng.random() < 0.2 else w for w in words[i::50]) + ". x1y2") for i in range(50)]
    got = same(docs_of(rows))
    assert sum(r[1] is not None for r in got) > 20 and any(r[2] != r[1] for r in got if r[1])


def test_odd_rows(odd, none, docs_of):
    same(odd)
    assert spelling.variants(spelling.word_counts(none)).count() == 0
    long = "ab" * 3000
    same(docs_of([(i, f"{long} {long}x repeated REPEATED repeatet") for i in range(9)] + [(None, "repeated " * 60)]))


def test_neighbourhood_holds_every_edit():
    word = "kitten"
    for other in ("kiten", "kittens", "akitten", "kittan", "kitxten", "itten"):
        a, b = spelling.Reduced([word], 3), spelling.Reduced([other], 3)
        assert b.names()[0] in a.neighbourhood()[1] and a.names()[0] in b.neighbourhood()[1]
