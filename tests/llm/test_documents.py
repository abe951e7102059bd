"""Line dedup, decontamination, near copies and language model against brute force."""

from __future__ import annotations

import collections
import hashlib
import math
import random
import re
import zlib

import numpy as np
import pyarrow as pa
import pytest
from conftest import ODD_TEXTS
from pyspark.sql import functions as F

from tristrata.llm import components, decontaminate, jaccard, katz, linededup
from tristrata.llm import textual

LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def words_of(text):
    return re.findall("[^\x20\x09-\x0d]+", (text or "").translate(LOWER))


# Line dedup


def plain_dedup(rows):
    """(doc_id, text, n_lines, n_removed), rows equal in doc_id and text being one document."""
    count = lambda x: len(re.findall("[^\x20\x09-\x0d]+", x))
    chunks = {}
    for doc_id, text in rows:
        if text is None:
            continue
        lines = text.split("\n")
        h = [int(hashlib.md5(x.encode()).hexdigest()[:8], 16) for x in lines]
        out = []
        for i, x in enumerate(lines):
            before = (h[i - 2] if i > 1 else 0) * 31 + h[i - 1] if i else 0
            if i == 0 or before % 2 == 0 or count(x) >= 50 or count(lines[i - 1]) >= 50:
                out.append([])
            out[-1].append(x)
        chunks[doc_id, text] = out
    order = lambda k: (k[0] is not None, k[0] or 0)
    groups = collections.defaultdict(list)
    for key, cs in chunks.items():
        for i, c in enumerate(cs):
            groups[tuple(c)].append((order(key), textual_print(key[1]), i, key))
    again = {(key, i) for found in groups.values() for _, _, i, key in sorted(found, key=lambda f: f[:3])[1:]}
    result = []
    for doc_id, text in rows:
        if text is None:
            result.append((doc_id, None, 0, 0))
            continue
        cs = chunks[doc_id, text]
        gone, i = set(), 0
        while i < len(cs):
            run = []
            while i < len(cs) and ((doc_id, text), i) in again:
                run.append(i)
                i += 1
            lines = [x for k in run for x in cs[k]]
            total = sum(map(count, lines))
            if (sum(count(x) > 0 for x in lines) >= 2 and total >= 20) or total >= 50:
                gone.update(run)
            i += 1
        left = "\n".join("\n".join(c) for k, c in enumerate(cs) if k not in gone)
        result.append((doc_id, left if gone else text, text.count("\n") + 1, sum(len(cs[k]) for k in gone)))
    return result


_PRINTS: dict[str, int] = {}


def textual_print(text):
    return _PRINTS[text]


def same_dedup(docs):
    rows = [(r.doc_id, r.text) for r in docs.select("doc_id", "text").collect()]
    _PRINTS.update({r.text: r.p for r in docs.select("text", F.xxhash64("text").alias("p")).collect()})
    got = [tuple(r) for r in linededup.dedup(docs, runs=False).collect()]
    assert sorted(map(str, got)) == sorted(map(str, plain_dedup(rows)))
    return got


def test_line_dedup_equals_brute_force(docs_of, prose):
    rng = random.Random(1)
    passages = [[prose("en", rng.randint(3, 20), f"p{i}{k}") for k in range(rng.randint(2, 6))] for i in range(8)]
    rows = []
    for i in range(120):
        lines = [prose("en", rng.randint(0, 15), f"{i}/{k}") for k in range(rng.randint(0, 5))]
        for p in rng.sample(passages, rng.randint(0, 2)):
            at = rng.randint(0, len(lines))
            lines[at:at] = p + [""] * rng.randint(0, 1)
        if i % 10 == 0:
            lines.insert(0, prose("en", 60, "long line"))
        rows.append((i, "\n".join(lines)))
    rows += [rows[3], (500, rows[7][1]), (501, "Bx\nCy\n\nB")]
    got = same_dedup(docs_of(rows))
    assert sum(r[3] for r in got) > 100


def test_a_shared_passage_goes_whatever_stands_before(docs_of, prose):
    passage = "\n".join(prose("fr", 12, f"shared{k}") for k in range(12))
    rows = [(i, "\n".join([*(prose("en", 9, f"{i}.{k}") for k in range(i)), passage, prose("en", 9, f"end{i}")])) for i in range(1, 6)]
    got = dict((r[0], r) for r in linededup.dedup(docs_of(rows)).collect())
    assert got[1][3] == 0 and all(got[i][3] >= 8 for i in range(2, 6))


def test_chunks_are_cut_once_per_use(docs_of):
    """A filter by exploded chunks would cut every text three times."""
    plan = linededup.repeated_chunks(linededup.with_chunks(docs_of([(1, "a b\nc")])))._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("\\n(?=B)") + plan.count("\n(?=B)") == 1


@pytest.mark.parametrize("runs", [True, False])
def test_texts_that_share_a_cell_with_others(docs_of, prose, monkeypatch, runs):
    """Whatever the bitmap marks by chance, the same lines go."""
    shared = "\n".join(prose("en", 26, f"shared{k}") for k in range(4))
    rows = [(k, prose("en", 30, f"own{k}") + ("\n" + shared + "\nend" if k % 4 == 0 else "\nalone")) for k in range(40)]
    rows += [(50, None), (50, None), (None, shared), (51, "")]
    plain = sorted(map(str, linededup.dedup(docs_of(rows), runs).collect()))
    monkeypatch.setattr(linededup, "CELLS", 16)
    assert sorted(map(str, linededup.dedup(docs_of(rows), runs).collect())) == plain
    assert any("n_removed=4" in r for r in plain) and len(plain) == len(rows)


def test_line_dedup_odd_rows(odd, none, docs_of):
    same_dedup(odd)
    assert linededup.dedup(none).count() == 0
    kept = linededup.strip(odd)
    assert kept.columns == odd.columns and kept.count() == len(ODD_TEXTS)
    copy = "Some words that fill a line with more than enough words to count.\nAnd another line of words that is as long as that."
    left = linededup.strip(docs_of([(1, copy), (2, copy), (3, copy + "\nnew"), (4, "")])).orderBy("doc_id").collect()
    assert [(r.doc_id, r.n_chars == len(r.text)) for r in left] == [(1, True), (3, True), (4, True)] and left[1].text.endswith("new")


def plain_runs(rows):
    """Places of all lines in a run of lines of 50 words that stands earlier, compared line by line."""
    count = lambda x: len(re.findall("[^\x20\x09-\x0d]+", x))
    docs = [(d, t.split("\n")) for d, t in sorted(set(r for r in rows if r[1] is not None), key=lambda r: (r[0], _PRINTS[r[1]]))]
    words = [[count(x) for x in lines] for _, lines in docs]
    where = collections.defaultdict(list)
    for d, (_, lines) in enumerate(docs):
        for i, x in enumerate(lines):
            where[x].append((d, i))
    gone = collections.defaultdict(set)
    for d, (_, lines) in enumerate(docs):
        for i in range(len(lines)):
            for e, k in where[lines[i]]:
                if (e, k) >= (d, i) or not words[d][i]:
                    continue
                n = 0
                while i + n < len(lines) and k + n < len(docs[e][1]) and (e < d or k + n < i) and lines[i + n] == docs[e][1][k + n]:
                    n += 1
                while not words[d][i + n - 1]:
                    n -= 1
                if sum(words[d][i : i + n]) >= 50:
                    gone[docs[d][0], "\n".join(lines)].update(range(i, i + n))
    return gone


def test_repeated_runs_go_whatever_the_chunks(docs_of, prose):
    rng = random.Random(7)
    sizes = [(2, 30), (3, 20), (4, 15), (5, 12), (6, 10), (8, 7), (55, 1), (2, 24), (3, 40)]
    passages = [[prose("en", n, f"run{i}/{k}") for k in range(m)] for i, (m, n) in enumerate(sizes)]
    passages[1].insert(1, "")
    passages[4][3:3] = [" ", ""]
    rows = []
    for i in range(90):
        lines = [prose("en", rng.randint(0, 12), f"own {i}/{k}") for k in range(rng.randint(0, 5))]
        for p in rng.sample(passages, rng.randint(0, 2)):
            at, part = rng.randint(0, len(lines)), p[rng.randint(0, 1) :][: rng.choice([99, 99, 4])]
            lines[at:at] = part
        rows.append((i, "\n".join(lines)))
    rows += [(200, "\n".join(["ten words in a line that comes again and again"] * 23)), (201, "\n".join(["word " * 60, "tail of a few words"])), (202, "x\n" + "\n".join(["word " * 60, "tail of a few words"]))]
    rows += [rows[5], (300, "\n" * 300 + rows[6][1]), (301, None), (302, "")]
    docs = docs_of(rows)
    _PRINTS.update({r.text: r.p for r in docs.select("text", F.xxhash64("text").alias("p")).collect()})
    runs, chunks = plain_runs(rows), collections.Counter((r.doc_id, r.n_removed) for r in linededup.dedup(docs, runs=False).collect())
    found = {}
    for r in linededup.repeated_runs(docs.select("doc_id", "text")).collect():
        found[r.doc_id] = {k for x in r.runs for k in range(x.at, x.at + x.size)}
    count = lambda x: len(re.findall("[^\x20\x09-\x0d]+", x))
    wide = lambda gone: {d: {k for k in g if 0 < count(t.split("\n")[k]) < 50} for (d, t), g in gone.items()}
    short = {d: {k for k in g if 0 < count(dict(rows)[d].split("\n")[k]) < 50} for d, g in found.items()}
    assert {d: g for d, g in short.items() if g} == {d: g for d, g in wide(runs).items() if g} and len(runs) > 20
    got = {r.doc_id: r for r in linededup.dedup(docs).collect()}
    for (d, t), gone in runs.items():
        lines = t.split("\n")
        assert got[d].n_removed >= len(gone) and got[d].n_removed == len(lines) - (got[d].text.count("\n") + 1 if got[d].text or len(lines) > got[d].n_removed else 0)
        assert not any(lines[k] in got[d].text.split("\n") for k in gone if count(lines[k]) > 2 and lines.count(lines[k]) == 1)
    assert sum(r.n_removed for r in got.values()) > sum(n * times for (_, n), times in chunks.items())
    assert got[200].n_removed < 23 and got[301].text is None


def test_two_lines_of_thirty_words_go_from_the_later_document(docs_of, prose):
    rows = []
    for i in range(40):
        passage = [prose("fr", 30, f"pair{i}{k}") for k in "ab"]
        rows += [(10 * i + j, "\n".join([prose("en", 9, f"{i}{j}<"), *passage, prose("en", 9, f"{i}{j}>")])) for j in (1, 2)]
    left = {r.doc_id: r.text for r in linededup.strip(docs_of(rows)).collect()}
    assert all(left[d].count("\n") == (3 if d % 10 == 1 else 1) for d, _ in rows)


# Decontamination


def distance(a, b):
    """Least edit distance between ``a`` and a part of ``b``."""
    row = [0] * (len(b) + 1)
    for i, x in enumerate(a, 1):
        prev, row[0] = row[0], i
        for j, y in enumerate(b, 1):
            prev, row[j] = row[j], min(prev + (x != y), row[j] + 1, row[j - 1] + 1)
    return min(row)


def test_bit_parallel_distance(prose):
    rng = random.Random(2)
    for _ in range(60):
        a = "".join(rng.choice("abc ") for _ in range(rng.randint(1, 90)))
        b = "".join(rng.choice("abc ") for _ in range(rng.randint(0, 120)))
        if rng.random() < 0.5:
            b = b[:9] + a[: len(a) // 2] + "b" + a[len(a) // 2 :] + b[9:]
        assert decontaminate.best_end(decontaminate.masks(a), len(a), b)[0] == distance(a, b)


def test_matches_equal_brute_force(spark, docs_of, prose):
    rng = random.Random(5)
    items = [(i, prose("en", rng.randint(2, 25), f"item{i}").capitalize() + ".") for i in range(12)] + [(20, None), (21, ""), (None, "x"), (3, "Short one")]
    rows = []
    for i in range(60):
        text = prose("en", 30, i)
        if i % 2:
            item = list(rng.choice(items[:12])[1])
            for _ in range(rng.randint(0, max(1, len(item) // 8))):
                item[rng.randrange(len(item))] = rng.choice("aeiou! ")
            text = text[:40] + " " + "".join(item) + " " + text[40:]
        rows.append((i, text))
    rows += [(100, "short ONE!"), (101, None), (102, "")]
    got = {(r.doc_id, r.item_id): r.distance for r in decontaminate.match(docs_of(rows), spark.createDataFrame(items, "item_id bigint, text string")).collect()}
    expected = {}
    plain = lambda t: decontaminate.plain(pa.array([t]))[0]
    for d, text in rows:
        for k, item in items:
            if k is None or not item or not text:
                continue
            a, b = plain(item), plain(text)
            if len(a) < decontaminate.SHORT_ITEM:
                if f" {a} " in f" {b} ":
                    expected[d, k] = 0
            elif (found := distance(a, b)) <= int(len(a) * decontaminate.RATE):
                expected[d, k] = found
    assert got == expected and len(expected) > 10 and max(got.values()) > 0


def test_blocks_of_items_end_by_bytes(spark):
    items = [(i, f"Item {i}: " + "é word " * (40 * (i % 5))) for i in range(60)] + [(60, "x" * 9000), (1, None), (None, "x")]
    blocks = list(decontaminate.blocks_of(spark.createDataFrame(items, "item_id bigint, text string").repartition(3), size=12, most=4000))
    assert all(len(b) <= 12 and (len(b) == 1 or sum(len(t) for _, t in b) <= 4000) for b in blocks)
    expected = sorted((i, decontaminate.plain(pa.array([t]))[0]) for i, t in items if i is not None and t)
    assert sorted(x for b in blocks for x in b) == expected and any(len(b) > 2 for b in blocks)


def test_decontamination_odd_rows(spark, odd, none):
    items = spark.createDataFrame([(1, "a" * 500), (2, "word word word word word word word")], "item_id bigint, text string")
    got = decontaminate.match(odd, items).collect()
    assert sorted((r.doc_id, r.item_id, r.distance) for r in got) == [(5, 1, 0), (6, 2, 0)]
    left = decontaminate.clean(odd, items)
    assert left.columns == odd.columns and left.count() == len(ODD_TEXTS) - 2
    short = spark.createDataFrame([("capital", "Paris is the capital"), ("par", "is the cap")], "item_id string, text string")
    france = odd.limit(1).withColumn("text", F.lit("We know that Paris is the CAPITAL, of France."))
    assert [(r.item_id, r.distance) for r in decontaminate.match(france, short).collect()] == [("capital", 0)]
    assert decontaminate.clean(france, short).count() == 0
    assert decontaminate.match(none, items).count() == 0
    assert decontaminate.match(odd, items.limit(0)).count() == 0 and decontaminate.clean(odd, items.limit(0)).count() == len(ODD_TEXTS)


# Near copies


def plain_components(rows, width, num, den):
    sets = []
    for doc_id, text in rows:
        w = words_of(text)
        sets.append(frozenset(tuple(w[i : i + width]) for i in range(max(1, len(w) - width + 1))) if w else frozenset())
    nodes = sorted(set(s for s in sets if s), key=hash)
    place = {s: i for i, s in enumerate(nodes)}
    up = list(range(len(nodes)))

    def top(x):
        while up[x] != x:
            x = up[x]
        return x

    for i, a in enumerate(nodes):
        for j in range(i):
            common = len(a & nodes[j])
            if common and den * common >= num * len(a | nodes[j]):
                up[top(i)] = top(j)
    least = {}
    for (doc_id, _), s in zip(rows, sets):
        if s and doc_id is not None:
            k = top(place[s])
            least[k] = min(least.get(k, doc_id), doc_id)
    return [(d, len(s), least.get(top(place[s]), d) if s else d) for (d, _), s in zip(rows, sets)]


@pytest.mark.parametrize("width,num", [(3, 90), (5, 80)])
def test_components_equal_brute_force(docs_of, prose, width, num):
    rng = random.Random(width)
    rows = []
    for g, size in enumerate((150, 60, 25, 9, 4, 3, 2, 2)):
        base = prose("en", rng.randint(30, 160), f"base{g}").split()
        drift = list(base)
        for k in range(size):
            mine = list(drift if k % 3 == 0 else base)
            for _ in range(rng.randint(0, 5)):
                mine[rng.randrange(len(mine))] = f"w{rng.randrange(10**6)}"
            if k % 3 == 0 and rng.random() < 0.5:
                drift[rng.randrange(len(drift))] = f"d{rng.randrange(10**6)}"  # chains of links
            rows.append((1000 * g + k, " ".join(mine)))
    rows += [(9000 + i, prose("fr", rng.randint(0, 40), i)) for i in range(60)]
    rows += [(9500, rows[5][1].upper()), (9501, None), (9502, ""), (9503, "a b"), (9504, "A  b"), (9505, "a"), (None, "a b"), (9506, "the same " * 50)]
    rng.shuffle(rows)
    got = [(r.doc_id, r.n_shingles, r.component_id) for r in jaccard.link(docs_of(rows), width, num, 100).collect()]
    expected = plain_components(rows, width, num, 100)
    assert sorted(map(str, got)) == sorted(map(str, expected))
    assert len({c for _, _, c in expected}) > 50


def test_large_groups_lose_no_link():
    """Pairs of one group: first with the leader, then across components, as many as all pairs allow."""
    rng = np.random.default_rng(3)
    n, place = rng.integers(95, 105, 80), rng.integers(0, 8, 80)
    name, root = np.arange(80), rng.integers(0, 5, 80)
    got = {tuple(p) for block in jaccard.cross_pairs(n, place, name, root, 90, 100) for p in block.tolist()}
    expected = {
        (i, j) for j in range(80) for i in range(j)
        if root[i] != root[j] and jaccard.may_reach(n[i : i + 1], place[i : i + 1], n[j : j + 1], place[j : j + 1], 90, 100)[0]
    }
    assert got == expected and len(got) > 100


def test_crossing_names_the_classes_of_cross_pairs():
    rng = np.random.default_rng(4)
    n, place = rng.integers(90, 110, 70), rng.integers(0, 8, 70)
    name, root = np.arange(70), np.where(rng.random(70) < 0.8, 1, rng.integers(2, 5, 70))
    pairs = np.concatenate(list(jaccard.cross_pairs(n, place, name, root, 90, 100)))
    assert np.flatnonzero(jaccard.crossing(n, place, root, 90, 100)).tolist() == np.unique(pairs).tolist()
    few, members = jaccard.few_or_members(n, place, name, root, 90, 100)
    assert not len(few) and members.tolist() == np.unique(pairs).tolist()


def test_large_clusters_link_without_all_pairs(docs_of, prose, monkeypatch):
    """Hundreds of copies just above and below the threshold: few pairs are compared, no link is lost."""
    rng, rows = random.Random(11), []
    for g, length in enumerate((150, 90)):
        base = [f"{w}{k % 7}" for k, w in enumerate(prose("en", length, f"hub{g}").split())]
        for k in range(220):
            mine = list(base)
            for _ in range(rng.choice((2, 2, 3, 4))):
                mine[rng.randrange(length)] = f"w{rng.randrange(10**6)}"
            rows.append((1000 * g + k, " ".join(mine)))
    compared, plain = [], jaccard.verified

    def counted(pairs, *rest):
        compared.append(pairs.count())
        return plain(pairs, *rest)

    monkeypatch.setattr(jaccard, "verified", counted)
    taken = []
    across = jaccard.across
    monkeypatch.setattr(jaccard, "across", lambda *a: taken.append(1) or across(*a))
    got = [(r.doc_id, r.n_shingles, r.component_id) for r in jaccard.link(docs_of(rows), 3, 90, 100).collect()]
    expected = plain_components(rows, 3, 90, 100)
    assert sorted(map(str, got)) == sorted(map(str, expected))
    assert 5 < len({c for _, _, c in expected}) < 435 and taken
    assert sum(compared) < 8 * len(rows)


def test_pairs_far_apart_go_before_their_shingles_move(docs_of, prose, monkeypatch):
    """Texts of which a fifth is shared are candidates, but never compared shingle by shingle."""
    rng, rows = random.Random(5), []
    blocks = [[f"b{g}x{k}" for k in range(30)] for g in range(12)]
    for g in range(40):
        shared = [f"s{g}x{k}" for k in range(30)]
        for k in range(2):
            rows.append((10 * g + k, " ".join(shared + sum(rng.sample(blocks[6 * k : 6 * k + 6], 4), []))))
    # Links of sets on both sides of a signature's next length: 64, 128 and 256 shingles.
    for g, length in enumerate((62, 66, 126, 130, 256, 262)):
        words = [f"l{g}x{k}" for k in range(length)]
        rows += [(1000 + 10 * g + cut, " ".join(words[: length - cut])) for cut in (0, 2, 4)]
    rows += [(2000, "the same words " * 400), (2001, "the same words " * 300), (2002, "a b"), (2003, "a b c"), (2004, None)]
    compared, plain = [], jaccard.verified

    def counted(pairs, *rest):
        compared.extend((r.x, r.y) for r in pairs.collect())
        return plain(pairs, *rest)

    monkeypatch.setattr(jaccard, "verified", counted)
    got = [(r.doc_id, r.n_shingles, r.component_id) for r in jaccard.link(docs_of(rows), 3, 90, 100).collect()]
    expected = plain_components(rows, 3, 90, 100)
    assert sorted(map(str, got)) == sorted(map(str, expected))
    assert {c for d, _, c in expected if 1000 <= d < 2000} == {1000 + 10 * g for g in range(6)}
    assert 0 < len(compared) <= 18


def test_parities_never_tell_more_than_the_difference():
    """Folded to one length, signatures differ in at most as many places as the sets, and in many if the sets do."""
    rng = np.random.default_rng(6)
    pool = rng.integers(0, 1 << 63, 3000, dtype=np.uint64)
    sets = [np.unique(pool[rng.integers(0, m, k)]) for m, k in ((40, 30), (3000, 64), (3000, 65), (80, 70), (300, 250), (300, 290), (3000, 1500), (3000, 2900))]
    sets += [np.zeros(0, dtype=np.uint64), pool[:1]]
    sizes = np.array([len(x) for x in sets])
    odd, words = jaccard.parities(np.repeat(np.arange(len(sets)), sizes), np.concatenate(sets), sizes)
    assert all(w & (w - 1) == 0 and 64 * w >= n and (w == 1 or 32 * w < n) for w, n in zip(words.tolist(), sizes.tolist()))
    signs = np.split(odd.view(np.uint64), np.cumsum(words)[:-1])
    for i, a in enumerate(sets):
        for j, b in enumerate(sets):
            k = min(words[i], words[j])
            apart = sum(int(x).bit_count() for x in np.bitwise_xor.reduce(np.concatenate([signs[i], signs[j]]).reshape(-1, k), axis=0))
            differ = len(np.setxor1d(a, b))
            assert apart <= differ and (differ > 0 or apart == 0) and (differ < 500 or words[i] != words[j] or apart > 250)


def test_near_copies_odd_rows(odd, none):
    got = sorted(map(str, ((r.doc_id, r.n_shingles, r.component_id) for r in jaccard.link(odd, 3, 90, 100).collect())))
    assert got == sorted(map(str, plain_components(ODD_TEXTS, 3, 90, 100)))
    assert jaccard.link(none).count() == 0
    left = jaccard.one_of_each(odd)
    assert left.columns == odd.columns and sorted(str(r.doc_id) for r in left.collect()) == sorted(str(d) for d, _ in ODD_TEXTS if d != 10)


def test_components_of_a_long_path(spark):
    edges = [(i, i + 1) for i in range(60)] + [(100, 200), (300, 200), (5, 5)]
    got = {r.node: r.root for r in components.components(spark.createDataFrame(edges, "a bigint, b bigint")).collect()}
    assert got == {**{i: 0 for i in range(61)}, 100: 100, 200: 100, 300: 100}
    assert components.components(spark.createDataFrame([], "a bigint, b bigint")).count() == 0


# Language model


def plain_katz(rows):
    tokens = [words_of(t) + [None] for _, t in rows]
    learn = [d is not None and zlib.crc32(str(d).encode()) % 10 != 0 for d, _ in rows]
    single, pairs = collections.Counter(), collections.Counter()
    for t, use in zip(tokens, learn):
        if use:
            single.update(t)
            pairs.update(zip([None, *t[:-1]], t))
    total, types = sum(single.values()), len(single)

    def rule(counts):
        seen = collections.Counter(counts.values())
        d = katz.discounts(np.array([seen[r] for r in range(1, katz.CUTOFF + 2)]))
        return lambda r: d[r] * r if r <= katz.CUTOFF else r - katz.REST

    d1, d2 = rule(single), rule(pairs)
    left = max(1 - sum(map(d1, single.values())) / total, 1e-12) if total else 1.0
    p1 = lambda w: d1(single[w]) / total if single[w] else left
    after = collections.defaultdict(dict)
    for (h, w), r in pairs.items():
        after[h][w] = r
    size = {h: sum(s.values()) for h, s in after.items()}
    weight = {h: (1 - sum(map(d2, s.values())) / size[h]) / (1 - sum(map(p1, s))) for h, s in after.items()}

    def log(h, w):
        if h not in after:
            return math.log10(p1(w))
        return math.log10(d2(after[h][w]) / size[h] if w in after[h] else weight[h] * p1(w))

    for h in list(after)[:5]:
        assert sum(10 ** log(h, w) for w in single) + 10 ** log(h, "unknown word") == pytest.approx(1)
    return [
        (d, len(t), sum(w in single for w in t), total, sum(math.log10((single[w] + 0.1) / (total + 0.1 * (types + 1))) for w in t),
         sum(log(h, w) for h, w in zip([None, *t[:-1]], t)))
        for (d, _), t in zip(rows, tokens)
    ]


def same_katz(docs):
    rows = [(r.doc_id, r.text) for r in docs.select("doc_id", "text").collect()]
    got = sorted((tuple(r) for r in katz.classify(docs).collect()), key=str)
    expected = sorted(plain_katz(rows), key=str)
    assert [g[:4] for g in got] == [e[:4] for e in expected]
    np.testing.assert_allclose([g[4:] for g in got], [e[4:] for e in expected], rtol=1e-9)
    return got


def test_scores_equal_brute_force(docs_of, prose):
    rows = [(i, prose("en" if i % 2 else "fr", i % 40, i % 90)) for i in range(300)]
    got = same_katz(docs_of(rows).repartition(3))
    out = [g for g in got if zlib.crc32(str(g[0]).encode()) % 10 == 0]
    assert sum(g[5] for g in out) > sum(g[4] for g in out)


def test_scores_of_odd_rows(odd, none, docs_of):
    same_katz(odd)
    assert katz.classify(none).count() == 0
    unlearned = [i for i in range(200) if zlib.crc32(str(i).encode()) % 10 == 0][:2]
    alone = katz.classify(docs_of([(i, "no training text") for i in unlearned])).collect()
    assert [(r.n_tokens, r.n_known, r.train_tokens) for r in alone] == [(4, 0, 0)] * 2 and all(math.isfinite(r.score) for r in alone)


def test_packed_numbers():
    for a in ([], [0], [1, 255, 256], [2**40, 0, 7]):
        assert katz.unpack(katz.pack(np.array(a, dtype=np.int64))).tolist() == a


def test_a_frequent_history_has_several_buckets():
    u = textual.words_of(pa.array(["the a the b the c the d"]))
    assert len(u.ends) == 8
    block = katz.Block.__new__(katz.Block)
    block.pair_history, block.pair_word = np.full(500, 3), np.arange(500)
    block.pair_history_count = np.full(500, 400)
    assert len(np.unique(block.pair_buckets(16, 1000))) > 8
    block.pair_history_count = np.full(500, 1)
    assert len(np.unique(block.pair_buckets(16, 100_000))) == 1
