from __future__ import annotations

import re

import pytest
from pyspark.sql import functions as F

from tristrata.llm import urls

PAGES = "page_id bigint, url string, html string, token string, verdict string"
ODD = [
    (1, "HTTP://WWW.Example.ORG/es/1?x=/en/1#y"), (2, "http://example.org"), (3, "https://a.example.com/fr/"), (4, None), (5, "no scheme/x"),
    (6, "://"), (7, "http://com/de/3"), (8, "http://notcom/de/3"), (9, "ftp://u:p@b.example.org:80/en/1"), (10, "http://x.example.org/en/12?a#b"),
    (11, "http://É.example.net?q=1&r&=2"), (12, "http://x.net/a/a/" + "b" * 5000), (12, "http://x.net/a/a/" + "b" * 5000), (None, "http://y.org/"),
]


@pytest.fixture(scope="module")
def pages(spark):
    many = [(100 + i, f"http://h{i % 7}.example.{'com' if i % 2 else 'org'}/{'de' if i % 4 == 1 else 'fr'}/{i}") for i in range(300)]
    spam = [(1000 + i, f"http://spam.example.com/de/{i}") for i in range(60)]
    rest = [(2000 + i, f"http://{'spam' if i % 2 else 'h1'}.example.net/{'de' if i % 2 else 'fr'}/{i}") for i in range(40)]
    return spark.createDataFrame([(i, u, None, "x", "y") for i, u in ODD + many + spam + rest], PAGES)


def plain_rule(url):
    after = url.split("://", 1)[1] if url and "://" in url else ""
    host = re.match(r"[^/?#]*", after)[0]
    path = re.match(r"[^?#]*", after[len(host) :])[0]
    host = "".join(c.lower() if "A" <= c <= "Z" else c for c in host)
    best = None
    for says, h, p in urls.RULES:
        if (host == h or host.endswith("." + h)) and path.startswith(p) and (best is None or len(h + p) > len(best[0])):
            best = (h + p, says)
    return host, path, best


def test_hosts_paths_and_stated_rules(pages):
    got = urls.judge(pages).collect()
    given = pages.select("page_id", "url").collect()
    assert sorted(map(str, ((r.page_id, r.host, r.path, r.rule) for r in got))) == sorted(
        str((r.page_id, *plain_rule(r.url)[:2], (plain_rule(r.url)[2] or (None,))[0])) for r in given
    )
    stated = {r.page_id: plain_rule(r.url)[2] for r in given}
    for r in got:
        assert r.verdict in ("allow", "block") and (stated[r.page_id] is None or r.verdict == stated[r.page_id][1])


def test_mined_rules_equal_brute_force(spark, pages):
    host, path = urls.host_of(F.col("url")), urls.path_of(F.col("url"))
    _, verdict = urls.stated_rule(host, path)
    seen = pages.select(urls.tokens_of(F.col("url")).alias("tokens"), verdict.alias("verdict"))
    rows = {(tuple(r.tokens), r.verdict) for r in seen.where("verdict is not null").collect() if r.tokens}
    least = -(-len(rows) * 2 // 100)
    from itertools import combinations

    counts, both = {}, {}
    for tokens, says in rows:
        for n in (1, 2, 3):
            for c in combinations(tokens, n):
                counts[c] = counts.get(c, 0) + 1
                both[c, says] = both.get((c, says), 0) + 1
    sure = {k: n / counts[k[0]] for k, n in both.items() if n >= least and n / counts[k[0]] >= 0.9}
    kept = {k for k, v in sure.items() if not any((c, k[1]) in sure and sure[c, k[1]] >= v for n in (1, 2) for c in combinations(k[0], n) if n < len(k[0]))}
    mined = urls.mine_rules(seen.where("verdict is not null"), support=0.02, confidence=0.9).collect()
    assert {(tuple(r.antecedent), r.verdict) for r in mined} == kept
    for r in mined:
        assert r.confidence == pytest.approx(sure[tuple(r.antecedent), r.verdict]) and r.token in r.antecedent


def test_four_tokens_that_are_sure_only_together(spark):
    four = ["p:a", "p:b", "p:c", "p:d"]
    rows = [([*four, f"p:own{i}"], "block") for i in range(20)]
    rows += [([t for t in four if t != gone] + [f"p:{gone}{i}"], "allow") for gone in four for i in range(20)]
    mined = urls.mine_rules(spark.createDataFrame(rows, "tokens array<string>, verdict string"), support=0.1, confidence=0.9).collect()
    assert [(r.antecedent, r.verdict, r.support) for r in mined if r.verdict == "block"] == [(four, "block", 20)]


def test_mined_verdicts(pages):
    got = {r.page_id: r for r in urls.judge(pages, support=0.02).collect()}
    assert got[2001].verdict == "block" and got[2001].mined_rule and got[2000].verdict == "allow"
    assert got[4].verdict == got[5].verdict == "allow" and got[4].host == got[4].path == ""


def test_empty_table(spark):
    assert urls.judge(spark.createDataFrame([], PAGES)).count() == 0
    alone = urls.judge(spark.createDataFrame([(1, "http://x.net/", None, None, None)], PAGES)).collect()
    assert [(r.rule, r.verdict) for r in alone] == [(None, "allow")]


def test_a_template_of_thirty_constant_parts(spark):
    """Parts that always come together are one item, whatever their number."""
    import time

    fixed = [f"p:part{i}" for i in range(30)]
    rows = [([*fixed, f"p:own{i}"], "block") for i in range(60)] + [([f"p:other{i}", "p:other"], "allow") for i in range(60)]
    began = time.monotonic()
    mined = urls.mine_rules(spark.createDataFrame(rows, "tokens array<string>, verdict string"), support=0.1, confidence=0.9).collect()
    assert time.monotonic() - began < 60
    assert sorted(r.antecedent for r in mined if r.verdict == "block") == sorted([t] for t in fixed)
    assert [r.antecedent for r in mined if r.verdict == "allow"] == [["p:other"]]
