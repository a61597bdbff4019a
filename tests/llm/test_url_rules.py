"""URL rules against plain Python."""

from __future__ import annotations

import random

import pytest

from reviewmill.llm import url_rules

RULES = "host string, path string, verdict string"
PAGES = "page_id long, url string, host string, path string, rule string, site string, row string, verdict string"


def split(url):
    if url is None or "://" not in url:
        return "", ""
    rest = url.split("://", 1)[1]
    end = min([rest.index(c) for c in "/?#" if c in rest] or [len(rest)])
    host = "".join(c.lower() if "A" <= c <= "Z" else c for c in rest[:end])
    tail = rest[end:]
    return host, tail[:min([tail.index(c) for c in "?#" if c in tail] or [len(tail)])]


def expected(url, rules, default="allow"):
    host, path = split(url)
    fits = [(len(h) + len(p), len(h), h + p, v) for h, p, v in rules if (host == h or host.endswith("." + h)) and path.startswith(p)]
    best = max(fits, default=(0, 0, None, default))
    return host, path, best[2], best[3]


def judged(spark, urls, rules, **options):
    pages = spark.createDataFrame([(i, u, "x", "x", "x", "x", "x", "x") for i, u in urls], PAGES).repartition(3)
    got = url_rules.judge(pages, spark.createDataFrame(rules, RULES), **options)
    assert got.columns == ["page_id", "host", "path", "rule", "verdict"]
    return sorted(map(tuple, got.collect()), key=repr)


CONTRACT = [("com", "/", "allow"), ("example.com", "/en/", "block"), ("www.example.com", "/en/", "allow"), ("net", "/es/", "block"), ("net", "/fr/", "block")]


def test_odd_urls(spark):
    urls = [
        None, "", "nothing", "://", "http://", "http://COM", "http://com/", "http://.com/", "http://xcom/", "http://a.Example.COM/en/1?x#y",
        "http://www.example.com/en/", "http://www.example.com/en", "https://a.www.example.com/en/x://b.net/fr/", "http://e.net/es/?q", "http://e.net?/es/",
        "http://e.net#/es/", "a://b://net/es/", "http://é.net/fr/é\U0010ffff", "http://com:80/", "http://a..com//en/", "http://x.net/fr/" + "y" * 200_000,
        "http://" + "a." * 5_000 + "com/"]
    rows = [(k, u) for k, u in enumerate(urls)] + [(None, urls[9]), (None, urls[9]), (3, urls[10]), (3, urls[10])]
    assert judged(spark, rows, CONTRACT) == sorted(((i, *expected(u, CONTRACT)) for i, u in rows), key=repr)


@pytest.mark.parametrize("slot", [3, 100_000])
@pytest.mark.parametrize("sites", [0, 100_000])
def test_nested_rules_and_hot_sites(spark, monkeypatch, slot, sites):
    monkeypatch.setattr(url_rules, "SLOT", slot)
    monkeypatch.setattr(url_rules, "MAX_BROADCAST_SITES", sites)
    rng = random.Random(5)
    hosts, parts = ["a", "b.a", "c.b.a", "b", "x.a", "", "a."], ["", "/", "/p", "/p/", "/p/q", "/p/qr", "/p/\U0010ffff", "/é", "/p/\x7f"]
    rules = sorted({(rng.choice(hosts), rng.choice(parts)) for _ in range(40)})
    rules = [(h, p, rng.choice(["allow", "block"])) for h, p in rules]
    urls = [(k, f"http://{rng.choice(hosts + ['z.c.b.a', 'n'])}{rng.choice(parts)}{rng.choice(['', 'x', '/y', chr(0x10ffff)])}") for k in range(200)]
    assert judged(spark, urls, rules, default="?") == sorted(((i, *expected(u, rules, "?")) for i, u in urls), key=repr)


def test_empty_tables_and_unclear_rules(spark):
    assert judged(spark, [], CONTRACT) == []
    assert judged(spark, [(1, "http://a.com/")], []) == [(1, "a.com", "/", None, "allow")]
    assert judged(spark, [(1, "http://a.com/"), (2, None)], [("com", None, "allow"), ("com", "", "block"), (None, None, "none")]) == [
        (1, "a.com", "/", "com", "block"), (2, "", "", "", "none")]


def test_no_python_in_the_plan(spark, sf_dir):
    from reviewmill.llm.queries import op11_url_rules

    plan = op11_url_rules(spark, sf_dir)._jdf.queryExecution().toString()
    assert not any(word in plan for word in ("Python", "Arrow", "Pandas", "CartesianProduct", "NestedLoop"))
