import random

import pytest

from tidemark.llm.urls import build_filter, judge_urls, possible_hits

RULES = [("net", "/", "block"), ("example.net", "/en/", "allow"), ("a.b", "/x", "allow"), ("a.b", "/x", "block")]
URLS = [
    "http://Shop.NET/a?b#c", "https://www.Example.net/en/1", "http://example.net/de/1", "http://net", "ftp://a.b/xyz?q",
    "http://notexample.org/p", "http://bad.org/p?x=1", "HTTP://BAD.org/p#y", "bad.org/p", "", None, "http://", "x://y://z/w",
    "http://a.b/X",
]
LISTED = ["https://bad.org/p", "http://other.org/q", None]


def brute(url):
    if url is None or "://" not in url:
        return "", "", None, False, "allow"
    rest = url.split("://", 1)[1]
    cut = min([rest.find(c) for c in "/?#" if c in rest], default=len(rest))
    host = rest[:cut].lower()
    path = rest[cut:]
    path = path[: min([path.find(c) for c in "?#" if c in path], default=len(path))]
    fits = [
        (len(h + p), h + p, v) for h, p, v in RULES if (host == h or host.endswith("." + h)) and path.startswith(p)
    ]
    listed = (host, path) in {("bad.org", "/p"), ("other.org", "/q")}
    rule = max(fits, default=None)
    return host, path, rule and rule[1], listed, rule[2] if rule else "block" if listed else "allow"


@pytest.fixture
def rules(spark):
    return spark.createDataFrame(RULES, "host string, path string, verdict string")


@pytest.fixture
def listed(spark):
    return spark.createDataFrame([(u,) for u in LISTED], "url string")


def test_matches_brute_force(spark, rules, listed):
    rows = [(i, u, "x") for i, u in enumerate(URLS + URLS[:3])] + [(None, URLS[0], "x")]
    pages = spark.createDataFrame(rows, "page_id long, url string, verdict string")
    got = {(r["page_id"], *list(r)[1:]) for r in judge_urls(pages, rules, listed).collect()}
    assert got == {(i, *brute(u)) for i, u, _ in rows}


def test_filter_has_no_false_negatives_and_few_false_positives(spark):
    pick = random.Random(5)
    keys = [(f"k{pick.random()}",) for _ in range(3000)]
    bloom = build_filter(spark.createDataFrame(keys, "key string"))
    asked = spark.createDataFrame(keys + [(f"other{i}",) for i in range(3000)], "key string")
    hits = {r["key"] for r in possible_hits(asked, bloom).collect()}
    assert {k for k, in keys} <= hits
    assert len(hits) - 3000 < 60


def test_empty_tables(spark, rules, listed):
    pages = spark.createDataFrame([(1, URLS[0])], "page_id long, url string")
    assert judge_urls(pages.limit(0), rules, listed).collect() == []
    assert [r["verdict"] for r in judge_urls(pages, rules.limit(0), listed.limit(0)).collect()] == ["allow"]


def test_long_hosts_and_paths(spark, rules, listed):
    urls = ["http://" + "a." * 20_000 + "example.net/en/x", "http://x.net/" + "p/" * 50_000, "http://" + "b" * 100_000]
    pages = spark.createDataFrame(list(enumerate(urls)), "page_id long, url string")
    got = {(r["page_id"], r["rule"], r["verdict"]) for r in judge_urls(pages, rules, listed).collect()}
    assert got == {(0, "example.net/en/", "allow"), (1, "net/", "block"), (2, None, "allow")}
