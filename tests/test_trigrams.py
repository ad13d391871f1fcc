import pytest
from pyspark.sql import functions as F

from tidemark.functions.guards import contains_ci
from tidemark.operators.trigrams import TrigramIndex, literals, needed, trigrams

TITLES = [
    "Markets rally as rates fall", "MARKETS FALL", None, "", "ab", "100% sure_thing", "100 sure thing", "a_b%c\\d", "ÉTÉ à Paris",
    "été", "emoji 😀😀😀 here", "日本語のニュース", "line\nbreak and\ttab", "aaa" * 50, "x" * 20_000 + " needle",
]
NEEDLES = [
    "fall", "FALL", "rates fa", "mark%fall", "m_rkets", "%", "_", "", "a", "ab", "été", "ÉTÉ", "😀😀😀", "日本語", "aaaa", "\nbreak",
    "100\\% sure", "100%sure", "a\\_b", "c\\\\d", "needle", "nothing like it", "fal%zzz", "sure_thing", "sure\\_thing",
]


@pytest.fixture(scope="module")
def indexed(spark, tmp_path_factory):
    rows = spark.createDataFrame([(i % 13 or None, str(i), t) for i, t in enumerate(TITLES * 3)], "k int, u string, title string").repartition(4)
    index = TrigramIndex(spark, str(tmp_path_factory.mktemp("trigrams")), rows.select("k", "u").schema, "title")
    index.build(rows)
    return rows, index


@pytest.mark.parametrize("needle", NEEDLES)
def test_search_equals_a_scan(indexed, needle):
    rows, index = indexed
    ids = lambda frame: sorted(r["u"] for r in frame.collect())
    assert ids(index.search(rows, needle)) == ids(rows.where(contains_ci(F.col("title"), needle)))


def test_candidates_come_from_the_postings_of_their_buckets(indexed):
    _, index = indexed
    files = index.candidates("markets").inputFiles()
    assert files and all("/postings/" in f for f in files)
    assert len({f.split("bucket=")[1].split("/")[0] for f in files}) <= 4
    assert index.candidates("no such").collect() == [] and index.candidates("%a_b") is None


def test_needles_and_trigrams(spark):
    assert literals("a%b_c\\%d\\\\") == ["a", "b", "c%d\\"] and needed("ab%cd") == [] and needed("ABcd") == ["abc", "bcd"]
    rows = spark.createDataFrame([("😀bcB😀",), ("ab",), (None,)], "t string").select(trigrams(F.col("t")).alias("g")).collect()
    assert [r["g"] for r in rows] == [["😀bc", "bcb", "cb😀"], [], []]


def test_building_again_replaces_all(spark, tmp_path):
    rows = spark.createDataFrame([(1, "first title"), (2, None)], "id int, title string")
    index = TrigramIndex(spark, str(tmp_path / "i"), rows.select("id").schema, "title")
    assert index.search(rows, "first").collect() == []  # nothing is indexed yet
    index.build(rows)
    assert index.search(rows, "first").count() == 1
    index.build(rows.where("id = 2"))
    assert index.search(rows, "first").collect() == []


def test_postings_do_not_repeat_long_keys(spark, tmp_path):
    """A posting is as short for a long key as for a short one, and rows with a null or repeated key are found."""
    rows = spark.createDataFrame([("u" * 500, "a title"), (None, "a title"), (None, "title b"), ("u" * 500, "other")], "url string, title string")
    index = TrigramIndex(spark, str(tmp_path / "i"), rows.select("url").schema, "title")
    index.build(rows)
    assert "url" not in index.table.read("postings").columns
    found = index.search(rows, "title").collect()
    assert sorted((r["url"] is None, r["title"]) for r in found) == [(False, "a title"), (True, "a title"), (True, "title b")]
