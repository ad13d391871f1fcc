import random

import pytest
from pyspark.sql import functions as F

import tidemark.operators.paging as paging
from tidemark.operators.paging import Page, narrowed_to_page


@pytest.fixture
def small_ranges(monkeypatch):
    for name, value in (("RANGE_ROWS", 40), ("RANGES", 6), ("SAMPLE_ROWS", 200)):
        monkeypatch.setattr(paging, name, value)


def made(spark, n, seed=1):
    pick = random.Random(seed)
    rows = [(pick.choice((None, "a", "b", "c")), pick.choice((None, 1.5, 2.5, -1.0)), i) for i in range(n)]
    pick.shuffle(rows)
    return spark.createDataFrame(rows, "g string, v double, i int").repartition(5)


ORDER = ("-g", "v", "-i")


def whole(rows):
    last = lambda x, sign: (x is None, 0 if x is None else x if sign > 0 else -x if not isinstance(x, str) else -ord(x))
    return sorted(rows.collect(), key=lambda r: (last(r["g"], -1), last(r["v"], 1), last(r["i"], -1)))


def test_deep_pages_are_those_of_the_whole_order(spark, small_ranges):
    rows = made(spark, 700)
    want = whole(rows)
    for offset in (1, 39, 350, 630, 690, 699, 700, 5000):
        page = Page(rows, ORDER, limit=15, offset=offset, deep=1)
        assert page._shallow()[0].items.collect() == want[offset : offset + 15], offset
        assert page.envelope()["total"] == 700
    report = Page(rows, ORDER, limit=2, offset=600, deep=1).report().collect()
    assert [(r["i"], r["total"], r["limit"], r["offset"]) for r in report] == [(w["i"], 700, 2, 600) for w in want[600:602]]


def test_no_task_holds_what_comes_before_the_page(spark, small_ranges):
    rows, offset, total = narrowed_to_page(made(spark, 2000), ORDER, 1800, 10)
    assert total == 2000 and offset < 200 and rows.count() < 200


def test_equal_keys_are_left_to_the_sort(spark, small_ranges):
    rows = spark.range(300).select(F.lit(7).alias("k"), "id")
    assert len(Page(rows, ("k",), limit=10, offset=250, deep=1)._shallow()[0].items.collect()) == 10
    rows, offset, total = narrowed_to_page(rows, ("k",), 250, 10)
    assert (offset, total) == (250, 300)


def test_total_and_rows_come_from_one_pass(spark):
    reads = spark.sparkContext.accumulator(0)

    def counted(batches):
        for batch in batches:
            reads.add(batch.num_rows)
            yield batch

    rows = spark.range(1000).mapInArrow(counted, "id long")
    page = Page(rows, ("-id",), limit=3, offset=4).envelope()
    assert page == {"items": [{"id": 995}, {"id": 994}, {"id": 993}], "total": 1000, "limit": 3, "offset": 4}
    assert reads.value == 1000


@pytest.mark.parametrize("condition", ["false", "id > 100", "id is null"])
def test_pages_of_nothing(spark, condition):
    rows = spark.range(10).where(condition)
    assert Page(rows, ("id",)).envelope() == {"items": [], "total": 0, "limit": 50, "offset": 0}
    assert Page(rows, ("id",), offset=20_000).envelope()["total"] == 0
    assert Page(rows, ("id",), offset=20_000).report().collect() == []
