import os
import threading
from datetime import date

import pytest
from pyspark.sql import functions as F

from test_warehouse import DAY, crypto, news
from tidemark.plans.warehouse import FACTS, INDEX, ROWS
from tidemark.sources.partitions import ConflictError, PartitionedTable, Section, survivors
from tidemark.sources.schemas import struct
from tidemark.sources.storage import create_exclusively, files_in, read_small

@pytest.fixture
def table(spark, tmp_path):
    return PartitionedTable(spark, str(tmp_path / "t"), {"rows": Section(struct("k int, v string"), "part", ("k",))})


def rows(spark, *values):
    return spark.createDataFrame(list(values), "k int, v string, part int")


def got(frame):
    return sorted(tuple(r) for r in frame.collect())


def test_a_reader_sees_the_old_or_the_new_rows(table, spark):
    assert got(table.read("rows")) == [] and table.state().version == 0
    first = table.write("rows", rows(spark, (1, "a", 5), (2, "b", 6)))
    assert got(table.read("rows")) == []  # stopped before the switch
    table.publish(table.state(), {"rows": first.folders})
    reader = table.read("rows")
    base = table.state()
    second = table.write("rows", rows(spark, (1, "new", 5), (3, "c", 7)))
    old = [(1, "a", 5), (2, "b", 6)]
    assert got(reader) == got(table.read("rows")) == old  # both partitions written, none switched
    table.publish(base, {"rows": second.folders})
    assert got(table.read("rows")) == [(1, "new", 5), (2, "b", 6), (3, "c", 7)]
    assert got(reader) == old  # who began before goes on with what was there
    assert got(table.read("rows", [7, 99])) == [(3, "c", 7)]


def test_partitions_of_several_folders_end_and_leave_nothing(table, spark):
    def load(state, *values, also=()):
        written = table.write("rows", rows(spark, *values)).folders
        return table.publish(state, {"rows": {v: f + tuple(also) for v, f in written.items()}})

    one = load(table.state(), (1, "a", 5))
    two = load(one, (2, "b", 5), also=one.of("rows")[5])
    assert got(table.read("rows")) == [(1, "a", 5), (2, "b", 5)]
    three = table.publish(two, {"rows": {5: ()}})
    assert got(table.read("rows")) == [] and three.of("rows") == {}
    load(three, (3, "c", 6))
    assert files_in(spark, f"{table.path}/_versions") == ["v-000000003.json", "v-000000004.json"]
    folders = [d for d, _, files in os.walk(f"{table.path}/rows") if any(f.endswith(".parquet") for f in files)]
    assert [f.rsplit("/", 1)[1] for f in folders] == ["part=6"]
    lost = table.write("rows", rows(spark, (9, "dead", 8)))
    assert any(lost.folder in p for p in table.vacuum()) and got(table.read("rows")) == [(3, "c", 6)]


def test_of_two_loads_of_a_partition_one_wins(table, spark):
    base = table.state()
    one, two = (table.write("rows", rows(spark, (1, v, 5))) for v in "xy")
    other = table.write("rows", rows(spark, (1, "z", 6)))
    table.publish(base, {"rows": one.folders})
    with pytest.raises(ConflictError):
        table.publish(base, {"rows": two.folders})
    table.publish(base, {"rows": other.folders})  # another partition: no conflict
    assert got(table.read("rows")) == [(1, "x", 5), (1, "z", 6)]


def test_unknown_partitions_are_refused(table, spark):
    with pytest.raises(ValueError, match="must not be null"):
        table.write("rows", rows(spark, (1, "a", None)))


def test_exclusive_creation(spark, tmp_path):
    path, wins = f"{tmp_path}/one/file", []
    threads = [threading.Thread(target=lambda n=n: wins.append((create_exclusively(spark, path, f"text {n}"), n))) for n in range(12)]
    [t.start() for t in threads]
    [t.join() for t in threads]
    (winner,) = [n for won, n in wins if won]
    assert read_small(spark, path) == f"text {winner}" and files_in(spark, f"{tmp_path}/one") == ["file"]


def test_survivors(spark):
    old, new = rows(spark, (1, "a", 5), (2, "b", 5)), rows(spark, (2, "x", 6))
    assert got(survivors(old, new, ["k"])) == [(1, "a", 5)]
    assert survivors(old.where("k = 2"), new, ["k"]) is None


def test_a_load_that_dies_changes_nothing_and_can_be_run_again(wh, silver, monkeypatch):
    wh.load("coingecko", silver("coingecko", crypto("bitcoin", 1.0), crypto("tron", 5.0)))
    before = got(wh.table("fact_crypto"))

    def dies(*_):
        raise RuntimeError("stopped before the switch")

    with monkeypatch.context() as patch:
        patch.setattr(PartitionedTable, "publish", dies)
        with pytest.raises(RuntimeError):
            wh.load("coingecko", silver("coingecko", crypto("bitcoin", 2.0)))
    assert got(wh.table("fact_crypto")) == before
    wh.load("coingecko", silver("coingecko", crypto("bitcoin", 2.0)))
    assert sorted(r["price_usd"] for r in wh.table("fact_crypto").collect()) == [2.0, 5.0]


def test_moved_rows_are_found_by_the_index_alone(wh, silver, monkeypatch):
    """A reload reads the index in the buckets of its keys, and stored rows of touched months only."""
    days = [date(2026, m, 1) for m in (1, 2, 3, 4)]
    wh.load("newsapi", silver("newsapi", *[news(f"u{m}-{i}", "old", day=d) for m, d in enumerate(days) for i in range(5)]))
    read = []
    real = PartitionedTable.read

    def watched(self, section, values=None, state=None):
        frame = real(self, section, values, state)
        read.append((section, None if values is None else set(values), frame._jdf.queryExecution().optimizedPlan().toString(), frame.inputFiles()))
        return frame

    monkeypatch.setattr(PartitionedTable, "read", watched)
    wh.load("newsapi", silver("newsapi", news("u1-0", "moved", day=days[3]), news("fresh", "new", day=days[3])))
    assert {s for s, *_ in read} == {ROWS, INDEX}
    buckets = next(v for s, v, *_ in read if s == INDEX)
    assert len(buckets) <= 2
    files = [f for s, _, _, listed in read if s == ROWS for f in listed]
    assert files and all("month_key=202602" in f or "month_key=202604" in f for f in files)
    monkeypatch.undo()
    rows = {r["url"]: (r["title"], r["date_key"]) for r in wh.table("fact_news").collect()}
    assert len(rows) == 21 and rows["u1-0"] == ("moved", 20260401) and rows["u1-1"] == ("old", 20260201)
    index = wh._fact(FACTS["fact_news"]).read(INDEX)
    assert index.count() == 21 and index.where("partition = 202602").count() == 4
    # A month whose articles have all moved away ends.
    wh.load("newsapi", silver("newsapi", *[news(f"u0-{i}", "moved", day=DAY) for i in range(5)]))
    assert 202601 not in wh._fact(FACTS["fact_news"]).state().of(ROWS)
    assert wh.table("fact_news").groupBy("url").count().where(F.col("count") > 1).count() == 0
