import json

import pytest
from pyspark.sql import functions as F

from payloads import annual, annual_page, coin, rates_page, weather_page
from tidemark.plans.jobs import land_payloads, run_silver
from tidemark.sources import schemas
from tidemark.sources.bronze import envelopes, numbered_pages, read_bronze, read_landed, stamp
from tidemark.sources.contracts import ContractError, check_payloads, require_valid
from tidemark.sources.extras import extra, extra_series, unmodelled
from tidemark.sources.silver import read_silver

DAYS = ["2031-01-01", "2031-01-02", "2031-01-03"]


def payloads(spark, *pages):
    rows = [(i, p if isinstance(p, str | None) else json.dumps(p)) for i, p in enumerate(pages)]
    return spark.createDataFrame(rows, "page_no long, payload string")


def test_what_a_payload_has_beyond_its_fields(spark):
    dtype = schemas.struct(schemas.PAGES["open_meteo"])
    given = [
        {**weather_page(DAYS, [1, 2, 3], wind=[1.5, None, "calm"], deep={"a": [1]}), "elevation": 9},
        weather_page(DAYS, [1, 2, 3]),
        {"latitude": 1, "daily": 5, "note": None},
        [1, 2], "broken", None, "{}",
    ]
    rows = payloads(spark, *given).select("page_no", F.to_json(unmodelled(F.col("payload"), dtype)).alias("extra"))
    got = {r["page_no"]: r["extra"] and json.loads(r["extra"]) for r in rows.collect()}
    assert got == {
        0: {"elevation": 9, "daily": {"wind": [1.5, None, "calm"], "deep": {"a": [1]}}},
        1: None, 2: {"note": None}, 3: None, 4: None, 5: None, 6: None,
    }


def test_extras_are_landed_and_typed_columns_stay(spark, tmp_path):
    bronze, silver = f"{tmp_path}/bronze", f"{tmp_path}/silver"
    pages = [{**weather_page(DAYS, [i, 2, 3], at=(i, 0.5), wind=[1.5, i, 7, 99], gusts=["x"]), "elevation": i} for i in range(5)]
    pages.append(weather_page(DAYS, [4, 4, 4], at=(9, 9)))
    land_payloads(payloads(spark, *pages), "open_meteo", "2031-02-01", bronze)
    for documents in (read_landed(spark, "open_meteo", bronze), read_bronze(spark, "open_meteo", f"{bronze}/feed=open_meteo/*")):
        rows = numbered_pages(documents)
        heights = rows.select("page_no", extra("$.elevation", "int").alias("h"), extra("$.elevation", "array<int>").alias("no"))
        assert sorted(tuple(r) for r in heights.collect()) == [(i, i if i < 5 else None, None) for i in range(6)]
        series = extra_series(rows, "page.daily.time", "$.daily")
        got = [(r["page_no"], r["series"], r["item_no"], r["v"]) for r in series.select("page_no", "series", "item_no", F.to_json("reading").alias("v")).collect()]
        want = [(i, "wind", n, v) for i in range(5) for n, v in enumerate(["1.5", str(i), "7"])]
        assert sorted(got) == sorted(want + [(i, "gusts", 0, '"x"') for i in range(5)])
    run_silver(spark, "open_meteo", bronze, silver)
    rows = read_silver(spark, "open_meteo", silver)
    assert rows.count() == 18 and "extra" not in rows.columns


def test_feeds_that_keep_none_have_no_extra_column(spark):
    page = {**rates_page("USD", EUR=1.5), "more": 1}
    checked = check_payloads(payloads(spark, page), "exchange_rate")
    assert "extra" not in checked.columns and checked.first()["problems"] == []


def test_every_feed_can_be_landed(spark, tmp_path):
    """Pages with maps can't be compared with each other; only their numbers are."""
    path = f"{tmp_path}/bronze"
    land_payloads(payloads(spark, rates_page("USD", EUR=1.5), rates_page("KES", EUR=2.5)), "exchange_rate", "2031-01-01", path)
    pages = numbered_pages(read_landed(spark, "exchange_rate", path)).collect()
    assert sorted((r["page_no"], r["page"]["base_code"]) for r in pages) == [(0, "USD"), (1, "KES")]


def test_breaches_are_counted_in_one_pass(spark, tmp_path):
    wrong = [{"coins": [coin("a", "n/a")]}, {"coins": [{"id": "b"}]}, "broken", {"coins": [coin("c", 1.0)]}]
    texts = payloads(spark, *wrong)
    with pytest.raises(ContractError, match=r"current_price: not a number \(1\).*name: missing \(1\).*symbol: missing \(1\).*expected shape \(1\)"):
        land_payloads(texts, "coingecko", "2031-01-01", f"{tmp_path}/bronze")
    assert not (tmp_path / "bronze").exists()
    reads = spark.sparkContext.accumulator(0)

    def counted(batches):
        for batch in batches:
            reads.add(batch.num_rows)
            yield batch

    fine = payloads(spark, *[{"coins": [coin(f"c{i}", 1.0)]} for i in range(50)]).mapInArrow(counted, "page_no long, payload string")
    assert require_valid(fine, "coingecko").count() == 50
    assert reads.value == 50


def test_a_large_pull_is_no_single_task(spark, tmp_path):
    """100,000 pages of one pull: no exchange to one partition, and files from many tasks."""
    before, after = json.dumps({"coins": [coin("c", 1.0)]}).split("The c")
    name = F.concat(F.md5(F.col("id").cast("string")), F.sha2(F.col("id").cast("string"), 256))
    texts = spark.range(100_000).select(F.col("id").alias("page_no"), F.concat(F.lit(before), name, F.lit(after)).alias("payload"))
    landed = envelopes(stamp(require_valid(texts, "coingecko"), "coingecko", "2031-01-01"), page_count=100_000)
    plan = landed._jdf.queryExecution().executedPlan().toString()
    assert "SinglePartition" not in plan and "Window" not in plan
    # A large pull is one beyond the advised size of a task.
    spark.conf.set("spark.sql.adaptive.advisoryPartitionSizeInBytes", "256k")
    try:
        land_payloads(texts, "coingecko", "2031-01-01", f"{tmp_path}/bronze")
    finally:
        spark.conf.unset("spark.sql.adaptive.advisoryPartitionSizeInBytes")
    documents = read_landed(spark, "coingecko", f"{tmp_path}/bronze")
    assert documents.count() == 200
    assert documents.agg(F.sum(F.size("pages")), F.min("page_count"), F.max("page_count")).first()[:] == (100_000,) * 3
    tasks = {f.name.split("-")[1] for f in (tmp_path / "bronze").rglob("part-*.json")}
    assert len(tasks) > 1


def test_pulls_side_by_side_are_counted_apart(spark):
    schema = schemas.struct(schemas.PAGES["world_bank"])
    rows = [("world_bank", None if i % 3 == 0 else "2031-01-01", "t", i, annual_page(annual("AAA", str(2000 + i), 1.0))) for i in range(9)]
    pages = spark.createDataFrame(rows, f"source string, logical_date string, fetched_at string, page_no int, page {schema.simpleString()}")
    got = {(r["logical_date"], tuple(r["page_numbers"])): r["page_count"] for r in envelopes(pages, per_envelope=4).collect()}
    assert got == {(None, (0, 3)): 3, (None, (6,)): 3, ("2031-01-01", (1, 2)): 6, ("2031-01-01", (4, 5, 7)): 6, ("2031-01-01", (8,)): 6}
