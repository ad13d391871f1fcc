import json

import pytest
from pyspark.sql import functions as F

from payloads import annual, annual_page, article, coin, news_page, rates_page
from tidemark.plans.silver import to_silver
from tidemark.sources.bronze import (
    completeness, envelopes, read_bronze, read_landed, write_bronze,
)
from tidemark.sources.contracts import ContractError, check_payloads, require_valid, split_payloads
from tidemark.sources.registry import UnknownSourceError, get_source
from tidemark.sources.silver import read_silver, write_silver
from tidemark.sources import storage
from tidemark.sources.storage import (
    Snapshots, partition_values, size_shuffles, stored_bytes, visible_as,
)
from tidemark.session import object_store_settings, shared_dir
from tidemark.streaming.landing import land_candidates, silver_from_candidates


def document(source, day, hour, *pages):
    return {
        "source": source, "logical_date": f"{day}T00:00:00+00:00",
        "fetched_at": f"{day}T{hour:02d}:00:00+00:00", "page_count": len(pages), "pages": list(pages),
    }


def test_multi_line_documents_of_many_days(spark, tmp_path):
    for day, price in (("2026-07-19", 1.0), ("2026-07-20", 2.0)):
        folder = tmp_path / "coingecko" / day
        folder.mkdir(parents=True)
        page = {"coins": [{**coin("bitcoin", price), "unmodelled": {"x": [1]}}]}
        text = json.dumps(document("coingecko", day, 1, page), indent=2)
        (folder / "coingecko.json").write_text(text)
    docs = read_bronze(spark, "coingecko", f"{tmp_path}/coingecko/*/coingecko.json")
    assert docs.count() == 2
    assert "unmodelled" not in docs.schema["pages"].dataType.simpleString()
    got = {r["logical_date"].day: r["price_usd"] for r in to_silver(docs, "coingecko").collect()}
    assert got == {19: 1.0, 20: 2.0}


def test_rates_are_read_as_a_map(spark, tmp_path):
    (tmp_path / "a.json").write_text(json.dumps(
        document("exchange_rate", "2026-07-20", 1, rates_page("USD", UGX=3700, EUR=0.92))))
    rows = to_silver(read_bronze(spark, "exchange_rate", str(tmp_path)), "exchange_rate")
    assert {r["currency"]: r["rate"] for r in rows.collect()} == {"UGX": 3700.0, "EUR": 0.92}


def landed_pages(spark, day, prices):
    schema = get_source("coingecko").bronze_schema["pages"].dataType.elementType
    rows = [
        ("coingecko", f"{day}T00:00:00+00:00", f"{day}T01:00:00+00:00", i, {"coins": [coin(f"c{i}", p)]})
        for i, p in enumerate(prices)
    ]
    from pyspark.sql import types as T

    fields = [T.StructField(n, T.StringType()) for n in ("source", "logical_date", "fetched_at")]
    fields += [T.StructField("page_no", T.IntegerType()), T.StructField("page", schema)]
    return spark.createDataFrame(rows, T.StructType(fields))


def test_envelope_keeps_page_order_and_splits_long_days(spark):
    pages = landed_pages(spark, "2026-07-20", [float(i) for i in range(7)])
    (whole,) = envelopes(pages).collect()
    assert whole["page_count"] == 7
    assert [p["coins"][0]["current_price"] for p in whole["pages"]] == [float(i) for i in range(7)]
    parts = envelopes(pages, per_envelope=3).collect()
    assert sorted((p["page_count"], len(p["pages"])) for p in parts) == [(7, 1), (7, 3), (7, 3)]


def test_landing_a_day_again_replaces_it(spark, tmp_path):
    path = str(tmp_path / "bronze")
    write_bronze(envelopes(landed_pages(spark, "2026-07-19", [1.0, 2.0])), path)
    write_bronze(envelopes(landed_pages(spark, "2026-07-20", [3.0])), path)
    write_bronze(envelopes(landed_pages(spark, "2026-07-20", [4.0])), path)
    day = read_landed(spark, "coingecko", path, day="2026-07-20")
    assert [r["price_usd"] for r in to_silver(day, "coingecko").collect()] == [4.0]
    assert to_silver(read_landed(spark, "coingecko", path), "coingecko").count() == 3
    scan = day._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull(feed" in scan and "day" in scan


@pytest.mark.parametrize("source, pages, expected", [
    ("world_bank", [annual_page(annual("UGA", "2022", 1.0), pages=3)] * 2, (2, 3, False)),
    ("world_bank", [annual_page(pages=1)], (1, 1, True)),
    ("coingecko", [{"coins": [coin(f"c{i}", 1.0) for i in range(100)]}], (1, 2, False)),
    ("coingecko", [{"coins": [coin("a", 1.0)]}], (1, 1, True)),
    ("coingecko", [{"coins": [coin(f"c{i}", 1.0) for i in range(100)]}] * 3, (3, 4, False)),
    ("newsapi", [news_page(article("u", "t"), total=900)], (1, 9, False)),
    ("exchange_rate", [rates_page("USD", UGX=1.0)], (1, 1, True)),
])
def test_completeness(documents, source, pages, expected):
    (row,) = completeness(documents(source, ("2026-07-20", 1, *pages)), source).collect()
    assert (row["pages_landed"], row["pages_expected"], row["complete"]) == expected


def test_completeness_of_a_pull_that_was_told_where_to_stop(documents):
    full = {"coins": [coin(f"c{i}", 1.0) for i in range(100)]}
    docs = documents("coingecko", ("2026-07-20", 1, full, full))
    (row,) = completeness(docs, "coingecko", max_pages=2).collect()
    assert (row["pages_expected"], row["complete"]) == (2, True)


def test_files_of_many_documents_and_of_other_sources(spark, tmp_path):
    """Documents over several lines, one per line, and several to a file; the other feed stays out."""
    first = [document("coingecko", f"2026-07-{d}", 1, {"coins": [coin(f"c{d}", 1.0)]}) for d in (11, 12, 13)]
    (tmp_path / "a.json").write_text("\n".join(json.dumps(d) for d in first))
    (tmp_path / "b.json").write_text("\n".join(json.dumps(d, indent=1) for d in first[:2]) + "\n")
    (tmp_path / "c.json").write_text(json.dumps(document("exchange_rate", "2026-07-11", 1, rates_page("A", B=1.0))))
    found = read_bronze(spark, "coingecko", str(tmp_path))
    assert sorted(str(r["logical_date"]) for r in found.collect()) == sorted(["2026-07-11", "2026-07-12"] * 2 + ["2026-07-13"])


def test_landed_pages_beyond_an_envelope_all_arrive(spark, tmp_path):
    path = str(tmp_path / "bronze")
    write_bronze(envelopes(landed_pages(spark, "2026-07-20", [1.0] * 1200)), path)
    for read in (read_bronze, read_landed):
        assert to_silver(read(spark, "coingecko", path), "coingecko").count() == 1200


def payloads(spark, *texts):
    return spark.createDataFrame([(i, t) for i, t in enumerate(texts)], "id int, payload string")


def test_two_element_list_becomes_a_page(spark):
    record = annual("UGA", "2023", "1.5")
    meta = {"page": 1, "pages": 2, "per_page": "50", "total": 9}
    got = check_payloads(payloads(
        spark, json.dumps([meta, [record]]), json.dumps([meta, None]),
        json.dumps({"meta": meta, "records": [record]})), "world_bank").orderBy("id").collect()
    assert [r["problems"] for r in got] == [[], [], []]
    assert got[0]["page"]["meta"]["per_page"] == 50
    assert got[0]["page"]["records"][0]["value"] == 1.5
    assert got[0]["page"]["records"][0]["unit"] == "" and got[0]["page"]["records"][0]["decimal"] == 0
    assert got[1]["page"]["records"] == []
    assert got[2]["page"] == got[0]["page"]


def test_bare_list_becomes_coins(spark):
    valid, bad = split_payloads(payloads(
        spark, json.dumps([{**coin("bitcoin", 5), "extra": 1}]), json.dumps([coin("bitcoin", "abc")]),
        json.dumps([{k: v for k, v in coin("x", 1.0).items() if k != "symbol"}]), "[oops"), "coingecko")
    (row,) = valid.collect()
    assert row["page"]["coins"][0]["current_price"] == 5.0
    assert "extra" not in row["page"]["coins"][0].asDict()
    found = {r["id"]: r["problems"] for r in bad.collect()}
    assert found == {
        1: ["coins[].current_price: not a number"],
        2: ["coins[].symbol: missing"],
        3: ["payload: not a JSON document of the expected shape"],
    }


@pytest.mark.parametrize("source, payload, problem", [
    ("exchange_rate", {"result": "ok", "base_code": "USD"}, "rates: missing"),
    ("exchange_rate", {"result": "ok", "base_code": "USD", "rates": {"A": None}}, "rates{}: missing"),
    ("open_meteo", {"latitude": 1, "longitude": 2, "daily": {}}, "daily.time: missing"),
    ("open_meteo", {"latitude": "north", "longitude": 2, "daily": {"time": []}}, "latitude: not a number"),
    ("newsapi", {"status": "ok", "totalResults": 1.5, "articles": []}, "totalResults: not a number"),
    ("newsapi", news_page({**article("u", "t"), "source": {"id": "x"}}), "articles[].source.name: missing"),
])
def test_breaches_are_named(spark, source, payload, problem):
    (row,) = check_payloads(payloads(spark, json.dumps(payload)), source).collect()
    assert row["problems"] == [problem]


def test_optional_and_extra_fields_are_allowed(spark):
    weather = {"latitude": 1, "longitude": 2, "elevation": 9, "daily": {"time": ["2026-07-20"]}}
    assert require_valid(payloads(spark, json.dumps(weather)), "open_meteo").count() == 1


def test_strict_check_raises_with_counts(spark):
    with pytest.raises(ContractError, match=r"rates: missing \(2\)"):
        bad = json.dumps({"result": "ok", "base_code": "USD"})
        require_valid(payloads(spark, bad, bad), "exchange_rate")
    with pytest.raises(UnknownSourceError):
        check_payloads(payloads(spark, "{}"), "nope")


def test_silver_full_refresh_clears_days_that_moved(spark, silver, tmp_path):
    from datetime import date

    path = str(tmp_path / "silver")
    row = lambda day, price: ("bitcoin", "btc", "B", price, 1.0, 1.0, 0.0, None, day)
    old = silver("coingecko", row(date(2026, 7, 19), 1.0), row(date(2026, 7, 20), 2.0))
    write_silver(old, path, ["logical_date"], full_refresh=True)
    new = silver("coingecko", row(date(2026, 7, 20), 9.0))
    write_silver(new, path, ["logical_date"])
    got = {r["logical_date"].day: r["price_usd"] for r in read_silver(spark, "coingecko", path).collect()}
    assert got == {19: 1.0, 20: 9.0}
    write_silver(new, path, ["logical_date"], full_refresh=True)
    assert partition_values(spark, path, "logical_date") == ["2026-07-20"]


def test_snapshots_keep_the_last_finished(spark, tmp_path):
    schema = spark.createDataFrame([], "a int").schema
    table = Snapshots(spark, str(tmp_path / "t"), schema)
    assert table.read().count() == 0
    for n in range(1, 5):
        table.replace(table.read().unionByName(spark.createDataFrame([(n,)], schema)))
    assert sorted(r["a"] for r in table.read().collect()) == [1, 2, 3, 4]
    assert len(list((tmp_path / "t").glob("v-*"))) == 2
    unfinished = tmp_path / "t" / "v-000000099"
    unfinished.mkdir()
    assert table.read().count() == 4


def test_stream_takes_in_only_what_is_new(spark, tmp_path):
    bronze, flat, state = (str(tmp_path / n) for n in ("bronze", "flat", "state"))
    write_bronze(envelopes(landed_pages(spark, "2026-07-19", [1.0, 2.0])), bronze)
    land_candidates(spark, "coingecko", bronze, flat, state)
    land_candidates(spark, "coingecko", bronze, flat, state)
    assert len(partition_values(spark, flat, "batch")) == 1
    write_bronze(envelopes(landed_pages(spark, "2026-07-20", [3.0])), bronze)
    land_candidates(spark, "coingecko", bronze, flat, state)
    assert spark.read.parquet(flat).count() == 3
    streamed = silver_from_candidates(spark, "coingecko", flat, bronze)
    batch = to_silver(read_landed(spark, "coingecko", bronze), "coingecko")
    assert sorted(map(str, streamed.collect())) == sorted(map(str, batch.collect()))
    assert silver_from_candidates(spark, "newsapi", str(tmp_path / "none")).count() == 0


def test_day_landed_again_replaces_its_streamed_rows(spark, tmp_path):
    bronze, flat, state = (str(tmp_path / n) for n in ("bronze", "flat", "state"))
    write_bronze(envelopes(landed_pages(spark, "2026-07-20", [1.0, 2.0, 3.0])), bronze)
    land_candidates(spark, "coingecko", bronze, flat, state)
    later = landed_pages(spark, "2026-07-20", [9.0]).withColumn(
        "fetched_at", F.lit("2026-07-20T09:00:00+00:00"))
    write_bronze(envelopes(later), bronze)
    land_candidates(spark, "coingecko", bronze, flat, state)
    (row,) = silver_from_candidates(spark, "coingecko", flat, bronze).collect()
    assert row["price_usd"] == 9.0


def test_frame_is_visible_for_a_block_only(spark):
    with visible_as(spark.range(3), "batch_rows") as name:
        assert spark.sql(f"select count(*) from {name}").first()[0] == 3
    assert not spark.catalog.tableExists("batch_rows")


def test_shuffles_grow_with_the_input(spark, tmp_path, monkeypatch):
    (tmp_path / "a").mkdir()
    (tmp_path / "a" / "x").write_bytes(b"0" * 5000)
    before = spark.conf.get("spark.sql.shuffle.partitions")
    assert stored_bytes(spark, f"{tmp_path}/*/") == 5000
    assert size_shuffles(spark, str(tmp_path)) == int(before)
    monkeypatch.setattr(storage, "SHUFFLE_BYTES", 100)
    assert size_shuffles(spark, f"{tmp_path}/*") == 50
    spark.conf.set("spark.sql.shuffle.partitions", before)


def test_object_store_settings_come_from_the_environment():
    assert object_store_settings({}) == {}
    got = object_store_settings({"AWS_ENDPOINT_URL": "http://store:9000", "AWS_ACCESS_KEY_ID": "k"})
    assert got["spark.hadoop.fs.s3a.endpoint"] == "http://store:9000"
    assert got["spark.hadoop.fs.s3a.path.style.access"] == "true"
    assert got["spark.hadoop.fs.s3a.connection.ssl.enabled"] == "false"


def test_shared_folder_is_the_one_the_session_names(spark):
    assert shared_dir(spark) == spark.conf.get("spark.checkpoint.dir").rstrip("/")


def test_session_settings(spark):
    assert spark.conf.get("spark.sql.session.timeZone") == "UTC"
    assert spark.range(1).select(F.current_timezone()).first()[0] == "UTC"
