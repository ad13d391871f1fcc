import json
from datetime import date, datetime

import pytest

from payloads import annual, annual_page, coin, rates_page
from tidemark.operators.quality import ValidationFailedError
from tidemark.plans import forecast, jobs, views
from tidemark.plans.silver import snapshot_silver
from tidemark.plans.warehouse import Warehouse
from tidemark.sources.bronze import read_landed
from tidemark.sources.contracts import ContractError
from tidemark.sources.registry import UnknownSourceError
from tidemark.sources.silver import read_silver, write_silver


def land(root, source, day, hour, *pages):
    folder = root / source / day
    folder.mkdir(parents=True, exist_ok=True)
    (folder / f"{source}.json").write_text(json.dumps({
        "source": source, "logical_date": f"{day}T00:00:00+00:00",
        "fetched_at": f"{day}T{hour:02d}:00:00+00:00", "page_count": len(pages), "pages": list(pages)}))


@pytest.fixture
def paths(tmp_path):
    return {n: str(tmp_path / n) for n in ("silver", "warehouse", "registry")}


def test_chain_of_one_source(spark, tmp_path, paths):
    bronze = tmp_path / "bronze"
    for i in range(8):
        land(bronze, "coingecko", f"2026-07-{10 + i}", 1, {"coins": [
            coin("bitcoin", 65000.0 + i, 1.0), coin("ethereum", 3200.0 + 2 * i)]})
    glob = f"{bronze}/coingecko/*/"
    wh = jobs.run_source(spark, "coingecko", glob, paths["silver"], paths["warehouse"])
    assert views.view_crypto(wh).count() == 16
    land(bronze, "coingecko", "2026-07-17", 9, {"coins": [coin("bitcoin", 1.0)]})
    wh = jobs.run_source(spark, "coingecko", glob, paths["silver"], paths["warehouse"])
    got = {(r["coin_id"], r["date"].day): r["price_usd"] for r in views.view_crypto(wh).collect()}
    assert got["bitcoin", 17] == 1.0 and got["ethereum", 17] == 3214.0 and len(got) == 16
    outcome = jobs.validate_silver(spark, "coingecko", paths["silver"])
    assert outcome.success and outcome.total == 8
    train = ["train", "--domain", "crypto", "--warehouse", paths["warehouse"]]
    assert jobs.main([*train, "--registry", paths["registry"]]) == 0
    (listed,) = forecast.Registry(spark, paths["registry"]).listing().collect()
    assert (listed["name"], listed["champion_version"]) == ("crypto_forecast", 1)


def test_landing_checks_wraps_and_replaces(spark, tmp_path):
    path = str(tmp_path / "bronze")

    def pull(*coins):
        rows = [(i, json.dumps([c])) for i, c in enumerate(coins)]
        return spark.createDataFrame(rows, "page_no int, payload string")

    jobs.land_payloads(pull(coin("a", 1.0), coin("b", 2.0)), "coingecko", "2026-07-20", path)
    jobs.land_payloads(pull(coin("a", "3.5")), "coingecko", "2026-07-20", path)
    (document,) = read_landed(spark, "coingecko", path).collect()
    assert document["page_count"] == 1
    assert document["pages"][0]["coins"][0]["current_price"] == 3.5
    assert datetime.fromisoformat(document["fetched_at"]).tzinfo is not None
    with pytest.raises(ContractError):
        jobs.land_payloads(pull({**coin("x", 1.0), "id": None}), "coingecko", "2026-07-21", path)
    with pytest.raises(UnknownSourceError):
        jobs.land_payloads(pull(), "nope", "2026-07-21", path)


def test_load_since_a_day(spark, silver, paths):
    rows = [("USD", "UGX", float(d), None, date(2026, 7, d)) for d in (1, 2, 3)]
    write_silver(silver("exchange_rate", *rows), paths["silver"], ["logical_date"])
    load = (spark, "exchange_rate", paths["silver"], paths["warehouse"])
    wh = jobs.load_silver(*load, since=date(2026, 7, 2))
    assert [r["date"].day for r in views.view_exchange_rate(wh).orderBy("date").collect()] == [2, 3]
    assert views.view_exchange_rate(jobs.load_silver(*load)).count() == 3


def test_gate_stops_the_load(spark, silver, paths):
    day = date(2026, 7, 20)
    bad = silver("exchange_rate", ("USD", "UGX", -1.0, None, day))
    write_silver(bad, paths["silver"], ["logical_date"])
    with pytest.raises(ValidationFailedError):
        jobs.load_silver(spark, "exchange_rate", paths["silver"], paths["warehouse"])
    wh = Warehouse(spark, paths["warehouse"])
    assert wh.table("fact_exchange_rate").count() == 0
    wh = jobs.load_silver(spark, "exchange_rate", paths["silver"], paths["warehouse"], gate=False)
    assert wh.table("fact_exchange_rate").count() == 1


def test_command_line_exit_codes(spark, silver, tmp_path, paths, capsys):
    land(tmp_path / "bronze", "world_bank", "2026-07-20", 1, annual_page(annual("UGA", "2023", 1.0)))
    glob = f"{tmp_path}/bronze/world_bank/*/"
    run = ["--source", "world_bank", "--bronze-path", glob, "--silver-path", paths["silver"]]
    assert jobs.main(["silver", *run]) == 0
    assert read_silver(spark, "world_bank", paths["silver"]).first()["year"] == 2023
    check = ["validate", "--source", "world_bank", "--path", paths["silver"]]
    assert jobs.main(check) == 0
    assert "9 expectations" in capsys.readouterr().out
    load = ["load", "--source", "world_bank", "--path", paths["silver"], "--warehouse", paths["warehouse"]]
    assert jobs.main(load) == 0
    bad = silver("world_bank", ("UGA", "Uganda", "I", 1800, 1.0, None, date(2026, 7, 20)))
    write_silver(bad, paths["silver"], ["year"])
    assert jobs.main(check) == 1
    assert jobs.main(load) == 1
    with pytest.raises(SystemExit):
        jobs.main(["validate", "--source", "nope", "--path", "x"])


def test_snapshots_go_on_after_a_failure(wh, documents):
    def broken():
        raise RuntimeError

    docs = documents("exchange_rate", ("2026-07-20", 1, rates_page("USD", UGX=3700.0, EUR=0.9)))
    gdp = documents("world_bank", ("2026-07-20", 1, annual_page(annual("UGA", "2023", 1.0))))
    status = jobs.load_snapshots(wh, {
        "exchange_rate": lambda: snapshot_silver(docs, "exchange_rate"),
        "coingecko": broken,
        "world_bank": lambda: snapshot_silver(gdp, "world_bank"),
    })
    assert [tuple(r) for r in status.collect()] == [
        ("exchange_rate", 2, None), ("coingecko", None, "RuntimeError()"), ("world_bank", 1, None)]
    assert wh.table("fact_exchange_rate").count() == 2
