"""Serving, charts, forecasts and the registry over one loaded warehouse."""

from datetime import date, datetime

import numpy as np
import pytest
from pyspark.sql import functions as F

from tidemark.plans import charts, forecast, serving, views
from tidemark.plans.warehouse import Warehouse

D = date(2026, 7, 20)
NAMES = {"UGA": "Uganda", "KEN": "Kenya", "WLD": "World", "LIC": "Low income", "AFE": "Africa Eastern"}


@pytest.fixture(scope="module")
def wh(spark, tmp_path_factory):
    from tidemark.sources.registry import get_source

    w = Warehouse(spark, str(tmp_path_factory.mktemp("read") / "warehouse"))
    w.create_schema()

    def load(source, rows):
        w.load(source, spark.createDataFrame(rows, get_source(source).silver_schema))

    gdp = {"UGA": 3.7e10, "KEN": 1.1e11, "WLD": 9e13, "LIC": 5e11, "AFE": 1e12}
    load("world_bank", [
        (iso, NAMES[iso], "NY.GDP.MKTP.CD", 2020 + i, base * 1.05 ** i, 0.05, D)
        for iso, base in gdp.items() for i in range(4)])
    load("world_bank_inflation", [
        (iso, NAMES[iso], "FP.CPI.TOTL.ZG", 2020 + i, base + (i * i) % 3, 1.0, D)
        for iso, base in (("UGA", 4.0), ("KEN", 6.1)) for i in range(4)])
    load("exchange_rate", [
        ("USD", cur, base + i * step, None, date(2026, 7, 10 + i))
        for cur, base, step in (("UGX", 3700.0, 3.0), ("EUR", 0.92, 0.001)) for i in range(8)])
    load("coingecko", [
        (c, c[:3], c.title(), base + (i * 7 % 5) * 10, 1.0, 2.0, 0.5, 0.1 * i, date(2026, 7, 10 + i))
        for c, base in (("bitcoin", 65000.0), ("ethereum", 3200.0), ("obscure", 2.0)) for i in range(8)])
    load("open_meteo", [
        (date(2026, 7, d), 0.3476, 32.5825, 20.0 + d % 5, 18.0, float(d % 3), 1.0, 0.0, D) for d in range(1, 21)])
    load("newsapi", [
        ("Reuters", "a", "Inflation cools", "d", "u1", datetime(2026, 7, 20), 2, D),
        (None, "a", "Rates rise 100%", "d", "u2", datetime(2026, 7, 20), 2, D),
        ("Reuters", "a", "Old news", "d", "u0", datetime(2026, 7, 1), 1, date(2026, 7, 1))])
    return w


def test_country_search(wh):
    assert [r["country_iso3"] for r in serving.list_countries(wh, search="UGAN").items.collect()] == ["UGA"]
    assert serving.list_countries(wh, search="ken").envelope()["items"] == [
        {"country_iso3": "KEN", "country_name": "Kenya"}]
    assert serving.list_countries(wh, search="%").total() == 5
    assert serving.list_countries(wh, search="").total() == 5


def test_total_counts_all_matches(wh):
    page = serving.list_gdp(wh, limit=2, offset=1).envelope()
    assert (page["total"], page["limit"], page["offset"], len(page["items"])) == (20, 2, 1, 2)
    assert [r["year"] for r in page["items"]] == [2023, 2023]
    assert [r["country_iso3"] for r in page["items"]] == ["KEN", "LIC"]


def test_filters_do_not_cut_history(wh):
    first = serving.list_gdp(wh, country="uga", year_min=2022, indicator_id="NY.GDP.MKTP.CD").items.collect()
    assert [r["year"] for r in first] == [2023, 2022]
    assert first[1]["lag1_gdp_usd"] == pytest.approx(3.7e10 * 1.05)


def test_other_lists(wh):
    assert serving.list_inflation(wh, country="ken", year_max=2021).total() == 2
    rates = serving.list_exchange_rates(wh, base="usd", quote="ugx", date_from=date(2026, 7, 16))
    assert [r["date"].day for r in rates.items.collect()] == [17, 16]
    assert serving.list_crypto(wh, coin_id="BITCOIN", date_to=date(2026, 7, 12)).total() == 3
    assert serving.list_weather(wh, latitude=0.3476, longitude=32.5825, limit=3).total() == 20
    assert serving.list_weather(wh, latitude=0.3).total() == 0
    assert [r["url"] for r in serving.list_news(wh, q="INFLATION").items.collect()] == ["u1"]
    assert [r["url"] for r in serving.list_news(wh, source="Reuters").items.collect()] == ["u1", "u0"]
    assert serving.list_news(wh, date_from=D).total() == 2


def test_latest_rows(wh):
    assert serving.latest_gdp_row(wh, "uga").first()["year"] == 2023
    assert serving.latest_inflation_row(wh, "zzz").first() is None
    assert serving.latest_exchange_rate_row(wh, "usd", "eur").first()["date"] == date(2026, 7, 17)
    assert serving.latest_crypto_row(wh, "Ethereum").first()["lag1_price_usd"] is not None
    batch = serving.latest_rows(views.view_crypto(wh), ["coin_id"], "date").collect()
    assert {(r["coin_id"], r["date"].day) for r in batch} == {(c, 17) for c in ("bitcoin", "ethereum", "obscure")}


def test_job_that_never_ran_is_listed(spark):
    jobs = spark.createDataFrame([("a",), ("b",)], "job_id string")
    runs = spark.createDataFrame(
        [("a", "r1", "failed", datetime(2026, 1, 1)), ("a", "r2", "success", datetime(2026, 1, 2)),
         ("x", "r3", "success", datetime(2026, 1, 3))],
        "job_id string, run_id string, state string, execution_date timestamp",
    ).withColumns({"start_date": F.col("execution_date"), "end_date": F.col("execution_date")})
    got = {r["job_id"]: r["state"] for r in serving.latest_runs(jobs, runs).collect()}
    assert got == {"a": "success", "b": None}


def test_country_groups_are_left_out(wh):
    bars = charts.chart(wh, "gdp_bar").collect()
    assert [r["country_name"] for r in bars] == ["Kenya", "Uganda"]
    lines = charts.chart(wh, "gdp_line").collect()
    assert {r["country_name"] for r in lines} == {"Kenya", "Uganda"} and len(lines) == 8


def test_series_limit_keeps_whole_series(wh):
    from dataclasses import replace

    one = replace(charts.CHARTS["gdp_line"], series_limit=1)
    got = charts.render(one, views.view_gdp(wh)).collect()
    assert {r["country_name"] for r in got} == {"Kenya"} and len(got) == 4


def test_only_major_coins_and_currencies(wh):
    assert {r["coin_id"] for r in charts.chart(wh, "crypto_bar").collect()} == {"bitcoin", "ethereum"}
    assert [r["currency"] for r in charts.chart(wh, "exchange_bar").collect()] == ["EUR"]
    assert charts.chart(wh, "exchange_line").count() == 8
    clicked = charts.chart(wh, "crypto_line", coin_id="bitcoin").collect()
    assert {r["coin_id"] for r in clicked} == {"bitcoin"}


def test_weather_charts(wh):
    bar = charts.chart(wh, "weather_bar").collect()
    days = [r["date"] for r in bar]
    assert len(days) == 20 and days == sorted(days)
    assert charts.chart(wh, "weather_bar", limit=3).collect() == bar[:3]
    assert charts.chart(wh, "weather_line").columns == ["date", "avg_temp_max_c", "Avg Precipitation (mm)"]
    bubble = charts.chart(wh, "weather_scatter").first()
    assert bubble["avg_longitude"] == pytest.approx(32.5825)


@pytest.mark.parametrize("name", [n for n, c in charts.CHARTS.items() if c.columns])
def test_tables_ascend_by_time_and_page(wh, name):
    spec = charts.CHARTS[name]
    whole = charts.chart(wh, name).collect()
    times = [r[spec.order[0]] for r in whole]
    assert times == sorted(times) and list(whole[0].asDict()) == list(spec.columns)
    assert charts.raw_table_page(wh, name, 0, size=3).collect() == whole[:3]


def test_new_filter_starts_at_the_first_page(wh):
    page = serving.list_gdp(wh, limit=3, offset=6)
    assert page.total() == 20
    first = page.narrowed(("KEN", lambda v: F.col("country_iso3") == v))
    assert (first.offset, first.limit, first.total()) == (0, 3, 4)


def test_dataset_roles(wh):
    roles = charts.DATASETS["crypto"].roles(wh)
    assert roles["time"] == ["date"] and roles["group"] == ["coin_id", "symbol", "name"]
    assert "price_7d_avg_usd" in roles["measure"]
    assert charts.DATASETS["gdp"].roles(wh)["time"] == []


def test_filter_values_and_explore(wh):
    assert [r[0] for r in charts.filter_values(wh, "crypto", "coin_id").collect()] == [
        "bitcoin", "ethereum", "obscure"]
    assert charts.explore(wh, "crypto", coin_id="", symbol=None).count() == 24
    assert charts.explore(wh, "crypto", coin_id="obscure").count() == 8


@pytest.mark.parametrize("domain, train_rows, test_rows", [
    ("gdp", 10, 5), ("inflation", 4, 2), ("exchange_rate", 12, 2), ("crypto", 18, 3)])
def test_training_split_and_metrics(wh, domain, train_rows, test_rows):
    spec = forecast.get_forecast(domain)
    got = forecast.train(spec.view(wh), spec)
    assert (got.train_rows, got.test_rows) == (train_rows, test_rows)
    assert 0 <= got.metrics["mae"] <= got.metrics["rmse"]
    assert got.params["features"] == ",".join(spec.features)
    log = domain != "inflation"
    assert got.params["model_type"] == ("log_linear_regression" if log else "linear_regression")


def test_too_little_history(spark, tmp_path, silver):
    w = Warehouse(spark, str(tmp_path / "w"))
    w.create_schema()
    spec = forecast.get_forecast("gdp")
    with pytest.raises(forecast.InsufficientDataError):
        forecast.train(spec.view(w), spec)
    w.load("world_bank", silver("world_bank", *[
        ("UGA", "Uganda", "I", 2020 + i, 1.0 + i, None, D) for i in range(3)]))
    with pytest.raises(forecast.InsufficientDataError, match="2 usable"):
        forecast.train(spec.view(w), spec)


def numpy_forecast(wh, coin_id):
    """The same pooled log-scale fit over collected rows."""
    rows = views.view_crypto(wh).toPandas().sort_values("date").dropna(subset=["lag1_price_usd"])
    latest = rows.groupby("coin_id").tail(1)
    known = rows.drop(latest.index)
    x = np.column_stack([np.ones(len(known)), np.log1p(known[["lag1_price_usd", "price_7d_avg_usd"]])])
    fit = np.linalg.lstsq(x, np.log1p(known["price_usd"]), rcond=None)[0]
    row = latest[latest["coin_id"] == coin_id].iloc[0]
    scaled = fit @ [1.0, np.log1p(row["lag1_price_usd"]), np.log1p(row["price_7d_avg_usd"])]
    return np.expm1(scaled)


def test_train_register_deploy_predict(wh, spark, tmp_path):
    registry = forecast.Registry(spark, str(tmp_path / "registry"))
    assert forecast.predict(wh, registry, "crypto", coin_id="bitcoin")["status"] == "no_champion"
    first = forecast.train_register_deploy(wh, registry, "crypto")
    assert first["version"] == 1 and first["promoted"]
    again = forecast.train_register_deploy(wh, registry, "crypto")
    assert again["version"] == 2 and not again["promoted"]
    answer = forecast.predict(wh, registry, "crypto", coin_id="BitCoin")
    assert answer["status"] == "ok" and answer["model_version"] == 1
    assert answer["predicted_value"] == pytest.approx(numpy_forecast(wh, "bitcoin"), rel=1e-6)
    assert set(answer["based_on"]) == {"lag1_price_usd", "price_7d_avg_usd"}
    assert forecast.predict(wh, registry, "crypto", coin_id="nope")["status"] == "no_data"
    (listed,) = registry.listing().collect()
    assert (listed["name"], listed["latest_version"], listed["champion_version"]) == ("crypto_forecast", 2, 1)
    assert listed["metrics"]["mae"] == pytest.approx(first["mae"])
    with pytest.raises(forecast.UnknownDomainError, match="gdp"):
        forecast.predict(wh, registry, "weather")
    with pytest.raises(forecast.MissingParameterError, match="quote"):
        forecast.predict(wh, registry, "exchange_rate", base="usd")


def test_registering_does_not_promote_and_gate_is_strict(wh, spark, tmp_path):
    registry = forecast.Registry(spark, str(tmp_path / "registry"))
    spec = forecast.get_forecast("crypto")
    result = forecast.train(spec.view(wh), spec)
    from dataclasses import replace

    run = registry.log_run(replace(result, metrics={"mae": 2.0, "rmse": 2.0}))
    version = registry.register(spec.model, run)
    assert registry.champion(spec.model) is None
    (listed,) = registry.listing().collect()
    assert listed["champion_version"] is None and listed["metrics"] == {}
    assert registry.should_promote(spec.model, 99.0)
    registry.promote(spec.model, version)
    assert registry.should_promote(spec.model, 1.5)
    assert not registry.should_promote(spec.model, 2.0)
    assert not registry.should_promote(spec.model, 2.5)


def test_promotion_decisions(spark):
    candidates = spark.createDataFrame([("a", 2, 1.5), ("a", 3, 2.5), ("b", 1, 9.0)], "model string, version int, mae double")
    champions = spark.createDataFrame([("a", 2.0)], "model string, champion_mae double")
    got = {(r["model"], r["version"]): r["promote"]
           for r in forecast.promotion_decisions(candidates, champions).collect()}
    assert got == {("a", 2): True, ("a", 3): False, ("b", 1): True}


def test_batch_scores_say_why_there_is_none(wh, spark, silver, tmp_path):
    w = Warehouse(spark, str(tmp_path / "w"))
    w.create_schema()
    w.load("coingecko", silver("coingecko", ("new", "n", "New", 1.0, 1.0, 1.0, 0.0, None, D)))
    spec = forecast.get_forecast("crypto")
    (row,) = forecast.score_latest(spec.view(w), spec, None).collect()
    assert (row["status"], row["predicted_value"]) == ("not_enough_history", None)
    rows = forecast.score_latest(spec.view(wh), spec, None).collect()
    assert {r["status"] for r in rows} == {"no_champion"} and len(rows) == 3


def test_overview(wh, spark):
    models = spark.createDataFrame(
        [("a", 1), ("b", None)], "name string, champion_version int")
    got = {r["card"]: (r["entity"], r["value"]) for r in charts.overview_cards(wh, models).collect()}
    assert got["countries"] == ("all", 5.0)
    assert got["latest_rate"][0] == "USD/EUR"
    assert got["latest_price"][0] == "BIT"
    assert got["champions"] == ("of 2", 1.0)
