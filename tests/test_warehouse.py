from datetime import date, datetime

import pytest

from tidemark.plans import views
from tidemark.plans.warehouse import FACTS, Warehouse, narrow_columns
from tidemark.sources.registry import UnknownSourceError

DAY = date(2026, 7, 20)


def gdp(iso3, year, value, growth=None, name=None):
    return (iso3, name or iso3.title(), "NY.GDP.MKTP.CD", year, value, growth, DAY)


def rate(currency, value, day=DAY, base="USD"):
    return (base, currency, value, None, day)


def weather(day, rain, tmax=28.0, lat=0.3476, lon=32.5825):
    return (day, lat, lon, tmax, 18.0, rain, rain, 0.0, DAY)


def crypto(coin, price, day=DAY, symbol="btc"):
    return (coin, symbol, coin.title(), price, 1.0, 2.0, 0.5, None, day)


def news(url, title, source="Reuters", day=DAY, count=1):
    return (source, "a", title, "d", url, datetime(2026, 7, 20, 8), count, day)


def test_schema_is_idempotent_and_empty(wh):
    wh.create_schema()
    for name in ("dim_date", "dim_country", *FACTS):
        assert wh.table(name).count() == 0


def test_unknown_source_and_table(wh, silver):
    with pytest.raises(UnknownSourceError):
        wh.load("nope", silver("world_bank"))
    with pytest.raises(ValueError, match="fact_gdp"):
        wh.table("fact_nope")


def test_reload_replaces_values_not_rows(wh, silver):
    first = silver("exchange_rate", rate("UGX", 3700.5), rate("EUR", 0.92))
    wh.load("exchange_rate", first)
    keys = {r["currency_code"]: r["currency_key"] for r in wh.table("dim_currency").collect()}
    wh.load("exchange_rate", silver("exchange_rate", rate("UGX", 3750.0), rate("KES", 129.0)))
    got = {r["currency"]: r["rate"] for r in views.view_exchange_rate(wh).collect()}
    assert got == {"UGX": 3750.0, "EUR": 0.92, "KES": 129.0}
    after = {r["currency_code"]: r["currency_key"] for r in wh.table("dim_currency").collect()}
    assert {k: after[k] for k in keys} == keys
    assert sorted(after.values()) == [1, 2, 3, 4]


def test_unknown_value_overwrites(wh, silver):
    wh.load("world_bank", silver("world_bank", gdp("UGA", 2022, 1.0, 0.5)))
    wh.load("world_bank", silver("world_bank", gdp("UGA", 2022, None, None)))
    (row,) = wh.table("fact_gdp").collect()
    assert (row["gdp_usd"], row["gdp_growth_rate"]) == (None, None)


def test_country_is_shared_and_renamed(wh, silver):
    wh.load("world_bank", silver("world_bank", gdp("UGA", 2022, 1.0, name="Old")))
    wh.load("world_bank_inflation", silver(
        "world_bank_inflation", ("UGA", "Uganda", "FP.CPI.TOTL.ZG", 2022, 5.0, None, DAY)))
    (country,) = wh.table("dim_country").collect()
    assert country["country_name"] == "Uganda"
    keys = {wh.table(f).first()["country_key"] for f in ("fact_gdp", "fact_inflation")}
    assert keys == {country["country_key"]}


def test_calendar_row(wh, silver):
    sunday = date(2026, 7, 19)
    wh.load("open_meteo", silver("open_meteo", weather(sunday, 0.0), weather(DAY, 4.2)))
    days = {r["date_key"]: r for r in wh.table("dim_date").collect()}
    row = days[20260719]
    assert (row["day_name"], row["day_of_week"], row["is_weekend"]) == ("Sunday", 0, True)
    assert (row["month_name"], row["quarter"], row["year"]) == ("July", 3, 2026)
    assert not days[20260720]["is_weekend"]
    assert wh.table("dim_location").count() == 1


def test_date_is_conformed(wh, silver):
    wh.load("coingecko", silver("coingecko", crypto("bitcoin", 65000.0)))
    wh.load("exchange_rate", silver("exchange_rate", rate("UGX", 3700.5)))
    assert wh.table("dim_date").count() == 1
    (row,) = views.drill_across(wh).collect()
    assert (row["avg_price_usd"], row["avg_rate"], row["coins"], row["pairs"]) == (65000.0, 3700.5, 1, 1)


def test_article_without_source_stays(wh, silver):
    wh.load("newsapi", silver("newsapi", news("u1", "t1"), news("u2", "t2", source=None)))
    assert wh.table("dim_news_source").count() == 1
    got = {r["url"]: r["source_name"] for r in views.view_news(wh).collect()}
    assert got == {"u1": "Reuters", "u2": None}


def test_article_moves_to_a_later_month_once(wh, silver):
    wh.load("newsapi", silver("newsapi", news("u1", "old", day=date(2026, 6, 30)),
                              news("u2", "stays", day=date(2026, 6, 1))))
    wh.load("newsapi", silver("newsapi", news("u1", "new")))
    got = {r["url"]: (r["title"], r["date"]) for r in views.view_news(wh).collect()}
    assert got == {"u1": ("new", DAY), "u2": ("stays", date(2026, 6, 1))}
    wh.load("newsapi", silver("newsapi", news("u2", "moved")))
    assert {r["url"] for r in wh.table("fact_news").collect()} == {"u1", "u2"}
    assert {r["date_key"] for r in wh.table("fact_news").collect()} == {20260720}


def test_only_touched_months_are_rewritten(wh, silver):
    wh.load("coingecko", silver("coingecko", crypto("bitcoin", 1.0, date(2026, 5, 1)), crypto("bitcoin", 2.0)))
    table = wh._fact(FACTS["fact_crypto"])
    before = table.state().of("rows")
    assert sorted(before) == [202605, 202607]
    wh.load("coingecko", silver("coingecko", crypto("bitcoin", 3.0)))
    after = table.state().of("rows")
    assert after[202605] == before[202605] and after[202607] != before[202607]
    got = {r["date"]: r["price_usd"] for r in views.view_crypto(wh).collect()}
    assert got == {date(2026, 5, 1): 1.0, DAY: 3.0}


def test_missing_grain_is_refused(wh, silver):
    with pytest.raises(Exception, match="date_key must not be null"):
        wh.load("exchange_rate", silver("exchange_rate", rate("UGX", 1.0, day=None)))


def test_integrity(wh, silver):
    wh.load("coingecko", silver("coingecko", crypto("bitcoin", 1.0)))
    assert {r["violations"] for r in wh.integrity("fact_crypto").collect()} == {0}
    broken = wh.table("fact_crypto").unionByName(wh.table("fact_crypto")).unionByName(
        wh.table("fact_crypto").selectExpr(
            "99 as coin_key", "date_key", "price_usd", "market_cap_usd", "volume_usd",
            "price_change_pct_24h", "volatility_7d"))
    wh.table = lambda name, real=wh.table: broken if name == "fact_crypto" else real(name)
    got = {(r["check"], r["column"]): r["violations"] for r in wh.integrity("fact_crypto").collect()}
    assert got["reference", "coin_key"] == 1
    assert got["unique", "coin_key,date_key"] == 1


def test_gdp_view_and_rollup(wh, silver):
    wh.load("world_bank", silver("world_bank", *[
        gdp("UGA", y, v) for y, v in ((2020, 3.7e10), (2021, 4.0e10), (2022, 4.4e10))]))
    got = views.view_gdp(wh).orderBy("year").collect()
    assert [r["lag1_gdp_usd"] for r in got] == [None, 3.7e10, 4.0e10]
    assert [r["gdp_3yr_avg_usd"] for r in got] == pytest.approx([3.7e10, 3.85e10, 12.1e10 / 3])


@pytest.mark.parametrize("values, cagr", [
    ([(2020, 100.0), (2021, 110.0), (2022, 121.0)], 0.1),
    ([(2020, 100.0), (2021, 121.0), (2022, None)], 0.1),
    ([(2020, 0.0), (2021, 5.0)], None),
    ([(2020, 5.0)], None),
    ([(2020, None), (2021, None)], None),
])
def test_growth_per_year(wh, silver, values, cagr):
    wh.load("world_bank", silver("world_bank", *[gdp("UGA", y, v) for y, v in values]))
    (row,) = views.agg_gdp_by_country(wh).collect()
    assert row["gdp_cagr"] == (None if cagr is None else pytest.approx(cagr))
    assert row["years_reported"] == len(values)


def test_rates_month(wh, silver):
    wh.load("exchange_rate", silver("exchange_rate", *[
        rate("UGX", v, date(2026, 7, d)) for d, v in ((18, 3700.0), (19, 3710.0), (20, 3720.0))]))
    last = views.view_exchange_rate(wh).orderBy("date").collect()[-1]
    assert (last["lag1_rate"], last["rate_7d_avg"]) == (3710.0, 3710.0)
    (month,) = views.agg_exchange_rate_monthly(wh).collect()
    assert (month["year"], month["month"], month["avg_rate"], month["min_rate"], month["max_rate"],
            month["days_observed"]) == (2026, 7, 3710.0, 3700.0, 3720.0, 3)


def test_weather_and_coin_views(wh, silver):
    wh.load("open_meteo", silver("open_meteo", weather(date(2026, 7, 19), 1.0, 20.0), weather(DAY, 2.0, 30.0)))
    wh.load("coingecko", silver("coingecko", crypto("bitcoin", 65000.0, date(2026, 7, 19)), crypto("bitcoin", 66000.0)))
    assert views.view_weather(wh).orderBy("date").collect()[-1]["temp_max_7d_avg_c"] == 25.0
    last = views.view_crypto(wh).orderBy("date").collect()[-1]
    assert (last["lag1_price_usd"], last["price_7d_avg_usd"]) == (65000.0, 65500.0)
    (month,) = views.agg_weather_monthly(wh).collect()
    assert (month["total_precipitation_mm"], month["avg_temp_max_c"]) == (3.0, 25.0)


def test_views_are_registered_for_sql(wh, silver, spark):
    wh.load("coingecko", silver("coingecko", crypto("bitcoin", 65000.0)))
    names = views.register_views(wh)
    views.register_views(wh)
    assert spark.sql("select coin_id from view_crypto").first()[0] == "bitcoin"
    assert "agg_weather_monthly" in names and "fact_news" in names
    for name in names:
        spark.catalog.dropTempView(name)


@pytest.mark.parametrize("months", [1, 3, 7])
def test_wide_rows_are_run_once(spark, tmp_path, silver, months):
    """With narrow rows at hand a plan goes into the fact in one run, shuffled only by many months."""
    made = [news(f"u{i}", f"t{i}", f"s{i % 3}" if i % 4 else None, date(2026, 1 + i % months, 3)) for i in range(40)]
    rows = silver("newsapi", *made)
    seen = spark.sparkContext.accumulator(0)

    def counted(batches):
        for batch in batches:
            seen.add(batch.num_rows)
            yield batch

    wide = rows.repartition(3).mapInArrow(counted, rows.schema)
    one, two = (Warehouse(spark, str(tmp_path / n)) for n in ("one", "two"))
    one.load("newsapi", rows)
    two.load("newsapi", wide, rows.select(*narrow_columns("newsapi")).distinct())
    assert narrow_columns("newsapi") == ["source_name", "logical_date"] and seen.value == 40
    for name in ("fact_news", "dim_news_source", "dim_date"):
        assert sorted(map(str, one.table(name).collect())) == sorted(map(str, two.table(name).collect()))
    files = {len(two.table("fact_news").where(f"date_key div 100 = {202601 + m}").inputFiles()) for m in range(months)}
    assert (max(files) > months) == (months <= 4)
