"""Feature views (`view_*`) and roll-ups (`agg_*`) over the star schema.

Windows are partitioned by the natural key of the entity, so a filter on that key reaches below the
window. A fact has one row per entity and point in time, which bounds each window by the calendar.

Views take `entity` and `until`, as `Warehouse.slice` does. Both narrow the stored rows before the
window and are exact: an entity's features use its own rows only, and frames reach back, never ahead.
A lower bound would cut history and is therefore offered only where there is no window.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark.operators.joins import lookup_join
from tidemark.operators.series import History
from tidemark.plans.warehouse import Warehouse


def _with_country(wh: Warehouse, fact: str, **within) -> DataFrame:
    return wh.describe(wh.slice(fact, **within), "dim_country", ["country_key"])


def _with_day(wh: Warehouse, rows: DataFrame, *more: str) -> DataFrame:
    days = wh.table("dim_date").select("date_key", F.col("full_date").alias("date"), *more)
    return lookup_join(rows, days, ["date_key"], known_bytes=wh.dimension_bytes("dim_date"))


def _with_pair(wh: Warehouse, rows: DataFrame) -> DataFrame:
    """Currency dimension in both roles: base and quote."""
    for role, name in (("base_currency_key", "base_code"), ("quote_currency_key", "currency")):
        names = {role: "currency_key", name: "currency_code"}
        rows = wh.describe(rows, "dim_currency", [role], **names)
    return rows


def _annual_view(
    wh: Warehouse, fact: str, measure: str, derived: str, mean_name: str, **within
) -> DataFrame:
    history = History(("country_iso3", "indicator_id"), "year")
    return _with_country(wh, fact, **within).select(
        "country_iso3",
        "country_name",
        "indicator_id",
        "year",
        measure,
        derived,
        history.previous(measure).alias(f"lag1_{measure}"),
        history.mean(measure, 3).alias(mean_name),
    )


def view_gdp(wh: Warehouse, **within) -> DataFrame:
    return _annual_view(
        wh, "fact_gdp", "gdp_usd", "gdp_growth_rate", "gdp_3yr_avg_usd", **within
    )


def view_inflation(wh: Warehouse, **within) -> DataFrame:
    return _annual_view(
        wh, "fact_inflation", "inflation_pct", "inflation_trend", "inflation_3yr_avg_pct", **within
    )


def view_exchange_rate(wh: Warehouse, **within) -> DataFrame:
    history = History(("base_code", "currency"), "date")
    return _with_day(wh, _with_pair(wh, wh.slice("fact_exchange_rate", **within))).select(
        "base_code",
        "currency",
        "date",
        "rate",
        "exchange_momentum",
        history.previous("rate").alias("lag1_rate"),
        history.mean("rate", 7).alias("rate_7d_avg"),
    )


def view_weather(wh: Warehouse, **within) -> DataFrame:
    history = History(("latitude", "longitude"), "date")
    rows = wh.describe(wh.slice("fact_weather", **within), "dim_location", ["location_key"])
    return _with_day(wh, rows).select(
        "latitude",
        "longitude",
        "date",
        "temp_max_c",
        "temp_min_c",
        "precipitation_mm",
        "precip_30d_avg_mm",
        "rainfall_anomaly_mm",
        history.mean("temp_max_c", 7).alias("temp_max_7d_avg_c"),
    )


def view_crypto(wh: Warehouse, **within) -> DataFrame:
    history = History(("coin_id",), "date")
    rows = wh.describe(wh.slice("fact_crypto", **within), "dim_coin", ["coin_key"])
    return _with_day(wh, rows).select(
        "coin_id",
        "symbol",
        "name",
        "date",
        "price_usd",
        "market_cap_usd",
        "volume_usd",
        "price_change_pct_24h",
        "volatility_7d",
        history.previous("price_usd").alias("lag1_price_usd"),
        history.mean("price_usd", 7).alias("price_7d_avg_usd"),
    )


def view_news(wh: Warehouse, **within) -> DataFrame:
    """Articles without a known source stay, with a null name."""
    rows = wh.describe(wh.slice("fact_news", **within), "dim_news_source", ["news_source_key"], "left")
    return _with_day(wh, rows).select(
        "url",
        "source_name",
        "title",
        "author",
        "description",
        "published_at",
        "date",
        "articles_that_day",
    )


def value_at(pick: Callable[[Column, Column], Column], value: str, time: str) -> Column:
    """Value at the first or last time at which it is known."""
    known_time = F.when(F.col(value).isNotNull(), F.col(time))
    return pick(F.col(value), known_time)


def agg_gdp_by_country(wh: Warehouse) -> DataFrame:
    """The year span counts every row; first and latest value skip unknown ones."""
    span = F.col("latest_year") - F.col("first_year")
    ratio = F.try_divide(F.col("latest_gdp_usd"), F.col("first_year_gdp_usd"))
    grows = (F.col("first_year_gdp_usd") > 0) & (span > 0)
    return (
        _with_country(wh, "fact_gdp")
        .groupBy("country_iso3", "country_name")
        .agg(
            F.count(F.lit(1)).alias("years_reported"),
            F.min("year").alias("first_year"),
            F.max("year").alias("latest_year"),
            value_at(F.min_by, "gdp_usd", "year").alias("first_year_gdp_usd"),
            value_at(F.max_by, "gdp_usd", "year").alias("latest_gdp_usd"),
            F.avg("gdp_growth_rate").alias("avg_gdp_growth_rate"),
        )
        .withColumn("gdp_cagr", F.when(grows, F.pow(ratio, F.try_divide(F.lit(1.0), span)) - 1))
    )


def agg_inflation_by_country(wh: Warehouse) -> DataFrame:
    return (
        _with_country(wh, "fact_inflation")
        .groupBy("country_iso3", "country_name")
        .agg(
            F.count(F.lit(1)).alias("years_reported"),
            F.max("year").alias("latest_year"),
            value_at(F.max_by, "inflation_pct", "year").alias("latest_inflation_pct"),
            F.avg("inflation_pct").alias("avg_inflation_pct"),
        )
    )


def _monthly(wh: Warehouse, rows: DataFrame, entity: list[str], *measures: Column) -> DataFrame:
    return (
        _with_day(wh, rows, "year", "month")
        .groupBy(*entity, "year", "month")
        .agg(*measures, F.count(F.lit(1)).alias("days_observed"))
    )


def agg_exchange_rate_monthly(wh: Warehouse) -> DataFrame:
    return _monthly(
        wh,
        _with_pair(wh, wh.table("fact_exchange_rate")),
        ["base_code", "currency"],
        F.avg("rate").alias("avg_rate"),
        F.min("rate").alias("min_rate"),
        F.max("rate").alias("max_rate"),
    )


def agg_crypto_monthly(wh: Warehouse) -> DataFrame:
    return _monthly(
        wh,
        wh.describe(wh.table("fact_crypto"), "dim_coin", ["coin_key"]),
        ["coin_id", "symbol", "name"],
        F.avg("price_usd").alias("avg_price_usd"),
        F.avg("volume_usd").alias("avg_volume_usd"),
        F.avg("price_change_pct_24h").alias("avg_price_change_pct_24h"),
    )


def agg_weather_monthly(wh: Warehouse) -> DataFrame:
    return _monthly(
        wh,
        wh.describe(wh.table("fact_weather"), "dim_location", ["location_key"]),
        ["latitude", "longitude"],
        F.avg("temp_max_c").alias("avg_temp_max_c"),
        F.avg("temp_min_c").alias("avg_temp_min_c"),
        F.sum("precipitation_mm").alias("total_precipitation_mm"),
    )


VIEWS: dict[str, Callable[..., DataFrame]] = {
    f.__name__: f
    for f in (
        view_gdp,
        view_inflation,
        view_exchange_rate,
        view_weather,
        view_crypto,
        view_news,
        agg_gdp_by_country,
        agg_inflation_by_country,
        agg_exchange_rate_monthly,
        agg_crypto_monthly,
        agg_weather_monthly,
    )
}


def drill_across(wh: Warehouse) -> DataFrame:
    """Coin prices and exchange rates of the same day, both daily totals first.

    Each fact is reduced to one row per day before they meet, so the join is one row per day.
    """
    coins = wh.table("fact_crypto").groupBy("date_key").agg(
        F.count(F.lit(1)).alias("coins"), F.avg("price_usd").alias("avg_price_usd")
    )
    rates = wh.table("fact_exchange_rate").groupBy("date_key").agg(
        F.count(F.lit(1)).alias("pairs"), F.avg("rate").alias("avg_rate")
    )
    days = wh.table("dim_date").select("date_key", F.col("full_date").alias("date"))
    return days.join(coins, "date_key").join(rates, "date_key")


def register_views(wh: Warehouse) -> list[str]:
    """Make every table and view visible to SQL in this session; repeating it refreshes them."""
    from tidemark.sources.schemas import WAREHOUSE

    for name in WAREHOUSE:
        wh.table(name).createOrReplaceTempView(name)
    for name, view in VIEWS.items():
        view(wh).createOrReplaceTempView(name)
    return [*WAREHOUSE, *VIEWS]
