"""Explicit schemas of the landed documents, the Silver datasets and the warehouse tables."""

from __future__ import annotations

from pyspark.sql import types as T

# Field names and types of the landed payloads.
ANNUAL_PAGE = """
    meta struct<page:int, pages:int, per_page:int, total:int>,
    records array<struct<
        indicator:struct<id:string, value:string>,
        country:struct<id:string, value:string>,
        countryiso3code:string,
        date:string,
        value:double,
        unit:string,
        obs_status:string,
        decimal:int>>
"""
PAGES = {
    "world_bank": ANNUAL_PAGE,
    "world_bank_inflation": ANNUAL_PAGE,
    "exchange_rate": """
        result string, base_code string, time_last_update_utc string, rates map<string,double>
    """,
    "open_meteo": """
        latitude double, longitude double,
        daily struct<
            time:array<string>,
            temperature_2m_max:array<double>,
            temperature_2m_min:array<double>,
            precipitation_sum:array<double>>
    """,
    "coingecko": """
        coins array<struct<
            id:string, symbol:string, name:string, current_price:double, market_cap:double,
            total_volume:double, price_change_percentage_24h:double>>
    """,
    "newsapi": """
        status string, totalResults int,
        articles array<struct<
            source:struct<id:string, name:string>, author:string, title:string,
            description:string, url:string, publishedAt:string>>
    """,
}

# Columns of the Silver datasets, in contract order.
SILVER = {
    "world_bank": """
        country_iso3 string, country_name string, indicator_id string, year int,
        gdp_usd double, gdp_growth_rate double, logical_date date
    """,
    "world_bank_inflation": """
        country_iso3 string, country_name string, indicator_id string, year int,
        inflation_pct double, inflation_trend double, logical_date date
    """,
    "exchange_rate": """
        base_code string, currency string, rate double, exchange_momentum double, logical_date date
    """,
    "open_meteo": """
        date date, latitude double, longitude double, temp_max_c double, temp_min_c double,
        precipitation_mm double, precip_30d_avg_mm double, rainfall_anomaly_mm double,
        logical_date date
    """,
    "coingecko": """
        coin_id string, symbol string, name string, price_usd double, market_cap_usd double,
        volume_usd double, price_change_pct_24h double, volatility_7d double, logical_date date
    """,
    "newsapi": """
        source_name string, author string, title string, description string, url string,
        published_at timestamp, articles_that_day bigint, logical_date date
    """,
}

# Columns of the star schema.
WAREHOUSE = {
    "dim_date": """
        date_key int, full_date date, year int, quarter int, month int, month_name string,
        day int, day_of_week int, day_name string, is_weekend boolean
    """,
    "dim_country": "country_key int, country_iso3 string, country_name string",
    "dim_currency": "currency_key int, currency_code string",
    "dim_coin": "coin_key int, coin_id string, symbol string, name string",
    "dim_location": "location_key int, latitude double, longitude double",
    "dim_news_source": "news_source_key int, source_name string",
    "fact_gdp": """
        country_key int, indicator_id string, year int, gdp_usd double, gdp_growth_rate double
    """,
    "fact_inflation": """
        country_key int, indicator_id string, year int, inflation_pct double,
        inflation_trend double
    """,
    "fact_exchange_rate": """
        base_currency_key int, quote_currency_key int, date_key int, rate double,
        exchange_momentum double
    """,
    "fact_weather": """
        location_key int, date_key int, temp_max_c double, temp_min_c double,
        precipitation_mm double, precip_30d_avg_mm double, rainfall_anomaly_mm double
    """,
    "fact_crypto": """
        coin_key int, date_key int, price_usd double, market_cap_usd double, volume_usd double,
        price_change_pct_24h double, volatility_7d double
    """,
    "fact_news": """
        url string, news_source_key int, date_key int, title string, author string,
        description string, published_at timestamp, articles_that_day bigint
    """,
}

# Tables of the model registry.
REGISTRY = {
    "model_runs": """
        run_id string, model string, params map<string,string>, metrics map<string,double>,
        intercept double, coef_lag double, coef_rolling double, log_scale boolean,
        train_rows bigint, test_rows bigint, started_at timestamp
    """,
    "model_versions": "model string, version int, run_id string",
    "model_aliases": "model string, alias string, version int",
}


def struct(ddl: str) -> T.StructType:
    return T.StructType.fromDDL(" ".join(ddl.split()))


def names(ddl: str) -> list[str]:
    """Column names of a flat schema; needs no running session."""
    return [column.split()[0] for column in ddl.split(",")]

# Feeds whose unmodelled fields are landed beside the typed page.
KEEPS_EXTRAS = ("open_meteo",)


def landed_schema(source: str) -> T.StructType:
    """What is read back of landed documents: the envelope, and `extras` of feeds that keep them."""
    schema = bronze_schema(source)
    return schema.add("extras", T.ArrayType(T.VariantType())) if source in KEEPS_EXTRAS else schema


def bronze_schema(source: str) -> T.StructType:
    """The envelope around the pages of one source."""
    return T.StructType(
        [
            T.StructField("source", T.StringType()),
            T.StructField("logical_date", T.StringType()),
            T.StructField("fetched_at", T.StringType()),
            T.StructField("page_count", T.IntegerType()),
            T.StructField("pages", T.ArrayType(struct(PAGES[source]))),
            # Of documents that hold a part of a pull; absent elsewhere.
            T.StructField("page_numbers", T.ArrayType(T.LongType())),
        ]
    )
