"""The given tables reshaped into landed documents of the six feeds, and the same rows in SQL.

Every row of the tables that carry a feed takes part. The SQL names the fetch order of a row
`fetched`; the documents carry it as an ISO instant.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.operators.joins import lookup_join
from tidemark.session import apply_settings

# Stand-ins, so that the fixed names in the chart filters occur in the data.
COUNTRY_NAMES = {
    0: "World", 1: "Low income", 2: "Latin America & Caribbean", 3: "Africa Eastern and Southern",
}
UNCODED_NATION = 24
BASES = {
    "AUTOMOBILE": "USD", "BUILDING": "KES", "FURNITURE": "ZAR", "HOUSEHOLD": "NGN",
    "MACHINERY": "EGP",
}
QUOTES = {
    "1-URGENT": "EUR", "2-HIGH": "GBP", "3-MEDIUM": "JPY", "4-NOT SPECIFIED": "CNY",
    "5-LOW": "UGX",
}
COINS = {
    0: "bitcoin", 1: "ethereum", 2: "solana", 3: "ripple", 4: "dogecoin", 5: "cardano", 6: "tron",
    7: "binancecoin",
}
PLACES = {
    0: (0.3476, 32.5825), 1: (40.7128, -74.006), 2: (35.6762, 139.6503), 3: (51.5074, -0.1278),
    4: (30.0444, 31.2357),
}
YEARS_ANNUAL, YEARS_RATES = 22, 23
# Articles of this source come without a title.
UNTITLED = "src13"


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    apply_settings(spark)
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def _choose(column: Column, choices: dict, otherwise: Column) -> Column:
    chosen = None
    for key, value in choices.items():
        hit = column == F.lit(key)
        chosen = F.when(hit, F.lit(value)) if chosen is None else chosen.when(hit, F.lit(value))
    return chosen.otherwise(otherwise)


def _instant(seconds: Column) -> Column:
    text = F.date_format(F.timestamp_seconds(seconds), "yyyy-MM-dd'T'HH:mm:ss")
    return F.concat(text, F.lit("+00:00"))


def _documents(rows: DataFrame, source: str, day: Column, fetched_at: Column, *pages: Column):
    """One document per row; `logical_date` is already a date, as it is after reading."""
    return rows.select(
        F.lit(source).alias("source"),
        day.cast("date").alias("logical_date"),
        fetched_at.alias("fetched_at"),
        F.lit(len(pages)).alias("page_count"),
        F.array(*pages).alias("pages"),
    )


def _annual_page(year: Column, value: Column, indicator: str) -> Column:
    """A page of one record; expects n_nationkey and n_name."""
    key = F.col("n_nationkey")
    code = F.when(key == UNCODED_NATION, F.lit("")).otherwise(
        F.concat(F.lit("N"), F.lpad(key.cast("string"), 2, "0"))
    )
    record = F.struct(
        F.struct(F.lit(indicator).alias("id"), F.lit("").alias("value")).alias("indicator"),
        F.struct(
            key.cast("string").alias("id"),
            _choose(key, COUNTRY_NAMES, F.col("n_name")).alias("value"),
        ).alias("country"),
        code.alias("countryiso3code"),
        year.cast("string").alias("date"),
        value.alias("value"),
        F.lit("").alias("unit"),
        F.lit("").alias("obs_status"),
        F.lit(0).alias("decimal"),
    )
    meta = F.struct(*[F.lit(1).alias(n) for n in ("page", "pages", "per_page", "total")])
    return F.struct(meta.alias("meta"), F.array(record).alias("records"))


def gdp_documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    orders = table(spark, sf_dir, "orders")
    home = (
        table(spark, sf_dir, "customer")
        .select(F.col("c_custkey").alias("o_custkey"), F.col("c_nationkey").alias("n_nationkey"))
    )
    rows = lookup_join(orders, home, ["o_custkey"])
    rows = lookup_join(rows, table(spark, sf_dir, "nation"), ["n_nationkey"])
    value = F.when(F.col("o_orderstatus") != "P", F.col("o_totalprice"))
    page = _annual_page(F.year("o_orderdate") + YEARS_ANNUAL, value, "NY.GDP.MKTP.CD")
    return _documents(
        rows, "world_bank", F.col("o_orderdate"), _instant(F.col("o_orderkey")), page
    )


def inflation_documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    home = table(spark, sf_dir, "supplier").select(
        F.col("s_suppkey").alias("l_suppkey"), F.col("s_nationkey").alias("n_nationkey")
    )
    rows = lookup_join(table(spark, sf_dir, "lineitem"), home, ["l_suppkey"])
    rows = lookup_join(rows, table(spark, sf_dir, "nation"), ["n_nationkey"])
    value = F.when(F.col("l_returnflag") != "N", F.col("l_discount") * 100 - 2)
    page = _annual_page(F.year("l_shipdate") + YEARS_ANNUAL, value, "FP.CPI.TOTL.ZG")
    return _documents(
        rows, "world_bank_inflation", F.col("l_shipdate"), _instant(F.col("l_orderkey")), page
    )


def rate_documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    segment = table(spark, sf_dir, "customer").select(
        F.col("c_custkey").alias("o_custkey"), "c_mktsegment"
    )
    rows = lookup_join(table(spark, sf_dir, "orders"), segment, ["o_custkey"])
    quote = _choose(F.col("o_orderpriority"), QUOTES, F.col("o_orderpriority"))
    rate = F.when(F.col("o_orderstatus") == "P", F.lit(0.0)).otherwise(F.col("o_totalprice"))
    page = F.struct(
        F.lit("success").alias("result"),
        _choose(F.col("c_mktsegment"), BASES, F.col("c_mktsegment")).alias("base_code"),
        F.lit(None).cast("string").alias("time_last_update_utc"),
        F.create_map(quote, rate).alias("rates"),
    )
    day = F.add_months("o_orderdate", 12 * YEARS_RATES)
    return _documents(rows, "exchange_rate", day, _instant(F.col("o_orderkey")), page)


def weather_days(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One reading per region, day and line status."""
    home = table(spark, sf_dir, "supplier").select(
        F.col("s_suppkey").alias("l_suppkey"), F.col("s_nationkey").alias("n_nationkey")
    )
    lines = table(spark, sf_dir, "lineitem").select(
        "l_suppkey", "l_shipdate", "l_linestatus", "l_discount", "l_tax", "l_quantity"
    )
    rows = lookup_join(lines, home, ["l_suppkey"])
    nations = table(spark, sf_dir, "nation").select("n_nationkey", "n_regionkey")
    rows = lookup_join(rows, nations, ["n_nationkey"])
    return rows.groupBy(
        "n_regionkey", F.col("l_shipdate").cast("date").alias("day"), "l_linestatus"
    ).agg(
        (F.lit(20.0) + F.lit(100.0) * F.max("l_discount")).alias("temp_max"),
        (F.lit(100.0) * F.min("l_tax") - F.lit(5.0)).alias("temp_min"),
        (F.sum("l_quantity") / F.lit(10.0)).alias("rain"),
    )


def weather_documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Months of parallel arrays, fetched once per line status; the O fetch is the later one."""
    day = F.struct("day", "temp_max", "temp_min", "rain")
    # A month has at most 31 of the days aggregated before.
    months = (
        weather_days(spark, sf_dir)
        .groupBy("n_regionkey", F.trunc("day", "month").alias("month"), "l_linestatus")
        .agg(F.sort_array(F.collect_list(day)).alias("days"))
    )
    late = F.col("l_linestatus") == "O"
    latitude = {k: v[0] for k, v in PLACES.items()}
    longitude = {k: v[1] for k, v in PLACES.items()}
    unknown = F.lit(None).cast("double")
    page = F.struct(
        _choose(F.col("n_regionkey"), latitude, unknown).alias("latitude"),
        _choose(F.col("n_regionkey"), longitude, unknown).alias("longitude"),
        F.struct(
            F.col("days.day").cast("array<string>").alias("time"),
            F.col("days.temp_max").alias("temperature_2m_max"),
            F.col("days.temp_min").alias("temperature_2m_min"),
            F.col("days.rain").alias("precipitation_sum"),
        ).alias("daily"),
    )
    hour = F.when(late, F.lit("-28T18:00:00+00:00")).otherwise(F.lit("-28T06:00:00+00:00"))
    fetched_at = F.concat(F.date_format("month", "yyyy-MM"), hour)
    logical = F.when(late, F.date_add(F.last_day("month"), 1)).otherwise(F.last_day("month"))
    return _documents(months, "open_meteo", logical, fetched_at, page)


def coin(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Events with the struct of one quoted coin."""
    user = F.col("user_id").cast("string")
    quoted = F.struct(
        _choose(F.col("user_id"), COINS, F.concat(F.lit("coin-"), user)).alias("id"),
        F.concat(F.lit("c"), user).alias("symbol"),
        F.concat(F.lit("Coin "), user).alias("name"),
        F.when(F.col("event_type") != "error", F.col("value")).alias("current_price"),
        (F.col("value") * 1000).alias("market_cap"),
        F.get_json_object("props", "$.k").cast("double").alias("total_volume"),
        (F.col("value") - 250).alias("price_change_percentage_24h"),
    )
    return table(spark, sf_dir, "events").select("event_id", "ts", quoted.alias("coin"))


def coin_documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    fetched = F.date_format("ts", "yyyy-MM-dd'T'HH:mm:ss.SSSSSS")
    page = F.struct(F.array("coin").alias("coins"))
    return _documents(
        coin(spark, sf_dir), "coingecko", F.col("ts"), F.concat(fetched, F.lit("+00:00")), page
    )


def news_documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Articles are whole texts; copies of a text share its address."""
    day = F.date_add(F.lit("2024-01-01").cast("date"), (F.col("doc_id") % 30).cast("int"))
    second = F.timestamp_seconds(F.unix_date(day) * 86400 + F.col("doc_id") % 86400)
    article = F.struct(
        F.struct(
            F.lit(None).cast("string").alias("id"),
            F.nullif(F.col("source"), F.lit("src0")).alias("name"),
        ).alias("source"),
        F.col("lang").alias("author"),
        F.when(F.col("source") != UNTITLED, F.col("text")).alias("title"),
        F.concat_ws(" ", "lang", F.col("n_chars").cast("string")).alias("description"),
        F.concat(F.lit("https://news.example/"), F.md5("text")).alias("url"),
        F.date_format(second, "yyyy-MM-dd'T'HH:mm:ss'Z'").alias("publishedAt"),
    )
    page = F.struct(
        F.lit("ok").alias("status"), F.lit(1).alias("totalResults"), F.array(article).alias("articles")
    )
    return _documents(
        table(spark, sf_dir, "documents"), "newsapi", day, _instant(F.col("doc_id")), page
    )


DOCUMENTS = {
    "world_bank": gdp_documents,
    "world_bank_inflation": inflation_documents,
    "exchange_rate": rate_documents,
    "open_meteo": weather_documents,
    "coingecko": coin_documents,
    "newsapi": news_documents,
}

# -- the same rows in SQL


def _case(column: str, choices: dict, otherwise: str) -> str:
    def literal(value) -> str:
        return f"'{value}'" if isinstance(value, str) else f"CAST({value} AS DOUBLE)"

    def key(value) -> str:
        return f"'{value}'" if isinstance(value, str) else str(value)

    whens = " ".join(f"WHEN {key(k)} THEN {literal(v)}" for k, v in choices.items())
    return f"CASE {column} {whens} ELSE {otherwise} END"


_COUNTRY_SQL = f"""
    CASE WHEN n_nationkey = {UNCODED_NATION} THEN ''
         ELSE 'N' || lpad(CAST(n_nationkey AS VARCHAR), 2, '0') END AS country_iso3,
    {_case('n_nationkey', COUNTRY_NAMES, 'n_name')} AS country_name
"""

RAW_SQL = {
    "world_bank": f"""
        SELECT {_COUNTRY_SQL}, 'NY.GDP.MKTP.CD' AS indicator_id,
            year(o_orderdate) + {YEARS_ANNUAL} AS year,
            CASE WHEN o_orderstatus <> 'P' THEN o_totalprice END AS gdp_usd,
            CAST(o_orderdate AS DATE) AS logical_date, o_orderkey AS fetched
        FROM orders JOIN customer ON o_custkey = c_custkey JOIN nation ON c_nationkey = n_nationkey
    """,
    "world_bank_inflation": f"""
        SELECT {_COUNTRY_SQL}, 'FP.CPI.TOTL.ZG' AS indicator_id,
            year(l_shipdate) + {YEARS_ANNUAL} AS year,
            CASE WHEN l_returnflag <> 'N' THEN l_discount * 100 - 2 END AS inflation_pct,
            CAST(l_shipdate AS DATE) AS logical_date, l_orderkey AS fetched
        FROM lineitem JOIN supplier ON l_suppkey = s_suppkey
        JOIN nation ON s_nationkey = n_nationkey
    """,
    "exchange_rate": f"""
        SELECT {_case('c_mktsegment', BASES, 'c_mktsegment')} AS base_code,
            {_case('o_orderpriority', QUOTES, 'o_orderpriority')} AS currency,
            CASE WHEN o_orderstatus = 'P' THEN 0.0 ELSE o_totalprice END AS rate,
            CAST(o_orderdate + INTERVAL {YEARS_RATES} YEAR AS DATE) AS logical_date,
            o_orderkey AS fetched
        FROM orders JOIN customer ON o_custkey = c_custkey
    """,
    "open_meteo": f"""
        SELECT day AS date,
            {_case('n_regionkey', {k: v[0] for k, v in PLACES.items()}, 'NULL')} AS latitude,
            {_case('n_regionkey', {k: v[1] for k, v in PLACES.items()}, 'NULL')} AS longitude,
            temp_max AS temp_max_c, temp_min AS temp_min_c, rain AS precipitation_mm,
            CASE WHEN l_linestatus = 'O' THEN last_day(day) + 1 ELSE last_day(day) END
                AS logical_date,
            l_linestatus AS fetched
        FROM (
            SELECT n_regionkey, CAST(l_shipdate AS DATE) AS day, l_linestatus,
                CAST(20 AS DOUBLE) + CAST(100 AS DOUBLE) * max(l_discount) AS temp_max,
                CAST(100 AS DOUBLE) * min(l_tax) - CAST(5 AS DOUBLE) AS temp_min,
                sum(l_quantity) / CAST(10 AS DOUBLE) AS rain
            FROM lineitem JOIN supplier ON l_suppkey = s_suppkey
            JOIN nation ON s_nationkey = n_nationkey
            GROUP BY n_regionkey, CAST(l_shipdate AS DATE), l_linestatus
        ) AS readings
    """,
    "coingecko": f"""
        SELECT {_case('user_id', COINS, "'coin-' || user_id")} AS coin_id,
            'c' || user_id AS symbol, 'Coin ' || user_id AS name,
            CASE WHEN event_type <> 'error' THEN value END AS price_usd,
            value * 1000 AS market_cap_usd,
            CAST(json_extract_string(props, '$.k') AS DOUBLE) AS volume_usd,
            value - 250 AS price_change_pct_24h,
            CAST(ts AS DATE) AS logical_date, ts AS fetched
        FROM events
    """,
    "newsapi": f"""
        SELECT nullif(source, 'src0') AS source_name, lang AS author,
            CASE WHEN source <> '{UNTITLED}' THEN text END AS title,
            lang || ' ' || n_chars AS description,
            'https://news.example/' || md5(text) AS url,
            CAST(DATE '2024-01-01' + CAST(doc_id % 30 AS INTEGER) AS TIMESTAMP)
                + to_seconds(CAST(doc_id % 86400 AS BIGINT)) AS published_at,
            DATE '2024-01-01' + CAST(doc_id % 30 AS INTEGER) AS logical_date, doc_id AS fetched
        FROM documents
    """,
}

_ANNUAL_KEEP = "country_iso3 IS NOT NULL AND country_iso3 <> '' AND year IS NOT NULL"
# (condition of a usable row, key, further tie-breakers)
CLEAN_SQL = {
    "world_bank": (
        _ANNUAL_KEEP, "country_iso3, indicator_id, year",
        "logical_date DESC, country_name DESC, gdp_usd DESC NULLS LAST",
    ),
    "world_bank_inflation": (
        _ANNUAL_KEEP, "country_iso3, indicator_id, year",
        "logical_date DESC, country_name DESC, inflation_pct DESC NULLS LAST",
    ),
    "exchange_rate": ("rate > 0", "base_code, currency, logical_date", "rate DESC"),
    "open_meteo": ("date IS NOT NULL", "latitude, longitude, date", "logical_date DESC"),
    "coingecko": (
        "coin_id IS NOT NULL AND price_usd IS NOT NULL", "coin_id, logical_date",
        "price_usd DESC",
    ),
    "newsapi": ("title IS NOT NULL AND url IS NOT NULL", "url", "logical_date DESC"),
}


def _ratio(now: str, window: str) -> str:
    before = f"lag({now}) OVER ({window})"
    return f"CASE WHEN {before} <> 0 THEN ({now} - {before}) / {before} END"


_PLACE_WINDOW = "PARTITION BY latitude, longitude ORDER BY date"
_RAIN_MEAN = (
    f"avg(precipitation_mm) OVER ({_PLACE_WINDOW} ROWS BETWEEN 29 PRECEDING AND CURRENT ROW)"
)
_ANNUAL_WINDOW = "PARTITION BY country_iso3, indicator_id ORDER BY year"
FEATURE_SQL = {
    "world_bank": f"{_ratio('gdp_usd', _ANNUAL_WINDOW)} AS gdp_growth_rate",
    "world_bank_inflation": (
        f"inflation_pct - lag(inflation_pct) OVER ({_ANNUAL_WINDOW}) AS inflation_trend"
    ),
    "exchange_rate": (
        _ratio("rate", "PARTITION BY base_code, currency ORDER BY logical_date")
        + " AS exchange_momentum"
    ),
    "open_meteo": (
        f"{_RAIN_MEAN} AS precip_30d_avg_mm, "
        f"precipitation_mm - {_RAIN_MEAN} AS rainfall_anomaly_mm"
    ),
    "coingecko": (
        "stddev_samp(price_change_pct_24h) OVER (PARTITION BY coin_id ORDER BY logical_date "
        "ROWS BETWEEN 6 PRECEDING AND CURRENT ROW) AS volatility_7d"
    ),
    "newsapi": "count(*) OVER (PARTITION BY logical_date) AS articles_that_day",
}

SHORT = {
    "world_bank": "gdp", "world_bank_inflation": "inflation", "exchange_rate": "rates",
    "open_meteo": "weather", "coingecko": "crypto", "newsapi": "news",
}


def silver_ctes(*sources: str, pulled_on: str | None = None) -> str:
    """CTEs `<short>_raw`, `<short>_newest` and `<short>_silver` for each source, without WITH.

    With `pulled_on` all rows are of one pull on that day.
    """
    parts = []
    for source in sources:
        name = SHORT[source]
        keep, key, ties = CLEAN_SQL[source]
        raw = RAW_SQL[source]
        if pulled_on:
            raw = f"SELECT * REPLACE (DATE '{pulled_on}' AS logical_date, 0 AS fetched) FROM ({raw})"
        parts.append(
            f"""{name}_raw AS ({raw}),
            {name}_newest AS (
                SELECT * FROM (
                    SELECT *, row_number() OVER (
                        PARTITION BY {key} ORDER BY fetched DESC, {ties}) AS place
                    FROM {name}_raw WHERE {keep}
                ) AS ranked WHERE place = 1
            ),
            {name}_silver AS (SELECT *, {FEATURE_SQL[source]} FROM {name}_newest)"""
        )
    return ", ".join(parts)
