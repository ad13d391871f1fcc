"""Queries over the star schema: dimensions, facts, merges, views and roll-ups."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.catalog.feeds import SHORT, silver_ctes, table
from tidemark.catalog.lake import dimension, staged_silver, warehouse
from tidemark.catalog.shape import Catalog
from tidemark.operators.joins import lookup_join
from tidemark.operators.merge import insert_if_absent, number_members, upsert
from tidemark.plans import views
from tidemark.plans.rollups import KEPT, PARTIALS
from tidemark.plans.warehouse import DIMENSIONS, FACT_OF_SOURCE, FACTS, Warehouse
from tidemark.session import scratch_path

star = Catalog()

ALL_SOURCES = tuple(SHORT)

# -- dimensions

CALENDAR = (
    "date_key:i full_date:d year:i quarter:i month:i month_name day:i day_of_week:i day_name "
    "is_weekend"
)


def dim_date(spark: SparkSession, sf_dir: str) -> DataFrame:
    return warehouse(spark, sf_dir, *ALL_SOURCES).table("dim_date")


star.add(
    "dim_date", CALENDAR, dim_date,
    """SELECT CAST(strftime(d, '%Y%m%d') AS INTEGER) AS date_key, d AS full_date, year(d) AS year,
        quarter(d) AS quarter, month(d) AS month, monthname(d) AS month_name, day(d) AS day,
        dayofweek(d) AS day_of_week, dayname(d) AS day_name, dayofweek(d) IN (0, 6) AS is_weekend
    FROM (SELECT logical_date AS d FROM rates_silver UNION SELECT date FROM weather_silver
        UNION SELECT logical_date FROM crypto_silver UNION SELECT logical_date FROM news_silver
    ) AS days""",
    f"WITH {silver_ctes('exchange_rate', 'open_meteo', 'coingecko', 'newsapi')}",
)


def _dimension(name: str, *sources: str):
    def query(spark: SparkSession, sf_dir: str) -> DataFrame:
        return dimension(spark, sf_dir, name, *sources)

    return query


star.add(
    "dim_country", "country_iso3 country_name",
    _dimension("dim_country", "world_bank", "world_bank_inflation"),
    """SELECT country_iso3, max(country_name) AS country_name FROM (
        SELECT country_iso3, country_name FROM gdp_silver
        UNION ALL SELECT country_iso3, country_name FROM inflation_silver) AS named GROUP BY 1""",
    f"WITH {silver_ctes('world_bank', 'world_bank_inflation')}",
)
star.add(
    "dim_currency_union", "currency_code", _dimension("dim_currency", "exchange_rate"),
    "SELECT base_code AS currency_code FROM rates_silver UNION SELECT currency FROM rates_silver",
    f"WITH {silver_ctes('exchange_rate')}",
)
star.add(
    "dim_coin", "coin_id symbol name", _dimension("dim_coin", "coingecko"),
    "SELECT coin_id, max(symbol) AS symbol, max(name) AS name FROM crypto_silver GROUP BY coin_id",
    f"WITH {silver_ctes('coingecko')}",
)
star.add(
    "dim_location", "latitude:r longitude:r", _dimension("dim_location", "open_meteo"),
    "SELECT DISTINCT latitude, longitude FROM weather_silver",
    f"WITH {silver_ctes('open_meteo')}",
)
star.add(
    "dim_news_source", "source_name", _dimension("dim_news_source", "newsapi"),
    "SELECT DISTINCT source_name FROM news_silver WHERE source_name IS NOT NULL",
    f"WITH {silver_ctes('newsapi')}",
)


def key_density(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Surrogate keys are unique and dense in every dimension."""
    wh = warehouse(spark, sf_dir, *ALL_SOURCES)
    answer = None
    for name, dimension in DIMENSIONS.items():
        keys = wh.table(name).groupBy(dimension.key).agg(F.count(F.lit(1)).alias("n"))
        row = keys.agg(
            F.sum("n").alias("members"),
            F.count(F.lit(1)).alias("distinct_keys"),
            F.min(dimension.key).alias("first_key"),
            F.max(dimension.key).alias("last_key"),
        ).select(F.lit(name).alias("dimension"), "*")
        answer = row if answer is None else answer.unionByName(row)
    return answer


_MEMBERS_SQL = {
    "dim_country": (
        "SELECT country_iso3 FROM gdp_silver UNION SELECT country_iso3 FROM inflation_silver"
    ),
    "dim_currency": "SELECT base_code FROM rates_silver UNION SELECT currency FROM rates_silver",
    "dim_coin": "SELECT DISTINCT coin_id FROM crypto_silver",
    "dim_location": "SELECT DISTINCT latitude, longitude FROM weather_silver",
    "dim_news_source": (
        "SELECT DISTINCT source_name FROM news_silver WHERE source_name IS NOT NULL"
    ),
}
star.add(
    "surrogate_key_density", "dimension members:b distinct_keys:b first_key:i last_key:i", key_density,
    " UNION ALL ".join(
        f"""SELECT '{name}' AS dimension, count(*) AS members, count(*) AS distinct_keys,
            1 AS first_key, count(*) AS last_key FROM ({body}) AS found"""
        for name, body in _MEMBERS_SQL.items()
    ),
    f"WITH {silver_ctes(*ALL_SOURCES)}",
)


def numbered_customers(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Dense keys for a large dimension: every customer gets one, each number is used once."""
    members = table(spark, sf_dir, "customer").select("c_custkey")
    numbered = number_members(members, ["c_custkey"], "customer_key", after=1000)
    return numbered.groupBy().agg(
        F.count(F.lit(1)).alias("members"),
        F.min("customer_key").alias("first_key"),
        F.max("customer_key").alias("last_key"),
        F.sum("customer_key").alias("key_sum"),
    )


star.add(
    "surrogate_keys_customers", "members:b first_key:i last_key:i key_sum:b", numbered_customers,
    """SELECT count(*) AS members, 1001 AS first_key, 1000 + count(*) AS last_key,
        1000 * count(*) + count(*) * (count(*) + 1) // 2 AS key_sum
    FROM (SELECT DISTINCT c_custkey FROM customer) AS members""",
)

# -- merges as pure operators


def upsert_orders(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Order totals replaced by the (possibly unknown) total of returned lines, others kept."""
    existing = table(spark, sf_dir, "orders").select("o_orderkey", F.col("o_totalprice").alias("total"))
    returned = F.when(F.col("l_returnflag") == "R", F.col("l_extendedprice"))
    incoming = (
        table(spark, sf_dir, "lineitem")
        .groupBy(F.col("l_orderkey").alias("o_orderkey"))
        .agg(F.sum(returned).alias("total"))
    )
    return upsert(existing, incoming, ["o_orderkey"])


star.add(
    "fact_upsert_replace", "o_orderkey:b total:r2", upsert_orders,
    """SELECT coalesce(l_orderkey, o_orderkey) AS o_orderkey,
        CASE WHEN l_orderkey IS NULL THEN o_totalprice ELSE returned END AS total
    FROM orders FULL JOIN (
        SELECT l_orderkey, sum(CASE WHEN l_returnflag = 'R' THEN l_extendedprice END) AS returned
        FROM lineitem GROUP BY l_orderkey) AS lines ON l_orderkey = o_orderkey""",
)


def insert_customers(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Customers seen in orders, plus those of the customer table that never ordered."""
    existing = table(spark, sf_dir, "orders").groupBy(F.col("o_custkey").alias("custkey")).agg(
        F.lit("ordered").alias("origin"), F.count(F.lit(1)).alias("orders")
    )
    incoming = table(spark, sf_dir, "customer").select(
        F.col("c_custkey").alias("custkey"),
        F.lit("listed").alias("origin"),
        F.lit(0).cast("bigint").alias("orders"),
    )
    return insert_if_absent(existing, incoming, ["custkey"])


star.add(
    "fact_insert_if_absent", "custkey:b origin orders:b", insert_customers,
    """SELECT coalesce(o_custkey, c_custkey) AS custkey,
        CASE WHEN o_custkey IS NULL THEN 'listed' ELSE 'ordered' END AS origin,
        coalesce(n, 0) AS orders
    FROM (SELECT o_custkey, count(*) AS n FROM orders GROUP BY 1) AS seen
    FULL JOIN customer ON o_custkey = c_custkey""",
)

# -- facts, with their keys resolved back to natural keys

FACT_SHAPES = {
    "fact_gdp": (
        "fact_gdp", "world_bank",
        "country_iso3 indicator_id year:i gdp_usd:r gdp_growth_rate:r",
    ),
    "fact_inflation": (
        "fact_inflation", "world_bank_inflation",
        "country_iso3 indicator_id year:i inflation_pct:r inflation_trend:r",
    ),
    "fact_fx_role_playing": (
        "fact_exchange_rate", "exchange_rate",
        "base_code currency date_key:i rate:r exchange_momentum:r",
    ),
    "fact_weather_composite": (
        "fact_weather", "open_meteo",
        "latitude:r longitude:r date_key:i temp_max_c:r temp_min_c:r precipitation_mm:r "
        "precip_30d_avg_mm:r rainfall_anomaly_mm:r",
    ),
    "fact_crypto": (
        "fact_crypto", "coingecko",
        "coin_id date_key:i price_usd:r market_cap_usd:r volume_usd:r price_change_pct_24h:r "
        "volatility_7d:r",
    ),
    "fact_news_left_join": (
        "fact_news", "newsapi",
        "url source_name date_key:i title author description published_at:t articles_that_day:b",
    ),
}


def natural_fact(wh: Warehouse, name: str) -> DataFrame:
    """A fact with every dimension key replaced by the natural key it stands for."""
    rows = wh.table(name)
    for lookup in FACTS[name].lookups:
        dimension = DIMENSIONS[lookup.dimension]
        named = zip(dimension.natural, lookup.silver_columns, strict=True)
        keys = wh.table(lookup.dimension).select(
            F.col(dimension.key).alias(lookup.role), *[F.col(n).alias(s) for n, s in named]
        )
        rows = lookup_join(rows, keys, [lookup.role], lookup.how)
    return rows


def _fact_query(fact: str, source: str):
    return lambda spark, sf_dir: natural_fact(warehouse(spark, sf_dir, source), fact)


def fact_sql(source: str) -> str:
    column = FACT_OF_SOURCE[source].date_column
    key = f", CAST(strftime({column}, '%Y%m%d') AS INTEGER) AS date_key" if column else ""
    return f"SELECT *{key} FROM {SHORT[source]}_silver"


for _name, (_fact, _source, _shape) in FACT_SHAPES.items():
    star.add(
        _name, _shape, _fact_query(_fact, _source), fact_sql(_source),
        f"WITH {silver_ctes(_source)}",
    )


def idempotent_reload(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Load a stale revision, then the current one twice: the fact holds the current one once."""
    wh = Warehouse(spark, scratch_path(spark, "warehouse-reload"))
    wh.create_schema()
    rows = staged_silver(spark, sf_dir, "coingecko")
    wh.load("coingecko", rows.withColumn("price_usd", F.col("price_usd") / 2))
    wh.load("coingecko", rows)
    wh.load("coingecko", rows)
    return natural_fact(wh, "fact_crypto")


star.add(
    "idempotent_reload", FACT_SHAPES["fact_crypto"][2], idempotent_reload, fact_sql("coingecko"),
    f"WITH {silver_ctes('coingecko')}",
)


def moved_news(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Articles first loaded two months early: reloading moves each to its own month, once."""
    wh = Warehouse(spark, scratch_path(spark, "warehouse-moved"))
    wh.create_schema()
    rows = staged_silver(spark, sf_dir, "newsapi")
    early = F.add_months("logical_date", -2)
    wh.load("newsapi", rows.withColumns({"logical_date": early, "title": F.lit("early")}))
    wh.load("newsapi", rows)
    return natural_fact(wh, "fact_news")


star.add(
    "fact_news_moved_reload", FACT_SHAPES["fact_news_left_join"][2], moved_news, fact_sql("newsapi"),
    f"WITH {silver_ctes('newsapi')}",
)


def integrity_report(spark: SparkSession, sf_dir: str) -> DataFrame:
    wh = warehouse(spark, sf_dir, *ALL_SOURCES)
    answer = None
    for name in FACTS:
        rules = wh.integrity(name)
        answer = rules if answer is None else answer.unionByName(rules)
    return answer


def _integrity_sql() -> str:
    """The same rules counted on Silver, where keys are still natural."""
    parts = []

    def rule(fact: str, check: str, column: str, count: str) -> None:
        parts.append(
            f"""SELECT '{fact}' AS fact, '{check}' AS "check", '{column}' AS "column",
                (SELECT count(*) FROM {count}) AS violations"""
        )

    for name, fact in FACTS.items():
        rows = f"{SHORT[fact.source]}_silver"
        natural = {lookup.role: list(lookup.silver_columns) for lookup in fact.lookups}
        dated = ["date_key"] if fact.date_column else []
        if fact.date_column:
            natural["date_key"] = [fact.date_column]
        for role in natural:
            listed = ", ".join(natural[role])
            known = " AND ".join(f"{c} IS NOT NULL" for c in natural[role])
            rule(
                name, "reference", role,
                f"""(SELECT {listed} FROM {rows} WHERE {known}
                    EXCEPT SELECT DISTINCT {listed} FROM {rows}) AS lost""",
            )
        grain = ", ".join(c for role in fact.grain for c in natural.get(role, [role]))
        repeated = f"(SELECT {grain} FROM {rows} GROUP BY {grain} HAVING count(*) > 1) AS repeated"
        rule(name, "unique", ",".join(fact.grain), repeated)
        for role in dict.fromkeys([*fact.grain, *dated]):
            unknown = " OR ".join(f"{c} IS NULL" for c in natural.get(role, [role]))
            rule(name, "not_null", role, f"{rows} WHERE {unknown}")
    return " UNION ALL ".join(parts)


star.add(
    "integrity_report", "fact check column violations:b", integrity_report, _integrity_sql(),
    f"WITH {silver_ctes(*ALL_SOURCES)}",
)



def integrity_of_broken_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Coin rows with coins that nobody knows, with days missing and with repeated keys, by day of month."""
    wh = warehouse(spark, sf_dir, "coingecko")
    rows, day = wh.table("fact_crypto"), F.col("date_key") % 100
    lost = F.when(day % 4 == 0, F.col("coin_key") + 1_000_000).otherwise(F.col("coin_key"))
    undated = F.when(day % 5 != 0, F.col("date_key"))
    broken = rows.select(lost.alias("coin_key"), undated.alias("date_key"), *[c for c in rows.columns if not c.endswith("_key")])
    return wh.integrity("fact_crypto", broken.unionByName(rows.where(day % 3 == 0)))


star.add(
    "integrity_of_broken_rows", "fact check column violations:b", integrity_of_broken_rows,
    """SELECT 'fact_crypto' AS fact, found.* FROM (
        SELECT 'reference' AS "check", 'coin_key' AS "column", (SELECT count(*) FROM landed WHERE unknown) AS violations
        UNION ALL SELECT 'reference', 'date_key', 0
        UNION ALL SELECT 'unique', 'coin_key,date_key', (SELECT count(*) FROM (
            SELECT 1 FROM landed GROUP BY coin_id, unknown, day HAVING count(*) > 1) AS repeated)
        UNION ALL SELECT 'not_null', 'coin_key', 0
        UNION ALL SELECT 'not_null', 'date_key', (SELECT count(*) FROM landed WHERE day IS NULL)) AS found""",
    f"""WITH {silver_ctes('coingecko')}, landed AS (
        SELECT coin_id, day(logical_date) % 4 = 0 AS unknown,
            CASE WHEN day(logical_date) % 5 <> 0 THEN logical_date END AS day FROM crypto_silver
        UNION ALL SELECT coin_id, false, logical_date FROM crypto_silver WHERE day(logical_date) % 3 = 0)""",
)

# -- views

ANNUAL_WINDOW = "PARTITION BY country_iso3, indicator_id ORDER BY year"


def _annual_view_sql(name: str, measure: str, mean: str) -> str:
    return f"""SELECT *, lag({measure}) OVER ({ANNUAL_WINDOW}) AS lag1_{measure},
        avg({measure}) OVER ({ANNUAL_WINDOW} ROWS BETWEEN 2 PRECEDING AND CURRENT ROW) AS {mean}
        FROM {name}_silver"""


def _daily_view_sql(name: str, day: str, entity: str, lag: str | None, mean: str, label: str) -> str:
    window = f"PARTITION BY {entity} ORDER BY {day}"
    previous = f", lag({lag}) OVER ({window}) AS lag1_{lag}" if lag else ""
    alias = "" if day == "date" else f", {day} AS date"
    return f"""SELECT *{alias}{previous}, avg({mean}) OVER ({window}
        ROWS BETWEEN 6 PRECEDING AND CURRENT ROW) AS {label} FROM {name}_silver"""


VIEW_SQL = {
    "view_gdp": _annual_view_sql("gdp", "gdp_usd", "gdp_3yr_avg_usd"),
    "view_inflation": _annual_view_sql("inflation", "inflation_pct", "inflation_3yr_avg_pct"),
    "view_exchange_rate": _daily_view_sql(
        "rates", "logical_date", "base_code, currency", "rate", "rate", "rate_7d_avg"
    ),
    "view_weather": _daily_view_sql(
        "weather", "date", "latitude, longitude", None, "temp_max_c", "temp_max_7d_avg_c"
    ),
    "view_crypto": _daily_view_sql(
        "crypto", "logical_date", "coin_id", "price_usd", "price_usd", "price_7d_avg_usd"
    ),
    "view_news": "SELECT *, logical_date AS date FROM news_silver",
}
VIEW_SOURCE = {
    "view_gdp": "world_bank", "view_inflation": "world_bank_inflation",
    "view_exchange_rate": "exchange_rate", "view_weather": "open_meteo",
    "view_crypto": "coingecko", "view_news": "newsapi",
}
VIEW_SHAPES = {
    "view_gdp": (
        "country_iso3 country_name indicator_id year:i gdp_usd:r gdp_growth_rate:r lag1_gdp_usd:r "
        "gdp_3yr_avg_usd:r"
    ),
    "view_inflation": (
        "country_iso3 country_name indicator_id year:i inflation_pct:r inflation_trend:r "
        "lag1_inflation_pct:r inflation_3yr_avg_pct:r"
    ),
    "view_exchange_rate": (
        "base_code currency date:d rate:r exchange_momentum:r lag1_rate:r rate_7d_avg:r"
    ),
    "view_weather": (
        "latitude:r longitude:r date:d temp_max_c:r temp_min_c:r precipitation_mm:r "
        "precip_30d_avg_mm:r rainfall_anomaly_mm:r temp_max_7d_avg_c:r"
    ),
    "view_crypto": (
        "coin_id symbol name date:d price_usd:r market_cap_usd:r volume_usd:r "
        "price_change_pct_24h:r volatility_7d:r lag1_price_usd:r price_7d_avg_usd:r"
    ),
    "view_news": (
        "url source_name title author description published_at:t date:d articles_that_day:b"
    ),
}


def view_ctes(*names: str) -> str:
    """WITH clause that defines the named views."""
    sources = list(dict.fromkeys(VIEW_SOURCE[n] for n in names))
    listed = ", ".join(f"{n} AS ({VIEW_SQL[n]})" for n in names)
    return f"WITH {silver_ctes(*sources)}, {listed}"


def view(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return views.VIEWS[name](warehouse(spark, sf_dir, VIEW_SOURCE[name]))


def _view_query(name: str):
    return lambda spark, sf_dir: view(spark, sf_dir, name)


for _name, _shape in VIEW_SHAPES.items():
    star.add(_name, _shape, _view_query(_name), f"SELECT * FROM {_name}", view_ctes(_name))

# -- roll-ups

_MONTH = "CAST(year(date) AS INTEGER) AS year, CAST(month(date) AS INTEGER) AS month"
ROLLUPS = {
    "agg_gdp_by_country": (
        "view_gdp",
        "country_iso3 country_name years_reported:b first_year:i latest_year:i "
        "first_year_gdp_usd:r latest_gdp_usd:r avg_gdp_growth_rate:r gdp_cagr:r",
        """SELECT country_iso3, country_name, count(*) AS years_reported, min(year) AS first_year,
            max(year) AS latest_year, arg_min(gdp_usd, year) AS first_year_gdp_usd,
            arg_max(gdp_usd, year) AS latest_gdp_usd,
            avg(gdp_growth_rate) AS avg_gdp_growth_rate,
            CASE WHEN arg_min(gdp_usd, year) > 0 AND max(year) > min(year)
                THEN power(arg_max(gdp_usd, year) / arg_min(gdp_usd, year),
                    CAST(1 AS DOUBLE) / (max(year) - min(year))) - 1 END AS gdp_cagr
        FROM view_gdp GROUP BY country_iso3, country_name""",
    ),
    "agg_inflation_by_country": (
        "view_inflation",
        "country_iso3 country_name years_reported:b latest_year:i latest_inflation_pct:r "
        "avg_inflation_pct:r",
        """SELECT country_iso3, country_name, count(*) AS years_reported,
            max(year) AS latest_year, arg_max(inflation_pct, year) AS latest_inflation_pct,
            avg(inflation_pct) AS avg_inflation_pct
        FROM view_inflation GROUP BY country_iso3, country_name""",
    ),
    "agg_exchange_rate_monthly": (
        "view_exchange_rate",
        "base_code currency year:i month:i avg_rate:r min_rate:r max_rate:r days_observed:b",
        f"""SELECT base_code, currency, {_MONTH}, avg(rate) AS avg_rate, min(rate) AS min_rate,
            max(rate) AS max_rate, count(*) AS days_observed
        FROM view_exchange_rate GROUP BY base_code, currency, year(date), month(date)""",
    ),
    "agg_crypto_monthly": (
        "view_crypto",
        "coin_id symbol name year:i month:i avg_price_usd:r avg_volume_usd:r "
        "avg_price_change_pct_24h:r days_observed:b",
        f"""SELECT coin_id, symbol, name, {_MONTH}, avg(price_usd) AS avg_price_usd,
            avg(volume_usd) AS avg_volume_usd,
            avg(price_change_pct_24h) AS avg_price_change_pct_24h, count(*) AS days_observed
        FROM view_crypto GROUP BY coin_id, symbol, name, year(date), month(date)""",
    ),
    "agg_weather_monthly": (
        "view_weather",
        "latitude:r longitude:r year:i month:i avg_temp_max_c:r avg_temp_min_c:r "
        "total_precipitation_mm:r days_observed:b",
        f"""SELECT latitude, longitude, {_MONTH}, avg(temp_max_c) AS avg_temp_max_c,
            avg(temp_min_c) AS avg_temp_min_c, sum(precipitation_mm) AS total_precipitation_mm,
            count(*) AS days_observed
        FROM view_weather GROUP BY latitude, longitude, year(date), month(date)""",
    ),
}


def _rollup_query(name: str, of_view: str):
    return lambda spark, sf_dir: views.VIEWS[name](
        warehouse(spark, sf_dir, VIEW_SOURCE[of_view])
    )


for _name, (_view, _shape, _body) in ROLLUPS.items():
    star.add(_name, _shape, _rollup_query(_name, _view), _body, view_ctes(_view))

# -- roll-ups that loads keep up to date

KEPT_OF = {
    "kept_gdp_by_country": ("agg_gdp_by_country", "world_bank", "year"),
    "kept_inflation_by_country": ("agg_inflation_by_country", "world_bank_inflation", "year"),
    "kept_exchange_rate_monthly": ("agg_exchange_rate_monthly", "exchange_rate", "month(logical_date)"),
    "kept_crypto_monthly": ("agg_crypto_monthly", "coingecko", "month(logical_date)"),
    "kept_weather_monthly": ("agg_weather_monthly", "open_meteo", "month(date)"),
}


def _kept_query(name: str, source: str, period: str):
    """Three loads, the first with stale values of every row; the roll-up is merged from what they kept."""

    def query(spark: SparkSession, sf_dir: str) -> DataFrame:
        wh = Warehouse(spark, scratch_path(spark, "warehouse-kept"), rollups=True)
        wh.create_schema()
        rows = staged_silver(spark, sf_dir, source)
        measures = [c for c in PARTIALS[FACT_OF_SOURCE[source].name].measures if c in rows.columns]
        wh.load(source, rows.withColumns({m: F.lit(-1.0) for m in measures}))
        third = F.expr(f"pmod({period}, 3)")
        wh.load(source, rows.where(third != 0))
        wh.load(source, rows.where(third != 1))
        return KEPT[name](wh)

    return query


for _name, (_agg, _source, _period) in KEPT_OF.items():
    _view, _shape, _body = ROLLUPS[_agg]
    star.add(_name, _shape, _kept_query(_name, _source, _period), _body, view_ctes(_view))


def drill_across_date(spark: SparkSession, sf_dir: str) -> DataFrame:
    return views.drill_across(warehouse(spark, sf_dir, "coingecko", "exchange_rate"))


star.add(
    "drill_across_date",
    "date:d coins:b avg_price_usd:r pairs:b avg_rate:r", drill_across_date,
    """SELECT * FROM (SELECT logical_date AS date, count(*) AS coins,
            avg(price_usd) AS avg_price_usd FROM crypto_silver GROUP BY 1) AS a
        JOIN (SELECT logical_date AS date, count(*) AS pairs, avg(rate) AS avg_rate
            FROM rates_silver GROUP BY 1) AS b USING (date)""",
    f"WITH {silver_ctes('coingecko', 'exchange_rate')}",
)
