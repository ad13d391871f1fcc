"""Queries a reader asks: pages, latest rows, charts, forecasts, registry."""

from __future__ import annotations

from dataclasses import replace
from datetime import date

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.catalog.feeds import silver_ctes, table
from tidemark.catalog.ingest import one_pull, snapshot, snapshot_sql
from tidemark.catalog.lake import registry, staged_silver, warehouse
from tidemark.catalog.shape import Catalog
from tidemark.catalog.star import VIEW_SHAPES, VIEW_SOURCE, view, view_ctes
from tidemark.operators.regression import LinearModel, error_metrics, least_squares
from tidemark.operators.trigrams import TrigramIndex
from tidemark.plans import charts, forecast, serving
from tidemark.plans.jobs import load_snapshots
from tidemark.plans.refit import MomentStore
from tidemark.plans.warehouse import Warehouse
from tidemark.session import scratch_path
from tidemark.sources.storage import delete

serve = Catalog()

# -- pages

PAGE = "total:b limit:i offset:i"


def _page(name: str, shape: str, feeds: str, list_query, where: str, order: str, limit: int,
          offset: int, relation: str, ctes: str, **chosen) -> None:
    def query(spark: SparkSession, sf_dir: str) -> DataFrame:
        wh = warehouse(spark, sf_dir, *feeds.split())
        return list_query(wh, **chosen, limit=limit, offset=offset).report()

    body = f"""SELECT *, (SELECT count(*) FROM {relation} WHERE {where}) AS total,
        {limit} AS "limit", {offset} AS "offset"
        FROM (SELECT * FROM {relation} WHERE {where} ORDER BY {order}
            LIMIT {limit} OFFSET {offset}) AS page"""
    serve.add(name, f"{shape} {PAGE}", query, body, ctes)


_page(
    "list_countries_search", "country_iso3 country_name", "world_bank world_bank_inflation",
    serving.list_countries,
    "country_iso3 ILIKE '%tion_1%' OR country_name ILIKE '%tion_1%'", "country_iso3", 5, 2,
    "countries",
    f"WITH {silver_ctes('world_bank', 'world_bank_inflation')}, countries AS ("
    "SELECT country_iso3, country_name FROM gdp_silver "
    "UNION SELECT country_iso3, country_name FROM inflation_silver)",
    search="TION_1",
)


def news_search(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Needles, wildcards among them, looked up in the titles of all articles by their trigrams."""
    rows = warehouse(spark, sf_dir, "newsapi").table("fact_news")
    index = TrigramIndex(spark, scratch_path(spark, "trigrams"), rows.select("url").schema, "title")
    index.build(rows)
    found = None
    for needle in NEEDLES:
        hits = index.search(rows, needle).select(F.lit(needle).alias("needle"), "url")
        found = hits if found is None else found.unionByName(hits)
    return found


NEEDLES = ("ING AND", "th%ion", "der_e", "zu", "Élle", "no such words")
serve.add(
    "news_search", "needle url", news_search,
    " UNION ALL ".join(f"SELECT '{n}' AS needle, url FROM news_silver WHERE title ILIKE '%{n}%'" for n in NEEDLES),
    f"WITH {silver_ctes('newsapi')}",
)


def deep_page(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The page nine tenths into the largest view, found by counting ranges of sampled keys."""
    page = serving.list_weather(warehouse(spark, sf_dir, "open_meteo"))
    return replace(page, offset=page.total() * 9 // 10, deep=100).report()


serve.add(
    "list_weather_deep", f"{VIEW_SHAPES['view_weather']} {PAGE}", deep_page,
    """SELECT * FROM (SELECT *, 50 AS "limit", row_number() OVER (
                ORDER BY view_weather.date DESC NULLS LAST, latitude NULLS LAST, longitude NULLS LAST) AS rank_here
            FROM view_weather) AS placed,
        (SELECT count(*) AS total, count(*) * 9 // 10 AS "offset" FROM view_weather) AS counted
    WHERE rank_here > "offset" AND rank_here <= "offset" + 50""",
    view_ctes("view_weather"),
)
_page(
    "list_gdp_page", VIEW_SHAPES["view_gdp"], "world_bank", serving.list_gdp,
    "year >= 2019 AND year <= 2022", "year DESC NULLS LAST, country_iso3, indicator_id", 50, 10,
    "view_gdp", view_ctes("view_gdp"), year_min=2019, year_max=2022,
)
_page(
    "list_gdp_country", VIEW_SHAPES["view_gdp"], "world_bank", serving.list_gdp,
    "country_iso3 = 'N07' AND indicator_id = 'NY.GDP.MKTP.CD' AND year >= 2019",
    "year DESC NULLS LAST, country_iso3, indicator_id", 50, 0, "view_gdp", view_ctes("view_gdp"),
    country="n07", indicator_id="NY.GDP.MKTP.CD", year_min=2019,
)
_page(
    "list_inflation_page", VIEW_SHAPES["view_inflation"], "world_bank_inflation",
    serving.list_inflation, "country_iso3 = 'N05'",
    "year DESC NULLS LAST, country_iso3, indicator_id", 3, 1, "view_inflation",
    view_ctes("view_inflation"), country="n05",
)
_page(
    "list_fx_page", VIEW_SHAPES["view_exchange_rate"], "exchange_rate",
    serving.list_exchange_rates,
    "base_code = 'USD' AND currency = 'EUR' AND date >= DATE '2020-01-01'",
    "date DESC NULLS LAST, base_code, currency", 500, 20, "view_exchange_rate",
    view_ctes("view_exchange_rate"), base="usd", quote="eur", date_from=date(2020, 1, 1),
)
_page(
    "list_weather_page", VIEW_SHAPES["view_weather"], "open_meteo", serving.list_weather,
    "latitude = CAST(0.3476 AS DOUBLE) AND longitude = CAST(32.5825 AS DOUBLE) "
    "AND date >= DATE '1997-06-01' AND date <= DATE '1998-06-01'",
    "date DESC NULLS LAST, latitude, longitude", 100, 0, "view_weather",
    view_ctes("view_weather"), latitude=0.3476, longitude=32.5825, date_from=date(1997, 6, 1),
    date_to=date(1998, 6, 1),
)
_page(
    "list_crypto_page", VIEW_SHAPES["view_crypto"], "coingecko", serving.list_crypto,
    "coin_id = 'bitcoin' AND date <= DATE '2024-01-20'", "date DESC NULLS LAST, coin_id", 10, 5,
    "view_crypto", view_ctes("view_crypto"), coin_id="BitCoin", date_to=date(2024, 1, 20),
)
_page(
    "list_news_page", VIEW_SHAPES["view_news"], "newsapi", serving.list_news,
    "title ILIKE '%the%' AND source_name = 'src3'", "date DESC NULLS LAST, url", 25, 0,
    "view_news", view_ctes("view_news"), q="THE", source="src3",
)

# -- latest rows

LATEST = {
    "latest_gdp_per_country": ("view_gdp", ("country_iso3",), "year"),
    "latest_inflation_per_country": ("view_inflation", ("country_iso3",), "year"),
    "latest_rate_per_pair": ("view_exchange_rate", ("base_code", "currency"), "date"),
    "latest_price_per_coin": ("view_crypto", ("coin_id",), "date"),
}


def latest_price_per_coin(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The flagship: documents to Silver to star schema to features to one row per coin."""
    name, entity, time = LATEST["latest_price_per_coin"]
    return serving.latest_rows(view(spark, sf_dir, name), entity, time)


def _latest_query(name: str, entity: tuple[str, ...], time: str):
    return lambda spark, sf_dir: serving.latest_rows(view(spark, sf_dir, name), entity, time)


for _name, (_view, _entity, _time) in LATEST.items():
    _body = f"""SELECT * FROM (SELECT *, row_number() OVER (
        PARTITION BY {', '.join(_entity)} ORDER BY {_time} DESC) AS age FROM {_view}) AS ranked
        WHERE age = 1"""
    serve.add(
        _name, VIEW_SHAPES[_view], _latest_query(_view, _entity, _time), _body, view_ctes(_view)
    )

POINTS = {
    "latest_gdp_row": (
        "view_gdp", lambda wh: serving.latest_gdp_row(wh, "n03"),
        "country_iso3 = 'N03' ORDER BY year DESC",
    ),
    "latest_inflation_row": (
        "view_inflation", lambda wh: serving.latest_inflation_row(wh, "n03"),
        "country_iso3 = 'N03' ORDER BY year DESC",
    ),
    "latest_exchange_rate_row": (
        "view_exchange_rate", lambda wh: serving.latest_exchange_rate_row(wh, "kes", "gbp"),
        "base_code = 'KES' AND currency = 'GBP' ORDER BY date DESC",
    ),
    "latest_crypto_row": (
        "view_crypto", lambda wh: serving.latest_crypto_row(wh, "Solana"),
        "coin_id = 'solana' ORDER BY date DESC",
    ),
}


def _point_query(name: str, ask):
    return lambda spark, sf_dir: ask(warehouse(spark, sf_dir, VIEW_SOURCE[name]))


for _name, (_view, _ask, _where) in POINTS.items():
    serve.add(
        _name, VIEW_SHAPES[_view], _point_query(_view, _ask),
        f"SELECT * FROM {_view} WHERE {_where} LIMIT 1", view_ctes(_view),
    )

# Event types stand for the training jobs; one listed job never ran.
JOBS = {
    "click": "train_gdp_forecast", "view": "train_inflation_forecast",
    "purchase": "train_exchange_rate_forecast", "never": "train_crypto_forecast",
}


def latest_run_per_job(spark: SparkSession, sf_dir: str) -> DataFrame:
    jobs = spark.createDataFrame([(j,) for j in JOBS.values()], "job_id string")
    named = F.coalesce(*[F.when(F.col("event_type") == e, F.lit(j)) for e, j in JOBS.items()], "event_type")
    runs = table(spark, sf_dir, "events").select(
        named.alias("job_id"),
        F.col("event_id").alias("run_id"),
        F.when(F.col("value") >= 250, "success").otherwise("failed").alias("state"),
        F.col("ts").alias("execution_date"),
        F.col("ts").alias("start_date"),
        F.col("ts").alias("end_date"),
    )
    return serving.latest_runs(jobs, runs)


_JOB_ROWS = ", ".join(f"('{e}', '{j}')" for e, j in JOBS.items())
serve.add(
    "latest_run_per_job", "job_id state execution_date:t start_date:t end_date:t",
    latest_run_per_job,
    f"""SELECT job_id, state, ts AS execution_date, ts AS start_date, ts AS end_date
    FROM (VALUES {_JOB_ROWS}) AS jobs(kind, job_id) LEFT JOIN (
        SELECT *, CASE WHEN value >= 250 THEN 'success' ELSE 'failed' END AS state,
            row_number() OVER (PARTITION BY event_type ORDER BY ts DESC, event_id DESC) AS place
        FROM events) AS runs ON runs.event_type = jobs.kind AND place = 1""",
)

# -- charts

_GROUPS = " AND ".join(f"country_name NOT LIKE '{p}'" for p in charts.GROUP_PATTERNS)
_SINGLE = f"{_GROUPS} AND country_name NOT IN ({', '.join(repr(n) for n in charts.GROUP_NAMES)})"
_COINS = f"coin_id IN ({', '.join(repr(c) for c in charts.MAJOR_COINS)})"
_CODES = f"currency IN ({', '.join(repr(c) for c in charts.MAJOR_CURRENCIES)})"


def _raw_sql(relation: str, columns: str, time: str, where: str = "true") -> str:
    names = [c.partition(":")[0] for c in columns.split()]
    order = [time, *[c for c in names if c != time]]
    ordered = ", ".join(f"{c} ASC NULLS LAST" for c in order)
    return f"SELECT {', '.join(names)} FROM {relation} WHERE {where} ORDER BY {ordered}"


def _grouped_sql(
    relation: str, groups: str, metrics: str, order: str, limit: int | None = None, where: str = "true"
):
    cut = "" if limit is None else f" LIMIT {limit}"
    return (
        f"SELECT {groups}, {metrics} FROM {relation} WHERE {where} GROUP BY {groups} "
        f"ORDER BY {order}{cut}"
    )


def _top_series_sql(relation: str, measure: str) -> str:
    label = f"avg_{measure}"
    best = (
        f"SELECT country_name FROM {relation} WHERE {_SINGLE} GROUP BY country_name "
        f"ORDER BY round(avg({measure}), 6) DESC NULLS LAST, country_name LIMIT 10"
    )
    return _grouped_sql(
        relation, "year, country_name", f"avg({measure}) AS {label}",
        "year, country_name", None,
        f"{_SINGLE} AND country_name IN ({best})",
    )


_RAIN = 'avg(precipitation_mm) AS "Avg Precipitation (mm)"'
CHART_SQL = {
    "gdp_table": (
        "country_iso3 country_name year:i gdp_usd:r gdp_growth_rate:r", "view_gdp", None,
    ),
    "gdp_bar": (
        "country_name avg_gdp_usd:r", "view_gdp",
        _grouped_sql(
            "view_gdp", "country_name", "avg(gdp_usd) AS avg_gdp_usd",
            "round(avg_gdp_usd, 6) DESC NULLS LAST, country_name", 15, f"year = 2023 AND {_SINGLE}",
        ),
    ),
    "gdp_line": (
        "year:i country_name avg_gdp_usd:r", "view_gdp", _top_series_sql("view_gdp", "gdp_usd"),
    ),
    "inflation_table": (
        "country_iso3 country_name year:i inflation_pct:r inflation_trend:r", "view_inflation",
        None,
    ),
    "inflation_bar": (
        "country_name avg_inflation_pct:r", "view_inflation",
        _grouped_sql(
            "view_inflation", "country_name", "avg(inflation_pct) AS avg_inflation_pct",
            "round(avg_inflation_pct, 6) DESC NULLS LAST, country_name", 15, f"year = 2023 AND {_SINGLE}",
        ),
    ),
    "inflation_line": (
        "year:i country_name avg_inflation_pct:r", "view_inflation",
        _top_series_sql("view_inflation", "inflation_pct"),
    ),
    "exchange_table": (
        "date:d base_code currency rate:r rate_7d_avg:r", "view_exchange_rate", None,
    ),
    "exchange_bar": (
        "currency avg_rate:r", "view_exchange_rate",
        _grouped_sql(
            "view_exchange_rate", "currency", "avg(rate) AS avg_rate",
            "round(avg_rate, 6) DESC NULLS LAST, currency", 8, _CODES,
        ),
    ),
    "exchange_line": (
        "date:d currency avg_rate:r", "view_exchange_rate",
        _grouped_sql(
            "view_exchange_rate", "date, currency", "avg(rate) AS avg_rate",
            "date, currency", None, _CODES,
        ),
    ),
    "crypto_table": (
        "date:d coin_id symbol price_usd:r volatility_7d:r", "view_crypto", None,
    ),
    "crypto_bar": (
        "coin_id avg_volatility_7d:r", "view_crypto",
        _grouped_sql(
            "view_crypto", "coin_id", "avg(volatility_7d) AS avg_volatility_7d",
            "round(avg_volatility_7d, 6) DESC NULLS LAST, coin_id", 8, _COINS,
        ),
    ),
    "crypto_line": (
        "date:d coin_id avg_price_usd:r", "view_crypto",
        _grouped_sql(
            "view_crypto", "date, coin_id", "avg(price_usd) AS avg_price_usd",
            "date, coin_id", None, _COINS,
        ),
    ),
    "weather_table": (
        "date:d latitude:r longitude:r temp_max_c:r precipitation_mm:r rainfall_anomaly_mm:r",
        "view_weather", None,
    ),
    "weather_bar": (
        None, "view_weather",
        _grouped_sql("view_weather", "date", _RAIN, "date"),
    ),
    "weather_line": (
        None, "view_weather",
        _grouped_sql(
            "view_weather", "date", f"avg(temp_max_c) AS avg_temp_max_c, {_RAIN}",
            "date",
        ),
    ),
    "weather_scatter": (
        "date:d avg_longitude:r avg_latitude:r avg_temp_max_c:r", "view_weather",
        _grouped_sql(
            "view_weather", "date",
            "avg(longitude) AS avg_longitude, avg(latitude) AS avg_latitude, "
            "avg(temp_max_c) AS avg_temp_max_c",
            "date",
        ),
    ),
}
# These labels hold blanks, so the query names the column plainly.
_PLAIN = "avg_precipitation"


def _chart_query(name: str, of_view: str):
    def query(spark: SparkSession, sf_dir: str) -> DataFrame:
        shown = charts.chart(warehouse(spark, sf_dir, VIEW_SOURCE[of_view]), name)
        return shown.withColumnRenamed(charts.AVG_RAIN.label, _PLAIN)

    return query


for _name, (_shape, _view, _body) in CHART_SQL.items():
    if _body is None:
        _time = charts.CHARTS[_name].order[0]
        _body = _raw_sql(_view, _shape, _time)
    if _shape is None:
        _body = _body.replace('"Avg Precipitation (mm)"', _PLAIN)
        _shape = "date:d " + ("avg_temp_max_c:r " if _name == "weather_line" else "") + f"{_PLAIN}:r"
    serve.add(f"chart_{_name}", _shape, _chart_query(_name, _view), _body, view_ctes(_view))


def cross_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The price line after a click on one coin of the volatility bars."""
    return charts.chart(warehouse(spark, sf_dir, "coingecko"), "crypto_line", coin_id="tron")


serve.add(
    "chart_cross_filter", "date:d coin_id avg_price_usd:r", cross_filter,
    """SELECT date, coin_id, avg(price_usd) AS avg_price_usd FROM view_crypto
    WHERE coin_id = 'tron' GROUP BY date, coin_id""",
    view_ctes("view_crypto"),
)


def table_page(spark: SparkSession, sf_dir: str) -> DataFrame:
    return charts.raw_table_page(warehouse(spark, sf_dir, "coingecko"), "crypto_table", page=3)


_TABLE_COLUMNS = CHART_SQL["crypto_table"][0]
serve.add(
    "chart_table_page", _TABLE_COLUMNS, table_page,
    _raw_sql("view_crypto", _TABLE_COLUMNS, "date") + " LIMIT 10 OFFSET 30", view_ctes("view_crypto"),
)


def filter_values(spark: SparkSession, sf_dir: str) -> DataFrame:
    return charts.filter_values(warehouse(spark, sf_dir, "coingecko"), "crypto", "coin_id")


serve.add(
    "chart_filter_values", "coin_id", filter_values,
    "SELECT DISTINCT coin_id FROM view_crypto WHERE coin_id IS NOT NULL", view_ctes("view_crypto"),
)


def overview(spark: SparkSession, sf_dir: str) -> DataFrame:
    wh = warehouse(spark, sf_dir, "world_bank", "world_bank_inflation", "exchange_rate", "coingecko")
    return charts.overview_cards(wh, registry(spark, sf_dir).listing())


serve.add(
    "overview_cards", "card entity value:r", overview,
    """SELECT 'countries' AS card, 'all' AS entity, CAST(count(*) AS DOUBLE) AS value FROM (
            SELECT country_iso3 FROM view_gdp UNION SELECT country_iso3 FROM inflation_silver) AS c
        UNION ALL SELECT * FROM (SELECT 'latest_rate', base_code || '/' || currency, rate
            FROM view_exchange_rate ORDER BY date DESC, base_code, currency LIMIT 1) AS r
        UNION ALL SELECT * FROM (SELECT 'latest_price', upper(symbol), price_usd
            FROM view_crypto ORDER BY date DESC, coin_id LIMIT 1) AS p
        UNION ALL SELECT 'champions', 'of 4', CAST(4 AS DOUBLE)""",
    view_ctes("view_gdp", "view_inflation", "view_exchange_rate", "view_crypto"),
)

# -- forecasts

_SPECS = forecast.FORECASTS
_VIEW_OF = {d: s.view.__name__ for d, s in _SPECS.items()}


def _usable(spark: SparkSession, sf_dir: str, domain: str) -> DataFrame:
    spec = _SPECS[domain]
    return forecast.usable_rows(view(spark, sf_dir, _VIEW_OF[domain]), spec)


def _usable_sql(domain: str) -> str:
    spec = _SPECS[domain]
    needed = (*spec.features, spec.target)
    known = " AND ".join(f"{c} IS NOT NULL" for c in needed)
    columns = ", ".join([*spec.entity, spec.time, *needed])
    return f"""usable AS (SELECT {columns}, row_number() OVER (
        PARTITION BY {', '.join(spec.entity)} ORDER BY {spec.time} DESC) = 1 AS is_holdout
        FROM {_VIEW_OF[domain]} WHERE {known})"""


def _fit_sql(domain: str) -> str:
    """CTE `fit` with the closed-form coefficients over the training rows of `usable`."""
    spec = _SPECS[domain]
    names = (spec.lag, spec.rolling, spec.target)
    a, b, y = (f"ln(1 + {c})" if spec.log_scale else c for c in names)
    return f"""moments AS (SELECT count(*) AS n, avg({a}) AS ma, avg({b}) AS mb, avg({y}) AS my,
            var_pop({a}) AS aa, var_pop({b}) AS bb, covar_pop({a}, {b}) AS ab,
            covar_pop({a}, {y}) AS ay, covar_pop({b}, {y}) AS yb
            FROM usable WHERE NOT is_holdout),
        slopes AS (SELECT *, (ay * bb - yb * ab) / (aa * bb - ab * ab) AS coef_lag,
            (yb * aa - ay * ab) / (aa * bb - ab * ab) AS coef_rolling FROM moments),
        fit AS (SELECT my - coef_lag * ma - coef_rolling * mb AS intercept, coef_lag,
            coef_rolling, n AS train_rows FROM slopes)"""


def _prediction_sql(domain: str) -> str:
    spec = _SPECS[domain]
    a, b = (f"ln(1 + {c})" if spec.log_scale else c for c in spec.features)
    line = f"intercept + coef_lag * {a} + coef_rolling * {b}"
    return f"exp({line}) - 1" if spec.log_scale else line


def _split_query(domain: str):
    def query(spark: SparkSession, sf_dir: str) -> DataFrame:
        return _usable(spark, sf_dir, domain)

    return query


def _fit_query(domain: str):
    def query(spark: SparkSession, sf_dir: str) -> DataFrame:
        spec = _SPECS[domain]
        rows = _usable(spark, sf_dir, domain).where("not is_holdout")
        return least_squares(rows, *spec.features, spec.target, spec.log_scale)

    return query


def _refit_query(domain: str):
    """A fit from kept moments: every period once with stale values, then in three batches as it is."""

    def query(spark: SparkSession, sf_dir: str) -> DataFrame:
        spec = _SPECS[domain]
        rows = view(spark, sf_dir, _VIEW_OF[domain])
        store = MomentStore(spark, scratch_path(spark, f"moments-{domain}"), spec, rows)
        store.add(rows.withColumn(spec.target, F.col(spec.target) / 2))
        third = F.pmod(F.col("year") if spec.time == "year" else F.month(spec.time), F.lit(3))
        for batch in range(3):
            store.add(rows.where(third == batch))
        return store.fit()

    return query


def _metrics_query(domain: str):
    def query(spark: SparkSession, sf_dir: str) -> DataFrame:
        spec = _SPECS[domain]
        rows = _usable(spark, sf_dir, domain)
        result = forecast.train(view(spark, sf_dir, _VIEW_OF[domain]), spec)
        scored = rows.where("is_holdout").withColumn(
            "predicted", result.model.predict(F.col(spec.lag), F.col(spec.rolling))
        )
        return error_metrics(scored, spec.target, "predicted").withColumn(
            "train_rows", F.lit(result.train_rows)
        )

    return query


def _score_query(domain: str):
    def query(spark: SparkSession, sf_dir: str) -> DataFrame:
        spec = _SPECS[domain]
        champion = registry(spark, sf_dir, domain).champion_model(domain)
        return forecast.score_latest(view(spark, sf_dir, _VIEW_OF[domain]), spec, champion)

    return query


for _domain, _spec in _SPECS.items():
    _of = _VIEW_OF[_domain]
    _with = f"{view_ctes(_of)}, {_usable_sql(_domain)}"
    _fitted = f"{_with}, {_fit_sql(_domain)}"
    _time = f"{_spec.time}:{'i' if _spec.time == 'year' else 'd'}"
    _keys = " ".join(_spec.entity)
    _measures = " ".join(f"{c}:r" for c in (*_spec.features, _spec.target))
    serve.add(
        f"forecast_split_{_domain}", f"{_keys} {_time} {_measures} is_holdout",
        _split_query(_domain), "SELECT * FROM usable", _with,
    )
    serve.add(
        f"forecast_fit_{_domain}", "intercept:r4 coef_lag:r4 coef_rolling:r4 train_rows:b",
        _fit_query(_domain), "SELECT * FROM fit", _fitted,
    )
    serve.add(
        f"forecast_refit_{_domain}", "intercept:r4 coef_lag:r4 coef_rolling:r4 train_rows:b",
        _refit_query(_domain), "SELECT * FROM fit", _fitted,
    )
    serve.add(
        f"forecast_metrics_{_domain}", "mae:r2 rmse:r2 test_rows:b train_rows:b",
        _metrics_query(_domain),
        f"""SELECT avg(abs(error)) AS mae, sqrt(avg(error * error)) AS rmse,
            count(*) AS test_rows, max(train_rows) AS train_rows
        FROM (SELECT {_spec.target} - ({_prediction_sql(_domain)}) AS error, train_rows
            FROM usable, fit WHERE is_holdout) AS scored""",
        _fitted,
    )
    _known = f"{_spec.lag} IS NOT NULL AND {_spec.rolling} IS NOT NULL"
    serve.add(
        f"batch_score_{_domain}",
        f"domain {_keys} {_time} {' '.join(f'{c}:r' for c in _spec.features)} status "
        "predicted_value:r2 model_version:b",
        _score_query(_domain),
        f"""SELECT '{_domain}' AS domain, *,
            CASE WHEN {_known} THEN 'ok' ELSE 'not_enough_history' END AS status,
            CASE WHEN {_known} THEN {_prediction_sql(_domain)} END AS predicted_value,
            CASE WHEN {_known} THEN 1 END AS model_version
        FROM (SELECT *, row_number() OVER (PARTITION BY {', '.join(_spec.entity)}
            ORDER BY {_spec.time} DESC) AS age FROM {_of}) AS latest, fit WHERE age = 1""",
        _fitted,
    )



def point_forecasts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A request per user seen in the events: in capitals, of unknown coins, or without a name."""
    user = F.col("user_id")
    name = F.when(user % 7 == 0, F.lit("")).when(user % 7 == 1, F.concat(F.lit("none-"), user.cast("string"))).when(
        user % 7 != 2, F.concat(F.lit("COIN-"), user.cast("string"))
    )
    requests = table(spark, sf_dir, "events").select("user_id").distinct().select(name.alias("coin_id"))
    return forecast.answers(requests, _score_query("crypto")(spark, sf_dir), _SPECS["crypto"])


serve.add(
    "point_forecasts", "coin_id status predicted_value:r2 model_version:b", point_forecasts,
    f"""SELECT asked AS coin_id,
        CASE WHEN coalesce(asked, '') = '' THEN 'missing_parameter' WHEN coin_id IS NULL THEN 'no_data'
            WHEN lag1_price_usd IS NOT NULL AND price_7d_avg_usd IS NOT NULL THEN 'ok' ELSE 'not_enough_history' END AS status,
        CASE WHEN lag1_price_usd IS NOT NULL AND price_7d_avg_usd IS NOT NULL THEN {_prediction_sql('crypto')} END AS predicted_value,
        CASE WHEN lag1_price_usd IS NOT NULL AND price_7d_avg_usd IS NOT NULL THEN 1 END AS model_version
    FROM (SELECT CASE WHEN user_id % 7 = 0 THEN '' WHEN user_id % 7 = 1 THEN 'none-' || user_id
            WHEN user_id % 7 <> 2 THEN 'COIN-' || user_id END AS asked FROM (SELECT DISTINCT user_id FROM events) AS users) AS requests
        LEFT JOIN (SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY coin_id ORDER BY date DESC) AS age
            FROM view_crypto) AS aged WHERE age = 1) AS latest ON lower(asked) = coin_id, fit""",
    f"{view_ctes('view_crypto')}, {_usable_sql('crypto')}, {_fit_sql('crypto')}",
)

# -- registry over many versions: every event is a registered version of its type's model

_MODEL_SQL = """versions AS (SELECT event_type || '_forecast' AS model, event_id AS version,
        value AS mae FROM events),
    best AS (SELECT * FROM (SELECT *, row_number() OVER (
        PARTITION BY model ORDER BY version) AS place FROM versions) AS ranked
        WHERE place = 1)"""


def _versions(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "events").select(
        F.concat("event_type", F.lit("_forecast")).alias("model"),
        F.col("event_id").alias("version"),
        F.col("event_id").cast("string").alias("run_id"),
        F.col("value").alias("mae"),
    )


def _champions(versions: DataFrame) -> DataFrame:
    """The first version of every model, which later ones may or may not be better than."""
    return versions.groupBy("model").agg(
        F.min(F.struct("version", "mae")).alias("first")
    ).select("model", F.col("first.version").alias("version"), F.col("first.mae").alias("mae"))


def champion_gate(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every version against its model's champion; the signup model has none yet."""
    versions = _versions(spark, sf_dir)
    champions = _champions(versions).where("model <> 'signup_forecast'")
    decided = forecast.promotion_decisions(
        versions.select("model", "version", "mae"),
        champions.select("model", F.col("mae").alias("champion_mae")),
    )
    return decided


serve.add(
    "champion_gate", "model version:b mae:r champion_mae:r promote", champion_gate,
    """SELECT versions.model, versions.version, versions.mae, best.mae AS champion_mae,
        best.mae IS NULL OR versions.mae < best.mae AS promote
    FROM versions LEFT JOIN best ON versions.model = best.model
        AND best.model <> 'signup_forecast'""",
    f"WITH {_MODEL_SQL}",
)


def registry_appends(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Runs of all weekdays logged and registered in order, three days in a second batch: the listing.

    Metrics come from the events: the mean value of each weekday stands for the error of a run.
    """
    root = scratch_path(spark, "registry-appends")
    models = forecast.Registry(spark, root)
    errors = table(spark, sf_dir, "events").groupBy("event_type", F.dayofweek("ts").alias("run")).agg(
        F.round(F.avg("value"), 6).alias("mae")
    )
    none = [F.lit(0.0).alias(c) for c in ("intercept", "coef_lag", "coef_rolling")]
    runs = errors.select(
        F.concat_ws("-", "event_type", "run").alias("run_id"), F.concat("event_type", F.lit("_forecast")).alias("model"),
        F.create_map().cast("map<string,string>").alias("params"), F.create_map(F.lit("mae"), F.col("mae")).alias("metrics"),
        *none, F.lit(False).alias("log_scale"), F.lit(1).cast("long").alias("train_rows"), F.lit(1).cast("long").alias("test_rows"),
        F.make_timestamp(F.lit(2024), F.lit(1), F.col("run"), F.lit(0), F.lit(0), F.lit(0)).alias("started_at"), "run",
    )
    for days in (F.col("run") < 5, F.col("run") >= 5):
        models.log_and_register(runs.where(days).drop("run"))
        models.promote_best()
    listed = models.listing()
    return listed.withColumn("mae", F.try_element_at("metrics", F.lit("mae")))


serve.add(
    "registry_appends", "name latest_version:i champion_version:i mae:r", registry_appends,
    """SELECT event_type || '_forecast' AS name, count(*) AS latest_version,
        arg_min(version, (mae, version)) AS champion_version, min(mae) AS mae
    FROM (SELECT event_type, round(avg(value), 6) AS mae,
            row_number() OVER (PARTITION BY event_type ORDER BY dayofweek(ts)) AS version
        FROM events GROUP BY event_type, dayofweek(ts)) AS runs
    GROUP BY event_type""",
)


def registry_listing(spark: SparkSession, sf_dir: str) -> DataFrame:
    versions = _versions(spark, sf_dir)
    aliases = (
        _champions(versions)
        .where("model <> 'signup_forecast'")
        .select("model", F.lit(forecast.CHAMPION).alias("alias"), "version")
    )
    runs = versions.select("run_id", F.create_map(F.lit("mae"), F.col("mae")).alias("metrics"))
    listed = forecast.registry_listing(versions.select("model", "version", "run_id"), aliases, runs)
    return listed.withColumn("mae", F.try_element_at("metrics", F.lit("mae")))


serve.add(
    "registry_listing", "name latest_version:b champion_version:b mae:r", registry_listing,
    """SELECT versions.model AS name, max(versions.version) AS latest_version,
        max(best.version) AS champion_version, max(best.mae) AS mae
    FROM versions LEFT JOIN best ON versions.model = best.model
        AND best.model <> 'signup_forecast' GROUP BY versions.model""",
    f"WITH {_MODEL_SQL}",
)


def snapshot_load_status(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Single pulls of two feeds loaded and one that says nothing but fails: the others load all the same."""
    root = scratch_path(spark, "warehouse-snapshot")
    wh = Warehouse(spark, root)
    wh.create_schema()

    def broken() -> DataFrame:
        raise RuntimeError

    status = load_snapshots(
        wh,
        {
            "exchange_rate": lambda: snapshot("exchange_rate")(spark, sf_dir),
            "newsapi": broken,
            "world_bank": lambda: snapshot("world_bank")(spark, sf_dir),
        },
    )
    delete(spark, root)
    return status


_PULLED = ("exchange_rate", "world_bank")
serve.add(
    "snapshot_load_status", "source rows:b error", snapshot_load_status,
    " UNION ALL ".join(
        f"SELECT '{s}' AS source, count(*) AS rows, CAST(NULL AS VARCHAR) AS error FROM "
        f"({one_pull(s)} {snapshot_sql(s, '0 AS one')}) AS loaded" for s in _PULLED
    )
    + " UNION ALL SELECT 'newsapi', NULL, 'RuntimeError()'",
)
