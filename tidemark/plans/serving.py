"""Parameterised queries over the views: filtered pages, latest rows, job status."""

from __future__ import annotations

from collections.abc import Sequence
from datetime import date

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark.functions import contains_ci
from tidemark.operators.paging import DEFAULT_LIMIT, Page, narrow, ordering
from tidemark.operators.series import last_per_entity
from tidemark.plans import views
from tidemark.plans.warehouse import Warehouse


def _equals(column: str):
    return lambda value: F.col(column) == F.lit(value)


def _from(column: str):
    return lambda value: F.col(column) >= F.lit(value)


def _to(column: str):
    return lambda value: F.col(column) <= F.lit(value)


def _upper(text: str | None) -> str | None:
    return text.upper() if text else text


def _lower(text: str | None) -> str | None:
    return text.lower() if text else text


def list_countries(
    wh: Warehouse, *, search: str | None = None, limit: int = DEFAULT_LIMIT, offset: int = 0
) -> Page:
    def matches(needle: str) -> Column:
        return contains_ci(F.col("country_iso3"), needle) | contains_ci(
            F.col("country_name"), needle
        )

    rows = wh.table("dim_country").select("country_iso3", "country_name")
    return Page(narrow(rows, (search, matches)), ("country_iso3",), limit, offset)


def _annual_page(
    wh: Warehouse, view, country, indicator_id, year_min, year_max, limit, offset
) -> Page:
    code = _upper(country)
    rows = narrow(
        view(wh, entity={"country_iso3": code}, until=year_max),
        (code, _equals("country_iso3")),
        (indicator_id, _equals("indicator_id")),
        (year_min, _from("year")),
        (year_max, _to("year")),
    )
    return Page(rows, ("-year", "country_iso3", "indicator_id"), limit, offset)


def list_gdp(
    wh: Warehouse,
    *,
    country: str | None = None,
    indicator_id: str | None = None,
    year_min: int | None = None,
    year_max: int | None = None,
    limit: int = DEFAULT_LIMIT,
    offset: int = 0,
) -> Page:
    view = views.view_gdp
    return _annual_page(wh, view, country, indicator_id, year_min, year_max, limit, offset)


def list_inflation(
    wh: Warehouse,
    *,
    country: str | None = None,
    indicator_id: str | None = None,
    year_min: int | None = None,
    year_max: int | None = None,
    limit: int = DEFAULT_LIMIT,
    offset: int = 0,
) -> Page:
    view = views.view_inflation
    return _annual_page(wh, view, country, indicator_id, year_min, year_max, limit, offset)


def list_exchange_rates(
    wh: Warehouse,
    *,
    base: str | None = None,
    quote: str | None = None,
    date_from: date | None = None,
    date_to: date | None = None,
    limit: int = DEFAULT_LIMIT,
    offset: int = 0,
) -> Page:
    pair = {"base_code": _upper(base), "currency": _upper(quote)}
    rows = narrow(
        views.view_exchange_rate(wh, entity=pair, until=date_to),
        (pair["base_code"], _equals("base_code")),
        (pair["currency"], _equals("currency")),
        (date_from, _from("date")),
        (date_to, _to("date")),
    )
    return Page(rows, ("-date", "base_code", "currency"), limit, offset)


def list_weather(
    wh: Warehouse,
    *,
    latitude: float | None = None,
    longitude: float | None = None,
    date_from: date | None = None,
    date_to: date | None = None,
    limit: int = DEFAULT_LIMIT,
    offset: int = 0,
) -> Page:
    place = {"latitude": latitude, "longitude": longitude}
    rows = narrow(
        views.view_weather(wh, entity=place, until=date_to),
        (latitude, _equals("latitude")),
        (longitude, _equals("longitude")),
        (date_from, _from("date")),
        (date_to, _to("date")),
    )
    return Page(rows, ("-date", "latitude", "longitude"), limit, offset)


def list_crypto(
    wh: Warehouse,
    *,
    coin_id: str | None = None,
    date_from: date | None = None,
    date_to: date | None = None,
    limit: int = DEFAULT_LIMIT,
    offset: int = 0,
) -> Page:
    coin = _lower(coin_id)
    rows = narrow(
        views.view_crypto(wh, entity={"coin_id": coin}, until=date_to),
        (coin, _equals("coin_id")),
        (date_from, _from("date")),
        (date_to, _to("date")),
    )
    return Page(rows, ("-date", "coin_id"), limit, offset)


def list_news(
    wh: Warehouse,
    *,
    source: str | None = None,
    date_from: date | None = None,
    date_to: date | None = None,
    q: str | None = None,
    limit: int = DEFAULT_LIMIT,
    offset: int = 0,
) -> Page:
    view = views.view_news(wh, entity={"source_name": source}, since=date_from, until=date_to)
    rows = narrow(
        view,
        (source, _equals("source_name")),
        (date_from, _from("date")),
        (date_to, _to("date")),
        (q, lambda needle: contains_ci(F.col("title"), needle)),
    )
    return Page(rows, ("-date", "url"), limit, offset)


def _newest(rows: DataFrame, *order: str) -> DataFrame:
    return rows.orderBy(*ordering(order)).limit(1)


def latest_gdp_row(wh: Warehouse, country: str) -> DataFrame:
    return _newest(views.view_gdp(wh, entity={"country_iso3": country.upper()}), "-year", "indicator_id")


def latest_inflation_row(wh: Warehouse, country: str) -> DataFrame:
    view = views.view_inflation(wh, entity={"country_iso3": country.upper()})
    return _newest(view, "-year", "indicator_id")


def latest_exchange_rate_row(wh: Warehouse, base: str, quote: str) -> DataFrame:
    pair = {"base_code": base.upper(), "currency": quote.upper()}
    return _newest(views.view_exchange_rate(wh, entity=pair), "-date")


def latest_crypto_row(wh: Warehouse, coin_id: str) -> DataFrame:
    return _newest(views.view_crypto(wh, entity={"coin_id": coin_id.lower()}), "-date")


def latest_rows(view: DataFrame, entity: Sequence[str], time: str, *ties: str) -> DataFrame:
    """Latest row of every entity at once: the batch form of the point look-ups above."""
    return last_per_entity(view, entity, (time, *ties))


RUN_COLUMNS = ("state", "execution_date", "start_date", "end_date")


def latest_runs(jobs: DataFrame, runs: DataFrame) -> DataFrame:
    """Every listed job with its most recent run; a job that never ran has null columns.

    The newest run is found by a combined aggregate, so a job with most of the log costs one row
    per task. `runs` has job_id, run_id and the run columns.
    """
    newest_first = F.struct("execution_date", "run_id")
    newest = runs.groupBy("job_id").agg(
        F.max_by(F.struct(*RUN_COLUMNS), newest_first).alias("run")
    )
    return jobs.join(newest, "job_id", "left").select("job_id", "run.*")
