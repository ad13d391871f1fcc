"""What is specific to each source: its documents, its Silver contract and its suite."""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidemark.functions import iso_instant
from tidemark.operators.quality import Expectation, between, not_null, same_columns, unique
from tidemark.operators.series import History
from tidemark.sources import schemas


class UnknownSourceError(ValueError):
    """No source of that name is registered."""


@dataclass(frozen=True)
class Source:
    """One feed, from landed document to Silver contract.

    `flatten` turns pages (logical_date, fetched_at, page_no, page) into candidate rows that keep
    their place in the payload (page_no, item_no); rows that pass `usable` are reduced to one per
    `key`; `features` are then added along `history`.
    """

    name: str
    flatten: Callable[[DataFrame], DataFrame]
    usable: Callable[[], Column]
    key: tuple[str, ...]
    partition_cols: tuple[str, ...]
    expectations: tuple[Expectation, ...]
    pages_expected: Column
    history: History | None = None
    features: dict[str, Callable[[History], Column]] = field(default_factory=dict)
    # Name of a column that receives the number of rows of the same day.
    rows_of_day: str | None = None

    @property
    def bronze_schema(self) -> T.StructType:
        return schemas.bronze_schema(self.name)

    @property
    def landed_schema(self) -> T.StructType:
        return schemas.landed_schema(self.name)

    @property
    def silver_schema(self) -> T.StructType:
        return schemas.struct(schemas.SILVER[self.name])

    @property
    def suite(self) -> tuple[Expectation, ...]:
        return (same_columns(*self.silver_schema.fieldNames()), *self.expectations)


# Carried along by every `flatten`: when the row was fetched and where in the payload it stood, and the
# file of the document where the pages have it.
PLACE = ("logical_date", "fetched_at", "page_no", "item_no")
DOCUMENT = "document"


def _carried(pages: DataFrame) -> list[str]:
    return ["logical_date", "fetched_at", "page_no", *[c for c in pages.columns if c == DOCUMENT]]


def _place(rows: DataFrame) -> list[str]:
    return [*PLACE, *[c for c in rows.columns if c == DOCUMENT]]


def _items(pages: DataFrame, array: str) -> DataFrame:
    items = F.posexplode(f"page.{array}").alias("item_no", "item")
    return pages.select(*_carried(pages), items)


def _annual(measure: str) -> Callable[[DataFrame], DataFrame]:
    def flatten(pages: DataFrame) -> DataFrame:
        items = _items(pages, "records")
        return items.select(
            F.col("item.countryiso3code").alias("country_iso3"),
            F.col("item.country.value").alias("country_name"),
            F.col("item.indicator.id").alias("indicator_id"),
            F.col("item.date").try_cast("int").alias("year"),
            F.col("item.value").alias(measure),
            *_place(items),
        )

    return flatten


def _annual_usable() -> Column:
    iso3 = F.col("country_iso3")
    return iso3.isNotNull() & (iso3 != "") & F.col("year").isNotNull()


def _rates(pages: DataFrame) -> DataFrame:
    quotes = F.posexplode("page.rates").alias("item_no", "currency", "rate")
    quoted = pages.select(*_carried(pages), "page.base_code", quotes)
    return quoted.select("base_code", "currency", "rate", *_place(quoted))


def _weather_days(pages: DataFrame) -> DataFrame:
    days = F.posexplode("page.daily.time").alias("item_no", "day")
    placed = pages.select(*_carried(pages), "page", days)

    def reading(name: str) -> Column:
        return F.get(F.col(f"page.daily.{name}"), F.col("item_no"))

    return placed.select(
        F.col("day").try_cast("date").alias("date"),
        F.col("page.latitude").alias("latitude"),
        F.col("page.longitude").alias("longitude"),
        reading("temperature_2m_max").alias("temp_max_c"),
        reading("temperature_2m_min").alias("temp_min_c"),
        reading("precipitation_sum").alias("precipitation_mm"),
        *_place(placed),
    )


def _coins(pages: DataFrame) -> DataFrame:
    items = _items(pages, "coins")
    return items.select(
        F.col("item.id").alias("coin_id"),
        F.col("item.symbol").alias("symbol"),
        F.col("item.name").alias("name"),
        F.col("item.current_price").alias("price_usd"),
        F.col("item.market_cap").alias("market_cap_usd"),
        F.col("item.total_volume").alias("volume_usd"),
        F.col("item.price_change_percentage_24h").alias("price_change_pct_24h"),
        *_place(items),
    )


def _articles(pages: DataFrame) -> DataFrame:
    items = _items(pages, "articles")
    return items.select(
        F.col("item.source.name").alias("source_name"),
        F.col("item.author").alias("author"),
        F.col("item.title").alias("title"),
        F.col("item.description").alias("description"),
        F.col("item.url").alias("url"),
        iso_instant(F.col("item.publishedAt")).alias("published_at"),
        *_place(items),
    )


def _known(*columns: str) -> Callable[[], Column]:
    def usable() -> Column:
        condition = F.col(columns[0]).isNotNull()
        for column in columns[1:]:
            condition = condition & F.col(column).isNotNull()
        return condition

    return usable


ANNUAL_KEY = ("country_iso3", "indicator_id", "year")
ANNUAL_HISTORY = History(("country_iso3", "indicator_id"), "year")
ANNUAL_CHECKS = (
    not_null("country_iso3"),
    not_null("country_name"),
    not_null("indicator_id"),
    not_null("year"),
    not_null("logical_date"),
    unique(*ANNUAL_KEY),
    between("year", 1960, 2100),
)
# Page sizes of the paged feeds.
COINS_PER_PAGE, ARTICLES_PER_PAGE = 100, 100


def _annual_pages() -> Column:
    return F.coalesce(F.max("page.meta.pages"), F.lit(1))


def _coin_pages() -> Column:
    """As long as every page is full another one is due."""
    return F.sum(F.when(F.size("page.coins") == COINS_PER_PAGE, 1).otherwise(0)) + 1


def _article_pages() -> Column:
    needed = F.ceil(F.max("page.totalResults") / ARTICLES_PER_PAGE)
    return F.greatest(F.lit(1), F.coalesce(needed, F.lit(1)))


def _build() -> dict[str, Source]:
    listed = [
        Source(
            name="world_bank",
            flatten=_annual("gdp_usd"),
            usable=_annual_usable,
            key=ANNUAL_KEY,
            partition_cols=("year",),
            expectations=(*ANNUAL_CHECKS, between("gdp_usd", 0)),
            pages_expected=_annual_pages(),
            history=ANNUAL_HISTORY,
            features={"gdp_growth_rate": lambda h: h.growth("gdp_usd")},
        ),
        Source(
            name="world_bank_inflation",
            flatten=_annual("inflation_pct"),
            usable=_annual_usable,
            key=ANNUAL_KEY,
            partition_cols=("year",),
            expectations=(*ANNUAL_CHECKS, between("inflation_pct", -50, 1000)),
            pages_expected=_annual_pages(),
            history=ANNUAL_HISTORY,
            features={"inflation_trend": lambda h: h.change("inflation_pct")},
        ),
        Source(
            name="exchange_rate",
            flatten=_rates,
            usable=lambda: F.col("rate") > 0,
            key=("base_code", "currency", "logical_date"),
            partition_cols=("logical_date",),
            expectations=(
                not_null("base_code"),
                not_null("currency"),
                not_null("rate"),
                not_null("logical_date"),
                unique("base_code", "currency", "logical_date"),
                between("rate", 0, above_low=True),
            ),
            pages_expected=F.lit(1),
            history=History(("base_code", "currency"), "logical_date"),
            features={"exchange_momentum": lambda h: h.growth("rate")},
        ),
        Source(
            name="open_meteo",
            flatten=_weather_days,
            usable=_known("date"),
            key=("latitude", "longitude", "date"),
            partition_cols=("logical_date",),
            expectations=(
                not_null("date"),
                not_null("latitude"),
                not_null("longitude"),
                not_null("logical_date"),
                unique("latitude", "longitude", "date"),
                between("latitude", -90, 90),
                between("longitude", -180, 180),
                between("precipitation_mm", 0),
                between("temp_max_c", -30, 60),
                between("temp_min_c", -50, 50),
            ),
            pages_expected=F.lit(1),
            history=History(("latitude", "longitude"), "date"),
            features={
                "precip_30d_avg_mm": lambda h: h.mean("precipitation_mm", 30),
                "rainfall_anomaly_mm": lambda h: (
                    F.col("precipitation_mm") - h.mean("precipitation_mm", 30)
                ),
            },
        ),
        Source(
            name="coingecko",
            flatten=_coins,
            usable=_known("coin_id", "price_usd"),
            key=("coin_id", "logical_date"),
            partition_cols=("logical_date",),
            expectations=(
                not_null("coin_id"),
                not_null("price_usd"),
                not_null("logical_date"),
                unique("coin_id", "logical_date"),
                between("price_usd", 0),
                between("market_cap_usd", 0),
                between("volume_usd", 0),
            ),
            pages_expected=_coin_pages(),
            history=History(("coin_id",), "logical_date"),
            features={"volatility_7d": lambda h: h.spread("price_change_pct_24h", 7)},
        ),
        Source(
            name="newsapi",
            flatten=_articles,
            usable=_known("title", "url"),
            key=("url",),
            partition_cols=("logical_date",),
            expectations=(
                not_null("title"),
                not_null("url"),
                not_null("logical_date"),
                unique("url"),
                between("articles_that_day", 1),
            ),
            pages_expected=_article_pages(),
            rows_of_day="articles_that_day",
        ),
    ]
    return {source.name: source for source in listed}


SOURCE_NAMES = tuple(schemas.SILVER)


def get_source(name: str) -> Source:
    """The source of that name; an unknown name is an error that lists the known ones."""
    if name not in SOURCE_NAMES:
        raise UnknownSourceError(f"unknown source {name!r}; known: {sorted(SOURCE_NAMES)}")
    # Columns need a running session, so the specs are built on use.
    return _build()[name]
