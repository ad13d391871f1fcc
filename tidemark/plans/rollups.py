"""Partial aggregates of facts, kept per entity and partition and merged when they are read."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

READING = T.StructType([T.StructField("at", T.IntegerType()), T.StructField("value", T.DoubleType())])
MEASURE = T.StructType([
    T.StructField("n", T.LongType()), T.StructField("total", T.DoubleType()), T.StructField("low", T.DoubleType()),
    T.StructField("high", T.DoubleType()), T.StructField("first", READING), T.StructField("last", READING),
])


@dataclass(frozen=True)
class Partials:
    """What is kept of a fact: entity keys, the time that orders its rows, and measures."""

    entity: tuple[str, ...]
    time: str
    measures: tuple[str, ...]

    def schema(self, partition: str) -> T.StructType:
        return T.StructType([
            *[T.StructField(c, T.IntegerType()) for c in (*self.entity, partition)],
            T.StructField("rows", T.LongType()),
            T.StructField("first_time", T.IntegerType()), T.StructField("last_time", T.IntegerType()),
            *[T.StructField(m, MEASURE) for m in self.measures],
        ])

    def of(self, rows: DataFrame, partition: str) -> DataFrame:
        """Rows of a fact as partial aggregates, one per entity and partition."""

        def measure(name: str) -> Column:
            value, known = F.col(name), F.when(F.col(name).isNotNull(), F.col(self.time))
            reading = F.when(value.isNotNull(), F.struct(known.alias("at"), value.alias("value")))
            parts = {
                "n": F.count(value), "total": F.sum(value), "low": F.min(value), "high": F.max(value),
                "first": F.min_by(reading, known), "last": F.max_by(reading, known),
            }
            return F.struct(*[c.alias(n) for n, c in parts.items()]).alias(name)

        return rows.groupBy(*self.entity, partition).agg(
            F.count(F.lit(1)).alias("rows"), F.min(self.time).alias("first_time"), F.max(self.time).alias("last_time"),
            *[measure(m) for m in self.measures],
        )

    def merged(self, partials: DataFrame, *by: Column | str) -> DataFrame:
        """Partial aggregates of larger groups: `by` may be coarser than entity and partition."""

        def measure(name: str) -> Column:
            first, last = F.col(f"{name}.first"), F.col(f"{name}.last")
            parts = {
                "n": F.sum(f"{name}.n"), "total": F.sum(f"{name}.total"), "low": F.min(f"{name}.low"), "high": F.max(f"{name}.high"),
                "first": F.min_by(first, first["at"]), "last": F.max_by(last, last["at"]),
            }
            return F.struct(*[c.alias(n) for n, c in parts.items()]).alias(name)

        return partials.groupBy(*by).agg(
            F.sum("rows").alias("rows"), F.min("first_time").alias("first_time"), F.max("last_time").alias("last_time"),
            *[measure(m) for m in self.measures],
        )


def mean(measure: str) -> Column:
    """The mean of the known values; null without any."""
    return F.try_divide(F.col(f"{measure}.total"), F.col(f"{measure}.n"))


PARTIALS = {
    "fact_gdp": Partials(("country_key",), "year", ("gdp_usd", "gdp_growth_rate")),
    "fact_inflation": Partials(("country_key",), "year", ("inflation_pct",)),
    "fact_exchange_rate": Partials(("base_currency_key", "quote_currency_key"), "date_key", ("rate",)),
    "fact_weather": Partials(("location_key",), "date_key", ("temp_max_c", "temp_min_c", "precipitation_mm")),
    "fact_crypto": Partials(("coin_key",), "date_key", ("price_usd", "volume_usd", "price_change_pct_24h")),
}


def _months(partials: DataFrame) -> DataFrame:
    month = F.col("month_key")
    return partials.withColumns({"year": F.floor(month / 100).cast("int"), "month": (month % 100).cast("int")})


def kept_gdp_by_country(wh) -> DataFrame:
    """The columns of `agg_gdp_by_country`, from what is kept."""
    kept = PARTIALS["fact_gdp"].merged(wh.partials("fact_gdp"), "country_key")
    first, latest = F.col("gdp_usd.first.value"), F.col("gdp_usd.last.value")
    span = F.col("last_time") - F.col("first_time")
    growth = F.pow(F.try_divide(latest, first), F.try_divide(F.lit(1.0), span)) - 1
    return wh.describe(kept, "dim_country", ["country_key"]).select(
        "country_iso3", "country_name", F.col("rows").alias("years_reported"), F.col("first_time").alias("first_year"),
        F.col("last_time").alias("latest_year"), first.alias("first_year_gdp_usd"), latest.alias("latest_gdp_usd"),
        mean("gdp_growth_rate").alias("avg_gdp_growth_rate"), F.when((first > 0) & (span > 0), growth).alias("gdp_cagr"),
    )


def kept_inflation_by_country(wh) -> DataFrame:
    kept = PARTIALS["fact_inflation"].merged(wh.partials("fact_inflation"), "country_key")
    return wh.describe(kept, "dim_country", ["country_key"]).select(
        "country_iso3", "country_name", F.col("rows").alias("years_reported"), F.col("last_time").alias("latest_year"),
        F.col("inflation_pct.last.value").alias("latest_inflation_pct"), mean("inflation_pct").alias("avg_inflation_pct"),
    )


def kept_exchange_rate_monthly(wh) -> DataFrame:
    rows = _months(wh.partials("fact_exchange_rate"))
    rows = wh.describe(rows, "dim_currency", ["base_currency_key"], base_currency_key="currency_key", base_code="currency_code")
    rows = wh.describe(rows, "dim_currency", ["quote_currency_key"], quote_currency_key="currency_key", currency="currency_code")
    return rows.select(
        "base_code", "currency", "year", "month", mean("rate").alias("avg_rate"), F.col("rate.low").alias("min_rate"),
        F.col("rate.high").alias("max_rate"), F.col("rows").alias("days_observed"),
    )


def kept_crypto_monthly(wh) -> DataFrame:
    rows = wh.describe(_months(wh.partials("fact_crypto")), "dim_coin", ["coin_key"])
    return rows.select(
        "coin_id", "symbol", "name", "year", "month",
        *[mean(m).alias(f"avg_{m}") for m in PARTIALS["fact_crypto"].measures], F.col("rows").alias("days_observed"),
    )


def kept_weather_monthly(wh) -> DataFrame:
    rows = wh.describe(_months(wh.partials("fact_weather")), "dim_location", ["location_key"])
    return rows.select(
        "latitude", "longitude", "year", "month", mean("temp_max_c").alias("avg_temp_max_c"), mean("temp_min_c").alias("avg_temp_min_c"),
        F.col("precipitation_mm.total").alias("total_precipitation_mm"), F.col("rows").alias("days_observed"),
    )


KEPT = {f.__name__: f for f in (
    kept_gdp_by_country, kept_inflation_by_country, kept_exchange_rate_monthly, kept_crypto_monthly, kept_weather_monthly,
)}
