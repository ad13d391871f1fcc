"""Dashboard charts: a chart is a query spec over a dataset, resolved to a DataFrame."""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass, replace

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import DoubleType

from tidemark.operators.paging import narrow, ordering
from tidemark.plans import views
from tidemark.plans.warehouse import Warehouse


@dataclass(frozen=True)
class Metric:
    """The mean of one column under a label."""

    label: str
    column: str

    def expression(self) -> Column:
        return F.avg(self.column).alias(self.label)


@dataclass(frozen=True)
class Dataset:
    """A view offered to charts, with its time column and its saved metrics."""

    view: Callable[..., DataFrame]
    time: str | None
    metrics: dict[str, Metric]

    def roles(self, wh: Warehouse) -> dict[str, list[str]]:
        """Columns by what a chart may do with them: order in time, average, or group and filter."""
        fields = self.view(wh).schema.fields
        measures = [f.name for f in fields if isinstance(f.dataType, DoubleType)]
        time = [self.time] if self.time else []
        others = [f.name for f in fields if f.name not in measures and f.name not in time]
        return {"time": time, "measure": measures, "group": others}


def _dataset(view, time: str | None, column: str) -> Dataset:
    label = f"avg_{column}"
    return Dataset(view, time, {label: Metric(label, column)})


DATASETS = {
    "gdp": _dataset(views.view_gdp, None, "gdp_usd"),
    "inflation": _dataset(views.view_inflation, None, "inflation_pct"),
    "exchange_rate": _dataset(views.view_exchange_rate, "date", "rate"),
    "weather": _dataset(views.view_weather, "date", "temp_max_c"),
    "crypto": _dataset(views.view_crypto, "date", "price_usd"),
}

# Names that stand for groups of countries rather than a country.
GROUP_PATTERNS = (
    "%income%", "%IDA%", "%IBRD%", "% & %", "%(%", "%dividend%", "%classification%", "Africa %",
)
GROUP_NAMES = (
    "World", "OECD members", "Arab World", "European Union", "Euro area", "North America",
    "South Asia", "Small states", "Not classified", "Fragile and conflict affected situations",
    "Central Europe and the Baltics", "Pacific island small states", "Caribbean small states",
    "Other small states", "Sub-Saharan Africa", "Latin America & Caribbean",
    "East Asia & Pacific", "Europe & Central Asia",
)
# The coins and currencies the line and bar charts show.
MAJOR_COINS = (
    "bitcoin", "ethereum", "solana", "ripple", "dogecoin", "cardano", "tron", "binancecoin",
)
MAJOR_CURRENCIES = ("EUR", "GBP", "JPY", "CNY", "CAD", "AUD", "CHF", "INR")


def single_countries() -> Column:
    """Leaves out country groups; an unknown name is left out as well."""
    name = F.col("country_name")
    keep = ~name.isin(*GROUP_NAMES)
    for pattern in GROUP_PATTERNS:
        keep = keep & ~name.like(pattern)
    return keep


def one_of(column: str, values: tuple[str, ...]) -> Callable[[], Column]:
    return lambda: F.col(column).isin(*values)


def equals(column: str, value) -> Callable[[], Column]:
    return lambda: F.col(column) == F.lit(value)


@dataclass(frozen=True)
class Chart:
    """Raw rows when `columns` is set, otherwise metrics per `x` and `series`.

    A chart with a row limit shows its best: it is ordered by its first metric, greatest first. Tables
    and series are whole unless the caller of `chart` asks for a limit, and ordered along `x`. Every
    order ends with the grouping columns so that it is total. Means are ranked at six decimals: the
    last bits of a distributed sum depend on its order and must not decide which rows a limit keeps.
    """

    dataset: str
    row_limit: int | None = None
    columns: tuple[str, ...] = ()
    order: tuple[str, ...] = ()
    x: str | None = None
    series: str | None = None
    metrics: tuple[Metric | str, ...] = ()
    filters: tuple[Callable[[], Column], ...] = ()
    series_limit: int | None = None

    def filtered_by(self, column: str, value) -> Chart:
        """The chart after a click on a sibling chart: one more equality filter."""
        return replace(self, filters=(*self.filters, equals(column, value)))


def _mean_label(column: str, label: str) -> Metric:
    return Metric(label, column)


COUNTRY_YEAR = (equals("year", 2023), single_countries)
AVG_RAIN = _mean_label("precipitation_mm", "Avg Precipitation (mm)")
CHARTS = {
    "gdp_table": Chart(
        "gdp", order=("year",),
        columns=("country_iso3", "country_name", "year", "gdp_usd", "gdp_growth_rate"),
    ),
    "gdp_bar": Chart("gdp", 15, x="country_name", metrics=("avg_gdp_usd",), filters=COUNTRY_YEAR),
    "gdp_line": Chart(
        "gdp", x="year", series="country_name", metrics=("avg_gdp_usd",),
        filters=(single_countries,), series_limit=10,
    ),
    "inflation_table": Chart(
        "inflation", order=("year",),
        columns=("country_iso3", "country_name", "year", "inflation_pct", "inflation_trend"),
    ),
    "inflation_bar": Chart(
        "inflation", 15, x="country_name", metrics=("avg_inflation_pct",), filters=COUNTRY_YEAR
    ),
    "inflation_line": Chart(
        "inflation", x="year", series="country_name", metrics=("avg_inflation_pct",),
        filters=(single_countries,), series_limit=10,
    ),
    "exchange_table": Chart(
        "exchange_rate", order=("date",),
        columns=("date", "base_code", "currency", "rate", "rate_7d_avg"),
    ),
    "exchange_bar": Chart(
        "exchange_rate", 8, x="currency", metrics=("avg_rate",),
        filters=(one_of("currency", MAJOR_CURRENCIES),),
    ),
    "exchange_line": Chart(
        "exchange_rate", x="date", series="currency", metrics=("avg_rate",),
        filters=(one_of("currency", MAJOR_CURRENCIES),),
    ),
    "crypto_table": Chart(
        "crypto", order=("date",),
        columns=("date", "coin_id", "symbol", "price_usd", "volatility_7d"),
    ),
    "crypto_bar": Chart(
        "crypto", 8, x="coin_id", metrics=(_mean_label("volatility_7d", "avg_volatility_7d"),),
        filters=(one_of("coin_id", MAJOR_COINS),),
    ),
    "crypto_line": Chart(
        "crypto", x="date", series="coin_id", metrics=("avg_price_usd",),
        filters=(one_of("coin_id", MAJOR_COINS),),
    ),
    "weather_table": Chart(
        "weather", order=("date",),
        columns=(
            "date", "latitude", "longitude", "temp_max_c", "precipitation_mm",
            "rainfall_anomaly_mm",
        ),
    ),
    "weather_bar": Chart("weather", x="date", metrics=(AVG_RAIN,)),
    "weather_line": Chart("weather", x="date", metrics=("avg_temp_max_c", AVG_RAIN)),
    "weather_scatter": Chart(
        "weather", x="date",
        metrics=(
            _mean_label("longitude", "avg_longitude"),
            _mean_label("latitude", "avg_latitude"),
            _mean_label("temp_max_c", "avg_temp_max_c"),
        ),
    ),
}


def _metric(dataset: Dataset, metric: Metric | str) -> Metric:
    return dataset.metrics[metric] if isinstance(metric, str) else metric


def _ranking(metric: Metric) -> list[Column]:
    return [F.round(F.col(f"`{metric.label}`"), 6).desc_nulls_last()]


def render(chart: Chart, rows: DataFrame) -> DataFrame:
    """Run a chart over the rows of its dataset."""
    dataset = DATASETS[chart.dataset]
    for condition in chart.filters:
        rows = rows.where(condition())
    if chart.columns:
        order = [*chart.order, *[c for c in chart.columns if c not in chart.order]]
        shown = rows.select(*chart.columns).orderBy(*ordering(order))
        return shown if chart.row_limit is None else shown.limit(chart.row_limit)
    metrics = [_metric(dataset, m) for m in chart.metrics]
    if chart.series_limit:
        best = (
            rows.groupBy(chart.series)
            .agg(metrics[0].expression())
            .orderBy(*_ranking(metrics[0]), *ordering([chart.series]))
            .limit(chart.series_limit)
        )
        # At most `series_limit` names.
        rows = rows.join(F.broadcast(best.select(chart.series)), chart.series, "left_semi")
    groups = [c for c in (chart.x, chart.series) if c]
    shown = rows.groupBy(*groups).agg(*[m.expression() for m in metrics])
    if chart.row_limit is None:
        return shown.orderBy(*ordering(groups))
    return shown.orderBy(*_ranking(metrics[0]), *ordering(groups)).limit(chart.row_limit)


def chart(wh: Warehouse, name: str, limit: int | None = None, **clicked) -> DataFrame:
    """A registered chart, optionally narrowed by clicked values (column=value).

    `limit` cuts a table or series to its first rows; charts that show their best N keep that N.
    """
    spec = CHARTS[name]
    for column, value in clicked.items():
        spec = spec.filtered_by(column, value)
    shown = render(spec, DATASETS[spec.dataset].view(wh))
    return shown if limit is None else shown.limit(limit)


def raw_table_page(wh: Warehouse, name: str, page: int, size: int = 10) -> DataFrame:
    """One page of a raw table chart, counted from zero."""
    spec = CHARTS[name]
    order = [*spec.order, *[c for c in spec.columns if c not in spec.order]]
    return chart(wh, name).orderBy(*ordering(order)).offset(page * size).limit(size)


def filter_values(wh: Warehouse, dataset: str, column: str) -> DataFrame:
    """Distinct known values of a column, for a filter box."""
    rows = DATASETS[dataset].view(wh).select(column).where(F.col(column).isNotNull())
    return rows.distinct().orderBy(*ordering([column]))


def explore(wh: Warehouse, dataset: str, **chosen) -> DataFrame:
    """Rows of a dataset narrowed by whatever filters are filled in."""
    conditions = [(v, lambda value, c=c: F.col(c) == F.lit(value)) for c, v in chosen.items()]
    return narrow(DATASETS[dataset].view(wh), *conditions)


def overview_cards(wh: Warehouse, models: DataFrame) -> DataFrame:
    """One row per card of the overview: label, the entity shown and its value.

    `models` is a registry listing (name, champion_version, ...).
    """
    countries = wh.table("dim_country").agg(F.count(F.lit(1)).cast("double").alias("value"))
    rate = views.view_exchange_rate(wh).orderBy(*ordering(["-date", "base_code", "currency"]))
    coin = views.view_crypto(wh).orderBy(*ordering(["-date", "coin_id"]))
    champions = models.agg(
        F.count("champion_version").cast("double").alias("value"),
        F.count(F.lit(1)).alias("registered"),
    )

    def card(label: str, entity: Column, value: Column) -> list[Column]:
        return [F.lit(label).alias("card"), entity.alias("entity"), value.alias("value")]

    value = F.col("value")
    return (
        countries.select(*card("countries", F.lit("all"), value))
        .unionByName(
            rate.limit(1).select(
                *card("latest_rate", F.concat_ws("/", "base_code", "currency"), F.col("rate"))
            )
        )
        .unionByName(
            coin.limit(1).select(*card("latest_price", F.upper("symbol"), F.col("price_usd")))
        )
        .unionByName(
            champions.select(
                *card("champions", F.concat(F.lit("of "), F.col("registered").cast("string")), value)
            )
        )
    )
