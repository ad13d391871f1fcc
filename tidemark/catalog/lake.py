"""The feeds loaded into a star schema in the shared folder, once per application and data folder."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from tidemark.catalog.feeds import DOCUMENTS
from tidemark.plans.forecast import FORECASTS, Registry, train_register_deploy
from tidemark.plans.silver import narrow_silver, to_silver
from tidemark.plans.warehouse import Warehouse, narrow_columns
from tidemark.session import apply_settings, scratch_path

_built: dict[tuple[str, str], tuple[Warehouse, set[str], Registry, set[str]]] = {}
_narrow: dict[tuple[str, str, str], str] = {}

# Sources whose rows hold whole texts; these move and are written once on the way into the fact.
WIDE = {"newsapi"}

DOMAIN_SOURCE = {
    "gdp": "world_bank", "inflation": "world_bank_inflation", "exchange_rate": "exchange_rate",
    "crypto": "coingecko",
}


def silver(spark: SparkSession, sf_dir: str, source: str) -> DataFrame:
    """Silver of one feed as a plan over the given tables."""
    return to_silver(DOCUMENTS[source](spark, sf_dir), source)


def staged_silver(spark: SparkSession, sf_dir: str, source: str) -> DataFrame:
    """The same, written to the shared folder so that several loads read it without redoing it."""
    path = scratch_path(spark, f"silver-{source}")
    silver(spark, sf_dir, source).write.parquet(path)
    return spark.read.parquet(path)


def staged_narrow(spark: SparkSession, sf_dir: str, source: str) -> DataFrame:
    """The columns of Silver that dimensions and calendar are loaded from, written once per application."""
    key = (spark.sparkContext.applicationId, sf_dir, source)
    if key not in _narrow:
        path = scratch_path(spark, f"narrow-{source}")
        rows = narrow_silver(DOCUMENTS[source](spark, sf_dir), source, narrow_columns(source))
        rows.distinct().write.parquet(path)
        _narrow[key] = path
    return spark.read.parquet(_narrow[key])


def _entry(spark: SparkSession, sf_dir: str):
    apply_settings(spark)
    key = (spark.sparkContext.applicationId, sf_dir)
    if key not in _built:
        wh = Warehouse(spark, scratch_path(spark, "warehouse"))
        wh.create_schema()
        _built[key] = (wh, set(), Registry(spark, scratch_path(spark, "registry")), set())
    return _built[key]


def warehouse(spark: SparkSession, sf_dir: str, *sources: str) -> Warehouse:
    """The warehouse with at least the named sources loaded."""
    wh, loaded, _, _ = _entry(spark, sf_dir)
    for source in sources:
        if source not in loaded:
            if source in WIDE:
                wh.load(source, silver(spark, sf_dir, source), staged_narrow(spark, sf_dir, source))
            else:
                wh.load(source, staged_silver(spark, sf_dir, source))
            loaded.add(source)
    return wh


def dimension(spark: SparkSession, sf_dir: str, name: str, *sources: str) -> DataFrame:
    """A dimension with the members of at least the named sources; facts of wide rows aren't loaded for it."""
    wh, loaded, _, _ = _entry(spark, sf_dir)
    for source in sources:
        if source in WIDE and source not in loaded:
            wh.load_dimensions(source, staged_narrow(spark, sf_dir, source))
        else:
            warehouse(spark, sf_dir, source)
    return wh.table(name)


def registry(spark: SparkSession, sf_dir: str, *domains: str) -> Registry:
    """The model registry with at least the named domains trained and deployed."""
    _, _, models, trained = _entry(spark, sf_dir)
    for domain in domains or FORECASTS:
        if domain not in trained:
            wh = warehouse(spark, sf_dir, DOMAIN_SOURCE[domain])
            train_register_deploy(wh, models, domain)
            trained.add(domain)
    return models
