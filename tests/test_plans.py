"""Shapes of the physical plans that matter at scale."""

import re
from datetime import date

import pytest
from pyspark.sql import functions as F

from tidemark.plans import serving, views
from tidemark.plans.silver import to_silver
from tidemark.plans.warehouse import Warehouse
from tidemark.sources.registry import get_source

D = date(2026, 7, 20)


def plan(df, final=False):
    if final:
        df.collect()
    return df._jdf.queryExecution().executedPlan().toString()


def body(text):
    """The plan before AQE rewrote it, without the expression details."""
    return text.split("Initial Plan")[-1]


@pytest.fixture(scope="module")
def loaded(spark, tmp_path_factory):
    wh = Warehouse(spark, str(tmp_path_factory.mktemp("plans") / "warehouse"))
    wh.create_schema()
    coins = [(c, c, c, 1.0, 1.0, 1.0, 0.0, None, date(2026, 7, d)) for c in "ab" for d in (1, 2, 3)]
    for source, rows in (("coingecko", coins), ("exchange_rate", [("USD", "UGX", 1.0, None, D)])):
        wh.load(source, spark.createDataFrame(rows, get_source(source).silver_schema))
    return wh


@pytest.mark.parametrize("source", ["world_bank", "exchange_rate", "open_meteo", "coingecko"])
def test_reduced_before_and_after_the_shuffle(documents, source):
    text = plan(to_silver(documents(source), source))
    assert text.count("WindowGroupLimit") == 2 and "row_number(), 1, Partial" in text
    assert text.count("Exchange hashpartitioning") == 2
    assert "SinglePartition" not in text


def test_news_day_is_never_gathered(documents):
    text = plan(to_silver(documents("newsapi"), "newsapi"))
    assert "windowspecdefinition(logical_date" not in text
    assert "partial_count(1)" in text
    counted = text[text.index("BroadcastExchange"):]
    assert "description" not in counted.split("posexplode")[0]


@pytest.mark.parametrize("name", ["view_crypto", "view_exchange_rate"])
def test_view_is_one_shuffle(loaded, name):
    text = plan(views.VIEWS[name](loaded))
    assert text.count("Exchange hashpartitioning") == 1
    assert "SortMergeJoin" not in text and "CartesianProduct" not in text
    assert "NestedLoop" not in text and "SinglePartition" not in text


def test_entity_filter_reaches_both_scans(loaded):
    text = plan(serving.list_crypto(loaded, coin_id="a").matches)
    assert "EqualTo(coin_id,a)" in text
    assert re.search(r"EqualTo\(coin_key,\d+\)", text)


def test_upper_bound_prunes_partitions_below_the_window(loaded):
    text = plan(serving.list_crypto(loaded, date_to=date(2026, 7, 2)).matches)
    assert re.search(r"PartitionFilters: \[[^\]]*month_key#\d+ <= 202607", text)
    assert "LessThanOrEqual(date_key,20260702)" in text
    assert serving.list_crypto(loaded, date_to=date(2026, 6, 30)).total() == 0
    assert [r["date"].day for r in serving.list_crypto(loaded, coin_id="a", date_to=date(2026, 7, 2))
            .items.collect()] == [2, 1]


def test_unknown_entity_reads_nothing(loaded):
    assert serving.list_crypto(loaded, coin_id="zzz").total() == 0
    assert serving.latest_crypto_row(loaded, "zzz").first() is None


def test_date_filter_stays_above_the_window(loaded):
    page = serving.list_crypto(loaded, coin_id="a", date_from=date(2026, 7, 3))
    (row,) = page.items.collect()
    assert row["lag1_price_usd"] == 1.0
    text = plan(page.matches)
    assert text.index("Filter") < text.index("Window")


def test_count_of_a_page_skips_the_features(loaded):
    total = serving.list_crypto(loaded).matches.agg(F.count(F.lit(1)))
    assert "Window" not in plan(total)


def test_page_is_a_top_k(loaded):
    assert "TakeOrderedAndProject" in plan(serving.list_crypto(loaded, limit=5, offset=5).items)


def test_rollup_combines_before_the_shuffle(loaded):
    text = plan(views.agg_crypto_monthly(loaded))
    assert "partial_avg" in text
    scans = [line for line in text.splitlines() if "FileScan" in line and "price_usd" in line]
    assert scans and not any("market_cap_usd" in s or "volatility_7d" in s for s in scans)


def test_fact_reads_only_touched_partitions(loaded):
    from tidemark.plans.warehouse import FACTS

    stored = loaded._stored(FACTS["fact_crypto"]).where(F.col("month_key").isin(202607))
    assert re.search(r"PartitionFilters: \[[^\]]*month_key#\d+ (=|IN)", plan(stored))


def test_fit_is_one_aggregate(loaded):
    from tidemark.operators.regression import least_squares

    df = loaded.table("fact_crypto")
    text = plan(least_squares(df, "price_usd", "volume_usd", "market_cap_usd"))
    assert text.count("Exchange") == 1 and "partial_covar" in text.replace("partial_covar_pop", "partial_covar")
