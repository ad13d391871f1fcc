from datetime import date, datetime

import pytest

from tidemark.operators.quality import (
    ValidationFailedError, between, evaluate, not_null, same_columns, unique, validate,
    validate_or_raise,
)
from tidemark.sources.registry import SOURCE_NAMES, get_source

DAY = date(2026, 7, 20)
T = datetime(2026, 7, 20)
VALID = {
    "world_bank": [("UGA", "Uganda", "I", 2022, None, None, DAY), ("UGA", "Uganda", "I", 2023, 5.0, None, DAY)],
    "world_bank_inflation": [("UGA", "Uganda", "I", 2022, -2.0, None, DAY)],
    "exchange_rate": [("USD", "UGX", 3700.0, None, DAY), ("USD", "EUR", 0.92, None, DAY)],
    "open_meteo": [(DAY, 0.3, 32.5, 28.0, 18.0, None, None, None, DAY)],
    "coingecko": [("bitcoin", "btc", "B", 65000.0, None, None, None, None, DAY)],
    "newsapi": [(None, None, "t", None, "u1", T, 1, DAY)],
}
SIZES = {"world_bank": 9, "world_bank_inflation": 9, "exchange_rate": 7, "open_meteo": 11,
         "coingecko": 8, "newsapi": 6}
BROKEN = {
    "world_bank": (
        [(None, "X", "I", 2022, 1.0, None, DAY), ("UGA", "U", "I", 2023, 1.0, None, DAY),
         ("UGA", "U", "I", 2023, 2.0, None, DAY), ("KEN", "K", "I", 1800, -5.0, None, DAY)],
        ["not_null", "compound_unique", "between", "between"]),
    "world_bank_inflation": (
        [("UGA", "U", "I", 2023, 5000.0, None, DAY), ("UGA", "U", "I", 2023, 1.0, None, DAY)],
        ["compound_unique", "between"]),
    "exchange_rate": (
        [("USD", "UGX", 0.0, None, DAY), ("USD", "UGX", 1.0, None, DAY)], ["compound_unique", "between"]),
    "open_meteo": (
        [(DAY, 95.0, 32.5, 28.0, 18.0, -3.0, None, None, DAY), (DAY, 95.0, 32.5, 28.0, 18.0, 1.0, None, None, DAY)],
        ["unique", "between", "between"]),
    "coingecko": (
        [("bitcoin", "b", "B", -1.0, None, None, None, None, DAY), ("bitcoin", "b", "B", 1.0, None, None, None, None, DAY)],
        ["compound_unique", "between"]),
    "newsapi": (
        [(None, None, None, None, "u1", T, 1, DAY), (None, None, "t", None, "u1", T, 0, DAY)],
        ["not_null", "unique", "between"]),
}


@pytest.mark.parametrize("source", SOURCE_NAMES)
def test_valid_rows_pass(silver, source):
    outcome = validate(silver(source, *VALID[source]), get_source(source).suite, source)
    assert outcome.success and outcome.failed == [] and outcome.total == SIZES[source]


@pytest.mark.parametrize("source", SOURCE_NAMES)
def test_broken_rows_fail(silver, source):
    rows, failed = BROKEN[source]
    outcome = validate(silver(source, *rows), get_source(source).suite, source)
    if source == "open_meteo":
        failed = ["compound_unique", *failed[1:]]
    assert outcome.failed == failed


@pytest.mark.parametrize("source", SOURCE_NAMES)
def test_empty_dataset_passes(silver, source):
    assert validate(silver(source), get_source(source).suite, source).success


def test_gate_raises(silver):
    with pytest.raises(ValidationFailedError, match="between"):
        validate_or_raise(silver("exchange_rate", ("USD", "UGX", 0.0, None, DAY)),
                          get_source("exchange_rate").suite, "exchange_rate")


def counts(df, *suite):
    rows = sorted(evaluate(df, suite, "a").collect(), key=lambda r: r["position"])
    return [r["violations"] for r in rows]


def test_counting_rules(spark):
    df = spark.createDataFrame(
        [(1, None, 5.0), (1, None, None), (None, None, 9.0), (None, None, 0.0), (2, 1, -1.0)],
        "a int, b int, x double")
    assert counts(df, unique("a")) == [2]
    assert counts(df, unique("a", "b")) == [2]
    assert counts(df, not_null("b"), between("x", 0, 5)) == [4, 2]
    assert counts(df, between("x", 0, above_low=True)) == [2]
    assert counts(df, unique("a"), unique("b"), not_null("a")) == [2, 0, 2]
    assert counts(df, same_columns("x", "b", "a"), same_columns("a", "c")) == [0, 3]


def test_missing_column_fails_with_unknown_count(spark):
    df = spark.createDataFrame([(1,)], "a int")
    (row,) = evaluate(df, [not_null("nope")], "a").collect()
    assert (row["violations"], row["success"]) == (None, False)


def test_hot_key_is_counted_once_per_task(spark):
    df = spark.range(9000).selectExpr("case when id % 3 = 0 then -1 else id end as k")
    assert counts(df, unique("k")) == [3000]
