import random

import numpy as np
import pandas as pd
import pytest
from pyspark.sql import functions as F

from tidemark.functions import struct_to_map
from tidemark.operators import joins
from tidemark.operators.joins import hot_keys, lookup_join, measured_bytes, split_join
from tidemark.operators.merge import insert_if_absent, number_members, upsert
from tidemark.operators.paging import Page, narrow
from tidemark.operators.regression import LinearModel, error_metrics, least_squares
from tidemark.operators.series import (
    History, first_per_key, last_per_entity, newest_per_key, split_holdout,
)


def as_set(df):
    return {tuple(r) for r in df.collect()}


@pytest.fixture(scope="module")
def hot_rows():
    """A third of the rows share one key."""
    rng = random.Random(7)
    rows = [(0, rng.randrange(500), rng.random()) for _ in range(2000)]
    return rows + [(rng.randrange(1, 300), rng.randrange(500), rng.random()) for _ in range(4000)]


def test_newest_per_key_against_brute_force(spark, hot_rows):
    df = spark.createDataFrame(hot_rows, "k int, v int, x double")
    best = {}
    for row in hot_rows:
        best[row[0]] = max(best.get(row[0], row), row, key=lambda r: r[1:])
    assert as_set(newest_per_key(df, ["k"], ["v"])) == set(best.values())
    assert as_set(newest_per_key(df.repartition(7), ["k"], ["v"])) == set(best.values())


def test_newest_prefers_known_over_unknown(spark):
    df = spark.createDataFrame([(1, "a", None), (1, "a", 2.0), (1, None, 9.0)], "k int, v string, x double")
    assert as_set(newest_per_key(df, ["k"], ["v"])) == {(1, "a", 2.0)}


def test_first_and_last(spark):
    df = spark.createDataFrame([(1, 3), (1, 1), (2, None), (2, 5)], "k int, t int")
    assert as_set(first_per_key(df, ["k"], ["t"])) == {(1, 1), (2, 5)}
    assert as_set(last_per_entity(df, ["k"], ["t"])) == {(1, 3), (2, 5)}


def test_history_against_pandas(spark):
    rng = random.Random(3)
    rows = [(k, t, rng.random()) for k in "ab" for t in rng.sample(range(100), 40)]
    h = History(("k",), "t")
    got = (
        spark.createDataFrame(rows, "k string, t int, v double")
        .withColumns({
            "prev": h.previous("v"), "growth": h.growth("v"), "mean": h.mean("v", 7),
            "before": h.mean("v", 7, include_current=False), "spread": h.spread("v", 7),
        })
        .toPandas().sort_values(["k", "t"]).reset_index(drop=True)
    )
    g = got.groupby("k")["v"]
    assert np.allclose(got["prev"], g.shift(1), equal_nan=True)
    assert np.allclose(got["growth"], g.pct_change(), equal_nan=True)
    rolling = g.rolling(7, min_periods=1)
    assert np.allclose(got["mean"], rolling.mean().reset_index(drop=True))
    assert np.allclose(got["spread"], rolling.std().reset_index(drop=True), equal_nan=True)
    shifted = g.transform(lambda s: s.shift(1).rolling(7, min_periods=1).mean())
    assert np.allclose(got["before"], shifted, equal_nan=True)


def test_split_holdout(spark):
    df = spark.createDataFrame([("a", 1), ("a", 2), ("b", 5)], "k string, t int")
    assert as_set(split_holdout(df, ["k"], ["t"])) == {("a", 1, False), ("a", 2, True), ("b", 5, True)}


@pytest.mark.parametrize("how", ["inner", "left"])
@pytest.mark.parametrize("share", [0.1, 0.001, 0.9])
def test_split_join_equals_plain_join(spark, hot_rows, how, share):
    unknown = [(None, 1, 0.5)] * 500
    facts = spark.createDataFrame(hot_rows + unknown, "k int, v int, x double")
    lookup = spark.createDataFrame([(k, f"n{k}") for k in range(0, 300, 2)], "k int, name string")
    plain = facts.join(lookup, ["k"], how)
    assert sorted(map(str, split_join(facts, lookup, ["k"], how, share).collect())) == sorted(
        map(str, plain.collect()))


def test_hot_keys_are_few(spark, hot_rows):
    facts = spark.createDataFrame(hot_rows, "k int, v int, x double")
    assert as_set(hot_keys(facts, ["k"], 0.1)) == {(0,)}
    assert hot_keys(facts, ["k"], 0.9).count() == 0


def test_lookup_join_broadcasts_only_what_fits(spark, hot_rows, monkeypatch):
    facts = spark.createDataFrame(hot_rows, "k int, v int, x double")
    lookup = spark.createDataFrame([(k, "n" * 50) for k in range(300)], "k int, name string")
    assert measured_bytes(lookup) >= 300 * 50
    small = lookup_join(facts, lookup, ["k"])
    monkeypatch.setattr(joins, "BROADCAST_BYTES", 1000)
    large = lookup_join(facts, lookup, ["k"])
    assert "Union" not in small._jdf.queryExecution().analyzed().toString()
    assert "Union" in large._jdf.queryExecution().analyzed().toString()
    assert small.count() == large.count() == len(hot_rows)


def test_number_members_is_dense_and_repeatable(spark):
    members = spark.createDataFrame([(f"m{i}", i % 7) for i in range(1000)], "name string, x int")
    numbered = number_members(members, ["name"], "key", after=50)
    first = {r["name"]: r["key"] for r in numbered.collect()}
    assert sorted(first.values()) == list(range(51, 1051))
    again = number_members(members.repartition(9), ["name"], "key", after=50)
    assert {r["name"]: r["key"] for r in again.collect()} == first


def test_upsert_overwrites_with_unknown_and_keeps_the_rest(spark):
    old = spark.createDataFrame([(1, 1.0), (2, 2.0), (3, 3.0)], "k int, v double")
    new = spark.createDataFrame([(2, None), (4, 4.0)], "k int, v double")
    assert as_set(upsert(old, new, ["k"])) == {(1, 1.0), (2, None), (3, 3.0), (4, 4.0)}
    assert as_set(insert_if_absent(old, new, ["k"])) == {(1, 1.0), (2, 2.0), (3, 3.0), (4, 4.0)}


def test_pages_concatenate_to_the_ordered_whole(spark):
    df = spark.createDataFrame([(i % 5 or None, i) for i in range(43)], "g int, i int")
    whole = sorted(df.collect(), key=lambda r: (-(r["g"] or -1), r["i"]))
    seen = []
    for offset in range(0, 50, 10):
        page = Page(df, ("-g", "i"), limit=10, offset=offset)
        seen += page.items.collect()
        assert page.total() == 43
    assert seen == whole
    report = Page(df, ("-g", "i"), limit=3, offset=41).report().collect()
    assert [(r["total"], r["limit"], r["offset"]) for r in report] == [(43, 3, 41)] * 2


@pytest.mark.parametrize("bad", [{"limit": 0}, {"limit": 501}, {"offset": -1}])
def test_page_bounds(bad):
    with pytest.raises(ValueError):
        Page(None, (), **bad)


def test_narrow_ignores_what_is_not_given(spark):
    df = spark.createDataFrame([(0,), (1,)], "i int")
    same = lambda v: F.col("i") == v
    assert narrow(df, (None, same), ("", same)).count() == 2
    assert narrow(df, (0, same)).count() == 1


def frame(spark, a, b, y):
    return spark.createDataFrame(pd.DataFrame({"a": a, "b": b, "y": y}))


def lstsq(a, b, y):
    a, b, y = map(np.asarray, (a, b, y))
    x = np.column_stack([a - a.mean(), b - b.mean()])
    slopes = np.linalg.pinv(x, rcond=1e-8) @ (y - y.mean())
    return [y.mean() - slopes @ [a.mean(), b.mean()], *slopes]


def test_least_squares_against_numpy(spark):
    rng = np.random.default_rng(1)
    a, b = rng.normal(50, 9, 400), rng.normal(-3, 2, 400)
    y = 4 + 2 * a - 3 * b + rng.normal(0, 1, 400)
    row = least_squares(frame(spark, a, b, y), "a", "b", "y").first()
    assert np.allclose([row[0], row[1], row[2]], lstsq(a, b, y), rtol=1e-8)
    assert row["train_rows"] == 400
    logs = least_squares(frame(spark, np.abs(a), np.abs(b), np.abs(y)), "a", "b", "y", True).first()
    expected = lstsq(*(np.log1p(np.abs(v)) for v in (a, b, y)))
    assert np.allclose([logs[0], logs[1], logs[2]], expected, rtol=1e-8)


@pytest.mark.parametrize("factor", [1.0, 2.5, 0.0])
def test_collinear_features_get_the_least_norm(spark, factor):
    a = np.arange(1.0, 30.0)
    b, y = factor * a + 1, 3 * a + 2
    row = least_squares(frame(spark, a, b, y), "a", "b", "y").first()
    assert np.allclose([row[0], row[1], row[2]], lstsq(a, b, y), rtol=1e-6)


def test_constant_features_predict_the_mean(spark):
    row = least_squares(frame(spark, [1.0] * 4, [2.0] * 4, [1.0, 2.0, 3.0, 6.0]), "a", "b", "y").first()
    assert (row["intercept"], row["coef_lag"], row["coef_rolling"]) == (3.0, 0.0, 0.0)


def test_model_and_errors(spark):
    df = spark.createDataFrame([(1.0, 2.0, 10.0), (2.0, 3.0, 12.0)], "a double, b double, y double")
    model = LinearModel(1.0, 2.0, 3.0)
    scored = df.withColumn("p", model.predict(F.col("a"), F.col("b")))
    assert [r["p"] for r in scored.orderBy("a").collect()] == [9.0, 14.0]
    errors = error_metrics(scored, "y", "p").first()
    assert (errors["mae"], errors["test_rows"]) == (1.5, 2)
    assert errors["rmse"] == pytest.approx(2.5 ** 0.5)


def test_struct_to_map_leaves_out_unknown(spark):
    df = spark.createDataFrame([((1.5, None),)], "rates struct<UGX:double,EUR:double>")
    assert df.select(struct_to_map(F.col("rates")).alias("m")).first()["m"] == {"UGX": 1.5}
