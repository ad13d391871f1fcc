import threading

import numpy as np
import pytest
from pyspark.sql import functions as F

from tidemark.operators.moments import merged, moments, without_row
from tidemark.operators.regression import LinearModel, least_squares
from tidemark.plans import forecast
from tidemark.plans.forecast import CHAMPION, FORECASTS, Registry, Training, usable_rows
from tidemark.plans.refit import MomentStore


def view(spark, seed, coins=12, days=120):
    pick = np.random.default_rng(seed)
    rows = []
    for c in range(coins):
        price = float(pick.uniform(1e4, 1e5))
        for d in range(days if c else 1):
            lag, price = price, price * float(pick.uniform(0.9, 1.12))
            known = pick.random() > 0.05
            rows.append((f"coin-{c}", d, price if known else None, lag, (lag + price) / 2))
    frame = spark.createDataFrame(rows, "coin_id string, d int, price_usd double, lag1_price_usd double, price_7d_avg_usd double")
    return frame.withColumn("date", F.date_add(F.lit("2031-01-20").cast("date"), "d")).drop("d")


def test_moments_add_up_and_rows_come_out_again(spark):
    pick = np.random.default_rng(3)
    data = 1e8 + pick.normal(size=(200, 2))  # far from zero, so that careless sums would lose all digits
    rows = spark.createDataFrame([(i % 7, float(a), float(b)) for i, (a, b) in enumerate(data)], "g int, a double, b double")
    groups = moments(rows, ["g"], a=F.col("a"), b=F.col("b"))
    total = merged(groups, ["a", "b"]).first()
    cov = np.cov(data.T, bias=True) * 200
    assert total["n"] == 200 and total["mean_a"] == pytest.approx(data[:, 0].mean(), rel=1e-15)
    assert [total["a_a"], total["a_b"], total["b_b"]] == pytest.approx([cov[0, 0], cov[0, 1], cov[1, 1]], rel=1e-6)
    small = spark.createDataFrame([(0, 1.0, 5.0), (0, 2.0, 3.0), (0, 4.0, 4.0)], "g int, a double, b double")
    left = moments(small, ["g"], a=F.col("a"), b=F.col("b"))
    out = without_row(["a", "b"], {"a": F.lit(4.0), "b": F.lit(4.0)})
    row = left.select(*[c.alias(n) for n, c in out.items()]).first()
    assert [row[c] for c in ("n", "mean_a", "mean_b", "a_a", "a_b", "b_b")] == pytest.approx([2, 1.5, 4, 0.5, -1, 2])
    assert merged(groups.limit(0), ["a", "b"]).first()["n"] == 0


def test_a_fit_from_three_batches_equals_one_pass(spark, tmp_path):
    spec, rows = FORECASTS["crypto"], view(spark, 1)
    store = MomentStore(spark, str(tmp_path / "moments"), spec, rows)
    store.add(rows.withColumn("price_usd", F.lit(7.0)))  # stale: replaced by what follows
    for part in range(3):
        store.add(rows.where(F.pmod(F.month("date"), F.lit(3)) == part))
    one = least_squares(usable_rows(rows, spec).where("not is_holdout"), *spec.features, spec.target, spec.log_scale).first()
    many = store.fit().first()
    assert many["train_rows"] == one["train_rows"]
    assert [many[c] for c in ("intercept", "coef_lag", "coef_rolling")] == pytest.approx([one[c] for c in ("intercept", "coef_lag", "coef_rolling")], rel=1e-9, abs=1e-9)


def test_a_batch_replaces_only_its_periods(spark, tmp_path):
    spec, rows = FORECASTS["crypto"], view(spark, 2, coins=3, days=70)
    store = MomentStore(spark, str(tmp_path / "moments"), spec, rows)
    store.add(rows)
    before = store.table.state().of("moments")
    store.add(rows.where("month(date) = 2"))
    after = store.table.state().of("moments")
    assert [v for v in before if before[v] != after[v]] == [203102]
    empty = MomentStore(spark, str(tmp_path / "empty"), spec, rows)
    assert empty.fit().first()["train_rows"] == 0


def trained(mae, domain="gdp"):
    return Training(FORECASTS[domain], LinearModel(0.0, 1.0, 0.0), {"mae": mae}, 5, 2)


def test_eight_writers_get_eight_versions(spark, tmp_path):
    """Each writer has its own registry object; what they share is the folder."""
    root, got = str(tmp_path / "registry"), []

    def write(n):
        own = Registry(spark, root)
        version = own.register("gdp_forecast", own.log_run(trained(float(n))))
        own.promote(f"model-{n}", version)
        got.append(version)

    threads = [threading.Thread(target=write, args=(n,)) for n in range(8)]
    [t.start() for t in threads]
    [t.join() for t in threads]
    assert sorted(got) == list(range(1, 9))
    registry = Registry(spark, root)
    versions = registry.table("model_versions").collect()
    assert sorted(r["version"] for r in versions) == list(range(1, 9)) and len({r["run_id"] for r in versions}) == 8
    # No alias was lost to another writer's switch.
    assert sorted(r["model"] for r in registry.table("model_aliases").collect()) == [f"model-{n}" for n in range(8)]


def test_runs_in_bulk(spark, tmp_path):
    registry = Registry(spark, str(tmp_path / "registry"))
    first = registry.register("gdp_forecast", registry.log_run(trained(5.0)))
    registry.promote("gdp_forecast", first)
    schema = registry.table("model_runs").schema
    rows = [(f"r{i}", m, {}, {"mae": float(mae)}, 0.0, 0.0, 0.0, False, 1, 1, f"2031-01-0{i + 1} 00:00:00") for i, (m, mae) in enumerate([("gdp_forecast", 5), ("gdp_forecast", 4), ("new", 9), ("gdp_forecast", 4)])]
    names = schema.fieldNames()
    runs = spark.createDataFrame([r[:-1] for r in rows], schema=forecast.T.StructType(schema.fields[:-1])).withColumn(names[-1], F.current_timestamp())
    stamped = runs.withColumn(names[-1], F.expr("timestampadd(DAY, cast(substr(run_id, 2) as int), timestamp'2031-01-01')"))
    registry.log_and_register(stamped)
    got = {(r["model"], r["version"]): r["run_id"] for r in registry.table("model_versions").collect()}
    assert {k: v for k, v in got.items() if k != ("gdp_forecast", 1)} == {
        ("gdp_forecast", 2): "r0", ("gdp_forecast", 3): "r1", ("gdp_forecast", 4): "r3", ("new", 1): "r2",
    }
    registry.promote_best()
    aliases = {r["model"]: r["version"] for r in registry.table("model_aliases").where(F.col("alias") == CHAMPION).collect()}
    assert aliases == {"gdp_forecast": 3, "new": 1}
