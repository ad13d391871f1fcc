import json

from pyspark.sql import functions as F

from payloads import annual, annual_page
from test_landing import document
from test_warehouse import crypto
from tidemark.operators.regression import LinearModel
from tidemark.plans.forecast import FORECASTS, answers
from tidemark.plans.jobs import run_steps


def steps(frame):
    return [(r["step"], r["status"], r["rows"], r["detail"]) for r in frame.collect()]


def land(folder, value):
    folder.mkdir(parents=True)
    page = annual_page(*[annual("UGA", str(y), value) for y in (2030, 2031)])
    (folder / "a.json").write_text(json.dumps(document("world_bank", "2032-01-01", 1, page), indent=1))


def test_steps_of_a_chain(spark, tmp_path):
    land(tmp_path / "good", 5.0)
    land(tmp_path / "bad", -5.0)
    run = lambda name, gate=True: steps(run_steps(spark, "world_bank", str(tmp_path / name), f"{tmp_path}/{name}-s-{gate}", f"{tmp_path}/{name}-w-{gate}", gate))
    assert run("good") == [("silver", "ok", 2, None), ("validate", "ok", 0, None), ("load", "ok", 2, None)]
    assert run("bad") == [("silver", "ok", 2, None), ("validate", "failed", 1, "between"), ("load", "skipped", None, None)]
    assert run("bad", gate=False)[2] == ("load", "ok", 2, None)


def test_a_step_that_breaks_is_a_row(spark, tmp_path, monkeypatch):
    import tidemark.plans.jobs as jobs

    def breaks(*_):
        raise OSError("no such disk")

    monkeypatch.setattr(jobs, "run_silver", breaks)
    got = steps(run_steps(spark, "world_bank", str(tmp_path), str(tmp_path / "s"), str(tmp_path / "w")))
    assert got == [("silver", "failed", None, "OSError"), ("validate", "skipped", None, None), ("load", "skipped", None, None)]


def test_point_forecasts_say_why_there_is_none(spark):
    spec = FORECASTS["exchange_rate"]
    scores = spark.createDataFrame(
        [("USD", "UGX", "ok", 5.0, 2), ("USD", "KES", "not_enough_history", None, None)],
        "base_code string, currency string, status string, predicted_value double, model_version int",
    )
    asked = [("usd", "ugx"), ("usd", "ugx"), ("USD", "kes"), ("USD", "XXX"), (None, "UGX"), ("USD", "")]
    rows = answers(spark.createDataFrame(asked, "base_code string, currency string"), scores, spec).collect()
    assert sorted((r["base_code"] or "", r["currency"], r["status"], r["predicted_value"]) for r in rows) == sorted([
        ("usd", "ugx", "ok", 5.0), ("usd", "ugx", "ok", 5.0), ("USD", "kes", "not_enough_history", None),
        ("USD", "XXX", "no_data", None), ("", "UGX", "missing_parameter", None), ("USD", "", "missing_parameter", None),
    ])
    assert LinearModel(1.0, 0.5, 0.0).predict(F.lit(2.0), F.lit(1.0)) is not None


def test_rows_are_judged_before_they_are_loaded(wh, silver):
    wh.load("coingecko", silver("coingecko", crypto("bitcoin", 1.0), crypto("tron", 2.0)))
    rows = wh.table("fact_crypto")
    broken = rows.withColumn("coin_key", F.col("coin_key") + 50).unionByName(rows).unionByName(rows.withColumn("date_key", F.lit(None).cast("int")))
    got = {(r["check"], r["column"]): r["violations"] for r in wh.integrity("fact_crypto", broken).collect()}
    assert got["reference", "coin_key"] == 2 and got["not_null", "date_key"] == 2 and got["unique", "coin_key,date_key"] == 0
    assert {r["violations"] for r in wh.integrity("fact_crypto").collect()} == {0}
