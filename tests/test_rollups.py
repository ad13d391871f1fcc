from datetime import date

import pytest
from pyspark.sql import functions as F

from test_warehouse import crypto, gdp, rate, weather
from tidemark.plans import views
from tidemark.plans.rollups import KEPT, PARTIALS, kept_crypto_monthly, kept_gdp_by_country
from tidemark.plans.warehouse import FACTS, ROLLUP, ROWS, Warehouse
from tidemark.sources.partitions import PartitionedTable


@pytest.fixture
def kept(spark, tmp_path):
    wh = Warehouse(spark, str(tmp_path / "kept"), rollups=True)
    wh.create_schema()
    return wh


def rows_of(frame, *columns):
    return sorted((tuple(r[c] for c in columns or frame.columns) for r in frame.collect()), key=str)


def same(kept, agg):
    names = sorted(agg.columns)
    assert sorted(kept.columns) == names
    got, want = rows_of(kept, *names), rows_of(agg, *names)
    assert [[pytest.approx(v) if isinstance(v, float) else v for v in r] for r in want] == [list(r) for r in got]


def test_kept_roll_ups_equal_those_of_all_rows(kept, silver):
    kept.load("coingecko", silver("coingecko", *[crypto("bitcoin", float(d), date(2031, m, d)) for m in (1, 2) for d in range(1, 9)]))
    kept.load("coingecko", silver("coingecko", crypto("bitcoin", 99.0, date(2031, 2, 3)), crypto("tron", None, date(2031, 2, 4)), crypto("tron", 7.0, date(2031, 3, 1))))
    same(kept_crypto_monthly(kept), views.agg_crypto_monthly(kept))
    kept.load("world_bank", silver("world_bank", *[gdp("UGA", y, v, g) for y, v, g in ((2019, None, None), (2020, 5.0, None), (2021, 6.0, 0.2))], gdp("KEN", 2021, 0.0)))
    kept.load("world_bank", silver("world_bank", gdp("UGA", 2022, None, 0.1), gdp("KEN", 2022, 3.0, 0.5)))
    same(kept_gdp_by_country(kept), views.agg_gdp_by_country(kept))
    kept.load("exchange_rate", silver("exchange_rate", rate("UGX", 3.0), rate("KES", 4.0)))
    kept.load("open_meteo", silver("open_meteo", weather(date(2031, 1, 1), 1.0), weather(date(2031, 1, 2), 2.5, 30.0)))
    for name in KEPT:
        if name != "kept_inflation_by_country":
            same(KEPT[name](kept), views.VIEWS[name.replace("kept", "agg")](kept))
    assert KEPT["kept_inflation_by_country"](kept).collect() == []


def test_a_load_reads_only_its_months(kept, silver, monkeypatch):
    months = [date(2031, m, 1) for m in range(1, 7)]
    kept.load("coingecko", silver("coingecko", *[crypto("bitcoin", 1.0, d) for d in months]))
    opened = []
    real = PartitionedTable.open

    def watched(self, section, folders):
        opened.append((section, set(folders)))
        return real(self, section, folders)

    monkeypatch.setattr(PartitionedTable, "open", watched)
    kept.load("coingecko", silver("coingecko", crypto("bitcoin", 2.0, months[2])))
    assert {v for s, values in opened if s == ROWS for v in values} == {203103}
    monkeypatch.undo()
    state = kept._fact(FACTS["fact_crypto"]).state()
    assert set(state.of(ROLLUP)) == {203100 + m for m in range(1, 7)}


def test_rollups_go_on_without_being_asked_and_can_begin_late(spark, tmp_path, silver):
    root = str(tmp_path / "late")
    plain = Warehouse(spark, root)
    plain.create_schema()
    plain.load("coingecko", silver("coingecko", crypto("bitcoin", 1.0, date(2031, 1, 1))))
    with pytest.raises(ValueError, match="no roll-ups are kept"):
        kept_crypto_monthly(plain)
    Warehouse(spark, root, rollups=True).load("coingecko", silver("coingecko", crypto("bitcoin", 2.0, date(2031, 2, 1))))
    plain.load("coingecko", silver("coingecko", crypto("bitcoin", 5.0, date(2031, 2, 1))))
    same(kept_crypto_monthly(plain), views.agg_crypto_monthly(plain))


def test_merging_partials_of_partials(spark):
    partials = PARTIALS["fact_inflation"]
    rows = spark.createDataFrame([(1, y, float(y) if y % 3 else None) for y in range(2000, 2020)], "country_key int, year int, inflation_pct double")
    by_year = partials.of(rows, "year")
    halves = partials.merged(by_year.withColumn("half", F.col("year") % 2), "country_key", "half")
    whole = partials.merged(halves, "country_key").first()
    assert whole["rows"] == 20 and (whole["first_time"], whole["last_time"]) == (2000, 2019)
    m = whole["inflation_pct"]
    known = [float(y) for y in range(2000, 2020) if y % 3]
    assert (m["n"], m["total"], m["low"], m["high"]) == (len(known), sum(known), known[0], known[-1])
    assert (m["first"]["at"], m["last"]["value"]) == (int(known[0]), known[-1])
