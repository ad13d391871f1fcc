"""The registered queries: contract of the entry module and a sample against SQL."""

import re

import duckdb
import pytest

import __spark_entry__ as driver
from check import TABLES, rows_of
from tidemark.catalog import lake

SF = "/root/testdata/sf0.001"
SAMPLE = (
    "bronze_envelope_explode contract_split silver_gdp_growth silver_news_volume dq_rates_landed "
    "dedupe_keep_first fact_upsert_replace view_crypto latest_price_per_coin chart_crypto_bar "
    "batch_score_crypto champion_gate"
).split()

# Which of the text operators have SQL is tested beside them.
TEXT_QUERY = re.compile(r"op\d+_\w+|pipeline")


def test_every_query_has_sql_and_plain_columns():
    queries, oracles = driver.queries(), driver.oracle_sql()
    assert {q for q in set(queries) - set(oracles) if not TEXT_QUERY.fullmatch(q)} == set()
    assert set(oracles) <= set(queries)
    assert len([q for q in queries if not TEXT_QUERY.fullmatch(q)]) >= 110


def test_sql_reads_the_given_tables():
    for name, sql in driver.oracle_sql().items():
        assert any(re.search(rf"\b{t}\b", sql) for t in TABLES), name


@pytest.mark.parametrize("name", SAMPLE)
def test_query_equals_sql(spark, name):
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM '{SF}/{t}.parquet'")
    df = driver.queries()[name](spark, SF)
    answer = con.execute(driver.oracle_sql()[name])
    columns = [d[0] for d in answer.description]
    assert sorted(columns) == sorted(df.columns)
    assert rows_of(df.columns, [tuple(r) for r in df.collect()]) == rows_of(columns, answer.fetchall())


def test_flagship(spark):
    assert driver.entry(spark).count() > 0


def test_a_dimension_of_articles_needs_no_fact(spark, tmp_path):
    """The texts of articles aren't loaded for the names of their sources."""
    rows = [(i, f"text {i // 2}", f"src{i % 3}", "en", 6) for i in range(12)]
    spark.createDataFrame(rows, "doc_id long, text string, source string, lang string, n_chars long").write.parquet(f"{tmp_path}/documents.parquet")
    queries = driver.queries()
    found = queries["dim_news_source"](spark, str(tmp_path)).collect()
    assert sorted(r["source_name"] for r in found) == ["src1", "src2"]
    wh = lake.warehouse(spark, str(tmp_path))
    assert wh.table("fact_news").count() == 0
    assert queries["view_news"](spark, str(tmp_path)).count() == 6 and wh.table("fact_news").count() == 6
    assert queries["dim_news_source"](spark, str(tmp_path)).collect() == found
