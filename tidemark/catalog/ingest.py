"""Queries over landed documents, contracts, Silver and the row-reducing operators."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.catalog.feeds import (
    CLEAN_SQL, DOCUMENTS, FEATURE_SQL, RAW_SQL, SHORT, coin, silver_ctes, table,
)
from tidemark.catalog.lake import silver
from tidemark.catalog.shape import Catalog
from tidemark.functions import struct_to_map
from tidemark.operators.joins import lookup_join
from tidemark.operators.merge import number_members
from tidemark.operators.quality import count_orphans, evaluate
from tidemark.operators.series import first_per_key, newest_per_key
from tidemark.plans.jobs import land_payloads, run_silver, run_steps
from tidemark.plans.silver import candidates, snapshot_silver
from tidemark.session import scratch_path
from tidemark.sources.bronze import completeness, envelopes, numbered_pages, read_bronze, read_landed, write_bronze
from tidemark.sources.contracts import check_payloads
from tidemark.sources.extras import extra, extra_series
from tidemark.sources.registry import get_source
from tidemark.sources.silver import read_silver, write_silver
from tidemark.sources.storage import delete, stored_bytes
from tidemark.streaming.landing import land_candidates, silver_from_candidates

ingest = Catalog()
PULLED_ON = "2026-07-20"

SILVER_SHAPES = {
    "world_bank": (
        "country_iso3 country_name indicator_id year:i gdp_usd:r gdp_growth_rate:r logical_date:d"
    ),
    "world_bank_inflation": (
        "country_iso3 country_name indicator_id year:i inflation_pct:r inflation_trend:r "
        "logical_date:d"
    ),
    "exchange_rate": "base_code currency rate:r exchange_momentum:r logical_date:d",
    "open_meteo": (
        "date:d latitude:r longitude:r temp_max_c:r temp_min_c:r precipitation_mm:r "
        "precip_30d_avg_mm:r rainfall_anomaly_mm:r logical_date:d"
    ),
    "coingecko": (
        "coin_id symbol name price_usd:r market_cap_usd:r volume_usd:r price_change_pct_24h:r "
        "volatility_7d:r logical_date:d"
    ),
    "newsapi": (
        "source_name author title description url published_at:t articles_that_day:b "
        "logical_date:d"
    ),
}
SILVER_NAMES = {
    "world_bank": "silver_gdp_growth",
    "world_bank_inflation": "silver_inflation_trend",
    "exchange_rate": "silver_fx_momentum",
    "open_meteo": "silver_weather_anomaly",
    "coingecko": "silver_crypto_volatility",
    "newsapi": "silver_news_volume",
}

# -- landing


def _coin_pages(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One page per event; the event number places it within its day."""
    day = F.date_format("ts", "yyyy-MM-dd")
    return coin(spark, sf_dir).select(
        F.lit("coingecko").alias("source"),
        F.concat(day, F.lit("T00:00:00+00:00")).alias("logical_date"),
        F.concat(day, F.lit("T23:00:00+00:00")).alias("fetched_at"),
        F.col("event_id").alias("page_no"),
        F.struct(F.array("coin").alias("coins")).alias("page"),
    )


def _with_date(documents: DataFrame) -> DataFrame:
    return documents.withColumn("logical_date", F.to_date(F.substring("logical_date", 1, 10)))


def envelope_explode(spark: SparkSession, sf_dir: str) -> DataFrame:
    documents = _with_date(envelopes(_coin_pages(spark, sf_dir)))
    return get_source("coingecko").flatten(numbered_pages(documents))


FLAT_COINS = (
    "coin_id symbol name price_usd:r market_cap_usd:r volume_usd:r price_change_pct_24h:r "
    "logical_date:d"
)
ingest.add(
    "bronze_envelope_explode", FLAT_COINS, envelope_explode, "SELECT * FROM crypto_raw",
    f"WITH crypto_raw AS ({RAW_SQL['coingecko']})",
)


def page_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    documents = _with_date(envelopes(_coin_pages(spark, sf_dir)))
    pull = documents.groupBy("logical_date", "fetched_at").agg(F.max("page_count").alias("pages"))
    return pull.groupBy("logical_date").agg(F.sum("pages").alias("pages"))


ingest.add(
    "bronze_page_counts", "logical_date:d pages:b", page_counts,
    "SELECT CAST(ts AS DATE) AS logical_date, count(*) AS pages FROM events GROUP BY 1",
)


def bronze_roundtrip(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Land envelopes as JSON, land them again (which replaces), read them back and flatten."""
    path = scratch_path(spark, "bronze")
    documents = envelopes(_coin_pages(spark, sf_dir))
    write_bronze(documents, path)
    write_bronze(documents, path)
    return candidates(read_landed(spark, "coingecko", path), get_source("coingecko"))


ingest.add(
    "bronze_json_roundtrip", FLAT_COINS, bronze_roundtrip,
    "SELECT * FROM crypto_raw WHERE price_usd IS NOT NULL",
    f"WITH crypto_raw AS ({RAW_SQL['coingecko']})",
)


def bronze_day(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Point read of one source and day of everything that was landed."""
    path = scratch_path(spark, "bronze")
    write_bronze(envelopes(_coin_pages(spark, sf_dir)), path)
    landed = read_landed(spark, "coingecko", path, day="2024-01-15")
    return candidates(landed, get_source("coingecko"))


ingest.add(
    "bronze_point_read", FLAT_COINS, bronze_day,
    "SELECT * FROM crypto_raw WHERE price_usd IS NOT NULL AND logical_date = DATE '2024-01-15'",
    f"WITH crypto_raw AS ({RAW_SQL['coingecko']})",
)


def bronze_large_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Files of many documents over many lines, each read by several tasks in ranges of a few kilobytes
    (of 64 MB in production): every document is read once."""
    path = scratch_path(spark, "bronze-large")
    documents = DOCUMENTS["coingecko"](spark, sf_dir).withColumn("logical_date", F.col("logical_date").cast("string"))
    text = F.to_json(F.struct("*"), {"pretty": "true"})
    documents.select(text.alias("value")).write.text(path)
    ranges = max(1 << 14, stored_bytes(spark, f"{path}/part-*") // 100)
    return candidates(read_bronze(spark, "coingecko", path, range_bytes=ranges), get_source("coingecko"))


ingest.add(
    "bronze_large_files", FLAT_COINS, bronze_large_files,
    "SELECT * FROM crypto_raw WHERE price_usd IS NOT NULL",
    f"WITH crypto_raw AS ({RAW_SQL['coingecko']})",
)


def nested_posexplode(spark: SparkSession, sf_dir: str) -> DataFrame:
    return candidates(DOCUMENTS["open_meteo"](spark, sf_dir), get_source("open_meteo"))


ingest.add(
    "nested_posexplode",
    "date:d latitude:r longitude:r temp_max_c:r temp_min_c:r precipitation_mm:r logical_date:d",
    nested_posexplode, "SELECT * FROM weather_raw",
    f"WITH weather_raw AS ({RAW_SQL['open_meteo']})",
)


def json_map_explode(spark: SparkSession, sf_dir: str) -> DataFrame:
    """An inferred-looking struct back to a map, then one row per entry."""
    events = table(spark, sf_dir, "events")
    as_struct = events.withColumn("fields", F.from_json("props", "k int"))
    pairs = F.explode(struct_to_map(F.col("fields"))).alias("name", "amount")
    return as_struct.select("event_id", pairs)


ingest.add(
    "json_map_explode", "event_id:b name amount:r", json_map_explode,
    "SELECT event_id, 'k' AS name, CAST(json_extract_string(props, '$.k') AS DOUBLE) AS amount "
    "FROM events",
)


def contract_split(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Raw payload texts, some broken on purpose by event type, against the coin contract."""
    events = table(spark, sf_dir, "events")
    kind = F.col("event_type")
    user, value = F.col("user_id").cast("string"), F.col("value").cast("string")
    name = F.when(kind == "signup", F.lit("")).otherwise(F.concat(F.lit('"name":"Coin '), user, F.lit('",')))
    price = F.when(kind == "error", F.lit('"n/a"')).when(kind == "view", F.concat(F.lit('"'), value, F.lit('"')))
    end = F.when(kind == "purchase", F.lit("")).otherwise(F.lit("]"))
    payload = F.concat(
        F.lit('[{"id":"coin-'), user, F.lit('","symbol":"c'), user, F.lit('",'), name,
        F.lit('"extra":1,"current_price":'), price.otherwise(value), F.lit("}"), end,
    )
    checked = check_payloads(events.select("event_id", payload.alias("payload")), "coingecko")
    first = F.get("page.coins", F.lit(0))
    whole = F.size("problems") == 0
    return checked.select(
        "event_id",
        F.array_join("problems", "; ").alias("problems"),
        F.when(whole, first["current_price"]).alias("price"),
        F.when(whole, first["id"]).alias("coin_id"),
    )


ingest.add(
    "contract_split", "event_id:b problems price:r coin_id",
    contract_split,
    """SELECT event_id,
        CASE event_type WHEN 'signup' THEN 'coins[].name: missing'
            WHEN 'error' THEN 'coins[].current_price: not a number'
            WHEN 'purchase' THEN 'payload: not a JSON document of the expected shape'
            ELSE '' END AS problems,
        CASE WHEN event_type NOT IN ('signup', 'error', 'purchase') THEN value END AS price,
        CASE WHEN event_type NOT IN ('signup', 'error', 'purchase') THEN 'coin-' || user_id END
            AS coin_id
    FROM events""",
)


NOT_OF_SHAPE = "payload: not a JSON document of the expected shape"


def _contract(source: str, name: str, key: str, text, value):
    """Payload texts made of rows of a table, some broken on purpose, against a feed's contract."""

    def query(spark: SparkSession, sf_dir: str) -> DataFrame:
        rows = table(spark, sf_dir, name)
        checked = check_payloads(rows.select(key, text().alias("payload")), source)
        found = F.when(F.size("problems") == 0, value())
        return checked.select(key, F.array_join("problems", "; ").alias("problems"), found.alias("found"))

    return query


def _annual_text() -> Column:
    """A list of the page's description and its records; without a year, or without records, by status."""
    status = F.col("o_orderstatus")
    year = F.when(status == "P", F.lit("")).otherwise(
        F.concat(F.lit(',"date":"'), F.year("o_orderdate").cast("string"), F.lit('"'))
    )
    record = F.concat(
        F.lit('{"indicator":{"id":"I","value":"i"},"country":{"id":"A","value":"a"},"countryiso3code":"AAA","value":'),
        F.col("o_totalprice").cast("string"), year, F.lit("}"),
    )
    meta = F.lit('[{"page":1,"pages":1,"per_page":"50","total":1}')
    return F.when(status == "O", F.concat(meta, F.lit("]"))).otherwise(F.concat(meta, F.lit(",["), record, F.lit("]]")))


ingest.add(
    "contract_annual", "o_orderkey:b problems found:r",
    _contract("world_bank", "orders", "o_orderkey", _annual_text, lambda: F.get("page.records", F.lit(0))["value"]),
    f"""SELECT o_orderkey, CASE o_orderstatus WHEN 'P' THEN 'records[].date: missing'
        WHEN 'O' THEN '{NOT_OF_SHAPE}' ELSE '' END AS problems,
        CASE WHEN o_orderstatus NOT IN ('P', 'O') THEN o_totalprice END AS found
    FROM orders""",
)


def _rates_text() -> Column:
    """Rates that are missing, or of which one is, by status."""
    rate = F.when(F.col("o_orderstatus") == "P", F.lit("null")).otherwise(F.col("o_totalprice").cast("string"))
    rates = F.when(F.col("o_orderstatus") == "O", F.lit("")).otherwise(
        F.concat(F.lit(',"rates":{"USD":1,"EUR":'), rate, F.lit("}"))
    )
    return F.concat(F.lit('{"result":"success","base_code":"USD","note":[1]'), rates, F.lit("}"))


ingest.add(
    "contract_rates", "o_orderkey:b problems found:r",
    _contract("exchange_rate", "orders", "o_orderkey", _rates_text, lambda: F.try_element_at("page.rates", F.lit("EUR"))),
    """SELECT o_orderkey, CASE o_orderstatus WHEN 'P' THEN 'rates{}: missing'
        WHEN 'O' THEN 'rates: missing' ELSE '' END AS problems,
        CASE WHEN o_orderstatus NOT IN ('P', 'O') THEN o_totalprice END AS found
    FROM orders""",
)


def _news_text() -> Column:
    """Articles without a title, or announced by a number that is none, by language."""
    total = F.when(F.col("lang") == "de", F.lit("1.5")).otherwise(F.lit("1"))
    title = F.when(F.col("lang") != "fr", F.col("text"))
    article = F.struct(
        F.struct(F.col("source").alias("name")).alias("source"), title.alias("title"),
        F.lit("u").alias("url"), F.lit("2024-01-01T00:00:00Z").alias("publishedAt"),
    )
    return F.concat(
        F.lit('{"status":"ok","totalResults":'), total, F.lit(',"articles":['), F.to_json(article), F.lit("]}")
    )


ingest.add(
    "contract_news", "doc_id:b problems found",
    _contract("newsapi", "documents", "doc_id", _news_text, lambda: F.md5(F.get("page.articles", F.lit(0))["title"])),
    """SELECT doc_id, CASE lang WHEN 'de' THEN 'totalResults: not a number'
        WHEN 'fr' THEN 'articles[].title: missing' ELSE '' END AS problems,
        CASE WHEN lang NOT IN ('de', 'fr') THEN md5(text) END AS found
    FROM documents""",
)


def _weather_text() -> Column:
    """Readings of a place that is no number, or without days, by line status and return flag."""
    place = F.when(F.col("l_returnflag") == "R", F.lit('"north"')).otherwise(F.col("l_tax").cast("string"))
    days = F.when(F.col("l_returnflag") == "A", F.lit("")).otherwise(
        F.concat(F.lit('"time":["'), F.date_format("l_shipdate", "yyyy-MM-dd"), F.lit('"],'))
    )
    return F.concat(
        F.lit('{"latitude":'), place, F.lit(',"longitude":2,"elevation":9,"daily":{'), days,
        F.lit('"precipitation_sum":['), F.col("l_quantity").cast("string"), F.lit("]}}"),
    )


def contract_weather(spark: SparkSession, sf_dir: str) -> DataFrame:
    """How many payloads of line items break the weather contract, by kind, and the rain of the others."""
    rows = table(spark, sf_dir, "lineitem").select(_weather_text().alias("payload"))
    checked = check_payloads(rows, "open_meteo")
    rain = F.get("page.daily.precipitation_sum", F.lit(0))
    return checked.groupBy(F.array_join("problems", "; ").alias("problems")).agg(
        F.count(F.lit(1)).alias("payloads"), F.sum(F.when(F.size("problems") == 0, rain)).alias("rain")
    )


ingest.add(
    "contract_weather", "problems payloads:b rain:r", contract_weather,
    """SELECT CASE l_returnflag WHEN 'R' THEN 'latitude: not a number'
        WHEN 'A' THEN 'daily.time: missing' ELSE '' END AS problems, count(*) AS payloads,
        sum(CASE WHEN l_returnflag NOT IN ('R', 'A') THEN l_quantity END) AS rain
    FROM lineitem GROUP BY 1""",
)


def landing_completeness(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Pages landed per day against the number of pages the payload announces."""
    orders = table(spark, sf_dir, "orders")
    pages = F.dayofmonth("o_orderdate")
    meta = F.struct(
        F.lit(1).alias("page"), pages.alias("pages"), F.lit(1).alias("per_page"), F.lit(1).alias("total")
    )
    schema = get_source("world_bank").bronze_schema["pages"].dataType
    records = F.array().cast(schema.elementType["records"].dataType)
    page = F.struct(meta.alias("meta"), records.alias("records"))
    day = F.date_format("o_orderdate", "yyyy-MM-dd")
    documents = orders.select(
        F.lit("world_bank").alias("source"),
        F.to_date("o_orderdate").alias("logical_date"),
        F.concat(day, F.lit("T23:00:00+00:00")).alias("fetched_at"),
        F.array(page).cast(schema).alias("pages"),
    )
    return completeness(documents, "world_bank")


ingest.add(
    "landing_completeness", "logical_date:d pages_landed:b pages_expected:b complete",
    landing_completeness,
    """SELECT CAST(o_orderdate AS DATE) AS logical_date, count(*) AS pages_landed,
        day(CAST(o_orderdate AS DATE)) AS pages_expected,
        count(*) >= day(CAST(o_orderdate AS DATE)) AS complete
    FROM orders GROUP BY CAST(o_orderdate AS DATE)""",
)

def coin_completeness(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A page of up to 100 coins per event type and day: every full page asks for another."""
    kinds = table(spark, sf_dir, "events").groupBy(F.to_date("ts").alias("day"), "event_type").count()
    page = get_source("coingecko").bronze_schema["pages"].dataType.elementType
    none = F.lit(None).cast(page["coins"].dataType.elementType)
    coins = F.array_repeat(none, F.least(F.col("count"), F.lit(100)).cast("int"))
    documents = kinds.select(
        F.lit("coingecko").alias("source"),
        F.col("day").alias("logical_date"),
        F.col("day").cast("string").alias("fetched_at"),
        F.array(F.struct(coins.alias("coins"))).alias("pages"),
    )
    return completeness(documents, "coingecko")


ingest.add(
    "landing_completeness_coins", "logical_date:d pages_landed:b pages_expected:b complete",
    coin_completeness,
    """SELECT day AS logical_date, count(*) AS pages_landed,
        count(*) FILTER (WHERE n >= 100) + 1 AS pages_expected,
        count(*) >= count(*) FILTER (WHERE n >= 100) + 1 AS complete
    FROM (SELECT CAST(ts AS DATE) AS day, event_type, count(*) AS n FROM events GROUP BY 1, 2) AS kinds
    GROUP BY day""",
)


def news_completeness(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A page per language of every source, each announcing the articles of the whole source."""
    texts = table(spark, sf_dir, "documents").groupBy("source", "lang").count()
    totals = texts.groupBy("source").agg(F.sum("count").cast("int").alias("announced"))
    page = get_source("newsapi").bronze_schema["pages"].dataType.elementType
    documents = lookup_join(texts, totals, ["source"]).select(
        F.lit("newsapi").alias("source"),
        F.lit(PULLED_ON).cast("date").alias("logical_date"),
        F.col("source").alias("fetched_at"),
        F.array(
            F.struct(
                F.lit("ok").alias("status"), F.col("announced").alias("totalResults"),
                F.array().cast(page["articles"].dataType).alias("articles"),
            )
        ).alias("pages"),
    )
    return completeness(documents, "newsapi")


ingest.add(
    "landing_completeness_news", "fetched_at pages_landed:b pages_expected:b complete",
    news_completeness,
    """SELECT source AS fetched_at, count(DISTINCT lang) AS pages_landed,
        greatest(1, ceil(count(*) / 100)) AS pages_expected,
        count(DISTINCT lang) >= greatest(1, ceil(count(*) / 100)) AS complete
    FROM documents GROUP BY source""",
)

# -- Silver


def _silver_query(source: str):
    return lambda spark, sf_dir: silver(spark, sf_dir, source)


for _source, _name in SILVER_NAMES.items():
    ingest.add(
        _name, SILVER_SHAPES[_source], _silver_query(_source),
        f"SELECT * FROM {SHORT[_source]}_silver", f"WITH {silver_ctes(_source)}",
    )


def silver_roundtrip(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Write Silver by day twice, the second time over the first, and read it by contract."""
    path = scratch_path(spark, "silver-roundtrip")
    spec = get_source("coingecko")
    rows = silver(spark, sf_dir, "coingecko")
    write_silver(rows, path, spec.partition_cols, full_refresh=True)
    write_silver(rows, path, spec.partition_cols)
    return read_silver(spark, "coingecko", path)


ingest.add(
    "silver_overwrite_roundtrip", SILVER_SHAPES["coingecko"], silver_roundtrip,
    "SELECT * FROM crypto_silver", f"WITH {silver_ctes('coingecko')}",
)



def streamed_silver(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Two pulls of every day, taken in one after the other; Silver as of all documents at once."""
    bronze, flat, checkpoint = (scratch_path(spark, f"stream-{n}") for n in ("in", "flat", "state"))
    documents = DOCUMENTS["coingecko"](spark, sf_dir)
    morning = F.substring("fetched_at", 12, 2) < "12"
    for part, pull in (("am", morning), ("pm", ~morning)):
        documents.where(pull).write.json(f"{bronze}/{part}")
        land_candidates(spark, "coingecko", bronze, flat, checkpoint)
    return silver_from_candidates(spark, "coingecko", flat, bronze)


ingest.add(
    "silver_from_stream", SILVER_SHAPES["coingecko"], streamed_silver,
    "SELECT * FROM crypto_silver", f"WITH {silver_ctes('coingecko')}",
)

# -- jobs


def _payloads(items: DataFrame, per_page: int, around: str) -> DataFrame:
    """JSON objects (item) as the raw texts of one pull, `per_page` to a page, numbered from zero."""
    numbered = number_members(items.groupBy("item").count(), ["item"], "n")
    page_no = F.floor((F.col("n") - 1) / per_page).alias("page_no")
    # At most `per_page` objects come together.
    pages = numbered.groupBy(page_no).agg(F.concat_ws(",", F.collect_list("item")).alias("listed"))
    return pages.select("page_no", F.format_string(around, "listed").alias("payload"))


def _run_landed(spark: SparkSession, source: str, **payloads: DataFrame) -> DataFrame:
    """Land one pull of each feed under one root and make Silver of `source`."""
    bronze, out = scratch_path(spark, "job-bronze"), scratch_path(spark, "job-silver")
    for feed, texts in payloads.items():
        land_payloads(texts, feed, PULLED_ON, bronze)
    run_silver(spark, source, bronze, out)
    delete(spark, bronze)
    return read_silver(spark, source, out)


def job_land_run_silver(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One pull of far more pages than an envelope holds, landed and made Silver of."""
    coins = DOCUMENTS["coingecko"](spark, sf_dir).select(F.to_json(F.col("pages")[0]["coins"][0]).alias("item"))
    return _run_landed(spark, "coingecko", coingecko=_payloads(coins, 4, "[%s]"))


ingest.add(
    "job_land_run_silver", SILVER_SHAPES["coingecko"], job_land_run_silver,
    "SELECT * FROM crypto_silver", f"WITH {silver_ctes('coingecko', pulled_on=PULLED_ON)}",
)


# Fixed names of daily series that the weather contract doesn't model.
WIND, SKY = "wind_speed_10m_max", "sky"


def weather_extras(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Weather payloads with two further daily series and a height, landed and read back by path."""
    bronze = scratch_path(spark, "extras-bronze")
    months = DOCUMENTS["open_meteo"](spark, sf_dir).select(F.col("pages")[0].alias("page"), "fetched_at")
    days = F.col("page.daily")
    wind = F.transform(days["temperature_2m_max"], lambda t: t / 2)
    sky = F.transform(days["precipitation_sum"], lambda r: F.when(r > 100, "wet").when(r > 20, "grey"))
    daily = F.struct(*[days[f].alias(f) for f in ("time", "temperature_2m_max", "precipitation_sum")],
                     wind.alias(WIND), sky.alias(SKY))
    payload = F.struct(
        "page.latitude", "page.longitude", F.size(days["time"]).alias("elevation"), daily.alias("daily"),
    )
    texts = months.select(F.to_json(payload, {"ignoreNullFields": "false"}).alias("item"), "fetched_at")
    numbered = number_members(texts, ["fetched_at", "item"], "n")
    land_payloads(numbered.select((F.col("n") - 1).alias("page_no"), F.col("item").alias("payload")), "open_meteo", PULLED_ON, bronze)
    pages = numbered_pages(read_landed(spark, "open_meteo", bronze))
    readings = extra_series(pages.withColumn("height", extra("$.elevation", "int")), "page.daily.time", "$.daily")
    typed = get_source("open_meteo").flatten(pages).select("page_no", "item_no", "date", "latitude", "longitude", "precipitation_mm")
    return readings.join(typed, ["page_no", "item_no"]).select(
        "date", "latitude", "longitude", "precipitation_mm", "series", "height",
        F.try_variant_get("reading", "$", "double").alias("number"), F.try_variant_get("reading", "$", "string").alias("word"),
    ).withColumn("word", F.when(F.col("series") == SKY, F.col("word")))


ingest.add(
    "weather_extras", "date:d latitude:r longitude:r precipitation_mm:r series height:i number:r word", weather_extras,
    f"""SELECT date, latitude, longitude, precipitation_mm, series,
        CAST(doc->>'$.elevation' AS INTEGER) AS height,
        CASE WHEN series = '{WIND}' THEN CAST(json_extract_string(doc, '$.daily.' || series || '[0]') AS DOUBLE) END AS number,
        CASE WHEN series = '{SKY}' THEN json_extract_string(doc, '$.daily.' || series || '[0]') END AS word
    FROM (SELECT *, json_object(
            'elevation', count(*) OVER (PARTITION BY latitude, longitude, date_trunc('month', date), fetched),
            'daily', json_object('{WIND}', [temp_max_c / 2], '{SKY}', [
                CASE WHEN precipitation_mm > 100 THEN 'wet' WHEN precipitation_mm > 20 THEN 'grey' END])) AS doc
        FROM weather_raw) AS landed,
        (SELECT unnest(['{WIND}', '{SKY}']) AS series) AS names""",
    f"WITH weather_raw AS ({RAW_SQL['open_meteo']})",
)


def _annual_items(spark: SparkSession, sf_dir: str, source: str, measure: str) -> DataFrame:
    """The newest value of every country and year as records of a payload."""
    named = F.struct(F.col("country_iso3").alias("id"), F.col("country_name").alias("value"))
    record = F.struct(
        F.struct(F.col("indicator_id").alias("id"), F.lit("").alias("value")).alias("indicator"),
        named.alias("country"), F.col("country_iso3").alias("countryiso3code"),
        F.col("year").cast("string").alias("date"), F.col(measure).alias("value"),
    )
    return silver(spark, sf_dir, source).select(F.to_json(record).alias("item"))


def job_feeds_side_by_side(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Two annual feeds of the same schema under one root: each job reads its own."""
    around = '[{"page":1,"pages":1,"per_page":50,"total":1},[%s]]'
    return _run_landed(
        spark, "world_bank",
        world_bank=_payloads(_annual_items(spark, sf_dir, "world_bank", "gdp_usd"), 20, around),
        world_bank_inflation=_payloads(
            _annual_items(spark, sf_dir, "world_bank_inflation", "inflation_pct"), 20, around
        ),
    )


ingest.add(
    "job_feeds_side_by_side", SILVER_SHAPES["world_bank"], job_feeds_side_by_side,
    f"SELECT * REPLACE (DATE '{PULLED_ON}' AS logical_date) FROM gdp_silver",
    f"WITH {silver_ctes('world_bank')}",
)


def job_steps(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The chains of two feeds, step by step: one that passes, and one with negative values, gated and not."""
    answer = None
    for source, gate, spoil in (("coingecko", True, False), ("world_bank", True, True), ("world_bank", False, True)):
        bronze, out, root = (scratch_path(spark, f"steps-{n}") for n in ("bronze", "silver", "warehouse"))
        documents = DOCUMENTS[source](spark, sf_dir).withColumn("logical_date", F.col("logical_date").cast("string"))
        if spoil:
            negative = lambda r: r.withField("value", -r["value"])
            wrong = lambda p: p.withField("records", F.transform(p["records"], negative))
            documents = documents.withColumn("pages", F.transform("pages", wrong))
        documents.write.json(bronze)
        steps = run_steps(spark, source, bronze, out, root, gate).withColumn("gated", F.lit(gate))
        answer = steps if answer is None else answer.unionByName(steps)
    return answer


def _steps_sql() -> str:
    parts = []
    for source, gated, failing in (("coingecko", "true", 0), ("world_bank", "true", 1), ("world_bank", "false", 1)):
        rows = f"(SELECT count(*) FROM {SHORT[source]}_silver)"
        skipped = failing and gated == "true"
        for step, status, count in (
            ("silver", "ok", rows), ("validate", "failed" if failing else "ok", failing),
            ("load", "skipped" if skipped else "ok", "NULL" if skipped else rows),
        ):
            parts.append(f"SELECT '{source}' AS source, '{step}' AS step, '{status}' AS status, {count} AS rows, {gated} AS gated")
    return " UNION ALL ".join(parts)


ingest.add(
    "job_steps", "source step status rows:b gated", job_steps, _steps_sql(),
    f"WITH {silver_ctes('coingecko', 'world_bank')}",
)


def snapshot(source: str):
    def query(spark: SparkSession, sf_dir: str) -> DataFrame:
        documents = DOCUMENTS[source](spark, sf_dir)
        # One pull: its pages are numbered by the instants that the feeds give their rows.
        return snapshot_silver(
            documents.withColumn("logical_date", F.lit(PULLED_ON).cast("date"))
            .withColumn("page_numbers", F.array(F.unix_timestamp(F.to_timestamp("fetched_at")))),
            source,
        )

    return query


def snapshot_sql(source: str, derived: str) -> str:
    keep, key, _ = CLEAN_SQL[source]
    return (
        f"SELECT *, {derived} FROM (SELECT *, row_number() OVER (PARTITION BY {key} ORDER BY page) AS place "
        f"FROM raw WHERE {keep}) AS ranked WHERE place = 1"
    )


def one_pull(source: str) -> str:
    raw = RAW_SQL[source]
    return f"WITH raw AS (SELECT * REPLACE (DATE '{PULLED_ON}' AS logical_date), fetched AS page FROM ({raw}))"


ingest.add(
    "snapshot_gdp", SILVER_SHAPES["world_bank"], snapshot("world_bank"),
    f"SELECT *, {FEATURE_SQL['world_bank']} FROM ({snapshot_sql('world_bank', '0 AS one')}) AS firsts",
    one_pull("world_bank"),
)
ingest.add(
    "snapshot_rates", SILVER_SHAPES["exchange_rate"], snapshot("exchange_rate"),
    snapshot_sql("exchange_rate", "CAST(NULL AS DOUBLE) AS exchange_momentum"), one_pull("exchange_rate"),
)

for _source, _name in (("open_meteo", "snapshot_weather"), ("newsapi", "snapshot_news")):
    ingest.add(
        _name, SILVER_SHAPES[_source], snapshot(_source),
        f"SELECT *, {FEATURE_SQL[_source]} FROM ({snapshot_sql(_source, '0 AS one')}) AS firsts", one_pull(_source),
    )

# -- one row per key


LINE_COLUMNS = (
    "l_orderkey:b l_linenumber:i l_partkey:b l_suppkey:b l_quantity:r l_extendedprice:r "
    "l_discount:r l_tax:r l_returnflag l_linestatus l_shipdate:d"
)
# The order in which the file stores the columns settles equal ship dates.
LINE_TIES = (
    "l_partkey DESC, l_suppkey DESC, l_quantity DESC, l_extendedprice DESC, l_discount DESC, "
    "l_tax DESC, l_returnflag DESC, l_linestatus DESC"
)


def newest_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    lines = table(spark, sf_dir, "lineitem")
    return newest_per_key(lines, ["l_orderkey", "l_linenumber"], ["l_shipdate"])


ingest.add(
    "dedupe_lineitem_latest", LINE_COLUMNS, newest_lines,
    f"""SELECT * FROM (SELECT *, row_number() OVER (
        PARTITION BY l_orderkey, l_linenumber ORDER BY l_shipdate DESC, {LINE_TIES}) AS place
        FROM lineitem) AS ranked WHERE place = 1""",
)


def first_copies(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The first document of every distinct whole text."""
    documents = table(spark, sf_dir, "documents")
    keyed = documents.withColumn("text_hash", F.sha2("text", 256))
    return first_per_key(keyed, ["text_hash"], ["doc_id"])


ingest.add(
    "dedupe_keep_first", "doc_id:b lang source n_chars:b text", first_copies,
    """SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY text ORDER BY doc_id) AS place
        FROM documents) AS ranked WHERE place = 1""",
)

# -- quality

QUALITY = "asset expectation columns violations:b success"


def _quality_body(asset: str, rows: str, silver_columns: list[str], present: list[str], checks) -> str:
    """SQL of a suite over the relation `rows`: one aggregate per expectation."""
    differing = len(set(silver_columns) ^ set(present))
    answers = [
        f"SELECT '{asset}' AS asset, 'columns_match' AS expectation, "
        f"'{','.join(silver_columns)}' AS columns, {differing} AS violations"
    ]
    for kind, columns, condition in checks:
        if "unique" in kind:
            known = " OR ".join(f"{c} IS NOT NULL" for c in columns.split(","))
            count = (
                f"(SELECT coalesce(sum(n), 0) FROM (SELECT count(*) AS n FROM {rows} "
                f"WHERE {known} GROUP BY {columns}) AS grouped WHERE n > 1)"
            )
        else:
            count = f"(SELECT count(*) FROM {rows} WHERE {condition})"
        answers.append(
            f"SELECT '{asset}' AS asset, '{kind}' AS expectation, '{columns}' AS columns, "
            f"{count} AS violations"
        )
    return (
        "SELECT *, violations = 0 AS success FROM ("
        + " UNION ALL ".join(answers) + ") AS answers"
    )


def _nulls(*columns: str):
    return [("not_null", c, f"{c} IS NULL") for c in columns]


def _outside(column: str, condition: str):
    return ("between", column, condition)


_ANNUAL = [
    *_nulls("country_iso3", "country_name", "indicator_id", "year", "logical_date"),
    ("compound_unique", "country_iso3,indicator_id,year", ""),
    _outside("year", "year < 1960 OR year > 2100"),
]
CHECKS_SQL = {
    "world_bank": [*_ANNUAL, _outside("gdp_usd", "gdp_usd < 0")],
    "world_bank_inflation": [
        *_ANNUAL, _outside("inflation_pct", "inflation_pct < -50 OR inflation_pct > 1000"),
    ],
    "exchange_rate": [
        *_nulls("base_code", "currency", "rate", "logical_date"),
        ("compound_unique", "base_code,currency,logical_date", ""),
        _outside("rate", "rate <= 0"),
    ],
    "open_meteo": [
        *_nulls("date", "latitude", "longitude", "logical_date"),
        ("compound_unique", "latitude,longitude,date", ""),
        _outside("latitude", "latitude < -90 OR latitude > 90"),
        _outside("longitude", "longitude < -180 OR longitude > 180"),
        _outside("precipitation_mm", "precipitation_mm < 0"),
        _outside("temp_max_c", "temp_max_c < -30 OR temp_max_c > 60"),
        _outside("temp_min_c", "temp_min_c < -50 OR temp_min_c > 50"),
    ],
    "coingecko": [
        *_nulls("coin_id", "price_usd", "logical_date"),
        ("compound_unique", "coin_id,logical_date", ""),
        _outside("price_usd", "price_usd < 0"),
        _outside("market_cap_usd", "market_cap_usd < 0"),
        _outside("volume_usd", "volume_usd < 0"),
    ],
    "newsapi": [
        *_nulls("title", "url", "logical_date"),
        ("unique", "url", ""),
        _outside("articles_that_day", "articles_that_day < 1"),
    ],
}


def _silver_quality(source: str):
    def query(spark: SparkSession, sf_dir: str) -> DataFrame:
        return evaluate(silver(spark, sf_dir, source), get_source(source).suite, source)

    return query


def _columns(source: str) -> list[str]:
    from tidemark.sources.schemas import SILVER, names

    return names(SILVER[source])


for _source in SILVER_NAMES:
    ingest.add(
        f"dq_{SHORT[_source]}_silver", QUALITY, _silver_quality(_source),
        _quality_body(
            _source, f"{SHORT[_source]}_silver", _columns(_source), _columns(_source),
            CHECKS_SQL[_source],
        ),
        f"WITH {silver_ctes(_source)}",
    )


def _unreduced(source: str):
    """Rows as landed, before cleaning and before one row per key: most suites must fail."""

    def query(spark: SparkSession, sf_dir: str) -> DataFrame:
        spec = get_source(source)
        documents = DOCUMENTS[source](spark, sf_dir)
        return evaluate(spec.flatten(numbered_pages(documents)), spec.suite, source)

    return query


# The landed rows lack the derived columns and carry the place in the payload.
LANDED_EXTRA = ["fetched_at", "page_no", "item_no"]
for _source, _derived in (
    ("coingecko", ["volatility_7d"]),
    ("exchange_rate", ["exchange_momentum"]),
    ("world_bank_inflation", ["inflation_trend"]),
):
    _present = [c for c in _columns(_source) if c not in _derived] + LANDED_EXTRA
    ingest.add(
        f"dq_{SHORT[_source]}_landed", QUALITY, _unreduced(_source),
        _quality_body(
            _source, f"{SHORT[_source]}_raw", _columns(_source), _present, CHECKS_SQL[_source]
        ),
        f"WITH {SHORT[_source]}_raw AS ({RAW_SQL[_source]})",
    )


def lineitem_orphans(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Reference checks on the given tables: line items without order, part or supplier."""
    lines = table(spark, sf_dir, "lineitem")
    answer = None
    for parent, column, key in (
        ("orders", "l_orderkey", "o_orderkey"),
        ("part", "l_partkey", "p_partkey"),
        ("supplier", "l_suppkey", "s_suppkey"),
    ):
        keys = table(spark, sf_dir, parent).select(F.col(key).alias(column))
        row = count_orphans(lines, keys, [column]).select(F.lit(column).alias("column"), "violations")
        answer = row if answer is None else answer.unionByName(row)
    return answer


ingest.add(
    "reference_check_lineitem", "column violations:b", lineitem_orphans,
    " UNION ALL ".join(
        f"""SELECT '{c}' AS "column", count(*) AS violations FROM lineitem
            WHERE NOT EXISTS (SELECT 1 FROM {p} WHERE {k} = {c})"""
        for p, c, k in (
            ("orders", "l_orderkey", "o_orderkey"),
            ("part", "l_partkey", "p_partkey"),
            ("supplier", "l_suppkey", "s_suppkey"),
        )
    ),
)
