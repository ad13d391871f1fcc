"""Silver of made-up pulls, compared with the same rules written out in plain Python."""

import random
import statistics
from datetime import date, datetime, timedelta

import pytest

from payloads import annual, annual_page, article, coin, news_page, rates_page, weather_page
from tidemark.plans.silver import narrow_silver, snapshot_silver, to_silver
from tidemark.sources.bronze import envelopes, numbered_pages
from tidemark.sources.registry import SOURCE_NAMES, UnknownSourceError, get_source

START = date(2031, 3, 1)


def pulls(seed, page_of, count=14):
    """(day, hour, page, ...): pulls at different instants, some days with several, in random order."""
    pick, out = random.Random(seed), []
    for n in range(count):
        day = START + timedelta(days=pick.randrange(6))
        out.append((str(day), n, *[page_of(pick, day) for _ in range(pick.randrange(1, 4))]))
    return out


def newest(landed, entries, key):
    """The entry of the latest fetch per key; entries(page) gives dicts, in the order of the payload."""
    found = {}
    for day, hour, *pages in landed:
        for page in pages:
            for entry in entries(page):
                entry = entry | {"day": date.fromisoformat(day), "version": (f"{day}T{hour:02d}", day)}
                old = found.get(key(entry))
                if old is None or entry["version"] > old["version"]:
                    found[key(entry)] = entry
    return found


def before(found, key, part):
    """The entry of the same history that comes before."""
    earlier = [k for k in found if all(a == b for i, (a, b) in enumerate(zip(k, key)) if i != part) and k[part] < key[part]]
    return found[max(earlier, key=lambda k: k[part])] if earlier else None


def near(value):
    return None if value is None else pytest.approx(value)


@pytest.mark.parametrize("source, measure, derived", [
    ("world_bank", "gdp_usd", "gdp_growth_rate"), ("world_bank_inflation", "inflation_pct", "inflation_trend")])
def test_annual_feeds(documents, source, measure, derived):
    def page_of(pick, day):
        # One value per pull and key, so that only fetches compete.
        return annual_page(*[
            annual(pick.choice(["", None, "AAA", "BBB"]), pick.choice(["2019", "2020", "2022", "x", None]),
                   pick.choice([None, 0.0, 4.0, 9.0]), pick.choice(["P", "Q"]))
            for _ in range(1)])

    landed = [(day, hour, pages[0]) for day, hour, *pages in pulls(source, page_of, 40)]
    landed = [(day, n, page) for n, (day, _, page) in enumerate(landed[:24])]
    usable = lambda page: [r for r in page["records"] if r["countryiso3code"] and (r["date"] or "").isdigit()]
    key = lambda r: (r["countryiso3code"], r["indicator"]["id"], int(r["date"]))
    found = newest(landed, usable, key)
    got = {(r["country_iso3"], r["indicator_id"], r["year"]): r for r in to_silver(documents(source, *landed), source).collect()}
    assert set(got) == set(found) and len(found) >= 4
    for k, entry in found.items():
        old, own = before(found, k, 2), entry["value"]
        last = old and old["value"]
        if derived == "inflation_trend":
            wanted = None if own is None or last is None else own - last
        else:
            wanted = None if own is None or not last else (own - last) / last
        assert (got[k][measure], got[k]["logical_date"]) == (own, entry["day"])
        assert got[k][derived] == near(wanted)


def test_rates(documents):
    def page_of(pick, day):
        return rates_page(pick.choice(["XAU", "XAG"]), **{c: pick.choice([None, -1.0, 0.0, 2.0, 2.5]) for c in ("ABC", "DEF")})

    landed = [(day, hour, pages[0]) for day, hour, *pages in pulls(5, page_of, 20)]
    entries = lambda p: [{"base": p["base_code"], "code": c, "rate": v} for c, v in p["rates"].items() if v and v > 0]
    found = {}
    for day, hour, page in sorted(landed, key=lambda x: (x[0], x[1])):
        for e in entries(page):
            found[e["base"], e["code"], date.fromisoformat(day)] = e
    got = {(r["base_code"], r["currency"], r["logical_date"]): r
           for r in to_silver(documents("exchange_rate", *landed), "exchange_rate").collect()}
    assert set(got) == set(found)
    for k, entry in found.items():
        old = before(found, k, 2)
        assert got[k]["rate"] == entry["rate"]
        assert got[k]["exchange_momentum"] == near(old and (entry["rate"] - old["rate"]) / old["rate"])


def test_weather(documents):
    def page_of(pick, day):
        days = [str(day + timedelta(days=d)) for d in range(-2, pick.randrange(1, 3))] + ["no day"]
        rain = [float(pick.randrange(9)) for _ in days[: pick.randrange(1, 5)]]
        return weather_page(days, rain, pick.choice([(0.5, 9.5), (7.5, 9.5)]), temperature_2m_max=[21.5] * len(days))

    landed = [(day, hour, pages[0]) for day, hour, *pages in pulls(6, page_of)]

    def entries(page):
        daily = page["daily"]
        for i, day in enumerate(daily["time"][:-1]):
            rain = daily["precipitation_sum"]
            yield {"at": page["latitude"], "date": date.fromisoformat(day), "rain": rain[i] if i < len(rain) else None}

    found = newest(landed, entries, lambda e: (e["at"], e["date"]))
    got = {(r["latitude"], r["date"]): r for r in to_silver(documents("open_meteo", *landed), "open_meteo").collect()}
    assert set(got) == set(found)
    for (at, day), entry in found.items():
        so_far = [e["rain"] for (a, d), e in found.items() if a == at and d <= day and e["rain"] is not None]
        mean = statistics.fmean(so_far) if so_far else None
        row = got[at, day]
        assert (row["precipitation_mm"], row["temp_max_c"], row["temp_min_c"]) == (entry["rain"], 21.5, None)
        assert row["precip_30d_avg_mm"] == near(mean)
        assert row["rainfall_anomaly_mm"] == near(None if mean is None or entry["rain"] is None else entry["rain"] - mean)


def test_coins(documents):
    def page_of(pick, day):
        return {"coins": [coin(pick.choice([None, "aa", "bb"]), pick.choice([None, 3.0, 4.0]), float(pick.randrange(-5, 9)))]}

    landed = [(str(START + timedelta(days=n // 2)), n, page_of(random.Random(n), None)) for n in range(24)]
    usable = lambda page: [c for c in page["coins"] if c["id"] and c["current_price"] is not None]
    found = newest(landed, usable, lambda c: (c["id"], c["day"]) if "day" in c else None)
    got = {(r["coin_id"], r["logical_date"]): r for r in to_silver(documents("coingecko", *landed), "coingecko").collect()}
    assert set(got) == set(found) and len(found) >= 8
    for (name, day), entry in found.items():
        seven = [found[k]["price_change_percentage_24h"] for k in sorted(found) if k[0] == name and k[1] <= day][-7:]
        assert (got[name, day]["price_usd"], got[name, day]["symbol"]) == (entry["current_price"], f"${name}")
        assert got[name, day]["volatility_7d"] == near(statistics.stdev(seven) if len(seven) > 1 else None)


def test_news(documents):
    def page_of(pick, day):
        return news_page(article(f"n/{pick.randrange(9)}", pick.choice([None, "one", "two"]), f"{day}T10:11:12Z"))

    landed = [(day, hour, pages[0]) for day, hour, *pages in pulls(7, page_of, 20)]
    found = newest(landed, lambda p: [a for a in p["articles"] if a["title"]], lambda a: a["url"])
    got = {r["url"]: r for r in to_silver(documents("newsapi", *landed), "newsapi").collect()}
    assert set(got) == set(found)
    for url, entry in found.items():
        assert got[url]["title"] == entry["title"] and got[url]["logical_date"] == entry["day"]
        assert got[url]["published_at"] == datetime.fromisoformat(entry["publishedAt"].rstrip("Z"))
        assert got[url]["articles_that_day"] == sum(e["day"] == entry["day"] for e in found.values())


def test_snapshot_uses_every_page_and_its_first_rows(documents):
    pages = [annual_page(annual("AAA", f"{2000 + n % 5}", float(n)), annual("BBB", "2001", -float(n))) for n in range(12)]
    got = snapshot_silver(documents("world_bank", (str(START), 1, *pages)), "world_bank").collect()
    assert {(r["country_iso3"], r["year"]): r["gdp_usd"] for r in got} == {
        ("BBB", 2001): 0.0, **{("AAA", 2000 + n): float(n) for n in range(5)}}
    rates = documents("exchange_rate", (str(START), 1, rates_page("XAU", ABC=2.0), rates_page("XAG", ABC=3.0)))
    assert {(r["base_code"], r["exchange_momentum"]) for r in snapshot_silver(rates, "exchange_rate").collect()} == {
        ("XAU", None), ("XAG", None)}
    news = documents("newsapi", (str(START), 1, news_page(article("n/1", "x")), news_page(article("n/2", "y"), article("n/1", "z"))))
    assert {(r["url"], r["title"], r["articles_that_day"]) for r in snapshot_silver(news, "newsapi").collect()} == {
        ("n/1", "x", 2), ("n/2", "y", 2)}


def test_parts_of_a_pull_are_one_pull(documents):
    docs = documents("coingecko", (str(START), 1, *[{"coins": [coin(f"c{n}", float(n))]} for n in range(11)]))
    whole = numbered_pages(docs)
    from pyspark.sql import functions as F

    parts = envelopes(whole.withColumn("source", F.lit("coingecko")), per_envelope=4)
    assert sorted((r["page_count"], len(r["pages"])) for r in parts.collect()) == [(11, 3), (11, 4), (11, 4)]
    again = {r["page_no"]: r["page"]["coins"][0]["id"] for r in numbered_pages(parts).collect()}
    assert again == {n: f"c{n}" for n in range(11)}


@pytest.mark.parametrize("source", SOURCE_NAMES)
def test_contract_holds_for_documents_without_rows(documents, source):
    got = to_silver(documents(source, (str(START), 1)), source)
    assert got.collect() == []
    assert [(f.name, f.dataType) for f in got.schema] == [(f.name, f.dataType) for f in get_source(source).silver_schema]


def test_unknown_source_names_the_known():
    with pytest.raises(UnknownSourceError, match="open_meteo"):
        get_source("nope")


def test_narrow_rows_are_those_of_the_whole_ones(spark, documents):
    """Ties included; the titles aren't part of the plan's shuffles."""
    def named(url, title, name):
        return article(url, title) | {"source": {"name": name}}

    landed = documents(
        "newsapi",
        ("2031-03-01", 1, news_page(named("u1", "a", "Old"), named("u2", "z", None), named("u3", "t", "Gone"))),
        ("2031-03-02", 1, news_page(named("u1", "a", "Post"), named("u1", "z", "Gazette"), named("u3", "t", None))),
        ("2031-03-02", 1, news_page(named("u2", "a", None), named("u2", "b", "Herald"), named(None, "b", "Lost"))),
    )
    columns = ["source_name", "logical_date"]
    narrow = narrow_silver(landed, "newsapi", columns)
    whole = to_silver(landed, "newsapi").select(*columns)
    assert sorted(map(str, narrow.collect())) == sorted(map(str, whole.collect()))
    assert narrow.distinct().count() == 3
    plan = narrow._jdf.queryExecution().optimizedPlan().toString()
    assert not any("title" in line for line in plan.splitlines() if "Window" in line)
