"""Payload pages for tests."""

# Pages and their rows; fields that a builder doesn't name are absent.


def annual(iso3, year, value, indicator="IND.A", name=None):
    land = {"id": iso3, "value": name or f"Land of {iso3}"}
    return {
        "value": value, "date": year, "countryiso3code": iso3, "country": land,
        "indicator": {"id": indicator, "value": indicator.lower()},
    }


def annual_page(*records, pages=1):
    meta = dict.fromkeys(("page", "per_page", "total"), 1) | {"pages": pages}
    return {"meta": meta, "records": list(records)}


def rates_page(base, **rates):
    return {"rates": rates, "base_code": base, "result": "success"}


def weather_page(days, rain, at=(1.5, -2.5), **others):
    """Daily readings of a place; `others` are further daily series by name."""
    return {"latitude": at[0], "longitude": at[1], "daily": {"time": days, "precipitation_sum": rain, **others}}


def coin(coin_id, price, change=None):
    names = {"id": coin_id, "symbol": f"${coin_id}", "name": f"The {coin_id}"}
    return names | {"current_price": price, "price_change_percentage_24h": change}


def article(url, title, at="2031-03-05T06:07:08Z"):
    return {"title": title, "url": url, "publishedAt": at, "source": {"name": "Gazette"}}


def news_page(*articles, total=None):
    made = {"status": "ok", "totalResults": len(articles) if total is None else total}
    return made | {"articles": list(articles)}
