"""Payload contracts: raw JSON text to typed pages, with every breach named.

Numbers are read as text first and then converted, so a quoted number is accepted and a word is
reported instead of silently becoming null.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, Observation
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidemark.session import scratch_path
from tidemark.sources import schemas
from tidemark.sources.extras import unmodelled
from tidemark.sources.registry import get_source
from tidemark.sources.storage import delete

# Fields a payload must carry; `[]` stands for every element of an array.
ANNUAL_REQUIRED = (
    "meta", "meta.page", "meta.pages", "meta.per_page", "meta.total", "records",
    "records[]", "records[].indicator", "records[].indicator.id", "records[].indicator.value",
    "records[].country", "records[].country.id", "records[].country.value",
    "records[].countryiso3code", "records[].date",
)
REQUIRED = {
    "world_bank": ANNUAL_REQUIRED,
    "world_bank_inflation": ANNUAL_REQUIRED,
    "exchange_rate": ("result", "base_code", "rates", "rates{}"),
    "open_meteo": (
        "latitude", "longitude", "daily", "daily.time", "daily.time[]",
        "daily.temperature_2m_max[]", "daily.temperature_2m_min[]", "daily.precipitation_sum[]",
    ),
    "coingecko": ("coins", "coins[]", "coins[].id", "coins[].symbol", "coins[].name"),
    "newsapi": (
        "status", "totalResults", "articles", "articles[]", "articles[].source",
        "articles[].source.name", "articles[].title", "articles[].url", "articles[].publishedAt",
    ),
}
# What an absent optional field is filled with.
ANNUAL_DEFAULTS = {"records[].unit": "", "records[].obs_status": "", "records[].decimal": 0}
DEFAULTS = {"world_bank": ANNUAL_DEFAULTS, "world_bank_inflation": ANNUAL_DEFAULTS}

NOT_JSON = "payload: not a JSON document of the expected shape"

BROKEN = "_broken"

Check = tuple[str, Callable[[Column], Column]]


class ContractError(ValueError):
    """At least one payload breaks the contract of its source."""


def _as_text(dtype: T.DataType) -> T.DataType:
    """The same shape with every number as text."""
    if isinstance(dtype, T.StructType):
        return T.StructType([T.StructField(f.name, _as_text(f.dataType)) for f in dtype.fields])
    if isinstance(dtype, T.ArrayType):
        return T.ArrayType(_as_text(dtype.elementType))
    if isinstance(dtype, T.MapType):
        return T.MapType(T.StringType(), _as_text(dtype.valueType))
    return T.StringType()


def _number_breach(dtype: T.DataType) -> Callable[[Column], Column]:
    def breach(value: Column) -> Column:
        number = value.try_cast("double")
        fits = number.isNotNull()
        if isinstance(dtype, T.IntegerType):
            fits = fits & (number == F.floor(number))
        return value.isNotNull() & ~F.coalesce(fits, F.lit(False))

    return breach


def _in_field(name: str, wrong: Callable[[Column], Column]) -> Callable[[Column], Column]:
    return lambda v: v.isNotNull() & wrong(v[name])


def _in_array(wrong: Callable[[Column], Column]) -> Callable[[Column], Column]:
    return lambda v: F.exists(v, wrong)


def _in_map(wrong: Callable[[Column], Column]) -> Callable[[Column], Column]:
    return lambda v: F.exists(F.map_values(v), wrong)


def _checks(dtype: T.DataType, path: str, required: frozenset[str]) -> list[Check]:
    """Label and condition of everything that can be wrong with a value at `path`."""
    found: list[Check] = []
    if path in required:
        found.append((f"{path}: missing", lambda v: v.isNull()))
    if isinstance(dtype, T.StructType):
        for f in dtype.fields:
            inner = f"{path}.{f.name}" if path else f.name
            checks = _checks(f.dataType, inner, required)
            found += [(label, _in_field(f.name, wrong)) for label, wrong in checks]
    elif isinstance(dtype, T.ArrayType):
        checks = _checks(dtype.elementType, f"{path}[]", required)
        found += [(label, _in_array(wrong)) for label, wrong in checks]
    elif isinstance(dtype, T.MapType):
        checks = _checks(dtype.valueType, f"{path}{{}}", required)
        found += [(label, _in_map(wrong)) for label, wrong in checks]
    elif not isinstance(dtype, T.StringType):
        found.append((f"{path}: not a number", _number_breach(dtype)))
    return found


def _typed(value: Column, dtype: T.DataType, path: str, defaults: dict) -> Column:
    """Convert a text-only value to its modelled type."""
    if isinstance(dtype, T.StructType):
        fields = [
            _typed(value[f.name], f.dataType, f"{path}.{f.name}" if path else f.name, defaults)
            .alias(f.name)
            for f in dtype.fields
        ]
        return F.when(value.isNotNull(), F.struct(*fields))
    if isinstance(dtype, T.ArrayType):
        return F.transform(value, lambda e: _typed(e, dtype.elementType, f"{path}[]", defaults))
    if isinstance(dtype, T.MapType):
        return F.transform_values(value, lambda _, v: _typed(v, dtype.valueType, path, defaults))
    if isinstance(dtype, T.IntegerType):
        value = value.try_cast("double").try_cast("int")
    elif not isinstance(dtype, T.StringType):
        value = value.try_cast(dtype)
    return F.coalesce(value, F.lit(defaults[path])) if path in defaults else value


def _as_object(raw: Column, source: str) -> Column:
    """Raw text as the text of one object; the bare lists some feeds answer with get field names."""
    if source in ("world_bank", "world_bank_inflation"):
        parts = F.from_json(raw, "array<string>")
        records = F.coalesce(F.get(parts, F.lit(1)), F.lit("[]"))
        pair = F.concat(
            F.lit('{"meta":'), F.get(parts, F.lit(0)), F.lit(',"records":'), records, F.lit("}")
        )
        return F.when(raw.rlike(r"^\s*\[") & (F.size(parts) == 2), pair).otherwise(raw)
    if source == "coingecko":
        listed = F.concat(F.lit('{"coins":'), raw, F.lit("}"))
        return F.when(raw.rlike(r"^\s*\["), listed).otherwise(raw)
    return raw


def check_payloads(payloads: DataFrame, source: str, raw: str = "payload") -> DataFrame:
    """Add `page` (typed, modelled fields only) and `problems` (empty for a valid payload).

    For a feed that keeps them, `extra` has the unmodelled fields as VARIANT.
    """
    get_source(source)
    dtype = schemas.struct(schemas.PAGES[source])
    # The parser leaves the text of a payload it cannot read in the extra field.
    shape = T.StructType([*_as_text(dtype).fields, T.StructField(BROKEN, T.StringType())])
    text = _as_object(F.col(raw), source)
    parsed = payloads.withColumn(
        "_text", F.from_json(text, shape, {"columnNameOfCorruptRecord": BROKEN})
    )
    value = F.col("_text")
    labels = [
        F.when(F.coalesce(wrong(value), F.lit(False)), F.lit(label))
        for label, wrong in _checks(dtype, "", frozenset(REQUIRED[source]))
    ]
    unreadable = value.isNull() | value[BROKEN].isNotNull()
    problems = F.when(unreadable, F.array(F.lit(NOT_JSON))).otherwise(
        F.array_compact(F.array(*labels))
    )
    added = {"page": _typed(value, dtype, "", DEFAULTS.get(source, {})), "problems": problems}
    if source in schemas.KEEPS_EXTRAS:
        added["extra"] = unmodelled(text, dtype)
    return parsed.withColumns(added).drop("_text")


def split_payloads(
    payloads: DataFrame, source: str, raw: str = "payload"
) -> tuple[DataFrame, DataFrame]:
    """(valid pages, quarantine). The quarantine keeps the raw text and says what is wrong."""
    checked = check_payloads(payloads, source, raw)
    valid = checked.where(F.size("problems") == 0).drop("problems", raw)
    quarantine = checked.where(F.size("problems") > 0).drop("page")
    return valid, quarantine


def _labels(source: str) -> list[str]:
    """Every kind of breach that a payload of the source can have."""
    dtype = schemas.struct(schemas.PAGES[source])
    return [NOT_JSON, *[label for label, _ in _checks(dtype, "", frozenset(REQUIRED[source]))]]


def observe_breaches(checked: DataFrame, source: str) -> tuple[DataFrame, Observation]:
    """The rows of `check_payloads`, counted while they are written or read.

    The counts are exact for rows that go straight to a file or the driver: of a task that runs twice
    one result counts.
    """
    counts = [
        F.count_if(F.array_contains("problems", label)).alias(f"p{i}") for i, label in enumerate(_labels(source))
    ]
    seen = Observation()
    return checked.observe(seen, F.count(F.lit(1)).alias("pages"), *counts), seen


def raise_on_breaches(seen: Observation, source: str) -> int:
    """The number of observed pages; an error that names each kind of breach if there is one."""
    counts = seen.get
    found = {label: counts.get(f"p{i}", 0) for i, label in enumerate(_labels(source))}
    detail = ", ".join(f"{label} ({n})" for label, n in sorted(found.items()) if n)
    if detail:
        raise ContractError(f"{source}: {detail}")
    return counts.get("pages", 0)


def require_valid(payloads: DataFrame, source: str, raw: str = "payload") -> DataFrame:
    """Valid pages, or an error naming each kind of breach and how often it occurs.

    Payloads are parsed once: the pages are staged in the shared folder while breaches are counted.
    """
    pages, _ = staged_valid(payloads, source, raw)
    return pages


def staged_valid(payloads: DataFrame, source: str, raw: str = "payload") -> tuple[DataFrame, int]:
    """`require_valid`, and how many pages there are."""
    spark = payloads.sparkSession
    checked, seen = observe_breaches(check_payloads(payloads, source, raw).drop(raw), source)
    path = scratch_path(spark, f"{source}-pages")
    checked.write.parquet(path)
    try:
        count = raise_on_breaches(seen, source)
    except ContractError:
        delete(spark, path)
        raise
    return spark.read.schema(checked.schema).parquet(path).drop("problems"), count
