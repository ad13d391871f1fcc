"""Lookups against a dimension: broadcast below a measured size, split by hot keys above it."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce
from operator import or_

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

BROADCAST_BYTES = 64 * 1024 * 1024
# A key is hot when it holds at least this share of the rows, so at most 1 / share keys are.
HOT_SHARE = 0.001

_HOT = "_hot"
_FIXED_WIDTH = 16


def measured_bytes(df: DataFrame) -> int:
    """Bytes of the rows as a broadcast would hold them: texts and nested values by length, the rest by
    slot."""
    width: Column = F.lit(_FIXED_WIDTH * (len(df.columns) + 1)).cast("long")
    for field in df.schema.fields:
        if isinstance(field.dataType, T.StringType):
            width = width + F.coalesce(F.octet_length(field.name), F.lit(0))
        elif isinstance(field.dataType, T.BinaryType):
            width = width + F.coalesce(F.length(field.name), F.lit(0))
        elif isinstance(field.dataType, (T.ArrayType, T.MapType, T.StructType)):
            held = F.to_json(F.struct(field.name))  # about as long as what it holds
            width = width + F.coalesce(F.octet_length(held), F.lit(0))
    return df.select(width.alias("bytes")).agg(F.sum("bytes")).first()[0] or 0


def hot_keys(rows: DataFrame, on: Sequence[str], share: float = HOT_SHARE) -> DataFrame:
    """Known keys holding at least `share` of the rows, as a local frame of at most 1 / share rows.

    Only the key columns are read, and they are counted before the shuffle.
    """
    counted = rows.groupBy(*on).agg(F.count(F.lit(1)).alias("_n"))
    least = rows.select(*on).count() * share
    found = counted.where(F.col("_n") >= least).drop("_n").na.drop().collect()
    schema = T.StructType([rows.schema[c] for c in on])
    return rows.sparkSession.createDataFrame(found, schema)


def split_join(
    facts: DataFrame,
    lookup: DataFrame,
    on: Sequence[str],
    how: str = "inner",
    share: float = HOT_SHARE,
) -> DataFrame:
    """Equi-join (inner or left) to a large lookup that is unique on `on`.

    Facts with a hot key meet the few lookup rows they need by broadcast and are not shuffled;
    unknown keys, which match nothing, go the same way; the rest is joined by shuffle.
    """
    hot = hot_keys(facts, on, share).withColumn(_HOT, F.lit(True))
    flagged = facts.join(F.broadcast(hot), list(on), "left")
    unknown = reduce(or_, (F.col(c).isNull() for c in on))
    apart = F.col(_HOT).isNotNull() | unknown
    few = lookup.join(F.broadcast(hot.drop(_HOT)), list(on), "left_semi")
    spared = flagged.where(apart).drop(_HOT).join(F.broadcast(few), list(on), how)
    shuffled = flagged.where(~apart).drop(_HOT).join(lookup, list(on), how)
    return spared.unionByName(shuffled)


def lookup_join(
    facts: DataFrame,
    lookup: DataFrame,
    on: Sequence[str],
    how: str = "inner",
    known_bytes: int | None = None,
) -> DataFrame:
    """Join facts to a stored dimension that is unique on `on`.

    Its size is measured first, unless the caller did so already.
    """
    size = measured_bytes(lookup) if known_bytes is None else known_bytes
    if size <= BROADCAST_BYTES:
        return facts.join(F.broadcast(lookup), list(on), how)
    return split_join(facts, lookup, on, how)
