"""Set-based writes: insert-if-absent, upsert, surrogate keys."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

# At least so many hash buckets; more where shuffles are wider.
LEAST_BUCKETS = 256


def absent(incoming: DataFrame, existing: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Rows of `incoming` whose key is not in `existing`."""
    return incoming.join(existing.select(*keys), list(keys), "left_anti")


def insert_if_absent(existing: DataFrame, incoming: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Existing rows stay as they are; only unseen keys are added."""
    return existing.unionByName(absent(incoming, existing, keys))


def upsert(existing: DataFrame, incoming: DataFrame, keys: Sequence[str]) -> DataFrame:
    """The incoming row replaces the existing one as a whole, nulls included."""
    return absent(existing, incoming, keys).unionByName(incoming)


def number_members(
    members: DataFrame,
    natural_key: Sequence[str],
    key_column: str,
    after: int = 0,
    buckets: int | None = None,
) -> DataFrame:
    """Give every member a dense integer key starting at `after + 1`.

    Members are unique on the natural key. They are numbered inside hash buckets of that key and
    shifted by the number of members in the buckets before, so no task sees all members and a
    repeated task assigns the same numbers.
    """
    if buckets is None:
        width = int(members.sparkSession.conf.get("spark.sql.shuffle.partitions"))
        buckets = max(LEAST_BUCKETS, 4 * width)
    bucketed = members.withColumn(
        "_bucket", F.pmod(F.xxhash64(*natural_key), F.lit(buckets)).cast("int")
    )
    # At most `buckets` rows from here to the join, so one task and a broadcast are bounded.
    before = Window.orderBy("_bucket").rowsBetween(Window.unboundedPreceding, -1)
    shifts = (
        bucketed.groupBy("_bucket")
        .agg(F.count(F.lit(1)).alias("_n"))
        .select("_bucket", F.coalesce(F.sum("_n").over(before), F.lit(0)).alias("_shift"))
    )
    place = F.row_number().over(Window.partitionBy("_bucket").orderBy(*natural_key))
    return (
        bucketed.withColumn("_place", place)
        .join(F.broadcast(shifts), "_bucket")
        .withColumn(key_column, (F.lit(after) + F.col("_shift") + F.col("_place")).cast("int"))
        .drop("_bucket", "_place", "_shift")
    )
