"""Bronze documents to Silver series; one plan for all sources."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.operators.series import first_per_key, newest_per_key, tie_columns
from tidemark.sources.bronze import numbered_pages
from tidemark.sources.registry import DOCUMENT, Source, get_source


def candidates(documents: DataFrame, source: Source) -> DataFrame:
    """Flat, usable rows of all documents, every fetch included."""
    return source.flatten(numbered_pages(documents)).where(source.usable())


# A later fetch wins; of fetches at the same instant, the one for the later day.
VERSION = ("fetched_at", "logical_date")


def _count_of_day(rows: DataFrame, landed: DataFrame, source: Source) -> DataFrame:
    """Add how many of `rows`, the newest of `landed` per key, share the day.

    A day can hold a third of all rows, so they are counted by a combined aggregate and the count
    (one row per calendar day) is joined back, instead of a window that gathers the day. The day of
    the newest row is the end of the greatest version, so counting reads and shuffles only the key
    and the version, not the texts.
    """
    newest = landed.groupBy(*source.key).agg(F.max(F.struct(*VERSION)).alias("version"))
    per_day = (
        newest.select("version.logical_date")
        .groupBy("logical_date")
        .agg(F.count(F.lit(1)).alias(source.rows_of_day))
    )
    return rows.join(F.broadcast(per_day), rows.logical_date.eqNullSafe(per_day.logical_date)).drop(
        per_day.logical_date
    )


def to_silver(documents: DataFrame, source_name: str) -> DataFrame:
    """Flatten, clean, keep the newest fetch per key, add the series features, fix the columns.

    `documents` are envelopes with `logical_date` as a date, as `read_bronze` returns them.
    """
    return newest_with_features(candidates(documents, get_source(source_name)), source_name)


def narrow_silver(documents: DataFrame, source_name: str, columns: Sequence[str]) -> DataFrame:
    """Some landed columns of the rows of `to_silver`, without moving those that can't decide about them.

    Equal versions are settled column by column, so of the newest row, the columns up to the last one that
    is asked for are the greatest of the newest rows cut off there.
    """
    source = get_source(source_name)
    landed = candidates(documents, source).drop("page_no", "item_no", DOCUMENT)
    ties = tie_columns(landed, source.key, VERSION)
    last = max((ties.index(c) + 1 for c in columns if c in ties), default=0)
    rows = landed.select(*source.key, *VERSION, *ties[:last])
    return newest_per_key(rows, source.key, VERSION).select(*columns)


def newest_with_features(landed: DataFrame, source_name: str) -> DataFrame:
    """Silver from candidate rows of any number of fetches."""
    source = get_source(source_name)
    landed = landed.drop("page_no", "item_no", DOCUMENT)
    rows = newest_per_key(landed, source.key, VERSION)
    if source.history:
        rows = rows.withColumns({n: make(source.history) for n, make in source.features.items()})
    if source.rows_of_day:
        rows = _count_of_day(rows, landed, source)
    return rows.select(*source.silver_schema.fieldNames())


def snapshot_silver(documents: DataFrame, source_name: str) -> DataFrame:
    """Silver rows of all pages of a single pull; of equal keys the first in the pull wins.

    One pull of rates or coins has no history, so what is derived from it stays unknown.
    """
    source = get_source(source_name)
    rows = candidates(documents, source)
    rows = first_per_key(rows.drop(DOCUMENT), source.key, ["page_no", "item_no"])
    dated = source.history is not None and source.history.time == "logical_date"
    derived = {
        name: F.lit(None).cast("double") if dated else make(source.history)
        for name, make in source.features.items()
    }
    rows = rows.withColumns(derived) if derived else rows
    if source.rows_of_day:
        rows = _count_of_day(rows, rows.withColumn("fetched_at", F.lit(0)), source)
    return rows.select(*source.silver_schema.fieldNames())
