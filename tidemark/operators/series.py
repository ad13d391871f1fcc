"""Time-series operators: one row per key, then features along each entity's history.

The order of the two steps is what keeps them safe under skew. `newest_per_key` is a top-1 per
key, which Spark plans with a limit before and after the shuffle, so a key holding a third of all
rows leaves each task as a single row. What remains has one row per (entity, point in time), so the
history of one entity is no longer than the calendar and a window over it fits one task.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tidemark.functions import change, growth

_RANK = "_rank"


def _first_per_key(df: DataFrame, keys: Sequence[str], order: Sequence[Column]) -> DataFrame:
    ranked = df.withColumn(_RANK, F.row_number().over(Window.partitionBy(*keys).orderBy(*order)))
    return ranked.where(F.col(_RANK) == 1).drop(_RANK)


def tie_columns(df: DataFrame, keys: Sequence[str], version: Sequence[str]) -> list[str]:
    """The columns that settle equal versions, in order."""
    return [c for c in df.columns if c not in keys and c not in version]


def newest_per_key(df: DataFrame, keys: Sequence[str], version: Sequence[str]) -> DataFrame:
    """One row per key: the one with the greatest `version` columns.

    Equal versions are settled by the remaining columns in order, so that the result does not
    depend on the layout of the input.
    """
    ties = tie_columns(df, keys, version)
    return _first_per_key(df, keys, [F.col(c).desc_nulls_last() for c in [*version, *ties]])


def first_per_key(df: DataFrame, keys: Sequence[str], position: Sequence[str]) -> DataFrame:
    """One row per key: the one that comes first by `position`."""
    return _first_per_key(df, keys, [F.col(c).asc_nulls_last() for c in position])


def last_per_entity(df: DataFrame, entity: Sequence[str], time: Sequence[str]) -> DataFrame:
    """The latest row of every entity."""
    return _first_per_key(df, entity, [F.col(c).desc_nulls_last() for c in time])


@dataclass(frozen=True)
class History:
    """Features along the history of an entity. Frames count rows; gaps are not filled."""

    entity: tuple[str, ...]
    time: str

    def _window(self):
        return Window.partitionBy(*self.entity).orderBy(F.col(self.time).asc_nulls_last())

    def _trailing(self, rows: int, include_current: bool):
        last = 0 if include_current else -1
        return self._window().rowsBetween(last + 1 - rows, last)

    def previous(self, column: str, steps: int = 1) -> Column:
        return F.lag(column, steps).over(self._window())

    def growth(self, column: str) -> Column:
        return growth(F.col(column), self.previous(column))

    def change(self, column: str) -> Column:
        return change(F.col(column), self.previous(column))

    def mean(self, column: str, rows: int, include_current: bool = True) -> Column:
        return F.avg(column).over(self._trailing(rows, include_current))

    def spread(self, column: str, rows: int) -> Column:
        """Sample standard deviation; null for a single value."""
        return F.stddev_samp(column).over(self._trailing(rows, True))


def split_holdout(
    df: DataFrame, entity: Sequence[str], time: Sequence[str], flag: str = "is_holdout"
) -> DataFrame:
    """Mark the latest row of every entity as holdout; the rest is for training."""
    newest = Window.partitionBy(*entity).orderBy(*[F.col(c).desc_nulls_last() for c in time])
    return df.withColumn(flag, F.row_number().over(newest) == 1)
