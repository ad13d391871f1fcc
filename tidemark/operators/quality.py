"""Data-quality suites: every expectation of a suite is answered by one pass over the data."""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass, field
from functools import reduce
from operator import and_, or_

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


class ValidationFailedError(Exception):
    """A dataset broke at least one expectation of its suite."""


@dataclass(frozen=True)
class Expectation:
    kind: str
    columns: tuple[str, ...]
    low: float | None = None
    high: float | None = None
    above_low: bool = False

    def breach(self) -> Column:
        """True for a row that violates a row-level expectation; unknown values never do."""
        column = F.col(self.columns[0])
        if self.kind == "not_null":
            return column.isNull()
        bounds = []
        if self.low is not None:
            bounds.append(column <= self.low if self.above_low else column < self.low)
        if self.high is not None:
            bounds.append(column > self.high)
        return reduce(or_, bounds)


def same_columns(*columns: str) -> Expectation:
    return Expectation("columns_match", columns)


def not_null(column: str) -> Expectation:
    return Expectation("not_null", (column,))


def unique(*columns: str) -> Expectation:
    return Expectation("unique" if len(columns) == 1 else "compound_unique", columns)


def between(column: str, low=None, high=None, above_low: bool = False) -> Expectation:
    return Expectation("between", (column,), low, high, above_low)


@dataclass(frozen=True)
class Outcome:
    asset: str
    success: bool
    failed: list[str] = field(default_factory=list)
    total: int = 0


def _grouped_counts(df: DataFrame, key: Sequence[str], breaches: dict[str, Column]) -> DataFrame:
    """Totals of every breach plus the rows that share their key, in one scan and one shuffle.

    The counts are combined before the shuffle, so a key with a third of all rows is one row per task.
    """
    partial = [F.sum(F.when(b, 1).otherwise(0)).alias(n) for n, b in breaches.items()]
    grouped = df.groupBy(*key).agg(F.count(F.lit(1)).alias("_rows"), *partial)
    known = reduce(or_, (F.col(c).isNotNull() for c in key))
    repeated = F.sum(F.when((F.col("_rows") > 1) & known, F.col("_rows")).otherwise(0))
    return grouped.agg(repeated.alias("_repeated"), *[F.sum(n).alias(n) for n in breaches])


def evaluate(df: DataFrame, suite: Sequence[Expectation], asset: str) -> DataFrame:
    """One row per expectation: asset, expectation, columns, violations, success.

    An expectation on a column the dataset lacks fails with unknown violations.
    """
    present = set(df.columns)
    row_level = {
        f"e{i}": e.breach()
        for i, e in enumerate(suite)
        if e.kind in ("not_null", "between") and present.issuperset(e.columns)
    }
    keys = [e.columns for e in suite if "unique" in e.kind and present.issuperset(e.columns)]
    if keys:
        measured = _grouped_counts(df, keys[0], row_level)
        for other in keys[1:]:
            extra = _grouped_counts(df, other, {}).scalar()
            measured = measured.withColumn("_repeated_" + "_".join(other), extra)
    else:
        totals = [F.sum(F.when(b, 1).otherwise(0)).alias(n) for n, b in row_level.items()]
        measured = df.agg(F.count(F.lit(1)).alias("_rows"), *totals)

    def violations(position: int, expectation: Expectation) -> Column:
        if expectation.kind == "columns_match":
            return F.lit(len(present.symmetric_difference(expectation.columns)))
        if not present.issuperset(expectation.columns):
            return F.lit(None)
        if "unique" in expectation.kind:
            first = expectation.columns == keys[0]
            return F.col("_repeated" if first else "_repeated_" + "_".join(expectation.columns))
        return F.col(f"e{position}")

    answers = []
    for i, expectation in enumerate(suite):
        # An empty dataset sums to null and violates nothing.
        count = violations(i, expectation)
        known = expectation.kind == "columns_match" or present.issuperset(expectation.columns)
        count = F.coalesce(count.cast("long"), F.lit(0)) if known else count.cast("long")
        answers.append(
            F.struct(
                F.lit(i).alias("position"),
                F.lit(expectation.kind).alias("expectation"),
                F.lit(",".join(expectation.columns)).alias("columns"),
                count.alias("violations"),
                F.coalesce(count == 0, F.lit(False)).alias("success"),
            )
        )
    return measured.select(F.lit(asset).alias("asset"), F.inline(F.array(*answers)))


def validate(df: DataFrame, suite: Sequence[Expectation], asset: str) -> Outcome:
    """Summary of `evaluate`; only one row per expectation reaches the driver."""
    rows = sorted(evaluate(df, suite, asset).collect(), key=lambda r: r["position"])
    failed = [r["expectation"] for r in rows if not r["success"]]
    return Outcome(asset, not failed, failed, len(rows))


def validate_or_raise(df: DataFrame, suite: Sequence[Expectation], asset: str) -> Outcome:
    outcome = validate(df, suite, asset)
    if not outcome.success:
        raise ValidationFailedError(f"{asset} broke {outcome.failed}")
    return outcome


def orphan_keys(facts: DataFrame, dimension: DataFrame, on: Sequence[str]) -> DataFrame:
    """Known keys without a dimension member, and how many facts carry each (`rows`).

    Facts are counted per key before the join, so a key with most of the facts is joined once.
    """
    known = reduce(and_, (F.col(c).isNotNull() for c in on))
    counted = facts.where(known).groupBy(*on).agg(F.count(F.lit(1)).alias("rows"))
    return counted.join(dimension.select(*on), list(on), "left_anti")


def count_orphans(facts: DataFrame, dimension: DataFrame, on: Sequence[str]) -> DataFrame:
    """One row: `violations`, the number of facts whose known key has no dimension member."""
    lost = orphan_keys(facts, dimension, on)
    return lost.agg(F.coalesce(F.sum("rows"), F.lit(0)).alias("violations"))
