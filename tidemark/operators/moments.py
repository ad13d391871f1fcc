"""Moments of groups that add up: counts, means and centred products, merged without the rows."""

from __future__ import annotations

from collections.abc import Sequence
from itertools import combinations_with_replacement

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def products(names: Sequence[str]) -> list[tuple[str, str, str]]:
    """(column, one, other) for each centred product that is kept."""
    return [(f"{a}_{b}", a, b) for a, b in combinations_with_replacement(names, 2)]


def moments(rows: DataFrame, by: Sequence[str], **values: Column) -> DataFrame:
    """One row per group: n, the mean of each value as `mean_<name>`, and the sum of each product of two
    values less their means as `<one>_<other>`. Values must be known."""
    n = F.count(F.lit(1)).cast("double")
    named = rows.select(*by, *[c.cast("double").alias(v) for v, c in values.items()])
    return named.groupBy(*by).agg(
        F.count(F.lit(1)).alias("n"),
        *[F.avg(v).alias(f"mean_{v}") for v in values],
        *[(F.covar_pop(a, b) * n).alias(c) for c, a, b in products(list(values))],
    )


def without_row(names: Sequence[str], row: dict[str, Column]) -> dict[str, Column]:
    """The moments of a group after one of its rows is taken out again; n is at least 2."""
    n = F.col("n") - 1
    means = {v: F.col(f"mean_{v}") + (F.col(f"mean_{v}") - row[v]) / n for v in names}
    left = {f"mean_{v}": mean for v, mean in means.items()}
    for column, a, b in products(names):
        left[column] = F.col(column) - (row[a] - F.col(f"mean_{a}")) * (row[b] - means[b])
    return {"n": n, **left}


def merged(groups: DataFrame, names: Sequence[str]) -> DataFrame:
    """One row: the moments of all groups together.

    The mean of all comes first; the products are then those inside the groups and those of the groups'
    own means around it, so no large numbers are subtracted from each other. Without groups n is 0.
    """
    n = F.col("n").cast("double")
    centre = groups.agg(*[F.try_divide(F.sum(n * F.col(f"mean_{v}")), F.sum(n)).alias(v) for v in names]).first()
    away = {v: F.col(f"mean_{v}") - F.lit(centre[v]).cast("double") for v in names}
    return groups.agg(
        F.coalesce(F.sum("n"), F.lit(0)).alias("n"),
        *[F.lit(centre[v]).cast("double").alias(f"mean_{v}") for v in names],
        *[F.sum(F.col(c) + n * away[a] * away[b]).alias(c) for c, a, b in products(names)],
    )
