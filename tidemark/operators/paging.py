"""Parameterised filters and pages over a view."""

from __future__ import annotations

from collections.abc import Callable, Sequence
from dataclasses import dataclass, replace
from typing import Any

from pyspark.sql import Column, DataFrame, Observation, Row
from pyspark.sql import functions as F

DEFAULT_LIMIT = 50
MAX_LIMIT = 500
# From this offset on a page is looked for by ranges. What a range may hold, how many there are, and the
# rows that their bounds are taken from.
DEEP_OFFSET = 10_000
RANGE_ROWS, RANGES, SAMPLE_ROWS = 50_000, 32, 2_000


def given(value: Any) -> bool:
    """A parameter the caller filled in; None and the empty string mean 'no filter'."""
    return value is not None and value != ""


def narrow(df: DataFrame, *choices: tuple[Any, Callable[[Any], Column]]) -> DataFrame:
    """Keep rows that satisfy the condition of every given parameter."""
    for value, condition in choices:
        if given(value):
            df = df.where(condition(value))
    return df


def ordering(spec: Sequence[str]) -> list[Column]:
    """'-year' is newest first, 'year' oldest first; unknown values come last both ways."""
    return [
        F.col(c[1:]).desc_nulls_last() if c.startswith("-") else F.col(c).asc_nulls_last()
        for c in spec
    ]


def _before(order: Sequence[str], row: Row) -> Column:
    """Whether a row comes strictly before another in an order; unknown values are last both ways."""
    found, same = F.lit(False), F.lit(True)
    for spec in order:
        name = spec.lstrip("-")
        value, bound = F.col(name), row[name]
        if bound is None:
            first = value.isNotNull()
        else:
            known = value > F.lit(bound) if spec.startswith("-") else value < F.lit(bound)
            first = F.coalesce(known, F.lit(False))
        found = found | (same & first)
        same = same & value.eqNullSafe(F.lit(bound))
    return found


def _splitters(rows: DataFrame, order: Sequence[str], count: int) -> tuple[list[Row], int]:
    """Up to `count` rows' keys that cut the rows in ranges of about the same size, and how many rows there
    are; both from one pass, in which a task holds a bounded sample."""
    seen = Observation()
    keys = rows.select(*[c.lstrip("-") for c in order])
    picked = keys.observe(seen, F.count(F.lit(1)).alias("n")).orderBy(F.rand(17)).limit(SAMPLE_ROWS)
    found = picked.collect()
    if not found:
        return [], 0  # nothing is observed where no row comes by
    sample = rows.sparkSession.createDataFrame(found, keys.schema).distinct().orderBy(*ordering(order)).collect()
    step = max(1, len(sample) // (count + 1))
    return sample[step::step][:count], seen.get["n"]


def narrowed_to_page(rows: DataFrame, order: Sequence[str], offset: int, limit: int) -> tuple[DataFrame, int, int]:
    """(rows, offset, total): the rows that a page deep inside an order can be on, and where it is in them.

    Sampled keys split the rows into ranges, which are counted exactly; only the ranges that the page
    reaches into are kept, and split again while they are large. So no task sorts or holds the rows before
    the page. Keys that all are equal can't be split and are left to the sort.
    """
    size = total = None
    while size is None or size > RANGE_ROWS:
        splitters, found = _splitters(rows, order, RANGES - 1)
        total = found if total is None else total
        if found <= RANGE_ROWS or not splitters or offset >= found:
            break
        before = [_before(order, s).cast("int") for s in splitters]
        place = F.lit(len(splitters)) - sum(before[1:], before[0])
        counts = {r["place"]: r["count"] for r in rows.groupBy(place.alias("place")).count().collect()}
        passed, kept, held = 0, [], 0
        for number in range(len(splitters) + 1):
            here = counts.get(number, 0)
            if passed + here <= offset:
                passed += here
            elif passed + held < offset + limit:
                kept.append(number)
                held += here
        if held == found:
            break
        low, high = kept[0], kept[-1]
        if low > 0:
            rows = rows.where(~_before(order, splitters[low - 1]))
        if high < len(splitters):
            rows = rows.where(_before(order, splitters[high]))
        offset, size = offset - passed, held
    return rows, offset, total


@dataclass(frozen=True)
class Page:
    """One page of a filtered, ordered result together with the size of the whole result.

    A page that begins within the first `deep` rows is a top-k; beyond, it is looked for by counting ranges.
    """

    matches: DataFrame
    order: tuple[str, ...]
    limit: int = DEFAULT_LIMIT
    offset: int = 0
    deep: int = DEEP_OFFSET

    def __post_init__(self) -> None:
        if not 1 <= self.limit <= MAX_LIMIT:
            raise ValueError(f"limit must be between 1 and {MAX_LIMIT}")
        if self.offset < 0:
            raise ValueError("offset must not be negative")

    @property
    def items(self) -> DataFrame:
        return self.matches.orderBy(*ordering(self.order)).offset(self.offset).limit(self.limit)

    def narrowed(self, *choices: tuple[Any, Callable[[Any], Column]]) -> Page:
        """The first page after further filters were set."""
        return replace(self, matches=narrow(self.matches, *choices), offset=0)

    def total(self) -> int:
        return self.matches.count()

    def _shallow(self) -> tuple[Page, int | None]:
        """The same page near the beginning of fewer rows, and the total where that had to be counted."""
        if self.offset < self.deep:
            return self, None
        rows, offset, total = narrowed_to_page(self.matches, self.order, self.offset, self.limit)
        return replace(self, matches=rows, offset=offset, deep=offset + 1), total

    def envelope(self) -> dict[str, Any]:
        """The page as plain values; at most `limit` rows reach the driver.

        The total is counted while the page is picked, in the tasks whose results the driver takes, so a
        task that runs twice counts once.
        """
        page, total = self._shallow()
        seen = Observation()
        watched = replace(page, matches=page.matches.observe(seen, F.count(F.lit(1)).alias("n")))
        rows = watched.items.collect()
        if total is None:
            # Nothing is observed where no row comes by.
            total = seen.get["n"] if rows else self.total() if self.offset else 0
        return {
            "items": [row.asDict(recursive=True) for row in rows],
            "total": total,
            "limit": self.limit,
            "offset": self.offset,
        }

    def report(self) -> DataFrame:
        """The page as rows, each carrying total, limit and offset."""
        page, total = self._shallow()
        counted = self.matches.agg(F.count(F.lit(1))).scalar() if total is None else F.lit(total).cast("long")
        return page.items.withColumns(
            {"total": counted, "limit": F.lit(self.limit), "offset": F.lit(self.offset)}
        )
