"""Null-safe arithmetic, predicates and conversions."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def growth(now: Column, before: Column) -> Column:
    """(now - before) / before; null when either side is unknown or `before` is zero."""
    return F.try_divide(now - before, before)


def change(now: Column, before: Column) -> Column:
    """now - before; null when either side is unknown."""
    return now - before


def contains_ci(text: Column, needle: str) -> Column:
    """Case-insensitive substring match; % and _ in `needle` stay wildcards."""
    return text.ilike(f"%{needle}%")



def struct_to_map(fields: Column) -> Column:
    """A struct whose field names are data, as map<string,double>; unknown fields get no entry."""
    return F.from_json(F.to_json(fields), "map<string,double>")
