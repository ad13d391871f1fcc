"""Unmodelled payload fields, kept as VARIANT beside the typed page."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T


def _members(value: Column, is_text: bool) -> Column:
    """The members of an object by name; null for anything else."""
    if is_text:
        return F.from_json(value, T.MapType(T.StringType(), T.VariantType()))
    return F.try_variant_get(value, "$", "map<string,variant>")


def _beyond(value: Column, dtype: T.StructType, is_text: bool = False) -> Column:
    """A map of the members of an object that `dtype` doesn't model, at any depth of objects."""
    members = _members(value, is_text)
    modelled = [f.name for f in dtype.fields]
    found = F.map_filter(members, lambda name, _: ~name.isin(*modelled))
    for field in dtype.fields:
        if isinstance(field.dataType, T.StructType):
            inner = _beyond(members[field.name], field.dataType)
            kept = F.when(F.size(inner) > 0, F.create_map(F.lit(field.name), F.to_variant_object(inner)))
            none = F.create_map().cast(T.MapType(T.StringType(), T.VariantType()))
            found = F.map_concat(found, F.coalesce(kept, none))
    return found


def unmodelled(payload: Column, dtype: T.StructType) -> Column:
    """What a payload text has beyond its modelled fields, as a VARIANT object of the same nesting.

    Fields of objects are looked at, those inside arrays are not. It is null where nothing is left or
    the text is no object.
    """
    found = _beyond(payload, dtype, is_text=True)
    return F.when(F.size(found) > 0, F.to_variant_object(found))


def extra(path: str, dtype: str, column: str = "extra") -> Column:
    """The unmodelled value at a path such as `$.daily.wind`; null if absent or of another type."""
    return F.try_variant_get(F.col(column), path, dtype)


def extra_series(pages: DataFrame, days: str, object_path: str) -> DataFrame:
    """One row for each day of each unmodelled series: the columns of `pages` but page and extra, item_no,
    series, reading (VARIANT).

    `days` is the typed array of the page that the series run along; a series is any array in the object
    at `object_path`. Readings beyond the last day are left out; missing ones give no row.
    """
    others = [c for c in pages.columns if c not in ("page", "extra")]
    series = F.explode(extra(object_path, "map<string,variant>")).alias("series", "values")
    named = pages.select(*others, F.size(days).alias("__days"), series)
    values = F.posexplode(F.try_variant_get("values", "$", "array<variant>")).alias("item_no", "reading")
    return named.select(*others, "__days", "series", values).where("item_no < __days").drop("__days")
