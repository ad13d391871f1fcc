from tidemark.functions.calendar import calendar_columns, date_key, iso_day, iso_instant, month_key
from tidemark.functions.guards import change, contains_ci, growth, struct_to_map

__all__ = [
    "calendar_columns",
    "change",
    "contains_ci",
    "date_key",
    "growth",
    "iso_day",
    "iso_instant",
    "month_key",
    "struct_to_map",
]
