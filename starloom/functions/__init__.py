"""Column expressions; every one stays inside whole-stage code generation."""

from starloom.functions.codes import (
    flag_equals,
    hash_key,
    impute,
    is_present,
    label_when,
    map_codes,
    normalize_codes,
    null_if,
    title_trim,
    to_long,
    value_or,
)
from starloom.functions.temporal import (
    date_from_days,
    epoch_seconds,
    epoch_timestamp,
    parse_date,
    time_parts,
    weekday_mon0,
    weekday_sun0,
)

__all__ = [
    "date_from_days",
    "epoch_seconds",
    "epoch_timestamp",
    "flag_equals",
    "hash_key",
    "impute",
    "is_present",
    "label_when",
    "map_codes",
    "normalize_codes",
    "null_if",
    "parse_date",
    "time_parts",
    "title_trim",
    "to_long",
    "value_or",
    "weekday_mon0",
    "weekday_sun0",
]
