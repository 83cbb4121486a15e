"""Code cleaning, labels, sentinels and surrogate hashes."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from starloom.functions.temporal import ColumnLike, _col

NULL_TEXT = "\\N"
TIMESTAMP_PATTERN = "yyyy-MM-dd HH:mm:ss"


def flag_equals(c: ColumnLike, value: object) -> Column:
    """True where the column holds ``value``; null counts as false."""
    return F.coalesce(_col(c) == F.lit(value), F.lit(False))


def normalize_codes(c: ColumnLike, keep: Sequence[object], null_as: str | None = "UNSPECIFIED", other: str = "OTHER") -> Column:
    """Keep the known codes, name the missing ones, fold the rest into ``other``."""
    c = _col(c)
    return F.when(c.isNull(), F.lit(null_as)).when(c.isin(list(keep)), c).otherwise(F.lit(other))


def is_present(c: ColumnLike) -> Column:
    return _col(c).isNotNull()


def map_codes(c: ColumnLike, labels: Mapping[object, str], other: str = "Other") -> Column:
    """Code to label; unknown codes become ``other``, null stays null."""
    c = _col(c)
    known = F.lit(None).cast("string")
    for code, label in labels.items():
        known = F.when(c == F.lit(code), F.lit(label)).otherwise(known)
    return F.when(c.isNotNull(), F.coalesce(known, F.lit(other)))


def null_if(c: ColumnLike, sentinel: object) -> Column:
    return F.nullif(_col(c), F.lit(sentinel))


def value_or(c: ColumnLike, default: object) -> Column:
    return F.coalesce(_col(c), F.lit(default))


def title_trim(c: ColumnLike) -> Column:
    """Title case without surrounding blanks, the form names are matched in."""
    return F.trim(F.initcap(_col(c)))


def label_when(predicate: Column) -> Column:
    """Boolean label; an undecided (null) predicate is false."""
    return F.coalesce(predicate, F.lit(False))


def to_long(c: ColumnLike, via_float: bool = False) -> Column:
    """Numeric text to long, over double, or over single precision where asked.

    Single precision loses digits above 2^24; it exists to reproduce figures
    that were loaded that way.
    """
    return _col(c).try_cast("float" if via_float else "double").try_cast("long")


def hash_key(*cols: ColumnLike, timestamps: Sequence[str] = (), sep: str = "|") -> Column:
    """Hex digest of the given columns, with a separator and a null marker.

    Names listed in ``timestamps`` are rendered with a fixed pattern first, so
    the digest does not depend on how an engine prints timestamps.
    """
    parts = []
    for c in cols:
        text = F.date_format(c, TIMESTAMP_PATTERN) if isinstance(c, str) and c in timestamps else _col(c).cast("string")
        parts.append(F.coalesce(text, F.lit(NULL_TEXT)))
    return F.md5(F.concat_ws(sep, *parts).cast("binary"))


def impute(df: DataFrame, defaults: Mapping[str, object]) -> DataFrame:
    """Constant imputation per column."""
    return df.fillna(dict(defaults))
