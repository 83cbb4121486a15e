"""Epoch, calendar and day-number expressions."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

ColumnLike = Column | str


def _col(c: ColumnLike) -> Column:
    return F.col(c) if isinstance(c, str) else c


def epoch_seconds(ms: ColumnLike) -> Column:
    """Epoch milliseconds to whole seconds, rounding towards the past."""
    ms = _col(ms)
    # integer arithmetic throughout: a detour over double would lose digits
    return F.call_function("div", ms - F.pmod(ms, F.lit(1000)), F.lit(1000))


def epoch_timestamp(seconds: ColumnLike) -> Column:
    """Epoch seconds to a timestamp, in the session zone (UTC by default)."""
    return F.timestamp_seconds(_col(seconds))


def weekday_mon0(ts: ColumnLike) -> Column:
    return F.weekday(_col(ts))


def weekday_sun0(ts: ColumnLike) -> Column:
    return F.dayofweek(_col(ts)) - F.lit(1)


def date_from_days(days: ColumnLike, origin: str = "1960-01-01", invalid: str = "1900-01-01") -> Column:
    """Day number since ``origin`` to a date; negative becomes ``invalid``, null stays null."""
    days = _col(days)
    counted = F.date_add(F.lit(origin).cast("date"), days.try_cast("int"))
    return F.when(days < 0, F.lit(invalid).cast("date")).when(days.isNotNull(), counted)


def parse_date(text: ColumnLike, fmt: str = "MMddyyyy") -> Column:
    """Text to date; text that does not parse becomes null."""
    return F.try_to_date(_col(text), fmt)


def time_parts(ts: ColumnLike, week_start: str = "sunday") -> dict[str, Column]:
    """Calendar columns of a timestamp, keyed by output name."""
    if week_start not in ("sunday", "monday"):
        raise ValueError(f"week_start must be 'sunday' or 'monday', not {week_start!r}")
    ts = _col(ts)
    return {
        "hour": F.hour(ts),
        "day": F.dayofmonth(ts),
        "week": F.weekofyear(ts),
        "month": F.month(ts),
        "year": F.year(ts),
        "weekday": weekday_sun0(ts) if week_start == "sunday" else weekday_mon0(ts),
    }
