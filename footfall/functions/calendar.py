"""Calendar column builders (F7-F13).  All built-in, codegen'd expressions."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def _c(c) -> Column:
    return F.col(c) if isinstance(c, str) else c


def to_day(c) -> Column:
    """F7 + F8: parse text/timestamp and truncate to a calendar date."""
    return F.to_date(_c(c))


def day_of_week(c) -> Column:
    """Monday = 0 ... Sunday = 6 (``weekday``, not ``dayofweek``)."""
    return F.weekday(_c(c)).cast("int")


def week_of_month(c) -> Column:
    """(day - 1) // 7 + 1."""
    return (F.floor((F.dayofmonth(_c(c)) - 1) / 7) + 1).cast("int")


def calendar_parts(c) -> dict[str, Column]:
    """F10-F12 as a ``withColumns`` mapping: dow, wom, year, month, day."""
    d = _c(c)
    return {
        "dow": day_of_week(d),
        "wom": week_of_month(d),
        "year": F.year(d).cast("int"),
        "month": F.month(d).cast("int"),
        "day": F.dayofmonth(d).cast("int"),
    }


def day_diff(later, earlier) -> Column:
    """whole calendar days between two already-truncated dates."""
    return F.datediff(_c(later), _c(earlier)).cast("int")


def date_int(c) -> Column:
    """date -> yyyymmdd integer."""
    return F.date_format(_c(c), "yyyyMMdd").cast("int")
