"""Calendar columns."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def date_parts(d: Column) -> dict[str, Column]:
    """Year, month, day, weekday (Monday is 0), ISO week, weekend flag and quarter."""
    weekday = F.weekday(d)
    return {
        "year": F.year(d),
        "month": F.month(d),
        "day": F.dayofmonth(d),
        "day_of_week": weekday,
        "week_of_year": F.weekofyear(d),
        "is_weekend": (weekday >= 5).cast("int"),
        "quarter": F.quarter(d),
    }


def day_name(d: Column) -> Column:
    return F.date_format(d, "EEEE")


def month_name(d: Column) -> Column:
    return F.date_format(d, "MMMM")


def year_month(d: Column) -> Column:
    return F.date_format(d, "yyyy-MM")


def week_end(d: Column) -> Column:
    """The Sunday that closes the day's week (a Sunday closes its own)."""
    return F.next_day(F.date_sub(d, 1), "SUN")


def hour_of_hhmm(hhmm: Column) -> Column:
    return F.floor(hhmm / 100).cast("int")


def since(ts: Column, interval: str, as_of: Column) -> Column:
    """True for times within ``interval`` (such as ``30 days``) before ``as_of``."""
    return ts >= as_of - F.expr(f"interval {interval}")
