"""Date windows and date dimensions."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import Column
from pyspark.sql import functions as F

from ledgermill.functions.text import ColumnOrName, _c

# Fixed value: the date that stands for "no date" in ordering rules.
NO_DATE = dt.date(1900, 1, 1)


def or_no_date(*dates: ColumnOrName) -> Column:
    return F.coalesce(*(_c(d).cast("date") for d in dates), F.lit(NO_DATE))


def compact(date: ColumnOrName) -> Column:
    """``yyyyMMdd`` text."""
    return F.date_format(_c(date), "yyyyMMdd")


def event_time(date: ColumnOrName, hhmmss: ColumnOrName) -> Column:
    """Timestamp from a date and a time of day kept as the number HHMMSS."""
    day, clock = _c(date), _c(hhmmss).cast("int")
    return F.make_timestamp(
        F.year(day), F.month(day), F.day(day),
        F.floor(clock / 10000).cast("int"),
        F.floor((clock % 10000) / 100).cast("int"),
        (clock % 100).cast("decimal(8,6)"),
    )


def date_dimensions(date: ColumnOrName, prefix: str) -> dict[str, Column]:
    """Year, quarter, month, Sunday-based week and weekday columns of one date.

    The week belongs to the year of its Sunday; its number counts from the
    week that holds 1 January, weeks starting on Sunday.
    """
    day = _c(date)
    sunday = F.date_sub(day, F.dayofweek(day) - 1)
    first_of_year = F.trunc(sunday, "year")
    week = F.floor((F.dayofyear(sunday) - 1 + F.dayofweek(first_of_year) - 1) / 7).cast("int") + 1
    return {
        f"{prefix}_year": F.year(day),
        f"{prefix}_yearqtr": F.year(day) * 10 + F.quarter(day),
        f"{prefix}_yearmonth": F.year(day) * 100 + F.month(day),
        f"{prefix}_yearweek": F.year(sunday) * 100 + week,
        f"{prefix}_dayofweek": F.dayofweek(day),
        f"{prefix}_month": F.month(day),
    }


def fiscal_label(period: ColumnOrName) -> Column:
    """``YYYY-PP`` from the number YYYYPP."""
    text = _c(period).cast("string")
    return F.concat(F.substring(text, 1, 4), F.lit("-"), F.substring(text, 5, 2))


def lookback_start(asof: dt.date, n: int, unit: str) -> Column:
    """First day of a look-back window that ends at ``asof``."""
    anchor = F.lit(asof)
    if unit == "month":
        return F.add_months(anchor, -n)
    if unit == "day":
        return F.date_sub(anchor, n)
    raise ValueError(f"unknown unit {unit!r}")
