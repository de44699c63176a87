"""Calendar dimension.  Its size is fixed by its date range, so it may be broadcast."""

from __future__ import annotations

import datetime as dt
from collections.abc import Mapping

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import Window as W
from pyspark.sql import functions as F

LONGEST_YEARS = 400


def calendar(
    spark: SparkSession, lo: dt.date, hi: dt.date, holidays: Mapping[dt.date, str] | None = None
) -> DataFrame:
    """One row per day with date parts, weekday, season and holiday columns.

    Seasons are meteorological; December opens the winter of the next year.
    Days that are no holiday have a null name and ``is_holiday`` false.
    """
    if (hi - lo).days > 366 * LONGEST_YEARS:
        raise ValueError("calendar range too long to be kept as a small dimension")
    day = F.col("calendar_date")
    days = spark.range(1).select(F.explode(F.sequence(F.lit(lo), F.lit(hi))).alias("calendar_date"))
    season = (
        F.when(F.month(day).isin(12, 1, 2), "Winter")
        .when(F.month(day) <= 5, "Spring")
        .when(F.month(day) <= 8, "Summer")
        .otherwise("Fall")
    )
    names = dict(holidays or {})
    if names:
        pairs = [x for date, name in names.items() for x in (F.lit(date), F.lit(name))]
        holiday = F.element_at(F.create_map(*pairs), day)
    else:
        holiday = F.lit(None).cast("string")
    return days.select(
        day,
        F.year(day).alias("year"),
        F.month(day).alias("month"),
        F.date_format(day, "MMMM").alias("month_name"),
        F.day(day).alias("day"),
        F.dayofweek(day).alias("day_of_week"),
        F.date_format(day, "EEEE").alias("day_of_week_name"),
        F.dayofweek(day).between(2, 6).alias("is_weekday"),
        season.alias("season"),
        (F.year(day) + F.when(F.month(day) == 12, 1).otherwise(0)).alias("season_year"),
        holiday.isNotNull().alias("is_holiday"),
        holiday.alias("holiday_name"),
    )


def working_index(cal: DataFrame, unknown_holiday_works: bool = True) -> DataFrame:
    """Per day: is it a working day, and how many working days lie up to and on it.

    An unknown holiday flag counts as "no holiday" or, on request, as one.
    The running count is over the calendar alone, a few thousand rows.
    """
    holiday = F.coalesce(F.col("is_holiday"), F.lit(not unknown_holiday_works))
    works = F.col("is_weekday") & ~holiday
    running = W.partitionBy(F.lit(0)).orderBy("calendar_date").rowsBetween(W.unboundedPreceding, W.currentRow)
    return cal.select(
        F.col("calendar_date").alias("day"),
        works.alias("works"),
        F.sum(works.cast("int")).over(running).alias("work_index"),
    )


def us_holidays(first_year: int, last_year: int) -> dict[dt.date, str]:
    """Fixed-date holidays, New Year to Christmas, by rule."""
    fixed = ((1, 1, "New Year"), (7, 4, "Independence Day"), (12, 25, "Christmas"))
    return {dt.date(y, m, d): name for y in range(first_year, last_year + 1) for m, d, name in fixed}
