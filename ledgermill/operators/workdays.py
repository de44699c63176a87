"""Working-day arithmetic.

Counting days by a range join costs a nested loop over the calendar for every
row.  Here the calendar carries a running count of working days, so a
difference is two equality look-ups and a subtraction, and "n working days
later" is one look-up and a step in the list of working days.  The calendar is
small by construction: look-ups broadcast it, and the list is a scalar that is
computed once.
"""

from __future__ import annotations

import datetime as dt

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ledgermill.functions.fixed_values import (
    FABRIC_CATEGORIES,
    SHIP_THRESHOLDS,
    SHIPPED_LATER,
    WORKDAY_GRACE_GROUPS,
)
from ledgermill.functions.text import ColumnOrName, _c, first_rule, flag_if
from ledgermill.sources.calendar import working_index

Date = ColumnOrName | dt.date


def _day(date: Date) -> Column:
    return F.lit(date) if isinstance(date, dt.date) else _c(date).cast("date")


def _with_index(df: DataFrame, date: Date, index: DataFrame, name: str) -> DataFrame:
    """Number of working days up to and on the date, as a new column.

    A date outside the calendar is an error, not a missing value.
    """
    if isinstance(date, dt.date):
        return df.withColumn(name, index.where(F.col("day") == F.lit(date)).select("work_index").scalar())
    lookup = F.broadcast(index.select(F.col("day").alias("__day"), F.col("work_index").alias(name)))
    joined = df.withColumn("__day", _day(date)).join(lookup, "__day", "left")
    outside = F.raise_error(F.concat(F.lit("date outside the calendar: "), F.col("__day").cast("string")))
    known = F.when(F.col("__day").isNull() | F.col(name).isNotNull(), F.col(name)).otherwise(outside)
    return joined.withColumn(name, known).drop("__day")


def workdays_between(
    df: DataFrame,
    pairs: dict[str, tuple[Date, Date]],
    cal: DataFrame,
    unknown_holiday_works: bool = False,
) -> DataFrame:
    """Working days after the first date up to and on the second, one column per pair.

    A date may be a column or a constant.  Null where a date is missing or the
    second lies before the first.
    """
    index = working_index(cal, unknown_holiday_works)
    indexed: dict[str, str] = {}
    for a, b in pairs.values():
        for date in (a, b):
            if str(date) not in indexed:
                indexed[str(date)] = f"__wi{len(indexed)}"
                df = _with_index(df, date, index, indexed[str(date)])
    for name, (a, b) in pairs.items():
        counted = F.col(indexed[str(b)]) - F.col(indexed[str(a)])
        df = df.withColumn(name, F.when(_day(b) >= _day(a), counted))
    return df.drop(*indexed.values())


def add_workdays(
    df: DataFrame,
    steps: dict[str, tuple[ColumnOrName, int]],
    cal: DataFrame,
    roll: bool = False,
    unknown_holiday_works: bool = True,
) -> DataFrame:
    """The n-th working day after a date (n > 0), one column per step.

    ``roll=True`` first moves a date that is no working day on to the next one
    and counts from there, so the result lies one working day later.  Null where
    the calendar ends before.
    """
    index = working_index(cal, unknown_holiday_works)
    working_days = index.where("works").agg(F.array_sort(F.collect_list("day"))).scalar()
    rolled = F.when(F.col("works"), 0).otherwise(1) if roll else F.lit(0)
    start = index.withColumn("work_index", (F.col("work_index") + rolled).cast("int"))
    indexed: dict[str, str] = {}
    for name, (date, n) in steps.items():
        if str(date) not in indexed:
            indexed[str(date)] = f"__wi{len(indexed)}"
            df = _with_index(df, date, start, indexed[str(date)])
        df = df.withColumn(name, F.try_element_at(working_days, F.col(indexed[str(date)]) + n))
    return df.drop(*indexed.values())


def sla_flags(workdays: ColumnOrName) -> dict[str, Column]:
    """Cumulative Y/N flags; the last one only says that the goods have shipped."""
    late = _c(workdays) - 1
    flags = {name: flag_if(late <= limit) for name, limit in SHIP_THRESHOLDS}
    flags[SHIPPED_LATER] = flag_if(_c(workdays).isNotNull())
    return flags


def lead_time_range(workdays: ColumnOrName) -> Column:
    """The same thresholds as disjoint ranges; null where not shipped."""
    late = _c(workdays) - 1
    rules: list[tuple[Column, object]] = [(late.isNull(), F.lit(None).cast("string"))]
    rules += [(late <= limit, name) for name, limit in SHIP_THRESHOLDS]
    return first_rule(rules, SHIPPED_LATER)


def delivery_group(
    stock: ColumnOrName, advertised: ColumnOrName, reorder_point: ColumnOrName, planner: ColumnOrName,
    category: ColumnOrName, promised_in: ColumnOrName, invoiced_in: ColumnOrName,
) -> Column:
    """Delivery group of a sale; the first matching rule decides."""
    stock, planner, reorder_point = _c(stock), _c(planner), _c(reorder_point)
    wp, wi = _c(promised_in), _c(invoiced_in)
    listed = (stock == "S") & (_c(advertised) == "Y") & (reorder_point > 1)
    quick = (wp <= 6) | (wi <= 2)
    slow = (wp > 6) & (wi > 2)
    return first_rule(
        [
            (listed & quick, "Advertised In-Stock"),
            ((listed | (planner == "AS")) & slow, "Advertised Out-of-Stock"),
            ((planner == "AS") & quick, "In-Stock Altered Stock"),
            ((stock == "S") & (reorder_point == 1), "Standard"),
            (planner == "KT", "Kits"),
            ((stock == "N") & ~planner.isin("AS", "KT"), "Made To Order"),
            (_c(category).isin(*FABRIC_CATEGORIES) | (planner == "RM"), "Fabrics and Raw Materials"),
            (stock == "S", "Other Stock"),
        ],
        "Other",
    )


def fillable(
    group: ColumnOrName, stock: ColumnOrName, promised_in: ColumnOrName,
    kit_all_stock: ColumnOrName, kit_components: ColumnOrName,
) -> Column:
    group, stock, wp = _c(group), _c(stock), _c(promised_in)
    all_stock = _c(kit_all_stock)
    in_time = first_rule(
        [
            (group.isin("Advertised In-Stock", "In-Stock Altered Stock"), True),
            (group == "Standard", wp <= 10),
            (group == "Other Stock", wp <= 6),
            (group == "Fabrics and Raw Materials", ((stock == "S") & (wp <= 6)) | ((stock != "S") & (wp <= 10))),
            (
                (group == "Kits") & (F.coalesce(_c(kit_components), F.lit(0)) > 0),
                ((all_stock == 1) & (wp <= 6)) | ((all_stock == 0) & (wp <= 10)),
            ),
        ],
        False,
    )
    return flag_if(in_time, "Fillable", "Unfillable")


def on_time(group: ColumnOrName, promised: ColumnOrName, invoiced: ColumnOrName, workdays_late: ColumnOrName) -> Column:
    """``Y``/``N``; null where a date is missing.  Some groups have ten working days of grace.

    ``workdays_late`` counts from promise to invoice and is null for early invoices.
    """
    promised, invoiced = _c(promised).cast("date"), _c(invoiced).cast("date")
    graced = F.coalesce(_c(workdays_late), F.lit(0)) <= 10
    return first_rule(
        [
            (promised.isNull() | invoiced.isNull(), F.lit(None).cast("string")),
            (_c(group).isin(*WORKDAY_GRACE_GROUPS), flag_if(graced)),
        ],
        flag_if(invoiced <= promised),
    )
