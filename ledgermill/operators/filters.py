"""Row filters.  Each is a plain predicate, so it reaches the parquet scan."""

from __future__ import annotations

import datetime as dt
from collections.abc import Mapping, Sequence
from typing import Any

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ledgermill.functions.dates import lookback_start
from ledgermill.functions.text import ColumnOrName, _c


def not_deleted(df: DataFrame, flag: str = "flag_del", deleted: str = "D") -> DataFrame:
    """Live rows; a missing flag counts as live."""
    return df.where(F.col(flag).isNull() | (F.col(flag) != deleted))


def between_dates(df: DataFrame, column: str, lo: dt.date, hi: dt.date) -> DataFrame:
    """Half-open window: ``lo`` belongs to it, ``hi`` does not."""
    return df.where((F.col(column) >= F.lit(lo)) & (F.col(column) < F.lit(hi)))


def lookback(df: DataFrame, column: str, n: int, unit: str, asof: dt.date) -> DataFrame:
    return df.where(F.col(column) >= lookback_start(asof, n, unit))


def code_range(df: DataFrame, column: str, lo: str, hi: str) -> DataFrame:
    return df.where(F.col(column).between(lo, hi))


def effective(df: DataFrame, start: str | None, end: str, asof: dt.date) -> DataFrame:
    """Rows valid at ``asof``; an open end (null) does not restrict."""
    now = F.lit(asof)
    valid = F.col(end).isNull() | (F.col(end) >= now)
    if start is not None:
        valid = valid & (F.col(start).isNull() | (F.col(start) <= now))
    return df.where(valid)


def unexpired(df: DataFrame, end: str, asof: dt.date) -> DataFrame:
    """Rows whose end lies after ``asof``; a missing end does not qualify."""
    return df.where(F.col(end) > F.lit(asof))


def sales_scope(df: DataFrame, date: str, since: dt.date, customer_class: str, excluded: str = "IC") -> DataFrame:
    """History after a cut-off without one customer class.  Rows of unknown class drop out."""
    return df.where((F.col(date) > F.lit(since)) & (F.col(customer_class) != excluded))


def still_open(shipment: ColumnOrName, shipped: ColumnOrName, opened: ColumnOrName) -> Column:
    """Nothing shipped yet, or less than is open."""
    return _c(shipment).isNull() | (_c(opened) > _c(shipped))


def param_filters(params: Mapping[str, Any], fields: Mapping[str, tuple[str, str]]) -> list[tuple[str, Column]]:
    """Predicates for the report parameters that are set; an unset one does not restrict.

    ``fields`` maps a parameter to (column, operator), operators being
    ``>= > <= < = in like``.
    """
    build = {
        ">=": lambda c, v: c >= F.lit(v), ">": lambda c, v: c > F.lit(v),
        "<=": lambda c, v: c <= F.lit(v), "<": lambda c, v: c < F.lit(v),
        "=": lambda c, v: c == F.lit(v), "in": lambda c, v: c.isin(list(v)), "like": lambda c, v: c.like(v),
    }
    unknown = set(params) - set(fields)
    if unknown:
        raise ValueError(f"unknown report parameters: {sorted(unknown)}")
    return [
        (name, build[op](F.col(column), params[name]))
        for name, (column, op) in fields.items()
        if params.get(name) is not None
    ]


def apply_params(df: DataFrame, params: Mapping[str, Any], fields: Mapping[str, tuple[str, str]]) -> DataFrame:
    for _, predicate in param_filters(params, fields):
        df = df.where(predicate)
    return df


def finished_goods(
    locations: DataFrame,
    items: DataFrame,
    location_ids: Sequence[str],
    cost_category: str = "05",
    parent_commodity: str = "PAR",
    sources: Sequence[str] = ("P", "M"),
) -> DataFrame:
    """Item locations of finished goods; ``items`` has one row per item."""
    wanted = items.where((F.col("code_cat_cost") == cost_category) & (F.col("code_comm") != parent_commodity))
    return locations.where(F.col("flag_source").isin(*sources) & F.col("id_loc").isin(*location_ids)).join(
        wanted.select("id_item"), "id_item", "left_semi"
    )
