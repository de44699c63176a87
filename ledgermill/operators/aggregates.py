"""Roll-ups.  All but the string lists combine inside each task before the shuffle."""

from __future__ import annotations

import datetime as dt
from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ledgermill.functions.dates import lookback_start
from ledgermill.operators.dedup import ranked


def bucket_sums(
    df: DataFrame, keys: Sequence[str], value: Column | str, buckets: Mapping[str, Column]
) -> DataFrame:
    """One conditional sum per bucket; a row outside the bucket adds zero."""
    amount = F.coalesce(F.col(value) if isinstance(value, str) else value, F.lit(0))
    return df.groupBy(*keys).agg(
        *(F.sum(F.when(condition, amount).otherwise(0)).alias(name) for name, condition in buckets.items())
    )


def split_sums(df: DataFrame, keys: Sequence[str], values: Sequence[str], flag: str, labels: Mapping[str, str]) -> DataFrame:
    """Total of each value and its parts by a two-valued flag, null as zero."""
    aggs: list[Column] = []
    for value in values:
        amount = F.coalesce(F.col(value), F.lit(0))
        aggs.append(F.sum(amount).alias(f"{value}_total"))
        aggs += [
            F.sum(F.when(F.col(flag) == code, amount).otherwise(0)).alias(f"{value}_{label}")
            for code, label in labels.items()
        ]
    return df.groupBy(*keys).agg(*aggs)


def pivot_attrs(
    df: DataFrame, keys: Sequence[str], attr: str, value: str, names: Mapping[str, str], default: str | None = ""
) -> DataFrame:
    """Attribute rows to columns.  A missing attribute gives the default, not null.

    The attribute list is given, so no pass over the data looks for it.
    """
    floor = F.lit(default)
    return df.groupBy(*keys).agg(
        *(F.max(F.when(F.col(attr) == code, F.col(value)).otherwise(floor)).alias(name) for code, name in names.items())
    )


def listagg(
    df: DataFrame, keys: Sequence[str], column: str, name: str, sep: str = ", ", order: Sequence[str] = ()
) -> DataFrame:
    """Ordered text list per key; nulls are skipped.

    A list holds its whole group by definition.  Reduce the rows to the distinct
    entries that belong in it before calling this.
    """
    present = df.where(F.col(column).isNotNull())
    return present.groupBy(*keys).agg(text_list(column, sep, order).alias(name))


def text_list(column: str, sep: str = ", ", order: Sequence[str] = (), condition: Column | None = None) -> Column:
    """The list of ``listagg`` as an aggregate, of the rows that meet the condition; null without entries.

    Several lists and other aggregates of the same rows then need one grouping.
    """
    present = F.col(column).isNotNull()
    entry = F.struct(*(F.col(c) for c in (order or (column,))), F.col(column).alias("__text"))
    entries = F.array_sort(F.collect_list(F.when(present if condition is None else present & condition, entry)))
    return F.when(F.size(entries) > 0, F.array_join(entries["__text"], sep))


def rank_to_columns(
    df: DataFrame, keys: Sequence[str], order: Sequence[Column | str], columns: Sequence[str], prefixes: Sequence[str]
) -> DataFrame:
    """The first rows per key side by side: ``primary_x``, ``secondary_x``, ..."""
    top = ranked(df, keys, order, "__rank").where(F.col("__rank") <= len(prefixes))
    return top.groupBy(*keys).agg(
        *(
            F.max(F.when(F.col("__rank") == i, F.col(c))).alias(f"{p}_{c}")
            for i, p in enumerate(prefixes, 1)
            for c in columns
        )
    )


def any_of(condition: Column) -> Column:
    return F.max(F.when(condition, 1).otherwise(0))


def all_of(condition: Column) -> Column:
    return F.min(F.when(condition, 1).otherwise(0))


def share_of_total(df: DataFrame, column: str, count: str = "value_count", share: str = "value_pct") -> DataFrame:
    """Count per value and its percentage of all rows.

    The total comes from the counts as a scalar, so no window gathers all values.
    """
    counts = df.groupBy(column).agg(F.count(F.lit(1)).alias(count))
    total = counts.agg(F.sum(count)).scalar()
    return counts.withColumn(share, F.round(F.col(count) * 100.0 / total, 2))


def most_frequent(df: DataFrame, keys: Sequence[str], value: str, name: str) -> DataFrame:
    """Most frequent value per key, the greater one among equals."""
    counts = df.where(F.col(value).isNotNull()).groupBy(*keys, value).agg(F.count(F.lit(1)).alias("__n"))
    return counts.groupBy(*keys).agg(F.max_by(value, F.struct("__n", value)).alias(name))


def summarise_log(
    df: DataFrame,
    keys: Sequence[str],
    order: Sequence[str],
    date: str,
    code: str,
    flag: str,
    change: str,
    asof: dt.date,
    days: int = 90,
) -> DataFrame:
    """One row per key of a transaction log: last date, greatest code, last flag, recent change."""
    recent = F.col(date) >= lookback_start(asof, days, "day")
    return df.groupBy(*keys).agg(
        F.max(date).alias("last_change_date"),
        F.max(code).alias("last_transaction_code"),
        F.max_by(flag, F.struct(*order)).alias("last_post_status"),
        F.coalesce(F.sum(F.when(recent, F.col(change))), F.lit(0)).alias("recent_change"),
        F.count(F.lit(1)).alias("transactions"),
    )
