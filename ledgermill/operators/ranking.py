"""Presentation order, samples and frequencies."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ledgermill.operators.dedup import qualify


def sorted_output(df: DataFrame, columns: Sequence[Column | str]) -> DataFrame:
    """Global sort (range partitioned); for the sink only."""
    return df.orderBy(*columns)


def sample_failures(df: DataFrame, n: int = 100, order: Sequence[Column | str] = ()) -> DataFrame:
    """A look at some failing rows.  The count of all of them is the check's own result."""
    return (df.orderBy(*order) if order else df).limit(n)


def long_values(df: DataFrame, columns: Sequence[str] | None = None) -> DataFrame:
    """(ordinal, column_name, value) rows, values as text, in one scan."""
    columns = list(columns or df.columns)
    cells = F.array(
        *(
            F.struct(
                F.lit(i).alias("ordinal"), F.lit(c).alias("column_name"),
                F.col(f"`{c}`").cast("string").alias("value"),
            )
            for i, c in enumerate(columns, 1)
        )
    )
    return df.select(F.inline(cells))


def topk_values(df: DataFrame, k: int, columns: Sequence[str] | None = None) -> DataFrame:
    """Up to ``k`` distinct values per column in a stable pseudo-random order."""
    present = long_values(df, columns).where(F.trim("value") != "")
    distinct = present.groupBy("ordinal", "column_name", "value").count().drop("count")
    return qualify(distinct, ["ordinal", "column_name"], [F.md5("value"), F.col("value")], k)


def first_values(df: DataFrame, k: int, columns: Sequence[str] | None = None) -> DataFrame:
    """The ``k`` smallest non-null values per column, repeats included, as text."""
    columns = list(columns or df.columns)
    present = long_values(df, columns).where(F.col("value").isNotNull())
    types = dict(df.dtypes)
    numeric = [c for c in columns if not types[c].startswith(("string", "date", "timestamp", "boolean"))]
    as_number = F.when(F.col("column_name").isin(*numeric), F.col("value").try_cast("double"))
    return qualify(present, ["ordinal", "column_name"], [as_number.asc_nulls_last(), F.col("value")], k)


def frequency(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    return df.groupBy(*columns).agg(F.count(F.lit(1)).alias("rows"))
