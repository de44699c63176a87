"""Key hygiene, renaming and projection."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def trim_keys(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Blank-pad free copies of the id columns."""
    return df.withColumns({c: F.trim(F.col(c)) for c in columns})


def rename(df: DataFrame, mapping: Mapping[str, str]) -> DataFrame:
    """Friendly names by map; names the table lacks are left out of account."""
    return df.withColumnsRenamed(dict(mapping))


def rename_by_table(df: DataFrame, mapping: DataFrame) -> DataFrame:
    """Friendly names from a rename table (as large as the column list, so read on the driver)."""
    names = {c.lower(): c for c in df.columns}
    wanted = mapping.where(F.lower("field").isin(list(names))).collect()
    return rename(df, {names[r.field.lower()]: r.friendly_name for r in wanted})


def select_except(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    return df.drop(*columns)


def prefixed(df: DataFrame, prefix: str, keep: Sequence[str] = ()) -> DataFrame:
    """Prefix all columns but the join keys, to keep two sides apart."""
    return df.select(*(F.col(c) if c in keep else F.col(c).alias(prefix + c) for c in df.columns))
