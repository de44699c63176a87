"""One row per key.

Every pick is a ``row_number`` window cut at a constant rank.  Spark prunes
such a window inside each input task before the shuffle (``WindowGroupLimit``),
so a key that holds a third of all rows sends at most one row per task.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from ledgermill.session import shared_folder, shuffles_released

_RANK = "__rank"


def ordering(df: DataFrame, order: Sequence[Column | str]) -> list[Column]:
    """A total order: the given one, then every remaining column as tie-breaker."""
    explicit = [F.col(o) if isinstance(o, str) else o for o in order]
    return explicit + [F.col(f"`{c}`").asc_nulls_last() for c in df.columns]


def latest_first(*columns: str) -> list[Column]:
    return [F.col(c).desc_nulls_last() for c in columns]


def prefer(condition: Column) -> Column:
    """Ordering term that puts the rows meeting the condition first."""
    return F.when(condition, 0).otherwise(1)


def ranked(df: DataFrame, keys: Sequence[Column | str], order: Sequence[Column | str], name: str) -> DataFrame:
    window = W.partitionBy(*keys).orderBy(*ordering(df, order))
    return df.withColumn(name, F.row_number().over(window))


def qualify(df: DataFrame, keys: Sequence[Column | str], order: Sequence[Column | str], n: int = 1) -> DataFrame:
    """The first ``n`` rows of each key."""
    return ranked(df, keys, order, _RANK).where(F.col(_RANK) <= n).drop(_RANK)


def dedup_by_priority(df: DataFrame, keys: Sequence[Column | str], order: Sequence[Column | str]) -> DataFrame:
    """One row per key, by explicit priorities."""
    return qualify(df, keys, order, 1)


def dedup_few(df: DataFrame, keys: Sequence[str], order: Sequence[Column | str]) -> DataFrame:
    """``dedup_by_priority`` of a stored table where few keys repeat: rows that have their key alone stay where they are.

    The total order reads every column, so a pick moves whole rows.  The repeated keys are counted and
    written first; the size of that file decides whether they are sent to the rows.  Where very many keys
    repeat, the rows move by key as in a plain pick.
    """
    spark, names = df.sparkSession, {k: f"__repeated_{k}" for k in keys}
    path = shared_folder(spark, "repeated-keys")
    counted = df.groupBy(*keys).agg(F.count(F.lit(1)).alias("__n")).where(F.col("__n") > 1)
    with shuffles_released(spark):
        counted.select(*(F.col(k).alias(name) for k, name in names.items())).write.parquet(path)
    repeated = spark.read.parquet(path)
    same = [F.col(k).eqNullSafe(F.col(name)) for k, name in names.items()]
    picked = dedup_by_priority(df.join(repeated, same, "left_semi"), keys, order)
    return df.join(repeated, same, "left_anti").unionByName(picked)


def one_per(df: DataFrame, key: str) -> DataFrame:
    """A code table with one row per trimmed code, the first in order of its columns."""
    return dedup_by_priority(df.withColumn(key, F.trim(key)), [key], [])


def latest(df: DataFrame, keys: Sequence[Column | str], order: Sequence[str]) -> DataFrame:
    """The newest row per key by technical columns, missing values last."""
    return qualify(df, keys, latest_first(*order), 1)


def row_hash(df: DataFrame, columns: Sequence[str]) -> Column:
    """SHA-256 over the values of a row: typed, null marked, each with its length, in the given order of columns.

    Rows have the same hash exactly if all these values are equal; a null differs from empty
    text, and neighbouring values cannot run into one another.
    """
    kinds = dict(df.dtypes)
    parts = []
    for name in columns:
        text = F.col(f"`{name}`").cast("string")
        parts.append(F.when(text.isNull(), "-").otherwise(F.concat(F.lit(f"{kinds[name]}:"), F.length(text).cast("string"), F.lit(":"), text)))
    return F.sha2(F.concat_ws(",", *parts), 256)


def without_replays(df: DataFrame, version: str, ignored: Sequence[str] = ()) -> DataFrame:
    """One row per content: rows equal in all columns but the version, and the ignored ones, are replays of each other.

    Keeps the content, its hash, its first and last version and the number of rows.  Rows are
    combined by their hash before the shuffle, so a row replayed very often costs one per task.
    """
    content = [c for c in df.columns if c != version and c not in ignored]
    hashed = df.withColumn("row_hash", row_hash(df, content))
    return hashed.groupBy("row_hash").agg(
        *(F.any_value(F.col(f"`{c}`")).alias(c) for c in content),
        F.min(version).alias(f"first_{version}"), F.max(version).alias(f"last_{version}"), F.count(F.lit(1)).alias("copies"),
    )
