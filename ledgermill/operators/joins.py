"""Look-ups and joins.

The right side of every look-up is brought to one row per key before the join,
so no join multiplies rows and none needs a clean-up ``distinct`` after it.
Which side is broadcast is left to the run-time size check of adaptive
execution; only tables of constant size are broadcast by hand.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ledgermill.functions.text import norm_key
from ledgermill.operators.dedup import dedup_by_priority, latest
from ledgermill.operators.keys import prefixed


def header_line(line: DataFrame, header: DataFrame, keys: Sequence[str], how: str = "inner") -> DataFrame:
    """Lines with the fields of their header (one row per key)."""
    return line.join(header, list(keys), how)


def enrich(df: DataFrame, *dims: tuple[DataFrame, Sequence[str] | str]) -> DataFrame:
    """Chain of left joins to dimensions with one row per key."""
    for dim, keys in dims:
        df = df.join(dim, [keys] if isinstance(keys, str) else list(keys), "left")
    return df


def left_latest(df: DataFrame, dim: DataFrame, keys: Sequence[str], order: Sequence[str]) -> DataFrame:
    """Left join to the newest dimension row per key."""
    return df.join(latest(dim, keys, order), list(keys), "left")


def join_norm(
    left: DataFrame, right: DataFrame, pairs: Sequence[tuple[str, str]], how: str = "left", keep_right: bool = False
) -> DataFrame:
    """Equi-join on trimmed, null-safe copies of the key columns."""
    names = [f"__k{i}" for i in range(len(pairs))]
    l_side = left.withColumns({n: norm_key(a) for n, (a, _) in zip(names, pairs)})
    r_side = right.withColumns({n: norm_key(b) for n, (_, b) in zip(names, pairs)})
    if not keep_right:
        r_side = r_side.drop(*(b for _, b in pairs))
    return l_side.join(r_side, names, how).drop(*names)


def spread_blank(key: str, *by: str) -> Column:
    """A normalised key for a left join; rows without a key get one of many that match nothing.

    Null and blank keys would otherwise all meet in one task.
    """
    own = norm_key(key)
    return F.when(own != "", own).otherwise(F.concat(F.lit("\0"), F.pmod(F.xxhash64(*by), F.lit(4096)).cast("string")))


def spread_null(key: str, *by: str) -> Column:
    """The trimmed key for a left join; only rows whose key is null get one of many that match nothing."""
    return F.coalesce(F.trim(key), F.concat(F.lit("\0"), F.pmod(F.xxhash64(*by), F.lit(4096)).cast("string")))


def full_reconcile(a: DataFrame, b: DataFrame, keys: Sequence[str], null_safe: bool = True) -> DataFrame:
    """Full outer join of two tables with one row per key.

    Null keys meet each other by default.  ``null_safe=False`` keeps them apart,
    as plain equality does.  Columns other than the keys must differ in name.
    """
    if not null_safe:
        return a.join(b, list(keys), "full")
    left, right = a.alias("a"), b.alias("b")
    on = [F.col(f"a.{k}").eqNullSafe(F.col(f"b.{k}")) for k in keys]
    merged = left.join(right, on, "full")
    return merged.select(
        *(F.coalesce(F.col(f"a.{k}"), F.col(f"b.{k}")).alias(k) for k in keys),
        *(F.col(f"a.{c}") for c in a.columns if c not in keys),
        *(F.col(f"b.{c}") for c in b.columns if c not in keys),
    )


def orphans(child: DataFrame, parent: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Rows of ``child`` without a partner.

    The partner keys are made distinct first: that combines inside each task,
    so a key of very many rows is sent once per task.
    """
    return child.join(parent.select(*keys).distinct(), list(keys), "left_anti")


def semi(df: DataFrame, keyset: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Rows of ``df`` whose key occurs in ``keyset`` (made distinct inside each task first)."""
    return df.join(keyset.select(*keys).distinct(), list(keys), "left_semi")


def exists_flag(df: DataFrame, other: DataFrame, keys: Sequence[str], name: str) -> DataFrame:
    """``Y`` where a partner exists, else ``N``; the row count stays."""
    found = other.select(*keys).distinct().withColumn("__found", F.lit(True))
    return (
        df.join(found, list(keys), "left")
        .withColumn(name, F.when(F.col("__found"), "Y").otherwise("N"))
        .drop("__found")
    )


def interval_join(df: DataFrame, date: str, periods: DataFrame, begin: str, end: str) -> DataFrame:
    """Left join to the period that holds the date.

    Periods (begin and end included) do not overlap.  They reach the rows as one
    sorted list, beside a list with the place of the last period begun by each day from
    the first begin to the last: the day's number finds the place, and the end of the
    period there decides.  The rows are not shuffled and not widened.  Both lists are
    scalars computed once; the calendar bounds them (one number a day, one entry a period).
    A period without a begin or an end, or with an end before its begin, holds nothing.
    """
    fields = [c for c in periods.columns if c not in (begin, end)]
    held = periods.where(F.col(begin) <= F.col(end)).select(
        F.struct(F.col(begin).cast("date").alias("__begin"), F.col(end).cast("date").alias("__end"), *(F.col(f"`{c}`") for c in fields)).alias("p")
    )
    length = "coalesce(datediff(get(rows, i + 1).__begin, rows[i].__begin), 1)"
    listed = held.agg(F.array_sort(F.collect_set("p")).alias("rows")).where(F.size("rows") > 0)
    places = F.expr(f"flatten(transform(sequence(0, size(rows) - 1), i -> array_repeat(i, {length})))")
    found = listed.select(F.struct("rows", places.alias("places"))).scalar()
    rows, places = found["rows"], found["places"]
    day = F.col(date).cast("date")
    place = F.get(places, F.least(F.datediff(day, F.get(rows, F.lit(0))["__begin"]), F.size(places) - 1))
    dated = df.withColumn("__period", F.get(rows, place))
    inside = F.col("__period")["__end"] >= day
    return dated.withColumns({c: F.when(inside, F.col("__period")[c]) for c in fields}).drop("__period")


def lookup_default(
    df: DataFrame, dim: DataFrame, code: str, specific: Column, dim_specific: str, value: str, name: str, blank: str = ""
) -> DataFrame:
    """Value for (code, specific), else the value for (code, blank).

    The first value of a repeated (code, specific value) counts.
    """
    key = F.trim(F.coalesce(F.col(dim_specific), F.lit(blank)))
    rows = dedup_by_priority(dim.select(F.col(code), key.alias("__spec"), F.col(value).alias("__value")), [code, "__spec"], [])
    exact = rows.where(F.col("__spec") != blank).withColumnRenamed("__value", "__exact")
    general = rows.where(F.col("__spec") == blank).drop("__spec").withColumnRenamed("__value", "__general")
    return (
        df.withColumn("__spec", F.trim(specific))
        .join(exact, [code, "__spec"], "left")
        .join(general, [code], "left")
        .withColumn(name, F.coalesce("__exact", "__general"))
        .drop("__spec", "__exact", "__general")
    )


def best_match(
    df: DataFrame,
    dim: DataFrame,
    group: Sequence[str],
    exact: Sequence[str],
    order: Sequence[Column | str],
    prefix: str,
) -> DataFrame:
    """The dimension row of the same group that also agrees on ``exact``, else the group's first row.

    Both tiers are reduced to one row per key first, so no group is ever
    multiplied out: the result equals ranking all pairs of a group.
    """
    group, exact = list(group), list(exact)
    full = prefixed(dedup_by_priority(dim, group + exact, order), "__x_", group + exact)
    rest = prefixed(dedup_by_priority(dim, group, order), "__r_", group)
    # by the group first: the rows then lie right for the finer key as well
    joined = df.join(rest, group, "left").join(full.withColumn("__hit", F.lit(True)), group + exact, "left")
    extra = [c for c in dim.columns if c not in group]
    chosen = [
        F.when(F.col("__hit"), F.col(c) if c in exact else F.col(f"__x_{c}")).otherwise(F.col(f"__r_{c}")).alias(prefix + c)
        for c in extra
    ]
    return joined.select(*df.columns, *chosen)


def pick_one(df: DataFrame, other: DataFrame, keys: Sequence[str], order: Sequence[Column | str]) -> DataFrame:
    """Left join to one related row per key, chosen by a total order before the join."""
    return df.join(dedup_by_priority(other, keys, order), list(keys), "left")


def alternative_detail(primary: DataFrame, fallback: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Detail rows of the primary table; keys it lacks take theirs from the fallback table.

    Both tables have the same columns.
    """
    missing = fallback.join(primary.select(*keys).distinct(), list(keys), "left_anti")
    return primary.unionByName(missing)


def override(df: DataFrame, winner: str, columns: Mapping[str, tuple[str, str]]) -> DataFrame:
    """Per new column: the first source where ``winner`` is present, else the second."""
    present = F.col(winner).isNotNull()
    return df.withColumns({name: F.when(present, F.col(a)).otherwise(F.col(b)) for name, (a, b) in columns.items()})


def hot_keys(df: DataFrame, keys: Sequence[str], rows: int) -> DataFrame:
    """Keys with more than ``rows`` rows: at most ``count / rows`` of them, whatever the data."""
    return df.groupBy(*keys).count().where(F.col("count") > rows).select(*keys)


def salted_join(
    fact: DataFrame,
    dim: DataFrame,
    keys: Sequence[str],
    how: str = "left",
    rows_per_task: int = 5_000_000,
    salts: int = 256,
) -> DataFrame:
    """Inner or left join that spreads hot fact keys over ``salts`` tasks.

    Only the dimension rows of hot keys are repeated.  Plain joins rely on
    adaptive skew handling; this one is for keys known to be extreme, or where
    the join is followed by work on the same key in the same stage.
    """
    if how not in ("inner", "left"):
        raise ValueError("salting needs an inner or left join")
    keys = list(keys)
    hot = F.broadcast(hot_keys(fact, keys, rows_per_task).withColumn("__hot", F.lit(True)))
    spread = F.pmod(F.xxhash64(*(F.col(f"`{c}`") for c in fact.columns)), F.lit(salts)).cast("int")
    left = (
        fact.join(hot, keys, "left")
        .withColumn("__salt", F.when(F.col("__hot"), spread).otherwise(F.lit(0)))
        .drop("__hot")
    )
    every = F.sequence(F.lit(0), F.lit(salts - 1))
    right = (
        dim.join(hot, keys, "left")
        .withColumn("__salt", F.explode(F.when(F.col("__hot"), every).otherwise(F.array(F.lit(0)))))
        .drop("__hot")
    )
    return left.join(right, keys + ["__salt"], how).drop("__salt")
