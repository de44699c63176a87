"""Old-versus-new comparison of tables."""

from __future__ import annotations

import datetime as dt
import uuid
from collections.abc import Callable, Mapping, Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, Observation, SparkSession, Window
from pyspark.sql import functions as F

from ledgermill.operators.joins import full_reconcile
from ledgermill.operators.quality import duplicate_keys
from ledgermill.sources.tables import write_table


def reconcile(
    old: DataFrame,
    new: DataFrame,
    dims: Mapping[str, Column],
    measures: Mapping[str, str],
    scale: Mapping[str, int] | None = None,
    null_safe: bool = True,
) -> DataFrame:
    """Sums of both tables by the same dimensions, their difference and MATCH/MISMATCH.

    ``measures`` maps a name to a column; ``scale`` names the decimals a measure
    is rounded to before the comparison (none: compared exactly).
    """
    keys = list(dims)

    def totals(df: DataFrame, side: str) -> DataFrame:
        grouped = df.groupBy(*(expr.alias(k) for k, expr in dims.items()))
        return grouped.agg(*(F.sum(column).alias(f"{side}_{m}") for m, column in measures.items()))

    merged = full_reconcile(totals(old, "old"), totals(new, "new"), keys, null_safe)
    filled = merged.withColumns(
        {f"{s}_{m}": F.coalesce(F.col(f"{s}_{m}"), F.lit(0)) for s in ("old", "new") for m in measures}
    )

    def same(measure: str) -> Column:
        a, b = F.col(f"old_{measure}"), F.col(f"new_{measure}")
        digits = (scale or {}).get(measure)
        return a == b if digits is None else F.round(a, digits) == F.round(b, digits)

    agree = reduce(lambda x, y: x & y, (same(m) for m in measures))
    return filled.select(
        *keys,
        *(c for m in measures for c in (
            F.col(f"old_{m}"), F.col(f"new_{m}"), (F.col(f"new_{m}") - F.col(f"old_{m}")).alias(f"delta_{m}")
        )),
        F.when(agree, "MATCH").otherwise("MISMATCH").alias("status"),
    )


def _differs(old: Column, new: Column, kind: str, tolerance: float, strict: bool) -> Column:
    if strict:
        one_missing = old.isNull() != new.isNull()
    else:
        one_missing = F.lit(False)
    if kind == "number":
        zero = F.lit(0.0)
        gap = F.abs(F.coalesce(old.cast("double"), zero) - F.coalesce(new.cast("double"), zero)) > tolerance
    elif kind == "timestamp":
        gap = F.coalesce(old.cast("string"), F.lit("")) != F.coalesce(new.cast("string"), F.lit(""))
    elif kind == "text":
        gap = F.upper(F.trim(F.coalesce(old.cast("string"), F.lit("")))) != F.upper(
            F.trim(F.coalesce(new.cast("string"), F.lit("")))
        )
    else:
        raise ValueError(f"unknown kind {kind!r}")
    return one_missing | gap


def cell_diff(
    old: DataFrame,
    new: DataFrame,
    keys: Sequence[str],
    fields: Mapping[str, tuple[str, str]],
    tolerance: float = 0.01,
    strict: bool = False,
) -> DataFrame:
    """One row per differing cell, and one per row that only one side has.

    ``fields`` maps an old column to (new column, kind), kind being ``number``,
    ``text`` or ``timestamp``.  A null equals zero or blank unless ``strict``.
    Keys are trimmed.  Every row of a repeated key is compared: equal rows of both
    sides are counted and cancelled first, those left are paired by their place in
    the order of their values within the key, and surplus rows are missing on the
    other side.  Both sides meet in one aggregation and one join, and the cells are
    unfolded from the joined row, whatever the number of fields.
    """
    keys = list(keys)
    values = [f"v{i}" for i in range(len(fields))]

    def side(df: DataFrame, columns: Sequence[str], sign: int) -> DataFrame:
        return df.select(
            *(F.trim(F.col(k).cast("string")).alias(k) for k in keys),
            *(F.col(c).cast("string").alias(v) for c, v in zip(columns, values)),
            F.lit(sign).alias("sign"),
        )

    both_sides = side(old, list(fields), 1).unionByName(side(new, [n for n, _ in fields.values()], -1))
    left = both_sides.groupBy(*keys, *values).agg(F.sum("sign").alias("surplus")).where("surplus <> 0")
    rows = left.withColumn("copy", F.explode(F.sequence(F.lit(1), F.abs("surplus"))))
    within = Window.partitionBy(*keys, F.signum("surplus")).orderBy(*values, "copy")
    rows = rows.withColumn("place", F.row_number().over(within))

    def named(sign: str, prefix: str) -> DataFrame:
        picked = rows.where(f"surplus {sign} 0")
        return picked.select(
            *keys, "place", *(F.col(v).alias(f"{prefix}{i}") for i, v in enumerate(values)), F.lit(True).alias(f"{prefix}here")
        )

    joined = full_reconcile(named(">", "o_"), named("<", "n_"), [*keys, "place"])
    both = F.col("o_here").isNotNull() & F.col("n_here").isNotNull()
    text = "string"

    def cell(issue: str, old_name, new_name, old_value: Column, new_value: Column, when: Column) -> Column:
        return F.when(
            when,
            F.struct(
                F.lit(issue).alias("issue_type"),
                F.lit(old_name).cast(text).alias("old_column"),
                F.lit(new_name).cast(text).alias("new_column"),
                old_value.cast(text).alias("old_value"),
                new_value.cast(text).alias("new_value"),
            ),
        )

    cells = [
        cell(
            "VALUE_MISMATCH", o, n, F.col(f"o_{i}"), F.col(f"n_{i}"),
            both & _differs(F.col(f"o_{i}"), F.col(f"n_{i}"), kind, tolerance, strict),
        )
        for i, (o, (n, kind)) in enumerate(fields.items())
    ]
    present, missing = F.lit("ROW_PRESENT"), F.lit("ROW_MISSING")
    cells.append(cell("MISSING_IN_NEW", None, None, present, missing, F.col("n_here").isNull()))
    cells.append(cell("MISSING_IN_OLD", None, None, missing, present, F.col("o_here").isNull()))
    issues = F.filter(F.array(*cells), lambda c: c.isNotNull())
    return joined.select(*keys, F.inline(issues))


def duplicates(old: DataFrame, new: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Keys that occur more than once, by side."""
    return duplicate_keys(old, keys).withColumn("table_side", F.lit("OLD")).unionByName(
        duplicate_keys(new, keys).withColumn("table_side", F.lit("NEW"))
    )


def diff_summary(diff: DataFrame) -> DataFrame:
    return diff.groupBy("issue_type", "old_column", "new_column").agg(F.count(F.lit(1)).alias("issue_count"))


RUN_LOG = (
    "run_id string, run_time timestamp, old_table string, new_table string, old_row_count bigint, new_row_count bigint, "
    "detail_issue_count bigint, duplicate_key_count bigint, status string"
)


def run_log(
    spark: SparkSession,
    path: str,
    run_id: str,
    old: tuple[str, DataFrame],
    new: tuple[str, DataFrame],
    detail: Callable[[DataFrame, DataFrame], DataFrame],
    keys: Sequence[str],
    detail_path: str,
) -> DataFrame:
    """Compare two named tables, keep the differences at ``detail_path`` and the run in a log; gives the log.

    The rows of both sides and the differences are counted while the differences are
    written.  A run is one partition of the log: running it again under its id
    replaces its row and adds none.
    """
    seen = {name: Observation(f"{name}-{uuid.uuid4().hex}") for name in ("old", "new", "issues")}
    rows = F.count(F.lit(1)).alias("rows")
    issues = detail(old[1].observe(seen["old"], rows), new[1].observe(seen["new"], rows))
    write_table(issues.observe(seen["issues"], rows), detail_path)
    repeated = duplicates(old[1], new[1], keys).count()
    counts = [seen[name].get["rows"] for name in ("old", "new", "issues")]
    status = "MATCH" if not counts[2] and not repeated else "DIFFERENT"
    now = dt.datetime.now(dt.timezone.utc)
    row = spark.createDataFrame([(run_id, now, old[0], new[0], *counts, repeated, status)], RUN_LOG)
    row.write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy("run_id").parquet(path)
    return spark.read.schema(RUN_LOG).parquet(path)


def overlap_audit(lines: DataFrame, keys: Sequence[str], tag: str, active: str, archived: str) -> DataFrame:
    """How repeated keys of a tagged union spread over the two sources."""
    per_key = lines.groupBy(*keys).agg(
        F.count(F.lit(1)).alias("n"),
        F.count_if(F.col(tag) == active).alias("a"),
        F.count_if(F.col(tag) == archived).alias("p"),
    )
    a, p = F.col("a"), F.col("p")
    return per_key.where(F.col("n") > 1).agg(
        F.count(F.lit(1)).alias("duplicate_keys_total"),
        F.count_if((a > 0) & (p > 0)).alias("keys_in_both"),
        F.count_if((a > 1) & (p == 0)).alias("keys_duplicated_within_active"),
        F.count_if((p > 1) & (a == 0)).alias("keys_duplicated_within_perm"),
    )


def filter_funnel(
    df: DataFrame, stages: Sequence[tuple[str, Column | None]], measures: Mapping[str, Column], distinct: Mapping[str, str]
) -> DataFrame:
    """Measures after each of several filters that build on one another, in one scan.

    A row carries the number of the last stage it passes.  Sums are taken per
    number and then run from the last stage to the first; a distinct key counts
    at the greatest number of its rows.  No row is copied.  ``measures`` map a name
    to the column that is summed.
    """
    passed = F.lit(True)
    last = F.lit(-1)
    for number, (_, condition) in enumerate(stages):
        if condition is not None:
            passed = passed & F.coalesce(condition, F.lit(False))
        last = F.when(passed, number).otherwise(last)
    staged = df.withColumn("__last", last).where("__last >= 0")
    sums = staged.groupBy("__last").agg(
        F.count(F.lit(1)).alias("total_line_items"), *(F.sum(expr).alias(n) for n, expr in measures.items())
    )
    names = F.create_map(*(F.lit(x) for number, (name, _) in enumerate(stages) for x in (number, name)))
    steps = F.explode(F.sequence(F.lit(0), F.col("__last"))).alias("__stage")
    # from here on one row per stage and number
    running = sums.select(steps, *sums.columns[1:]).groupBy("__stage").agg(*(F.sum(c).alias(c) for c in sums.columns[1:]))
    for name, column in distinct.items():
        best = staged.where(F.col(column).isNotNull()).groupBy(column).agg(F.max("__last").alias("__last"))
        counted = best.groupBy("__last").agg(F.count(F.lit(1)).alias(name)).select(steps, name)
        running = running.join(counted.groupBy("__stage").agg(F.sum(name).alias(name)), "__stage", "left")
    ordered = [*distinct, "total_line_items", *measures]
    return running.select(
        names[F.col("__stage")].alias("stage"), *(F.coalesce(c, F.lit(0)).alias(c) if c in distinct else F.col(c) for c in ordered)
    )
