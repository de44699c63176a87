"""Data checks.

Every check is one result row ``(test_id, severity, failed_rows, status,
notes)``; a suite is the union of such rows.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, Observation
from pyspark.sql import functions as F

from ledgermill.functions.text import norm_key
from ledgermill.sources.tables import union_all

CHECK_COLUMNS = ["test_id", "severity", "failed_rows", "status", "notes"]


def result(counted: DataFrame, test_id: str, severity: str = "FAIL", notes: str = "") -> DataFrame:
    """Result row from a one-row frame with the column ``failed_rows``."""
    failed = F.coalesce(F.col("failed_rows"), F.lit(0)).cast("long")
    return counted.select(
        F.lit(test_id).alias("test_id"),
        F.lit(severity).alias("severity"),
        failed.alias("failed_rows"),
        F.when(failed == 0, "PASS").otherwise("FAIL").alias("status"),
        F.lit(notes).alias("notes"),
    )


def _missing(keys: Sequence[str]) -> Column:
    bad = norm_key(keys[0]) == ""
    for key in keys[1:]:
        bad = bad | (norm_key(key) == "")
    return bad


def with_keys(df: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Rows whose keys are all filled, keys normalised."""
    return df.where(~_missing(keys)).select(*(norm_key(k).alias(k) for k in keys))


def null_keys(df: DataFrame, keys: Sequence[str]) -> DataFrame:
    return df.where(_missing(keys))


def duplicate_keys(df: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Keys that occur more than once, with their row count."""
    return (
        with_keys(df, keys).groupBy(*keys).agg(F.count(F.lit(1)).alias("dup_cnt")).where(F.col("dup_cnt") > 1)
    )


def _count(df: DataFrame) -> DataFrame:
    return df.agg(F.count(F.lit(1)).alias("failed_rows"))


def check_null_keys(df: DataFrame, keys: Sequence[str], test_id: str, **kw) -> DataFrame:
    return result(df.agg(F.count_if(_missing(keys)).alias("failed_rows")), test_id, **kw)


def check_duplicates(df: DataFrame, keys: Sequence[str], test_id: str, **kw) -> DataFrame:
    return result(_count(duplicate_keys(df, keys)), test_id, **kw)


def check_orphans(child: DataFrame, parent: DataFrame, keys: Sequence[str], test_id: str, **kw) -> DataFrame:
    """Distinct child keys without a parent."""
    lost = with_keys(child, keys).distinct().join(with_keys(parent, keys), list(keys), "left_anti")
    return result(_count(lost), test_id, **kw)


def check_key_counts(source: DataFrame, target: DataFrame, keys: Sequence[str], test_id: str, **kw) -> DataFrame:
    """Absolute difference of the distinct key counts, both from one aggregation."""
    sides = union_all(
        [with_keys(df, keys).distinct().select(F.lit(side).alias("side")) for side, df in ((1, source), (-1, target))]
    )
    return result(sides.agg(F.abs(F.sum("side")).alias("failed_rows")), test_id, **kw)


def check_missing(source: DataFrame, target: DataFrame, keys: Sequence[str], test_id: str, **kw) -> DataFrame:
    """Keys of ``source`` that ``target`` lacks."""
    return check_orphans(source, target, keys, test_id, **kw)


def check_line_counts(df: DataFrame, keys: Sequence[str], limit: int, test_id: str, **kw) -> DataFrame:
    """Keys with more than ``limit`` rows."""
    lines = with_keys(df, keys).groupBy(*keys).count()
    kw.setdefault("severity", "WARN")
    return result(lines.agg(F.count_if(F.col("count") > limit).alias("failed_rows")), test_id, **kw)


def check_domain(df: DataFrame, column: str, allowed: Sequence[object], test_id: str, **kw) -> DataFrame:
    """Values outside the allowed set; null is outside."""
    bad = F.col(column).isNull() | ~F.col(column).isin(*allowed)
    return result(df.agg(F.count_if(bad).alias("failed_rows")), test_id, **kw)


def check_rule(df: DataFrame, broken: Column, test_id: str, **kw) -> DataFrame:
    """Rows that break a rule, e.g. a stored flag that differs from the rule's own result."""
    return result(df.agg(F.count_if(broken).alias("failed_rows")), test_id, **kw)


def check_rows_exist(df: DataFrame, test_id: str, **kw) -> DataFrame:
    """Fails (one failed row) on an empty table."""
    empty = F.when(F.count(F.lit(1)) > 0, 0).otherwise(1)
    return result(df.agg(empty.alias("failed_rows")), test_id, **kw)


def check_negative(df: DataFrame, columns: Sequence[str], test_id: str, **kw) -> DataFrame:
    """Rows with a negative quantity: counted, never filtered."""
    kw.setdefault("severity", "WARN")
    negative = F.least(*(F.coalesce(F.col(c), F.lit(0)) for c in columns)) < 0 if len(columns) > 1 else F.col(columns[0]) < 0
    return result(df.agg(F.count_if(negative).alias("failed_rows")), test_id, **kw)


def check_single_value(df: DataFrame, keys: Sequence[str], column: str, test_id: str, **kw) -> DataFrame:
    """Keys whose rows carry more than one value of a column that belongs to the key.

    Smallest and greatest value decide, which combines before the shuffle.
    """
    spread = df.groupBy(*keys).agg(F.min(column).alias("lo"), F.max(column).alias("hi"))
    return result(spread.agg(F.count_if(F.col("lo") != F.col("hi")).alias("failed_rows")), test_id, **kw)


def check_row_stability(before: DataFrame, after: DataFrame, test_id: str, **kw) -> DataFrame:
    """Rows gained or lost by a join that must keep the grain."""
    sides = before.select(F.lit(-1).alias("side")).unionByName(after.select(F.lit(1).alias("side")))
    return result(sides.agg(F.abs(F.sum("side")).alias("failed_rows")), test_id, **kw)


def check_coverage(
    df: DataFrame, other: DataFrame, keys: Sequence[str], threshold_pct: float, test_id: str, **kw
) -> DataFrame:
    """Warns (one failed row) where too few rows find a partner; notes carry nothing of the data."""
    found = other.select(*keys).distinct().withColumn("__found", F.lit(1))
    share = F.count("__found") * 100.0 / F.count(F.lit(1))
    kw.setdefault("severity", "WARN")
    return result(
        df.join(found, list(keys), "left").agg(F.when(share < threshold_pct, 1).otherwise(0).alias("failed_rows")),
        test_id, **kw,
    )


def coverage(df: DataFrame, other: DataFrame, keys: Sequence[str], name: str) -> DataFrame:
    """Matched rows, all rows and the percentage."""
    found = other.select(*keys).distinct().withColumn("__found", F.lit(1))
    return df.join(found, list(keys), "left").agg(
        F.lit(name).alias("source"),
        F.count("__found").alias("matched_rows"),
        F.count(F.lit(1)).alias("total_rows"),
        F.round(F.count("__found") * 100.0 / F.count(F.lit(1)), 2).alias("match_pct"),
    )


def field_mismatches(df: DataFrame, pairs: Mapping[str, tuple[str, str, object]]) -> DataFrame:
    """One row of mismatch counters: per name (left column, right column, value that stands for null)."""
    return df.agg(
        *(
            F.count_if(F.coalesce(F.col(a), F.lit(null)) != F.coalesce(F.col(b), F.lit(null))).alias(name)
            for name, (a, b, null) in pairs.items()
        )
    )


def run_checks(checks: Sequence[DataFrame]) -> DataFrame:
    """Dashboard of a suite."""
    return union_all([c.select(*CHECK_COLUMNS) for c in checks])


class KeySuite:
    """Checks that compare the keys of several tables, from one pass over each of them.

    The tables' keys meet in one grouped count (which combines before the shuffle, also
    for rows without keys), and every check is an aggregate over the groups: rows
    without keys, repeated and long keys, keys of one table that another lacks.  ``rows``
    maps further counters to (table, condition on its rows).
    """

    def __init__(self, tables: Mapping[str, DataFrame], keys: Sequence[str], rows: Mapping[str, tuple[str, Column]] | None = None):
        self._tables, self._keys, self._rows = tables, list(keys), rows or {}
        self._checks: list[tuple[str, str, str, Column]] = []

    def _add(self, failed: Column, test_id: str, severity: str, notes: str) -> KeySuite:
        self._checks.append((test_id, severity, notes, failed))
        return self

    def null_keys(self, table: str, test_id: str, severity: str = "FAIL", notes: str = "") -> KeySuite:
        return self._add(F.sum(F.when(~F.col("__keyed"), F.col(f"n_{table}"))), test_id, severity, notes)

    def duplicates(self, table: str, test_id: str, severity: str = "FAIL", notes: str = "") -> KeySuite:
        return self.line_counts(table, 1, test_id, severity, notes)

    def line_counts(self, table: str, limit: int, test_id: str, severity: str = "WARN", notes: str = "") -> KeySuite:
        """Keys with more than ``limit`` rows."""
        return self._add(F.count_if(F.col("__keyed") & (F.col(f"n_{table}") > limit)), test_id, severity, notes)

    def missing(self, table: str, other: str, test_id: str, severity: str = "FAIL", notes: str = "") -> KeySuite:
        """Keys of a table that another lacks."""
        lost = F.col("__keyed") & (F.col(f"n_{table}") > 0) & (F.col(f"n_{other}") == 0)
        return self._add(F.count_if(lost), test_id, severity, notes)

    def key_counts(self, table: str, other: str, test_id: str, severity: str = "FAIL", notes: str = "") -> KeySuite:
        """Absolute difference of the distinct key counts."""
        a, b = (F.count_if(F.col("__keyed") & (F.col(f"n_{t}") > 0)) for t in (table, other))
        return self._add(F.abs(a - b), test_id, severity, notes)

    def rows_where(self, counter: str, test_id: str, severity: str = "FAIL", notes: str = "") -> KeySuite:
        return self._add(F.sum(f"n_{counter}"), test_id, severity, notes)

    def groups(self) -> DataFrame:
        """A row per key (and one for rows without keys), with its number of rows in each table."""
        names = [*self._tables, *self._rows]

        def marks(table: str) -> list[Column]:
            own = [F.lit(int(t == table)).alias(f"n_{t}") for t in self._tables]
            return own + [
                (F.when(bad, 1).otherwise(0) if of == table else F.lit(0)).alias(f"n_{name}") for name, (of, bad) in self._rows.items()
            ]

        keyed = ~_missing(self._keys)
        parts = [
            df.select(keyed.alias("__keyed"), *(F.when(keyed, norm_key(k)).alias(k) for k in self._keys), *marks(table))
            for table, df in self._tables.items()
        ]
        groups = union_all(parts).groupBy("__keyed", *self._keys).agg(*(F.sum(f"n_{n}").alias(f"n_{n}") for n in names))
        return groups

    def facts(self, metrics: Mapping[str, Column]) -> DataFrame:
        """One row of aggregates over the groups, missing ones as zero."""
        return self.groups().agg(*(F.coalesce(metric, F.lit(0)).cast("long").alias(name) for name, metric in metrics.items()))

    def results(self) -> DataFrame:
        counted = self.facts({f"c{i}": failed for i, (*_, failed) in enumerate(self._checks)})
        cells = F.array(*(
            F.struct(
                F.lit(test_id).alias("test_id"), F.lit(severity).alias("severity"), F.col(f"c{i}").alias("failed_rows"),
                F.when(F.col(f"c{i}") == 0, "PASS").otherwise("FAIL").alias("status"), F.lit(notes).alias("notes"),
            )
            for i, (test_id, severity, notes, _) in enumerate(self._checks)
        ))
        return counted.select(F.inline(cells))


MEASURED = [
    "test_id", "test_name", "test_category", "severity", "status", "expected_value", "actual_value", "variance", "detail",
    "pipeline_name", "run_time",
]


def measured_checks(
    facts: DataFrame, checks: Sequence[tuple[str, str, str, str, str]], category: str, detail: str, pipeline: str
) -> DataFrame:
    """Result rows with expected and measured value, their variance, the tables checked and the time of the run.

    ``facts`` is one row of measured numbers; a check is (id, name, severity, expected,
    fact).  What is expected is a number, or ``>n`` for more than that.
    """
    def cell(test_id: str, name: str, severity: str, expected: str, fact: str) -> Column:
        actual = F.col(fact)
        bound = int(expected.removeprefix(">"))
        passed = actual > bound if expected.startswith(">") else actual == bound
        values = (
            F.lit(test_id), F.lit(name), F.lit(category), F.lit(severity), F.when(passed, "PASS").otherwise("FAIL"), F.lit(expected),
            actual.cast("string"), F.when(passed, "").otherwise((actual - bound).cast("string")), F.lit(detail), F.lit(pipeline),
            F.current_timestamp(),
        )
        return F.struct(*(v.alias(n) for n, v in zip(MEASURED, values, strict=True)))

    return facts.select(F.inline(F.array(*(cell(*check) for check in checks))))


def observed(df: DataFrame, step: str) -> tuple[DataFrame, Observation]:
    """Count the rows of a step while some later action runs; no pass of its own."""
    observation = Observation(step)
    return df.observe(observation, F.count(F.lit(1)).alias("rows")), observation
