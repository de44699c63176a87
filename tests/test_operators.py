import datetime as dt
import random

import pytest
from pyspark.errors import AnalysisException
from pyspark.sql import functions as F

from ledgermill.operators import quality as q
from ledgermill.operators.aggregates import listagg, pivot_attrs, rank_to_columns, share_of_total
from ledgermill.operators.dedup import dedup_by_priority, latest, one_per, prefer, without_replays
from ledgermill.operators.filters import apply_params, effective, not_deleted, unexpired
from ledgermill.operators.joins import (
    alternative_detail, best_match, enrich, full_reconcile, interval_join, lookup_default, orphans, salted_join, spread_blank,
)
from ledgermill.operators.profile import profile
from ledgermill.operators.quality import KeySuite
from ledgermill.operators.reconcile import cell_diff, duplicates, filter_funnel, reconcile, run_log
from ledgermill.plans.inventory import primary_location_flag, secondary_location_list
from ledgermill.session import own_folders
from ledgermill.sources.tables import conform, tagged_union


def rows(df, *cols):
    return sorted((tuple(r) for r in (df.select(*cols) if cols else df).collect()), key=repr)


def test_active_row_beats_archived_one(spark):
    active = spark.createDataFrame([(1, "a"), (2, "b")], "k int, v string")
    archived = spark.createDataFrame([(2, "old"), (3, "c")], "k int, v string")
    both = tagged_union({"ACTIVE": active, "PERM": archived}, "src")
    got = dedup_by_priority(both, ["k"], [prefer(F.col("src") == "ACTIVE")])
    assert rows(got, "k", "v", "src") == [(1, "a", "ACTIVE"), (2, "b", "ACTIVE"), (3, "c", "PERM")]


def test_latest_puts_missing_order_values_last_and_breaks_ties(spark):
    df = spark.createDataFrame([(1, None, "n"), (1, 5, "z"), (1, 5, "a"), (2, None, "only")], "k int, rowid int, v string")
    assert rows(latest(df, ["k"], ["rowid"])) == [(1, 5, "a"), (2, None, "only")]


def test_hot_key_is_cut_before_the_shuffle(spark):
    df = spark.range(10000).select(F.when(F.col("id") < 4000, 0).otherwise(F.col("id")).alias("k"), "id")
    picked = latest(df, ["k"], ["id"])
    plan = picked._jdf.queryExecution().executedPlan().toString()
    assert "WindowGroupLimit" in plan.split("Exchange hashpartitioning")[1]
    assert picked.where("k = 0").first().id == 3999 and picked.count() == 6001


def test_deleted_and_validity_filters(spark):
    df = spark.createDataFrame([("D",), ("",), (None,)], "flag_del string")
    assert rows(not_deleted(df)) == [("",), (None,)]
    day = dt.date(2001, 1, 1)
    spans = spark.createDataFrame(
        [(1, None, None), (2, day, None), (3, None, day), (4, dt.date(2002, 1, 1), None), (5, None, dt.date(2000, 1, 1))],
        "i int, s date, e date",
    )
    assert rows(effective(spans, "s", "e", day), "i") == [(1,), (2,), (3,)]
    assert rows(unexpired(spans, "e", dt.date(2000, 6, 1)), "i") == [(3,)]


def test_unset_report_parameters_do_not_restrict(spark):
    df = spark.createDataFrame([(1, "a"), (2, "b"), (3, None)], "n int, s string")
    fields = {"low": ("n", ">="), "codes": ("s", "in")}
    assert apply_params(df, {"low": None, "codes": None}, fields).count() == 3
    assert rows(apply_params(df, {"low": 2, "codes": ["b"]}, fields)) == [(2, "b")]
    with pytest.raises(ValueError):
        apply_params(df, {"typo": 1}, fields)


def test_best_match_equals_ranking_all_pairs(spark):
    rng = random.Random(3)
    lines = [(i, f"c{rng.randrange(6)}", rng.randrange(5)) for i in range(60)]
    ships = sorted({(f"c{rng.randrange(5)}", rng.randrange(4)) for _ in range(14)})
    left = spark.createDataFrame(lines, "i int, cust string, ship int")
    right = spark.createDataFrame([(c, s, f"{c}/{s}") for c, s in ships], "cust string, ship int, name string")
    got = {r.i: r.m_name for r in best_match(left, right, ["cust"], ["ship"], ["ship"], "m_").collect()}
    for i, cust, ship in lines:
        offers = sorted((s != ship, s) for c, s in ships if c == cust)
        assert got[i] == (f"{cust}/{offers[0][1]}" if offers else None)


def test_salted_join_keeps_every_row_of_a_hot_key(spark):
    fact = spark.range(3000).select(F.when(F.col("id") % 3 == 0, 7).otherwise(F.col("id")).alias("k"), "id")
    dim = spark.createDataFrame([(k, f"n{k}") for k in range(0, 3000, 2)] + [(7, "hot")], "k long, name string")
    for how in ("inner", "left"):
        plain = fact.join(dim, "k", how)
        assert rows(salted_join(fact, dim, ["k"], how, rows_per_task=100, salts=5), "k", "id", "name") == rows(plain, "k", "id", "name")


def test_null_dimensions_meet_only_when_null_safe(spark):
    a = spark.createDataFrame([(None, 1), ("x", 2)], "k string, a int")
    b = spark.createDataFrame([(None, 3), ("y", 4)], "k string, b int")
    assert rows(full_reconcile(a, b, ["k"])) == sorted([(None, 1, 3), ("x", 2, None), ("y", None, 4)], key=repr)
    assert full_reconcile(a, b, ["k"], null_safe=False).count() == 4


def test_reconcile_status(spark):
    old = spark.createDataFrame([("a", 1.001, 1), (None, 5.0, 2)], "d string, amount double, n int")
    new = spark.createDataFrame([("a", 1.0, 1), (None, 6.0, 2)], "d string, amount double, n int")
    got = reconcile(old, new, {"d": F.col("d")}, {"sales": "amount", "n": "n"}, {"sales": 2})
    assert rows(got, "d", "status") == [("a", "MATCH"), (None, "MISMATCH")]


def test_interval_and_two_tier_lookup(spark):
    periods = spark.createDataFrame([(dt.date(2001, 1, 1), dt.date(2001, 1, 31), "p1")], "b date, e date, p string")
    df = spark.createDataFrame([(1, dt.date(2001, 1, 31)), (2, dt.date(2001, 2, 1)), (3, None)], "i int, d date")
    assert rows(interval_join(df, "d", periods, "b", "e"), "i", "p") == [(1, "p1"), (2, None), (3, None)]
    dim = spark.createDataFrame([("05", "DS", "spec"), ("05", " ", "gen"), ("06", None, "gen6")], "code string, t string, descr string")
    lines = spark.createDataFrame([(1, "05", "DS"), (2, "05", "EU"), (3, "06", None), (4, "09", "DS")], "i int, code string, cust string")
    got = lookup_default(lines, dim, "code", F.col("cust"), "t", "descr", "name")
    assert rows(got, "i", "name") == [(1, "spec"), (2, "gen"), (3, "gen6"), (4, None)]


def test_alternative_detail_and_orphans(spark):
    item = spark.createDataFrame([("a", 1), ("a", 2)], "po string, n int")
    other = spark.createDataFrame([("a", 9), ("b", 3)], "po string, n int")
    assert rows(alternative_detail(item, other, ["po"])) == [("a", 1), ("a", 2), ("b", 3)]
    assert rows(orphans(other, item, ["po"])) == [("b", 3)]


def test_pivot_default_and_ordered_lists(spark):
    df = spark.createDataFrame([(1, "C", "red"), (1, "S", "9"), (2, None, None)], "k int, a string, v string")
    assert rows(pivot_attrs(df, ["k"], "a", "v", {"C": "c", "S": "s"})) == [(1, "red", "9"), (2, "", "")]
    lists = listagg(spark.createDataFrame([(1, "b"), (1, None), (1, "a"), (2, None)], "k int, v string"), ["k"], "v", "l")
    assert rows(lists) == [(1, "a, b")]


def test_rank_to_columns_and_share(spark):
    df = spark.createDataFrame([(1, "v1", "S"), (1, "v2", "P"), (1, "v3", "S"), (2, "v9", "S")], "k int, v string, f string")
    got = rank_to_columns(df, ["k"], [prefer(F.col("f") == "P"), "v"], ["v"], ["primary", "secondary"])
    assert rows(got) == [(1, "v2", "v1"), (2, "v9", None)]
    assert sorted(r.value_pct for r in share_of_total(df, "f").collect()) == [25.0, 75.0]


def test_primary_location_golden_rows(spark):
    data = [("A", "10", "M", "Y"), ("A", "20", "M", "N"), ("B", "20", "M", "Y"), ("C", "10", "P", "N"), ("D", "90", "M", "Y")]
    df = spark.createDataFrame(data, "id_item string, id_loc string, flag_source string, want string")
    home = df.where((F.col("flag_source") == "M") & (F.col("id_loc") == "10"))
    for r in primary_location_flag(df, home).collect():
        assert r.primary_location_flag == r.want


def test_secondary_location_golden_rows(spark):
    data = [("A", "10", "CLE", "20, 50"), ("A", "20", "CLE", "20, 50"), ("A", "50", "CLE", "20, 50"),
            ("B", "20", "CHI", None), ("C", "10", "CLE", "90"), ("C", "90", "CLE", "90")]
    df = spark.createDataFrame(data, "id_item string, id_loc string, primary_source string, want string")
    got = secondary_location_list(df).collect()
    assert len(got) == 6 and all(r.secondary_location_list == r.want for r in got)


def test_cell_diff_null_rules_and_duplicates(spark):
    old = spark.createDataFrame([(" 1", 0.0, "a"), ("2", 1.0, "B "), ("3", 1.0, "x"), ("4", 1.0, "q"), ("4", 2.0, "q")], "k string, n double, t string")
    new = spark.createDataFrame([("1", None, "A"), ("2", 1.5, "b"), ("5", 1.0, "x"), ("4", 1.0, "q")], "k string, n double, t string")
    fields = {"n": ("n", "number"), "t": ("t", "text")}
    got = cell_diff(old, new, ["k"], fields)
    assert rows(got, "k", "issue_type", "old_column") == [
        ("2", "VALUE_MISMATCH", "n"), ("3", "MISSING_IN_NEW", None), ("4", "MISSING_IN_NEW", None), ("5", "MISSING_IN_OLD", None)
    ]
    strict = cell_diff(old, new, ["k"], fields, strict=True)
    assert ("1", "VALUE_MISMATCH", "n") in rows(strict, "k", "issue_type", "old_column")
    assert rows(duplicates(old, new, ["k"])) == [("4", 2, "OLD")]


def test_funnel_counts_every_stage(spark):
    df = spark.createDataFrame([(1, 5, 1.0), (1, 0, 2.0), (2, 7, 4.0), (3, None, 8.0)], "o int, q int, v double")
    got = filter_funnel(df, [("1", None), ("2", F.col("q") > 0), ("3", F.col("q") > 6)], {"v": F.col("v")}, {"orders": "o"})
    assert rows(got, "stage", "orders", "total_line_items", "v") == [("1", 3, 4, 15.0), ("2", 2, 2, 5.0), ("3", 1, 1, 4.0)]


def test_checks(spark):
    df = spark.createDataFrame([("a", 1), (" ", 1), (None, 2), ("b", 3), ("b", 3)], "k string, n int")
    parent = spark.createDataFrame([("a",), ("z",)], "k string")
    suite = q.run_checks([
        q.check_null_keys(df, ["k"], "nulls"), q.check_duplicates(df, ["k"], "dups"), q.check_orphans(df, parent, ["k"], "orphans"),
        q.check_key_counts(df, parent, ["k"], "counts"), q.check_line_counts(df, ["k"], 1, "lines"),
        q.check_domain(df, "k", ["a", "b"], "domain"), q.check_negative(df, ["n"], "neg"), q.check_rows_exist(df, "rows"),
        q.check_coverage(df, parent, ["k"], 50, "cover"), q.check_single_value(df, ["k"], "n", "single"),
    ])
    assert {r.test_id: (r.failed_rows, r.status) for r in suite.collect()} == {
        "nulls": (2, "FAIL"), "dups": (1, "FAIL"), "orphans": (1, "FAIL"), "counts": (0, "PASS"), "lines": (1, "FAIL"),
        "domain": (2, "FAIL"), "neg": (0, "PASS"), "rows": (0, "PASS"), "cover": (1, "FAIL"), "single": (0, "PASS"),
    }


def test_profile_blank_counts_as_null(spark):
    df = spark.createDataFrame([("a", 1), ("a", 2), (" ", None), ("bb", 4)], "t string, n int")
    got = {r.column_name: r for r in profile(df).collect()}
    assert (got["t"].distinct_count, got["t"].null_pct, got["t"].min_length, got["t"].max_length) == (2, 25.0, 1, 2)
    assert got["t"].value_composition == "a (2, 66.67%) | bb (1, 33.33%)"
    assert (got["n"].min_value, got["n"].max_value, got["n"].data_type) == ("1", "4", "NUMBER(38,0)")
    assert sorted(got["n"].sample_values.split(", ")) == ["1", "2", "4"]


def test_conform_rejects_missing_columns(spark):
    df = spark.createDataFrame([(1, "2")], "a int, b string")
    assert conform(df, "b decimal(5,1), a bigint").dtypes == [("b", "decimal(5,1)"), ("a", "bigint")]
    with pytest.raises(ValueError):
        conform(df, "c int")


def test_hot_join_partition_is_split_even_before_a_window(spark):
    settings = {
        "spark.sql.autoBroadcastJoinThreshold": "-1", "spark.sql.adaptive.autoBroadcastJoinThreshold": "-1",
        "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "20KB",
        "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "1.5", "spark.sql.adaptive.advisoryPartitionSizeInBytes": "20KB",
    }
    before = {k: spark.conf.get(k, None) for k in settings}
    for key, value in settings.items():
        spark.conf.set(key, value)
    try:
        lines = spark.range(0, 60000, 1, 8).select(
            F.when(F.col("id") % 3 == 0, 5).otherwise(F.col("id")).alias("id_ord"), F.col("id").alias("line"),
            F.sha2(F.col("id").cast("string"), 256).alias("text"),
        )
        heads = spark.range(0, 60000, 1, 8).select(F.col("id").alias("id_ord"), F.lit("h").alias("h"))
        picked = dedup_by_priority(lines.join(heads, "id_ord"), ["id_ord", "line"], ["text"])
        assert len(picked.collect()) == 60000
        assert "skew=true" in picked._jdf.queryExecution().executedPlan().toString()
    finally:
        for key, value in before.items():
            spark.conf.unset(key) if value is None else spark.conf.set(key, value)


def test_cell_diff_compares_every_row_of_a_repeated_key(spark):
    fields = {"v": ("w", "number")}

    def diff(old, new):
        a = spark.createDataFrame([("k", v) for v in old], "k string, v int")
        b = spark.createDataFrame([("k", v) for v in new], "k string, w int")
        return sorted((r.issue_type, r.old_value, r.new_value) for r in cell_diff(a, b, ["k"], fields).collect())

    assert diff([1, 5], [1, 9]) == [("VALUE_MISMATCH", "5", "9")]
    assert diff([1, 1, 5], [1, 5]) == [("MISSING_IN_NEW", "ROW_PRESENT", "ROW_MISSING")]
    assert diff([1, 1], [1, 1, 2, 3]) == [("MISSING_IN_OLD", "ROW_MISSING", "ROW_PRESENT")] * 2
    assert diff([5, 1, 1], [1, 5, 1]) == []


def test_dimensions_with_repeated_codes_do_not_multiply_facts(spark):
    facts = spark.createDataFrame([("A", 1), ("B", 2), ("C", 3)], "code string, n int")
    names = spark.createDataFrame([("A", "x"), ("A ", "w"), ("B", "y"), ("B", "y")], "code string, name string")
    got = sorted((r.code, r.name) for r in enrich(facts, (one_per(names, "code"), "code")).collect())
    assert got == [("A", "w"), ("B", "y"), ("C", None)]


def test_blank_keys_are_spread_and_match_nothing(spark):
    rows = spark.createDataFrame([(i, None if i % 3 else " ") for i in range(900)] + [(1000, " K1 ")], "i int, k string")
    spread = rows.withColumn("key", spread_blank("k", "i"))
    assert spread.select("key").distinct().count() > 500
    other = spark.createDataFrame([("K1", 1), ("", 2)], "key string, v int")
    assert [r.v for r in spread.join(other, "key", "left").where("v IS NOT NULL").collect()] == [1]


def test_row_hash_tells_contents_apart(spark):
    df = spark.createDataFrame(
        [("a", "b", None, 1), ("ab", "", None, 2), ("a", "b", "", 3), ("a", "b", None, 4), (None, "b", "a", 5), ("a", "b", None, 4)],
        "x string, y string, z string, version long",
    )
    kept = without_replays(df, "version")
    assert rows(kept, "first_version", "last_version", "copies") == [(1, 4, 3), (2, 2, 1), (3, 3, 1), (5, 5, 1)]
    assert without_replays(df.limit(0), "version").count() == 0


def test_a_run_is_logged_once(spark, tmp_path):
    old = spark.createDataFrame([(1, "a"), (2, "b"), (2, "c"), (3, "d")], "k long, v string")
    new = spark.createDataFrame([(1, "a"), (2, "x"), (2, "c")], "k long, v string")
    place = str(tmp_path)

    def go(run_id):
        return run_log(
            spark, f"{place}/log", run_id, ("old_t", old), ("new_t", new), lambda a, b: cell_diff(a, b, ["k"], {"v": ("v", "text")}), ["k"], f"{place}/detail",
        )

    go("r1")
    log = go("r1")
    assert rows(log, "run_id", "old_table", "new_table", "old_row_count", "new_row_count", "detail_issue_count", "duplicate_key_count", "status") == [
        ("r1", "old_t", "new_t", 4, 3, 2, 2, "DIFFERENT")
    ]
    assert go("r2").count() == 2 and spark.read.parquet(f"{place}/detail").count() == 2
    assert log.where("run_time IS NULL").count() == 0


def test_own_folders_go_also_after_an_error(spark):
    names = []
    with pytest.raises(ValueError), own_folders(spark) as folder:
        names.append(folder("trial"))
        spark.range(3).write.parquet(names[0])
        raise ValueError
    with pytest.raises(AnalysisException):
        spark.read.parquet(names[0])


def test_key_suite_counts(spark):
    a = spark.createDataFrame([("1 ", 1), ("1", 2), ("2", 3), (None, 4), ("", 5), (" ", 6)], "k string, n int")
    b = spark.createDataFrame([("1",), ("3",), ("4",)], "k string")
    suite = KeySuite({"a": a, "b": b}, ["k"], {"big": ("a", F.col("n") > 4)})
    suite.null_keys("a", "N").duplicates("a", "D").missing("b", "a", "M").key_counts("a", "b", "C").line_counts("a", 2, "L").rows_where("big", "R")
    assert {r.test_id: r.failed_rows for r in suite.results().collect()} == {"N": 3, "D": 1, "M": 2, "C": 1, "L": 0, "R": 2}
    empty = KeySuite({"a": a.limit(0), "b": b.limit(0)}, ["k"]).null_keys("a", "N").missing("a", "b", "M")
    assert [r.status for r in empty.results().collect()] == ["PASS", "PASS"]


def _moves(df) -> int:
    """Shuffles in the plan as first made."""
    return df._jdf.queryExecution().executedPlan().toString().count("Exchange hashpartitioning")


def _unbroadcast(spark, build):
    kept = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        return build()
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", kept)


def test_rows_by_order_serve_the_join_on_order_and_line(spark):
    rows = spark.createDataFrame([(1, 1, "a"), (1, 2, "b")], "o int, l int, x string")
    heads = spark.createDataFrame([(1, "h")], "o int, h string")
    notes = spark.createDataFrame([(1, 2, "n")], "o int, l int, n string")
    moved = _unbroadcast(spark, lambda: _moves(rows.join(heads, "o").join(notes, ["o", "l"], "left")))
    assert moved == 3


def test_text_list_of_a_condition_is_null_without_entries(spark):
    from ledgermill.operators.aggregates import text_list

    rows = spark.createDataFrame([(1, "b", True), (1, "a", True), (1, "c", False), (2, "d", False), (3, None, True)], "k int, x string, f boolean")
    found = rows.groupBy("k").agg(text_list("x", condition=F.col("f")).alias("t"))
    assert dict(found.collect()) == {1: "a, b", 2: None, 3: None}


def test_null_keys_are_spread_and_blank_ones_kept(spark):
    from ledgermill.operators.joins import spread_null

    rows = spark.createDataFrame([(i, None) for i in range(50)] + [(50, " "), (51, " A ")], "i int, k string")
    keys = [r.k for r in rows.select(spread_null("k", "i").alias("k"), "i").orderBy("i").collect()]
    assert keys[50:] == ["", "A"] and len(set(keys[:50])) > 40 and all(k.startswith("\0") for k in keys[:50])
