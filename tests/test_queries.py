"""Every registered query against its independent SQL statement, and the shape of the plans."""

import re

import pytest
from compare import compare, database

from ledgermill.checks import statements
from ledgermill.operators.joins import interval_join
from ledgermill.queries import REGISTRY as QUERIES
from ledgermill.sources.erp import TABLES, Captures

SMALL = "/root/testdata/sf0.001"
CHECKS = statements()  # of this library's own queries; those of parts that can be taken out have tests of their own


def plan(df) -> str:
    return df._jdf.queryExecution().executedPlan().toString()


@pytest.fixture(scope="module")
def duck():
    return database(SMALL)


def test_every_query_has_a_check():
    assert set(QUERIES) == set(CHECKS)


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_result_equals_sql(spark, duck, name):
    ok, note = compare(spark, duck, QUERIES[name], CHECKS[name], SMALL)
    assert ok, note


@pytest.mark.parametrize("name", [
    "orders_master", "order_valuation", "sales_service", "open_orders_with_prices", "open_orders_by_line",
    "gold_item_location", "cached_open_orders", "workdays_between_dates", "fiscal_interval_join", "best_customer_match",
])
def test_no_pairwise_joins(spark, name):
    text = plan(QUERIES[name](spark, SMALL))
    assert "CartesianProduct" not in text and "BroadcastNestedLoopJoin" not in text


@pytest.mark.parametrize("name", ["latest_line", "priority_dedup", "orders_master", "best_customer_match"])
def test_every_pick_is_cut_before_the_shuffle(spark, name):
    text = plan(QUERIES[name](spark, SMALL))
    windows = len(re.findall(r"\bWindow \[", text))
    assert windows and text.count("WindowGroupLimit") == 2 * windows


def test_filters_and_columns_reach_the_scan(spark):
    text = plan(QUERIES["code_filters"](spark, SMALL))
    assert "GreaterThanOrEqual(o_orderpriority,2)" in text and "o_totalprice" not in text


def test_captures_derive_the_same_in_both_engines(spark, duck):
    captures = Captures(spark, SMALL)
    for name in ("order_line", "item_location", "sales_transaction"):
        sql = re.sub(r"\{(\w+)\}", r"\1", TABLES[name])
        assert captures.derive(name).count() == duck.execute(f"SELECT count(*) FROM ({sql})").fetchone()[0]


def run(df) -> str:
    df.collect()
    return plan(df)


def test_periods_are_found_without_a_shuffle(spark):
    day = "date_add(DATE '2000-01-01', CAST(id % 40000 AS INT))"
    facts = spark.range(0, 60000).selectExpr("id", f"IF(id % 7 = 0, NULL, {day}) AS d")
    periods = spark.range(0, 5000).selectExpr("date_add(DATE '2000-01-01', CAST(id * 7 AS INT)) AS b", "date_add(DATE '2000-01-01', CAST(id * 7 + id % 7 AS INT)) AS e", "id AS p")
    found = interval_join(facts, "d", periods, "b", "e")  # gaps after all periods but every seventh
    own = found._jdf.queryExecution().sparkPlan().toString().split("Subquery")[0]
    assert "Exchange" not in own and "Join" not in own
    want = facts.join(periods, "d >= b AND d <= e" and (facts.d >= periods.b) & (facts.d <= periods.e), "left").select("id", "d", "p")
    assert found.exceptAll(want).count() == 0 == want.exceptAll(found).count() and found.where("p IS NULL").count() > 20000


def test_profile_reads_its_table_once(spark):
    text = run(QUERIES["profile_orders"](spark, SMALL))
    final = text.split("== Initial Plan ==")[0]
    assert len(re.findall(r"Scan parquet", final)) == 1


def test_checks_read_every_table_once(spark):
    t = Captures(spark, SMALL)
    tables = (t.shop_header, t.shop_operation, t.shop_material, t.item_location)
    once = sum(plan(table).count("Scan parquet") for table in tables) + 1  # and the target
    assert plan(QUERIES["shop_order_checks"](spark, SMALL)).count("Scan parquet") == once


def test_inventory_runs_its_joins_once(spark):
    text = plan(QUERIES["inventory_master"](spark, SMALL))
    assert len(re.findall(r"[^t]Exchange hashpartitioning", text)) <= 8
    places = re.findall(r"ReadSchema: struct<[^>]*flag_source", text)
    assert len(places) == 1  # locations are read once


def test_captures_that_join_lines_with_orders_are_not_written():
    from ledgermill.sources.erp import STORED

    assert not STORED & {"booking_line", "invoice_line", "sales_transaction"}
