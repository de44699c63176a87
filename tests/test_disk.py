"""What the open-order and item tables leave and move on disk."""

import os
import re
import time

import pytest
from pyspark.sql import functions as F

from ledgermill.operators.dedup import dedup_by_priority, dedup_few
from ledgermill.queries import REGISTRY as QUERIES
from ledgermill.sources.erp import Captures, stored_once

SMALL = "/root/testdata/sf0.001"


def shuffle_files(spark) -> set[str]:
    files = spark.sparkContext._jvm.org.apache.spark.SparkEnv.get().blockManager().diskBlockManager().getAllFiles()
    return {files.apply(i).getPath() for i in range(files.size()) if "shuffle_" in files.apply(i).getName()}


def test_a_stored_layer_keeps_no_shuffle_files(spark):
    before, made = shuffle_files(spark), []

    def build():
        moved = spark.range(0, 20_000).repartition(3, "id").groupBy((F.col("id") % 100).alias("k")).count()
        made.append(moved)  # whoever holds the frame, its files go
        return moved

    path = stored_once(spark, Captures(spark, SMALL), "test/layer", build)
    for _ in range(50):
        left = {f for f in shuffle_files(spark) - before if os.path.exists(f)}
        if not left:
            break
        time.sleep(0.1)
    assert not left and spark.read.parquet(path).count() == 100


def moves(df, column: str) -> int:
    """Exchanges that move a column."""
    mode = df.sparkSession._jvm.org.apache.spark.sql.execution.ExplainMode.fromString("formatted")
    text = df._jdf.queryExecution().explainString(mode)
    return len(re.findall(rf"\(\d+\) Exchange\nInput \[\d+\]: \[[^\]]*\b{column}#", text))


@pytest.fixture
def few_broadcasts(spark):
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "2k")
    yield
    spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")


@pytest.mark.parametrize("name, column, times", [
    ("open_orders_by_line", "customer_purchase_order_id", 1), ("open_orders_view", "date_order_requested", 1),
    ("open_orders_with_prices", "order_line_comment_note", 2),  # the other one has the rows of repeated keys only
])
def test_whole_lines_move_once(spark, few_broadcasts, name, column, times):
    assert moves(QUERIES[name](spark, SMALL), column) == times


def test_few_repeated_keys_are_picked_as_by_priority(spark):
    rows = [(1, "a", 5, "x"), (1, "a", 7, "w"), (1, "a", 7, "v"), (2, "a", 1, "u"), (None, "a", 1, "t"), (None, "a", 2, "s"),
            (None, None, 3, "r"), (3, None, 3, None), (3, None, 3, None), (4, "b", None, "q")]
    frame = spark.createDataFrame(rows, "k int, l string, n int, note string")
    order = [F.col("n").desc_nulls_last()]
    got, want = (f(frame, ["k", "l"], order).collect() for f in (dedup_few, dedup_by_priority))
    assert sorted(map(repr, got)) == sorted(map(repr, want)) and len(got) == 6
    assert dedup_few(frame.limit(0), ["k", "l"], order).collect() == []
