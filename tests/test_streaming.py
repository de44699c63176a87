import datetime as dt

import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ledgermill.sources.tables import append_table
from ledgermill.streaming.latest import maintain_latest, read_snapshot, rewrite, upsert_batch
from ledgermill.streaming.tiers import DAILY, FREQUENT, Source, ingest_tier

SCHEMA = "k string, rowid int, v string"
TYPES = T.StructType([T.StructField("k", T.StringType()), T.StructField("rowid", T.IntegerType()), T.StructField("v", T.StringType())])


def rows(spark, table):
    return sorted(map(tuple, read_snapshot(spark, table, TYPES, ["k"], ["rowid"]).collect()))


def drain(spark, feed, table, progress):
    maintain_latest(spark.readStream.schema(SCHEMA).parquet(feed), table, progress, ["k"], ["rowid"]).awaitTermination()


BATCHES = [[("a", 1, "a1"), ("b", 1, "b1"), ("a", 2, "a2")], [("b", 3, "b3"), ("c", 1, "c1"), ("a", 1, "late")]]
NEWEST = [("a", 2, "a2"), ("b", 3, "b3"), ("c", 1, "c1")]


def test_feed_is_merged_run_by_run(spark, tmp_path):
    feed, table, progress = (str(tmp_path / n) for n in ("feed", "table", "progress"))
    for batch in BATCHES:
        append_table(spark.createDataFrame(batch, SCHEMA), feed)
        drain(spark, feed, table, progress)
    assert rows(spark, table) == NEWEST
    assert len(list((tmp_path / "table").glob("feed_query=*"))) == 1
    assert sorted(p.name for p in (tmp_path / "table").glob("*/batch_id=*")) == ["batch_id=0", "batch_id=1"]


def test_repeated_batch_changes_nothing(spark, tmp_path):
    table = str(tmp_path / "table")
    upsert_batch(spark.createDataFrame([("a", 1, "x"), ("b", 1, "y")], SCHEMA), "q", 0, table, ["k"], ["rowid"])
    for _ in range(2):
        upsert_batch(spark.createDataFrame([("a", 2, "z")], SCHEMA), "q", 1, table, ["k"], ["rowid"])
    assert rows(spark, table) == [("a", 2, "z"), ("b", 1, "y")]
    assert spark.read.parquet(table).count() == 3


@pytest.mark.parametrize("place", ["progress", "fresh"])
def test_fresh_checkpoint_continues_the_table(spark, tmp_path, place):
    """Also one in the place of the old one, whose batches have the same numbers."""
    feeds = [str(tmp_path / f"feed{n}") for n in range(2)]
    table = str(tmp_path / "table")
    for feed, batch in zip(feeds, BATCHES, strict=True):
        append_table(spark.createDataFrame(batch, SCHEMA), feed)
    drain(spark, feeds[0], table, str(tmp_path / "progress"))
    (tmp_path / "progress").rename(tmp_path / "old")
    drain(spark, feeds[1], table, str(tmp_path / place))
    assert rows(spark, table) == NEWEST


def test_rewritten_table_holds_the_newest_rows_and_the_feed_goes_on(spark, tmp_path):
    feed, table, progress, new = (str(tmp_path / n) for n in ("feed", "table", "progress", "new"))
    for batch in BATCHES:
        append_table(spark.createDataFrame(batch, SCHEMA), feed)
        drain(spark, feed, table, progress)
    rewrite(spark, table, new, TYPES, ["k"], ["rowid"])
    assert rows(spark, new) == rows(spark, table) == NEWEST
    assert spark.read.parquet(new).count() == 3
    append_table(spark.createDataFrame([("a", 9, "last")], SCHEMA), feed)
    drain(spark, feed, new, progress)
    assert ("a", 9, "last") in rows(spark, new) and len(rows(spark, new)) == 3


def test_feed_without_rows_gives_an_empty_snapshot(spark, tmp_path):
    table = str(tmp_path / "table")
    upsert_batch(spark.createDataFrame([], SCHEMA), "q", 0, table, ["k"], ["rowid"])
    assert rows(spark, table) == []


def test_columns_named_as_partitions_are_refused(spark, tmp_path):
    with pytest.raises(ValueError):
        upsert_batch(spark.createDataFrame([("a", 1)], "k string, batch_id int"), "q", 0, str(tmp_path / "t"), ["k"], ["batch_id"])


def test_replayed_rows_are_dropped_within_the_window(spark, tmp_path):
    feed, table, progress = (str(tmp_path / n) for n in ("feed", "table", "progress"))
    stamp = dt.datetime(2024, 1, 1, 12)
    schema = T.StructType.fromDDL("k string, ts timestamp, v int")
    append_table(spark.createDataFrame([("a", stamp, 1), ("a", stamp, 1), ("b", stamp, 2)], schema), feed)
    changes = spark.readStream.schema(schema).parquet(feed)
    maintain_latest(changes, table, progress, ["k"], ["ts"], "ts", "10 minutes").awaitTermination()
    assert read_snapshot(spark, table, schema, ["k"], ["ts"]).count() == 2


def test_a_tier_run_drains_its_own_sources_once(spark, tmp_path):
    schema = spark.createDataFrame([], SCHEMA).schema
    sources = [Source(n, tier, str(tmp_path / n), schema) for n, tier in (("x", FREQUENT), ("y", DAILY))]
    for s in sources:
        append_table(spark.createDataFrame([("a", 1, "v")], SCHEMA), s.path)
    for _ in range(2):
        stored = ingest_tier(spark, FREQUENT, sources, str(tmp_path / "out"), str(tmp_path / "progress"))
    assert list(stored) == ["x"]
    rows = spark.read.parquet(stored["x"])
    assert rows.count() == 1 and rows.where(F.col("load_timestamp").isNotNull()).count() == 1
