"""Incremental upkeep of a latest-row-per-key table from a change feed.

The table is parquet, partitioned by query and batch.  Every micro-batch is reduced
to the newest row per key and overwrites its own partition, so a batch that is run
again changes nothing, and one with a fresh checkpoint is a new query that adds to
the table.  Readers take the newest row per key over all partitions; ``rewrite`` is a
batch job that copies what they read to a new table, which the feed can go on with.
A batch writes what it brings, whatever the size of the table.

Partition columns are ``PARTS``; feeds must not have columns of these names.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import StreamingQuery

from ledgermill.operators.dedup import latest

PARTS = ("feed_query", "batch_id")
REWRITTEN = "rewritten"


def read_snapshot(spark: SparkSession, path: str, schema: T.StructType, keys: Sequence[str], order: Sequence[str]) -> DataFrame:
    """The newest row per key; none of a feed that has brought no rows."""
    return latest(spark.read.schema(schema).parquet(path).select(*schema.names), keys, order)


def upsert_batch(batch: DataFrame, query: str, number: int, path: str, keys: Sequence[str], order: Sequence[str]) -> None:
    """Write one batch of changes as the partition of its query and number."""
    if clash := set(PARTS) & set(batch.columns):
        raise ValueError(f"columns of the feed are named as partitions: {sorted(clash)}")
    rows = latest(batch, keys, order).withColumns({PARTS[0]: F.lit(query), PARTS[1]: F.lit(number).cast("long")})
    rows.write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy(*PARTS).parquet(path)


def rewrite(spark: SparkSession, path: str, target: str, schema: T.StructType, keys: Sequence[str], order: Sequence[str]) -> None:
    """Copy the current rows to a new table, one partition; for a time when no feed writes to the old one, which stays as it is."""
    upsert_batch(read_snapshot(spark, path, schema, keys, order), REWRITTEN, 0, target, keys, order)


def maintain_latest(
    changes: DataFrame,
    path: str,
    checkpoint: str,
    keys: Sequence[str],
    order: Sequence[str],
    event_time: str | None = None,
    replay_window: str | None = None,
) -> StreamingQuery:
    """Start the upkeep of a snapshot from a streaming change feed; runs until the feed is drained.

    With ``event_time`` and ``replay_window`` rows delivered again within the
    window are dropped before the merge.  A checkpoint may be replaced by a fresh
    one, wherever it is: its batches continue the table.
    """
    if event_time and replay_window:
        changes = changes.withWatermark(event_time, replay_window).dropDuplicatesWithinWatermark(
            [*keys, *order]
        )

    def merge(batch: DataFrame, number: int) -> None:
        query = batch.sparkSession.sparkContext.getLocalProperty("sql.streaming.queryId")  # kept by the checkpoint
        upsert_batch(batch, query, number, path, keys, order)

    return (
        changes.writeStream.foreachBatch(merge)
        .option("checkpointLocation", checkpoint)
        .trigger(availableNow=True)
        .start()
    )
