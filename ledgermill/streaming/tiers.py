"""Two-speed ingestion of source captures.

Every source belongs to a tier (frequent or daily).  A run of a tier drains
the new files of its sources into the captured tables and stops, so any
scheduler can call it.
"""

from __future__ import annotations

from collections.abc import Iterable, Mapping
from dataclasses import dataclass

from pyspark.sql import SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import StreamingQuery

FREQUENT, DAILY = "15min", "daily"


@dataclass(frozen=True)
class Source:
    """One source: where its files arrive, their schema, and an optional file-name filter."""

    name: str
    tier: str
    path: str
    schema: T.StructType
    file_glob: str | None = None


def ingest_source(spark: SparkSession, source: Source, target: str, checkpoint: str) -> StreamingQuery:
    """Drain the new files of one source into ``target/<name>``, each row stamped with its load time."""
    reader = spark.readStream.schema(source.schema)
    if source.file_glob:
        reader = reader.option("pathGlobFilter", source.file_glob)
    rows = reader.parquet(source.path).withColumn("load_timestamp", F.current_timestamp())
    return (
        rows.writeStream.format("parquet")
        .option("path", f"{target}/{source.name}")
        .option("checkpointLocation", f"{checkpoint}/{source.name}")
        .trigger(availableNow=True)
        .start()
    )


def ingest_tier(
    spark: SparkSession, tier: str, sources: Iterable[Source], target: str, checkpoint: str
) -> Mapping[str, str]:
    """Run all sources of a tier side by side; returns the stored path of each."""
    started = {s.name: ingest_source(spark, s, target, checkpoint) for s in sources if s.tier == tier}
    for query in started.values():
        query.awaitTermination()
    return {name: f"{target}/{name}" for name in started}
