"""Reading, unioning, typing and writing tables."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

MAPPING_SCHEMA = "field string, friendly_name string"


def load(spark: SparkSession, directory: str, name: str, schema: T.StructType | None = None) -> DataFrame:
    """Scan one stored table; filters and column pruning reach the parquet reader.

    A given schema saves the look into the files.
    """
    return load_path(spark, f"{directory}/{name}.parquet", schema)


def load_path(spark: SparkSession, path: str, schema: T.StructType | None = None) -> DataFrame:
    reader = spark.read if schema is None else spark.read.schema(schema)
    return reader.parquet(path)


def tagged_union(frames: Mapping[str, DataFrame], tag: str = "source_table") -> DataFrame:
    """Union active and archived captures, each row carrying the name of its source."""
    parts = [frame.withColumn(tag, F.lit(name)) for name, frame in frames.items()]
    return reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), parts)


def union_all(frames: Sequence[DataFrame]) -> DataFrame:
    return reduce(DataFrame.unionByName, frames)


def inline_lookup(spark: SparkSession, rows: Sequence[tuple], schema: str) -> DataFrame:
    """A constant code table.  Its size is fixed by the caller's literal, so it is broadcast."""
    return F.broadcast(spark.createDataFrame(list(rows), schema))


def read_mapping(spark: SparkSession, path: str, schema: str = MAPPING_SCHEMA) -> DataFrame:
    """Read a rename map or column list kept as CSV with a header row."""
    frame = spark.read.csv(path, header=True, schema=schema, enforceSchema=True)
    return frame.select(*(F.trim(c).alias(c) for c in frame.columns))


def sample(df: DataFrame, percent: float, keys: Sequence[str]) -> DataFrame:
    """About the given percentage of the rows, chosen by a hash of their key.

    The same rows are kept however the table is stored or partitioned.
    """
    return df.where(in_sample(percent, keys))


def in_sample(percent: float, keys: Sequence[str]) -> Column:
    text = F.concat_ws("|", *(F.col(f"`{k}`").cast("string") for k in keys))
    limit = format(min(2**32 - 1, int(percent / 100 * 2**32)), "08x")
    return F.substring(F.md5(text), 1, 8) < limit


def conform(df: DataFrame, schema: T.StructType | str) -> DataFrame:
    """Project and cast to a declared target schema; a missing column is an error."""
    if isinstance(schema, str):
        schema = T.StructType.fromDDL(schema)
    present = {c.lower() for c in df.columns}
    missing = [f.name for f in schema.fields if f.name.lower() not in present]
    if missing:
        raise ValueError(f"columns missing for the target table: {missing}")
    return df.select(*(F.col(f.name).cast(f.dataType).alias(f.name) for f in schema.fields))


def stamp(df: DataFrame, name: str = "load_timestamp") -> DataFrame:
    return df.withColumn(name, F.current_timestamp())


def write_table(df: DataFrame, path: str, partition_by: Sequence[str] = (), compression: str | None = None) -> None:
    """Replace a stored table.  The input must not read from the same path."""
    writer = df.write.mode("overwrite")
    if compression:
        writer = writer.option("compression", compression)
    if partition_by:
        writer = writer.partitionBy(*partition_by)
    writer.parquet(path)


def append_table(df: DataFrame, path: str) -> None:
    df.write.mode("append").parquet(path)
