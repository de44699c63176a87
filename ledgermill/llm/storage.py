"""Intermediate tables in the folder that all executors share."""

from __future__ import annotations

from pyspark.sql import DataFrame

from ledgermill.session import shared_folder


def stored(frame: DataFrame, purpose: str) -> DataFrame:
    """Write a table to the shared folder and read it back.

    Cuts the lineage; what is read later survives the loss of any executor.
    """
    path = shared_folder(frame.sparkSession, f"llm-{purpose}")
    frame.write.option("compression", "zstd").parquet(path)
    return frame.sparkSession.read.schema(frame.schema).parquet(path)
