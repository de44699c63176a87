"""Working days from order to ship, by delivery range."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ledgermill.operators.dedup import dedup_by_priority
from ledgermill.operators.joins import header_line
from ledgermill.operators.workdays import lead_time_range, workdays_between


def ship_lead_times(orders: DataFrame, lineitem: DataFrame, cal: DataFrame) -> DataFrame:
    """Lines, quantity and value per lead-time range; one row counts per order and line."""
    lines = dedup_by_priority(
        lineitem.select(
            F.col("l_orderkey").alias("o_orderkey"), "l_linenumber", "l_quantity", "l_extendedprice", "l_shipdate"
        ),
        ["o_orderkey", "l_linenumber"],
        [F.col("l_shipdate").desc(), F.col("l_extendedprice").desc(), F.col("l_quantity").desc()],
    )
    dated = header_line(lines, orders.select("o_orderkey", "o_orderdate"), ["o_orderkey"])
    counted = workdays_between(dated, {"workdays": ("o_orderdate", "l_shipdate")}, cal)
    return counted.groupBy(lead_time_range("workdays").alias("lead_time_range")).agg(
        F.count(F.lit(1)).alias("lines"),
        F.sum(F.col("l_quantity").cast("long")).alias("quantity"),
        F.sum(F.col("l_extendedprice").cast("decimal(18,2)")).alias("value"),
        F.max("workdays").alias("longest"),
    )
