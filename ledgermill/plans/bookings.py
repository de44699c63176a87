"""Booking history."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ledgermill.functions.text import describe
from ledgermill.operators.dedup import dedup_by_priority, latest_first
from ledgermill.operators.joins import header_line, semi


def build_bookings(t, since: dt.date = dt.date(2019, 1, 1)) -> DataFrame:
    """Booking events with margin.

    An order counts when any of its lines was booked since the cut-off, not as
    a return and not for rework; then all of its lines are kept.  Headers of
    inter-company classes, and those without class, drop out.
    """
    lines = t.booking_line
    valid = lines.where(
        (F.col("date_book_last") >= F.lit(since)) & (F.col("id_user_add") != "RMA") & (F.col("id_item") != "REWORK")
    )
    kept = semi(lines, valid, ["id_ord"]).select(
        "id_ord", "id_cust", "seq_shipto", "seq_line_ord", "seq_rec", "id_item", "id_loc", "qty_ship", "sls", "cost",
        describe("descr_1", "descr_2").alias("line_item_description"),
        (F.col("sls") - F.col("cost")).alias("margin"),
        F.col("date_book_last").alias("calendar_date"),
    )
    outside = t.booking_header.where(~F.col("code_cust_1").isin("IC", "IP"))
    header = dedup_by_priority(outside, ["id_ord", "id_cust", "seq_shipto"], latest_first("date_ord", "rowid"))
    return header_line(kept, header.drop("rowid"), ["id_ord", "id_cust", "seq_shipto"])
