import datetime as dt
from decimal import Decimal

import pytest
from pyspark.sql import functions as F

from ledgermill.functions.amounts import decode_vendor_price, decode_vp, decode_vp_tail, net_of, total_of_present
from ledgermill.functions.dates import date_dimensions, event_time, fiscal_label
from ledgermill.functions.text import (
    canonical, case_map, composite_id, describe, first_column, is_pending, material_flag, norm_key,
    ship_complete_flag, strip_pending,
)


def values(df):
    return [tuple(r) for r in df.collect()]


def test_keys_null_blank_and_padding_agree(spark):
    df = spark.createDataFrame([("  A1 ",), ("A1",), ("",), (None,)], "k string")
    assert values(df.select(norm_key("k"))) == [("A1",), ("A1",), ("",), ("",)]


def test_composite_id_is_zero_padded(spark):
    df = spark.createDataFrame([("C7", 12)], "c string, s int")
    assert values(df.select(composite_id("c", "s"))) == [("C7-0012",)]


def test_description_survives_missing_part(spark):
    df = spark.createDataFrame([("a", "b"), ("a", None), (None, None)], "x string, y string")
    assert values(df.select(describe("x", "y"))) == [("a b",), ("a",), ("",)]


def test_pending_marker(spark):
    df = spark.createDataFrame([("I1# ",), ("I1",)], "i string")
    assert values(df.select(is_pending("i"), strip_pending("i"))) == [(True, "I1"), (False, "I1")]


def test_packed_price_scales_and_bad_text(spark):
    rows = [("0000000000012345",), ("2000000001234500",), ("4000000000012345",), ("",), ("N/A BAD VALUE ##",), (None,)]
    df = spark.createDataFrame(rows, "p string")
    got = [r[0] for r in df.select(decode_vp("p")).collect()]
    assert got == [Decimal("123.4500"), Decimal("123.4500"), Decimal("0.0123"), None, None, None]


def test_packed_price_variants(spark):
    df = spark.createDataFrame([("0000000001234500", "00000001234500"), (" ", "    bad text  ")], "a string, b string")
    assert values(df.select(decode_vp_tail("a"), decode_vendor_price("b"))) == [
        (Decimal("123.4500"), Decimal("123.45")), (None, None)
    ]


def test_missing_amounts_count_as_zero(spark):
    df = spark.createDataFrame([(5, None), (None, 3), (None, None)], "a int, b int")
    assert values(df.select(net_of("a", "b"), total_of_present("a", "b"))) == [(5, 5), (-3, 3), (0, 0)]


def test_comment_flags(spark):
    df = spark.createDataFrame([("need #mo now",), ("Ship Complete",), ("SHIP LINE COMPLETE",), (None,)], "c string")
    assert values(df.select(material_flag("c"), ship_complete_flag("c"))) == [
        ("Y", None), ("N", "Y"), ("N", None), ("N", None)
    ]


def test_week_belongs_to_the_year_of_its_sunday(spark):
    df = spark.createDataFrame([(dt.date(2000, 1, 1),), (dt.date(2000, 1, 2),), (dt.date(2000, 12, 31),)], "d date")
    weeks = [r[0] for r in df.select(date_dimensions("d", "x")["x_yearweek"]).collect()]
    # 1 Jan 2000 is a Saturday: its Sunday is 26 Dec 1999, the 53rd week when week one holds 1 January
    assert weeks == [199953, 200002, 200054]


def test_event_time_and_fiscal_label(spark):
    df = spark.createDataFrame([(dt.date(2001, 2, 3), 40506, 200102)], "d date, t int, p int")
    assert values(df.select(event_time("d", "t").cast("string"), fiscal_label("p"))) == [("2001-02-03 04:05:06", "2001-02")]


def test_canonical_value_names_its_source(spark):
    df = spark.createDataFrame([("x", "y"), (None, "y"), (None, None)], "a string, b string")
    value, source = canonical({"A": F.col("a"), "B": F.col("b")})
    assert values(df.select(value, source)) == [("x", "A"), ("y", "B"), (None, "UNAVAILABLE")]


def test_case_map_and_first_column(spark):
    df = spark.createDataFrame([("M", None, "z"), ("Q", "b", "z")], "f string, B string, c string")
    assert values(df.select(case_map("f", {"M": "made"}, "other"), first_column(df, ["nope", "b", "C"]))) == [
        ("made", "z"), ("other", "b")
    ]
    with pytest.raises(ValueError):
        first_column(df, ["nope"])
