import datetime as dt
import random

from pyspark.sql import functions as F

from ledgermill.operators.workdays import (
    add_workdays, delivery_group, fillable, lead_time_range, on_time, sla_flags, workdays_between,
)
from ledgermill.sources.calendar import calendar

HOLIDAYS = {dt.date(2001, 1, 1): "New Year", dt.date(2001, 7, 4): "Summer"}
LO, HI = dt.date(2000, 12, 1), dt.date(2001, 12, 31)


def works(day):
    return day.weekday() < 5 and day not in HOLIDAYS


def between(a, b):
    if a is None or b is None or b < a:
        return None
    return sum(works(a + dt.timedelta(n)) for n in range(1, (b - a).days + 1))


def after(a, n, roll=False):
    if a is None:
        return None
    while roll and not works(a):
        a += dt.timedelta(1)
    while n:
        a += dt.timedelta(1)
        n -= works(a)
    return a


def test_against_counting_days(spark):
    rng = random.Random(7)
    days = [dt.date(2001, 1, 1) + dt.timedelta(rng.randrange(300)) for _ in range(400)]
    rows = list(zip(days[:200], days[200:])) + [(None, days[0]), (days[0], None), (dt.date(2001, 6, 29), dt.date(2001, 7, 5))]
    df = spark.createDataFrame(rows, "a date, b date")
    cal = calendar(spark, LO, HI, HOLIDAYS)
    got = workdays_between(df, {"n": ("a", "b"), "back": ("b", "a"), "now": ("a", dt.date(2001, 9, 3))}, cal)
    got = add_workdays(add_workdays(got, {"p1": ("a", 1), "p10": ("a", 10)}, cal), {"r5": ("a", 5)}, cal, roll=True)
    for r in got.collect():
        assert r.n == between(r.a, r.b)
        assert r.back == between(r.b, r.a)
        assert r.now == between(r.a, dt.date(2001, 9, 3))
        assert (r.p1, r.p10) == (after(r.a, 1), after(r.a, 10))
        assert r.r5 == after(r.a, 5, roll=True)


def test_past_the_calendar_is_null(spark):
    df = spark.createDataFrame([(dt.date(2001, 12, 31),)], "a date")
    assert add_workdays(df, {"x": ("a", 3)}, calendar(spark, LO, HI)).first().x is None


def test_unknown_holiday_flag(spark):
    cal = calendar(spark, LO, HI).withColumn(
        "is_holiday", F.when(F.col("calendar_date") != F.lit(dt.date(2001, 3, 6)), F.lit(False))
    )
    df = spark.createDataFrame([(dt.date(2001, 3, 5), dt.date(2001, 3, 7))], "a date, b date")
    assert workdays_between(df, {"n": ("a", "b")}, cal, unknown_holiday_works=True).first().n == 2
    assert workdays_between(df, {"n": ("a", "b")}, cal, unknown_holiday_works=False).first().n == 1


def test_sla_edges(spark):
    df = spark.createDataFrame([(n,) for n in (0, 1, 2, 3, 6, 8, 41, 42, None)], "w int")
    flags = sla_flags("w")
    rows = df.select("w", lead_time_range("w").alias("r"), flags["shipped_same_day"].alias("same"),
                     flags["shipped_1_week"].alias("week"), flags["shipped_greater_than_40"].alias("late")).collect()
    assert [r.r for r in rows] == [
        "shipped_same_day", "shipped_same_day", "shipped_next_day", "shipped_2_days", "shipped_1_week", "shipped_7_days",
        "shipped_40_days", "shipped_greater_than_40", None,
    ]
    assert [r.same for r in rows] == ["Y", "Y", "N", "N", "N", "N", "N", "N", "N"]
    assert [r.week for r in rows] == ["Y", "Y", "Y", "Y", "Y", "N", "N", "N", "N"]
    assert [r.late for r in rows] == ["Y"] * 8 + ["N"]


def test_delivery_rules_first_match_wins(spark):
    rows = [
        ("S", "Y", 5, "ZZ", "10", 3, 9, "Advertised In-Stock"), ("S", "Y", 5, "AS", "10", 9, 9, "Advertised Out-of-Stock"),
        ("N", None, None, "AS", "10", 2, None, "In-Stock Altered Stock"), ("S", "N", 1, "KT", "10", 2, 2, "Standard"),
        ("N", "N", 1, "KT", "10", 2, 2, "Kits"), ("N", "N", 1, "ZZ", "06", 2, 2, "Made To Order"),
        ("N", "N", 1, None, "06", 2, 2, "Fabrics and Raw Materials"), ("S", "N", 3, "ZZ", "10", 2, 2, "Other Stock"),
        (None, None, None, None, None, None, None, "Other"),
    ]
    df = spark.createDataFrame(rows, "s string, a string, r int, p string, c string, wp int, wi int, want string")
    for row in df.withColumn("got", delivery_group("s", "a", "r", "p", "c", "wp", "wi")).collect():
        assert row.got == row.want


def test_fillable_and_on_time(spark):
    rows = [
        ("Kits", "N", 6, 1, 2, "Fillable"), ("Kits", "N", 9, 0, 2, "Fillable"), ("Kits", "N", 9, 1, 2, "Unfillable"),
        ("Kits", "N", 1, None, None, "Unfillable"), ("Standard", "S", None, None, None, "Unfillable"),
        ("Other Stock", "S", 6, None, None, "Fillable"), ("Other", "S", 1, None, None, "Unfillable"),
    ]
    df = spark.createDataFrame(rows, "g string, s string, wp int, k int, n int, want string")
    for row in df.withColumn("got", fillable("g", "s", "wp", "k", "n")).collect():
        assert row.got == row.want
    day = dt.date(2001, 5, 7)
    rows = [("Standard", day, day + dt.timedelta(9), 7, "Y"), ("Standard", day, day - dt.timedelta(9), None, "Y"),
            ("Standard", day, day + dt.timedelta(30), 22, "N"), ("Kits", day, day + dt.timedelta(1), 1, "N"), ("Kits", day, None, None, None)]
    df = spark.createDataFrame(rows, "g string, p date, i date, late int, want string")
    for row in df.withColumn("got", on_time("g", "p", "i", "late")).collect():
        assert row.got == row.want
