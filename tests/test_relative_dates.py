"""Dates told against a day."""

import datetime as dt

import pytest
from pyspark.sql import functions as F

from postmill.functions.relative_dates import relative_date

CASES = [
    ("today", "2024-03-31", False), ("Just posted", "2024-03-31", False), ("Posted: today.", "2024-03-31", False),
    ("yesterday", "2024-03-30", False), ("the day before yesterday", "2024-03-29", False),
    ("3 days ago", "2024-03-28", False), ("Reposted  3 Days\tago", "2024-03-28", False), ("3d", "2024-03-28", False),
    ("30+ days ago", "2024-03-01", True), ("30 + days", "2024-03-01", True), ("over a week ago", "2024-03-24", True),
    ("more than two weeks ago", "2024-03-17", True), ("a fortnight ago", "2024-03-17", False), ("last week", "2024-03-24", False),
    ("1 month ago", "2024-02-29", False), ("last month", "2024-02-29", False), ("a couple of months ago", "2024-01-31", False),
    ("an hour ago", "2024-03-31", False), ("23 hours ago", "2024-03-31", False), ("49 hours ago", "2024-03-29", False),
    ("5 min ago", "2024-03-31", False), ("a year ago", "2023-03-31", False), ("2 yrs back", "2022-03-31", False),
    ("twelve days ago", "2024-03-19", False), ("0 days ago", "2024-03-31", False),
]
NOTHING = [None, "", "ago", "a day", "in 3 days", "2024-03-01", "days ago", "-3 days ago", "123456 days ago", "posted", "3 moons ago",
           "3 days ago, or so", "word " * 5000]


def test_relative_dates(spark):
    rows = [(t, d) for t, *_ in CASES for d in (dt.date(2024, 3, 31), None)] + [(t, dt.date(2024, 3, 31)) for t in NOTHING]
    df = spark.createDataFrame(rows, "t string, d date").select("t", "d", relative_date(F.col("t"), F.col("d")).alias("r"))
    want = {t: (dt.date.fromisoformat(date), least) for t, date, least in CASES}
    for r in df.collect():
        expected = want.get(r.t) if r.d else None
        assert (r.r and tuple(r.r)) == expected, r.t


@pytest.mark.parametrize("anchor", ["timestamp'2024-03-31 23:59:59'", "'2024-03-31'", "date'2024-03-31'"])
def test_kinds_of_anchor(spark, anchor):
    got = spark.range(1).select(relative_date(F.lit("2 days ago"), F.expr(anchor)).alias("r")).first()["r"]
    assert got.date == dt.date(2024, 3, 29)
