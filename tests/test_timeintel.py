"""Last-year operators on hand-made sales: leap days, gaps, blank and zero years, a second group."""

from __future__ import annotations

import datetime as dt

import pytest
from pyspark.sql import functions as F

from kalends.functions import dates as D
from kalends.operators import timeintel as ti
from kalends.operators.calendar import calendar_from, date_range
from kalends.operators.ranges import date_islands, date_ranges_text

YEAR = {"year": F.year}
MONTH = {"year": F.year, "month": F.month}


def d(text):
    return dt.date.fromisoformat(text)


SALES = [
    ("a", "2011-02-28", 1), ("a", "2011-03-01", 2), ("a", "2011-07-07", 64), ("a", "2012-02-28", 4),
    ("a", "2012-02-29", 8), ("a", "2012-03-01", 16), ("a", "2012-08-08", 128), ("a", "2013-02-28", 32),
    ("b", "2012-08-08", 1000), ("b", "2013-08-08", 500), ("c", "2012-01-01", 0), ("c", "2013-01-01", 7),
    (None, "2012-05-05", 3), (None, "2013-05-05", 9),
]


@pytest.fixture(scope="module")
def totals(spark):
    rows = [(g, d(day), amount) for g, day, amount in SALES]
    fact = spark.createDataFrame(rows, "g string, day date, LineTotal int").withColumn(
        "LineTotal", F.col("LineTotal").cast("decimal(19,4)")
    )
    return ti.day_totals(fact, "day", ["g"])


@pytest.fixture(scope="module")
def calendar(spark):
    return date_range(spark, d("2011-01-01"), d("2013-12-31"))


def values(df, *keys):
    return {tuple(r[k] for k in keys): (None if r["sales"] is None else int(r["sales"]),
                                        None if r["ly"] is None else int(r["ly"])) for r in df.collect()}


def test_sparse_months(totals):
    got = values(ti.ly_sparse(totals, ["g"], MONTH), "g", "year", "month")
    assert got[("a", 2012, 2)] == (12, 1 + 2)  # the 29th looks at March 1st
    assert got[("a", 2012, 3)] == (16, 2)
    assert got[("a", 2013, 2)] == (32, 4)      # the 29th of last year has no counterpart
    assert got[("a", 2012, 8)] == (128, None)
    assert got[("b", 2013, 8)] == (500, 1000)
    assert got[(None, 2013, 5)] == (9, 3)      # the blank member is a group like any other


def test_sparse_years_count_a_shared_day_once(totals):
    got = values(ti.ly_sparse(totals, ["g"], YEAR), "g", "year")
    assert got[("a", 2012)] == (156, 1 + 2)    # 64 of July 2011 is lost: no sale that day in 2012
    assert got[("a", 2013)] == (32, 4)


def test_sparse_without_other_filters(totals):
    everything = totals.groupBy("Date").agg(F.sum("sales").alias("sales"))
    got = values(ti.ly_sparse(totals, ["g"], YEAR, all_totals=everything), "g", "year")
    assert got[("b", 2013)] == (500, 1128) and got[("a", 2013)] == (32, 4)


def test_date_filter_narrows_this_year_only(totals):
    got = values(ti.ly_sparse(totals, ["g"], YEAR, date_filter=F.month("Date") == 8), "g", "year")
    assert got == {("a", 2012): (128, None), ("b", 2012): (1000, None), ("b", 2013): (500, 1000)}
    full = values(ti.ly_full_year(totals, ["g"], YEAR, date_filter=F.month("Date") == 8), "g", "year")
    assert full[("a", 2012)] == (128, 67)


def test_full_year(totals):
    got = values(ti.ly_full_year(totals, ["g"], MONTH), "g", "year", "month")
    assert got[("a", 2012, 2)] == (12, 67) and got[("a", 2011, 2)] == (1, None)
    assert got[("b", 2013, 8)] == (500, 1000) and got[("c", 2013, 1)] == (7, 0) and got[(None, 2013, 5)] == (9, 3)


def test_dense_months_take_the_whole_month(totals, calendar):
    got = values(ti.ly_dense(totals, calendar, ["g"], MONTH), "g", "year", "month")
    assert got[("a", 2012, 2)] == (12, 1)
    assert got[("a", 2013, 2)] == (32, 4 + 8)  # February 29th belongs to the month
    assert got[("a", 2012, 7)] == (None, 64)   # a month without sales still has a last year
    assert ("a", 2014, 2) not in got           # outside the calendar


def test_dense_years(totals, calendar):
    got = values(ti.ly_dense(totals, calendar, ["g"], YEAR), "g", "year")
    assert got[("a", 2012)] == (156, 67) and got[("a", 2013)] == (32, 156) and got[("b", 2011)[:1] + (2012,)] == (1000, None)


def test_dense_days_share_the_28th(totals, calendar):
    got = values(ti.ly_dense(totals, calendar, ["g"], {"day": lambda c: c}, single_days=True), "g", "day")
    assert got[("a", d("2012-02-28"))] == (4, 1) and got[("a", d("2012-02-29"))] == (8, 1)
    assert got[("a", d("2013-02-28"))] == (32, 4)


def test_a_calendar_that_stops_early_compares_the_same_part(totals, spark):
    days = calendar_from(totals.filter("Date < '2013-03-01'"), "Date", lead_months=12)
    got = values(ti.ly_dense(totals.filter("g = 'a'"), days, [], YEAR), "year")
    assert got[(2013,)] == (32, 4 + 8)  # until the end of February, the 29th included
    assert got[(2012,)] == (156, 67)


def test_days_without_calendar_form_a_blank_period(totals, spark):
    days = date_range(spark, d("2012-01-01"), d("2012-12-31"))
    got = values(ti.ly_dense(totals.filter("g = 'a'"), days, [], YEAR), "year")
    assert got == {(2012,): (156, None), (None,): (99, None)}


def test_yoy(spark):
    rows = spark.createDataFrame([(10, 4), (10, None), (None, 4), (5, 0), (None, None)], "sales int, ly int")
    got = [(r["yoy"], r["yoy_pct"], r["parallel_period"]) for r in ti.with_yoy(rows).collect()]
    assert got == [(6, 1.5, 4), (10, None, None), (-4, -1.0, 4), (5, None, 0), (None, None, None)]


def test_relative_period(totals, calendar):
    described = calendar.withColumn("YearOffset", F.year("Date") - 2013)
    assert ti.in_relative_period(totals, described, F.col("YearOffset") == 0).count() == 4


def test_rolling_and_clamping(spark):
    row = spark.range(1).select(F.lit(d("2024-02-29")).alias("x")).select(
        D.previous_year_rolling("x"), D.previous_year_clamped("x")
    ).first()
    assert tuple(row) == (d("2023-03-01"), d("2023-02-28"))


def test_ranges(spark):
    days = {"run": [5, 1, 8, 3, 2, 7, 2], "lone": [4], "month": range(1, 32)}
    rows = [(k, dt.datetime(2024, 1, n, n % 24)) for k, ns in days.items() for n in ns] + [("none", None)]
    df = spark.createDataFrame(rows, "k string, t timestamp_ntz")
    got = {r["k"]: r["ranges"] for r in date_ranges_text(df, ["k"], "t").collect()}
    assert got == {
        "run": "2024-01-01-2024-01-03,2024-01-05,2024-01-07-2024-01-08,", "lone": "2024-01-04,",
        "month": "2024-01-01-2024-01-31,",
    }
    assert date_islands(df, ["k"], "t").count() == 5
    assert date_ranges_text(df.filter("k = 'lone'"), [], "t").first()[0] == "2024-01-04,"
