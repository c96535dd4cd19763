"""Properties of the date dimension, its edge days, and mistakes it must not repeat."""

from __future__ import annotations

import datetime as dt

import pytest
from pyspark.sql import functions as F

from kalends.functions import dates as D
from kalends.functions.names import DAYS, MONTHS, check_language
from kalends.operators.calendar import (
    DATE_COLUMNS, calendar_from, date_dim, date_range, describe_days, small_date_dim, with_calendar_columns,
)
from kalends.operators.filters import today_row
from kalends.operators.quality import calendar_sanity

AS_OF = dt.date(2024, 2, 29)


@pytest.fixture(scope="module")
def calendar(spark):
    return {r["Date"]: r for r in date_dim(spark, 2019, 2028, as_of=AS_OF).collect()}


def test_columns_and_rows(spark, calendar):
    assert len(DATE_COLUMNS) == 38
    assert date_dim(spark, 2019, 2028, as_of=AS_OF).columns == DATE_COLUMNS
    assert len(calendar) == (dt.date(2029, 1, 1) - dt.date(2019, 1, 1)).days
    assert len({r["idFecha"] for r in calendar.values()}) == len(calendar)
    assert all(r["idFecha"] == int(d.strftime("%Y%m%d")) for d, r in calendar.items())


def test_a_range_of_more_than_ten_thousand_days_is_whole(spark):
    assert date_range(spark, dt.date(1990, 1, 1), dt.date(2040, 12, 31)).count() == 18628


def test_iso_weeks_follow_the_standard_library(spark):
    days = date_range(spark, dt.date(1990, 1, 1), dt.date(2040, 12, 31))
    for row in describe_days(days, as_of=AS_OF, columns=["Date", "IsoYear", "IsoWeek", "Day of Week"]).collect():
        iso = row["Date"].isocalendar()
        assert (row["IsoYear"], row["IsoWeek"], row["Day of Week"]) == (iso.year, iso.week, iso.weekday % 7)


@pytest.mark.parametrize("day, week, iso", [
    (dt.date(2021, 1, 1), 1, (2020, 53)), (dt.date(2021, 1, 3), 2, (2020, 53)), (dt.date(2022, 1, 1), 1, (2021, 52)),
    (dt.date(2023, 1, 1), 1, (2022, 52)), (dt.date(2024, 12, 31), 53, (2025, 1)),
    (dt.date(2028, 12, 31), 54, (2028, 52)),
])
def test_edge_weeks(calendar, day, week, iso):
    row = calendar[day]
    assert row["Week of Year"] == week and (row["IsoYear"], row["IsoWeek"]) == iso


def test_working_days_end_at_the_weekdays_of_the_year(calendar):
    for year in range(2019, 2029):
        days = [d for d in calendar if d.year == year]
        assert calendar[max(days)]["WorkingDayNumber"] == sum(d.weekday() < 5 for d in days)


@pytest.mark.parametrize("start", range(1, 13))
@pytest.mark.parametrize("basis", ["Start", "End"])
def test_fiscal_parts(spark, start, basis):
    rows = date_dim(spark, 2023, 2024, start, basis, as_of=AS_OF, columns=[
        "Date", "FiscalYear", "FiscalQuarter", "FiscalMonthNumber", "FiscalQuarterCode"
    ]).collect()
    for row in rows:
        passed = (row["Date"].month - start) % 12
        opened = row["Date"].year - (row["Date"].month < start)
        assert row["FiscalYear"] == opened + (basis == "End")
        assert row["FiscalQuarter"] == passed // 3 + 1 and row["FiscalMonthNumber"] == passed + 1
        assert row["FiscalQuarterCode"] == row["FiscalYear"] * 100 + row["FiscalQuarter"]


def test_fiscal_week_modes(spark):
    def week(mode):
        rows = date_dim(spark, 2019, 2021, 6, "End", as_of=AS_OF, fiscal_week_mode=mode,
                        columns=["Date", "Fiscal Week of Year"])
        return {r["Date"]: r["Fiscal Week of Year"] for r in rows.collect()}

    assert [week("shifted")[dt.date(y, 6, 1)] for y in (2019, 2020, 2021)] == [48, 49, 49]
    assert [week("aligned")[dt.date(y, 6, 1)] for y in (2019, 2020, 2021)] == [1, 1, 1]


def test_offsets_count_boundaries(calendar):
    assert calendar[dt.date(2024, 3, 1)]["DayOffset"] == 1
    assert calendar[dt.date(2024, 3, 1)]["MonthOffset"] == 1
    assert calendar[dt.date(2023, 12, 31)]["YearOffset"] == -1
    assert calendar[dt.date(2023, 12, 31)]["QuarterOffset"] == -1
    assert calendar[dt.date(2025, 4, 1)]["QuarterOffset"] == 5


def test_relative_labels(calendar):
    today = calendar[AS_OF]
    assert {today[f"Current {u}"] for u in ("Year", "Month", "Week", "Day", "Fiscal Year")} == {"Current"}
    assert [d for d, r in calendar.items() if r["Current Day"] == "Current"] == [AS_OF]
    # The week of the reference day is compared with weeks, not with months.
    assert {d for d, r in calendar.items() if r["Current Week"] == "Current"} == {
        dt.date(2024, 2, 25) + dt.timedelta(days=i) for i in range(7)
    }
    assert calendar[dt.date(2024, 3, 3)]["Current Week"] == "Future Week"
    assert calendar[dt.date(2024, 6, 1)]["Current Fiscal Year"] == "Future Year"
    assert calendar[dt.date(2023, 5, 31)]["Current Fiscal Year"] == "Past Year"
    assert all(r["Current Fiscal Month"] == r["Current Month"] and r["Current Fiscal Week"] == r["Current Week"]
               for r in calendar.values())


def test_a_week_across_new_year_is_split(spark):
    rows = date_dim(spark, 2024, 2025, as_of=dt.date(2024, 12, 31), columns=["Date", "Current Week"]).collect()
    labels = {r["Date"]: r["Current Week"] for r in rows}
    assert labels[dt.date(2024, 12, 29)] == "Current" and labels[dt.date(2025, 1, 1)] == "Future Week"


def test_without_as_of_today_is_the_session_date(spark):
    today = spark.range(1).select(F.current_date()).first()[0]
    rows = today_row(date_dim(spark, today.year, today.year)).collect()
    assert [(r["Date"], r["Current Day"], r["DayOffset"]) for r in rows] == [(today, "Current", 0)]


def test_names(spark, calendar):
    assert set(MONTHS) == set(DAYS) == {"es", "en", "pt", "ca", "eu", "gl", "fr"}
    assert all(len(MONTHS[code]) == 12 and len(DAYS[code]) == 7 for code in MONTHS)
    row = calendar[dt.date(2024, 9, 1)]
    assert row["Month Name"] == row["Fiscal Month Name"] == "Septiembre" and row["Day Name"] == "Domingo"
    assert row["Month Name Complete"] == "Septiembre 2024" and row["Month Name Short Complete"] == "Sep 24"
    basque = date_dim(spark, 2009, 2009, lang="eu", as_of=AS_OF, columns=["Month Name", "Month Name Short Complete"])
    assert basque.first()["Month Name Short Complete"] == "Urt 09"


@pytest.mark.parametrize("arguments", [
    {"fiscal_year_basis": "Middle"}, {"fiscal_start_month": 0}, {"fiscal_start_month": 13}, {"lang": "xx"},
    {"end_year": 2018}, {"fiscal_week_mode": "other"},
])
def test_parameters_are_checked(spark, arguments):
    with pytest.raises(ValueError):
        date_dim(spark, **{"start_year": 2019, "end_year": 2020, **arguments})


def test_unknown_language_lists_the_known_ones():
    with pytest.raises(ValueError, match="ca, en, es, eu, fr, gl, pt"):
        check_language("de")


def test_calendar_from_data(spark):
    dates = spark.createDataFrame([(dt.date(2015, 12, 31),), (dt.date(2013, 3, 31),), (dt.date(9999, 12, 31),), (None,)],
                                  "d date")
    days = [r[0] for r in calendar_from(dates, "d", whole_years=True).orderBy("Date").collect()]
    assert (days[0], days[-1], len(days)) == (dt.date(2013, 1, 1), dt.date(2015, 12, 31), 1095)
    lead = calendar_from(dates, "d", lead_months=13).agg(F.min("Date"), F.max("Date")).first()
    assert tuple(lead) == (dt.date(2012, 2, 29), dt.date(2015, 12, 31))


def test_calendar_from_ignores_the_time_of_day(spark):
    stamps = spark.sql("select timestamp_ntz'2020-02-28 23:59:59' t union all select timestamp_ntz'2020-03-01 00:00:01'")
    assert calendar_from(stamps, "t").count() == 3


def test_small_calendars(spark):
    days = date_range(spark, dt.date(2011, 1, 1), dt.date(2014, 12, 31))
    small = small_date_dim(days)
    assert small.columns == ["FechaKey", "Fecha", "Anio", "Trimestre", "Mes", "NombreMes", "Semana", "DiaSemana"]
    assert small.count() == 1461
    row = with_calendar_columns(days, "Date").filter("Date = date'2012-02-29'").first()
    assert (row["Año"], row["Mes"], row["NombreMes"]) == (2012, 2, "Febrero")
    assert days.select(D.quarter_label("Date")).distinct().count() == 4


def test_sanity_of_a_sound_and_of_a_broken_calendar(spark):
    sound = date_dim(spark, 2019, 2024, as_of=AS_OF)
    facts = calendar_sanity(sound, AS_OF).first()
    assert facts["days"] == facts["different_days"] == facts["different_keys"] == facts["expected_days"] == 2192
    assert facts["today_rows"] == 1 and facts["longest_working_year"] == 262
    broken = calendar_sanity(sound.filter("Date <> date'2020-05-05'"), AS_OF).first()
    assert broken["days"] == broken["expected_days"] - 1
