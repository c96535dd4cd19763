"""Calendars: ranges of days, and the date dimension that describes each day.

A calendar has one row per day of its range, so its size is bounded by the range
and never by the fact it describes. Bounds taken from data stay inside the plan
as a one-row aggregate; nothing is collected.
"""

from __future__ import annotations

import datetime as dt

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from kalends.functions import dates as D
from kalends.functions.names import DEFAULT_LANGUAGE, check_language

OPEN_END = dt.date(9999, 12, 31)

# The columns of the date dimension, in order.
DATE_COLUMNS = [
    "Date", "FiscalDate", "Year", "Month", "Month Name", "Month Name Short", "Month Name Complete",
    "Month Name Short Complete", "Quarter", "Week of Year", "Day", "Day of Week", "Day of Year", "Day Name",
    "IsoWeek", "IsoYear", "FiscalYear", "FiscalQuarter", "FiscalQuarterCode", "idFecha", "MonthKey",
    "QuarterCode", "Fiscal Week of Year", "DayOffset", "YearOffset", "MonthOffset", "QuarterOffset",
    "Current Year", "Current Month", "Current Week", "Current Day", "Current Fiscal Year",
    "Current Fiscal Month", "Current Fiscal Week", "IsWorkingDay", "WorkingDayNumber",
    "FiscalMonthNumber", "Fiscal Month Name",
]


#: The greatest span of a calendar whose bounds come from data, in years. Such calendars are sent to every executor; a stray
#: date in year 1 must not make them large.
MOST_YEARS = 1_000
#: Years of days that one task makes.
YEARS_A_TASK = 250


def _days(bounds: DataFrame, first: Column, last: Column) -> DataFrame:
    """The days from ``first`` to ``last`` of a one-row table; a span of more than ``MOST_YEARS`` stops the query."""
    too_long = F.year(last) - F.year(first) >= MOST_YEARS
    checked = F.when(too_long, F.raise_error(F.lit(f"the dates span more than {MOST_YEARS} years: name a date to ignore, or give the calendar by its parameters")).cast("date")).otherwise(last)
    return bounds.select(F.explode(F.sequence(first, checked, F.expr("interval 1 day"))).alias("Date"))


def _date(day: dt.date) -> Column:
    """The day as a literal; put together from numbers, as years before 1000 have no text that Spark reads."""
    return F.make_date(F.lit(day.year), F.lit(day.month), F.lit(day.day))


def date_range(spark: SparkSession, start: dt.date, end: dt.date) -> DataFrame:
    """One ``Date`` row per day from ``start`` to ``end``, both included.

    The span is cut into its years, which are dealt to tasks and spelled out there. It may be as long as dates go, which is
    9,999 years.
    """
    if end < start:
        raise ValueError(f"the range ends ({end}) before it starts ({start})")
    years = end.year - start.year + 1
    made = spark.range(start.year, end.year + 1, 1, -(-years // YEARS_A_TASK)).select(F.col("id").cast("int").alias("_year"))
    first = F.greatest(F.make_date("_year", F.lit(1), F.lit(1)), _date(start))
    last = F.least(F.make_date("_year", F.lit(12), F.lit(31)), _date(end))
    return made.select(F.explode(F.sequence(first, last, F.expr("interval 1 day"))).alias("Date"))


def date_bounds(df: DataFrame, columns: list[str], *, ignore: dt.date | None = OPEN_END) -> DataFrame:
    """column, first, last of several date columns, from one pass that repeats no row.

    ``ignore`` is the date that stands for "still open". A column without dates has NULL bounds.
    """
    def day(c: str) -> Column:
        value = F.to_date(F.col(f"`{c}`"))
        return value if ignore is None else F.when(value < F.lit(ignore), value)

    bounds = df.agg(*[f(day(c)).alias(f"{n}{i}") for i, c in enumerate(columns) for n, f in (("first", F.min), ("last", F.max))])
    return bounds.select(F.inline(F.array(*[
        F.struct(F.lit(c).alias("column"), F.col(f"first{i}").alias("first"), F.col(f"last{i}").alias("last")) for i, c in enumerate(columns)
    ])))


def calendar_over(bounds: DataFrame, *, lead_months: int = 0, whole_years: bool = False) -> DataFrame:
    """The days from the least ``first`` to the greatest ``last`` of some bounds (those of ``date_bounds``, of any tables)."""
    ends = bounds.agg(F.min("first").alias("first"), F.max("last").alias("last"))
    first, last = F.add_months("first", -lead_months), F.col("last")
    if whole_years:
        first = F.make_date(F.year(first), F.lit(1), F.lit(1))
        last = F.make_date(F.year(last), F.lit(12), F.lit(31))
    return _days(ends, first, last)


def calendar_from(
    fact: DataFrame,
    date_col: str,
    *,
    lead_months: int = 0,
    whole_years: bool = False,
    ignore: dt.date | None = OPEN_END,
) -> DataFrame:
    """The days spanned by a date column of ``fact``.

    ``lead_months`` starts the range that many months before the first date;
    ``whole_years`` widens it to January 1st and December 31st. ``ignore`` is the date
    that stands for "still open" and must not stretch the calendar.
    """
    return calendar_over(date_bounds(fact, [date_col], ignore=ignore), lead_months=lead_months, whole_years=whole_years)


def filled_days(per_day: DataFrame, *, whole_years: bool = False) -> DataFrame:
    """A table with one row per ``Date``, and a row for each day between that it lacks; ``_given`` tells them apart.

    Each row spells out the days up to the next one, so the table is read once and no calendar has to be joined. Columns of
    added days repeat those of the day before (of the first day, for days before it). A day table has as many rows as days at
    most, which bounds the one window over it.
    """
    order = Window.orderBy("Date")
    placed = per_day.withColumns({"_next": F.lead("Date").over(order), "_is_first": F.lag("Date").over(order).isNull()})
    new_year, new_years_eve = (F.make_date(F.year("Date"), F.lit(m), F.lit(d)) for m, d in ((1, 1), (12, 31)))
    start = F.when(F.col("_is_first"), new_year).otherwise(F.col("Date")) if whole_years else F.col("Date")
    end = F.coalesce(F.date_sub("_next", 1), new_years_eve if whole_years else F.col("Date"))
    spelled = placed.withColumn("_day", F.explode(F.sequence(start, end, F.expr("interval 1 day"))))
    others = [F.col(f"`{c}`") for c in per_day.columns if c != "Date"]
    return spelled.select(F.col("_day").alias("Date"), *others, (F.col("_day") == F.col("Date")).alias("_given"))


def _relative(value: Column, today: Column, unit: str) -> Column:
    return (
        F.when(value == today, "Current").when(value > today, f"Future {unit}").otherwise(f"Past {unit}")
    )


def describe_days(
    days: DataFrame,
    *,
    fiscal_start_month: int = 6,
    fiscal_year_basis: str = "End",
    lang: str = DEFAULT_LANGUAGE,
    as_of: dt.date | None = None,
    fiscal_week_mode: str = "shifted",
    columns: list[str] | None = None,
) -> DataFrame:
    """Describe each ``Date`` of ``days`` with the columns of the date dimension, or with some of them.

    ``as_of`` is the day the offsets and the Current/Past/Future labels refer to; without
    it they follow the session's current date. ``fiscal_week_mode`` says how far the date
    is moved back before its fiscal week is read: by ``fiscal_start_month`` months
    ("shifted", the customary column) or by one month less, so that the first day of
    the fiscal year falls in week 1 ("aligned").

    Everything but ``WorkingDayNumber`` is one projection; that running count is a window
    over the at most 366 days of a year, left out when it is not selected.
    """
    D.check_fiscal(fiscal_start_month, fiscal_year_basis)
    check_language(lang)
    if fiscal_week_mode not in ("shifted", "aligned"):
        raise ValueError(f"fiscal_week_mode must be 'shifted' or 'aligned', got {fiscal_week_mode!r}")
    today = F.current_date() if as_of is None else F.lit(as_of)
    day = F.col("Date")
    year, month, quarter = F.year(day), F.month(day), F.quarter(day)
    name = D.month_name(day, lang)
    working = ~D.day_of_week(day).isin(0, 6)
    fiscal_date = F.add_months(day, -fiscal_start_month)

    def fiscal_year(d: Column) -> Column:
        return D.fiscal_year(d, fiscal_start_month, fiscal_year_basis)

    def fiscal_week() -> Column:
        aligned = fiscal_week_mode == "aligned"
        return D.week_of_year(F.add_months(day, 1 - fiscal_start_month) if aligned else fiscal_date)

    def fiscal_quarter() -> Column:
        return D.fiscal_quarter(day, fiscal_start_month)

    def week_key(d: Column) -> Column:
        # Year and Sunday week side by side: a week that straddles New Year counts as two.
        return F.year(d) * 100 + D.week_of_year(d)

    def current_month() -> Column:
        return _relative(D.month_key(day), D.month_key(today), "Month")

    def current_week() -> Column:
        return _relative(week_key(day), week_key(today), "Week")

    rules = {
        "Date": lambda: day,
        "FiscalDate": lambda: fiscal_date,
        "Year": lambda: year,
        "Month": lambda: month,
        "Month Name": lambda: name,
        "Month Name Short": lambda: F.substring(name, 1, 3),
        "Month Name Complete": lambda: F.concat_ws(" ", name, year),
        "Month Name Short Complete": lambda: F.concat_ws(
            " ", F.substring(name, 1, 3), F.lpad(F.pmod(year, F.lit(100)).cast("string"), 2, "0")
        ),
        "Quarter": lambda: quarter,
        "Week of Year": lambda: D.week_of_year(day),
        "Day": lambda: F.dayofmonth(day),
        "Day of Week": lambda: D.day_of_week(day),
        "Day of Year": lambda: F.dayofyear(day),
        "Day Name": lambda: D.day_name(day, lang),
        "IsoWeek": lambda: D.iso_week(day),
        "IsoYear": lambda: D.iso_year(day),
        "FiscalYear": lambda: fiscal_year(day),
        "FiscalQuarter": fiscal_quarter,
        "FiscalQuarterCode": lambda: fiscal_year(day) * 100 + fiscal_quarter(),
        "idFecha": lambda: D.date_key(day),
        "MonthKey": lambda: D.month_key(day),
        "QuarterCode": lambda: D.quarter_key(day),
        "Fiscal Week of Year": fiscal_week,
        "DayOffset": lambda: F.datediff(day, today),
        "YearOffset": lambda: year - F.year(today),
        "MonthOffset": lambda: (year - F.year(today)) * 12 + (month - F.month(today)),
        "QuarterOffset": lambda: (year - F.year(today)) * 4 + (quarter - F.quarter(today)),
        "Current Year": lambda: _relative(year, F.year(today), "Year"),
        "Current Month": current_month,
        "Current Week": current_week,
        "Current Day": lambda: _relative(day, today, "Day"),
        "Current Fiscal Year": lambda: _relative(fiscal_year(day), fiscal_year(today), "Year"),
        "Current Fiscal Month": current_month,
        "Current Fiscal Week": current_week,
        "IsWorkingDay": lambda: working,
        "WorkingDayNumber": lambda: F.sum(working.cast("int")).over(
            Window.partitionBy(year).orderBy(day).rowsBetween(Window.unboundedPreceding, 0)
        ),
        "FiscalMonthNumber": lambda: D.fiscal_month_number(day, fiscal_start_month),
        "Fiscal Month Name": lambda: name,
    }
    return days.select(*[rules[c]().alias(c) for c in columns or DATE_COLUMNS])


def date_dim(
    spark: SparkSession,
    start_year: int,
    end_year: int,
    fiscal_start_month: int = 6,
    fiscal_year_basis: str = "End",
    lang: str = DEFAULT_LANGUAGE,
    as_of: dt.date | None = None,
    fiscal_week_mode: str = "shifted",
    columns: list[str] | None = None,
) -> DataFrame:
    """The date dimension for whole calendar years, ``start_year`` to ``end_year`` included."""
    if end_year < start_year:
        raise ValueError(f"end_year {end_year} lies before start_year {start_year}")
    return describe_days(
        date_range(spark, dt.date(start_year, 1, 1), dt.date(end_year, 12, 31)),
        fiscal_start_month=fiscal_start_month,
        fiscal_year_basis=fiscal_year_basis,
        lang=lang,
        as_of=as_of,
        fiscal_week_mode=fiscal_week_mode,
        columns=columns,
    )


def small_date_dim(days: DataFrame, lang: str = DEFAULT_LANGUAGE) -> DataFrame:
    """The eight-column calendar that goes with the star: key, date, parts and names."""
    day = F.col("Date")
    return days.select(
        D.date_key(day).alias("FechaKey"),
        day.alias("Fecha"),
        F.year(day).alias("Anio"),
        F.quarter(day).alias("Trimestre"),
        F.month(day).alias("Mes"),
        D.month_name(day, lang).alias("NombreMes"),
        D.week_of_year(day).alias("Semana"),
        D.day_name(day, lang).alias("DiaSemana"),
    )


def with_calendar_columns(df: DataFrame, date_col: str, lang: str = DEFAULT_LANGUAGE) -> DataFrame:
    """Add year, month number and month name columns to a flat table, read off its own date."""
    return df.withColumns({
        "Año": F.year(date_col),
        "Mes": F.month(date_col),
        "NombreMes": D.month_name(date_col, lang),
    })
