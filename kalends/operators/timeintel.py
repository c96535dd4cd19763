"""Comparing a period with the year before.

All operators work on day totals: one row per group and day, so the fact is reduced
before any date is shifted, and a fact is never joined with a fact. Periods are given
as ``{"Year": F.year, "Month": F.month}``: names, and what they make of a date column.

Every result has the grouping columns, the period columns, ``sales`` and ``ly``. Groups
may be NULL (the blank member) and stay one group.
"""

from __future__ import annotations

from collections.abc import Callable
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from kalends.functions import dates as D
from kalends.functions.scalars import blank_minus, safe_div

Periods = dict[str, Callable[[Column], Column]]


def day_totals(fact: DataFrame, date_col: str, by: list[str], amount: str = "LineTotal") -> DataFrame:
    """Sales per group and day. A time of day on ``date_col`` is ignored."""
    return fact.groupBy(*by, F.to_date(date_col).alias("Date")).agg(F.sum(amount).alias("sales"))


def _named(periods: Periods) -> list[Column]:
    return [part(F.col("Date")).alias(name) for name, part in periods.items()]


def _same(left: DataFrame, right: DataFrame, pairs: list[tuple[str, str]]) -> Column:
    """NULL-safe equality, so that the blank member meets itself."""
    return reduce(lambda a, b: a & b, [left[l].eqNullSafe(right[r]) for l, r in pairs])


def prior_year_days(calendar: DataFrame, periods: Periods, *, single_days: bool = False) -> DataFrame:
    """The days of ``calendar`` that lie one year before each period of ``calendar``.

    A day maps to the same day a year earlier, February 29th to the 28th. For periods longer
    than a day the end of a month maps to the end of the month, so a whole February covers a
    29th of the year before. Days outside the calendar are left out. One row per period and
    day (``_day``): at most two rows per calendar day.
    """
    return same_days_last_year(calendar, calendar, _named(periods), single_days=single_days)


def same_days_last_year(in_view: DataFrame, calendar: DataFrame, names: list[Column], *, single_days: bool) -> DataFrame:
    """``names`` of the days ``in_view``, and beside them each day of ``calendar`` (``_day``) one year earlier."""
    shifted = D.previous_year_clamped("Date")
    if single_days:
        priors = in_view.select(*names, shifted.alias("_day"))
    else:
        ends_month = F.col("Date") == F.last_day("Date")
        until = F.when(ends_month, F.last_day(shifted)).otherwise(shifted)
        priors = in_view.select(*names, F.explode(F.sequence(shifted, until)).alias("_day")).distinct()
    return priors.join(calendar.select(F.col("Date").alias("_day")), "_day", "left_semi")


def ly_dense(
    totals: DataFrame, calendar: DataFrame, by: list[str], periods: Periods, *, single_days: bool = False
) -> DataFrame:
    """Last year's sales through the calendar, whether or not this year's days had sales.

    The calendar decides which days count: over whole years a period is compared with the
    whole period before; a calendar that stops in August compares the last year with the
    first eight months of the one before. Days without a calendar row form a blank period.

    The shift is a table from day to period, one set of rows for "now" and one for "a year
    ago", so the totals are read once and joined with something of calendar size.
    """
    now = calendar.select(F.col("Date").alias("_day"), *_named(periods), F.lit(True).alias("_is_now"))
    ago = prior_year_days(calendar, periods, single_days=single_days).withColumn("_is_now", F.lit(False))
    roles = F.broadcast(now.unionByName(ago))  # at most three rows per calendar day
    is_now = F.coalesce("_is_now", F.lit(True))
    return (
        totals.join(roles, totals["Date"] == roles["_day"], "left")
        .groupBy(*by, *periods)
        .agg(
            F.sum(F.when(is_now, F.col("sales"))).alias("sales"),
            F.sum(F.when(~is_now, F.col("sales"))).alias("ly"),
        )
    )


def ly_sparse(
    totals: DataFrame,
    by: list[str],
    periods: Periods,
    *,
    date_filter: Column | None = None,
    all_totals: DataFrame | None = None,
) -> DataFrame:
    """Last year's sales on the days, one year back, of the days that had sales this year.

    Days without a sale in the current context drop the matching day of last year: the
    answer depends on the group. February 29th rolls to March 1st, and days that meet there
    count once. ``date_filter`` narrows the current days only. Given ``all_totals``
    (``Date``, ``sales``), last year is looked up there and so ignores every other filter.
    """
    current = totals if date_filter is None else totals.filter(date_filter)
    shifted = (
        current.select(*by, *_named(periods), D.previous_year_rolling("Date").alias("prior"), "sales")
        .groupBy(*by, *periods, "prior")
        .agg(F.sum("sales").alias("sales"))
    )
    lookup_by = by if all_totals is None else []
    lookup = (totals if all_totals is None else all_totals).select(
        *[F.col(c).alias(f"_{c}") for c in lookup_by], F.col("Date").alias("_day"), F.col("sales").alias("ly")
    )
    found = shifted.join(
        lookup, _same(shifted, lookup, [(c, f"_{c}") for c in lookup_by] + [("prior", "_day")]), "left"
    )
    return found.groupBy(*by, *periods).agg(F.sum("sales").alias("sales"), F.sum("ly").alias("ly"))


def ly_full_year(
    totals: DataFrame, by: list[str], periods: Periods, *, date_filter: Column | None = None
) -> DataFrame:
    """Sales of the whole calendar year before the latest sale date in the context.

    Filters on other columns stay, so the year total is taken within the same group.
    """
    current = totals if date_filter is None else totals.filter(date_filter)
    context = (
        current.select(*by, *_named(periods), "Date", "sales")
        .groupBy(*by, *periods)
        .agg(F.sum("sales").alias("sales"), (F.year(F.max("Date")) - 1).alias("_year"))
    )
    years = (
        totals.groupBy(*[F.col(c).alias(f"_{c}") for c in by], F.year("Date").alias("_total_year"))
        .agg(F.sum("sales").alias("ly"))
    )
    return (
        context.join(years, _same(context, years, [(c, f"_{c}") for c in by] + [("_year", "_total_year")]), "left")
        .select(*by, *periods, "sales", "ly")
    )


def with_yoy(compared: DataFrame) -> DataFrame:
    """Add the difference to last year, its ratio, and the parallel period (last year's value again).

    A missing side of the difference counts as 0; the ratio is NULL when last year is missing or 0.
    """
    return compared.withColumns({
        "yoy": blank_minus("sales", "ly"),
        "yoy_pct": safe_div(blank_minus("sales", "ly"), "ly"),
        "parallel_period": F.col("ly"),
    })


def in_relative_period(totals: DataFrame, calendar: DataFrame, condition: Column) -> DataFrame:
    """Totals of the calendar days that satisfy ``condition``, such as ``F.col("YearOffset") == 0``."""
    return totals.join(F.broadcast(calendar.filter(condition).select("Date")), "Date", "left_semi")


def regroup(totals: DataFrame, members: DataFrame, key: str, by: list[str]) -> DataFrame:
    """Day totals per member turned into day totals per member attribute.

    ``members`` has ``key`` and the columns ``by``. The totals come reduced to one row per
    member and day, so a member that owns much of the fact meets the join with few rows.
    """
    return (
        totals.join(members.select(key, *by), key, "left").groupBy(*by, "Date").agg(F.sum("sales").alias("sales"))
    )
