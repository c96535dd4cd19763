"""What is in view when a measure is evaluated, and how a measure can change it.

Each result row of an evaluation sees the fact rows that pass the filters and carry the row's own column values. A
measure may change that view before its base measure is evaluated: replace the days in view by other days,
and drop filters by the name of their column. Days are replaced through a small relation of result rows and
days; the fact is reduced to one row per group and day before it meets that relation.
"""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from kalends.functions import dates as D
from kalends.operators.filters import in_set
from kalends.operators.joins import Star
from kalends.operators.timeintel import same_days_last_year

Where = dict[str, Callable[[Column], Column]]

#: Stands for every filter, whatever its column.
ALL = ("*",)
#: How the days in view can be replaced.
SAME_PERIOD, SALE_DAYS, FULL_YEAR = "same period last year", "sale days last year", "last full year"


@dataclass(frozen=True)
class Change:
    """Evaluate ``base`` in a changed view.

    ``days`` replaces the days in view: by the same period a year earlier through the calendar, by the days a year before
    the days that had sales, or by the whole calendar year before the last day that had sales. Filters on dates then no
    longer hold for the base measure. ``drop`` names columns whose filters, among them the value in the result's own
    column, are dropped; ``ALL`` drops every one.
    """

    base: str
    days: str | None = None
    drop: tuple[str, ...] = ()

    def drops(self, column: str) -> bool:
        return self.drop == ALL or column in self.drop


def in_view(star: Star, where: Where) -> DataFrame:
    """The fact rows that pass the tests; a test of a dimension's column is a semi join with the members that pass."""
    fact = star.fact
    for column, test in where.items():
        owner = star.owner_of(column)
        if owner is None:
            fact = fact.filter(test(F.col(f"`{column}`")))
        else:
            dimension = star.dimensions[owner]
            fact = in_set(fact, dimension.members(test(F.col(f"`{column}`"))), dimension.fact_key)
    return fact


def kept_filters(star: Star, where: Where, change: Change) -> Where:
    """The tests that still hold for the base measure of ``change``."""
    replaced = change.days is not None
    return {c: t for c, t in where.items() if not change.drops(c) and not (replaced and star.is_date(c))}


def same_period_days(star: Star, date_by: list[str], where: Where) -> DataFrame:
    """``date_by`` and, for each of its periods in view, the days (``_day``) a year earlier that the calendar has."""
    if star.calendar not in star.dimensions:
        raise ValueError(f"the same period last year needs a calendar, and the star has no dimension {star.calendar!r}")
    calendar = star.dimensions[star.calendar].rows
    visible = calendar
    for column, test in where.items():
        if star.owner_of(column) == star.calendar:
            visible = visible.filter(test(F.col(f"`{column}`")))
    names = [F.col(f"`{c}`") for c in date_by]
    return same_days_last_year(visible, calendar, names, single_days=bool({"Date", star.dimensions[star.calendar].key} & set(date_by)))


def sale_days_last_year(days: DataFrame, by: list[str]) -> DataFrame:
    """``by`` and the days (``_day``) a year before each sale day of ``days``; February 29th and March 1st meet there once."""
    return days.select(*[F.col(f"`{c}`") for c in by], D.previous_year_rolling("_day").alias("_day")).distinct()


def year_before_last_sale(days: DataFrame, by: list[str]) -> DataFrame:
    """``by`` and the year (``_year``) before that of the last sale day."""
    return days.groupBy(*[F.col(f"`{c}`") for c in by]).agg((F.year(F.max("_day")) - 1).alias("_year"))
