"""Date expressions: keys, week numbers, fiscal parts, names and year shifts.

Every function takes a column (or its name) and returns a ``Column`` built from
Spark's own functions, so a calendar or a fact can be described inside one
code-generated projection.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from kalends.functions.names import DAYS, DEFAULT_LANGUAGE, MONTHS, check_language

FISCAL_BASES = ("Start", "End")
GRAINS = ("day", "month", "quarter", "year")


def _col(c: Column | str) -> Column:
    return F.col(c) if isinstance(c, str) else c


def check_fiscal(fiscal_start_month: int, fiscal_year_basis: str) -> None:
    if fiscal_start_month not in range(1, 13):
        raise ValueError(f"fiscal_start_month must lie in 1..12, got {fiscal_start_month!r}")
    if fiscal_year_basis not in FISCAL_BASES:
        raise ValueError(f"fiscal_year_basis must be one of {FISCAL_BASES}, got {fiscal_year_basis!r}")


def date_key(c: Column | str) -> Column:
    """The day as the integer yyyymmdd."""
    c = _col(c)
    return F.year(c) * 10000 + F.month(c) * 100 + F.dayofmonth(c)


def month_key(c: Column | str) -> Column:
    """The month as the integer yyyymm."""
    c = _col(c)
    return F.year(c) * 100 + F.month(c)


def quarter_key(c: Column | str) -> Column:
    """The quarter as the integer yyyy0q."""
    c = _col(c)
    return F.year(c) * 100 + F.quarter(c)


def period_key(c: Column | str, grain: str) -> Column:
    """The integer key of the period of the given grain that holds the day."""
    keys = {"day": date_key, "month": month_key, "quarter": quarter_key, "year": lambda d: F.year(_col(d))}
    if grain not in keys:
        raise ValueError(f"grain must be one of {GRAINS}, got {grain!r}")
    return keys[grain](c)


def day_of_week(c: Column | str) -> Column:
    """Weekday number with Sunday as 0."""
    return F.dayofweek(_col(c)) - 1


def week_of_year(c: Column | str) -> Column:
    """Week number with weeks starting on Sunday and week 1 holding January 1st.

    Spelled out because the pattern letter ``w`` is refused by Spark's date formatter.
    """
    c = _col(c)
    days_since_first_sunday = F.dayofyear(c) + day_of_week(F.trunc(c, "year")) - 1
    return (F.floor(days_since_first_sunday / 7) + 1).cast("int")


def iso_week(c: Column | str) -> Column:
    return F.weekofyear(_col(c))


def iso_year(c: Column | str) -> Column:
    """The year the ISO week belongs to, which differs from the calendar year around January 1st."""
    return F.extract(F.lit("YEAROFWEEK"), _col(c))


def _lookup(names: list[str], index: Column) -> Column:
    return F.element_at(F.array(*[F.lit(n) for n in names]), index)


def month_name(c: Column | str, lang: str = DEFAULT_LANGUAGE) -> Column:
    return _lookup(MONTHS[check_language(lang)], F.month(_col(c)))


def day_name(c: Column | str, lang: str = DEFAULT_LANGUAGE) -> Column:
    return _lookup(DAYS[check_language(lang)], F.dayofweek(_col(c)))


def quarter_label(c: Column | str) -> Column:
    """Quarter label in Spanish, such as ``Trim. 3``."""
    return F.concat(F.lit("Trim. "), F.quarter(_col(c)).cast("string"))


def fiscal_month_number(c: Column | str, fiscal_start_month: int) -> Column:
    """Position of the month inside its fiscal year, 1 to 12."""
    return F.pmod(F.month(_col(c)) - fiscal_start_month, F.lit(12)) + 1


def fiscal_quarter(c: Column | str, fiscal_start_month: int) -> Column:
    """Three fiscal months to a quarter, counted from the starting month."""
    return F.ceil(fiscal_month_number(c, fiscal_start_month) / 3).cast("int")


def fiscal_year(c: Column | str, fiscal_start_month: int, fiscal_year_basis: str) -> Column:
    """The fiscal year, named after the calendar year it starts in or the one after that."""
    check_fiscal(fiscal_start_month, fiscal_year_basis)
    c = _col(c)
    named_after = F.year(c) if fiscal_year_basis == "Start" else F.year(c) + 1
    return named_after - (F.month(c) < fiscal_start_month).cast("int")


def previous_year_rolling(c: Column | str) -> Column:
    """The same month and day one year earlier; February 29th rolls over to March 1st."""
    c = _col(c)
    return F.date_add(F.make_date(F.year(c) - 1, F.month(c), F.lit(1)), F.dayofmonth(c) - 1)


def previous_year_clamped(c: Column | str) -> Column:
    """The same month and day one year earlier; February 29th is clamped to the 28th."""
    return F.add_months(_col(c), -12)
