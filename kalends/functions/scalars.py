"""Small column helpers whose NULL handling matters to the results."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from kalends.functions.dates import _col


def full_name(first: Column | str, last: Column | str, *, null_as_empty: bool = False) -> Column:
    """``first`` and ``last`` with a space between them.

    A missing part makes the whole name NULL, unless ``null_as_empty`` reads it as ''.
    The separator stays in both cases.
    """
    parts = [_col(first), _col(last)]
    if null_as_empty:
        parts = [F.coalesce(p, F.lit("")) for p in parts]
    return F.concat(parts[0], F.lit(" "), parts[1])


def safe_div(numerator: Column | str, denominator: Column | str) -> Column:
    """The ratio as a double; NULL where the denominator is zero or missing."""
    return F.try_divide(_col(numerator).cast("double"), _col(denominator).cast("double"))


def blank_minus(left: Column | str, right: Column | str) -> Column:
    """Difference that counts a missing side as 0 and is NULL only when both are missing."""
    left, right = _col(left), _col(right)
    zero_filled = F.coalesce(left, F.lit(0)) - F.coalesce(right, F.lit(0))
    return F.when(left.isNotNull() | right.isNotNull(), zero_filled)


def distinct_count(c: Column | str, *, count_blank: bool = True) -> Column:
    """Number of different values; a NULL is one more value when ``count_blank`` is set."""
    c = _col(c)
    counted = F.count_distinct(c)
    if not count_blank:
        return counted
    return counted + F.coalesce(F.max(c.isNull().cast("int")), F.lit(0))


def bucket_of(number: Column | str, buckets: Column | int) -> Column:
    """Deal 1, 2, 3, ... into ``buckets`` slots in turn: 1..k, then 1 again."""
    k = buckets if isinstance(buckets, Column) else F.lit(buckets)
    return F.pmod(_col(number) - 1, k) + 1
