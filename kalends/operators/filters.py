"""Filters the models apply: date slicers, set filters, today's row, first rows."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from kalends.operators.joins import BROADCAST_ROWS


def between_dates(df: DataFrame, date_col: str, first: dt.date, last: dt.date) -> DataFrame:
    """Rows dated ``first`` to ``last``, both days whole.

    The bounds are put on the bare column, half-open at the end, so the predicate reaches
    the Parquet scan and a time of day on the last date is kept.
    """
    return df.filter((F.col(date_col) >= F.lit(first)) & (F.col(date_col) < F.lit(last + dt.timedelta(days=1))))


def in_set(df: DataFrame, values: DataFrame, on: str) -> DataFrame:
    """Keep the rows whose ``on`` value occurs in ``values``, each row once (a semi join)."""
    return df.join(values.select(on), on, "left_semi")


#: Bits of the filter of many keys: 4 MB, whatever their number.
FILTER_BITS = 1 << 25


def within_keys(df: DataFrame, on: str, keys: DataFrame) -> DataFrame:
    """Drop rows of ``df`` that cannot match one of ``keys``, in the stage that scans ``df``: nothing is shuffled.

    Few keys are sent to the scan and meet every row there, which is exact. Of many keys the scan gets a filter of fixed
    size that lets some others through: the join that follows decides.
    """
    if keys.count() <= BROADCAST_ROWS:
        return in_set(df, F.broadcast(keys.select(on)), on)
    return df.filter(_may_be_among(F.col(on), keys.select(F.col(on).alias("_key"))))


def _may_be_among(column: Column, keys: DataFrame) -> Column:
    """Whether the hash of ``column`` is the hash of one of ``keys``, by an array of 64-bit words that the plan carries."""
    def place(value: Column) -> Column:
        return F.pmod(F.xxhash64(value), F.lit(FILTER_BITS))

    bits = keys.select(place(F.col("_key")).alias("_at")).select((F.col("_at") / 64).cast("int").alias("_word"), F.pmod("_at", F.lit(64)).cast("int").alias("_bit"))
    words = bits.groupBy("_word").agg(F.bit_or(F.expr("shiftleft(1L, _bit)")).alias("_bits"))
    every = keys.sparkSession.range(FILTER_BITS // 64).select(F.col("id").cast("int").alias("_word"), F.lit(0).cast("long").alias("_bits"))
    filled = words.unionByName(every).groupBy("_word").agg(F.bit_or("_bits").alias("_bits"))
    array = filled.agg(F.transform(F.array_sort(F.collect_list(F.struct("_word", "_bits"))), lambda w: w["_bits"]).alias("words"))
    at = place(column)
    word = F.element_at(array.scalar(), (at / 64).cast("int") + 1)
    return F.getbit(word, F.pmod(at, F.lit(64)).cast("int")) == 1


def non_blank(df: DataFrame, columns: list[str]) -> DataFrame:
    """Drop the rows in which every one of ``columns`` is missing."""
    return df.dropna(how="all", subset=columns)


def today_row(calendar: DataFrame, as_of: dt.date | None = None) -> DataFrame:
    """The calendar's row for ``as_of`` (the session's current date when not given)."""
    today: Column = F.current_date() if as_of is None else F.lit(as_of)
    return calendar.filter(F.col("Date") == today)


def first_rows(df: DataFrame, n: int, order_by: list) -> DataFrame:
    """The first ``n`` rows in the given order (a heap per task, no full sort)."""
    return df.orderBy(*order_by).limit(n)
