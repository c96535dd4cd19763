"""Checks of a model: fan-out, keys, totals, repetition, date coverage, calendar sanity."""

from __future__ import annotations

import datetime as dt
from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from kalends.functions.scalars import safe_div
from kalends.operators.calendar import date_bounds
from kalends.operators.distinct import distinct_counts


def _stacked(parts: list[DataFrame]) -> DataFrame:
    return reduce(DataFrame.unionByName, parts)


def fanout_audit(
    fact: DataFrame, fact_key: str, other: DataFrame, other_key: str, amount: str,
    labels: tuple[str, str] = ("A. without the join", "B. with the join"),
) -> DataFrame:
    """Rows and total of ``fact`` before and after an inner join with ``other``, one row each.

    The join itself is never made: both sides are counted per key, and a key's rows and
    amount are multiplied by its number of partners. That gives exactly the joined rows and
    total, in one pass over the fact, also for a key that owns most of the rows.
    """
    per_key = fact.groupBy(F.col(fact_key).alias("key")).agg(
        F.count(F.lit(1)).alias("rows"), F.sum(amount).alias("total")
    )
    partners = other.groupBy(F.col(other_key).alias("key")).agg(F.count(F.lit(1)).alias("partners"))
    both = per_key.join(partners, "key", "left").agg(
        F.struct(F.lit(labels[0]).alias("version"), F.sum("rows").alias("rows"),
                 F.sum(F.col("total").cast("decimal(38,4)")).alias("total")).alias("before"),
        F.struct(F.lit(labels[1]).alias("version"),
                 F.coalesce(F.sum(F.col("rows") * F.col("partners")), F.lit(0)).alias("rows"),
                 F.sum((F.col("total") * F.col("partners")).cast("decimal(38,4)")).alias("total")).alias("after"),
    )
    return both.select(F.inline(F.array("before", "after")))


def duplicate_keys(dimension: DataFrame, keys: list[str]) -> DataFrame:
    """Key values that occur more than once, with their row count: none in a sound dimension."""
    return dimension.groupBy(*keys).agg(F.count(F.lit(1)).alias("rows")).filter("rows > 1")


def reconcile(tables: dict[str, DataFrame], amount: str) -> DataFrame:
    """Row count and total of each table, side by side, to be compared."""
    return _stacked([
        df.agg(F.count(F.lit(1)).alias("rows"), F.sum(amount).alias("total")).withColumn("model", F.lit(name))
        for name, df in tables.items()
    ])


def repetition(flat: DataFrame, customer: str, product: str, territory: str) -> DataFrame:
    """How often a flat table repeats its customers and products, in one row."""
    counts = distinct_counts(flat, {"customers": [customer], "products": [product], "territories": [territory]})
    return counts.withColumns({
        "rows_per_customer": safe_div("rows", "customers"),
        "rows_per_product": safe_div("rows", "products"),
    })


def row_counts(tables: dict[str, DataFrame]) -> DataFrame:
    """The row counts of several tables as one row, a column per table."""
    spark = next(iter(tables.values())).sparkSession
    return spark.range(1).select(*[
        df.agg(F.count(F.lit(1))).scalar().alias(name) for name, df in tables.items()
    ])


def cardinality(
    tables: dict[str, tuple[DataFrame, list[str]]], *, approx: bool = False, stored: frozenset[str] = frozenset()
) -> DataFrame:
    """Rows and number of different values of chosen columns, one row per table and column.

    Exact counts take one narrow pass per column; ``stored`` names the tables whose columns can be read again at little
    cost, those of the others are written once. ``approx`` keeps one small sketch per column instead.
    """
    parts = []
    for table, (df, columns) in tables.items():
        names = {f"n{i}": [c] for i, c in enumerate(columns)}
        profile = df.agg(
            F.count(F.lit(1)).alias("rows"), *[F.approx_count_distinct(F.col(f"`{c}`")).alias(n) for n, (c,) in names.items()]
        ) if approx else distinct_counts(df, names, stored=table in stored)
        per_column = F.array(*[F.struct(F.lit(c).alias("column"), F.col(n).alias("values")) for n, (c,) in names.items()])
        parts.append(profile.select(F.lit(table).alias("table"), "rows", F.inline(per_column)))
    return _stacked(parts)


def date_columns(df: DataFrame) -> list[str]:
    """The columns of ``df`` that hold dates or timestamps."""
    return [f.name for f in df.schema.fields if isinstance(f.dataType, (T.DateType, T.TimestampType, T.TimestampNTZType))]


def date_coverage(tables: dict[str, DataFrame], calendar: DataFrame, related: set[tuple[str, str]]) -> DataFrame:
    """For each date column of each table: how many of its rows have a day in the calendar.

    ``related`` lists the (table, column) pairs that are already connected to the calendar;
    the others are candidates. Rows are counted per day before the calendar is consulted.
    """
    known = F.broadcast(calendar.select("Date", F.lit(True).alias("known")))
    parts = []
    for table, df in tables.items():
        for column in date_columns(df):
            per_day = df.groupBy(F.to_date(column).alias("Date")).agg(F.count(F.lit(1)).alias("n"))
            parts.append(
                per_day.filter("Date is not null").join(known, "Date", "left")
                .agg(
                    F.coalesce(F.sum("n"), F.lit(0)).alias("dated_rows"),
                    F.coalesce(F.sum(F.when(F.col("known"), F.col("n"))), F.lit(0)).alias("in_calendar"),
                    F.count_if(F.col("known").isNull()).alias("unknown_days"),
                )
                .select(
                    F.lit(table).alias("table"), F.lit(column).alias("column"),
                    F.lit((table, column) in related).alias("related"),
                    "dated_rows", "in_calendar", "unknown_days",
                )
            )
    return _stacked(parts)


def unrelated_date_columns(tables: dict[str, DataFrame], related: set[tuple[str, str]]) -> list[tuple[str, str]]:
    """The date columns that are not connected to the calendar yet; read from the schemas alone."""
    return [(t, c) for t, df in tables.items() for c in date_columns(df) if (t, c) not in related]


def calendar_sanity(calendar: DataFrame, as_of: dt.date) -> DataFrame:
    """One row of facts about a date dimension that should hold without gaps or repeats."""
    return calendar.agg(
        F.count(F.lit(1)).alias("days"),
        F.count_distinct("Date").alias("different_days"),
        F.count_distinct("idFecha").alias("different_keys"),
        F.min("Date").alias("first_day"),
        F.max("Date").alias("last_day"),
        (F.datediff(F.max("Date"), F.min("Date")) + 1).alias("expected_days"),
        F.count_if((F.col("Current Day") == "Current") & (F.col("Date") == F.lit(as_of))).alias("today_rows"),
        F.count_if("IsWorkingDay").alias("working_days"),
        F.max("WorkingDayNumber").alias("longest_working_year"),
    )


def correction_impact(flat: DataFrame, dimension: DataFrame, column: str, *, counted: str | None = None) -> DataFrame:
    """Rows to rewrite when a value of ``column`` is corrected, in the flat table and in the dimension.

    ``counted`` names a column of ``flat`` that says how many rows of the flat table each of its rows stands for.
    """
    def per_value(df: DataFrame, name: str, rows: str | None = None) -> DataFrame:
        return df.groupBy(F.col(column).alias("value")).agg((F.sum(rows) if rows else F.count(F.lit(1))).alias(name))

    both = per_value(flat, "flat_rows", counted).unionByName(per_value(dimension, "dimension_rows"), allowMissingColumns=True)
    return both.groupBy("value").agg(
        F.coalesce(F.sum("flat_rows"), F.lit(0)).alias("flat_rows"),
        F.coalesce(F.sum("dimension_rows"), F.lit(0)).alias("dimension_rows"),
    )


def days_outside(tables: dict[str, DataFrame], calendar: DataFrame) -> DataFrame:
    """table, column, first, last of every date column, and whether the calendar reaches that far on either side.

    One pass per table, however many date columns it has; the calendar's own bounds are one row.
    """
    reach = calendar.agg(F.min("Date").alias("from"), F.max("Date").alias("to"))
    start, end = reach.select("from").scalar(), reach.select("to").scalar()
    return _stacked([
        date_bounds(df, date_columns(df)).select(F.lit(name).alias("table"), "*")
        for name, df in tables.items() if date_columns(df)
    ]).withColumns({
        "starts_inside": F.col("first") >= start, "ends_inside": F.col("last") <= end,
    })
