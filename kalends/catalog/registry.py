"""The named queries over the test tables, each with the SQL that must give the same rows.

Results are shaped for comparison: counts and keys are long, money is double (summed
exactly first), days are ISO text.
"""

from __future__ import annotations

import datetime as dt
from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

Query = Callable[[SparkSession, str], DataFrame]

QUERIES: dict[str, Query] = {}
ORACLES: dict[str, str] = {}

# The day the offsets and Current/Past/Future labels refer to; inside the range of the orders.
AS_OF = dt.date(1998, 6, 15)


def query(sql: str) -> Callable[[Query], Query]:
    """Register a function under its name, with its SQL counterpart."""
    def register(build: Query) -> Query:
        QUERIES[build.__name__] = build
        ORACLES[build.__name__] = sql
        return build
    return register


def whole(c: Column | str, name: str | None = None) -> Column:
    column = F.col(f"`{c}`") if isinstance(c, str) else c
    return column.cast("long").alias(name or c)


def money(c: Column | str, name: str | None = None) -> Column:
    column = F.col(f"`{c}`") if isinstance(c, str) else c
    return column.cast("double").alias(name or c)


def text(c: Column | str, name: str | None = None) -> Column:
    column = F.col(f"`{c}`") if isinstance(c, str) else c
    return column.cast("string").alias(name or c)


# SQL fragments. `lines` has one row per order line with its exact amount and the order's keys.
LINES = """lines AS (
  SELECT l_orderkey, l_linenumber, l_partkey, l_suppkey, l_shipdate, l_quantity, l_extendedprice, l_discount,
         CAST(l_shipdate AS DATE) AS shipped, CAST(o_orderdate AS DATE) AS d, o_custkey, o_orderstatus,
         c_nationkey AS t,
         CAST(CAST(l_extendedprice AS DECIMAL(15,2)) * (1 - CAST(l_discount AS DECIMAL(4,2))) AS DECIMAL(19,4))
           AS amount
  FROM lineitem JOIN orders ON o_orderkey = l_orderkey LEFT JOIN customer ON c_custkey = o_custkey)"""

# `cal` has the days of the whole years that hold an order date.
CAL = """cal AS (
  SELECT CAST(unnest(generate_series(CAST(make_date(year(min(o_orderdate)), 1, 1) AS TIMESTAMP),
                                     CAST(make_date(year(max(o_orderdate)), 12, 31) AS TIMESTAMP),
                                     INTERVAL 1 DAY)) AS DATE) AS d
  FROM orders)"""

# Sunday weeks: %U counts them from the first Sunday, so add 1 unless January 1st is that Sunday.
WEEK = """(CAST(strftime({d}, '%U') AS BIGINT)
  + CASE WHEN dayofweek(make_date(year({d}), 1, 1)) = 0 THEN 0 ELSE 1 END)"""


def week_sql(day: str) -> str:
    return WEEK.format(d=day)
