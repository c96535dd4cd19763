"""Queries that evaluate measures: by dimension, by period, against last year, along hierarchies."""

from __future__ import annotations

import datetime as dt
from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from kalends.catalog.calendars import order_calendar, order_days
from kalends.catalog.registry import AS_OF, CAL, LINES, money, query, text, week_sql, whole
from kalends.functions.dates import month_name
from kalends.functions.names import MONTHS
from kalends.functions.scalars import safe_div
from kalends.operators import timeintel as ti
from kalends.operators.calendar import calendar_from, with_calendar_columns
from kalends.operators.filters import between_dates, first_rows
from kalends.operators.hierarchy import day_sets, in_order, set_rollup
from kalends.operators.joins import DateRole, Star, by_role
from kalends.operators.measures import FLAT_FIELDS, days_without_purchase, evaluate, measure_rows, values_of
from kalends.operators.ranges import date_ranges_text
from kalends.plans import flat as flat_plans
from kalends.plans import star as star_plans
from kalends.sources import samples
from kalends.storage import materialise


def sales_star(
    spark: SparkSession, sf_dir: str, dimensions: list[str], calendar: list[str] | None = None, *, territory: bool = True
) -> Star:
    """The star over the order system, with the dimensions and calendar columns a query asks for.

    Without ``territory`` the fact has no territory key, which spares a join with the customers.
    """
    days = order_calendar(spark, sf_dir, "Date", "idFecha", *(calendar or []))
    if calendar:
        dimensions = [*dimensions, "Fecha"]
    return star_plans.star_from_order_entry(
        samples.order_entry(spark, sf_dir, territory=territory), days, dimensions or ["Dim_Territorio"]
    )


def orders_with_sales(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Sales and lines per order, without territories."""
    return star_plans.order_totals(samples.order_entry(spark, sf_dir, territory=False))


def all_days(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ti.day_totals(orders_with_sales(spark, sf_dir), "OrderDate", [])


def territory_days(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Sales per territory and day, by way of sales per customer and day."""
    homes = samples.table(spark, sf_dir, "customer").select(
        F.col("c_custkey").alias("ClienteKey"), F.col("c_nationkey").alias("TerritorioKey")
    )
    per_customer = ti.day_totals(orders_with_sales(spark, sf_dir), "OrderDate", ["ClienteKey"])
    return ti.regroup(per_customer, homes, "ClienteKey", ["TerritorioKey"])


YEAR = {"year": F.year}
MONTH = {"year": F.year, "month": F.month}
DAY = {"day": lambda date: date}


def _compared(df: DataFrame, keys: list[str]) -> DataFrame:
    columns = df.columns
    return df.select(*[
        text(c, "date") if c == "Date" else
        whole(c, {"TerritorioKey": "territorio_key"}.get(c, c)) if c in keys else money(c)
        for c in columns
    ])


# --- measures -----------------------------------------------------------------------------------

_ALL_MEASURES_SQL = """CAST(sum(amount) AS DOUBLE) AS sales, count(*) AS lines,
       count(DISTINCT o_custkey) AS customers, count(DISTINCT l_partkey) AS products,
       count(DISTINCT t) AS territories, count(DISTINCT l_orderkey) AS orders, count(DISTINCT d) AS purchase_days,
       count(DISTINCT l_partkey * 1000 + t) AS product_territory_pairs,
       CAST(sum(amount) AS DOUBLE) / count(DISTINCT l_orderkey) AS average_ticket,
       date_diff('day', min(d), max(d)) + 1 - count(DISTINCT d) AS days_without_purchase"""
_ALL_MEASURES = ["sales", "lines", "customers", "products", "territories", "orders", "purchase_days",
                 "product_territory_pairs", "average_ticket", "days_without_purchase"]


def _shaped_measures(df: DataFrame, *keys) -> DataFrame:
    return df.select(*keys, *[
        money(c) if c in ("sales", "average_ticket") else whole(c) for c in df.columns if c in _ALL_MEASURES
    ])


@query(f"WITH {LINES} SELECT {_ALL_MEASURES_SQL} FROM lines")
def measures_total(spark, sf_dir):
    """Every measure as a grand total."""
    return _shaped_measures(evaluate(sales_star(spark, sf_dir, []), [], _ALL_MEASURES))


@query(f"""WITH {LINES} SELECT n_name AS territorio, {_ALL_MEASURES_SQL}
FROM lines LEFT JOIN nation ON n_nationkey = t GROUP BY 1""")
def measures_by_territory(spark, sf_dir):
    return _shaped_measures(
        evaluate(sales_star(spark, sf_dir, ["Dim_Territorio"]), ["Territorio"], _ALL_MEASURES), F.col("Territorio").alias("territorio")
    )


@query(f"""WITH {LINES} SELECT year(d) AS anio, month(d) AS mes, {MONTHS['es']}[month(d)] AS nombre_mes,
{_ALL_MEASURES_SQL} FROM lines GROUP BY 1, 2, 3""")
def measures_by_month_flat(spark, sf_dir):
    """Every measure on the flat table, by the year and month columns it carries itself."""
    t = samples.order_entry(spark, sf_dir)
    flat = flat_plans.flat_from_order_entry(t).withColumnsRenamed({
        "SalesOrderID": "SalesOrderNumber", "CustomerID": "ClienteID", "ProductID": "ProductoID",
        "TerritoryID": "TerritorioID",
    })
    by_month = measure_rows(
        with_calendar_columns(flat, "OrderDate"), ["Año", "Mes", "NombreMes"], _ALL_MEASURES, FLAT_FIELDS
    )
    return _shaped_measures(by_month, whole("Año", "anio"), whole("Mes", "mes"), F.col("NombreMes").alias("nombre_mes"))


@query(f"""WITH {LINES} SELECT r_name AS grupo, p_type AS categoria, CAST(sum(amount) AS DOUBLE) AS sales
FROM lines LEFT JOIN nation ON n_nationkey = t LEFT JOIN region ON r_regionkey = n_regionkey
LEFT JOIN part ON p_partkey = l_partkey GROUP BY 1, 2""")
def sales_by_group_category(spark, sf_dir):
    """One measure by columns of two dimensions."""
    return evaluate(
        sales_star(spark, sf_dir, ["Dim_Territorio", "Dim_Producto"]), ["Grupo", "Categoria"], ["sales"]
    ).select(
        F.col("Grupo").alias("grupo"), F.col("Categoria").alias("categoria"), money("sales")
    )


@query(f"""WITH {LINES} SELECT p_type AS categoria, CAST(sum(amount) AS DOUBLE) AS sales, count(*) AS lines
FROM lines JOIN nation ON n_nationkey = t JOIN region ON r_regionkey = n_regionkey AND r_name = 'ASIA'
LEFT JOIN part ON p_partkey = l_partkey WHERE year(d) = 1998 GROUP BY 1""")
def sales_of_group_and_year(spark, sf_dir):
    """Filters on two dimensions that are not shown themselves."""
    filtered = evaluate(
        sales_star(spark, sf_dir, ["Dim_Territorio", "Dim_Producto"], ["Year"]), ["Categoria"], ["sales", "lines"],
        where={"Grupo": lambda c: c == "ASIA", "Year": lambda c: c == 1998},
    )
    return filtered.select(F.col("Categoria").alias("categoria"), money("sales"), whole("lines"))


@query("SELECT DISTINCT replace(c_name, '#', ' ') AS nombre_cliente FROM customer")
def distinct_customer_names(spark, sf_dir):
    """The values of a dimension column."""
    return values_of(sales_star(spark, sf_dir, ["Dim_Cliente"], territory=False), "NombreCliente").select(
        F.col("NombreCliente").alias("nombre_cliente")
    )


@query(f"""WITH {LINES}, x AS (SELECT DISTINCT p_type, l_partkey, t FROM lines LEFT JOIN part ON p_partkey = l_partkey)
SELECT p_type AS categoria, count(*) AS pairs FROM x GROUP BY 1""")
def product_territory_pairs(spark, sf_dir):
    """Combinations of product and territory that were sold, by category."""
    return evaluate(sales_star(spark, sf_dir, ["Dim_Producto"]), ["Categoria"], ["product_territory_pairs"]).select(
        F.col("Categoria").alias("categoria"), whole("product_territory_pairs", "pairs")
    )


@query(f"""WITH {LINES} SELECT p_name AS producto, count(DISTINCT d) AS purchase_days,
       date_diff('day', min(d), max(d)) + 1 - count(DISTINCT d) AS days_without_purchase
FROM lines JOIN part ON p_partkey = l_partkey GROUP BY 1""")
def days_without_sales_flat(spark, sf_dir):
    """Days without a sale between a product's first and last sale."""
    star = sales_star(spark, sf_dir, ["Dim_Producto"], territory=False)
    return evaluate(star, ["Producto"], ["purchase_days", "days_without_purchase"]).select(
        F.col("Producto").alias("producto"), whole("purchase_days"), whole("days_without_purchase")
    )


@query(f"""WITH {CAL}, {LINES}, days AS (SELECT date_diff('day', min(d), max(d)) + 1 AS n FROM cal)
SELECT p_name AS producto, count(DISTINCT lines.d) AS purchase_days,
       (SELECT n FROM days) - count(DISTINCT lines.d) AS days_without_purchase
FROM lines JOIN part ON p_partkey = l_partkey GROUP BY 1""")
def days_without_sales_star(spark, sf_dir):
    """Days of the calendar on which a product was not sold: not the flat model's answer."""
    star = sales_star(spark, sf_dir, ["Dim_Producto"], territory=False)
    return days_without_purchase(star, order_calendar(spark, sf_dir, "Date"), ["Producto"], []).select(
        F.col("Producto").alias("producto"), whole("purchase_days"), whole("days_without_purchase")
    )


@query(f"""WITH {CAL}, {LINES}, n AS (SELECT year(d) AS y, count(DISTINCT d) AS n FROM lines GROUP BY 1)
SELECT year(d) AS year, coalesce(any_value(n), 0) AS purchase_days, count(*) - coalesce(any_value(n), 0)
       AS days_without_purchase
FROM cal LEFT JOIN n ON y = year(d) GROUP BY 1""")
def days_without_sales_by_year(spark, sf_dir):
    star = sales_star(spark, sf_dir, [], ["Year"], territory=False)
    return days_without_purchase(star, order_calendar(spark, sf_dir, "Date", "Year"), [], ["Year"]).select(
        whole("Year", "year"), whole("purchase_days"), whole("days_without_purchase")
    )


@query(f"""WITH {CAL}, {LINES}, span AS (SELECT year(d) AS y, date_diff('day', min(d), max(d)) + 1 AS n FROM cal GROUP BY 1),
sold AS (SELECT l_partkey, year(lines.d) AS y, lines.d FROM lines),
per AS (SELECT p_name, y, count(DISTINCT d) AS n FROM sold JOIN part ON p_partkey = l_partkey GROUP BY 1, 2)
SELECT p.p_name AS producto, span.y AS year, coalesce(per.n, 0) AS purchase_days,
       span.n - coalesce(per.n, 0) AS days_without_purchase
FROM (SELECT DISTINCT p_name FROM part) p CROSS JOIN span
LEFT JOIN per ON per.p_name = p.p_name AND per.y = span.y""")
def days_without_sales_by_product_year(spark, sf_dir):
    """A row for every product and year, also for years in which the product was not sold."""
    star = sales_star(spark, sf_dir, ["Dim_Producto"], ["Year"], territory=False)
    return days_without_purchase(star, order_calendar(spark, sf_dir, "Date", "Year"), ["Producto"], ["Year"]).select(
        F.col("Producto").alias("producto"), whole("Year", "year"), whole("purchase_days"), whole("days_without_purchase")
    )


@query(f"""WITH {LINES} SELECT CAST(d AS VARCHAR) AS date, CAST(sum(amount) AS DOUBLE) AS sales
FROM lines WHERE d BETWEEN DATE '1997-11-15' AND DATE '1998-02-15' GROUP BY 1""")
def sales_between_dates(spark, sf_dir):
    """Sales per day inside a date slicer; the bounds are applied to the scan of the orders, their keys to that of the lines."""
    t = samples.order_entry(spark, sf_dir, territory=False)
    t["headers"] = between_dates(t["headers"], "OrderDate", dt.date(1997, 11, 15), dt.date(1998, 2, 15))
    return ti.day_totals(star_plans.order_totals(t, selective=True), "OrderDate", []).select(text("Date", "date"), money("sales"))


@query(f"""WITH {LINES} SELECT CAST(d AS VARCHAR) AS date, CAST(sum(amount) AS DOUBLE) AS sales
FROM lines GROUP BY 1 ORDER BY sum(amount) DESC, 1 LIMIT 5""")
def best_days(spark, sf_dir):
    """The five days with the highest sales."""
    return first_rows(all_days(spark, sf_dir), 5, [F.desc("sales"), "Date"]).select(
        text("Date", "date"), money("sales")
    )


@query(f"""WITH {LINES}, x AS (SELECT year(d) AS year, month(d) AS m, CAST(sum(amount) AS DOUBLE) AS sales
                               FROM lines GROUP BY 1, 2)
SELECT year, {MONTHS['es']}[m] AS month_name, sales, row_number() OVER (PARTITION BY year ORDER BY m) AS place FROM x""")
def sales_by_month_name(spark, sf_dir):
    """Sales by month label; within a year the label takes its place from the hidden month number."""
    by = ["Year", "Month", "Month Name"]
    return evaluate(sales_star(spark, sf_dir, [], by, territory=False), by, ["sales"]).withColumn(
        "place", F.expr("row_number() over (partition by Year order by Month)")
    ).orderBy("Year", "Month").select(
        whole("Year", "year"), F.col("`Month Name`").alias("month_name"), money("sales"), whole("place")
    )


@query(f"""WITH {LINES}, x AS (SELECT year(d) + CASE WHEN month(d) >= 6 THEN 1 ELSE 0 END AS fy,
         (month(d) + 6) % 12 + 1 AS fm, month(d) AS m, CAST(sum(amount) AS DOUBLE) AS sales FROM lines GROUP BY 1, 2, 3)
SELECT fy AS fiscal_year, fm AS fiscal_month_number, {MONTHS['es']}[m] AS fiscal_month_name, sales FROM x""")
def sales_by_fiscal_month(spark, sf_dir):
    """Sales by fiscal year and month, in fiscal order (June first)."""
    by = ["FiscalYear", "FiscalMonthNumber", "Fiscal Month Name"]
    return evaluate(sales_star(spark, sf_dir, [], by, territory=False), by, ["sales"]).orderBy(*by[:2]).select(
        whole("FiscalYear", "fiscal_year"), whole("FiscalMonthNumber", "fiscal_month_number"),
        F.col("`Fiscal Month Name`").alias("fiscal_month_name"), money("sales"),
    )


# --- last year ----------------------------------------------------------------------------------

_DAYS = f"{LINES}, dt AS (SELECT t, d, sum(amount) AS s FROM lines GROUP BY 1, 2), " \
        "al AS (SELECT d, sum(s) AS s FROM dt GROUP BY 1)"
_ROLLED = "CAST(make_date(year(d) - 1, month(d), 1) + CAST(day(d) - 1 AS INTEGER) AS DATE)"


@query(f"""WITH {_DAYS}, pri AS (SELECT DISTINCT t, year(d) AS y, month(d) AS m, {_ROLLED} AS p FROM dt),
cur AS (SELECT t, year(d) AS y, month(d) AS m, sum(s) AS s FROM dt GROUP BY 1, 2, 3),
ly AS (SELECT pri.t, y, m, sum(s) AS ly FROM pri JOIN dt ON dt.t = pri.t AND dt.d = p GROUP BY 1, 2, 3)
SELECT CAST(t AS BIGINT) AS territorio_key, y AS year, m AS month, CAST(s AS DOUBLE) AS sales, CAST(ly AS DOUBLE) AS ly
FROM cur LEFT JOIN ly USING (t, y, m)""")
def ly_sparse(spark, sf_dir):
    """Last year on the days matching this year's sale days, within the territory."""
    keys = ["TerritorioKey", "year", "month"]
    return _compared(ti.ly_sparse(territory_days(spark, sf_dir), ["TerritorioKey"], MONTH), keys)


@query(f"""WITH {_DAYS}, pri AS (SELECT DISTINCT t, year(d) AS y, {_ROLLED} AS p FROM dt WHERE month(d) <= 3),
cur AS (SELECT t, year(d) AS y, sum(s) AS s FROM dt WHERE month(d) <= 3 GROUP BY 1, 2),
ly AS (SELECT pri.t, y, sum(s) AS ly FROM pri JOIN dt ON dt.t = pri.t AND dt.d = p GROUP BY 1, 2)
SELECT CAST(t AS BIGINT) AS territorio_key, y AS year, CAST(s AS DOUBLE) AS sales, CAST(ly AS DOUBLE) AS ly
FROM cur LEFT JOIN ly USING (t, y)""")
def ly_sparse_first_quarter(spark, sf_dir):
    """The same under a date filter, which holds for this year only; leap days meet March 1st."""
    compared = ti.ly_sparse(
        territory_days(spark, sf_dir), ["TerritorioKey"], YEAR, date_filter=F.month("Date") <= 3
    )
    return _compared(compared, ["TerritorioKey", "year"])


@query(f"""WITH {_DAYS}, pri AS (SELECT DISTINCT t, year(d) AS y, month(d) AS m, {_ROLLED} AS p FROM dt),
cur AS (SELECT t, year(d) AS y, month(d) AS m, sum(s) AS s FROM dt GROUP BY 1, 2, 3),
ly AS (SELECT pri.t, y, m, sum(s) AS ly FROM pri JOIN al ON al.d = p GROUP BY 1, 2, 3)
SELECT CAST(t AS BIGINT) AS territorio_key, y AS year, m AS month, CAST(s AS DOUBLE) AS sales, CAST(ly AS DOUBLE) AS ly
FROM cur LEFT JOIN ly USING (t, y, m)""")
def ly_sparse_all(spark, sf_dir):
    """Last year on the matching days with every other filter dropped: all territories together."""
    totals = territory_days(spark, sf_dir)
    everything = totals.groupBy("Date").agg(F.sum("sales").alias("sales"))
    compared = ti.ly_sparse(totals, ["TerritorioKey"], MONTH, all_totals=everything)
    return _compared(compared, ["TerritorioKey", "year", "month"])


@query(f"""WITH {_DAYS}, pri AS (SELECT DISTINCT year(d) AS y, month(d) AS m, {_ROLLED} AS p FROM al),
cur AS (SELECT year(d) AS y, month(d) AS m, sum(s) AS s FROM al GROUP BY 1, 2),
ly AS (SELECT y, m, sum(s) AS ly FROM pri JOIN al ON al.d = p GROUP BY 1, 2)
SELECT y AS year, m AS month, {MONTHS['es']}[m] AS month_name, CAST(s AS DOUBLE) AS sales,
       CAST(ly AS DOUBLE) AS parallel_period
FROM cur LEFT JOIN ly USING (y, m)""")
def parallel_period_by_month(spark, sf_dir):
    """Sales and parallel period by year and month label, without a calendar."""
    periods = {**MONTH, "month_name": month_name}
    compared = ti.with_yoy(ti.ly_sparse(all_days(spark, sf_dir), [], periods)).orderBy("year", "month")
    return compared.select(whole("year"), whole("month"), "month_name", money("sales"), money("parallel_period"))


@query(f"""WITH {_DAYS}, cur AS (SELECT t, year(d) AS y, month(d) AS m, sum(s) AS s FROM dt GROUP BY 1, 2, 3),
years AS (SELECT t, year(d) + 1 AS y, sum(s) AS ly FROM dt GROUP BY 1, 2)
SELECT CAST(t AS BIGINT) AS territorio_key, y AS year, m AS month, CAST(s AS DOUBLE) AS sales, CAST(ly AS DOUBLE) AS ly
FROM cur LEFT JOIN years USING (t, y)""")
def ly_full_year(spark, sf_dir):
    """The whole previous year beside each month of the territory."""
    compared = ti.ly_full_year(territory_days(spark, sf_dir), ["TerritorioKey"], MONTH)
    return _compared(compared, ["TerritorioKey", "year", "month"])


def _dense_sql(by: str, on: str, names: str, keys: str) -> str:
    """Whole periods against whole periods, over the years of the calendar."""
    return f"""WITH {_DAYS}, p AS (SELECT {by}, sum(s) AS s FROM dt GROUP BY ALL),
b AS (SELECT max(year(d)) AS last_year FROM dt)
SELECT {names}, CAST(c.s AS DOUBLE) AS sales, CAST(l.s AS DOUBLE) AS ly
FROM p c FULL JOIN (SELECT * REPLACE (y + 1 AS y) FROM p, b WHERE y < last_year) l ON {on}"""


@query(_dense_sql(
    "t, year(d) AS y, month(d) AS m", "c.t = l.t AND c.y = l.y AND c.m = l.m",
    "CAST(coalesce(c.t, l.t) AS BIGINT) AS territorio_key, coalesce(c.y, l.y) AS year, coalesce(c.m, l.m) AS month",
    "t, y, m",
).replace("SELECT * REPLACE (y + 1 AS y) FROM p, b", "SELECT t, y + 1 AS y, m, s FROM p, b"))
def ly_dense_month(spark, sf_dir):
    """The same month last year through the full calendar, per territory."""
    compared = ti.ly_dense(
        territory_days(spark, sf_dir), order_days(spark, sf_dir), ["TerritorioKey"], MONTH
    )
    return _compared(compared, ["TerritorioKey", "year", "month"])


@query(f"""WITH {CAL}, {_DAYS}, x AS (
  SELECT cal.d, n.s AS sales, l.s AS ly FROM cal LEFT JOIN al n ON n.d = cal.d
  LEFT JOIN al l ON l.d = CAST(cal.d - INTERVAL 1 YEAR AS DATE))
SELECT CAST(d AS VARCHAR) AS date, CAST(sales AS DOUBLE) AS sales, CAST(ly AS DOUBLE) AS ly
FROM x WHERE sales IS NOT NULL OR ly IS NOT NULL""")
def ly_dense_day(spark, sf_dir):
    """The same day last year through the full calendar."""
    compared = ti.ly_dense(
        all_days(spark, sf_dir), order_days(spark, sf_dir), [], DAY, single_days=True
    )
    return compared.select(text("day", "date"), money("sales"), money("ly"))


@query(f"""WITH {_DAYS}, b AS (SELECT max(CAST(o_orderdate AS DATE)) AS z FROM orders),
cur AS (SELECT year(d) AS y, sum(s) AS s FROM al GROUP BY 1),
ly AS (SELECT year(d) + 1 AS y, sum(s) AS ly FROM al, b
       WHERE year(d) + 1 <= year(z) AND (year(d) + 1 < year(z) OR strftime(d, '%m%d') <= strftime(z, '%m%d')) GROUP BY 1)
SELECT y AS year, CAST(s AS DOUBLE) AS sales, CAST(ly AS DOUBLE) AS ly, CAST(coalesce(s, 0) - coalesce(ly, 0) AS DOUBLE)
       AS yoy,
       CASE WHEN ly <> 0 THEN CAST(coalesce(s, 0) - coalesce(ly, 0) AS DOUBLE) / CAST(ly AS DOUBLE) END AS yoy_pct
FROM cur FULL JOIN ly USING (y)""")
def ly_bounded_calendar(spark, sf_dir):
    """Last year through a calendar that stops at the last order: the unfinished year against the same months."""
    days = calendar_from(samples.table(spark, sf_dir, "orders"), "o_orderdate", lead_months=12)
    compared = ti.with_yoy(ti.ly_dense(all_days(spark, sf_dir), days, [], YEAR)).drop("parallel_period")
    return _compared(compared, ["year"])


@query(f"""WITH {_DAYS}, p AS (SELECT year(d) AS y, sum(s) AS s FROM al GROUP BY 1)
SELECT c.y AS year, CAST(c.s AS DOUBLE) AS sales, CAST(l.s AS DOUBLE) AS ly,
       CAST(c.s - coalesce(l.s, 0) AS DOUBLE) AS yoy,
       CAST(c.s - coalesce(l.s, 0) AS DOUBLE) / CAST(nullif(l.s, 0) AS DOUBLE) AS yoy_pct,
       CAST(l.s AS DOUBLE) AS parallel_period
FROM p c LEFT JOIN p l ON l.y = c.y - 1""")
def yoy_by_year(spark, sf_dir):
    """Sales by year with last year, difference, ratio and parallel period."""
    compared = ti.ly_dense(all_days(spark, sf_dir), order_days(spark, sf_dir), [], YEAR)
    return _compared(ti.with_yoy(compared), ["year"])


@query(f"""WITH {CAL}, {LINES}, b AS (SELECT min(d) AS a, max(d) AS z FROM cal)
SELECT CASE WHEN shipped BETWEEN a AND z THEN year(shipped) ELSE -1 END AS year, count(*) AS lines,
       CAST(sum(amount) AS DOUBLE) AS sales
FROM lines, b GROUP BY 1""")
def sales_by_ship_date_role(spark, sf_dir):
    """Sales by the year of shipment: the calendar in its other role."""
    t = samples.order_entry(spark, sf_dir, territory=False)
    roles = [DateRole("order", "OrderDate", active=True), DateRole("ship", "ShipDate")]
    per_day = star_plans.sales_fact(t).groupBy(F.to_date("ShipDate").alias("ShipDate")).agg(
        F.sum("LineTotal").alias("sales"), F.count(F.lit(1)).alias("lines")
    )
    shipped = by_role(per_day, order_calendar(spark, sf_dir, "Date", "Year"), roles, ["Year"], use="ship")
    return shipped.groupBy(whole(F.coalesce("Year", F.lit(-1)), "year")).agg(
        F.sum("lines").alias("lines"), money(F.sum("sales"), "sales")
    )


@query(f"""WITH {_DAYS}
SELECT 'year' AS period, CAST(sum(s) AS DOUBLE) AS sales FROM al WHERE year(d) = {AS_OF.year}
UNION ALL SELECT 'last year', CAST(sum(s) AS DOUBLE) FROM al WHERE year(d) = {AS_OF.year - 1}
UNION ALL SELECT 'last 3 months', CAST(sum(s) AS DOUBLE) FROM al
          WHERE date_diff('month', DATE '{AS_OF}', d) BETWEEN -3 AND -1
UNION ALL SELECT 'quarter', CAST(sum(s) AS DOUBLE) FROM al WHERE date_diff('quarter', DATE '{AS_OF}', d) = 0
UNION ALL SELECT 'last 30 days', CAST(sum(s) AS DOUBLE) FROM al
          WHERE date_diff('day', DATE '{AS_OF}', d) BETWEEN -30 AND -1""")
def sales_in_relative_periods(spark, sf_dir):
    """Sales of periods named by their offset from the reference day."""
    periods = {
        "year": F.col("YearOffset") == 0,
        "last year": F.col("YearOffset") == -1,
        "last 3 months": F.col("MonthOffset").between(-3, -1),
        "quarter": F.col("QuarterOffset") == 0,
        "last 30 days": F.col("DayOffset").between(-30, -1),
    }
    totals = all_days(spark, sf_dir)
    described = totals.join(
        order_calendar(spark, sf_dir, "Date", "YearOffset", "QuarterOffset", "MonthOffset", "DayOffset"), "Date"
    )
    sums = described.agg(*[
        F.struct(F.lit(name).alias("period"), money(F.sum(F.when(test, F.col("sales"))), "sales")).alias(f"p{i}")
        for i, (name, test) in enumerate(periods.items())
    ])
    return sums.select(F.inline(F.array(*sums.columns)))


@query(f"""WITH {_DAYS} SELECT CAST(d AS VARCHAR) AS date, CAST(s AS DOUBLE) AS sales FROM al
WHERE d > DATE '{AS_OF}' - 92 AND d <= DATE '{AS_OF}'
  AND date_diff('month', DATE '{AS_OF}', d) >= -2""")
def sales_of_recent_months(spark, sf_dir):
    """Daily sales of this month and the two before it, up to the reference day."""
    recent = F.col("MonthOffset").between(-2, 0) & (F.col("DayOffset") <= 0)
    return ti.in_relative_period(
        all_days(spark, sf_dir), order_calendar(spark, sf_dir, "Date", "MonthOffset", "DayOffset"), recent
    ).select(
        text("Date", "date"), money("sales")
    )


# --- hierarchies --------------------------------------------------------------------------------

def _rollup_sql(year: str, part: str, label: str) -> str:
    return f"""WITH {LINES}, x AS (SELECT d, o_custkey, l_orderkey, amount, {year} AS y, {part} AS p FROM lines)
SELECT CAST(3 - CASE grouping(y, p, d) WHEN 0 THEN 0 WHEN 1 THEN 1 WHEN 3 THEN 2 ELSE 3 END AS BIGINT) AS level,
       coalesce(CAST(y AS VARCHAR), 'All') AS year, coalesce(CAST(p AS VARCHAR), 'All') AS part,
       coalesce({label}, 'All') AS part_label, coalesce(CAST(d AS VARCHAR), 'All') AS date,
       CAST(sum(amount) AS DOUBLE) AS sales, count(*) AS lines, count(DISTINCT o_custkey) AS customers,
       count(DISTINCT l_orderkey) AS orders, CAST(sum(amount) AS DOUBLE) / count(DISTINCT l_orderkey) AS average_ticket
FROM x GROUP BY ROLLUP (y, p, d)"""


_SUMMED = ["sales", "lines", "orders"]
# Hierarchy -> its year, its part of the year, that part's label.
_LEVELS = {
    "Calendar": ("Year", "Month", "Month Name"), "Fiscal": ("FiscalYear", "FiscalMonthNumber", "Fiscal Month Name"),
    "Calendar Week": ("Year", "Week of Year", "Week of Year"),
    "Fiscal Week": ("FiscalYear", "Fiscal Week of Year", "Fiscal Week of Year"), "Iso Week": ("IsoYear", "IsoWeek", "IsoWeek"),
}


def sales_day_sets(spark, sf_dir) -> DataFrame:
    """Sales, lines and orders per day, and each day's customers as a set: all that a roll-up needs of the fact.

    Orders have one date each, so their number can be summed over days; customers cannot.
    """
    rows = orders_with_sales(spark, sf_dir).groupBy(F.to_date("OrderDate").alias("Date"), "ClienteKey").agg(
        F.sum("LineTotal").alias("sales"), F.sum("Lineas").alias("lines"), F.count(F.lit(1)).alias("orders")
    )
    return materialise(day_sets(rows.withColumnRenamed("ClienteKey", "customers"), _SUMMED, "customers"), "day-sets")


def _rolled(spark, sf_dir, days: DataFrame, hierarchy: str) -> DataFrame:
    """Sales, lines, customers, orders and ticket per level of a hierarchy."""
    year, part, label = _LEVELS[hierarchy]
    calendar = order_calendar(spark, sf_dir, *dict.fromkeys(["Date", year, part, label]))
    rolled = set_rollup(days, calendar, hierarchy, _SUMMED, "customers")

    def or_all(column: str, name: str):
        return F.coalesce(F.col(f"`{column}`").cast("string"), F.lit("All")).alias(name)

    return in_order(rolled, hierarchy).select(
        whole("level"), or_all(year, "year"), or_all(part, "part"), or_all(label, "part_label"), or_all("Date", "date"),
        money("sales"), whole("lines"), whole("customers"), whole("orders"),
        safe_div("sales", "orders").alias("average_ticket"),
    )


def _rollup(spark, sf_dir, hierarchy: str) -> DataFrame:
    return _rolled(spark, sf_dir, sales_day_sets(spark, sf_dir), hierarchy)


@query(_rollup_sql("year(d)", "month(d)", f"{MONTHS['es']}[p]"))
def calendar_rollup(spark, sf_dir):
    return _rollup(spark, sf_dir, "Calendar")


_FISCAL_YEAR_SQL = "year(d) + CASE WHEN month(d) >= 6 THEN 1 ELSE 0 END"


@query(_rollup_sql(_FISCAL_YEAR_SQL, "(month(d) + 6) % 12 + 1", f"{MONTHS['es']}[(p + 4) % 12 + 1]"))
def fiscal_rollup(spark, sf_dir):
    return _rollup(spark, sf_dir, "Fiscal")


@query(_rollup_sql("year(d)", week_sql("d"), "CAST(p AS VARCHAR)"))
def week_rollup(spark, sf_dir):
    return _rollup(spark, sf_dir, "Calendar Week")


@query(_rollup_sql(_FISCAL_YEAR_SQL, week_sql("CAST(d - INTERVAL 6 MONTH AS DATE)"), "CAST(p AS VARCHAR)"))
def fiscal_week_rollup(spark, sf_dir):
    return _rollup(spark, sf_dir, "Fiscal Week")


@query(_rollup_sql("isoyear(d)", "week(d)", "CAST(p AS VARCHAR)"))
def iso_week_rollup(spark, sf_dir):
    return _rollup(spark, sf_dir, "Iso Week")


@query(" UNION ALL ".join(f"SELECT '{name}' AS hierarchy, * FROM ({sql})" for name, sql in {
    "Calendar": _rollup_sql("year(d)", "month(d)", f"{MONTHS['es']}[p]"),
    "Fiscal": _rollup_sql(_FISCAL_YEAR_SQL, "(month(d) + 6) % 12 + 1", f"{MONTHS['es']}[(p + 4) % 12 + 1]"),
    "Calendar Week": _rollup_sql("year(d)", week_sql("d"), "CAST(p AS VARCHAR)"),
    "Fiscal Week": _rollup_sql(_FISCAL_YEAR_SQL, week_sql("CAST(d - INTERVAL 6 MONTH AS DATE)"), "CAST(p AS VARCHAR)"),
    "Iso Week": _rollup_sql("isoyear(d)", "week(d)", "CAST(p AS VARCHAR)"),
}.items()))
def five_rollups(spark, sf_dir):
    """All five hierarchies, distinct customers included, from one pass over the fact."""
    days = sales_day_sets(spark, sf_dir)
    stacked = [_rolled(spark, sf_dir, days, h).select(F.lit(h).alias("hierarchy"), "*") for h in _LEVELS]
    return reduce(DataFrame.unionByName, stacked)


# --- date ranges --------------------------------------------------------------------------------

def _ranges_sql(keys: str, source: str) -> str:
    return f"""WITH days AS (SELECT DISTINCT {source}),
runs AS (SELECT *, d - CAST(row_number() OVER (PARTITION BY {keys} ORDER BY d) AS INTEGER) AS run FROM days),
isl AS (SELECT {keys}, run, min(d) AS a, max(d) AS z FROM runs GROUP BY {keys}, run)
SELECT {keys}, string_agg(CAST(a AS VARCHAR) || CASE WHEN z > a THEN '-' || CAST(z AS VARCHAR) ELSE '' END || ',', ''
                          ORDER BY a) AS ranges
FROM isl GROUP BY {keys}"""


@query(_ranges_sql("cliente_key", "o_custkey AS cliente_key, CAST(o_orderdate AS DATE) AS d FROM orders"))
def active_date_ranges_by_customer(spark, sf_dir):
    """The days on which each customer ordered, as ranges."""
    orders = samples.table(spark, sf_dir, "orders").select(F.col("o_custkey").alias("cliente_key"), "o_orderdate")
    return date_ranges_text(orders, ["cliente_key"], "o_orderdate")


@query(_ranges_sql("event_type, day_of_month",
                   "event_type, CAST(day(ts) AS BIGINT) AS day_of_month, CAST(ts AS DATE) AS d FROM events"))
def active_date_ranges_of_events(spark, sf_dir):
    """Ranges over timestamps with a time of day, which is ignored."""
    events = samples.table(spark, sf_dir, "events").select(
        "event_type", F.dayofmonth("ts").cast("long").alias("day_of_month"), "ts"
    )
    return date_ranges_text(events, ["event_type", "day_of_month"], "ts")


@query(_ranges_sql("tag", "'shipped' AS tag, CAST(l_shipdate AS DATE) AS d FROM lineitem").replace(
    "SELECT tag, string_agg", "SELECT string_agg"))
def shipping_date_ranges(spark, sf_dir):
    """The days on which anything was shipped, as one text."""
    return date_ranges_text(samples.table(spark, sf_dir, "lineitem"), [], "l_shipdate")
