"""Queries that evaluate measures in a changed view: last year's sales and counts beside this year's, shares of a whole."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from kalends.catalog.analysis import sales_star
from kalends.catalog.registry import CAL, LINES, money, query, whole
from kalends.operators.calendar import with_calendar_columns
from kalends.operators.context import SALE_DAYS, SAME_PERIOD, Change
from kalends.operators.measures import evaluate, measure_rows
from kalends.plans import flat as flat_plans
from kalends.sources import samples

# Sales by group, category and day; sales by day; the day a year earlier, February 29th rolled over.
_DAYS = f"""{LINES}, gc AS (
  SELECT r_name AS g, p_type AS c, d, sum(amount) AS s FROM lines LEFT JOIN nation ON n_nationkey = t
  LEFT JOIN region ON r_regionkey = n_regionkey LEFT JOIN part ON p_partkey = l_partkey GROUP BY 1, 2, 3),
al AS (SELECT d, sum(s) AS s FROM gc GROUP BY 1)"""
_PRIOR = "CAST(make_date(year(d) - 1, month(d), 1) + CAST(day(d) - 1 AS INTEGER) AS DATE)"


def _lower(column: str) -> Column:
    return F.col(column).alias(column.lower())


def _yoy(sales: str, ly: str) -> str:
    return f"CASE WHEN {sales} IS NOT NULL OR {ly} IS NOT NULL THEN CAST(coalesce({sales}, 0) - coalesce({ly}, 0) AS DOUBLE) END"


def _pct(sales: str, ly: str) -> str:
    return f"CASE WHEN {ly} <> 0 THEN CAST(coalesce({sales}, 0) - coalesce({ly}, 0) AS DOUBLE) / CAST({ly} AS DOUBLE) END"


@query(f"""WITH {CAL}, {_DAYS}, m AS (SELECT g, c, year(d) AS y, month(d) AS m, sum(s) AS s FROM gc GROUP BY 1, 2, 3, 4),
l AS (SELECT g, c, y + 1 AS y, m, s AS ly FROM m WHERE y < (SELECT max(year(d)) FROM cal))
SELECT g AS grupo, c AS categoria, y AS year, m AS month, CAST(s AS DOUBLE) AS sales, CAST(ly AS DOUBLE) AS ly,
       {_yoy('s', 'ly')} AS yoy, {_pct('s', 'ly')} AS yoy_pct, CAST(ly AS DOUBLE) AS parallel_period
FROM m FULL JOIN l USING (g, c, y, m)""")
def time_measures_by_group_category(spark, sf_dir):
    """Sales, last year's through the calendar, difference, ratio and parallel period by columns of three dimensions."""
    star = sales_star(spark, sf_dir, ["Dim_Territorio", "Dim_Producto"], ["Year", "Month"])
    return evaluate(star, ["Grupo", "Categoria", "Year", "Month"], ["sales", "ly", "yoy", "yoy_pct", "parallel"]).select(
        *[_lower(c) for c in ("Grupo", "Categoria")], whole("Year", "year"), whole("Month", "month"),
        money("sales"), money("ly"), money("yoy"), money("yoy_pct"), money("parallel", "parallel_period"),
    )


@query(f"""WITH {_DAYS}, cur AS (SELECT g, c, year(d) AS y, sum(s) AS s FROM gc GROUP BY 1, 2, 3),
pri AS (SELECT DISTINCT g, c, year(d) AS y, {_PRIOR} AS p FROM gc),
a AS (SELECT pri.g, pri.c, y, sum(s) AS ly FROM pri JOIN gc ON gc.g = pri.g AND gc.c = pri.c AND gc.d = p GROUP BY 1, 2, 3),
b AS (SELECT pri.g, pri.c, y, sum(s) AS ly_all FROM pri JOIN al ON al.d = p GROUP BY 1, 2, 3),
f AS (SELECT g, c, y + 1 AS y, s AS ly_year FROM cur)
SELECT g AS grupo, c AS categoria, y AS year, CAST(s AS DOUBLE) AS sales, CAST(ly AS DOUBLE) AS ly_sparse,
       {_yoy('s', 'ly')} AS yoy_sparse, CAST(ly_all AS DOUBLE) AS ly_sparse_all, {_pct('s', 'ly_all')} AS yoy_pct_sparse_all,
       CAST(ly_year AS DOUBLE) AS ly_full_year, {_pct('s', 'ly_year')} AS yoy_pct_full_year
FROM cur LEFT JOIN a USING (g, c, y) LEFT JOIN b USING (g, c, y) LEFT JOIN f USING (g, c, y)""")
def sparse_time_measures_by_group_category(spark, sf_dir):
    """Last year's sales on the days matching this year's sale days, in the group or everywhere, and of the whole year."""
    star = sales_star(spark, sf_dir, ["Dim_Territorio", "Dim_Producto"], ["Year"])
    measures = ["sales", "ly_sparse", "yoy_sparse", "ly_sparse_all", "yoy_pct_sparse_all", "ly_full_year", "yoy_pct_full_year"]
    return evaluate(star, ["Grupo", "Categoria", "Year"], measures).select(
        *[_lower(c) for c in ("Grupo", "Categoria")], whole("Year", "year"), *[money(m) for m in measures],
    )


@query(f"""WITH {_DAYS}, v AS (SELECT * FROM gc WHERE c IN ('LARGE', 'PROMO')),
n AS (SELECT g, sum(s) AS s FROM v WHERE year(d) = 1997 AND month(d) <= 6 GROUP BY 1),
l AS (SELECT g, sum(s) AS ly FROM v WHERE year(d) = 1996 AND month(d) <= 6 GROUP BY 1),
pri AS (SELECT DISTINCT g, {_PRIOR} AS p FROM v WHERE year(d) = 1997 AND month(d) <= 6),
a AS (SELECT pri.g, sum(s) AS ly_s FROM pri JOIN v ON v.g = pri.g AND v.d = p GROUP BY 1),
b AS (SELECT pri.g, sum(s) AS ly_a FROM pri JOIN al ON al.d = p GROUP BY 1),
f AS (SELECT g, sum(s) AS ly_y FROM v WHERE year(d) = 1996 GROUP BY 1)
SELECT coalesce(n.g, l.g) AS grupo, CAST(s AS DOUBLE) AS sales, CAST(ly AS DOUBLE) AS ly, {_pct('s', 'ly')} AS yoy_pct,
       CAST(ly_s AS DOUBLE) AS ly_sparse, CAST(ly_a AS DOUBLE) AS ly_sparse_all,
       CAST(ly_y AS DOUBLE) AS ly_full_year
FROM n FULL JOIN l ON l.g = n.g LEFT JOIN a ON a.g = n.g LEFT JOIN b ON b.g = n.g LEFT JOIN f ON f.g = n.g""")
def time_measures_under_filters(spark, sf_dir):
    """All forms of last year's sales by group, while year, months and categories are filtered and not shown."""
    star = sales_star(spark, sf_dir, ["Dim_Territorio", "Dim_Producto"], ["Year", "Month"])
    measures = ["sales", "ly", "yoy_pct", "ly_sparse", "ly_sparse_all", "ly_full_year"]
    filtered = evaluate(star, ["Grupo"], measures, where={
        "Year": lambda c: c == 1997, "Month": lambda c: c <= 6, "Categoria": lambda c: c.isin("LARGE", "PROMO"),
    })
    return filtered.select(_lower("Grupo"), *[money(m) for m in measures])


@query(f"""WITH {CAL}, {LINES}, x AS (
  SELECT r_name AS g, year(d) AS y, o_custkey, d, amount FROM lines LEFT JOIN nation ON n_nationkey = t
  LEFT JOIN region ON r_regionkey = n_regionkey),
n AS (SELECT g, y, count(DISTINCT o_custkey) AS customers, sum(amount) AS s FROM x GROUP BY 1, 2),
l AS (SELECT g, y + 1 AS y, customers AS customers_ly FROM n WHERE y < (SELECT max(year(d)) FROM cal)),
pri AS (SELECT DISTINCT g, y, {_PRIOR} AS p FROM x),
e AS (SELECT pri.g, pri.y, count(DISTINCT o_custkey) AS same_days FROM pri JOIN x ON x.g = pri.g AND x.d = p GROUP BY 1, 2),
w AS (SELECT y, sum(s) AS whole FROM n GROUP BY 1)
SELECT g AS grupo, y AS year, customers, customers_ly, same_days AS customers_same_days, CAST(s AS DOUBLE) AS sales,
       CAST(whole AS DOUBLE) AS sales_of_all_groups
FROM n FULL JOIN l USING (g, y) LEFT JOIN e USING (g, y) LEFT JOIN w USING (y)""")
def counts_in_changed_views(spark, sf_dir):
    """Customers of last year beside this year's, which cannot be summed, and a group's sales beside those of all groups."""
    star = sales_star(spark, sf_dir, ["Dim_Territorio"], ["Year"])
    changes = {
        "customers_ly": Change("customers", SAME_PERIOD), "customers_same_days": Change("customers", SALE_DAYS),
        "sales_of_all_groups": Change("sales", drop=("Grupo",)),
    }
    counted = evaluate(star, ["Grupo", "Year"], ["customers", "sales", *changes], changes=changes)
    return counted.select(
        _lower("Grupo"), whole("Year", "year"), whole("customers"), whole("customers_ly"), whole("customers_same_days"),
        money("sales"), money("sales_of_all_groups"),
    )


@query(f"""WITH {LINES}, dt AS (SELECT n_name AS t, d, sum(amount) AS s FROM lines JOIN nation ON n_nationkey = t GROUP BY 1, 2),
al AS (SELECT d, sum(s) AS s FROM dt GROUP BY 1),
cur AS (SELECT t, year(d) AS y, sum(s) AS s FROM dt GROUP BY 1, 2),
pri AS (SELECT DISTINCT t, year(d) AS y, {_PRIOR} AS p FROM dt),
a AS (SELECT pri.t, y, sum(s) AS ly FROM pri JOIN dt ON dt.t = pri.t AND dt.d = p GROUP BY 1, 2),
b AS (SELECT pri.t, y, sum(s) AS ly_all FROM pri JOIN al ON al.d = p GROUP BY 1, 2),
f AS (SELECT t, y + 1 AS y, s AS ly_year FROM cur)
SELECT t AS territorio, y AS anio, CAST(s AS DOUBLE) AS sales, CAST(ly AS DOUBLE) AS ly_sparse,
       CAST(ly_all AS DOUBLE) AS ly_sparse_all, {_yoy('s', 'ly_all')} AS yoy_sparse_all, CAST(ly_year AS DOUBLE) AS ly_full_year
FROM cur LEFT JOIN a USING (t, y) LEFT JOIN b USING (t, y) LEFT JOIN f USING (t, y)""")
def flat_time_measures(spark, sf_dir):
    """The comparisons of the flat table, which has no calendar: year and month are columns of its own."""
    flat = flat_plans.flat_from_order_entry(samples.order_entry(spark, sf_dir)).withColumnsRenamed({
        "SalesOrderID": "SalesOrderNumber", "CustomerID": "ClienteID", "ProductID": "ProductoID", "TerritoryID": "TerritorioID",
    })
    measures = ["sales", "ly_sparse", "ly_sparse_all", "yoy_sparse_all", "ly_full_year"]
    compared = measure_rows(
        with_calendar_columns(flat, "OrderDate"), ["Territorio", "Año"], measures,
        date_columns=("OrderDate", "Año", "Mes", "NombreMes"),
    )
    return compared.select(_lower("Territorio"), whole("Año", "anio"), *[money(m) for m in measures])
