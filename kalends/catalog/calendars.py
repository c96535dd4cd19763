"""Queries about calendars, all bounded by the dates found in the data."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from kalends.catalog.registry import AS_OF, CAL, LINES, query, text, week_sql, whole
from kalends.functions import dates as D
from kalends.functions.names import DAYS, MONTHS
from kalends.operators.calendar import (
    OPEN_END, calendar_from, calendar_over, date_dim, describe_days, filled_days, small_date_dim, with_calendar_columns,
)
from kalends.operators.filters import today_row
from kalends.operators.quality import calendar_sanity, days_outside
from kalends.plans.star import sales_fact, seller_periods
from kalends.sources import samples
from kalends.storage import materialise


def order_days(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The days of the whole years in which orders were placed."""
    return calendar_from(samples.table(spark, sf_dir, "orders"), "o_orderdate", whole_years=True)


def order_calendar(spark: SparkSession, sf_dir: str, *columns: str) -> DataFrame:
    """The date dimension over those days: all of it, or the named columns."""
    return describe_days(order_days(spark, sf_dir), as_of=AS_OF, columns=list(columns) or None)


@query(f"""WITH {CAL}, n AS (SELECT CAST(o_orderdate AS DATE) AS d, count(*) AS orders FROM orders GROUP BY 1)
SELECT CAST(cal.d AS VARCHAR) AS date, year(cal.d) AS year, month(cal.d) AS month, quarter(cal.d) AS quarter,
       day(cal.d) AS day, dayofyear(cal.d) AS day_of_year, dayofweek(cal.d) AS day_of_week,
       {week_sql('cal.d')} AS week_of_year, CAST(strftime(cal.d, '%Y%m%d') AS BIGINT) AS id_fecha,
       CAST(strftime(cal.d, '%Y%m') AS BIGINT) AS month_key, year(cal.d) * 100 + quarter(cal.d) AS quarter_code,
       coalesce(orders, 0) AS orders
FROM cal LEFT JOIN n ON n.d = cal.d""")
def date_dim_core(spark, sf_dir):
    """Date parts and integer keys of every day, with the orders placed on it."""
    placed = samples.table(spark, sf_dir, "orders").groupBy(F.to_date("o_orderdate").alias("Date")).agg(
        F.count(F.lit(1)).alias("orders")
    )
    calendar = order_calendar(
        spark, sf_dir, "Date", "Year", "Month", "Quarter", "Day", "Day of Year", "Day of Week", "Week of Year",
        "idFecha", "MonthKey", "QuarterCode",
    )
    return calendar.join(placed, "Date", "left").select(
        text("Date", "date"), whole("Year", "year"), whole("Month", "month"), whole("Quarter", "quarter"),
        whole("Day", "day"), whole("Day of Year", "day_of_year"), whole("Day of Week", "day_of_week"),
        whole("Week of Year", "week_of_year"), whole("idFecha", "id_fecha"), whole("MonthKey", "month_key"),
        whole("QuarterCode", "quarter_code"), F.coalesce("orders", F.lit(0)).alias("orders"),
    )


_NAMES_SQL = " UNION ALL ".join(
    f"SELECT '{lang}' AS lang, d, {MONTHS[lang]}[month(d)] AS m, {DAYS[lang]}[dayofweek(d) + 1] AS day_name FROM cal"
    for lang in MONTHS
)


@query(f"""WITH {CAL}, named AS ({_NAMES_SQL})
SELECT lang, CAST(d AS VARCHAR) AS date, m AS month_name, m[1:3] AS month_name_short,
       m || ' ' || year(d) AS month_name_complete, m[1:3] || ' ' || strftime(d, '%y') AS month_name_short_complete,
       day_name
FROM named""")
def date_dim_names(spark, sf_dir):
    """Month and day names in each language."""
    days = order_days(spark, sf_dir)
    return reduce(DataFrame.unionByName, [
        describe_days(days, lang=lang, as_of=AS_OF, columns=[
            "Date", "Month Name", "Month Name Short", "Month Name Complete", "Month Name Short Complete", "Day Name",
        ]).select(
            F.lit(lang).alias("lang"), text("Date", "date"), F.col("`Month Name`").alias("month_name"),
            F.col("`Month Name Short`").alias("month_name_short"),
            F.col("`Month Name Complete`").alias("month_name_complete"),
            F.col("`Month Name Short Complete`").alias("month_name_short_complete"),
            F.col("`Day Name`").alias("day_name"),
        )
        for lang in MONTHS
    ])


@query(f"""WITH {CAL}
SELECT CAST(d AS VARCHAR) AS date, week(d) AS iso_week, isoyear(d) AS iso_year, {week_sql('d')} AS week_of_year
FROM cal""")
def date_dim_iso_weeks(spark, sf_dir):
    return order_calendar(spark, sf_dir, "Date", "IsoWeek", "IsoYear", "Week of Year").select(
        text("Date", "date"), whole("IsoWeek", "iso_week"), whole("IsoYear", "iso_year"),
        whole("Week of Year", "week_of_year"),
    )


_FISCAL = [(1, "Start"), (1, "End"), (4, "End"), (6, "Start"), (6, "End"), (10, "End"), (12, "Start")]


@query(f"""WITH {CAL}, sets(s, basis) AS (VALUES {', '.join(map(str, _FISCAL))}),
f AS (SELECT s, basis, d, CAST(d - to_months(s) AS DATE) AS fd,
             CASE WHEN month(d) >= s THEN year(d) ELSE year(d) - 1 END + CASE basis WHEN 'End' THEN 1 ELSE 0 END AS fy,
             (month(d) + 12 - s) % 12 AS passed
      FROM cal, sets)
SELECT CAST(s AS BIGINT) AS fiscal_start_month, basis AS fiscal_year_basis, CAST(d AS VARCHAR) AS date,
       CAST(fd AS VARCHAR) AS fiscal_date, fy AS fiscal_year, passed // 3 + 1 AS fiscal_quarter,
       fy * 100 + passed // 3 + 1 AS fiscal_quarter_code, {week_sql('fd')} AS fiscal_week_of_year,
       passed + 1 AS fiscal_month_number
FROM f""")
def date_dim_fiscal(spark, sf_dir):
    """Fiscal parts of every day under several starting months and both ways of naming the year."""
    days = order_days(spark, sf_dir)
    return reduce(DataFrame.unionByName, [
        describe_days(days, fiscal_start_month=start, fiscal_year_basis=basis, as_of=AS_OF, columns=[
            "Date", "FiscalDate", "FiscalYear", "FiscalQuarter", "FiscalQuarterCode", "Fiscal Week of Year",
            "FiscalMonthNumber",
        ]).select(
            whole(F.lit(start), "fiscal_start_month"), F.lit(basis).alias("fiscal_year_basis"), text("Date", "date"),
            text("FiscalDate", "fiscal_date"), whole("FiscalYear", "fiscal_year"),
            whole("FiscalQuarter", "fiscal_quarter"), whole("FiscalQuarterCode", "fiscal_quarter_code"),
            whole("Fiscal Week of Year", "fiscal_week_of_year"), whole("FiscalMonthNumber", "fiscal_month_number"),
        )
        for start, basis in _FISCAL
    ])


@query(f"""WITH {CAL}, x AS (SELECT d, DATE '{AS_OF}' AS today FROM cal)
SELECT CAST(d AS VARCHAR) AS date, date_diff('day', today, d) AS day_offset, date_diff('year', today, d) AS year_offset,
       date_diff('month', today, d) AS month_offset, date_diff('quarter', today, d) AS quarter_offset
FROM x""")
def date_dim_offsets(spark, sf_dir):
    return order_calendar(spark, sf_dir, "Date", "DayOffset", "YearOffset", "MonthOffset", "QuarterOffset").select(
        text("Date", "date"), whole("DayOffset", "day_offset"), whole("YearOffset", "year_offset"),
        whole("MonthOffset", "month_offset"), whole("QuarterOffset", "quarter_offset"),
    )


def _label_sql(value: str, today: str, unit: str) -> str:
    return (f"CASE sign({value} - {today}) WHEN 0 THEN 'Current' WHEN 1 THEN 'Future {unit}' "
            f"ELSE 'Past {unit}' END")


@query(f"""WITH {CAL}, x AS (
  SELECT d, year(d) AS y, year(d) * 12 + month(d) AS m, year(d) * 100 + {week_sql('d')} AS w,
         year(d) + CASE WHEN month(d) >= 6 THEN 1 ELSE 0 END AS fy, date_diff('day', DATE '1900-01-01', d) AS n
  FROM cal),
today AS (SELECT y AS ty, m AS tm, w AS tw, fy AS tfy, n AS tn FROM x WHERE d = DATE '{AS_OF}')
SELECT CAST(d AS VARCHAR) AS date, {_label_sql('y', 'ty', 'Year')} AS current_year,
       {_label_sql('m', 'tm', 'Month')} AS current_month, {_label_sql('w', 'tw', 'Week')} AS current_week,
       {_label_sql('n', 'tn', 'Day')} AS current_day, {_label_sql('fy', 'tfy', 'Year')} AS current_fiscal_year,
       {_label_sql('m', 'tm', 'Month')} AS current_fiscal_month, {_label_sql('w', 'tw', 'Week')} AS current_fiscal_week
FROM x, today""")
def date_dim_current(spark, sf_dir):
    """Current, Future and Past labels relative to a given day."""
    labels = ["Current Year", "Current Month", "Current Week", "Current Day", "Current Fiscal Year",
              "Current Fiscal Month", "Current Fiscal Week"]
    return order_calendar(spark, sf_dir, "Date", *labels).select(
        text("Date", "date"), *[F.col(f"`{c}`").alias(c.lower().replace(" ", "_")) for c in labels]
    )


@query(f"""WITH {CAL}, x AS (SELECT d, dayofweek(d) BETWEEN 1 AND 5 AS works FROM cal)
SELECT CAST(a.d AS VARCHAR) AS date, a.works AS is_working_day, count(b.d) AS working_day_number
FROM x a LEFT JOIN x b ON year(b.d) = year(a.d) AND b.d <= a.d AND b.works GROUP BY a.d, a.works""")
def date_dim_working_days(spark, sf_dir):
    return order_calendar(spark, sf_dir, "Date", "IsWorkingDay", "WorkingDayNumber").select(
        text("Date", "date"), F.col("IsWorkingDay").alias("is_working_day"),
        whole("WorkingDayNumber", "working_day_number"),
    )


@query(f"""WITH {CAL}, x AS (SELECT d, dayofweek(d) BETWEEN 1 AND 5 AS works FROM cal),
y AS (SELECT year(d) AS y, count(*) FILTER (works) AS n FROM x GROUP BY 1)
SELECT count(*) AS days, count(DISTINCT d) AS different_days, count(DISTINCT strftime(d, '%Y%m%d')) AS different_keys,
       CAST(min(d) AS VARCHAR) AS first_day, CAST(max(d) AS VARCHAR) AS last_day,
       date_diff('day', min(d), max(d)) + 1 AS expected_days,
       count(*) FILTER (d = DATE '{AS_OF}') AS today_rows, count(*) FILTER (works) AS working_days,
       (SELECT max(n) FROM y) AS longest_working_year
FROM x""")
def date_dim_sanity(spark, sf_dir):
    checked = calendar_sanity(order_calendar(spark, sf_dir), AS_OF)
    return checked.select(*[
        text(c) if c in ("first_day", "last_day") else whole(c) for c in checked.columns
    ])


@query("""WITH b AS (SELECT CAST(min(o_orderdate) AS DATE) AS a, CAST(max(o_orderdate) AS DATE) AS z FROM orders),
x AS (SELECT CAST(unnest(generate_series(a - INTERVAL 12 MONTH, CAST(z AS TIMESTAMP), INTERVAL 1 DAY)) AS DATE) AS d
      FROM b)
SELECT CAST(d AS VARCHAR) AS fecha, year(d) AS anio, quarter(d) AS trimestre, month(d) AS mes,
       """ + f"{MONTHS['es']}[month(d)]" + """ AS nombre_mes
FROM x""")
def calendar_from_orders(spark, sf_dir):
    """The calendar that starts a year before the first order and stops at the last one."""
    days = calendar_from(samples.table(spark, sf_dir, "orders"), "o_orderdate", lead_months=12)
    return with_calendar_columns(days, "Date").select(
        text("Date", "fecha"), whole("Año", "anio"), whole(F.quarter("Date"), "trimestre"), whole("Mes", "mes"),
        F.col("NombreMes").alias("nombre_mes"),
    )


@query("""WITH b AS (SELECT min(year(l_shipdate)) AS a, max(year(l_shipdate)) AS z FROM lineitem),
x AS (SELECT CAST(unnest(generate_series(CAST(make_date(a, 1, 1) AS TIMESTAMP),
                                         CAST(make_date(z, 12, 31) AS TIMESTAMP), INTERVAL 1 DAY)) AS DATE) AS d
      FROM b),
n AS (SELECT CAST(l_shipdate AS DATE) AS d, count(*) AS shipped FROM lineitem GROUP BY 1)
SELECT CAST(x.d AS VARCHAR) AS date, 'Trim. ' || quarter(x.d) AS quarter_label, coalesce(shipped, 0) AS shipped_lines
FROM x LEFT JOIN n ON n.d = x.d""")
def auto_calendar_of_shipments(spark, sf_dir):
    """The whole years of a date column, with quarter labels and the lines shipped per day."""
    lines = samples.table(spark, sf_dir, "lineitem")
    shipped = lines.groupBy(F.to_date("l_shipdate").alias("Date")).agg(F.count(F.lit(1)).alias("shipped_lines"))
    return filled_days(shipped, whole_years=True).select(
        text("Date", "date"), D.quarter_label("Date").alias("quarter_label"),
        F.when(F.col("_given"), F.col("shipped_lines")).otherwise(0).alias("shipped_lines"),
    )


@query(f"""WITH {LINES}, p AS (SELECT l_suppkey, t, max(d) AS z FROM lines GROUP BY 1, 2),
e AS (SELECT z AS hasta FROM p WHERE z < (SELECT max(z) FROM p) - 90)
SELECT count(*) AS days, CAST(min(d) AS VARCHAR) AS first_day, CAST(max(d) AS VARCHAR) AS last_day,
       (SELECT count(*) FROM e) AS closed_periods
FROM (SELECT CAST(unnest(generate_series(CAST(make_date(year(min(hasta)), 1, 1) AS TIMESTAMP),
                                         CAST(make_date(year(max(hasta)), 12, 31) AS TIMESTAMP),
                                         INTERVAL 1 DAY)) AS DATE) AS d FROM e)""")
def auto_calendar_of_history(spark, sf_dir):
    """A calendar over the ends of the sellers' periods, which must not run on to the open end in 9999."""
    fact = sales_fact(samples.order_entry(spark, sf_dir))
    periods = materialise(seller_periods(fact), "periods")  # the sellers' history: read for the bounds and to be counted
    closed = periods.where(F.col("Hasta") < F.lit(OPEN_END)).agg(F.count(F.lit(1))).scalar()
    return calendar_from(periods, "Hasta", whole_years=True).agg(
        F.count(F.lit(1)).alias("days"), F.min("Date").cast("string").alias("first_day"),
        F.max("Date").cast("string").alias("last_day"), F.max(closed).alias("closed_periods"),
    )


@query("""WITH days AS (SELECT CAST(unnest(generate_series(TIMESTAMP '1994-01-01', TIMESTAMP '2003-12-31', INTERVAL 1 DAY)) AS DATE) AS d),
n AS (SELECT CAST(o_orderdate AS DATE) AS d, count(*) AS orders FROM orders GROUP BY 1)
SELECT year(days.d) + CASE WHEN month(days.d) >= 4 THEN 1 ELSE 0 END AS fiscal_year, (month(days.d) + 8) % 12 // 3 + 1 AS fiscal_quarter,
       ['Sunday', 'Monday', 'Tuesday', 'Wednesday', 'Thursday', 'Friday', 'Saturday'][dayofweek(days.d) + 1] AS day_name,
       count(*) AS days, CAST(coalesce(sum(orders), 0) AS BIGINT) AS orders
FROM days LEFT JOIN n ON n.d = days.d GROUP BY 1, 2, 3""")
def calendar_by_parameters(spark, sf_dir):
    """A calendar given by its parameters, with the orders of each fiscal quarter and weekday beside its days."""
    calendar = date_dim(
        spark, 1994, 2003, fiscal_start_month=4, lang="en", as_of=AS_OF, columns=["Date", "FiscalYear", "FiscalQuarter", "Day Name"]
    )
    orders = samples.table(spark, sf_dir, "orders").groupBy(F.to_date("o_orderdate").alias("Date")).agg(F.count(F.lit(1)).alias("orders"))
    return calendar.join(orders, "Date", "left").groupBy(
        whole("FiscalYear", "fiscal_year"), whole("FiscalQuarter", "fiscal_quarter"), F.col("`Day Name`").alias("day_name")
    ).agg(F.count(F.lit(1)).alias("days"), F.coalesce(F.sum("orders"), F.lit(0)).alias("orders"))


@query(f"""WITH {CAL}, b AS (SELECT min(d) AS a, max(d) AS z FROM cal), x AS (
  SELECT 'orders' AS "table", 'o_orderdate' AS "column", min(CAST(o_orderdate AS DATE)) AS f, max(CAST(o_orderdate AS DATE)) AS l FROM orders
  UNION ALL SELECT 'lineitem', 'l_shipdate', min(CAST(l_shipdate AS DATE)), max(CAST(l_shipdate AS DATE)) FROM lineitem
  UNION ALL SELECT 'events', 'ts', min(CAST(ts AS DATE)), max(CAST(ts AS DATE)) FROM events)
SELECT "table", "column", CAST(f AS VARCHAR) AS first, CAST(l AS VARCHAR) AS last, f >= a AS starts_inside, l <= z AS ends_inside,
       (SELECT date_diff('day', min(f), max(l)) + 1 FROM x) AS days_of_all
FROM x, b""")
def date_bounds_of_all_tables(spark, sf_dir):
    """First and last day of every date column, whether the order calendar reaches them, and the calendar that would."""
    tables = {name: samples.table(spark, sf_dir, name) for name in ("orders", "lineitem", "events")}
    bounds = materialise(days_outside(tables, order_days(spark, sf_dir)), "bounds")
    days = calendar_over(bounds).agg(F.count(F.lit(1))).scalar()
    return bounds.select(
        "table", "column", text("first"), text("last"), "starts_inside", "ends_inside", days.alias("days_of_all")
    )


@query(f"""WITH {CAL}
SELECT CAST(strftime(d, '%Y%m%d') AS BIGINT) AS fecha_key, CAST(d AS VARCHAR) AS fecha, year(d) AS anio,
       quarter(d) AS trimestre, month(d) AS mes, {MONTHS['es']}[month(d)] AS nombre_mes, {week_sql('d')} AS semana,
       {DAYS['es']}[dayofweek(d) + 1] AS dia_semana
FROM cal""")
def dim_date(spark, sf_dir):
    """The eight-column calendar of the star."""
    return small_date_dim(order_days(spark, sf_dir)).select(
        whole("FechaKey", "fecha_key"), text("Fecha", "fecha"), whole("Anio", "anio"), whole("Trimestre", "trimestre"),
        whole("Mes", "mes"), F.col("NombreMes").alias("nombre_mes"), whole("Semana", "semana"),
        F.col("DiaSemana").alias("dia_semana"),
    )


@query(f"""WITH {CAL}
SELECT CAST(d AS VARCHAR) AS date, 'Current' AS current_day, {week_sql('d')} AS week_of_year
FROM cal WHERE d = DATE '{AS_OF}'""")
def calendar_today(spark, sf_dir):
    """The calendar row of the reference day."""
    return today_row(order_calendar(spark, sf_dir, "Date", "Current Day", "Week of Year"), AS_OF).select(
        text("Date", "date"), F.col("`Current Day`").alias("current_day"), whole("Week of Year", "week_of_year")
    )
