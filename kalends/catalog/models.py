"""Queries that build the flat table, the star and the histories, and check one against the other."""

from __future__ import annotations

from pyspark.sql import functions as F

from kalends.catalog.calendars import order_days
from kalends.catalog.registry import CAL, LINES, money, query, text, whole
from kalends.operators.distinct import distinct_counts
from kalends.operators.joins import aggregate_through_join, dim_with_history
from kalends.operators.numbering import global_row_number
from kalends.operators.quality import (
    cardinality, correction_impact, date_coverage, duplicate_keys, fanout_audit, reconcile, repetition, row_counts,
)
from kalends.plans import flat as flat_plans
from kalends.plans import star as star_plans
from kalends.sources import samples
from kalends.sources.readers import FLAT_SCHEMA, cast_columns, read_flat_csv
from kalends.sources.sinks import write_table, write_text_csv
from kalends.storage import Scratch, materialise

# Half-up to four places in whole numbers: neither engine's rounding of a double is involved.
_UNIT_PRICE = """CAST((200 * CAST(round(l_extendedprice * 100) AS BIGINT) + CAST(l_quantity AS BIGINT))
  // (2 * CAST(l_quantity AS BIGINT)) AS DOUBLE) / 10000"""
_PERSON = "replace({c}, '#', ' ')"
# Enough columns to tell all lines apart that differ in anything a model keeps.
LINE_ORDER = ["SalesOrderNumber", "SalesOrderLineNumber", "ProductKey", "OrderQuantity", "UnitPrice",
              "UnitPriceDiscountPct", "ShipDate"]


@query(f"""WITH {LINES}
SELECT l_orderkey AS sales_order_id, CAST(l_linenumber AS BIGINT) AS line_id, CAST(d AS VARCHAR) AS order_date,
       CAST(shipped AS VARCHAR) AS ship_date, o_orderstatus AS estado_pedido, o_custkey AS customer_id,
       replace(c_name, '#', ' ') AS nombre_cliente, CAST(t AS BIGINT) AS territory_id, n_name AS territorio,
       l_partkey AS product_id, p_name AS producto, CAST(p_retailprice AS DOUBLE) AS list_price,
       p_brand AS subcategoria, p_type AS categoria, -1 - l_suppkey AS vendedor_id,
       replace(s_name, '#', ' ') AS nombre_vendedor, CAST(l_quantity AS BIGINT) AS order_qty,
       {_UNIT_PRICE} AS unit_price, l_discount AS unit_price_discount, CAST(amount AS DOUBLE) AS line_total
FROM lines JOIN customer ON c_custkey = o_custkey JOIN nation ON n_nationkey = t JOIN part ON p_partkey = l_partkey
LEFT JOIN supplier ON s_suppkey = l_suppkey""")
def flat_sales(spark, sf_dir):
    """The whole wide table, with people joined as customers and as sellers."""
    flat = flat_plans.flat_from_order_entry(samples.order_entry(spark, sf_dir, amounts=False), samples.line_amounts())
    return flat.select(
        whole("SalesOrderID", "sales_order_id"), whole("SalesOrderDetailID", "line_id"),
        text(F.to_date("OrderDate"), "order_date"), text(F.to_date("ShipDate"), "ship_date"),
        F.col("EstadoPedido").alias("estado_pedido"), whole("CustomerID", "customer_id"),
        F.col("NombreCliente").alias("nombre_cliente"), whole("TerritoryID", "territory_id"),
        F.col("Territorio").alias("territorio"), whole("ProductID", "product_id"), F.col("Producto").alias("producto"),
        money("ListPrice", "list_price"), F.col("Subcategoria").alias("subcategoria"),
        F.col("Categoria").alias("categoria"), whole("VendedorID", "vendedor_id"),
        F.col("NombreVendedor").alias("nombre_vendedor"), whole("OrderQty", "order_qty"),
        money("UnitPrice", "unit_price"), money("UnitPriceDiscount", "unit_price_discount"),
        money("LineTotal", "line_total"),
    )


@query(f"""WITH {LINES}, x AS (
  SELECT count(*) AS n, count(DISTINCT o_custkey) AS c, count(DISTINCT l_partkey) AS p, count(DISTINCT t) AS t
  FROM lines)
SELECT n AS rows, c AS customers, p AS products, t AS territories,
       CAST(n AS DOUBLE) / c AS rows_per_customer, CAST(n AS DOUBLE) / p AS rows_per_product
FROM x""")
def flat_repetition(spark, sf_dir):
    """How often the flat table repeats its customers and products."""
    fact = star_plans.sales_fact(samples.order_entry(spark, sf_dir))
    return repetition(fact, "ClienteKey", "ProductoKey", "TerritorioKey")


@query("""SELECT p_partkey AS producto_key, p_name AS producto, p_retailprice AS list_price, p_brand AS subcategoria,
       p_type AS categoria FROM part""")
def dim_product(spark, sf_dir):
    """The product snowflake flattened."""
    return star_plans.product_dim(samples.order_entry(spark, sf_dir)).select(
        whole("ProductoKey", "producto_key"), F.col("Producto").alias("producto"), money("ListPrice", "list_price"),
        F.col("Subcategoria").alias("subcategoria"), F.col("Categoria").alias("categoria"),
    )


@query("SELECT c_custkey AS cliente_key, replace(c_name, '#', ' ') AS nombre_cliente FROM customer")
def dim_customer(spark, sf_dir):
    return star_plans.customer_dim(samples.order_entry(spark, sf_dir)).select(
        whole("ClienteKey", "cliente_key"), F.col("NombreCliente").alias("nombre_cliente")
    )


@query("""SELECT CAST(n_nationkey AS BIGINT) AS territorio_key, n_name AS territorio, n_name AS pais, r_name AS grupo
FROM nation LEFT JOIN region ON r_regionkey = n_regionkey""")
def dim_territory(spark, sf_dir):
    return star_plans.territory_dim(samples.order_entry(spark, sf_dir)).select(
        whole("TerritorioKey", "territorio_key"), F.col("Territorio").alias("territorio"),
        F.col("Pais").alias("pais"), F.col("Grupo").alias("grupo"),
    )


@query("""SELECT s_suppkey AS vendedor_key, replace(s_name, '#', ' ') AS nombre_vendedor,
       CAST(s_nationkey AS BIGINT) AS territorio_key FROM supplier WHERE s_acctbal > 0""")
def dim_seller(spark, sf_dir):
    """The employees flagged as salespeople, one row each with their highest territory."""
    return flat_plans.salespeople(samples.warehouse(spark, sf_dir)["employees"]).select(
        whole("VendedorKey", "vendedor_key"), F.col("NombreVendedor").alias("nombre_vendedor"),
        whole("TerritorioKey", "territorio_key"),
    )


@query("""WITH s AS (SELECT s_suppkey AS k, replace(s_name, '#', ' ') AS n, s_nationkey AS t
                     FROM supplier WHERE s_acctbal > 0)
SELECT k AS vendedor_key, n AS nombre_vendedor, CAST(1 AS BIGINT) AS territorio_key, '2005-01-01' AS desde,
       '2015-12-31' AS hasta FROM s
UNION ALL
SELECT k, n, CAST(t AS BIGINT), '2016-01-01', '9999-12-31' FROM s""")
def seller_history(spark, sf_dir):
    """Two validity periods per salesperson."""
    sellers = flat_plans.salespeople(samples.warehouse(spark, sf_dir)["employees"])
    return star_plans.seller_history(sellers).select(
        whole("VendedorKey", "vendedor_key"), F.col("NombreVendedor").alias("nombre_vendedor"),
        whole("TerritorioKey", "territorio_key"), text("Desde", "desde"), text("Hasta", "hasta"),
    )


@query(f"""WITH {LINES}
SELECT l_orderkey AS sales_order_number, CAST(l_linenumber AS BIGINT) AS line_number,
       CAST(strftime(d, '%Y%m%d') AS BIGINT) AS fecha_key, o_custkey AS cliente_key,
       CAST(t AS BIGINT) AS territorio_key, l_partkey AS producto_key, -1 - l_suppkey AS vendedor_key,
       CAST(l_quantity AS BIGINT) AS order_qty, {_UNIT_PRICE} AS unit_price,
       l_discount AS unit_price_discount, CAST(amount AS DOUBLE) AS line_total
FROM lines""")
def fact_sales(spark, sf_dir):
    """The whole star fact: keys and amounts only."""
    return star_plans.sales_fact(samples.order_entry(spark, sf_dir)).select(
        whole("SalesOrderNumber", "sales_order_number"), whole("SalesOrderLineNumber", "line_number"),
        whole("FechaKey", "fecha_key"), whole("ClienteKey", "cliente_key"), whole("TerritorioKey", "territorio_key"),
        whole("ProductoKey", "producto_key"), whole("VendedorKey", "vendedor_key"), whole("OrderQty", "order_qty"),
        money("UnitPrice", "unit_price"), money("UnitPriceDiscount", "unit_price_discount"),
        money("LineTotal", "line_total"),
    )


@query(f"""WITH {CAL}
SELECT (SELECT count(*) FROM lineitem JOIN orders ON o_orderkey = l_orderkey) AS filas_hechos,
       (SELECT count(*) FROM part) AS filas_dim_producto, (SELECT count(*) FROM customer) AS filas_dim_cliente,
       (SELECT count(*) FROM nation) AS filas_dim_territorio, (SELECT count(*) FROM supplier) AS filas_dim_vendedor,
       (SELECT count(*) FROM cal) AS filas_dim_fecha""")
def star_row_counts(spark, sf_dir):
    """The sizes of the star's six tables in one row."""
    t = samples.order_entry(spark, sf_dir, territory=False)
    return row_counts({
        "filas_hechos": star_plans.sales_fact(t), "filas_dim_producto": star_plans.product_dim(t),
        "filas_dim_cliente": star_plans.customer_dim(t), "filas_dim_territorio": star_plans.territory_dim(t),
        "filas_dim_vendedor": star_plans.seller_dim(t), "filas_dim_fecha": order_days(spark, sf_dir),
    })


def lines_as_flat(spark, sf_dir):
    """The flat table under the 23 column names of the file format; sellers are those of the lines."""
    flat = flat_plans.flat_from_order_entry(samples.order_entry(spark, sf_dir, amounts=False), samples.line_amounts()).withColumnsRenamed({
        "SalesOrderID": "SalesOrderNumber", "SalesOrderDetailID": "SalesOrderLineNumber", "CustomerID": "ClienteID",
        "TerritoryID": "TerritorioID", "CountryRegionCode": "Pais", "ProductID": "ProductoID",
    }).withColumn("DueDate", F.lit(None).cast("timestamp_ntz"))
    return flat.select(*[F.col(f.name).cast(f.dataType) for f in FLAT_SCHEMA.fields])


@query(f"""WITH {LINES}
SELECT (SELECT count(*) FROM lines) AS fact_ventas, (SELECT count(DISTINCT l_partkey) FROM lines) AS dim_producto,
       (SELECT count(DISTINCT o_custkey) FROM lines) AS dim_cliente,
       (SELECT count(DISTINCT t) FROM lines) AS dim_territorio,
       (SELECT count(*) FROM (SELECT DISTINCT l_suppkey, t FROM lines)) AS dim_vendedor,
       2 * (SELECT count(*) FROM (SELECT DISTINCT l_suppkey, t FROM lines)) AS dim_vendedor_historial""")
def star_from_flat_counts(spark, sf_dir):
    """The sizes of the tables derived from the flat table alone, which is stored once and read many times."""
    tables = star_plans.star_from_flat(materialise(lines_as_flat(spark, sf_dir), "flat"))
    return row_counts({name.lower(): df for name, df in tables.items()})


@query(f"""WITH {LINES}
SELECT -1 - l_suppkey AS vendedor_key, count(DISTINCT t) AS rows FROM lines GROUP BY 1 HAVING count(DISTINCT t) > 1""")
def dimension_key_check(spark, sf_dir):
    """Sellers that come out more than once when their dimension is the distinct rows of the flat table."""
    columns = ["VendedorID", "NombreVendedor", "TerritoryID"]
    sellers = flat_plans.flat_groups(samples.order_entry(spark, sf_dir), columns)
    return duplicate_keys(sellers, ["VendedorID"]).select(whole("VendedorID", "vendedor_key"), "rows")


@query(f"""WITH {LINES}
SELECT -1 - l_suppkey AS vendedor_key, any_value(replace(s_name, '#', ' ')) AS nombre_vendedor,
       CAST(max(t) AS BIGINT) AS territorio_key
FROM lines LEFT JOIN supplier ON s_suppkey = l_suppkey GROUP BY 1""")
def dim_seller_from_flat(spark, sf_dir):
    """The seller dimension from the flat table with one row per key."""
    columns = ["VendedorID", "NombreVendedor", "TerritoryID"]
    sellers = flat_plans.flat_groups(samples.order_entry(spark, sf_dir), columns)
    return star_plans.keyed_dim(sellers, "VendedorID", ["NombreVendedor", "TerritoryID"], "VendedorKey").select(
        whole("VendedorKey", "vendedor_key"), F.col("NombreVendedor").alias("nombre_vendedor"),
        whole("TerritoryID", "territorio_key"),
    )


@query(f"""WITH {LINES}, x AS (SELECT count(*) AS rows, CAST(sum(amount) AS DOUBLE) AS total FROM lines)
SELECT 'flat' AS model, * FROM x UNION ALL SELECT 'star', * FROM x""")
def flat_star_reconcile(spark, sf_dir):
    """Flat table and star fact must agree on rows and total."""
    t = samples.order_entry(spark, sf_dir)
    compared = reconcile(
        {"flat": flat_plans.flat_from_order_entry(t), "star": star_plans.sales_fact(t)}, "LineTotal"
    )
    return compared.select("model", "rows", money("total"))


@query(f"""WITH {LINES}, h AS (SELECT s_suppkey FROM supplier UNION ALL SELECT s_suppkey FROM supplier)
SELECT 'A. without the join' AS version, count(*) AS rows, CAST(sum(amount) AS DOUBLE) AS total FROM lines
UNION ALL
SELECT 'B. with the join', count(*), CAST(sum(amount) AS DOUBLE) FROM lines JOIN h ON s_suppkey = l_suppkey""")
def history_trap(spark, sf_dir):
    """Rows and sales before and after the seller history is joined to the lines."""
    t = samples.order_entry(spark, sf_dir, territory=False)
    history = star_plans.seller_history(star_plans.seller_dim(t))
    audit = fanout_audit(star_plans.sales_fact(t), "VendedorKey", history, "VendedorKey", "LineTotal")
    return audit.select("version", "rows", money("total"))


@query(f"""WITH {LINES}, h AS (
  SELECT s_suppkey, '2005-01-01' AS desde, 1 AS tk FROM supplier
  UNION ALL SELECT s_suppkey, '2016-01-01', s_nationkey FROM supplier)
SELECT desde, CAST(tk AS BIGINT) AS territorio_historico, count(*) AS rows, CAST(sum(amount) AS DOUBLE) AS total
FROM lines JOIN h ON s_suppkey = l_suppkey GROUP BY 1, 2""")
def history_trap_by_period(spark, sf_dir):
    """Sales by the history's own columns after the naive join: every line counted in each period."""
    t = samples.order_entry(spark, sf_dir, territory=False)
    history = star_plans.seller_history(star_plans.seller_dim(t))
    summed = aggregate_through_join(
        star_plans.sales_fact(t), "VendedorKey", history, "VendedorKey", {"total": "LineTotal"}, by_other=["Desde", "TerritorioKey"]
    )
    return summed.select(text("Desde", "desde"), whole("TerritorioKey", "territorio_historico"), "rows", money("total"))


@query(f"""WITH {LINES}, f AS (SELECT l_suppkey, CAST(sum(amount) AS DOUBLE) AS sales FROM lines GROUP BY 1),
h AS (SELECT s_suppkey, '2005-01-01' AS desde, '2015-12-31' AS hasta, 1 AS tk FROM supplier
      UNION ALL SELECT s_suppkey, '2016-01-01', '9999-12-31', s_nationkey FROM supplier)
SELECT -1 - s.s_suppkey AS vendedor_key, replace(s_name, '#', ' ') AS nombre_vendedor,
       CAST(s_nationkey AS BIGINT) AS territorio_key, CAST(tk AS BIGINT) AS territorio_historico, desde, hasta, sales
FROM supplier s LEFT JOIN h ON h.s_suppkey = s.s_suppkey LEFT JOIN f ON l_suppkey = s.s_suppkey""")
def history_on_dimension(spark, sf_dir):
    """The history hung on the seller dimension, with each seller's unchanged sales."""
    t = samples.order_entry(spark, sf_dir, territory=False)
    sellers = star_plans.seller_dim(t)
    sales = star_plans.sales_fact(t).groupBy("VendedorKey").agg(F.sum("LineTotal").alias("sales"))
    return dim_with_history(sellers, star_plans.seller_history(sellers), "VendedorKey").join(
        sales, "VendedorKey", "left"
    ).select(
        whole("VendedorKey", "vendedor_key"), F.col("NombreVendedor").alias("nombre_vendedor"),
        whole("TerritorioKey", "territorio_key"), whole("HistorialTerritorioKey", "territorio_historico"),
        text("Desde", "desde"), text("Hasta", "hasta"), money("sales"),
    )


_LINE_ORDER_SQL = "l_orderkey, l_linenumber, l_partkey, l_quantity, l_extendedprice, l_discount, l_shipdate, l_suppkey"


@query(f"""SELECT l_orderkey, CAST(l_linenumber AS BIGINT) AS l_linenumber, l_partkey, l_suppkey,
       row_number() OVER (ORDER BY {_LINE_ORDER_SQL}) AS line_rank FROM lineitem""")
def global_line_numbers(spark, sf_dir):
    """Every line with its position in the order of all lines."""
    order = ["l_orderkey", "l_linenumber", "l_partkey", "l_quantity", "l_extendedprice", "l_discount", "l_shipdate",
             "l_suppkey"]
    numbered = global_row_number(samples.table(spark, sf_dir, "lineitem").select(*order), order, "line_rank")
    return numbered.select("l_orderkey", whole("l_linenumber"), "l_partkey", "l_suppkey", whole("line_rank"))


_DEALT = f"""{LINES},
numbered AS (
  SELECT *, row_number() OVER (ORDER BY l_orderkey, l_linenumber, l_partkey, CAST(l_quantity AS BIGINT),
                               {_UNIT_PRICE}, l_discount, l_shipdate) AS n FROM lines),
sellers AS (
  SELECT s_suppkey, s_name, row_number() OVER (ORDER BY s_suppkey) AS slot, count(*) OVER () AS k
  FROM supplier WHERE s_acctbal > 0),
dealt AS (SELECT * FROM numbered JOIN sellers ON slot = (n - 1) % k + 1)"""


@query(f"""WITH {_DEALT}
SELECT s_suppkey AS vendedor_key, count(*) AS rows, CAST(sum(amount) AS DOUBLE) AS total FROM dealt GROUP BY 1""")
def round_robin_seller(spark, sf_dir):
    """Lines dealt to the salespeople in turn: what each of them receives."""
    t = samples.warehouse(spark, sf_dir)
    sales = t["sales"].select(*LINE_ORDER, "SalesAmount")
    return flat_plans.sales_with_sellers(sales, t["employees"], LINE_ORDER).groupBy(
        whole("VendedorKey", "vendedor_key")
    ).agg(F.count(F.lit(1)).alias("rows"), money(F.sum("SalesAmount"), "total"))


@query(f"""WITH {_DEALT}
SELECT CAST(l_orderkey AS VARCHAR) AS sales_order_number, CAST(l_linenumber AS BIGINT) AS line_number,
       CAST(d AS VARCHAR) AS order_date, CAST(shipped AS VARCHAR) AS ship_date, o_custkey AS cliente_id,
       replace(c_name, '#', ' ') AS nombre_cliente, n_name AS territorio, p_name AS producto,
       p_brand AS subcategoria, p_type AS categoria, s_suppkey AS vendedor_id,
       replace(s_name, '#', ' ') AS nombre_vendedor, CAST(amount AS DOUBLE) AS line_total
FROM dealt JOIN customer ON c_custkey = o_custkey JOIN nation ON n_nationkey = t JOIN part ON p_partkey = l_partkey""")
def flat_from_warehouse(spark, sf_dir):
    """The wide table of a warehouse without sellers, each line dealt to a salesperson."""
    flat = flat_plans.flat_from_warehouse(samples.warehouse(spark, sf_dir), LINE_ORDER)
    return flat.select(
        text("SalesOrderNumber", "sales_order_number"), whole("SalesOrderLineNumber", "line_number"),
        text(F.to_date("OrderDate"), "order_date"), text(F.to_date("ShipDate"), "ship_date"),
        whole("ClienteID", "cliente_id"), F.col("NombreCliente").alias("nombre_cliente"),
        F.col("Territorio").alias("territorio"), F.col("Producto").alias("producto"),
        F.col("Subcategoria").alias("subcategoria"), F.col("Categoria").alias("categoria"),
        whole("VendedorID", "vendedor_id"), F.col("NombreVendedor").alias("nombre_vendedor"),
        money("LineTotal", "line_total"),
    )


@query(f"""WITH {_DEALT}
SELECT (SELECT count(*) FROM dealt) AS fact_ventas, (SELECT count(DISTINCT d) FROM dealt) AS dias_con_venta,
       (SELECT CAST(sum(amount) AS DOUBLE) FROM dealt) AS total,
       (SELECT count(DISTINCT s_suppkey) FROM dealt) AS vendedores""")
def star_from_warehouse_totals(spark, sf_dir):
    """The warehouse's star fact: same rows and total, every salesperson served."""
    tables = star_plans.star_from_warehouse(
        samples.warehouse(spark, sf_dir), order_days(spark, sf_dir), LINE_ORDER
    )
    # one row per seller and day is all that the counts need
    per_day = materialise(tables["Fact_Ventas"].groupBy("VendedorKey", "FechaKey").agg(
        F.count(F.lit(1)).alias("n"), F.sum("LineTotal").alias("s")
    ), "per-day")
    counts = distinct_counts(per_day, {"dias_con_venta": ["FechaKey"], "vendedores": ["VendedorKey"]}, stored=True)
    totals = per_day.agg(F.sum("n"), F.sum("s")).toDF("n", "s")
    return counts.select(
        totals.select("n").scalar().alias("fact_ventas"), "dias_con_venta", money(totals.select("s").scalar(), "total"), "vendedores"
    )


_FLAT_SUMMARY_SQL = f"""WITH {LINES}
SELECT p_type AS categoria, count(*) AS rows, count(DISTINCT replace(c_name, '#', ' ')) AS clientes,
       CAST(min(d) AS VARCHAR) AS first_day, CAST(sum(l_quantity) AS BIGINT) AS order_qty,
       CAST(sum(amount) AS DOUBLE) AS total
FROM lines JOIN part ON p_partkey = l_partkey JOIN customer ON c_custkey = o_custkey GROUP BY 1"""


def _flat_summary(flat):
    return flat.groupBy(F.col("Categoria").alias("categoria")).agg(
        F.count(F.lit(1)).alias("rows"), F.count_distinct("NombreCliente").alias("clientes"),
        text(F.to_date(F.min("OrderDate")), "first_day"), F.sum("OrderQty").alias("order_qty"),
        money(F.sum("LineTotal"), "total"),
    )


@query(_FLAT_SUMMARY_SQL)
def flat_csv_round_trip(spark, sf_dir):
    """The flat table written as CSV and read back with its declared types."""
    path = Scratch(spark).folder("flat-csv")
    text_columns = [F.col(f.name).cast("string") for f in FLAT_SCHEMA.fields]
    write_text_csv(lines_as_flat(spark, sf_dir).select(*text_columns), path)
    return _flat_summary(read_flat_csv(spark, path))


@query(_FLAT_SUMMARY_SQL)
def flat_table_round_trip(spark, sf_dir):
    """The flat table written as Parquet, replaced, and read back."""
    path = Scratch(spark).folder("flat")
    write_table(lines_as_flat(spark, sf_dir), path)
    return _flat_summary(cast_columns(spark.read.schema(FLAT_SCHEMA).parquet(path), FLAT_SCHEMA))


@query(f"""WITH {LINES}, f AS (
  SELECT * FROM lines JOIN part ON p_partkey = l_partkey JOIN customer ON c_custkey = o_custkey
  JOIN nation ON n_nationkey = t)
SELECT * FROM (
  SELECT 'flat' AS "table", (SELECT count(*) FROM f) AS rows, u."column", u."values" FROM (
    SELECT 'NombreCliente' AS "column", count(DISTINCT c_name) AS "values" FROM f
    UNION ALL SELECT 'Producto', count(DISTINCT p_name) FROM f
    UNION ALL SELECT 'Territorio', count(DISTINCT n_name) FROM f
    UNION ALL SELECT 'Subcategoria', count(DISTINCT p_brand) FROM f
    UNION ALL SELECT 'Categoria', count(DISTINCT p_type) FROM f) u
  UNION ALL SELECT 'Dim_Cliente', count(*), 'NombreCliente', count(DISTINCT c_name) FROM customer
  UNION ALL SELECT 'Dim_Producto', count(*), 'Producto', count(DISTINCT p_name) FROM part
  UNION ALL SELECT 'Dim_Producto', count(*), 'Subcategoria', count(DISTINCT p_brand) FROM part
  UNION ALL SELECT 'Dim_Producto', count(*), 'Categoria', count(DISTINCT p_type) FROM part
  UNION ALL SELECT 'Dim_Territorio', count(*), 'Territorio', count(DISTINCT n_name) FROM nation)""")
def column_cardinality(spark, sf_dir):
    """Different values of the same columns in the flat table and in the dimensions."""
    t = samples.order_entry(spark, sf_dir)
    return cardinality({
        "flat": (flat_plans.flat_from_order_entry(t),
                 ["NombreCliente", "Producto", "Territorio", "Subcategoria", "Categoria"]),
        "Dim_Cliente": (star_plans.customer_dim(t), ["NombreCliente"]),
        "Dim_Producto": (star_plans.product_dim(t), ["Producto", "Subcategoria", "Categoria"]),
        "Dim_Territorio": (star_plans.territory_dim(t), ["Territorio"]),
    }, stored=frozenset({"Dim_Cliente", "Dim_Producto", "Dim_Territorio"}))


@query(f"""WITH {CAL}, x AS (
  SELECT 'orders' AS "table", 'o_orderdate' AS "column", true AS related, CAST(o_orderdate AS DATE) AS d FROM orders
  UNION ALL SELECT 'lineitem', 'l_shipdate', false, CAST(l_shipdate AS DATE) FROM lineitem
  UNION ALL SELECT 'events', 'ts', false, CAST(ts AS DATE) FROM events)
SELECT "table", "column", related, count(*) AS dated_rows, count(cal.d) AS in_calendar,
       count(DISTINCT CASE WHEN cal.d IS NULL THEN x.d END) AS unknown_days
FROM x LEFT JOIN cal ON cal.d = x.d GROUP BY 1, 2, 3""")
def date_column_coverage(spark, sf_dir):
    """How far each date column of the data is covered by the order calendar."""
    tables = {name: samples.table(spark, sf_dir, name) for name in ("orders", "lineitem", "events")}
    return date_coverage(tables, order_days(spark, sf_dir), {("orders", "o_orderdate")})


@query(f"""WITH {LINES}, f AS (SELECT p_brand AS value, count(*) AS n FROM lines JOIN part ON p_partkey = l_partkey
                               GROUP BY 1),
g AS (SELECT p_brand AS value, count(*) AS n FROM part GROUP BY 1)
SELECT value, coalesce(f.n, 0) AS flat_rows, coalesce(g.n, 0) AS dimension_rows FROM f FULL JOIN g USING (value)""")
def correction_of_subcategory(spark, sf_dir):
    """Rows to touch when a subcategory is renamed, in the flat table and in the product dimension."""
    t = samples.order_entry(spark, sf_dir)
    lines = flat_plans.flat_groups(t, ["Subcategoria"])
    return correction_impact(lines, star_plans.product_dim(t), "Subcategoria", counted="rows").select(
        "value", whole("flat_rows"), whole("dimension_rows")
    )
