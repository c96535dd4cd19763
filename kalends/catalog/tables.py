"""Queries about where tables come from and go to: checked files, replaced tables, sources by name, shared dealings."""

from __future__ import annotations

import hashlib

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from kalends.catalog.calendars import order_days
from kalends.catalog.models import LINE_ORDER, _DEALT, lines_as_flat
from kalends.catalog.registry import LINES, money, query, whole
from kalends.operators.joins import Dimension, Star
from kalends.operators.measures import evaluate
from kalends.plans import flat as flat_plans
from kalends.plans import star as star_plans
from kalends.sources import samples
from kalends.sources.checked import accepted_rows, read_checked_csv, rejected_rows
from kalends.sources.names import Names
from kalends.sources.readers import FLAT_SCHEMA
from kalends.sources.sinks import write_text_csv
from kalends.sources.versions import VersionedTable
from kalends.storage import Scratch, materialise


# Which lines get a bad value: column -> (divisor and remainder of the order's key, the value, the reason).
_PLANTED = {
    "OrderQty": (97, 1, "three", "not a whole number"), "ClienteID": (89, 2, "99999999999999999999", "too large for the column"),
    "OrderDate": (83, 3, "2011-02-31", "not a date or time"), "UnitPriceDiscount": (79, 4, "10%", "not a number"),
    "LineTotal": (73, 5, "1234567890123456789", "too large for the column"),
}
_HIT = " OR ".join(f"l_orderkey % {d} = {r}" for d, r, *_ in _PLANTED.values())


@query(" UNION ALL ".join(
    f"SELECT '{c}' AS \"column\", '{reason}' AS reason, '{value}' AS value, count(*) AS rows FROM lineitem WHERE l_orderkey % {d} = {r}"
    for c, (d, r, value, reason) in _PLANTED.items()
) + f" UNION ALL SELECT 'accepted', '', '', count(*) FROM lineitem WHERE NOT ({_HIT})"
    f" UNION ALL SELECT 'rejected lines', '', '', count(*) FROM lineitem WHERE {_HIT}")
def flat_csv_rejects(spark, sf_dir):
    """A flat file with planted bad values: what is rejected and why, and what is accepted."""
    path = Scratch(spark).folder("checked-csv")
    key = F.col("SalesOrderNumber").cast("long")
    spoiled = [
        F.when(key % _PLANTED[f.name][0] == _PLANTED[f.name][1], _PLANTED[f.name][2]).otherwise(F.col(f.name).cast("string")).alias(f.name)
        if f.name in _PLANTED else F.col(f.name).cast("string")
        for f in FLAT_SCHEMA.fields
    ]
    write_text_csv(lines_as_flat(spark, sf_dir).select(*spoiled), path)
    checked = read_checked_csv(spark, path, FLAT_SCHEMA)
    rejects = materialise(rejected_rows(checked, path), "rejects")
    per_reason = rejects.groupBy("column", "reason", "value").agg(F.count(F.lit(1)).alias("rows"))

    def counted(name: str, df: DataFrame) -> DataFrame:
        return df.agg(F.count(F.lit(1)).alias("rows")).select(F.lit(name).alias("column"), F.lit("").alias("reason"), F.lit("").alias("value"), "rows")

    return per_reason.unionByName(counted("accepted", accepted_rows(checked))).unionByName(
        counted("rejected lines", rejects.select("file", "line").distinct())
    )


@query("""WITH v AS (SELECT year(o_orderdate) AS y, o_orderpriority AS p, count(*) AS n, CAST(sum(CAST(o_totalprice AS DECIMAL(15,2))) AS DOUBLE) AS s
           FROM orders GROUP BY 1, 2),
a AS (SELECT y, sum(n) AS n FROM v GROUP BY 1)
SELECT 1 AS version, y AS year, '' AS priority, CAST(n AS BIGINT) AS orders, CAST(NULL AS DOUBLE) AS total FROM a WHERE y < 2000
UNION ALL SELECT 2, y, '', CAST(n AS BIGINT), NULL FROM a
UNION ALL SELECT 3, y, p, n, s FROM v""")
def versioned_orders(spark, sf_dir):
    """A table written, appended to, and replaced by one with other columns; all three versions can still be read."""
    per = samples.table(spark, sf_dir, "orders").groupBy(F.year("o_orderdate").alias("year"), F.col("o_orderpriority").alias("priority")).agg(
        F.count(F.lit(1)).alias("orders"), F.sum(F.col("o_totalprice").cast("decimal(15,2)")).alias("total")
    )
    years = per.groupBy("year").agg(F.sum("orders").alias("orders"))
    table = VersionedTable(spark, Scratch(spark).folder("versioned"))
    table.write(years.where("year < 2000"))
    table.write(years.where("year >= 2000"), mode="append")
    table.write(per, overwrite_schema=True)
    read = [table.read(n).select(F.lit(n).alias("version"), "*") for n in table.versions()]
    stacked = read[0].unionByName(read[1], allowMissingColumns=True).unionByName(read[2], allowMissingColumns=True)
    return stacked.select(
        "version", whole("year"), F.coalesce("priority", F.lit("")).alias("priority"), whole("orders"), money("total")
    )


# The names that a model uses for its sources, the test table behind each, and the columns it declares.
_NAMED = {
    "Ventas.dbo.Detalle": ("lineitem", "l_orderkey long, l_partkey long, l_suppkey long, l_extendedprice double, l_discount double"),
    "Ventas.dbo.Cabecera": ("orders", "o_orderkey long, o_custkey long, o_orderdate timestamp_ntz"),
    "Ventas.dbo.Cliente": ("customer", "c_custkey long, c_nationkey long"),
    "Maestro.Territorio": ("nation", "n_nationkey long, n_name string, n_regionkey long"),
    "Maestro.Grupo": ("region", "r_regionkey long, r_name string"),
}


def named_sources(spark: SparkSession, sf_dir: str) -> Names:
    """The test tables as catalog tables of two databases, reached through the names of a model."""
    mark = hashlib.sha256(sf_dir.encode()).hexdigest()[:12]
    places = {"Ventas.dbo": f"ventas_{mark}", "Maestro": f"maestro_{mark}"}
    for database in places.values():
        spark.sql(f"CREATE DATABASE IF NOT EXISTS {database}")
    names = Names(spark, places, {name: columns for name, (_, columns) in _NAMED.items()})
    for name, (table, _) in _NAMED.items():
        spark.sql(f"CREATE TABLE IF NOT EXISTS {names.located(name)} USING parquet LOCATION '{sf_dir}/{table}.parquet'")
    return names


@query(f"""WITH {LINES} SELECT r_name AS grupo, n_name AS territorio, CAST(sum(amount) AS DOUBLE) AS sales, count(DISTINCT l_orderkey) AS orders
FROM lines LEFT JOIN nation ON n_nationkey = t LEFT JOIN region ON r_regionkey = n_regionkey GROUP BY 1, 2""")
def star_from_names(spark, sf_dir):
    """A star whose every table is read by its two- or three-part name, with its declared columns."""
    sources = named_sources(spark, sf_dir)
    price = F.col("l_extendedprice").cast("decimal(15,2)")
    t = {
        "lines": sources.table("Ventas.dbo.Detalle").select(
            F.col("l_orderkey").alias("SalesOrderID"), F.col("l_partkey").alias("ProductID"), F.col("l_suppkey").alias("SalesPersonID"),
            (price * (F.lit(1) - F.col("l_discount").cast("decimal(4,2)"))).cast("decimal(19,4)").alias("LineTotal"),
        ),
        "headers": sources.table("Ventas.dbo.Cabecera").join(sources.table("Ventas.dbo.Cliente"), F.col("c_custkey") == F.col("o_custkey"), "left").select(
            F.col("o_orderkey").alias("SalesOrderID"), F.col("o_custkey").alias("CustomerID"), F.col("o_orderdate").alias("OrderDate"),
            F.col("c_nationkey").alias("TerritoryID"),
        ),
        "territories": sources.table("Maestro.Territorio").join(
            sources.table("Maestro.Grupo"), F.col("n_regionkey") == F.col("r_regionkey"), "left"
        ).select(
            F.col("n_nationkey").alias("TerritoryID"), F.col("n_name").alias("Name"), F.col("n_name").alias("CountryRegionCode"),
            F.col("r_name").alias("Group"),
        ),
    }
    star = Star(star_plans.sales_fact(t), {"Dim_Territorio": Dimension(star_plans.territory_dim(t), "TerritorioKey", "TerritorioKey")})
    return evaluate(star, ["Grupo", "Territorio"], ["sales", "orders"]).select(
        F.col("Grupo").alias("grupo"), F.col("Territorio").alias("territorio"), money("sales"), whole("orders")
    )


@query(f"""WITH {_DEALT}
SELECT model, s_suppkey AS vendedor_key, count(*) AS rows, CAST(sum(amount) AS DOUBLE) AS total
FROM dealt, (SELECT unnest(['flat', 'star']) AS model) GROUP BY 1, 2""")
def models_of_one_dealing(spark, sf_dir):
    """Flat table and star of a warehouse whose lines got their sellers once: every seller has the same lines in both."""
    t = samples.warehouse(spark, sf_dir)
    dealt = flat_plans.deal_sellers(t, LINE_ORDER)
    flat = flat_plans.flat_from_warehouse(t, LINE_ORDER, dealt=dealt)
    star = star_plans.star_from_warehouse(t, order_days(spark, sf_dir), LINE_ORDER, dealt=dealt)["Fact_Ventas"]
    per = [
        df.groupBy(F.lit(name).alias("model"), whole(key, "vendedor_key")).agg(F.count(F.lit(1)).alias("rows"), money(F.sum("LineTotal"), "total"))
        for name, df, key in (("flat", flat, "VendedorID"), ("star", star, "VendedorKey"))
    ]
    return per[0].unionByName(per[1])


@query("""SELECT s_suppkey AS vendedor_key, replace(s_name, '#', ' ') AS nombre_vendedor,
       CAST(CASE WHEN s_acctbal > 5000 THEN 11 ELSE s_nationkey END AS BIGINT) AS territorio_key FROM supplier WHERE s_acctbal > 0""")
def dim_seller_default_territory(spark, sf_dir):
    """The salespeople of a warehouse in which some have no territory, which puts these in a default one."""
    t = samples.warehouse(spark, sf_dir)
    missing = samples.table(spark, sf_dir, "supplier").where("s_acctbal > 5000").select(F.col("s_suppkey").alias("EmployeeKey"))
    marked = t["employees"].join(missing.withColumn("_missing", F.lit(True)), "EmployeeKey", "left")
    t["employees"] = marked.withColumn("SalesTerritoryKey", F.when(F.col("_missing").isNull(), F.col("SalesTerritoryKey"))).drop("_missing")
    star = star_plans.star_from_warehouse(t, order_days(spark, sf_dir), LINE_ORDER, default_territory=11, dealt=t["sales"].withColumn("VendedorKey", F.lit(0)))
    return star["Dim_Vendedor"].select(
        whole("VendedorKey", "vendedor_key"), F.col("NombreVendedor").alias("nombre_vendedor"), whole("TerritorioKey", "territorio_key")
    )
