"""The test tables, seen as the two kinds of source database the models are built from.

``order_entry`` looks like a normalised order system (lines, headers, customers and
sellers as people, a product snowflake); ``warehouse`` like an existing warehouse whose
sales fact has no seller. Both are projections: nothing is computed until a model
selects it, and columns a query does not use are not read.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from kalends.operators.joins import join_growing
from kalends.sources.readers import MONEY, read_parquet

_TABLES = {
    "lineitem": "l_orderkey long, l_partkey long, l_suppkey long, l_linenumber long, l_quantity double, "
                "l_extendedprice double, l_discount double, l_tax double, l_returnflag string, "
                "l_linestatus string, l_shipdate timestamp_ntz",
    "orders": "o_orderkey long, o_custkey long, o_orderstatus string, o_totalprice double, "
              "o_orderdate timestamp_ntz, o_orderpriority string",
    "customer": "c_custkey long, c_name string, c_nationkey long, c_acctbal double, c_mktsegment string",
    "supplier": "s_suppkey long, s_name string, s_nationkey long, s_acctbal double",
    "part": "p_partkey long, p_name string, p_brand string, p_type string, p_size long, p_retailprice double",
    "nation": "n_nationkey long, n_name string, n_regionkey long",
    "region": "r_regionkey long, r_name string",
    "events": "event_id long, ts timestamp_ntz, user_id long, event_type string, value double, props string",
}


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return read_parquet(spark, f"{sf_dir}/{name}.parquet", T.StructType.fromDDL(_TABLES[name]))


def line_amounts() -> dict:
    """Quantity and money of a line, from the columns that ``bare_lines`` has of it."""
    price = F.col("l_extendedprice").cast("decimal(15,2)")
    return {
        "OrderQty": F.col("l_quantity").cast("long"),
        "UnitPrice": F.try_divide(price, F.col("l_quantity").cast("decimal(10,0)")).cast(MONEY),
        "UnitPriceDiscount": F.col("l_discount"),
        "LineTotal": (price * (F.lit(1) - F.col("l_discount").cast("decimal(4,2)"))).cast(MONEY),
    }


def bare_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The order lines with the columns that ``line_amounts`` are computed from. Those take less room than the amounts."""
    return table(spark, sf_dir, "lineitem").select(
        F.col("l_orderkey").alias("SalesOrderID"),
        F.col("l_linenumber").alias("SalesOrderDetailID"),
        F.col("l_partkey").alias("ProductID"),
        F.col("l_suppkey").alias("SalesPersonID"),
        F.col("l_shipdate").alias("ShipDate"),
        "l_quantity", "l_extendedprice", "l_discount",
    )


def order_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    lines = bare_lines(spark, sf_dir).withColumns(line_amounts())
    return lines.drop("l_quantity", "l_extendedprice", "l_discount")


def order_headers(spark: SparkSession, sf_dir: str, *, territory: bool = True) -> DataFrame:
    """One row per order. The territory is the customer's nation; leave it out to spare the join."""
    headers = table(spark, sf_dir, "orders").select(
        F.col("o_orderkey").alias("SalesOrderID"),
        F.col("o_orderdate").alias("OrderDate"),
        F.col("o_orderstatus").alias("Status"),
        F.col("o_custkey").alias("CustomerID"),
    )
    if not territory:
        return headers
    homes = table(spark, sf_dir, "customer").select(
        F.col("c_custkey").alias("CustomerID"), F.col("c_nationkey").alias("TerritoryID")
    )
    return headers.join(homes, "CustomerID", "left")


def _named_people(df: DataFrame, key, name: str) -> DataFrame:
    return df.select(
        key.alias("BusinessEntityID"),
        F.substring_index(name, "#", 1).alias("FirstName"),
        F.substring_index(name, "#", -1).alias("LastName"),
    )


class OnDemand(dict):
    """Tables by name, each planned when it is first asked for."""

    def __init__(self, plans: dict[str, Callable[[], DataFrame]]):
        super().__init__()
        self._plans = plans

    def __missing__(self, name: str) -> DataFrame:
        self[name] = self._plans[name]()
        return self[name]


def order_entry(spark: SparkSession, sf_dir: str, *, territory: bool = True, amounts: bool = True) -> dict[str, DataFrame]:
    """The tables of an order system. Customers are people 0, 1, ...; sellers are people -1, -2, ...

    Without ``amounts`` the lines are ``bare_lines``, for plans that compute ``line_amounts`` themselves.
    """
    lines = order_lines if amounts else bare_lines
    def source(name: str) -> DataFrame:
        return table(spark, sf_dir, name)

    customer, seller, subcategory = F.col("c_custkey"), -1 - F.col("s_suppkey"), F.concat_ws("/", "p_type", "p_brand")
    return OnDemand({
        "lines": lambda: lines(spark, sf_dir).withColumn("SalesPersonID", -1 - F.col("SalesPersonID")),
        "headers": lambda: order_headers(spark, sf_dir, territory=territory),
        "customers": lambda: source("customer").select(customer.alias("CustomerID"), customer.alias("PersonID")),
        "people": lambda: _named_people(source("customer"), customer, "c_name").unionByName(
            _named_people(source("supplier"), seller, "s_name")
        ),
        "sellers": lambda: source("supplier").select(
            seller.alias("BusinessEntityID"), F.col("s_nationkey").alias("TerritoryID")
        ),
        "territories": lambda: source("nation").join(
            source("region"), F.col("n_regionkey") == F.col("r_regionkey"), "left"
        ).select(
            F.col("n_nationkey").alias("TerritoryID"), F.col("n_name").alias("Name"),
            F.col("n_name").alias("CountryRegionCode"), F.col("r_name").alias("Group"),
        ),
        "products": lambda: source("part").select(
            F.col("p_partkey").alias("ProductID"), F.col("p_name").alias("Name"),
            F.lit(None).cast("string").alias("Color"), F.lit(None).cast(MONEY).alias("StandardCost"),
            F.col("p_retailprice").cast(MONEY).alias("ListPrice"), subcategory.alias("ProductSubcategoryID"),
        ),
        "subcategories": lambda: source("part").select(
            subcategory.alias("ProductSubcategoryID"), F.col("p_brand").alias("Name"),
            F.col("p_type").alias("ProductCategoryID"),
        ).distinct(),
        "categories": lambda: source("part").select(
            F.col("p_type").alias("ProductCategoryID"), F.col("p_type").alias("Name")
        ).distinct(),
    })


def warehouse(spark: SparkSession, sf_dir: str) -> dict[str, DataFrame]:
    """The tables of an existing warehouse: a sales fact without sellers, and its dimensions."""
    entry = order_entry(spark, sf_dir)
    return OnDemand({
        "sales": lambda: join_growing(bare_lines(spark, sf_dir), entry["headers"], "SalesOrderID").withColumns(line_amounts()).select(
            F.col("SalesOrderID").alias("SalesOrderNumber"), F.col("SalesOrderDetailID").alias("SalesOrderLineNumber"),
            "OrderDate", F.lit(None).cast("timestamp_ntz").alias("DueDate"), "ShipDate",
            F.col("CustomerID").alias("CustomerKey"), F.col("TerritoryID").alias("SalesTerritoryKey"),
            F.col("ProductID").alias("ProductKey"), F.col("OrderQty").alias("OrderQuantity"), "UnitPrice",
            F.col("UnitPriceDiscount").alias("UnitPriceDiscountPct"), F.col("LineTotal").alias("SalesAmount"),
        ),
        "customers": lambda: _named_people(table(spark, sf_dir, "customer"), F.col("c_custkey"), "c_name")
        .withColumnRenamed("BusinessEntityID", "CustomerKey"),
        "employees": lambda: table(spark, sf_dir, "supplier").select(
            F.col("s_suppkey").alias("EmployeeKey"),
            F.substring_index("s_name", "#", 1).alias("FirstName"),
            F.substring_index("s_name", "#", -1).alias("LastName"),
            F.col("s_nationkey").alias("SalesTerritoryKey"),
            (F.col("s_acctbal") > 0).cast("int").alias("SalesPersonFlag"),
        ),
        "territories": lambda: entry["territories"].withColumnsRenamed({
            "TerritoryID": "SalesTerritoryKey", "Name": "SalesTerritoryRegion",
            "CountryRegionCode": "SalesTerritoryCountry", "Group": "SalesTerritoryGroup",
        }),
        "products": lambda: entry["products"].withColumnsRenamed({
            "ProductID": "ProductKey", "Name": "EnglishProductName", "ProductSubcategoryID": "ProductSubcategoryKey",
        }),
        "subcategories": lambda: entry["subcategories"].withColumnsRenamed({
            "ProductSubcategoryID": "ProductSubcategoryKey", "Name": "EnglishProductSubcategoryName",
            "ProductCategoryID": "ProductCategoryKey",
        }),
        "categories": lambda: entry["categories"].withColumnsRenamed({
            "ProductCategoryID": "ProductCategoryKey", "Name": "EnglishProductCategoryName",
        }),
    })
