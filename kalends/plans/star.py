"""The star: a fact at the grain of the flat table, its dimensions, and seller histories."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from kalends.functions.dates import date_key
from kalends.functions.scalars import full_name
from kalends.operators.calendar import OPEN_END, small_date_dim
from kalends.operators.filters import within_keys
from kalends.operators.joins import Dimension, Star, join_growing
from kalends.plans.flat import (
    Tables, deal_sellers, flatten_products, person_names, salespeople, warehouse_snowflake,
)

_PRODUCT_COLUMNS = ["ProductoKey", "Producto", "Color", "StandardCost", "ListPrice", "Subcategoria", "Categoria"]
_FACT_COLUMNS = [
    "SalesOrderNumber", "SalesOrderLineNumber", "FechaKey", "ClienteKey", "TerritorioKey", "ProductoKey",
    "VendedorKey", "OrderQty", "UnitPrice", "UnitPriceDiscount", "LineTotal",
]


def product_dim(t: Tables) -> DataFrame:
    return flatten_products(t["products"], t["subcategories"], t["categories"]).withColumnRenamed(
        "ProductID", "ProductoKey"
    ).select(*_PRODUCT_COLUMNS)


def customer_dim(t: Tables) -> DataFrame:
    names = person_names(t["people"], "PersonID", "NombreCliente")
    return t["customers"].join(names, "PersonID", "left").select(
        F.col("CustomerID").alias("ClienteKey"), "NombreCliente"
    )


def territory_dim(t: Tables) -> DataFrame:
    return t["territories"].select(
        F.col("TerritoryID").alias("TerritorioKey"), F.col("Name").alias("Territorio"),
        F.col("CountryRegionCode").alias("Pais"), *([F.col("Group").alias("Grupo")] if "Group" in
                                                    t["territories"].columns else []),
    )


def seller_dim(t: Tables) -> DataFrame:
    names = person_names(t["people"], "BusinessEntityID", "NombreVendedor")
    return t["sellers"].join(names, "BusinessEntityID", "left").select(
        F.col("BusinessEntityID").alias("VendedorKey"), "NombreVendedor", F.col("TerritoryID").alias("TerritorioKey")
    )


def sales_fact(t: Tables) -> DataFrame:
    """Order lines with the keys of their header: one row per line, no descriptive text.

    ``OrderDate`` and ``ShipDate`` stay beside the integer key for the roles they play.
    """
    joined = join_growing(t["lines"], t["headers"], "SalesOrderID").withColumn("FechaKey", date_key("OrderDate"))
    renamed = joined.withColumnsRenamed({
        "SalesOrderID": "SalesOrderNumber", "SalesOrderDetailID": "SalesOrderLineNumber",
        "CustomerID": "ClienteKey", "TerritoryID": "TerritorioKey", "ProductID": "ProductoKey",
        "SalesPersonID": "VendedorKey",
    })
    wanted = [*_FACT_COLUMNS, "OrderDate", "ShipDate"]
    return renamed.select(*[c for c in wanted if c in renamed.columns])


def order_totals(t: Tables, keep: list[str] | None = None, *, selective: bool = False) -> DataFrame:
    """Sales per order (and ``keep`` columns of its lines), with the header's columns beside them.

    For measures that can be summed this stands in for the fact. Lines are summed per order
    before they meet the headers, so the join sees every order once, however many lines it has.
    ``selective`` says that the headers are filtered: their keys then filter the lines while these are scanned.
    """
    lines = within_keys(t["lines"], "SalesOrderID", t["headers"].select("SalesOrderID")) if selective else t["lines"]
    per_order = lines.groupBy("SalesOrderID", *(keep or [])).agg(
        F.sum("LineTotal").alias("LineTotal"), F.count(F.lit(1)).alias("Lineas")
    )
    return join_growing(per_order, t["headers"], "SalesOrderID").withColumnsRenamed({
        "SalesOrderID": "SalesOrderNumber", "CustomerID": "ClienteKey", "TerritoryID": "TerritorioKey",
    })


def star_from_order_entry(t: Tables, calendar: DataFrame, dimensions: list[str] | None = None) -> Star:
    """Fact and dimensions of an order system, around a date dimension keyed by ``idFecha``.

    ``dimensions`` names the ones to set up; all of them when not given.
    """
    plans = {
        "Fecha": lambda: Dimension(calendar, "idFecha", "FechaKey", bounded=True),
        "Dim_Producto": lambda: Dimension(product_dim(t), "ProductoKey", "ProductoKey", counted=t["products"]),
        "Dim_Cliente": lambda: Dimension(customer_dim(t), "ClienteKey", "ClienteKey", counted=t["customers"]),
        "Dim_Territorio": lambda: Dimension(territory_dim(t), "TerritorioKey", "TerritorioKey", counted=t["territories"]),
        # The seller's own territory must not be taken for the sale's.
        "Dim_Vendedor": lambda: Dimension(
            seller_dim(t).drop("TerritorioKey"), "VendedorKey", "VendedorKey", counted=t["sellers"]
        ),
    }
    # Every fact row has its header's customer: the headers can be asked instead of the lines.
    keys = {"ClienteKey": t["headers"].select(F.col("CustomerID").alias("ClienteKey"))}
    return Star(sales_fact(t), {name: plans[name]() for name in dimensions or plans}, key_sources=keys)


def star_from_warehouse(
    t: Tables, days: DataFrame, order_by: list[str] | None = None, *,
    default_territory: int | None = None, dealt: DataFrame | None = None,
) -> Tables:
    """The star's tables from a warehouse, with sellers dealt to the lines in turn.

    ``dealt`` are lines that already have their seller (``deal_sellers``), so that other models can share them. Salespeople
    without a territory get ``default_territory``.
    """
    lines = (deal_sellers(t, order_by) if dealt is None else dealt).withColumn("FechaKey", date_key("OrderDate"))
    fact = lines.withColumnsRenamed({
        "CustomerKey": "ClienteKey", "SalesTerritoryKey": "TerritorioKey", "ProductKey": "ProductoKey",
        "OrderQuantity": "OrderQty", "UnitPriceDiscountPct": "UnitPriceDiscount", "SalesAmount": "LineTotal",
    }).select(*_FACT_COLUMNS)
    sellers = salespeople(t["employees"], default_territory=default_territory)
    return {
        "Fact_Ventas": fact,
        "Dim_Fecha": small_date_dim(days),
        "Dim_Producto": flatten_products(*warehouse_snowflake(t)).withColumnRenamed("ProductID", "ProductoKey")
        .select(*_PRODUCT_COLUMNS),
        "Dim_Cliente": t["customers"].select(
            F.col("CustomerKey").alias("ClienteKey"),
            full_name("FirstName", "LastName", null_as_empty=True).alias("NombreCliente"),
        ),
        "Dim_Territorio": t["territories"].select(
            F.col("SalesTerritoryKey").alias("TerritorioKey"), F.col("SalesTerritoryRegion").alias("Territorio"),
            F.col("SalesTerritoryCountry").alias("Pais"), F.col("SalesTerritoryGroup").alias("Grupo"),
        ),
        "Dim_Vendedor": sellers,
        "Dim_Vendedor_Historial": seller_history(sellers),
    }


def distinct_dim(flat: DataFrame, key: str, attributes: list[str], new_key: str) -> DataFrame:
    """A dimension as the distinct rows of some flat columns.

    A key with two different attribute values comes out twice; ``keyed_dim`` does not do that.
    """
    return flat.select(key, *attributes).distinct().withColumnRenamed(key, new_key)


def keyed_dim(flat: DataFrame, key: str, attributes: list[str], new_key: str) -> DataFrame:
    """A dimension with one row per key: the largest value of each attribute."""
    return flat.groupBy(F.col(key).alias(new_key)).agg(*[F.max(a).alias(a) for a in attributes])


def star_from_flat(flat: DataFrame, *, unique_sellers: bool = False) -> Tables:
    """Every dimension and the fact, derived from the flat table alone.

    Each of them reads its own few columns of ``flat``, so that should be a stored table.
    Sellers seen in several territories give several rows unless ``unique_sellers``.
    """
    build_sellers = keyed_dim if unique_sellers else distinct_dim
    sellers = build_sellers(flat, "VendedorID", ["NombreVendedor", "TerritorioID"], "VendedorKey").withColumnRenamed(
        "TerritorioID", "TerritorioKey"
    )
    fact = flat.withColumnsRenamed({
        "ClienteID": "ClienteKey", "TerritorioID": "TerritorioKey", "ProductoID": "ProductoKey",
        "VendedorID": "VendedorKey",
    }).withColumn("FechaKey", date_key("OrderDate")).select(*_FACT_COLUMNS)
    return {
        "Fact_Ventas": fact,
        "Dim_Producto": distinct_dim(flat, "ProductoID", _PRODUCT_COLUMNS[1:], "ProductoKey"),
        "Dim_Cliente": distinct_dim(flat, "ClienteID", ["NombreCliente"], "ClienteKey"),
        "Dim_Territorio": distinct_dim(flat, "TerritorioID", ["Territorio", "Pais"], "TerritorioKey"),
        "Dim_Vendedor": sellers,
        "Dim_Vendedor_Historial": seller_history(sellers),
    }


def seller_history(
    sellers: DataFrame,
    *,
    opened: dt.date = dt.date(2005, 1, 1),
    changed: dt.date = dt.date(2016, 1, 1),
    first_territory: int = 1,
) -> DataFrame:
    """Two periods per seller: ``first_territory`` until the day before ``changed``, then their own.

    The second period is open: it ends on 9999-12-31.
    """
    def period(territory, first: dt.date, last: dt.date) -> DataFrame:
        return sellers.select(
            "VendedorKey", "NombreVendedor", territory.cast("long").alias("TerritorioKey"),
            F.lit(first).alias("Desde"), F.lit(last).alias("Hasta"),
        )

    before = period(F.lit(first_territory), opened, changed - dt.timedelta(days=1))
    return before.unionByName(period(F.col("TerritorioKey"), changed, OPEN_END))


def seller_periods(fact: DataFrame, *, open_days: int = 90) -> DataFrame:
    """When each seller sold in each territory: a row per seller and territory, from the first to the last order date.

    A period that ends less than ``open_days`` before the last order of all is still open and ends on 9999-12-31. One
    aggregate over the fact; the last order of all is read off its result.
    """
    day = F.to_date("OrderDate")
    spans = fact.groupBy("VendedorKey", "TerritorioKey").agg(F.min(day).alias("Desde"), F.max(day).alias("_last"))
    latest = spans.agg(F.max("_last")).scalar()
    closed = F.col("_last") < F.date_sub(latest, open_days)
    return spans.withColumn("Hasta", F.when(closed, F.col("_last")).otherwise(F.lit(OPEN_END))).drop("_last")
