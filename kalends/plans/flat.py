"""The wide table: one row per order line, with all of its context repeated."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from kalends.functions.scalars import full_name
from kalends.operators.joins import broadcast_if_small, is_small, join_growing
from kalends.operators.numbering import assign_round_robin

Tables = dict[str, DataFrame]


def person_names(people: DataFrame, key: str, name: str, *, null_as_empty: bool = False) -> DataFrame:
    return people.select(
        F.col("BusinessEntityID").alias(key),
        full_name("FirstName", "LastName", null_as_empty=null_as_empty).alias(name),
    )


def flatten_products(products: DataFrame, subcategories: DataFrame, categories: DataFrame) -> DataFrame:
    """The product snowflake as one table; a product without subcategory or category is kept."""
    arm = (
        subcategories.select("ProductSubcategoryID", "ProductCategoryID", F.col("Name").alias("Subcategoria"))
        .join(categories.select("ProductCategoryID", F.col("Name").alias("Categoria")), "ProductCategoryID", "left")
        .drop("ProductCategoryID")
    )
    return products.withColumnRenamed("Name", "Producto").join(arm, "ProductSubcategoryID", "left").drop(
        "ProductSubcategoryID"
    )


def flat_from_order_entry(t: Tables, computed: dict[str, Column] | None = None) -> DataFrame:
    """The flat table of an order system.

    People are joined in two roles, as customers and as sellers. Everything that belongs to
    an order is joined to the headers and the snowflake is flattened first, so the line
    table, by far the largest, is joined only three times: with headers, products and sellers.
    The headers come first: that join always shuffles, and then moves the bare lines. Products come
    next and may shuffle the lines again, with what the headers brought; sides that are broadcast add
    their columns after that, the territories too if they are few. ``computed`` are columns that follow
    from others of the line; they are added last, so that only what they follow from is moved.
    """
    buyers = t["customers"].select("CustomerID", "PersonID").join(
        t["people"].select(F.col("BusinessEntityID").alias("PersonID"), "FirstName", "LastName"), "PersonID", "left"
    ).withColumn("NombreCliente", full_name("FirstName", "LastName"))
    territories = t["territories"].select("TerritoryID", F.col("Name").alias("Territorio"), "CountryRegionCode")
    few_territories = is_small(t["territories"])
    orders = t["headers"].join(buyers, "CustomerID")
    if not few_territories:
        orders = orders.join(territories, "TerritoryID")
    products = flatten_products(t["products"], t["subcategories"], t["categories"])
    # People grow with the customers, sellers do not: only those who can match are kept and counted.
    selling = t["sellers"].select(F.col("BusinessEntityID")).distinct() if "sellers" in t else (
        t["lines" if "SalesPersonID" in t["lines"].columns else "headers"]
        .select(F.col("SalesPersonID").alias("BusinessEntityID")).distinct()
    )
    sellers = person_names(t["people"].join(selling, "BusinessEntityID", "left_semi"), "SalesPersonID", "NombreVendedor")
    lines = join_growing(t["lines"], orders, "SalesOrderID").join(broadcast_if_small(products, t["products"]), "ProductID")
    if few_territories:
        lines = lines.join(F.broadcast(territories), "TerritoryID")
    return (
        lines.join(broadcast_if_small(sellers, selling, narrow=True), "SalesPersonID", "left").withColumns(computed or {})
        .select(
            "SalesOrderID", "SalesOrderDetailID", "OrderDate",
            *[c for c in ("DueDate", "ShipDate") if c in t["headers"].columns + t["lines"].columns],
            F.col("Status").alias("EstadoPedido"),
            "CustomerID", "FirstName", "LastName", "NombreCliente",
            "TerritoryID", "Territorio", "CountryRegionCode",
            "ProductID", "Producto", "Color", "StandardCost", "ListPrice", "Subcategoria", "Categoria",
            F.col("SalesPersonID").alias("VendedorID"), "NombreVendedor",
            "OrderQty", "UnitPrice", "UnitPriceDiscount", "LineTotal",
        )
    )


# Columns of the wide table that follow from a key of the line or its order.
_FOLLOWS = {
    "SalesPersonID": ["VendedorID", "NombreVendedor"],
    "CustomerID": ["CustomerID", "FirstName", "LastName", "NombreCliente"],
    "TerritoryID": ["TerritoryID", "Territorio", "CountryRegionCode"],
    "ProductID": ["ProductID", "Producto", "Color", "StandardCost", "ListPrice", "Subcategoria", "Categoria"],
}


def flat_groups(t: Tables, columns: list[str]) -> DataFrame:
    """The combinations of some descriptive columns in the flat table, and the ``rows`` of each; the table is not built.

    Lines are counted per key first: only the dimensions that own one of the columns are joined, to one row per combination
    of keys. Lines that the flat table leaves out, for want of a customer, territory or product, are left out here.
    Dimension keys must be unique.
    """
    key_of = {c: key for key, owned in _FOLLOWS.items() for c in owned}
    unknown = [c for c in columns if c not in key_of]
    if unknown:
        raise ValueError(f"{unknown} do not follow from a key; there are {sorted(key_of)}")
    keys = list(dict.fromkeys(key_of[c] for c in columns))
    orders = t["headers"].join(t["customers"].select("CustomerID"), "CustomerID", "left_semi").join(
        broadcast_if_small(t["territories"].select("TerritoryID")), "TerritoryID", "left_semi"
    )
    lines = t["lines"].join(broadcast_if_small(t["products"].select("ProductID")), "ProductID", "left_semi")
    of_line = [k for k in keys if k in t["lines"].columns]
    of_order = [k for k in keys if k not in of_line]
    grouped = join_growing(
        lines.select("SalesOrderID", *of_line), orders.select("SalesOrderID", *of_order), "SalesOrderID"
    ).groupBy(*keys).agg(F.count(F.lit(1)).alias("rows"))
    sides = {
        "SalesPersonID": lambda: person_names(t["people"], "SalesPersonID", "NombreVendedor").withColumn("VendedorID", F.col("SalesPersonID")),
        "CustomerID": lambda: t["customers"].join(
            t["people"].select(F.col("BusinessEntityID").alias("PersonID"), "FirstName", "LastName"), "PersonID", "left"
        ).withColumn("NombreCliente", full_name("FirstName", "LastName")),
        "TerritoryID": lambda: t["territories"].withColumnRenamed("Name", "Territorio"),
        "ProductID": lambda: flatten_products(t["products"], t["subcategories"], t["categories"]),
    }
    for key in keys:
        owned = [c for c in columns if key_of[c] == key and c not in (key, "VendedorID")]
        if owned:
            grouped = grouped.join(sides[key]().select(key, *owned), key, "left")
    if "VendedorID" in columns:
        grouped = grouped.withColumn("VendedorID", F.col("SalesPersonID"))
    return grouped.groupBy(*columns).agg(F.sum("rows").alias("rows"))


def salespeople(employees: DataFrame, *, default_territory: int | None = None) -> DataFrame:
    """One row per salesperson with name and highest territory key."""
    territory = F.max("SalesTerritoryKey")
    if default_territory is not None:
        territory = F.coalesce(territory, F.lit(default_territory))
    return (
        employees.filter("SalesPersonFlag = 1")
        .groupBy(
            F.col("EmployeeKey").alias("VendedorKey"),
            full_name("FirstName", "LastName", null_as_empty=True).alias("NombreVendedor"),
        )
        .agg(territory.alias("TerritorioKey"))
    )


def sales_with_sellers(sales: DataFrame, employees: DataFrame, order_by: list[str] | None = None) -> DataFrame:
    """The sales lines with a seller dealt to each in turn, by order and line number.

    Give ``order_by`` where order and line number do not tell all lines apart.
    """
    order_by = order_by or ["SalesOrderNumber", "SalesOrderLineNumber"]
    return assign_round_robin(sales, order_by, salespeople(employees), "VendedorKey", "VendedorKey")


def deal_sellers(t: Tables, order_by: list[str] | None = None) -> DataFrame:
    """A warehouse's lines with their dealt sellers, for the flat table and the star alike.

    The numbered lines are stored once; every model that is given this result reads them from there.
    """
    return sales_with_sellers(t["sales"], t["employees"], order_by)


def flat_from_warehouse(t: Tables, order_by: list[str] | None = None, *, dealt: DataFrame | None = None) -> DataFrame:
    """The 23-column flat table of a warehouse whose fact has no seller; ``dealt`` as in ``star_from_warehouse``."""
    customers = t["customers"].select(
        F.col("CustomerKey").alias("ClienteID"),
        full_name("FirstName", "LastName", null_as_empty=True).alias("NombreCliente"),
    )
    territories = t["territories"].select(
        F.col("SalesTerritoryKey").alias("TerritorioID"), F.col("SalesTerritoryRegion").alias("Territorio"),
        F.col("SalesTerritoryCountry").alias("Pais"),
    )
    products = flatten_products(*warehouse_snowflake(t)).withColumnRenamed("ProductID", "ProductoID")
    sellers = t["employees"].select(
        F.col("EmployeeKey").alias("VendedorID"),
        full_name("FirstName", "LastName", null_as_empty=True).alias("NombreVendedor"),
    )
    lines = (deal_sellers(t, order_by) if dealt is None else dealt).withColumnsRenamed({
        "CustomerKey": "ClienteID", "SalesTerritoryKey": "TerritorioID", "ProductKey": "ProductoID",
        "VendedorKey": "VendedorID", "OrderQuantity": "OrderQty", "UnitPriceDiscountPct": "UnitPriceDiscount",
        "SalesAmount": "LineTotal",
    })
    return (
        lines.join(broadcast_if_small(customers), "ClienteID")
        .join(broadcast_if_small(products, t["products"]), "ProductoID")
        .join(broadcast_if_small(territories), "TerritorioID")
        .join(broadcast_if_small(sellers, narrow=True), "VendedorID")
        .select(
            "SalesOrderNumber", "SalesOrderLineNumber", "OrderDate", "DueDate", "ShipDate", "ClienteID",
            "NombreCliente", "TerritorioID", "Territorio", "Pais", "ProductoID", "Producto", "Color",
            "StandardCost", "ListPrice", "Subcategoria", "Categoria", "VendedorID", "NombreVendedor",
            "OrderQty", "UnitPrice", "UnitPriceDiscount", "LineTotal",
        )
    )


def warehouse_snowflake(t: Tables) -> tuple[DataFrame, DataFrame, DataFrame]:
    """The warehouse's product tables under the column names of the order system."""
    return (
        t["products"].withColumnsRenamed({
            "ProductKey": "ProductID", "EnglishProductName": "Name", "ProductSubcategoryKey": "ProductSubcategoryID",
        }),
        t["subcategories"].withColumnsRenamed({
            "ProductSubcategoryKey": "ProductSubcategoryID", "EnglishProductSubcategoryName": "Name",
            "ProductCategoryKey": "ProductCategoryID",
        }),
        t["categories"].withColumnsRenamed({
            "ProductCategoryKey": "ProductCategoryID", "EnglishProductCategoryName": "Name",
        }),
    )
