"""Building flat tables, stars and histories from small hand-made databases, and checking them."""

from __future__ import annotations

import datetime as dt
from decimal import Decimal

import pytest
from pyspark.sql import functions as F

from kalends.functions.scalars import bucket_of, full_name, safe_div
from kalends.operators.calendar import date_dim, date_range
from kalends.operators.joins import (
    BROADCAST_ROWS, DateRole, Dimension, active_role, broadcast_if_small, by_role, dim_with_history,
    join_history_naive, join_on_date,
)
from kalends.operators.numbering import assign_round_robin, global_row_number
from kalends.operators.quality import (
    cardinality, correction_impact, date_columns, date_coverage, duplicate_keys, fanout_audit, reconcile, repetition,
    row_counts, unrelated_date_columns,
)
from kalends.plans import flat as flat_plans
from kalends.plans import star as star_plans

DAY = dt.datetime(2012, 2, 29, 13, 30)


@pytest.fixture(scope="module")
def entry(spark):
    """Two orders with three lines; a buyer without a last name; a seller only on one order."""
    make = spark.createDataFrame
    return {
        "lines": make([(1, 1, 10, 2, 5.0, 0.0, Decimal(10)), (1, 2, 11, 1, 7.0, 0.5, Decimal("3.5")),
                       (2, 3, 10, 1, 5.0, 0.0, Decimal(5)), (9, 4, 10, 1, 5.0, 0.0, Decimal(99))],
                      "SalesOrderID long, SalesOrderDetailID long, ProductID long, OrderQty long, UnitPrice double, "
                      "UnitPriceDiscount double, LineTotal decimal(19,4)"),
        "headers": make([(1, DAY, DAY, DAY, 5, 100, 1, 70), (2, DAY, DAY, None, 5, 101, 1, None)],
                        "SalesOrderID long, OrderDate timestamp_ntz, DueDate timestamp_ntz, ShipDate timestamp_ntz, "
                        "Status int, CustomerID long, TerritoryID long, SalesPersonID long"),
        "customers": make([(100, 50), (101, 51), (102, None)], "CustomerID long, PersonID long"),
        "people": make([(50, "Ana", "Ruiz"), (51, "Leo", None), (70, "Eva", "Gil")],
                       "BusinessEntityID long, FirstName string, LastName string"),
        "sellers": make([(70, 1)], "BusinessEntityID long, TerritoryID long"),
        "territories": make([(1, "Norte", "ES")], "TerritoryID long, Name string, CountryRegionCode string"),
        "products": make([(10, "Rueda", "Rojo", Decimal(1), Decimal(2), 1), (11, "Pegatina", None, None, None, None)],
                         "ProductID long, Name string, Color string, StandardCost decimal(19,4), "
                         "ListPrice decimal(19,4), ProductSubcategoryID long"),
        "subcategories": make([(1, "Ruedas", 1)], "ProductSubcategoryID long, Name string, ProductCategoryID long"),
        "categories": make([(1, "Componentes")], "ProductCategoryID long, Name string"),
    }


def test_flat_from_order_entry(entry):
    flat = flat_plans.flat_from_order_entry(entry)
    assert flat.columns == [
        "SalesOrderID", "SalesOrderDetailID", "OrderDate", "DueDate", "ShipDate", "EstadoPedido", "CustomerID",
        "FirstName", "LastName", "NombreCliente", "TerritoryID", "Territorio", "CountryRegionCode", "ProductID",
        "Producto", "Color", "StandardCost", "ListPrice", "Subcategoria", "Categoria", "VendedorID",
        "NombreVendedor", "OrderQty", "UnitPrice", "UnitPriceDiscount", "LineTotal",
    ]
    rows = {r["SalesOrderDetailID"]: r for r in flat.collect()}
    assert set(rows) == {1, 2, 3}  # a line without a header is dropped
    assert rows[1]["NombreCliente"] == "Ana Ruiz" and rows[1]["NombreVendedor"] == "Eva Gil"
    assert rows[3]["NombreCliente"] is None and rows[3]["FirstName"] == "Leo"  # a missing part hides the name
    assert rows[3]["VendedorID"] is None and rows[3]["NombreVendedor"] is None
    assert rows[2]["Subcategoria"] is None and rows[1]["Categoria"] == "Componentes"


def test_star_from_order_entry(spark, entry):
    star = star_plans.star_from_order_entry(entry, date_dim(spark, 2012, 2012, as_of=DAY.date()))
    assert {r["FechaKey"] for r in star.fact.collect()} == {20120229} and star.fact.count() == 3
    assert star.dimensions["Dim_Cliente"].rows.count() == 3
    assert star_plans.product_dim(entry).columns == [
        "ProductoKey", "Producto", "Color", "StandardCost", "ListPrice", "Subcategoria", "Categoria"
    ]
    totals = reconcile({"flat": flat_plans.flat_from_order_entry(entry), "star": star.fact}, "LineTotal").collect()
    assert {(r["rows"], r["total"]) for r in totals} == {(3, Decimal("18.5"))}
    summed = star_plans.order_totals(entry).agg(F.sum("LineTotal"), F.sum("Lineas")).first()
    assert tuple(summed) == (Decimal("18.5"), 3)


@pytest.fixture(scope="module")
def wh(spark):
    make = spark.createDataFrame
    sales = [(f"SO{n // 2}", n % 2 + 1, DAY, None, DAY, 1, 1, 10, 1, 2.0, 0.0, Decimal(n)) for n in range(7)]
    return {
        "sales": make(sales, "SalesOrderNumber string, SalesOrderLineNumber long, OrderDate timestamp_ntz, "
                             "DueDate timestamp_ntz, ShipDate timestamp_ntz, CustomerKey long, SalesTerritoryKey long, "
                             "ProductKey long, OrderQuantity long, UnitPrice double, UnitPriceDiscountPct double, "
                             "SalesAmount decimal(19,4)"),
        "customers": make([(1, "Ana", None)], "CustomerKey long, FirstName string, LastName string"),
        "employees": make([(5, "Eva", "Gil", 4, 1), (3, "Iu", "Mas", None, 1), (9, "No", "No", 1, 0)],
                          "EmployeeKey long, FirstName string, LastName string, SalesTerritoryKey long, "
                          "SalesPersonFlag int"),
        "territories": make([(1, "Norte", "España", "Europa")], "SalesTerritoryKey long, SalesTerritoryRegion string, "
                            "SalesTerritoryCountry string, SalesTerritoryGroup string"),
        "products": make([(10, "Rueda", "Rojo", Decimal(1), Decimal(2), None)],
                         "ProductKey long, EnglishProductName string, Color string, StandardCost decimal(19,4), "
                         "ListPrice decimal(19,4), ProductSubcategoryKey long"),
        "subcategories": make([], "ProductSubcategoryKey long, EnglishProductSubcategoryName string, "
                                  "ProductCategoryKey long"),
        "categories": make([], "ProductCategoryKey long, EnglishProductCategoryName string"),
    }


def test_flat_and_star_from_warehouse(spark, wh):
    from kalends.sources.readers import FLAT_SCHEMA

    flat = flat_plans.flat_from_warehouse(wh)
    assert flat.columns == FLAT_SCHEMA.fieldNames()
    dealt = {(r["SalesOrderNumber"], r["SalesOrderLineNumber"]): r["VendedorID"] for r in flat.collect()}
    assert [dealt[k] for k in sorted(dealt)] == [3, 5, 3, 5, 3, 5, 3]
    assert flat.first()["NombreCliente"] == "Ana "  # a missing part reads as empty
    tables = star_plans.star_from_warehouse(wh, date_range(spark, DAY.date(), DAY.date()))
    assert tables["Fact_Ventas"].join(tables["Dim_Vendedor"], "VendedorKey").count() == 7
    assert {r["TerritorioKey"] for r in tables["Dim_Vendedor"].collect()} == {4, None}
    assert {r["TerritorioKey"] for r in flat_plans.salespeople(wh["employees"], default_territory=1).collect()} == {4, 1}
    history = tables["Dim_Vendedor_Historial"]
    assert {(str(r["Desde"]), str(r["Hasta"])) for r in history.collect()} == {
        ("2005-01-01", "2015-12-31"), ("2016-01-01", "9999-12-31")
    }
    trap = fanout_audit(tables["Fact_Ventas"], "VendedorKey", history, "VendedorKey", "LineTotal").orderBy("version")
    assert [(r["rows"], r["total"]) for r in trap.collect()] == [(7, Decimal(21)), (14, Decimal(42))]


def test_star_from_flat(wh):
    flat = flat_plans.flat_from_warehouse(wh)
    two_places = flat.unionByName(flat.withColumn("TerritorioID", F.lit(2).cast("long")))
    tables = star_plans.star_from_flat(two_places)
    assert {n: df.count() for n, df in tables.items()} == {
        "Fact_Ventas": 14, "Dim_Producto": 1, "Dim_Cliente": 1, "Dim_Territorio": 2, "Dim_Vendedor": 4,
        "Dim_Vendedor_Historial": 8,
    }
    assert {r["VendedorKey"]: r["rows"] for r in duplicate_keys(tables["Dim_Vendedor"], ["VendedorKey"]).collect()} \
        == {3: 2, 5: 2}
    sound = star_plans.star_from_flat(two_places, unique_sellers=True)["Dim_Vendedor"]
    assert duplicate_keys(sound, ["VendedorKey"]).count() == 0
    assert {r["TerritorioKey"] for r in sound.collect()} == {2}


def test_history_on_flat_and_on_dimension(spark):
    flat = spark.createDataFrame([(1, 1.0), (1, 2.0), (2, 4.0), (3, 8.0), (4, 16.0)], "VendedorID long, LineTotal double")
    sellers = spark.createDataFrame([(1, "a", 5), (2, "b", 6), (3, "c", 7)],
                                    "VendedorKey long, NombreVendedor string, TerritorioKey long")
    history = star_plans.seller_history(sellers)
    joined = join_history_naive(flat, history, "VendedorID", "VendedorKey")
    assert joined.count() == 8 and joined.agg(F.sum("LineTotal")).first()[0] == 30.0
    audit = {r["version"][0]: (r["rows"], float(r["total"])) for r in
             fanout_audit(flat, "VendedorID", history, "VendedorKey", "LineTotal").collect()}
    assert audit == {"A": (5, 31.0), "B": (8, 30.0)}
    hung = dim_with_history(sellers, history.filter("VendedorKey <> 3"), "VendedorKey")
    assert hung.count() == 5 and "HistorialTerritorioKey" in hung.columns
    assert sorted(r["HistorialTerritorioKey"] for r in hung.filter("VendedorKey = 1").collect()) == [1, 5]


def test_global_row_number_splits_a_hot_value(spark):
    rows = spark.range(0, 5000, 1, 7).selectExpr(
        "case when id % 3 = 0 then 17 else id % 1000 end as a", "hash(id) as b", "id"
    )
    numbered = global_row_number(rows, ["a", "b", "id"], "n").collect()
    ordered = sorted((r["a"], r["b"], r["id"]) for r in numbered)
    assert [(r["a"], r["b"], r["id"]) for r in sorted(numbered, key=lambda r: r["n"])] == ordered
    assert sorted(r["n"] for r in numbered) == list(range(1, 5001))


def test_round_robin_deals_evenly_with_many_members(spark, monkeypatch):
    fact = spark.range(100).withColumnRenamed("id", "line")
    members = spark.createDataFrame([(k,) for k in (30, 10, 20)], "m long")

    def dealt():
        rows = assign_round_robin(fact, ["line"], members, "m", "who").collect()
        return [r["who"] for r in sorted(rows, key=lambda r: r["line"])]

    expected = [(10, 20, 30)[n % 3] for n in range(100)]
    assert dealt() == expected
    monkeypatch.setattr("kalends.operators.numbering.BROADCAST_ROWS", 1)
    assert dealt() == expected


def test_roles(spark):
    calendar = date_dim(spark, 2012, 2013, as_of=DAY.date())
    fact = spark.createDataFrame([(DAY, dt.datetime(2013, 1, 1, 0, 0)), (DAY, None)],
                                 "OrderDate timestamp_ntz, ShipDate timestamp_ntz")
    roles = [DateRole("order", "OrderDate", active=True), DateRole("ship", "ShipDate")]
    assert [r["Year"] for r in by_role(fact, calendar, roles, ["Year"]).collect()] == [2012, 2012]
    assert {r["Year"] for r in by_role(fact, calendar, roles, ["Year"], use="ship").collect()} == {2013, None}
    assert active_role(roles).name == "order"
    for wrong in ([DateRole("a", "x")], [DateRole("a", "x", True), DateRole("b", "y", True)], []):
        with pytest.raises(ValueError, match="exactly one"):
            active_role(wrong)
    with pytest.raises(ValueError, match="no role"):
        by_role(fact, calendar, roles, ["Year"], use="due")


def test_join_on_date_ignores_the_time(spark):
    left = spark.createDataFrame([(dt.datetime(2024, 1, 1, 9, 0),)], "a timestamp_ntz")
    right = spark.createDataFrame([(dt.date(2024, 1, 1),), (dt.date(2024, 1, 2),)], "b date")
    assert join_on_date(left, "a", right, "b", "inner").count() == 1


def test_broadcast_follows_the_count(spark):
    small, big = spark.range(10), spark.range(BROADCAST_ROWS + 1)

    def hinted(df):
        return "ResolvedHint" in df._jdf.queryExecution().analyzed().toString()

    assert hinted(broadcast_if_small(small)) and not hinted(broadcast_if_small(big))
    assert not hinted(Dimension(small, "id", "id", counted=big).side([], "k"))
    assert hinted(Dimension(big, "id", "id", bounded=True).side([], "k"))


def test_scalars(spark):
    df = spark.createDataFrame([("a", None, 6, 0), ("a", "b", 6, 4), (None, None, None, 4)],
                               "x string, y string, p int, q int")
    got = df.select(full_name("x", "y"), full_name("x", "y", null_as_empty=True), safe_div("p", "q")).collect()
    assert [tuple(r) for r in got] == [(None, "a ", None), ("a b", "a b", 1.5), (None, " ", None)]
    assert [r[0] for r in spark.range(1, 8).select(bucket_of("id", 3)).collect()] == [1, 2, 3, 1, 2, 3, 1]


def test_checks(spark):
    flat = spark.createDataFrame([(1, 1, "x", "p"), (1, 2, "y", "p"), (2, 2, "y", None)],
                                 "c int, p int, t string, name string")
    assert tuple(repetition(flat, "c", "p", "t").first()) == (3, 2, 2, 2, 1.5, 1.5)
    counted = {r["column"]: (r["rows"], r["values"]) for r in cardinality({"f": (flat, ["c", "name"])}).collect()}
    assert counted == {"c": (3, 2), "name": (3, 1)}
    assert cardinality({"f": (flat, ["c"])}, approx=True).first()["values"] == 2
    dimension = spark.createDataFrame([("p",), ("q",)], "name string")
    impact = {r["value"]: (r["flat_rows"], r["dimension_rows"]) for r in
              correction_impact(flat, dimension, "name").collect()}
    assert impact == {"p": (2, 1), "q": (0, 1), None: (1, 0)}
    assert tuple(row_counts({"flat": flat, "dim": dimension}).first()) == (3, 2)


def test_date_columns(spark):
    calendar = date_range(spark, dt.date(2012, 1, 1), dt.date(2012, 12, 31))
    tables = {"a": spark.createDataFrame([(DAY, dt.date(2013, 1, 1), 1), (None, dt.date(2012, 1, 1), 2)],
                                         "t timestamp_ntz, d date, n int")}
    assert date_columns(tables["a"]) == ["t", "d"]
    assert unrelated_date_columns(tables, {("a", "t")}) == [("a", "d")]
    got = {r["column"]: (r["related"], r["dated_rows"], r["in_calendar"], r["unknown_days"])
           for r in date_coverage(tables, calendar, {("a", "t")}).collect()}
    assert got == {"t": (True, 1, 1, 0), "d": (False, 2, 1, 1)}


def test_sellers_are_broadcast_though_people_are_many(spark, entry, monkeypatch):
    from kalends.operators import joins
    monkeypatch.setattr(joins, "BROADCAST_ROWS", 2)  # three people, one seller
    plan = flat_plans.flat_from_order_entry(entry)._jdf.queryExecution().optimizedPlan().toString()
    hinted = [line for line in plan.splitlines() if "Join LeftOuter, (SalesPersonID" in line]
    assert hinted and all("rightHint=(strategy=broadcast)" in line for line in hinted), plan


def test_many_sellers_are_still_broadcast(spark, monkeypatch):
    from kalends.operators import joins
    monkeypatch.setattr(joins, "BROADCAST_ROWS", 3)
    hinted = lambda df: "broadcast" in df._jdf.queryExecution().analyzed().toString()
    assert hinted(broadcast_if_small(spark.range(6), narrow=True)) and not hinted(broadcast_if_small(spark.range(7), narrow=True))
    assert not hinted(broadcast_if_small(spark.range(4)))


def test_lines_move_without_what_is_looked_up_or_computed_later(spark, monkeypatch):
    """Neither the territory's names nor the amounts are there when the lines are dealt by product."""
    from kalends.operators import joins
    from kalends.sources import samples
    sf_dir = "/root/testdata/sf0.001"
    monkeypatch.setattr(joins, "BROADCAST_ROWS", 50)  # more than the nations, fewer than the products
    t = samples.order_entry(spark, sf_dir, amounts=False)
    flat = flat_plans.flat_from_order_entry(t, samples.line_amounts())
    joined = [x for x in flat._jdf.queryExecution().optimizedPlan().toString().splitlines() if "Join " in x]
    at = {key: next(i for i, x in enumerate(joined) if f"({key}#" in x) for key in ("ProductID", "TerritoryID")}
    assert at["TerritoryID"] < at["ProductID"], joined  # the upper join is the later one
    whole = flat_plans.flat_from_order_entry(samples.order_entry(spark, sf_dir))
    assert sorted(map(str, flat.collect())) == sorted(map(str, whole.collect()))


def test_territories_beyond_a_broadcast(spark, monkeypatch):
    from kalends.operators import joins
    from kalends.sources import samples
    t = samples.order_entry(spark, "/root/testdata/sf0.001")
    few = sorted(map(str, flat_plans.flat_from_order_entry(t).collect()))
    monkeypatch.setattr(joins, "BROADCAST_ROWS", 0)
    assert sorted(map(str, flat_plans.flat_from_order_entry(t).collect())) == few
