"""Measures with blanks and unmatched members, hierarchies, sources and sinks, and plan shapes."""

from __future__ import annotations

import datetime as dt
from decimal import Decimal

import pytest
from pyspark.sql import functions as F

from kalends.catalog import QUERIES
from kalends.functions.scalars import distinct_count
from kalends.operators.calendar import date_dim
from kalends.operators.filters import between_dates, first_rows, in_set, non_blank
from kalends.operators.hierarchy import HIERARCHIES, hierarchy_rollup, in_order
from kalends.operators.joins import Dimension, Star, star_join
from kalends.operators.measures import days_without_purchase, evaluate, values_of
from kalends.sources.readers import (
    FLAT_SCHEMA, cast_columns, count_rejects, jdbc_options, read_flat_csv, read_table, read_text_csv,
)
from kalends.sources.sinks import check_table_name, write_table
from kalends.storage import materialise, shared_folder

SF_DIR = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def star(spark):
    fact = spark.createDataFrame(
        [("o1", 20240229, 1, 1, 10, Decimal(10)), ("o1", 20240229, 1, 1, 11, Decimal(5)),
         ("o2", 20240302, 2, 2, 10, Decimal(20)), ("o3", 20240302, None, 2, 99, Decimal(40)),
         ("o4", 20250101, 2, 1, 99, None)],
        "SalesOrderNumber string, FechaKey int, ClienteKey long, TerritorioKey long, ProductoKey long, "
        "LineTotal decimal(19,4)",
    )
    products = spark.createDataFrame([(10, "A"), (11, "B"), (12, "C")], "ProductoKey long, Categoria string")
    territories = spark.createDataFrame([(1, "N", "G"), (2, "S", "G")], "TerritorioKey long, Territorio string, Grupo string")
    calendar = date_dim(spark, 2024, 2025, as_of=dt.date(2024, 6, 1))
    return Star(fact, {
        "Fecha": Dimension(calendar, "idFecha", "FechaKey", bounded=True),
        "Dim_Producto": Dimension(products, "ProductoKey", "ProductoKey"),
        "Dim_Territorio": Dimension(territories, "TerritorioKey", "TerritorioKey"),
    })


def rows(df):
    return {tuple(r) for r in df.collect()}


def test_unmatched_rows_form_the_blank_member(star):
    got = rows(evaluate(star, ["Categoria"], ["sales", "lines"]))
    assert got == {("A", Decimal(30), 2), ("B", Decimal(5), 1), (None, Decimal(40), 2)}


def test_grouping_by_keys(star):
    assert rows(evaluate(star, ["ProductoKey"], ["lines"])) == {(10, 2), (11, 1), (99, 2)}
    assert rows(evaluate(star, ["idFecha", "Territorio"], ["lines"])) == {
        (20240229, "N", 2), (20240302, "S", 2), (20250101, "N", 1)
    }


def test_blank_groups_are_dropped(star):
    by_year = evaluate(star, ["Categoria", "Year"], ["sales"])
    assert (None, 2025, None) not in rows(by_year) and by_year.count() == 3


def test_blanks_count_as_a_value(star):
    got = evaluate(star, [], ["customers", "orders", "products", "territories", "product_territory_pairs",
                              "purchase_days", "average_ticket", "days_without_purchase"]).first()
    assert tuple(got)[:6] == (3, 4, 3, 2, 5, 3)
    assert got["average_ticket"] == 75 / 4 and got["days_without_purchase"] == 308 - 3
    plain = star.fact.agg(distinct_count("ClienteKey", count_blank=False)).first()[0]
    assert plain == 2


def test_filters_on_columns_not_shown(star):
    got = rows(evaluate(star, ["Categoria"], ["lines"], where={"Territorio": lambda c: c == "S"}))
    assert got == {("A", 1), (None, 1)}
    got = rows(evaluate(star, [], ["lines", "orders"], where={"Year": lambda c: c == 2024, "LineTotal": lambda c: c > 5}))
    assert got == {(3, 3)}


def test_only_needed_dimensions_are_joined(star):
    joined = star_join(star, ["Grupo"])
    assert "Categoria" not in joined.columns and joined.count() == 5
    assert set(joined.columns) - set(star.fact.columns) == {"Grupo"}


def test_values_have_a_blank_when_a_member_is_missing(star):
    assert rows(values_of(star, "Categoria")) == {("A",), ("B",), ("C",), (None,)}
    assert rows(values_of(star, "Grupo")) == {("G",)}


def test_unknown_names_are_refused(star):
    with pytest.raises(ValueError, match="no measure"):
        evaluate(star, [], ["margin"])
    with pytest.raises(ValueError, match="no table"):
        evaluate(star, ["Color"], ["sales"])


def test_days_without_purchase(star):
    calendar = star.dimensions["Fecha"].rows
    assert rows(days_without_purchase(star, calendar, [], ["Year"])) == {(2024, 2, 364), (2025, 1, 364)}
    assert rows(days_without_purchase(star, calendar, ["Territorio"], [])) == {("N", 2, 729), ("S", 1, 730)}
    assert rows(days_without_purchase(star, calendar, ["Territorio"], ["Year"])) == {
        ("N", 2024, 1, 365), ("N", 2025, 1, 364), ("S", 2024, 1, 365), ("S", 2025, 0, 365)
    }
    # A product that was never sold, and the blank product that was sold in both years.
    assert rows(days_without_purchase(star, calendar, ["Categoria"], ["Year"])) == {
        ("A", 2024, 2, 364), ("A", 2025, 0, 365), ("B", 2024, 1, 365), ("B", 2025, 0, 365),
        ("C", 2024, 0, 366), ("C", 2025, 0, 365), (None, 2024, 1, 365), (None, 2025, 1, 364),
    }
    assert ("C", 0, 731) in rows(days_without_purchase(star, calendar, ["Categoria"], []))
    assert rows(days_without_purchase(star, calendar, ["Categoria", "Grupo"], ["Year"])) == {
        (c, "G", y, n, (366 if y == 2024 else 365) - n)
        for c, y, n in [("A", 2024, 2), ("A", 2025, 0), ("B", 2024, 1), ("B", 2025, 0), (None, 2024, 1), (None, 2025, 1)]
    }


def test_rollup_counts_customers_afresh(spark):
    days = spark.createDataFrame(
        [(dt.date(2024, 5, 31), 1, 10), (dt.date(2024, 6, 1), 1, 20), (dt.date(2024, 6, 1), 2, 40)],
        "Date date, c int, s int",
    )
    calendar = date_dim(spark, 2024, 2024, as_of=dt.date(2024, 6, 1))
    rolled = hierarchy_rollup(days, calendar, "Fiscal", {"s": F.sum("s"), "n": F.count_distinct("c")})
    got = [tuple(r) for r in in_order(rolled, "Fiscal").select(
        "level", "FiscalYear", "Fiscal Month Name", F.col("Date").cast("string"), "s", "n").collect()]
    assert got == [
        (0, None, None, None, 70, 2), (1, 2024, None, None, 10, 1), (2, 2024, "Mayo", None, 10, 1),
        (3, 2024, "Mayo", "2024-05-31", 10, 1), (1, 2025, None, None, 60, 2), (2, 2025, "Junio", None, 60, 2),
        (3, 2025, "Junio", "2024-06-01", 60, 2),
    ]
    shallow = hierarchy_rollup(days, calendar, "Calendar", {"s": F.sum("s")}, depth=1)
    assert rows(shallow.select("level", "Year", "s")) == {(0, None, 70), (1, 2024, 70)}
    assert len(HIERARCHIES) == 5
    with pytest.raises(ValueError):
        hierarchy_rollup(days, calendar, "Lunar", {})


def test_filters(spark):
    stamps = spark.createDataFrame([(dt.datetime(2024, 1, n, 23, 59), n) for n in range(1, 11)], "t timestamp_ntz, n int")
    kept = between_dates(stamps, "t", dt.date(2024, 1, 3), dt.date(2024, 1, 5))
    assert [r["n"] for r in kept.orderBy("n").collect()] == [3, 4, 5]
    values = spark.createDataFrame([(3,), (3,), (77,)], "n int")
    assert in_set(stamps, values, "n").count() == 1
    blanks = spark.createDataFrame([(None, None), (1, None)], "a int, b int")
    assert non_blank(blanks, ["a", "b"]).count() == 1
    assert [r["n"] for r in first_rows(stamps, 2, [F.desc("n")]).collect()] == [10, 9]


def test_csv(spark, tmp_path):
    header = ",".join(FLAT_SCHEMA.fieldNames())
    good = '"SO1",1,2012-02-29 00:00:00,,2012-03-01 10:00:00,5,José "Pepe",1,Norte,ES,7,Rueda,,1.5,2.25,S,C,,,3,1.1,0.5,9.9999'
    bad = good.replace("SO1", "SO2").replace(",3,1.1,", ",three,1.1,")
    path = tmp_path / "flat.csv"
    path.write_text("\n".join([header, good, bad]) + "\n", encoding="utf-8")
    flat = read_flat_csv(spark, str(path))
    assert flat.schema == FLAT_SCHEMA
    first, second = flat.orderBy("SalesOrderNumber").collect()
    assert first["SalesOrderNumber"] == '"SO1"' and first["NombreCliente"] == 'José "Pepe"'  # quotes are ordinary
    assert first["OrderDate"] == dt.datetime(2012, 2, 29) and first["LineTotal"] == Decimal("9.9999")
    assert first["DueDate"] is None and first["VendedorID"] is None and second["OrderQty"] is None
    text = read_text_csv(spark, str(path), FLAT_SCHEMA.fieldNames())
    rejects = count_rejects(text, FLAT_SCHEMA).first().asDict()
    assert {c: n for c, n in rejects.items() if n} == {"OrderQty": 1}


def test_csv_in_another_order_is_refused(spark, tmp_path):
    path = tmp_path / "swapped.csv"
    path.write_text("b,a\n1,2\n")
    with pytest.raises(Exception, match="header"):
        read_text_csv(spark, str(path), ["a", "b"]).collect()


def test_casting_merges_spellings_of_a_key(spark):
    text = spark.createDataFrame([("01", "x"), ("1", "x")], "ClienteID string, NombreCliente string")
    schema = FLAT_SCHEMA["ClienteID"], FLAT_SCHEMA["NombreCliente"]
    assert cast_columns(text, type(FLAT_SCHEMA)(list(schema))).distinct().count() == 1


def test_tables(spark, tmp_path):
    folder = str(tmp_path / "t")
    write_table(spark.range(3), folder)
    write_table(spark.range(5).withColumn("x", F.lit(1)), folder, overwrite_schema=True)
    assert spark.read.parquet(folder).columns == ["id", "x"]
    spark.range(4).createOrReplaceTempView("some_view")
    assert read_table(spark, "some_view").count() == 4
    assert check_table_name("lake.dbo.DimFecha") == "lake.dbo.DimFecha"
    for wrong in ("1abc", "a b", "a;drop", "a..b", "", "a.b.", "tabla\n"):
        with pytest.raises(ValueError):
            check_table_name(wrong)


def test_jdbc_options():
    options = jdbc_options("jdbc:x", "dbo.t", key="id", first=0, last=99, partitions=4)
    assert (options["partitionColumn"], options["numPartitions"], options["upperBound"]) == ("id", "4", "99")
    assert "partitionColumn" not in jdbc_options("jdbc:x", "dbo.t")
    with pytest.raises(ValueError):
        jdbc_options("jdbc:x", "dbo.t", key="id")


def test_stored_tables_go_to_the_configured_folder(spark, tmp_path, monkeypatch):
    assert shared_folder(spark) == shared_folder(spark)
    monkeypatch.setattr("kalends.storage.shared_folder", lambda _: str(tmp_path))
    stored = materialise(spark.range(10), "x")
    assert stored.count() == 10 and all(f.startswith(tmp_path.as_uri()[:8]) for f in stored.inputFiles())
    assert list(tmp_path.iterdir())


def plan_of(spark, name):
    return QUERIES[name](spark, SF_DIR)._jdf.queryExecution().executedPlan().toString()


@pytest.fixture
def settings(spark):
    """Set session settings for one test."""
    changed = {}

    def change(**values):
        for name, value in values.items():
            key = "spark.sql." + name
            changed.setdefault(key, spark.conf.get(key))
            spark.conf.set(key, value)

    yield change
    for key, value in changed.items():
        spark.conf.set(key, value)


@pytest.mark.parametrize("build", ["fact", "flat"])
def test_an_order_with_a_third_of_the_lines_is_split(spark, settings, build):
    from kalends.plans import flat as flat_plans
    from kalends.plans import star as star_plans
    from kalends.sources import samples

    settings(**{
        "shuffle.partitions": "32", "adaptive.skewJoin.skewedPartitionThresholdInBytes": "20k",
        "adaptive.advisoryPartitionSizeInBytes": "10k", "adaptive.coalescePartitions.enabled": "false",
    })
    t = samples.order_entry(spark, "/root/testdata/sf0.01")
    hot = F.when(F.pmod(F.xxhash64(*t["lines"].columns), F.lit(3)) == 0, 20).otherwise(F.col("SalesOrderID"))
    t["lines"] = t["lines"].repartition(16).withColumn("SalesOrderID", hot.cast("long"))
    joined = star_plans.sales_fact(t) if build == "fact" else flat_plans.flat_from_order_entry(t)
    assert len(joined.collect()) == 60_000
    assert "SortMergeJoin(skew=true)" in joined._jdf.queryExecution().executedPlan().toString()


def test_date_slicer_reaches_the_scan(spark):
    plan = plan_of(spark, "sales_between_dates")
    assert "GreaterThanOrEqual(o_orderdate" in plan and "LessThan(o_orderdate" in plan


def test_scans_read_needed_columns_only(spark):
    plan = plan_of(spark, "yoy_by_year")
    assert "ReadSchema: struct<l_orderkey:bigint,l_extendedprice:double,l_discount:double>" in plan
    assert "ReadSchema: struct<o_orderkey:bigint,o_orderdate:timestamp_ntz>" in plan


@pytest.mark.parametrize("name", sorted(set(QUERIES) - {"flat_csv_round_trip", "flat_table_round_trip"}))
def test_no_cross_joins_and_no_python_in_plans(spark, name):
    plan = plan_of(spark, name)
    for operator in ("CartesianProduct", "BroadcastNestedLoopJoin", "BatchEvalPython", "ArrowEvalPython"):
        assert operator not in plan
