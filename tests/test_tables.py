"""Checked files, replaced tables, sources by name; reductions below joins, and plans that keep lines where they are."""

from __future__ import annotations

import collections
import datetime as dt
import os
import random
from decimal import Decimal

import pytest
from pyspark.sql import functions as F

from kalends.catalog import QUERIES
from kalends.functions.names import MONTHS
from kalends.operators import filters
from kalends.operators.calendar import calendar_over, date_bounds, date_dim, date_range, describe_days, filled_days
from kalends.operators.joins import aggregate_through_join
from kalends.operators.numbering import assign_round_robin
from kalends.operators.quality import correction_impact, days_outside
from kalends.plans import flat as flat_plans
from kalends.plans.star import seller_periods, star_from_warehouse
from kalends.sources import samples
from kalends.sources.checked import REASONS, accepted_rows, read_checked_csv, rejected_rows
from kalends.sources.names import Names
from kalends.sources.versions import VersionedTable, history
from kalends.storage import Scratch, materialise, shared_folder, temporary

SF_DIR = "/root/testdata/sf0.001"
SCHEMA = "n long, d date, x decimal(5,2), s string"


def rows(df):
    return sorted(map(tuple, df.collect()), key=str)


# --- files --------------------------------------------------------------------------------------

def test_rejects_have_line_column_and_reason(spark, tmp_path):
    folder = tmp_path / "in"
    folder.mkdir()
    (folder / "a.csv").write_text("n,d,x,s\n1,2024-02-29,1.5,ok\nx,2023-02-29,1e3,\n,,,\n5,2024-01-01\n6,2024-01-01,2,a,b\n", encoding="utf-8")
    (folder / "b.csv").write_text('n,d,x,s\n99999999999999999999,2024-01-01,abc,"q\n', encoding="utf-8")
    from pyspark.sql import types as T

    checked = read_checked_csv(spark, str(folder), T.StructType.fromDDL(SCHEMA))
    assert rows(accepted_rows(checked)) == [(1, dt.date(2024, 2, 29), Decimal("1.50"), "ok"), (None, None, None, None)]
    assert rows(rejected_rows(checked, str(folder))) == sorted([
        ("a.csv", 3, "n", "x", REASONS["whole"]), ("a.csv", 3, "d", "2023-02-29", REASONS["day"]),
        ("a.csv", 3, "x", "1e3", REASONS["range"]), ("a.csv", 5, None, "5,2024-01-01", REASONS["fields"]),
        ("a.csv", 6, None, "6,2024-01-01,2,a,b", REASONS["fields"]), ("b.csv", 2, "n", "9" * 20, REASONS["range"]),
        ("b.csv", 2, "x", "abc", REASONS["number"]),
    ], key=str)
    assert checked.count() == 6  # every row but the two headers, rejected or not


def test_lines_are_numbered_across_blocks(spark, tmp_path):
    from pyspark.sql import types as T

    bad = {2, 700, 1999, 5000}
    body = "".join(f"{'bad' if n in bad else n},2024-01-01,1,{'z' * 20}\n" for n in range(2, 5001))
    path = tmp_path / "long.csv"
    path.write_text("n,d,x,s\n" + body)
    before = spark.conf.get("spark.sql.files.maxPartitionBytes")
    spark.conf.set("spark.sql.files.maxPartitionBytes", "20000")
    try:
        checked = read_checked_csv(spark, str(path), T.StructType.fromDDL(SCHEMA))
        assert checked.rdd.getNumPartitions() > 5
        assert [r[1] for r in rejected_rows(checked, str(path)).orderBy("line").collect()] == sorted(bad)
        assert accepted_rows(checked).count() == 4995
    finally:
        spark.conf.set("spark.sql.files.maxPartitionBytes", before)


def test_a_line_is_split_once_and_a_sound_one_gets_no_list(spark, tmp_path):
    from pyspark.sql import types as T

    (tmp_path / "a.csv").write_text("n,d,x,s\n1,2024-02-29,1.5,ok\n")
    checked = read_checked_csv(spark, str(tmp_path), T.StructType.fromDDL(SCHEMA))
    for df in (checked, accepted_rows(checked), rejected_rows(checked, str(tmp_path))):
        plan = df._jdf.queryExecution().optimizedPlan().toString()
        assert plan.count("split(value") == 1, plan
    assert "CASE WHEN" in plan and "Generate explode(array(CASE WHEN" in plan, plan


def test_written_text_is_compressed_and_read_again(spark, tmp_path):
    from kalends.sources.readers import read_text_csv
    from kalends.sources.sinks import write_text_csv

    values = [("1", 'a "quoted" word'), ("2", None), (None, "ñandú")]
    write_text_csv(spark.createDataFrame(values, "n string, s string"), str(tmp_path / "t"))
    files = [f for f in os.listdir(tmp_path / "t") if f.startswith("part-")]
    assert files and all(f.endswith(".csv.gz") for f in files)
    assert rows(read_text_csv(spark, str(tmp_path / "t"), ["n", "s"])) == sorted(values, key=str)


def test_a_table_is_replaced_whole_or_not_at_all(spark, tmp_path):
    table = VersionedTable(spark, str(tmp_path / "t"))
    with pytest.raises(ValueError, match="no version"):
        table.read()
    assert table.write(spark.range(3)) == 1
    assert table.write(spark.range(2).withColumn("x", F.lit("a")), mode="append") == 2
    assert rows(table.read()) == sorted([(0, "a"), (1, "a"), (0, None), (1, None), (2, None)], key=str)
    with pytest.raises(ValueError, match="overwrite_schema"):
        table.write(spark.range(3))
    with pytest.raises(ValueError, match="other types"):
        table.write(spark.range(3).withColumn("x", F.lit(1)), mode="append")
    # a write that stops half-way: rows are there, the manifest is not
    failing = spark.range(9).select(F.when(F.col("id") < 8, F.col("id")).otherwise(F.raise_error(F.lit("stop")).cast("long")).alias("other"))
    with pytest.raises(Exception, match="stop"):
        table.write(failing, overwrite_schema=True)
    assert table.versions() == [1, 2] and table.read().count() == 5
    assert table.write(spark.range(4).toDF("other"), overwrite_schema=True) == 3
    assert table.read().columns == ["other"] and table.read(1).columns == ["id"] and table.read(1).count() == 3
    assert rows(history(table)) == sorted([(1, "id", "bigint"), (2, "id", "bigint"), (2, "x", "string"), (3, "other", "bigint")], key=str)


def test_two_writers_of_one_version(spark, tmp_path):
    first, second = (VersionedTable(spark, str(tmp_path / "t")) for _ in range(2))
    first.write(spark.range(1))
    known = second.versions()
    first.write(spark.range(2))
    second.versions = lambda: known  # as if it had looked before the other wrote
    with pytest.raises(RuntimeError, match="somebody else"):
        second.write(spark.range(3))
    assert first.read().count() == 2
    first.write(spark.range(5))
    first.drop_older(keep=1)
    assert first.versions() == [3] and first.read().count() == 5
    assert sorted(n.split("-")[0] for n in os.listdir(tmp_path / "t") if not n.startswith(".")) == ["manifest", "rows"]
    with pytest.raises(ValueError, match="mode"):
        first.write(spark.range(1), mode="ignore")


def test_sources_by_name(spark, tmp_path):
    spark.sql("CREATE DATABASE IF NOT EXISTS names_test")
    spark.range(3).select("id", F.lit(1).alias("N"), F.lit("x").alias("extra")).write.mode("overwrite").saveAsTable("names_test.things")
    names = Names(spark, {"DW.dbo": "names_test", "DW": "default"}, {"DW.dbo.Things": "id long, n long", "DW.dbo.Wrong": "id long"})
    df = names.table("dw.dbo.things")
    assert df.columns == ["id", "n"] and dict(df.dtypes)["n"] == "bigint" and df.count() == 3
    assert names.located("DW.dbo.Things") == "names_test.Things" and names.located("Other.x") == "Other.x"
    with pytest.raises(ValueError, match="no table or view"):
        names.table("DW.dbo.Wrong")
    strict = Names(spark, {"DW.dbo": "names_test"}, {"DW.dbo.things": "id int, missing string, extra string"})
    with pytest.raises(ValueError, match="id is bigint, not int") as told:
        strict.table("DW.dbo.things")
    assert "missing is missing" in str(told.value)
    with pytest.raises(ValueError, match="not a table name"):
        names.table("DW.dbo; drop")
    spark.sql("DROP TABLE names_test.things")


def test_temporary_tables_go_when_their_block_ends(spark, tmp_path, monkeypatch):
    monkeypatch.setattr("kalends.storage.shared_folder", lambda _: str(tmp_path))
    with temporary(spark):
        materialise(spark.range(3), "one")
        kept = Scratch(spark).folder("two")
        spark.range(2).write.parquet(kept)
        assert len(os.listdir(tmp_path)) == 2
    assert os.listdir(tmp_path) == []
    with temporary(spark, keep=lambda folder: "/stay-" in folder):
        materialise(spark.range(3), "stay")
        materialise(spark.range(3), "go")
    assert [n.split("-")[0] for n in os.listdir(tmp_path)] == ["stay"]


@pytest.mark.parametrize("name", ["flat_csv_round_trip", "flat_csv_rejects", "versioned_orders", "round_robin_seller", "measures_total"])
def test_queries_leave_nothing_behind(spark, tmp_path, monkeypatch, name):
    monkeypatch.setattr("kalends.storage.shared_folder", lambda _: str(tmp_path))
    with temporary(spark):
        assert QUERIES[name](spark, SF_DIR).count() > 0
    assert os.listdir(tmp_path) == []


def test_a_cluster_needs_a_shared_folder(spark, monkeypatch):
    class Context:
        master = "spark://host:7077"

        def getCheckpointDir(self):
            return None

    class Session:
        sparkContext = Context()

        class conf:
            @staticmethod
            def get(name, default=None):
                return "file:/somewhere" if "warehouse" in name else default

    with pytest.raises(ValueError, match="checkpoint"):
        shared_folder(Session())


# --- calendars ----------------------------------------------------------------------------------

def test_a_long_span_is_made_by_several_tasks(spark):
    days = date_range(spark, dt.date(1, 3, 5), dt.date(9999, 12, 30))
    assert days.rdd.getNumPartitions() == 40
    found = days.agg(F.count(F.lit(1)), F.countDistinct("Date"), F.min("Date"), F.max("Date")).first()
    assert tuple(found) == ((dt.date(9999, 12, 30) - dt.date(1, 3, 5)).days + 1,) * 2 + (dt.date(1, 3, 5), dt.date(9999, 12, 30))
    assert date_range(spark, dt.date(2024, 2, 28), dt.date(2024, 3, 1)).count() == 3
    assert date_range(spark, dt.date(2024, 2, 28), dt.date(2024, 2, 28)).count() == 1


def test_a_stray_date_does_not_make_a_calendar_large(spark):
    df = spark.sql("SELECT make_date(1, 1, 1) AS d UNION ALL SELECT DATE '2024-01-01'")
    with pytest.raises(Exception, match="1000 years"):
        calendar_over(date_bounds(df, ["d"])).count()


def test_bounds_of_several_columns_in_one_pass(spark):
    df = spark.createDataFrame(
        [(dt.date(2024, 5, 1), dt.datetime(2023, 1, 31, 23), None), (dt.date(9999, 12, 31), None, None)],
        "a date, b timestamp_ntz, c date",
    )
    bounds = date_bounds(df, ["a", "b", "c"])
    assert rows(bounds) == [("a", dt.date(2024, 5, 1), dt.date(2024, 5, 1)), ("b", dt.date(2023, 1, 31), dt.date(2023, 1, 31)), ("c", None, None)]
    assert "Expand" not in bounds._jdf.queryExecution().executedPlan().toString()
    assert calendar_over(bounds).count() == (dt.date(2024, 5, 1) - dt.date(2023, 1, 31)).days + 1
    assert calendar_over(bounds, lead_months=1, whole_years=True).count() == 365 + 366 + 365
    outside = days_outside({"t": df, "none": spark.range(1)}, date_range(spark, dt.date(2024, 1, 1), dt.date(2024, 12, 31)))
    assert {(r["column"], r["starts_inside"], r["ends_inside"]) for r in outside.collect()} == {("a", True, True), ("b", False, True), ("c", None, None)}


def test_days_between_are_filled(spark):
    df = spark.createDataFrame([(dt.date(2024, 12, 30), 1), (dt.date(2025, 1, 2), 2)], "Date date, n int")
    assert rows(filled_days(df)) == [
        (dt.date(2024, 12, 30), 1, True), (dt.date(2024, 12, 31), 1, False), (dt.date(2025, 1, 1), 1, False), (dt.date(2025, 1, 2), 2, True)
    ]
    whole = filled_days(df, whole_years=True)
    assert whole.count() == 366 + 365 and whole.where("_given").count() == 2
    assert filled_days(df.limit(0)).count() == 0


def test_month_names_are_those_expected(spark):
    # literals, so that a slip in the library's own lists is seen
    spanish = ["Enero", "Febrero", "Marzo", "Abril", "Mayo", "Junio", "Julio", "Agosto", "Septiembre", "Octubre", "Noviembre", "Diciembre"]
    days = date_dim(spark, 2024, 2024, as_of=dt.date(2024, 1, 1), columns=["Month", "Month Name"]).distinct().orderBy("Month")
    assert [r["Month Name"] for r in days.collect()] == spanish == MONTHS["es"]
    week = describe_days(date_range(spark, dt.date(2024, 6, 2), dt.date(2024, 6, 8)), lang="en", as_of=dt.date(2024, 1, 1), columns=["Date", "Day Name", "Month Name"])
    assert [r["Day Name"] for r in week.orderBy("Date").collect()] == ["Sunday", "Monday", "Tuesday", "Wednesday", "Thursday", "Friday", "Saturday"]
    assert week.first()["Month Name"] == "June"


# --- reductions below joins ---------------------------------------------------------------------

@pytest.mark.parametrize("how", ["inner", "left"])
def test_sums_through_a_join_that_is_not_made(spark, how):
    draw = random.Random(1)
    fact = [(draw.choice([1, 2, 3, 4, None]), draw.choice("xy"), draw.randrange(9)) for _ in range(60)]
    other = [(draw.choice([1, 2, 3, 5, None]), draw.choice("pq")) for _ in range(9)]
    left = spark.createDataFrame(fact, "k int, g string, a int").withColumn("m", F.col("a").cast("decimal(19,4)"))
    right = spark.createDataFrame(other, "j int, h string")
    got = aggregate_through_join(left, "k", right, "j", {"a": "a", "m": "m"}, by_fact=["g"], by_other=["h"], how=how)
    want = collections.defaultdict(lambda: [0, 0])
    for k, g, a in fact:
        partners = [h for j, h in other if j == k and k is not None] or ([None] if how == "left" else [])
        for h in partners:
            want[(g, h)][0] += 1
            want[(g, h)][1] += a
    assert {(r["g"], r["h"]): [r["rows"], r["a"]] for r in got.collect()} == dict(want)
    assert all(r["m"] == r["a"] for r in got.collect())


@pytest.mark.parametrize("few", [True, False])
def test_keys_filter_the_scan(spark, monkeypatch, few):
    if not few:
        monkeypatch.setattr(filters, "BROADCAST_ROWS", 10)
    keys = spark.range(0, 4000, 40).select(F.col("id").alias("k"))
    df = spark.range(5000).select(F.col("id").alias("k"), F.lit("x").alias("v"))
    kept = filters.within_keys(df, "k", keys)
    found = {r["k"] for r in kept.collect()}
    assert set(range(0, 4000, 40)) <= found and len(found) < 110
    if few:
        assert len(found) == 100
    plan = kept._jdf.queryExecution().executedPlan().toString()
    assert "SortMergeJoin" not in plan and "CartesianProduct" not in plan
    assert filters.within_keys(df, "k", keys.limit(0)).count() == 0


def test_flat_groups_are_those_of_the_flat_table(spark):
    t = samples.order_entry(spark, SF_DIR)
    flat = flat_plans.flat_from_order_entry(t)
    for columns in (["VendedorID", "NombreVendedor", "TerritoryID"], ["Subcategoria"], ["NombreCliente", "Categoria"], ["CustomerID"]):
        want = flat.groupBy(*columns).agg(F.count(F.lit(1)).alias("rows"))
        assert rows(flat_plans.flat_groups(t, columns)) == rows(want)
    with pytest.raises(ValueError, match="do not follow"):
        flat_plans.flat_groups(t, ["OrderQty"])


def test_counted_rows_in_a_correction(spark):
    groups = spark.createDataFrame([("a", 5), ("b", 2), ("a", 1)], "v string, rows long")
    dimension = spark.createDataFrame([("a",), ("c",)], "v string")
    assert rows(correction_impact(groups, dimension, "v", counted="rows")) == [("a", 6, 1), ("b", 2, 0), ("c", 0, 1)]


def test_many_members_are_dealt_like_few(spark):
    fact = spark.range(1, 1001).select(F.col("id").alias("o"))
    members = spark.range(0, 70, 10).select(F.col("id").alias("m"))
    dealt = assign_round_robin(fact, ["o"], members, "m", "seller")
    assert {(r["o"], r["seller"]) for r in dealt.collect()} == {(o, 10 * ((o - 1) % 7)) for o in range(1, 1001)}


def test_seller_periods(spark):
    day = dt.datetime(2024, 1, 1)
    fact = spark.createDataFrame(
        [(1, 1, day), (1, 1, day + dt.timedelta(days=9, hours=5)), (1, 2, day + dt.timedelta(days=200)), (2, None, day + dt.timedelta(days=120))],
        "VendedorKey int, TerritorioKey int, OrderDate timestamp_ntz",
    )
    assert rows(seller_periods(fact)) == sorted([
        (1, 1, dt.date(2024, 1, 1), dt.date(2024, 1, 10)), (1, 2, dt.date(2024, 7, 19), dt.date(9999, 12, 31)),
        (2, None, dt.date(2024, 4, 30), dt.date(9999, 12, 31)),
    ], key=str)
    assert rows(seller_periods(fact, open_days=20))[2][3] == dt.date(2024, 4, 30)


def test_default_territory(spark):
    t = samples.warehouse(spark, SF_DIR)
    t["employees"] = t["employees"].withColumn("SalesTerritoryKey", F.lit(None).cast("long"))
    star = star_from_warehouse(t, date_range(spark, dt.date(2024, 1, 1), dt.date(2024, 1, 2)), default_territory=7,
                               dealt=t["sales"].withColumn("VendedorKey", F.lit(0)))
    assert {r["TerritorioKey"] for r in star["Dim_Vendedor"].collect()} == {7}


# --- plans --------------------------------------------------------------------------------------

def plan_of(spark, name):
    return QUERIES[name](spark, SF_DIR)._jdf.queryExecution().executedPlan().toString()


def test_values_of_a_dimension_do_not_touch_the_lines(spark):
    assert "l_orderkey" not in plan_of(spark, "distinct_customer_names")


def test_header_keys_reach_the_scan_of_the_lines(spark):
    plan = plan_of(spark, "sales_between_dates")
    scan = plan.index("ReadSchema: struct<l_orderkey")
    above = plan[:scan]
    semi, partial = above.rindex("LeftSemi"), above.rindex("partial_sum(")
    assert partial < semi  # the plan prints parents first: the sum per order is above the filter
    assert "Exchange hashpartitioning(SalesOrderID" not in above[semi:]


def test_shipments_are_scanned_once(spark):
    assert plan_of(spark, "auto_calendar_of_shipments").count("ReadSchema: struct<l_shipdate") == 1


def test_history_sums_join_one_row_per_seller(spark):
    plan = plan_of(spark, "history_trap_by_period")
    assert "_partners" in plan and plan.index("_partners") < plan.index("ReadSchema: struct<l_orderkey")
