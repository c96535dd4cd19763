"""Measures in a changed view, exact distinct sets and roll-ups from sets, against loops over the rows."""

from __future__ import annotations

import calendar as months
import datetime as dt
import random
from decimal import Decimal

import pytest
from pyspark.sql import functions as F

from kalends.catalog import QUERIES
from kalends.operators.calendar import date_dim
from kalends.operators.context import ALL, FULL_YEAR, SALE_DAYS, SAME_PERIOD, Change
from kalends.operators.distinct import dense_ids, distinct_counts, distinct_sets, merged_sets, set_sizes
from kalends.operators.hierarchy import day_sets, hierarchy_rollup, in_order, set_rollup
from kalends.operators.joins import Dimension, Star
from kalends.operators.measures import evaluate, measure_rows, values_of

SF_DIR = "/root/testdata/sf0.001"
FIRST, LAST = dt.date(2023, 1, 1), dt.date(2025, 12, 31)


def _rows():
    draw = random.Random(7)
    days = [FIRST + dt.timedelta(days=draw.randrange(1096)) for _ in range(250)]
    days += [dt.date(2024, 2, 29)] * 6 + [dt.date(2023, 2, 28), dt.date(2023, 3, 1), dt.date(2025, 2, 28), dt.date(2024, 2, 28)] * 3
    return [
        (f"o{i % 90}", d, draw.choice([1, 2, 3, None]), draw.choice([1, 2, None]), draw.choice([10, 11]), Decimal(draw.randrange(1, 100)))
        for i, d in enumerate(days)
    ]


ROWS = _rows()
NAMES = {1: "N", 2: "S", None: None}


@pytest.fixture(scope="module")
def star(spark):
    fact = spark.createDataFrame(
        [(o, d.year * 10000 + d.month * 100 + d.day, c, t, p, a) for o, d, c, t, p, a in ROWS],
        "SalesOrderNumber string, FechaKey int, ClienteKey long, TerritorioKey long, ProductoKey long, LineTotal decimal(19,4)",
    )
    territories = spark.createDataFrame([(1, "N"), (2, "S")], "TerritorioKey long, Territorio string")
    return Star(fact, {
        "Fecha": Dimension(date_dim(spark, 2023, 2025, as_of=dt.date(2024, 6, 1)), "idFecha", "FechaKey", bounded=True),
        "Dim_Territorio": Dimension(territories, "TerritorioKey", "TerritorioKey"),
    })


def clamped(d):
    return dt.date(d.year - 1, d.month, min(d.day, months.monthrange(d.year - 1, d.month)[1]))


def rolled(d):
    return dt.date(d.year - 1, d.month, 1) + dt.timedelta(days=d.day - 1)


def same_period(days):
    out = set()
    for d in days:
        out.add(clamped(d))
        if d.day == months.monthrange(d.year, d.month)[1]:
            out.add(dt.date(d.year - 1, d.month, months.monthrange(d.year - 1, d.month)[1]))
    return {d for d in out if d >= FIRST}


def all_days():
    return [FIRST + dt.timedelta(days=n) for n in range((LAST - FIRST).days + 1)]


def brute(sees_day, sees_row, territories, years):
    """Every form of last year's sales and customers for each (territory, year) cell."""
    out = {}
    for t in territories:
        own = [r for r in ROWS if r[3] == t and sees_row(r)]
        for y in years:
            shown = [r for r in own if r[1].year == y and sees_day(r[1])]
            sales = sum(r[5] for r in shown) if shown else None
            period = same_period([d for d in all_days() if d.year == y and sees_day(d)])
            matching = {rolled(r[1]) for r in shown}

            def total(rows):
                rows = list(rows)
                return sum(r[5] for r in rows) if rows else None

            ly = total(r for r in own if r[1] in period)
            cell = (
                sales, ly, total(r for r in own if r[1] in matching), total(r for r in ROWS if r[1] in matching),
                total(r for r in own if shown and r[1].year == max(x[1] for x in shown).year - 1),
                len({r[2] for r in own if r[1] in period}) or None,
            )
            if any(v is not None for v in cell):
                out[(NAMES[t], y)] = cell
    return out


FORMS = ["sales", "ly", "ly_sparse", "ly_sparse_all", "ly_full_year", "customers_ly"]
CUSTOMERS_LY = {"customers_ly": Change("customers", SAME_PERIOD)}


@pytest.mark.parametrize("filtered", [False, True])
def test_forms_of_last_year_against_a_loop(star, filtered):
    where = {"Month": lambda c: c <= 3, "ProductoKey": lambda c: c == 10} if filtered else None
    got = {
        (r["Territorio"], r["Year"]): tuple(r[m] for m in FORMS)
        for r in evaluate(star, ["Territorio", "Year"], FORMS, where, changes=CUSTOMERS_LY).collect()
    }
    want = brute(lambda d: not filtered or d.month <= 3, lambda r: not filtered or r[4] == 10, [1, 2, None], [2023, 2024, 2025])
    assert got == want


def test_comparisons_come_from_the_forms(star):
    rows = evaluate(star, ["Territorio", "Year"], ["sales", "ly", "yoy", "yoy_pct", "parallel", "yoy_sparse", "ly_sparse"]).collect()
    for r in rows:
        assert r["parallel"] == r["ly"] and r["yoy"] == (r["sales"] or 0) - (r["ly"] or 0)
        assert r["yoy_pct"] == (pytest.approx(float(r["yoy"]) / float(r["ly"])) if r["ly"] else None)
        assert r["yoy_sparse"] == (r["sales"] or 0) - (r["ly_sparse"] or 0)


def test_single_days_and_totals(star):
    by_day = {r["Date"]: (r["sales"], r["ly"]) for r in evaluate(star, ["Date"], ["sales", "ly"]).collect()}
    on = {d: sum(r[5] for r in ROWS if r[1] == d) or None for d in all_days()}
    want = {d: (on[d], on.get(clamped(d))) for d in all_days() if on[d] or on.get(clamped(d))}
    assert by_day == want
    whole = evaluate(star, [], ["sales", "ly"], {"Year": lambda c: c == 2025}).first()
    assert tuple(whole) == tuple(sum(r[5] for r in ROWS if r[1].year == y) for y in (2025, 2024))


def test_filters_dropped_by_name(star):
    changes = {"everyone": Change("sales", drop=("Territorio",)), "everything": Change("lines", drop=ALL),
               "everyone_ly": Change("sales", SAME_PERIOD, ("Territorio",)), "year_before": Change("lines", FULL_YEAR, ("ProductoKey",))}
    where = {"ProductoKey": lambda c: c == 10}
    rows = evaluate(star, ["Territorio", "Year"], ["sales", *changes], where, changes=changes).collect()
    assert len(rows) == 9
    for r in rows:
        assert r["everyone"] == sum(x[5] for x in ROWS if x[4] == 10 and x[1].year == r["Year"])
        assert r["everything"] == len(ROWS)
        assert r["everyone_ly"] == (sum(x[5] for x in ROWS if x[4] == 10 and x[1].year == r["Year"] - 1) or None)
        own = [x for x in ROWS if NAMES[x[3]] == r["Territorio"] and x[1].year == r["Year"] - 1]
        assert r["year_before"] == (len(own) or None)


def test_flat_tables_say_when_by_columns_of_their_own(spark):
    flat = spark.createDataFrame(
        [(o, dt.datetime(d.year, d.month, d.day, 13), c, t, p, a, d.year) for o, d, c, t, p, a in ROWS],
        "SalesOrderNumber string, OrderDate timestamp_ntz, ClienteID long, TerritorioID long, ProductoID long, "
        "LineTotal decimal(19,4), `Año` int",
    )
    got = {
        (NAMES[r["TerritorioID"]], r["Año"]): (r["sales"], r["ly_sparse"], r["ly_sparse_all"], r["ly_full_year"])
        for r in measure_rows(flat, ["TerritorioID", "Año"], ["sales", "ly_sparse", "ly_sparse_all", "ly_full_year"],
                              date_columns=("OrderDate", "Año")).collect()
    }
    want = brute(lambda d: True, lambda r: True, [1, 2, None], [2023, 2024, 2025])
    assert got == {k: (v[0], *v[2:5]) for k, v in want.items()}
    with pytest.raises(ValueError, match="calendar"):
        measure_rows(flat, ["Año"], ["ly"], date_columns=("Año",))


def test_changes_need_a_plain_measure(star):
    with pytest.raises(ValueError, match="neither summed nor counted"):
        evaluate(star, [], ["x"], changes={"x": Change("average_ticket", SALE_DAYS)})


def test_several_counts_at_once_are_those_of_each_alone(star):
    measures = ["customers", "orders", "products", "territories", "product_territory_pairs", "purchase_days", "sales", "calendar_days"]
    together = {r["Territorio"]: r for r in evaluate(star, ["Territorio"], measures).collect()}
    for m in measures:
        for r in evaluate(star, ["Territorio"], [m]).collect():
            assert together[r["Territorio"]][m] == r[m]
    assert together[None]["customers"] == len({r[2] for r in ROWS if r[3] is None})
    stored = Star(star.fact, star.dimensions, stored=True)
    assert {tuple(r) for r in evaluate(stored, ["Territorio"], measures).collect()} == {tuple(r) for r in together.values()}


def test_sets_are_exact_and_merge(spark):
    ids = [-40000, -32768, -1, 0, 1, 2, 32768, 32769, 70000, None]
    draw = random.Random(3)
    rows = [(g, h, draw.choice(ids)) for g in "ab" for h in (1, 2, None) for _ in range(12)]
    df = spark.createDataFrame(rows, "g string, h int, v long")
    sets = distinct_sets(df, ["g", "h"], "v")
    assert {tuple(r) for r in set_sizes(sets, ["g", "h"], "n").collect()} == {
        (g, h, len({v for a, b, v in rows if (a, b) == (g, h)})) for g, h, _ in rows
    }
    assert {tuple(r) for r in set_sizes(merged_sets(sets, ["g"]), ["g"], "n").collect()} == {
        (g, len({v for a, _, v in rows if a == g})) for g in "ab"
    }
    assert set_sizes(merged_sets(sets, []), [], "n").first()["n"] == len({v for _, _, v in rows})
    words = df.select("g", F.col("v").cast("string").alias("w"))
    assert {tuple(r) for r in set_sizes(distinct_sets(words, ["g"], "w"), ["g"], "n").collect()} == {
        (g, len({v for a, _, v in rows if a == g})) for g in "ab"
    }
    numbered = dense_ids(words, "w").orderBy("w").collect()
    assert [r["_id"] for r in numbered] == list(range(1, len(numbered) + 1))
    assert set_sizes(distinct_sets(df.limit(0), ["g"], "v"), ["g"], "n").count() == 0


def test_distinct_counts(spark):
    df = spark.createDataFrame([(1, "a"), (1, None), (None, "b"), (2, "a")], "x int, y string")
    assert distinct_counts(df, {"xs": ["x"], "ys": ["y"], "both": ["x", "y"]}).first().asDict() == {"rows": 4, "xs": 2, "ys": 2, "both": 2}
    assert distinct_counts(df.limit(0), {"xs": ["x"], "ys": ["y"]}, stored=True).first().asDict() == {"rows": 0, "xs": 0, "ys": 0}


@pytest.mark.parametrize("hierarchy", ["Calendar", "Fiscal", "Iso Week"])
def test_set_rollup_equals_the_rollup_of_rows(spark, hierarchy):
    days = spark.createDataFrame([(d, c, 1) for _, d, c, *_ in ROWS] + [(dt.date(2030, 1, 1), 1, 5)], "Date date, c long, n int")
    calendar = date_dim(spark, 2023, 2025, as_of=dt.date(2024, 6, 1))
    direct = hierarchy_rollup(days, calendar, hierarchy, {
        "n": F.sum("n"), "c": F.count_distinct("c") + F.max(F.col("c").isNull().cast("int")),
    })
    merged = set_rollup(day_sets(days, ["n"], "c"), calendar, hierarchy, ["n"], "c")
    assert set(merged.columns) == set(direct.columns)
    columns = [f"`{c}`" for c in direct.columns]
    assert {tuple(r) for r in merged.select(*columns).collect()} == {tuple(r) for r in direct.select(*columns).collect()}
    assert in_order(merged, hierarchy).first()["level"] == 0


def test_values_ask_the_smaller_table_first(spark, star):
    customers = spark.createDataFrame([(1, "a"), (2, "b"), (3, "c")], "ClienteKey long, NombreCliente string")
    keys = star.fact.select("ClienteKey")
    dimensions = {"Dim_Cliente": Dimension(customers, "ClienteKey", "ClienteKey")}
    with_blank = Star(star.fact, dimensions, key_sources={"ClienteKey": keys})
    assert {r[0] for r in values_of(with_blank, "NombreCliente").collect()} == {"a", "b", "c", None}
    sound = Star(star.fact.dropna(subset=["ClienteKey"]), dimensions, key_sources={"ClienteKey": keys})
    assert {r[0] for r in values_of(sound, "NombreCliente").collect()} == {"a", "b", "c"}


@pytest.mark.parametrize("name", [
    "measures_total", "measures_by_territory", "measures_by_month_flat", "flat_repetition", "column_cardinality", "five_rollups",
    "time_measures_by_group_category", "counts_in_changed_views",
])
def test_no_row_is_repeated_per_counted_column(spark, name):
    assert "Expand" not in QUERIES[name](spark, SF_DIR)._jdf.queryExecution().executedPlan().toString()
