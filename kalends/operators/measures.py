"""Named measures, and their evaluation by any columns of a star or a flat table.

A measure is additive, or counts different values, or spans first to last day, or is computed from others, or
evaluates another measure in a changed view (last year's sales). Different values are counted one set of columns at a
time: the fact is reduced to the combinations of its grouping keys and the counted columns, by a hash aggregate that
combines before the shuffle, and only what is left meets the dimensions. No fact row is ever repeated per counted column.
"""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass, replace
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from kalends.functions.scalars import blank_minus, safe_div
from kalends.operators import context as C
from kalends.operators.context import Change, Where
from kalends.operators.filters import non_blank
from kalends.operators.joins import Star, broadcast_if_small, star_join
from kalends.storage import materialise


@dataclass(frozen=True)
class Fields:
    """Which columns of the fact the measures read."""

    amount: str
    order: str
    date: str
    customer: str
    product: str
    territory: str


FLAT_FIELDS = Fields("LineTotal", "SalesOrderNumber", "OrderDate", "ClienteID", "ProductoID", "TerritorioID")
STAR_FIELDS = Fields("LineTotal", "SalesOrderNumber", "FechaKey", "ClienteKey", "ProductoKey", "TerritorioKey")

# Measures that can be summed from partial results.
ADDITIVE: dict[str, Callable[[Fields], Column]] = {
    "sales": lambda f: F.sum(f"`{f.amount}`"),
    "lines": lambda f: F.count(F.lit(1)),
}
# Measures that count different combinations of columns. A missing value counts as one more distinct value.
COUNTED: dict[str, Callable[[Fields], list[Column]]] = {
    "customers": lambda f: [F.col(f.customer)],
    "products": lambda f: [F.col(f.product)],
    "territories": lambda f: [F.col(f.territory)],
    "orders": lambda f: [F.col(f.order)],
    "purchase_days": lambda f: [_day(f)],
    "product_territory_pairs": lambda f: [F.col(f.product), F.col(f.territory)],
}
# Measures of the first and the last date.
SPAN: dict[str, Callable[[Column, Column], Column]] = {
    "calendar_days": lambda first, last: F.datediff(last, first) + 1,
}
# Measures computed from others.
DERIVED: dict[str, tuple[list[str], Callable[[], Column]]] = {
    "average_ticket": (["sales", "orders"], lambda: safe_div("sales", "orders")),
    "days_without_purchase": (
        ["calendar_days", "purchase_days"], lambda: F.col("calendar_days") - F.col("purchase_days")
    ),
}
# Measures of sales in a changed view: ``ly`` through the calendar; on the days matching the days with sales, with the other
# filters kept or all of them dropped; and of the whole year before.
CHANGED: dict[str, Change] = {
    "ly": Change("sales", C.SAME_PERIOD),
    "ly_sparse": Change("sales", C.SALE_DAYS),
    "ly_sparse_all": Change("sales", C.SALE_DAYS, C.ALL),
    "ly_full_year": Change("sales", C.FULL_YEAR),
}


def _compared(form: str) -> dict[str, tuple[list[str], Callable[[], Column]]]:
    """The comparisons of this year's sales with one form of last year's."""
    ly = f"ly{form}"
    return {
        f"yoy{form}": (["sales", ly], lambda: blank_minus("sales", ly)),
        f"yoy_pct{form}": (["sales", ly], lambda: safe_div(blank_minus("sales", ly), ly)),
        f"parallel{form}": ([ly], lambda: F.col(ly)),
    }


for _form in ("", "_sparse", "_sparse_all", "_full_year"):
    DERIVED |= _compared(_form)


def _day(f: Fields) -> Column:
    """The sale day; an integer key is as good as a date for counting."""
    return F.col(f.date) if f.date.endswith("Key") else F.to_date(f.date)


def _as_date(f: Fields, value: Column) -> Column:
    """A day or an aggregated date, read back from the integer key where the fact has one (keys sort like dates)."""
    return F.to_date(value.cast("string"), "yyyyMMdd") if f.date.endswith("Key") else F.to_date(value)


def _expand(measures: list[str], changes: dict[str, Change]) -> list[str]:
    """The measures needed for ``measures`` that are not computed from others."""
    base: dict[str, None] = {}
    for measure in measures:
        if measure in DERIVED:
            base.update(dict.fromkeys(DERIVED[measure][0]))
        elif measure in ADDITIVE or measure in COUNTED or measure in SPAN or measure in changes:
            base[measure] = None
        else:
            known = sorted([*ADDITIVE, *COUNTED, *SPAN, *DERIVED, *changes])
            raise ValueError(f"no measure {measure!r}; there are {known}")
    return list(base)


def _named(columns: list[str]) -> list[Column]:
    return [F.col(f"`{c}`") for c in columns]


def _finish(grouped: DataFrame, by: list[str], measures: list[str]) -> DataFrame:
    derived = {m: DERIVED[m][1]() for m in measures if m in DERIVED}
    out = grouped.withColumns(derived) if derived else grouped
    return non_blank(out.select(*_named(by), *_named(measures)), measures)


def _reduced(star: Star, fact: DataFrame, by: list[str], extra: list[Column], partial: dict[str, Column], merged: dict[str, Column]) -> DataFrame:
    """One row per combination of ``by`` and ``extra`` (aliased columns of the fact), with merged aggregates.

    The fact is reduced to its own keys first; the dimensions that own a column of ``by`` are joined to what is left.
    """
    owners = {c: star.owner_of(c) for c in by}
    keys = list(dict.fromkeys(c if o is None else star.dimensions[o].fact_key for c, o in owners.items()))
    columns = [*_named(keys), *extra]
    grouped = fact.groupBy(*columns).agg(*[c.alias(n) for n, c in partial.items()]) if partial else fact.select(*columns).distinct()
    if not any(owners.values()):
        return grouped
    names = [*by, *grouped.columns[len(keys): len(keys) + len(extra)]]
    joined = star_join(star, by, grouped)
    if not merged:
        return joined.select(*_named(names)).distinct()
    return joined.groupBy(*_named(names)).agg(*[c.alias(n) for n, c in merged.items()])


def _partials(base: list[str], fields: Fields) -> tuple[dict[str, Column], dict[str, Column]]:
    """Aggregates of fact rows for additive measures and first and last dates, and what merges them."""
    partial = {m: ADDITIVE[m](fields) for m in base if m in ADDITIVE}
    merged = {m: F.sum(m) for m in partial}
    if any(m in SPAN for m in base):
        partial |= {"_first": F.min(f"`{fields.date}`"), "_last": F.max(f"`{fields.date}`")}
        merged |= {"_first": F.min("_first"), "_last": F.max("_last")}
    return partial, merged


def _summed(rows: DataFrame, by: list[str], base: list[str], merged: dict[str, Column], fields: Fields, *more: Column) -> DataFrame:
    """``by`` and its measures, from partial results."""
    out = rows.groupBy(*_named(by)).agg(*[c.alias(n) for n, c in merged.items()], *more)
    spans = {m: SPAN[m](_as_date(fields, F.col("_first")), _as_date(fields, F.col("_last"))) for m in base if m in SPAN}
    return out.withColumns(spans).drop("_first", "_last") if spans else out


def _plain(star: Star, fact: DataFrame, by: list[str], base: list[str], fields: Fields) -> list[DataFrame]:
    """Unchanged measures as tables of ``by`` and some of the measures each; together they have them all."""
    counted = [m for m in base if m in COUNTED]
    partial, merged = _partials(base, fields)
    parts = []
    for measure in counted:
        values = [c.alias(f"_n{i}") for i, c in enumerate(COUNTED[measure](fields))]
        number = F.count(F.lit(1)).alias(measure)
        if len(counted) == 1:  # one pass for everything: partial sums ride along with the combinations
            rows = _reduced(star, fact, by, values, partial, merged)
            return [_summed(rows, by, base, merged, fields, number)]
        parts.append(_reduced(star, fact, by, values, {}, {}).groupBy(*_named(by)).agg(number))
    if partial:
        parts.append(_summed(_reduced(star, fact, by, [], partial, merged), by, base, merged, fields))
    return parts


def _same(left: DataFrame, right: DataFrame, pairs: list[tuple[str, str]]) -> Column:
    """NULL-safe equality, so that the blank member meets itself."""
    return reduce(lambda a, b: a & b, [left[f"`{l}`"].eqNullSafe(right[f"`{r}`"]) for l, r in pairs], F.lit(True))


def _changed(star: Star, by: list[str], name: str, change: Change, where: Where, fields: Fields) -> DataFrame:
    """``by`` and one measure in its changed view."""
    base = change.base
    if base not in ADDITIVE and base not in COUNTED:
        raise ValueError(f"{name!r} changes the view of {base!r}, which is neither summed nor counted")
    replaced = change.days is not None
    if replaced and fields.date in by and not star.is_date(fields.date):
        raise ValueError(f"{name!r} replaces days: group by columns of the calendar, or name {fields.date!r} among the star's date columns")
    date_by = [c for c in by if replaced and star.is_date(c)]
    kept = [c for c in by if c not in date_by and not change.drops(c)]
    values = [c.alias(f"_n{i}") for i, c in enumerate(COUNTED[base](fields))] if base in COUNTED else []
    counted = [f"_n{i}" for i in range(len(values))]
    partial, merged = _partials([base], fields)
    fact = C.in_view(star, C.kept_filters(star, where, change))
    full_year = change.days == C.FULL_YEAR
    day = [_day(fields).alias("_key")] if replaced else []
    rows = _reduced(star, fact, kept, [*day, *values], partial, merged)
    if replaced:
        rows = rows.withColumn("_key", F.year(_as_date(fields, F.col("_key"))) if full_year else _as_date(fields, F.col("_key")))
        if full_year:
            columns = _named([*kept, "_key", *counted])
            rows = rows.groupBy(*columns).agg(*[c.alias(n) for n, c in merged.items()]) if merged else rows.select(*columns).distinct()
        if change.days == C.SAME_PERIOD:
            days, link = C.same_period_days(star, date_by, where), []
            days = F.broadcast(days)  # a few rows for each day of the calendar
        else:
            seen = _reduced(star, C.in_view(star, where), by, [_day(fields).alias("_day")], {}, {})
            seen = seen.withColumn("_day", _as_date(fields, F.col("_day")))
            days = C.year_before_last_sale(seen, by) if full_year else C.sale_days_last_year(seen, by)
            link = kept
        found = [c for c in by if c in days.columns]
        days = days.select(*[F.col(f"`{c}`").alias(f"_by{by.index(c)}") for c in found], F.col("_year" if full_year else "_day").alias("_when"))
        rows = rows.select(*[F.col(f"`{c}`").alias(f"_own{by.index(c)}") for c in kept], "_key", *counted, *merged)
        rows = rows.join(days, _same(rows, days, [("_key", "_when"), *[(f"_own{by.index(c)}", f"_by{by.index(c)}") for c in link]]))
        rows = rows.select(
            *[F.col(f"_by{by.index(c)}" if c in found else f"_own{by.index(c)}").alias(c) for c in by if c in found or c in kept],
            *counted, *merged,
        )
    known = [c for c in by if c in rows.columns]
    if counted:
        out = rows.select(*_named([*known, *counted])).distinct().groupBy(*_named(known)).agg(F.count(F.lit(1)).alias(name))
    else:
        out = rows.groupBy(*_named(known)).agg(F.sum(base).alias(name))
    if len(known) == len(by):
        return out
    # a dropped column of the result itself: each of its values in view gets the value found without it
    cells = _reduced(star, C.in_view(star, where), by, [], {}, {})
    side = out.select(*[F.col(f"`{c}`").alias(f"_at{by.index(c)}") for c in known], name)
    if not known:
        return cells.withColumn(name, side.scalar())
    return cells.join(side, _same(cells, side, [(c, f"_at{by.index(c)}") for c in known]), "left").select(*_named(by), name)


def _read_once(star: Star, by: list[str], where: Where, fields: Fields, changes: list[Change]) -> Star:
    """The star around the columns of its fact that are needed, written once: every pass then reads a few of them.

    Filters that hold for all measures are applied before; the others are left to the passes.
    """
    common = {
        c: t for c, t in where.items()
        if not any(change.drops(c) or (change.days is not None and star.is_date(c)) for change in changes)
    }
    columns = [*by, *where]
    keys = [c if star.owner_of(c) is None else star.dimensions[star.owner_of(c)].fact_key for c in columns]
    used = [*keys, fields.amount, fields.order, fields.date, fields.customer, fields.product, fields.territory]
    fact = C.in_view(star, common).select(*_named([c for c in dict.fromkeys(used) if c in star.fact.columns]))
    return replace(star, fact=materialise(fact, "measured"), stored=True)


def measure_rows(
    rows: DataFrame, by: list[str], measures: list[str], fields: Fields = FLAT_FIELDS, where: Where | None = None,
    date_columns: tuple[str, ...] = (), stored: bool = False,
) -> DataFrame:
    """Evaluate measures on one table (a flat one, or a fact already joined), one row per group.

    ``date_columns`` are those that say when; measures that replace the days in view drop filters on them.
    """
    return evaluate(Star(rows, {}, date_columns=date_columns, stored=stored), by, measures, where, fields)


def evaluate(
    star: Star,
    by: list[str],
    measures: list[str],
    where: Where | None = None,
    fields: Fields = STAR_FIELDS,
    changes: dict[str, Change] | None = None,
) -> DataFrame:
    """Evaluate measures by columns of any table of the star; all-blank rows are dropped.

    Only the dimensions that own a column of ``by`` are joined. ``where`` maps a column to a
    test of it; a test on a dimension keeps the fact rows of the members that pass (a semi
    join). The fact is first reduced to one row per combination of the keys in use (and of the counted
    columns): the join then sees each key a bounded number of times, however many fact rows it has.
    ``changes`` adds measures that evaluate others in a changed view to those of ``CHANGED``.
    """
    known = CHANGED | (changes or {})
    base = _expand(measures, known)
    where = where or {}
    plain = [m for m in base if m not in known]
    changed = [known[m] for m in base if m in known]
    if not star.stored and (changed or sum(m in COUNTED for m in plain) > 1):
        star = _read_once(star, by, where, fields, changed)
    parts = _plain(star, C.in_view(star, where), by, plain, fields) if plain else []
    parts += [_changed(star, by, m, known[m], where, fields) for m in base if m in known]
    if len(parts) == 1:
        return _finish(parts[0], by, measures)
    # Every part has at most one row per group; equal groups, the blank ones too, meet in one aggregate.
    stacked = reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), parts)
    return _finish(stacked.groupBy(*_named(by)).agg(*[F.max(m).alias(m) for m in base]), by, measures)


def values_of(star: Star, column: str) -> DataFrame:
    """The different values of a dimension column, plus one blank if fact rows lack a member.

    Keys without a member are looked for in the smaller table of ``key_sources`` where there is one, with the members
    as a filter and before anything is shuffled; the fact is only asked if such keys exist.
    """
    owner = star.owner_of(column)
    if owner is None:
        return star.fact.select(column).distinct()
    dimension = star.dimensions[owner]
    values = dimension.rows.select(column)
    members = dimension.side([], dimension.fact_key)
    orphans = star.key_sources.get(dimension.fact_key, star.fact).select(dimension.fact_key).join(members, dimension.fact_key, "left_anti")
    if dimension.fact_key in star.key_sources:
        if orphans.isEmpty():
            return values.distinct()
        keys = broadcast_if_small(orphans.distinct().select(F.col(dimension.fact_key).alias("_orphan")))
        orphans = star.fact.join(keys, star.fact[dimension.fact_key].eqNullSafe(keys["_orphan"]), "left_semi")
    blank = orphans.limit(1).select(F.lit(None).cast(dimension.rows.schema[column].dataType).alias(column))
    return values.unionByName(blank).distinct()


def _groups(star: Star, by: list[str], bought: DataFrame) -> DataFrame:
    """The groups that ``by`` can name: all members of its dimension, and what the sales name besides."""
    named = bought.select(*[F.col(f"`{c}`") for c in by])
    owners = {star.owner_of(c) for c in by}
    owner = owners.pop() if len(owners) == 1 else None
    if owner is not None:
        named = star.dimensions[owner].rows.select(*[F.col(f"`{c}`") for c in by]).unionByName(named)
    return named.distinct()


def days_without_purchase(star: Star, calendar: DataFrame, by: list[str], periods: list[str]) -> DataFrame:
    """Calendar days on which a group bought nothing, counted over the calendar and not over the sales.

    ``periods`` are columns of ``calendar``: each period spans its own first to last day. A
    period in which nobody bought counts in full. Columns of one dimension give a row for each
    of its members in every period, bought or not; columns of several tables, or of the fact, give one
    for each combination that was ever sold.
    """
    bought = evaluate(star, [*by, *periods], ["purchase_days"])
    span = calendar.groupBy(*periods).agg((F.datediff(F.max("Date"), F.min("Date")) + 1).alias("calendar_days"))
    if not by:
        joined = span.join(bought, periods, "left") if periods else bought.withColumn("calendar_days", span.scalar())
    else:
        # Periods are bounded by the calendar's days: one array of them, read off beside every group.
        spans = span.agg(F.collect_list(F.struct(*[F.col(f"`{c}`") for c in span.columns])))
        wanted = _groups(star, by, bought).withColumn("_span", F.explode(spans.scalar())).select(
            *[F.col(f"`{c}`") for c in by], "_span.*"
        )
        keys = [*by, *periods]
        found = bought.select(*[F.col(f"`{c}`").alias(f"_{i}") for i, c in enumerate(keys)], "purchase_days")
        same = [wanted[f"`{c}`"].eqNullSafe(found[f"_{i}"]) for i, c in enumerate(keys)]
        joined = wanted.join(found, same, "left")
    joined = joined.fillna(0, ["purchase_days"])
    return joined.select(
        *by, *periods, "purchase_days",
        (F.col("calendar_days") - F.col("purchase_days")).alias("days_without_purchase"),
    )
