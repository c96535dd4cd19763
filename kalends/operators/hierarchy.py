"""Drill-down along the calendar's hierarchies, with a subtotal per level."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from kalends.operators.distinct import PART, SET, distinct_sets

# Hierarchy -> its levels, coarse to fine, each as (key column, label column).
# A label is ordered by its key: month names by month number, fiscal months by fiscal position.
HIERARCHIES = {
    "Calendar": [("Year", "Year"), ("Month", "Month Name"), ("Date", "Date")],
    "Fiscal": [("FiscalYear", "FiscalYear"), ("FiscalMonthNumber", "Fiscal Month Name"), ("Date", "Date")],
    "Calendar Week": [("Year", "Year"), ("Week of Year", "Week of Year"), ("Date", "Date")],
    "Fiscal Week": [("FiscalYear", "FiscalYear"), ("Fiscal Week of Year", "Fiscal Week of Year"), ("Date", "Date")],
    "Iso Week": [("IsoYear", "IsoYear"), ("IsoWeek", "IsoWeek"), ("Date", "Date")],
}


def hierarchy_rollup(
    rows: DataFrame, calendar: DataFrame, hierarchy: str, aggregates: dict[str, Column], depth: int | None = None
) -> DataFrame:
    """Evaluate ``aggregates`` for every level of a hierarchy and for the grand total.

    ``rows`` have a column ``Date`` and should already be reduced to what the aggregates
    need (day totals; or one row per day and customer, to count customers), since a roll-up
    repeats each row once per level. Aggregates are evaluated afresh on each level, so
    distinct counts and ratios come out right. ``level`` is 0 for the grand total; keys and
    labels below a subtotal's level are NULL. ``depth`` stops the drill-down early.
    """
    if hierarchy not in HIERARCHIES:
        raise ValueError(f"no hierarchy {hierarchy!r}; there are {sorted(HIERARCHIES)}")
    levels = HIERARCHIES[hierarchy][:depth]
    keys = [key for key, _ in levels]
    labels = {label: position for position, (key, label) in enumerate(levels, 1) if label != key}
    columns = [c for c in dict.fromkeys([*keys, *labels]) if c != "Date"]
    days = F.broadcast(calendar.select("Date", *[F.col(f"`{c}`") for c in columns]))
    described = rows.join(days, "Date", "left")
    level = F.lit(len(keys)) - F.bit_count(F.grouping_id())  # one bit per key, set where the key is rolled up
    rolled = described.rollup(*[F.col(f"`{k}`") for k in keys]).agg(
        level.alias("level"),
        *[F.max(f"`{label}`").alias(label) for label in labels],
        *[c.alias(name) for name, c in aggregates.items()],
    )
    return rolled.withColumns({
        label: F.when(F.col("level") >= position, F.col(f"`{label}`")) for label, position in labels.items()
    })


def day_sets(rows: DataFrame, additive: list[str], counted: str) -> DataFrame:
    """What roll-ups of many rows need of them, by ``Date``: sums, and the different values of ``counted`` as bitmaps.

    One table: rows without a part hold the sums, the others a bitmap. Store it to roll it up along several hierarchies.
    """
    sums = rows.groupBy("Date").agg(*[F.sum(c).alias(c) for c in additive])
    sets = distinct_sets(rows, ["Date"], counted)
    return sets.withColumn("_sums", F.lit(False)).unionByName(sums.withColumn("_sums", F.lit(True)), allowMissingColumns=True)


def set_rollup(days: DataFrame, calendar: DataFrame, hierarchy: str, additive: list[str], counted: str) -> DataFrame:
    """Sums and an exact distinct count (named ``counted``) for every level of a hierarchy and for the grand total.

    ``days`` come from ``day_sets``. Each level is merged from the one below it, so nothing but the day's own table is ever
    read, and no row is repeated per level. The result has the shape of ``hierarchy_rollup``'s.
    """
    if hierarchy not in HIERARCHIES:
        raise ValueError(f"no hierarchy {hierarchy!r}; there are {sorted(HIERARCHIES)}")
    levels = HIERARCHIES[hierarchy]
    keys = [key for key, _ in levels]
    labels = [label for key, label in levels if label != key]
    described = [c for c in dict.fromkeys([*keys, *labels]) if c != "Date"]
    below = days.join(F.broadcast(calendar.select("Date", *[F.col(f"`{c}`") for c in described])), "Date", "left")
    stacked = []
    for depth in range(len(levels), -1, -1):
        known = keys[:depth]
        shown = [label for position, (key, label) in enumerate(levels, 1) if label != key and position <= depth]
        names = [F.col(f"`{c}`") for c in known]
        kept = [F.max(f"`{c}`").alias(c) for c in shown]
        if depth < len(levels):
            below = below.groupBy(*names, PART, "_sums").agg(F.bitmap_or_agg(SET).alias(SET), *[F.sum(c).alias(c) for c in additive], *kept)
        level = below.groupBy(*names).agg(
            *[F.sum(c).alias(c) for c in additive],
            F.sum(F.when(~F.col("_sums"), F.bitmap_count(SET))).alias(counted), *kept,
        )
        stacked.append(level.withColumn("level", F.lit(depth)))
    return reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), stacked)


def in_order(rolled: DataFrame, hierarchy: str) -> DataFrame:
    """Sort a roll-up for display: by the hidden keys, each subtotal ahead of its detail."""
    keys = [k for k, _ in HIERARCHIES[hierarchy] if k in rolled.columns]
    return rolled.orderBy(*[F.col(f"`{k}`").asc_nulls_first() for k in keys], "level")
