"""Joins between facts, dimensions, calendars and histories.

A dimension is broadcast only after its rows were counted (or when its size is bounded by
construction, as a calendar's is). Otherwise the join is a shuffled one, in which adaptive
execution splits a hot key over several tasks. Two tables that both grow with the business,
such as order lines and order headers, are never broadcast at all.
"""

from __future__ import annotations

from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


# A dimension of at most this many rows is sent to every executor.
BROADCAST_ROWS = 200_000
# One of a key and a single short value may have so many times as many.
NARROW = 2


def is_small(counted: DataFrame) -> bool:
    """Whether a count finds few enough rows for a broadcast."""
    return counted.count() <= BROADCAST_ROWS


def broadcast_if_small(side: DataFrame, counted: DataFrame | None = None, *, narrow: bool = False) -> DataFrame:
    """Mark ``side`` for broadcast if a count finds few enough rows, otherwise leave it to a shuffle.

    The count decides before the large side is shuffled, and from rows instead of a guess:
    Spark's own estimate for a flattened snowflake is the product of the sizes joined. Give
    ``counted`` when another table is known to have at least as many rows and is cheaper to
    count; a plain Parquet table is counted from its file footers. ``narrow`` says that the side
    has a key and one short value only, so that more rows of it are still small.
    """
    rows = (side if counted is None else counted).count()
    return F.broadcast(side) if rows <= BROADCAST_ROWS * (NARROW if narrow else 1) else side


def join_growing(left: DataFrame, right: DataFrame, key: str, how: str = "inner") -> DataFrame:
    """Join two tables that both grow without bound: sort-merge, whatever the estimates say."""
    return left.hint("merge").join(right, key, how)


@dataclass(frozen=True)
class Dimension:
    """A table with one row per ``key``, reached from column ``fact_key`` of the fact.

    ``bounded`` says that its size is limited by construction. ``counted`` is a cheaper
    table to count instead, with at least as many rows.
    """

    rows: DataFrame
    key: str
    fact_key: str
    bounded: bool = False
    counted: DataFrame | None = None

    def side(self, columns: list[str], key_name: str) -> DataFrame:
        """The key and some columns, ready to be joined to a fact."""
        return self._sized(self.rows.select(F.col(self.key).alias(key_name), *[F.col(f"`{c}`") for c in columns]))

    def members(self, condition: Column) -> DataFrame:
        """The keys, under the fact's name for them, of the rows that satisfy a condition."""
        return self._sized(self.rows.filter(condition).select(F.col(self.key).alias(self.fact_key)))

    def _sized(self, side: DataFrame) -> DataFrame:
        return F.broadcast(side) if self.bounded else broadcast_if_small(side, self.counted)


@dataclass(frozen=True)
class Star:
    """A fact and its dimensions.

    ``calendar`` names the dimension that holds the days (in a column ``Date``); ``date_columns`` are columns of the
    fact itself that say when, such as a flat table's year and month. ``stored`` says that the fact can be read column by
    column at little cost, as a written table can. ``key_sources`` has, for keys of the fact, a smaller table with at
    least the fact's values of that key.
    """

    fact: DataFrame
    dimensions: dict[str, Dimension]
    calendar: str = "Fecha"
    date_columns: tuple[str, ...] = ()
    stored: bool = False
    key_sources: dict[str, DataFrame] = field(default_factory=dict)

    def is_date(self, column: str) -> bool:
        """Whether a filter on ``column`` is a filter on the days in view."""
        return column in self.date_columns or self.owner_of(column) == self.calendar

    def owner_of(self, column: str) -> str | None:
        """The dimension that carries ``column``; None when the fact itself does.

        A dimension's attributes come first, then the fact's columns, then keys that only a
        dimension has.
        """
        carriers = [name for name, dimension in self.dimensions.items() if column in dimension.rows.columns]
        attribute_of = [name for name in carriers if column != self.dimensions[name].key]
        if attribute_of:
            return attribute_of[0]
        if column in self.fact.columns:
            return None
        if carriers:
            return carriers[0]
        raise ValueError(f"no table of the star has a column {column!r}")


def star_join(star: Star, columns: list[str], fact: DataFrame | None = None) -> DataFrame:
    """The fact with the named dimension columns beside it.

    Only the dimensions that own one of the columns are joined. Fact rows without a
    matching member are kept, with NULL in the dimension's columns.
    """
    joined = star.fact if fact is None else fact
    wanted: dict[str, list[str]] = {}
    for column in columns:
        owner = star.owner_of(column)
        if owner is not None:
            wanted.setdefault(owner, []).append(column)
    for owner, owned in wanted.items():
        dimension = star.dimensions[owner]
        side = dimension.side(list(dict.fromkeys(owned)), f"_{owner}_key")
        # A column of the same name on the fact gives way to the dimension's.
        joined = joined.drop(*[c for c in owned if c != dimension.fact_key])
        joined = joined.join(side, joined[dimension.fact_key] == side[f"_{owner}_key"], "left").drop(f"_{owner}_key")
    return joined


def join_on_date(left: DataFrame, left_col: str, right: DataFrame, right_col: str, how: str = "left") -> DataFrame:
    """Join on the day of both columns, ignoring any time of day."""
    return left.join(right, F.to_date(left[left_col]) == F.to_date(right[right_col]), how)


def join_history_naive(flat: DataFrame, history: DataFrame, flat_key: str, history_key: str) -> DataFrame:
    """Join a one-to-many history straight onto the fact rows.

    This is the trap, kept as an operator so that it can be shown: each fact row comes out
    once per history row of its key, and every sum grows with it.
    """
    periods = history.select(*[F.col(c).alias(f"Historial{c}") for c in history.columns])
    return flat.join(periods, flat[flat_key] == periods[f"Historial{history_key}"])


def aggregate_through_join(
    fact: DataFrame, fact_key: str, other: DataFrame, other_key: str, sums: dict[str, str], *,
    by_fact: list[str] | None = None, by_other: list[str] | None = None, count: str = "rows", how: str = "inner",
) -> DataFrame:
    """Row count and sums over an equality join, by columns of both sides, without making the join's rows.

    ``sums`` names the result and the column of ``fact`` to be summed. Each side is reduced per key (and its own grouping
    columns) first; a key's sums are then multiplied by its number of partners. The join meets one row per key and
    group of either side, however often a key occurs.
    """
    by_fact, by_other = by_fact or [], by_other or []
    left = fact.groupBy(F.col(fact_key).alias("_key"), *[F.col(c).alias(f"_f{i}") for i, c in enumerate(by_fact)]).agg(
        F.count(F.lit(1)).alias("_rows"), *[F.sum(c).alias(f"_s{i}") for i, c in enumerate(sums.values())]
    )
    right = other.groupBy(F.col(other_key).alias("_key"), *[F.col(c).alias(f"_o{i}") for i, c in enumerate(by_other)]).agg(
        F.count(F.lit(1)).alias("_partners")
    )
    partners = F.coalesce("_partners", F.lit(1))  # a left join keeps a row without a partner once

    def times(column: str) -> Column:
        product = F.col(column) * partners
        return product.cast("decimal(38,4)") if left.schema[column].dataType.typeName() == "decimal" else product

    groups = [F.col(f"_f{i}").alias(c) for i, c in enumerate(by_fact)] + [F.col(f"_o{i}").alias(c) for i, c in enumerate(by_other)]
    return left.join(right, "_key", how).groupBy(*groups).agg(
        F.coalesce(F.sum(F.col("_rows") * partners), F.lit(0)).alias(count),
        *[F.sum(times(f"_s{i}")).alias(name) for i, name in enumerate(sums)],
    )


def dim_with_history(dimension: DataFrame, history: DataFrame, key: str) -> DataFrame:
    """Hang a history on its dimension: one row per member and period, members without one kept.

    History columns that the dimension also has come out as ``Historial...``.
    """
    periods = history.select(key, *[
        F.col(c).alias(f"Historial{c}" if c in dimension.columns else c) for c in history.columns if c != key
    ])
    return dimension.join(periods, key, "left")


@dataclass(frozen=True)
class DateRole:
    """One way a calendar relates to a fact: through ``fact_col``, by default or on request."""

    name: str
    fact_col: str
    active: bool = False


def active_role(roles: list[DateRole]) -> DateRole:
    """The one role used by default; exactly one must be marked active."""
    active = [r for r in roles if r.active]
    if len(active) != 1:
        raise ValueError(f"exactly one role must be active, found {[r.name for r in active]}")
    return active[0]


def by_role(
    fact: DataFrame, calendar: DataFrame, roles: list[DateRole], columns: list[str], use: str | None = None
) -> DataFrame:
    """The fact with calendar ``columns`` looked up through the active role, or through ``use``."""
    role = active_role(roles)
    if use is not None:
        named = {r.name: r for r in roles}
        if use not in named:
            raise ValueError(f"no role {use!r}; the fact has {sorted(named)}")
        role = named[use]
    side = calendar.select(F.col("Date").alias("_day"), *[F.col(f"`{c}`") for c in columns])
    return join_on_date(fact, role.fact_col, F.broadcast(side), "_day").drop("_day")
