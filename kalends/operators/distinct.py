"""Exact distinct counts: several columns without repeating rows, and sets that can be merged.

Counting several columns in one aggregate makes Spark repeat every row once per column. Here each column is
counted by a pass of its own, over a table that holds only the counted columns, with a hash aggregate that combines
before the shuffle.

Counts cannot be added up, sets can: ``distinct_sets`` packs the different values of a column into bitmaps of
32,768 ids each, which are merged to any coarser grouping without going back to the rows.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from kalends.operators.joins import broadcast_if_small
from kalends.operators.numbering import global_row_number
from kalends.storage import materialise

#: Columns of a table of sets: which 32,768 ids a bitmap is about (NULL for the missing value), and the bitmap.
PART, SET = "_part", "_set"


def distinct_counts(rows: DataFrame, columns: dict[str, list[str]], *, stored: bool = False) -> DataFrame:
    """``rows`` (their number) and, under each name, the number of different values of its columns, as one row.

    Rows in which one of a name's columns is missing do not count there. ``stored`` says that single columns of ``rows`` can be
    read at little cost; otherwise the counted columns are written once.
    """
    used = [c for c in dict.fromkeys(c for cs in columns.values() for c in cs)]
    if len(columns) > 1 and not stored:
        rows = materialise(rows.select(*[F.col(f"`{c}`") for c in used]), "counted")
    parts = [rows.agg(F.count(F.lit(1)).alias("rows"))]
    for name, own in columns.items():
        values = rows.select(*[F.col(f"`{c}`").alias(f"_{i}") for i, c in enumerate(own)]).dropna().distinct()
        parts.append(values.agg(F.count(F.lit(1)).alias(name)))
    stacked = reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), parts)
    return stacked.agg(*[F.max(c).alias(c) for c in ("rows", *columns)])


def dense_ids(values: DataFrame, column: str) -> DataFrame:
    """The different values of a column that are not missing, numbered 1..n in their order (``_id``)."""
    return global_row_number(values.select(column).where(F.col(f"`{column}`").isNotNull()).distinct(), [column], "_id")


def distinct_sets(rows: DataFrame, by: list[str], column: str) -> DataFrame:
    """The different values of ``column`` for each group, as bitmaps: ``by``, ``_part``, ``_set``.

    Whole numbers are their own ids; other values are numbered first. A missing value is one more value, in a part
    of its own. Rows are reduced to different combinations before any bitmap is built.
    """
    groups = [F.col(f"`{c}`") for c in by]
    pairs = rows.select(*groups, F.col(f"`{column}`").alias("_value")).distinct()
    if not isinstance(rows.schema[column].dataType, (T.LongType, T.IntegerType, T.ShortType, T.ByteType)):
        ids = broadcast_if_small(dense_ids(pairs, "_value"))
        pairs = pairs.join(ids, "_value", "left").select(*groups, F.col("_id").alias("_value"))
    bit = F.coalesce(F.bitmap_bit_position("_value"), F.lit(0).cast("long"))
    return pairs.groupBy(*groups, F.bitmap_bucket_number("_value").alias(PART)).agg(F.bitmap_construct_agg(bit).alias(SET))


def merged_sets(sets: DataFrame, by: list[str]) -> DataFrame:
    """The same sets for a coarser grouping."""
    return sets.groupBy(*[F.col(f"`{c}`") for c in by], PART).agg(F.bitmap_or_agg(SET).alias(SET))


def set_sizes(sets: DataFrame, by: list[str], name: str) -> DataFrame:
    """The number of different values in each group's set."""
    return sets.groupBy(*[F.col(f"`{c}`") for c in by]).agg(F.sum(F.bitmap_count(SET)).alias(name))
