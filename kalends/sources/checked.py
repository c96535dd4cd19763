"""A comma-separated file read once, every row typed and every value that does not fit named with its line and reason.

The file is read as lines, so that a row with too few or too many fields, or a value of the wrong kind, can be told by its
place. A line is split, cast and judged once; accepted and rejected rows are filters of the same result.
"""

from __future__ import annotations

from functools import reduce
from operator import or_

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from kalends.operators.joins import broadcast_if_small

#: What a reader is told of a rejected value.
REASONS = {"fields": "wrong number of fields", "whole": "not a whole number", "number": "not a number", "range": "too large for the column",
           "day": "not a date or time"}
_WHOLE, _NUMBER = r"^\s*[+-]?[0-9]+\s*$", r"^\s*[+-]?([0-9]+\.?[0-9]*|\.[0-9]+)([eE][+-]?[0-9]+)?\s*$"


def _reason(value: Column, kind: T.DataType) -> Column:
    """Why a present value is no value of the type."""
    if isinstance(kind, (T.ByteType, T.ShortType, T.IntegerType, T.LongType)):
        return F.when(value.rlike(_WHOLE), REASONS["range"]).otherwise(REASONS["whole"])
    if isinstance(kind, (T.DecimalType, T.FloatType, T.DoubleType)):
        return F.when(value.rlike(_NUMBER), REASONS["range"]).otherwise(REASONS["number"])
    return F.lit(REASONS["day"])


def _evaluated_once(value: Column) -> Column:
    """``value`` as a row generator of one row. Filters are not moved below generators, so they do not repeat what it takes to compute it."""
    return F.explode(F.array(value))


def read_checked_csv(spark: SparkSession, path: str, schema: T.StructType) -> DataFrame:
    """The columns of ``schema`` with its types, and ``_rejects``: an array of (column, value, reason), empty for sound rows.

    An empty field is a missing value. Quotes are ordinary characters, as in ``read_flat_csv``. The first line of every
    file must name the columns in order. ``_file``, ``_block`` and ``_at`` say where the row stands (see
    ``rejected_rows``). A row with the wrong number of fields has the fields it has, and one reject without a column.
    """
    names = schema.fieldNames()
    lines = spark.read.text(path).select(
        "value", F.col("_metadata.file_path").alias("_file"), F.col("_metadata.file_block_start").alias("_block"),
        F.monotonically_increasing_id().alias("_at"),
    )
    is_header = (F.col("_block") == 0) & (F.col("value") == ",".join(names))
    given = lines.where(~is_header).select("*", _evaluated_once(F.split("value", ",", -1)).alias("_fields"))

    def field(i: int) -> Column:
        value = F.get("_fields", F.lit(i))
        return F.when(value != "", value)

    typed = given.select(*[field(i).try_cast(f.dataType).alias(f.name) for i, f in enumerate(schema.fields)], "value", "_fields", "_file", "_block", "_at")
    wrong = [(F.size("_fields") != len(names), F.lit(None).cast("string"), F.col("value"), F.lit(REASONS["fields"]))] + [
        (field(i).isNotNull() & F.col(f"`{f.name}`").isNull(), F.lit(f.name), field(i), _reason(field(i), f.dataType))
        for i, f in enumerate(schema.fields) if not isinstance(f.dataType, T.StringType)
    ]
    listed = F.array_compact(F.array(*[
        F.when(found, F.struct(column.alias("column"), value.alias("value"), reason.alias("reason"))) for found, column, value, reason in wrong
    ]))
    # Most rows are sound: they are told by their nulls, and no list is put together for them.
    unsound = reduce(or_, [F.coalesce(found, F.lit(False)) for found, *_ in wrong])
    rejects = _evaluated_once(F.when(unsound, listed).otherwise(F.array().cast("array<struct<column: string, value: string, reason: string>>")))
    return typed.select(*[F.col(f"`{c}`") for c in names], rejects.alias("_rejects"), "_file", "_block", "_at")


def accepted_rows(checked: DataFrame) -> DataFrame:
    """The rows without a reject, with the declared columns only."""
    return checked.where(F.size("_rejects") == 0).drop("_rejects", "_file", "_block", "_at")


def rejected_rows(checked: DataFrame, path: str) -> DataFrame:
    """file, line, column, value and reason of every rejected value; the header is line 1.

    A line's number is its place in its block of the file plus the lines of the blocks before. Blocks are counted once more,
    without looking into the lines; both readings split the files alike.
    """
    spark = checked.sparkSession
    blocks = spark.read.text(path).select(
        F.col("_metadata.file_path").alias("_file"), F.col("_metadata.file_block_start").alias("_block"),
        F.monotonically_increasing_id().alias("_at"),
    ).groupBy("_file", "_block").agg(F.min("_at").alias("_first"), F.count(F.lit(1)).alias("_lines"))
    before = Window.partitionBy("_file").orderBy("_block").rowsBetween(Window.unboundedPreceding, -1)
    blocks = blocks.select("_file", "_block", "_first", F.coalesce(F.sum("_lines").over(before), F.lit(0)).alias("_before"))
    rejects = checked.where(F.size("_rejects") > 0).select("_file", "_block", "_at", F.inline("_rejects"))
    return rejects.join(broadcast_if_small(blocks), ["_file", "_block"]).select(
        F.element_at(F.split("_file", "/"), -1).alias("file"), (F.col("_before") + F.col("_at") - F.col("_first") + 1).alias("line"),
        "column", "value", "reason",
    )
