"""Compacting dates into ranges (gaps and islands)."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F


def date_islands(df: DataFrame, keys: list[str], date_col: str) -> DataFrame:
    """Runs of consecutive days per key, as ``first_day`` and ``last_day``.

    Days are made distinct first, which already shrinks on the map side, so a key that owns
    a large share of the rows still enters the window with no more rows than there are days.
    """
    days = df.select(*keys, F.to_date(date_col).alias("day")).dropna(subset=["day"]).distinct()
    within_key = Window.partitionBy(*keys).orderBy("day")
    return (
        days.withColumn("run", F.date_sub("day", F.row_number().over(within_key)))
        .groupBy(*keys, "run")
        .agg(F.min("day").alias("first_day"), F.max("day").alias("last_day"))
        .drop("run")
    )


def date_ranges_text(df: DataFrame, keys: list[str], date_col: str, name: str = "ranges") -> DataFrame:
    """The days of each key as text: ``first-last,`` for a run, ``day,`` for a lone day, in date order.

    Dates are written in ISO form. The list collected per key is bounded by the number of days.
    """
    piece = F.concat(
        F.col("first_day").cast("string"),
        F.when(F.col("first_day") < F.col("last_day"), F.concat(F.lit("-"), F.col("last_day").cast("string")))
        .otherwise(""),
        F.lit(","),
    )
    pieces = F.array_sort(F.collect_list(F.struct("first_day", piece.alias("text"))))
    return date_islands(df, keys, date_col).groupBy(*keys).agg(
        F.array_join(F.transform(pieces, lambda p: p["text"]), "").alias(name)
    )
