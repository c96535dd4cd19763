"""Small helpers that several operators of this subpackage share."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

#: The characters that end a word: blank, tab, line feed, vertical tab, form feed, carriage return.
SPACES = " \t\n\x0b\x0c\r"
SPACE_CLASS = r"[\x20\x09-\x0D]+"


def table(spark: SparkSession, sf_dir: str, name: str, *columns: str) -> DataFrame:
    """A table of the folder; with ``columns``, only those (an extra column of any name stays out)."""
    df = spark.read.parquet(f"{sf_dir}/{name}.parquet")
    return df.select(*columns) if columns else df


def words_of(text: Column) -> Column:
    """The words ``[^\\x20\\x09-\\x0D]+`` of a text, in order; an empty array for null or blank text."""
    trimmed = F.btrim(F.coalesce(text, F.lit("")), F.lit(SPACES))
    return F.when(F.length(trimmed) == 0, F.array().cast("array<string>")).otherwise(F.split(trimmed, SPACE_CLASS, -1))


def rows_with(documents: DataFrame, chosen: DataFrame, key: str = "doc_id") -> DataFrame:
    """The rows of ``documents`` whose key is in ``chosen``, unchanged; a null key matches a null key."""
    keys = chosen.select(F.col(key).alias("_chosen"))
    return documents.join(keys, documents[key].eqNullSafe(keys["_chosen"]), "left_semi")


def lower_ascii(text: Column) -> Column:
    """The text with A-Z, and no other letter, in lower case."""
    return F.translate(text, "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def bucket_of_id(doc_id: Column, modulus: int) -> Column:
    """crc32 of the id as text, modulo ``modulus``: the fixed folds of labelled rows; -1 for a null id."""
    return F.coalesce(F.crc32(doc_id.cast("string").cast("binary")) % modulus, F.lit(-1))
