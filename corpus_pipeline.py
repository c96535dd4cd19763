"""Documents to packed training sequences: every stage takes the documents that its predecessor kept.

Every stage judges rows, not ids. Quality and language drop documents, near-duplicate removal keeps one of each group, repeat removal shortens
texts, and packing turns what is left into sequences. All stages but the last return the columns of documents.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from kalends.llm import langid, neardup, packing, quality, repeats
from kalends.llm.common import rows_with, table
from kalends.storage import materialise, temporary

#: Least share of its language that a text needs; text of which no language has this much is dropped.
LEAST_SHARE = 0.3
#: Bytes of a repeated passage that is taken out. 51 words of the documents' prose have 252 bytes at least.
PASSAGE_BYTES = 240


def _numbered(docs: DataFrame) -> DataFrame:
    """The rows with ``_row``, 128 bits of hashes of what the stages judge; only rows that agree in all of it share a number."""
    judged = [x for c in ("doc_id", "text", "lang", "source") for x in (F.col(c), F.col(c).isNull())]
    return docs.withColumn("_row", F.concat_ws("-", *[F.hex(F.xxhash64(F.lit(half), *judged)) for half in (1, 2)]))


def quality_rules(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The documents that pass the base rules and are no outliers in their language and source."""
    rows = _numbered(docs)
    kept = quality.outlier_verdicts(rows.withColumn("doc_id", F.col("_row"))).where("kept")
    return rows_with(rows, kept.select(F.col("doc_id").alias("_row")).distinct(), "_row").drop("_row")


def language_id(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The documents with a language that can be told."""
    rows = _numbered(docs)
    told = langid.labelled(rows, "_row").where((F.col("lang_pred") != langid.UNDETERMINED) & (F.col("score") >= LEAST_SHARE))
    return rows_with(rows, told.select("_row").distinct(), "_row").drop("_row")


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One row of every group of near duplicates, that with the least id."""
    return neardup.one_of_each(docs)


def repeated_passages(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The documents without the passages of ``PASSAGE_BYTES`` or more that occur more than once."""
    return repeats.without_repeats(docs, PASSAGE_BYTES)


def pack(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The pieces of all texts in sequences of 2048 tokens."""
    return packing.packed(docs)


STAGES = [
    ("quality", quality_rules), ("language", language_id), ("near_duplicates", near_duplicates),
    ("repeats", repeated_passages), ("packing", pack),
]

#: Learned and iterative stages cannot be told in SQL; tests hold them against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over the documents, each written as Parquet and read again by the next.

    What a stage writes besides its result goes when it ends. Columns that documents has besides its own are carried along; an
    empty table gives no rows; null and empty texts do not pass the first stage.
    """
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES:
        with temporary(spark, keep=lambda folder, name=name: f"/{name}-" in folder):
            docs = materialise(stage(spark, docs, sf_dir), name)
    return docs
