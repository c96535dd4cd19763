"""The numbered queries over the test tables, with their SQL where SQL can say the same."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from kalends.llm import alignment, annsearch, codec, langid, lexical, neardup, packing, pieces, quality, repeats, sharding, toxicity, urls
from kalends.llm.common import table

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLES: dict[str, str] = {}


def query(sql: str | None = None):
    """Register a function under its name, with its SQL where there is one."""
    def register(build):
        QUERIES[build.__name__] = build
        if sql:
            ORACLES[build.__name__] = sql
        return build
    return register


@query()
def op1_robust_outliers(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality.outlier_verdicts(table(spark, sf_dir, "documents", "doc_id", "text", "lang", "source"))


@query()
def op2_kmeans_tree_neighbours(spark: SparkSession, sf_dir: str) -> DataFrame:
    return annsearch.nearest(table(spark, sf_dir, "embeddings", "vec_id", "embedding"))


@query(sql=neardup.SQL)
def op3_chosen_path_neardup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return neardup.components(table(spark, sf_dir, "documents", "doc_id", "text"))


@query()
def op4_ftrl_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    return toxicity.scored(table(spark, sf_dir, "documents", "doc_id", "text"), table(spark, sf_dir, "labels", "doc_id", "toxic"))


@query(sql=urls.SQL)
def op5_digest_array_urls(spark: SparkSession, sf_dir: str) -> DataFrame:
    return urls.judged(table(spark, sf_dir, "pages", "page_id", "url"))


@query()
def op6_interval_tree_repeats(spark: SparkSession, sf_dir: str) -> DataFrame:
    return repeats.removal(table(spark, sf_dir, "documents", "doc_id", "text"))


@query()
def op7_sum_of_squares_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packing.packed(table(spark, sf_dir, "documents", "doc_id", "text"))


@query()
def op8_virtual_slots(spark: SparkSession, sf_dir: str) -> DataFrame:
    return sharding.sharded(table(spark, sf_dir, "documents", "doc_id", "text"))


@query()
def op9_chain_field_language(spark: SparkSession, sf_dir: str) -> DataFrame:
    return langid.labelled(table(spark, sf_dir, "documents", "doc_id", "text", "lang"))


@query()
def op10_forced_boundary_codec(spark: SparkSession, sf_dir: str) -> DataFrame:
    return codec.digests(table(spark, sf_dir, "documents", "doc_id", "text"))


@query()
def op11_vectorised_merge_codec(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pieces.digests(table(spark, sf_dir, "documents", "doc_id", "text"))


@query(sql=lexical.SQL)
def op12_pipelined_term_ranking(spark: SparkSession, sf_dir: str) -> DataFrame:
    return lexical.ranked(table(spark, sf_dir, "documents", "doc_id", "text"), table(spark, sf_dir, "benchmark", "item_id", "text"))


@query()
def op13_shared_cut_alignment(spark: SparkSession, sf_dir: str) -> DataFrame:
    return alignment.aligned(table(spark, sf_dir, "documents", "doc_id", "text"))
