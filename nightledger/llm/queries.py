"""Registered queries of the operators on training text, and their SQL."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from nightledger.llm import byte_gru, cover_dedup, cover_tree, histogram_packing, jaccard_join, license_scan, max_sketch, nbsvm, quality_rules, secret_models, token_alignment, warc_index, winnow
from nightledger.llm.common import reachable


def _table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    reachable(spark)
    return spark.read.parquet(f"{folder}/{name}.parquet")


def op1_line_quality(spark: SparkSession, folder: str) -> DataFrame:
    return quality_rules.line_quality(_table(spark, folder, "documents"), with_text=False)


def op2_warc_index(spark: SparkSession, folder: str) -> DataFrame:
    return warc_index.archive_round_trip(_table(spark, folder, "pages"))


def op3_secret_models(spark: SparkSession, folder: str) -> DataFrame:
    docs = _table(spark, folder, "documents")
    return secret_models.scan(docs, secret_models.train(docs))


def op4_passage_dedup(spark: SparkSession, folder: str) -> DataFrame:
    return cover_dedup.without_repeats(_table(spark, folder, "documents"), with_text=False)


def op5_language_id(spark: SparkSession, folder: str) -> DataFrame:
    docs = _table(spark, folder, "documents")
    return byte_gru.languages(docs, byte_gru.train(docs))


def op6_decontamination(spark: SparkSession, folder: str) -> DataFrame:
    return winnow.decontaminate(_table(spark, folder, "documents"), _table(spark, folder, "benchmark"))


def op7_quality_nbsvm(spark: SparkSession, folder: str) -> DataFrame:
    docs = _table(spark, folder, "documents")
    return nbsvm.quality_scores(docs, nbsvm.train(docs, _table(spark, folder, "labels")))


def op8_best_fit_packing(spark: SparkSession, folder: str) -> DataFrame:
    return histogram_packing.pack(_table(spark, folder, "documents"))


def op9_jaccard_join(spark: SparkSession, folder: str) -> DataFrame:
    return jaccard_join.near_duplicates(_table(spark, folder, "documents"))


def op9_jaccard_links(spark: SparkSession, folder: str) -> DataFrame:
    return jaccard_join.link_numbers(_table(spark, folder, "documents"))


def op10_license_notices(spark: SparkSession, folder: str) -> DataFrame:
    return license_scan.license_notices(_table(spark, folder, "documents"))


def op11_token_alignment(spark: SparkSession, folder: str) -> DataFrame:
    return token_alignment.alignments(_table(spark, folder, "documents"), with_groups=False)


def op12_lexical_search(spark: SparkSession, folder: str) -> DataFrame:
    return max_sketch.search(_table(spark, folder, "documents"), _table(spark, folder, "benchmark"))


def op13_near_vectors(spark: SparkSession, folder: str) -> DataFrame:
    return cover_tree.near_vectors(_table(spark, folder, "embeddings"))


def registered() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    """Query name to a function of (session, folder of the parquet tables)."""
    return {
        "op1_line_quality": op1_line_quality,
        "op2_warc_index": op2_warc_index,
        "op3_secret_models": op3_secret_models,
        "op4_passage_dedup": op4_passage_dedup,
        "op5_language_id": op5_language_id,
        "op6_decontamination": op6_decontamination,
        "op7_quality_nbsvm": op7_quality_nbsvm,
        "op8_best_fit_packing": op8_best_fit_packing,
        "op9_jaccard_join": op9_jaccard_join,
        "op10_license_notices": op10_license_notices,
        "op11_token_alignment": op11_token_alignment,
        "op12_lexical_search": op12_lexical_search,
        "op13_near_vectors": op13_near_vectors,
    }


def oracle_sql() -> dict[str, str]:
    """The same results as SQL; models and searches with bounded errors have no SQL form."""
    return {
        "op1_line_quality": quality_rules.ORACLE,
        "op2_warc_index": warc_index.ORACLE,
        "op4_passage_dedup": cover_dedup.ORACLE,
        "op6_decontamination": winnow.ORACLE,
        "op9_jaccard_join": jaccard_join.ORACLE,
        "op12_lexical_search": max_sketch.ORACLE,
        "op13_near_vectors": cover_tree.ORACLE,
    }


def with_links() -> dict[str, tuple[Callable[[SparkSession, str], DataFrame], str]]:
    """Query and SQL of 9 with the number of links, which the columns of op9_jaccard_join leave out."""
    return {"op9_jaccard_links": (op9_jaccard_links, jaccard_join.ORACLE_LINKS)}
