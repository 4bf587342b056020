"""Registered queries on training text: against their SQL, and the rest for columns and rows on the shared tables."""

import os

import pytest

import __spark_entry__ as entry
from nightledger.llm import queries
from tests.oracle_check import compare, connect

FOLDER = os.environ.get("ORACLE_SF_DIR", "/root/testdata/sf0.01")
QUERIES, SQL = queries.registered(), queries.oracle_sql()
COLUMNS = {
    "op1_line_quality": "doc_id n_words word_chars n_symbols n_dup_lines n_repeat_words base_failed kept",
    "op2_warc_index": "page_id payload_bytes payload_digest record_type refers_to",
    "op3_secret_models": "doc_id n_assign n_access n_hex base_sha256 spans",
    "op4_passage_dedup": "doc_id n_words n_removed kept_sha256",
    "op5_language_id": "doc_id held_out lang_pred score",
    "op6_decontamination": "doc_id n_words n_hit n_items items_sha256 contaminated",
    "op7_quality_nbsvm": "doc_id held_out score predicted",
    "op8_best_fit_packing": "doc_id piece start length ids_crc32 sequence_id offset",
    "op9_jaccard_join": "doc_id n_shingles component_id",
    "op10_license_notices": "doc_id n_words n_base first_word last_word base_labels labels score",
    "op11_token_alignment": "doc_id n_a n_b n_groups n_links n_best count_sum groups_sha256",
    "op12_lexical_search": "item_id rank doc_id score",
    "op13_near_vectors": "vec_id n_links component_id kept",
}


@pytest.fixture(scope="module")
def con():
    return connect(FOLDER)


@pytest.mark.parametrize("name", sorted(SQL))
def test_matches_sql(spark, con, name):
    assert compare(name, QUERIES[name], SQL[name], spark, FOLDER, con) is None


def test_all_are_registered_in_the_entry():
    assert set(COLUMNS) == set(QUERIES) <= set(entry.queries()) and "pipeline" in entry.queries()


@pytest.mark.parametrize("name", sorted(set(COLUMNS) - set(SQL)))
def test_columns_and_rows(spark, name):
    made = QUERIES[name](spark, FOLDER)
    assert made.columns[: len(COLUMNS[name].split())] == COLUMNS[name].split()
    docs = spark.read.parquet(f"{FOLDER}/documents.parquet")
    assert made.select("doc_id").distinct().count() == docs.count()


def test_held_out_accuracy(spark):
    """Language and quality of documents that no fit has seen."""
    docs = spark.read.parquet(f"{FOLDER}/documents.parquet")
    lang = QUERIES["op5_language_id"](spark, FOLDER).where("held_out").join(docs.select("doc_id", "lang"), "doc_id")
    n, right = lang.selectExpr("count(*)", "count_if(lang = lang_pred)").first()
    assert right >= 0.97 * n
    marks = spark.read.parquet(f"{FOLDER}/labels.parquet")
    quality = QUERIES["op7_quality_nbsvm"](spark, FOLDER).where("held_out").join(marks, "doc_id")
    n, right = quality.selectExpr("count(*)", "count_if(predicted = quality)").first()
    assert right >= 0.92 * n
