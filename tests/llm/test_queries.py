"""Registered queries of the package: names, contract columns, and those with SQL against DuckDB."""

import os
import sys

import pytest

sys.path.insert(0, os.path.join(os.path.dirname(os.path.dirname(os.path.dirname(os.path.abspath(__file__)))), "tools"))
import check  # noqa: E402

from __spark_entry__ import queries  # noqa: E402
from ladle.llm.queries import ORACLES, QUERIES  # noqa: E402

COLUMNS = {
    "op2_substring_dedup": "doc_id n_words n_removed kept_sha256",
    "op4_quality_rules": "doc_id n_words word_chars n_symbols n_dup_lines n_repeat_words base_failed kept",
    "op6_token_store": "doc_id start n_tokens ids_crc32",
    "op7_lm_scoring": "doc_id held_out n_tokens n_known train_tokens base_score score",
    "op9_language_id": "doc_id held_out lang_pred score",
    "op10_minhash_near_dedup": "doc_id n_shingles component_id kept",
    "op11_phrase_collocations": "lang rank phrase a l r n score",
    "op12_prefix_trie": "conv_id depth parent_conv_id n_convs n_children n_leaves saved_tokens ends_sha256",
}


def test_names():
    assert {k.split("_")[0] for k in QUERIES} == {*(f"op{n}" for n in range(1, 14)), "pipeline"}
    assert set(ORACLES) <= set(QUERIES) <= set(queries())


@pytest.mark.parametrize("name", [k for k in COLUMNS if k not in ORACLES])
def test_contract_columns(spark, sf, name):
    got = QUERIES[name](spark, sf)
    assert set(COLUMNS[name].split()) <= set(got.columns)
    assert got.count() == spark.read.parquet(f"{sf}/documents.parquet").count()


@pytest.mark.parametrize("name", sorted(ORACLES))
def test_query_matches_sql(spark, sf, name):
    verdict, n, _ = check.compare(spark, check.connect(sf), name, sf)
    assert verdict == "ok" and n > 0
