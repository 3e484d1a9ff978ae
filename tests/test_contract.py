"""Registered queries against their SQL, on the smallest tables."""

import os
import sys

import pytest

sys.path.insert(0, os.path.join(os.path.dirname(os.path.dirname(os.path.abspath(__file__))), "tools"))
import check  # noqa: E402

from __spark_entry__ import entry, oracle_sql, queries  # noqa: E402

QUICK = [
    "dedupe_first", "stratified_split", "repeated_folds", "group_zscore", "roc_auc_by_group", "grouped_precision_at_k",
    "clean_text", "split_lines", "model_text", "constraint_filter_strict", "score_requests", "rule_findings", "fault_ranges",
    "ks_drift", "telemetry_by_path", "char_wb_ngrams", "tfidf", "promotion_decision", "telemetry_windows",
    "production_auc", "stage_trace", "request_level_contract", "candidate_file_findings", "validation_warnings", "impute_encode",
    "word_ngrams", "tfidf_chars", "alert_verification", "numbered_ids",
]


def test_names():
    assert set(oracle_sql()) <= set(queries()) and set(QUICK) <= set(oracle_sql())


@pytest.mark.parametrize("name", QUICK)
def test_query_matches_sql(spark, sf, name):
    verdict, n, _ = check.compare(spark, check.connect(sf), name, sf)
    assert verdict == "ok" and n > 0


def test_entry(spark):
    assert entry(spark).count() == 1
