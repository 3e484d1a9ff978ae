"""The pipeline's stages, each against plain code on its own input, and odd rows all the way through."""

import re
from collections import Counter

import numpy as np
import pytest
from pyspark.sql import functions as F

import corpus_pipeline as cp
from ladle.llm import decontaminate, pieces, ppm
from ladle.session import materialize
from tests.llm.test_decontaminate import everything
from tests.llm.test_minhash import brute as components

WORD = re.compile(r"[^\x20\x09-\x0D]+")


@pytest.fixture(scope="module")
def stages(spark, sf):
    """Input and output of every stage."""
    docs = spark.read.parquet(f"{sf}/documents.parquet")
    out = []
    for _, stage in cp.STAGES:
        new = materialize(stage(spark, docs, sf), "stage")
        out.append((docs, new))
        docs = new
    return out


def rows(df):
    return {r["doc_id"]: r for r in df.collect()}


def test_columns(stages):
    assert 4 <= len(cp.STAGES) <= 5
    for old, new in stages[:-1]:
        assert new.columns == old.columns and new.count() <= old.count()
    assert stages[-1][1].columns == [*stages[-1][0].columns, "ids"]


def test_language(stages):
    old, new = stages[0]
    told = ppm.detect(old).collect()
    assert set(rows(new)) == {r["doc_id"] for r in told if r["lang_pred"] != "und" and r["score"] >= cp.LEAST_SHARE}
    assert new.count() > 0.95 * old.where(F.col("text").rlike(r"\p{L}")).count()


def test_near_duplicates(stages):
    old, new = stages[1]
    want = {k for k, _, _, kept in components([(r["doc_id"], r["text"]) for r in old.collect()]) if kept}
    assert set(rows(new)) == want and rows(new) == {k: r for k, r in rows(old).items() if k in want}


def test_repeated_passages(stages):
    old, new = map(rows, stages[2])
    first: dict = {}
    for k, r in old.items():
        w = WORD.findall(r["text"] or "")
        for i in range(len(w) - 12):
            g = tuple(w[i : i + 13])
            first[g] = min(first.get(g, k), k)
    for k, r in old.items():
        w = WORD.findall(r["text"] or "")
        gone = {p for i in range(len(w) - 12) if first[tuple(w[i : i + 13])] < k for p in range(i, i + 13)}
        if gone and len(gone) == len(w):
            assert k not in new
            continue
        text = " ".join(x for p, x in enumerate(w) if p not in gone) if gone else r["text"]
        assert new[k]["text"] == text and new[k]["lang"] == r["lang"] and (not gone or new[k]["n_chars"] == len(text))


def test_benchmark_copies(stages, spark, sf):
    old, new = stages[3]
    items = [tuple(r) for r in spark.read.parquet(f"{sf}/benchmark.parquet").select("item_id", "text").collect()]
    found = everything([(r["doc_id"], r["text"]) for r in old.collect()], items)
    assert set(rows(new)) == {k for k, (n, _) in found.items() if not n}
    assert decontaminate.LEAST == 0.5


def test_encoding(stages):
    old, new = stages[4]
    e = pieces.load(cp.PIECES)
    assert set(rows(new)) == set(rows(old))
    assert all(e.decode(np.array(r["ids"], np.int32)) == r["text"] for r in new.collect() if r["text"] is not None)


def test_odd_rows_and_empty(spark, tmp_path, sf):
    kinds = spark.read.parquet(f"{sf}/documents.parquet").schema
    a = "the cat sat on the warm mat near the old door and slept all day"
    odd = [(1, a, "en", "s", 1), (2, None, None, None, None), (3, "", "en", "s", 0), (None, a + " then woke", "en", None, 5), (4, a, None, "s", 1), (1, a, "en", "s", 1), (5, "123", "en", "s", 3)]
    for name, data in (("odd", odd), ("none", [])):
        spark.createDataFrame(data, kinds).write.parquet(str(tmp_path / name / "documents.parquet"))
        spark.createDataFrame([(1, None), (2, "")], "item_id long, text string").write.parquet(str(tmp_path / name / "benchmark.parquet"))
    got = cp.run(spark, str(tmp_path / "odd")).collect()
    assert Counter(r["doc_id"] for r in got) == {1: 2, None: 1}
    assert cp.run(spark, str(tmp_path / "none")).count() == 0


def test_no_language_to_learn_from(spark, sf):
    """Texts stay where no row is labelled."""
    docs = spark.createDataFrame([(1, "some words", None), (2, "other words", None), (3, "123", None), (4, None, None)], "doc_id long, text string, lang string")
    assert {r["doc_id"] for r in cp.language(spark, docs, sf).collect()} == {1, 2}


def test_near_duplicates_go_by_row(spark, sf):
    """A text that shares its doc_id with a copy of another text is no copy itself."""
    a, z = (" ".join(f"{c}{i}" for i in range(40)) for c in "az")
    data = [(3, a), (7, a), (7, z), (9, z), (None, a), (8, None), (8, "")]
    docs = spark.createDataFrame([(*r, "en") for r in data], "doc_id long, text string, lang string")
    got = Counter((r["doc_id"], r["text"]) for r in cp.near_duplicates(spark, docs, sf).collect())
    assert got == Counter({(3, a): 1, (9, z): 1, (None, a): 1, (8, None): 1, (8, ""): 1})
    plain = docs.where("text = '" + a + "'")
    assert Counter(r["doc_id"] for r in cp.near_duplicates(spark, plain, sf).collect()) == Counter([3, None])
