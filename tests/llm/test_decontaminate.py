"""Decontamination: alignment against a plain table, results against aligning everything with everything, odd inputs."""

import numpy as np
import pyarrow as pa
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from ladle.llm import decontaminate as d
from ladle.llm.common import tokens


def plain(a, b):
    best, row = 0, [0] * (len(b) + 1)
    for x in a:
        new = [0]
        for j, y in enumerate(b):
            new.append(max(0, row[j] + (d.MATCH if x == y else d.PENALTY), row[j + 1] + d.PENALTY, new[j] + d.PENALTY))
        best, row = max(best, *new), new
    return best


seq = st.lists(st.integers(0, 3), max_size=12)


@given(seq, seq)
@settings(max_examples=200, deadline=None)
def test_alignment(a, b):
    assert d.align(np.array(a, np.uint64), np.array(b, np.uint64)) == plain(a, b)


def everything(docs, items):
    w = tokens(pa.array([t for _, t in docs], pa.string()), lower=True, punctuation=True)
    v = tokens(pa.array([t for _, t in items], pa.string()), lower=True, punctuation=True)
    out = {}
    for i, (key, _) in enumerate(docs):
        scores = []
        for j, (item, _) in enumerate(items):
            x = v.hashes[v.ptr[j] : v.ptr[j + 1]]
            if len(x):
                s = d.align(x, w.hashes[w.ptr[i] : w.ptr[i + 1]]) / (d.MATCH * len(x))
                if s >= d.LEAST:
                    scores.append((-s, item))
        out[key] = (len({i for _, i in scores}), min(scores)[1] if scores else None)
    return out


@pytest.mark.parametrize("block", [1 << 14, 20])
def test_against_all_pairs(spark, sf, monkeypatch, block):
    monkeypatch.setattr(d, "BLOCK_ITEMS", block)
    docs, items = spark.read.parquet(f"{sf}/documents.parquet").where("doc_id < 120"), spark.read.parquet(f"{sf}/benchmark.parquet")
    want = everything([(r[0], r[1]) for r in docs.select("doc_id", "text").collect()], [(r[0], r[1]) for r in items.select("item_id", "text").collect()])
    got = {r["doc_id"]: (r["n_items"], r["best_item"]) for r in d.contamination(docs, items).collect()}
    assert got == want and any(n for n, _ in got.values())


def test_edited_copies_and_odd_rows(spark):
    item = "when zorbing quaxels mimble the frandle of plorth gently under seven vexing moons at dusk"
    edited = "so it began. When zorbing quaxels, mimble a frandle of plorth softly under seven vexing moons! And more"
    rows = [(1, edited, 1), (2, "the of at under when and more so it began", 2), (3, None, 3), (4, "", 4), (5, item, 5), (5, item, 5), (None, item, 6), (7, "Hi there", 7)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, best_item int")
    bench = spark.createDataFrame([(9, item), (9, item), (8, None), (7, ""), (6, "hi")], "item_id long, text string")
    got = d.contamination(docs, bench).collect()
    assert sorted((r["doc_id"] or 0, r["contaminated"]) for r in got) == [(0, True), (1, True), (2, False), (3, False), (4, False), (5, True), (5, True), (7, True)]
    assert not any(r["contaminated"] for r in d.contamination(docs, bench.where("false")).collect())
    assert d.contamination(docs.where("false"), bench).count() == 0


def test_long_passage_of_a_longer_item(spark):
    """A passage is a copy by its own length, also where it is below LEAST of the item."""
    rng = np.random.default_rng(5)
    item = [f"v{x}" for x in rng.integers(0, 10**6, 500)]
    rows = [(1, " ".join(item[100:300])), (2, "so it is " + " ".join(item[7 : 7 + d.LEAST_WORDS])), (3, " ".join(item[50 : 50 + d.LEAST_WORDS - 1])), (4, "nothing of it")]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    bench = spark.createDataFrame([(1, " ".join(item))], "item_id long, text string")
    got = {r["doc_id"]: (r["contaminated"], r["best_score"]) for r in d.contamination(docs, bench).collect()}
    assert got == {1: (True, 0.4), 2: (True, d.LEAST_WORDS / 500), 3: (False, None), 4: (False, None)}
    assert {r["doc_id"] for r in d.clean(docs, bench).collect()} == {3, 4}


def test_copy_edited_in_its_one_rare_window(spark):
    """An item of frequent words and one name, copied without the name."""
    rng = np.random.default_rng(6)
    plain_words = [f"w{x}" for x in range(12)]
    text = [" ".join(rng.choice(plain_words, 20)) for _ in range(200)]
    item = rng.choice(plain_words, 30).tolist()
    docs = spark.createDataFrame([(-1, " ".join(["someone", *item])), *enumerate(text)], "doc_id long, text string")
    bench = spark.createDataFrame([(1, " ".join(["zorbel", *item]))], "item_id long, text string")
    got = d.contamination(docs, bench).where("doc_id = -1").first()
    assert got["contaminated"] and got["best_score"] == pytest.approx(30 / 31)


def test_items_without_id(spark):
    """A copy of an item without id is found; each such item counts, and a named item goes first among equal shares."""
    a = "alpha bravo charlie delta echo foxtrot golf hotel india juliet"
    b = "one two three four five six seven eight nine ten eleven"
    docs = spark.createDataFrame([(1, a), (2, b), (3, "nothing of the kind here"), (4, a + " " + b)], "doc_id long, text string")
    items = spark.createDataFrame([(None, a), (None, b), (7, b)], "item_id long, text string")
    got = {r["doc_id"]: (r["contaminated"], r["n_items"], r["best_item"]) for r in d.contamination(docs, items).collect()}
    assert got == {1: (True, 1, None), 2: (True, 2, 7), 3: (False, 0, None), 4: (True, 3, 7)}
    assert {r["doc_id"] for r in d.clean(docs, items).collect()} == {3}


def test_many_blocks(spark, sf, monkeypatch):
    """Blocks of three items find what one block finds, also when rows come from a shuffle."""
    docs = spark.read.parquet(f"{sf}/documents.parquet").repartition(5)
    items = spark.read.parquet(f"{sf}/benchmark.parquet").limit(12)
    cols = ["doc_id", "contaminated", "n_items", "best_item", "best_score"]
    whole = sorted(map(tuple, d.contamination(docs, items).select(*cols).collect()), key=repr)
    monkeypatch.setattr(d, "BLOCK_ITEMS", 3)
    parts = d.contamination(docs, items).select(*cols).collect()
    # Seeds depend on a block's own words only through their counts, which are the corpus's.
    assert sorted(map(tuple, parts), key=repr) == whole


def test_very_long_text_and_clashing_names(spark):
    text = "w " * 200000 + "alpha bravo charlie delta echo foxtrot golf"
    docs = spark.createDataFrame([(1, text, 5, 6, "x")], "doc_id long, text string, row long, n_items long, best_item string")
    items = spark.createDataFrame([(3, "alpha bravo charlie delta echo foxtrot golf", 1)], "item_id long, text string, row long")
    assert [(r["n_items"], r["best_item"]) for r in d.contamination(docs, items).collect()] == [(1, 3)]
    assert d.clean(docs, items).columns == docs.columns and d.clean(docs, items).count() == 0
