"""Substring dedup against brute force, the covering property of the anchors, odd inputs."""

import hashlib
import re

import pytest
from pyspark.sql import functions as F

from ladle.llm import exchange, substrings

WORD = re.compile(r"[^\x20\x09-\x0D]+")


def brute(rows, window=13):
    first: dict = {}
    words = [(k, WORD.findall(t or "")) for k, t in rows]
    for k, w in words:
        for i in range(len(w) - window + 1) if k is not None else ():
            g = tuple(w[i : i + window])
            first[g] = min(first.get(g, k), k)
    out = []
    for k, w in words:
        gone = set()
        for i in range(len(w) - window + 1) if k is not None else ():
            if first[tuple(w[i : i + window])] < k:
                gone |= set(range(i, i + window))
        kept = " ".join(x for i, x in enumerate(w) if i not in gone)
        out.append((k, len(w), len(gone), hashlib.sha256(kept.encode()).hexdigest()))
    return sorted(out, key=str)


def test_cover():
    """Whatever two alignments remain modulo the period, some shift brings both into the cover."""
    p = substrings.PERIOD
    assert all(any((i + t) % p in substrings.COVER and (j + t) % p in substrings.COVER for t in range(p)) for i in range(p) for j in range(p))


@pytest.mark.parametrize("window", [7, 13])
def test_random_overlaps(spark, window):
    import random

    rng = random.Random(window)
    passages = [[f"p{n}w{i}" for i in range(rng.randint(5, 40))] for n in range(12)]
    rows = []
    for k in range(120):
        words = []
        for _ in range(rng.randint(0, 5)):
            words += [f"u{rng.random()}" for _ in range(rng.randint(0, 9))]
            p = rng.choice(passages)
            a = rng.randint(0, len(p) - 1)
            words += p[a : a + rng.randint(1, 30)] * rng.choice([1, 1, 2])
        rows.append((rng.choice([k, k, -k, k // 2]), rng.choice([" ", "\n", " \t "]).join(words)))
    got = substrings.remove_repeats(spark.createDataFrame(rows, "doc_id long, text string"), window)
    assert sorted((tuple(r) for r in got.drop("kept_text").collect()), key=str) == brute(rows, window)


def test_odd_rows(spark):
    long = " ".join(f"w{i}" for i in range(3000))
    rows = [(3, long), (1, long), (1, long), (None, long), (4, None), (5, ""), (6, "a b"), (7, "x " * 40), (8, "x " * 13)]
    docs = spark.createDataFrame([(*r, "s") for r in rows], "doc_id long, text string, found string")
    got = substrings.remove_repeats(docs, keep=("doc_id", "found"))
    assert sorted((tuple(r)[:5] for r in got.select("doc_id", "n_words", "n_removed", "kept_sha256", "kept_text").collect()), key=str)
    assert sorted((tuple(r) for r in got.select("doc_id", "n_words", "n_removed", "kept_sha256").collect()), key=str) == brute(rows)
    assert {r["row"]["found"] for r in got.collect()} == {"s"} and sorted(str(r["text"]) for r in got.collect()) == sorted(str(r[1]) for r in rows)
    assert substrings.remove_repeats(docs.where("false")).count() == 0
    with pytest.raises(ValueError):
        substrings.remove_repeats(docs, window=5)


def test_hot_key_costs_two_entries_a_batch(spark):
    """A key that every document holds is settled within a batch; only its ends go on."""
    import numpy as np

    docs = np.repeat(np.arange(100), 3)
    keys = np.tile(np.array([7, 8, 9], np.uint64), 100)
    _, found, ends = exchange._shared(docs, keys, first_too=True)
    assert found.all() and ends.sum() == 6
    _, found, ends = exchange._shared(docs, keys, first_too=False)
    assert (~found).sum() == 3 and ends.sum() == 3


def test_names_do_not_matter(spark):
    docs = spark.createDataFrame([(1, "a " * 20), (2, "a " * 20)], "k long, body string").withColumn("bucket", F.lit(1))
    got = {r["doc_id"]: r["n_removed"] for r in substrings.remove_repeats(docs, key="k", text="body").collect()}
    assert got == {1: 0, 2: 20}
