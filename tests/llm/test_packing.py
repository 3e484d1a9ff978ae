"""Packing: pieces against the tokenizer, gapless sequences, number of sequences against the bound and plain best fit; odd inputs."""

import zlib
from collections import Counter, defaultdict

import numpy as np
import public_tokenizers as P
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from tokenizers import Tokenizer

from ladle.llm import packing as pk

PATH = P.path("word_bpe_49k.json")


def counts_of(lengths, capacity):
    return np.bincount(lengths, minlength=capacity + 1).astype(np.int64)


def plain_best_fit(lengths, capacity):
    free = []
    for x in sorted(lengths, reverse=True):
        fits = [f for f in free if f >= x]
        if fits:
            free.remove(min(fits))
            free.append(min(fits) - x)
        else:
            free.append(capacity - x)
    return len(free)


@given(st.lists(st.integers(1, 50), max_size=200))
@settings(max_examples=150, deadline=None)
def test_plan_holds_every_piece_once(lengths):
    counts = counts_of(lengths, 50)
    held = Counter()
    for pattern, n in pk.plan(counts, 50):
        assert 0 < sum(pattern) <= 50 and n > 0
        for v in pattern:
            held[v] += n
    assert held == Counter(lengths)


@given(st.lists(st.integers(1, 30), min_size=1, max_size=120))
@settings(max_examples=100, deadline=None)
def test_best_fit_by_counts_is_best_fit(lengths):
    assert sum(n for _, n in pk.best_fit(counts_of(lengths, 30), 30)) == plain_best_fit(lengths, 30)


def test_patterns_fill_a_row():
    got = {tuple(x for x in p if x) for p in pk.patterns(np.array([1, 3, 4, 5, 9, 10]), 10).tolist()}
    assert got == {(10,), (1, 9), (5, 5), (1, 4, 5), (3, 3, 4)}


def test_close_to_the_bound_and_no_worse_than_best_fit():
    rng = np.random.default_rng(5)
    for size in (300, 20000):
        lengths = np.minimum(rng.lognormal(6.2, 0.9, size).astype(int) + 1, 2048)
        used = sum(n for _, n in pk.plan(counts_of(lengths, 2048)))
        least = -(-int(lengths.sum()) // 2048)
        assert used <= least * 1.01 + 1
    fitted, times = pk.fit(counts_of(lengths, 2048), 2048)
    rounded, left = pk.rounded(fitted, times, counts_of(lengths, 2048))
    assert left.min() >= 0 and left.sum() < 0.25 * len(lengths) and rounded.sum() > 0


def check(rows, docs, capacity=2048):
    """Pieces hold each document's ids; sequences have no gaps and no overlap."""
    lib = Tokenizer.from_file(PATH)
    want = Counter()
    for key, text in docs:
        ids = np.array([*lib.encode(text or "", add_special_tokens=False).ids, 0], "<u4")
        for i, at in enumerate(range(0, len(ids), capacity)):
            part = ids[at : at + capacity]
            want[key, i, at, len(part), zlib.crc32(part.tobytes())] += 1
    assert Counter((r["doc_id"], r["piece"], r["start"], r["length"], r["ids_crc32"]) for r in rows) == want
    seqs = defaultdict(list)
    for r in rows:
        seqs[r["sequence_id"]].append((r["offset"], r["length"]))
    for places in seqs.values():
        at = 0
        for offset, length in sorted(places):
            assert offset == at
            at += length
        assert at <= capacity
    return len(seqs)


def test_whole_table(spark, sf):
    docs = spark.read.parquet(f"{sf}/documents.parquet").select("doc_id", "text")
    rows = pk.packed(docs, PATH).collect()
    used = check(rows, [tuple(r) for r in docs.collect()])
    assert used <= -(-sum(r["length"] for r in rows) // 2048) * 1.01 + 1
    assert sorted({r["sequence_id"] for r in rows}) == list(range(used))


def test_odd_rows(spark):
    data = [(1, None), (2, ""), (2, ""), (None, "no key"), (None, "no key"), (3, "word " * 30000), (4, "X" * 5000), (5, "<|endoftext|> a")]
    docs = spark.createDataFrame([(*r, 0, "c", 1) for r in data], "doc_id long, text string, piece int, length string, offset int")
    check(pk.packed(docs, PATH).collect(), data)
    assert pk.packed(docs.where("false"), PATH).count() == 0


def test_hot_length(spark):
    """Equal lengths in many tasks get places of their own."""
    docs = spark.range(3000).selectExpr("id AS doc_id", "CASE WHEN id % 3 > 0 THEN 'same text here' ELSE repeat('b ', id) END AS text").repartition(7)
    check(pk.packed(docs, PATH).collect(), [tuple(r) for r in docs.collect()])


def test_sequences_join_the_ids(spark):
    docs = spark.createDataFrame([(i, "a b c " * (i * 40)) for i in range(30)], "doc_id long, text string")
    done = pk.packed(docs, PATH, capacity=512, ids=True)
    rows = done.collect()
    cells = defaultdict(dict)
    for r in rows:
        cells[r["sequence_id"]][r["offset"]] = r["ids"]
    for r in pk.sequences(done).collect():
        assert len(r["ids"]) <= 4 * 512 and sorted(r["offsets"]) == r["offsets"]
    assert sum(len(r["ids"]) for r in pk.sequences(done).collect()) == sum(len(r["ids"]) for r in rows)
    assert {len(b"".join(c.values())) for c in cells.values()} == {len(r["ids"]) for r in pk.sequences(done).collect()}


@pytest.mark.parametrize("capacity", [1, 2, 5])
def test_small_capacity(capacity):
    counts = counts_of([1] * 7 + [capacity] * 3, capacity)
    chosen = pk.plan(counts, capacity)
    held = Counter()
    for pattern, n in chosen:
        for v in pattern:
            held[v] += n
    assert held == Counter([1] * 7 + [capacity] * 3)
