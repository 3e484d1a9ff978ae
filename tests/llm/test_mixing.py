"""Language-model scores: base counts against brute force, a proper class distribution, gain on held-out rows, odd inputs."""

import math
import re
import zlib
from collections import Counter

import numpy as np
import pytest

from ladle.llm import mixing

WORD = re.compile(r"[^\x20\x09-\x0D]+")


def words(text):
    low = re.sub("[A-Z]", lambda m: m[0].lower(), text or "")
    return [*WORD.findall(low), None]


def test_classes_add_up_to_one():
    rng = np.random.default_rng(1)
    model = {"stretch": rng.normal(0, 2, (mixing.CONTEXTS - 1, mixing.SLOTS)).astype(np.float32), "map": rng.random((mixing.CLASS_BITS, mixing.MAP_STEPS)).astype(np.float32),
             "weights": rng.normal(0.3, 0.2, mixing.START.shape).astype(np.float32)}
    after_two = rng.normal(0, 2, (3, mixing.CLASSES)).astype(np.float32)
    total = 0.0
    for c in range(mixing.CLASSES):
        cls, ptr = np.array([5, 9, c], np.int32), np.array([0, 3])
        slots, _ = mixing._slots(cls, ptr)
        third = np.stack([after_two[t, slots[0, t]] for t in range(3)])
        total += 2 ** mixing._mixed(model, cls, ptr, third)[2]
    assert total == pytest.approx(1, abs=1e-3)


def test_base_score_and_gain(spark, sf):
    docs = spark.read.parquet(f"{sf}/documents.parquet")
    got = {r["doc_id"]: r for r in mixing.score(docs).collect()}
    rows = docs.select("doc_id", "text").collect()
    fold = {r[0]: zlib.crc32(str(r[0]).encode()) % 10 for r in rows}
    counts = Counter(w for r in rows if fold[r[0]] for w in words(r[1]))
    n, v = sum(counts.values()), len(counts)
    assert len(got) == len(rows)
    gain = []
    for i, text in rows:
        own = words(text)
        want = sum(math.log10((counts[w] + 0.1) / (n + 0.1 * (v + 1))) for w in own)
        g = got[i]
        assert g["base_score"] == pytest.approx(want, rel=1e-9)
        assert (g["n_tokens"], g["n_known"], g["train_tokens"]) == (len(own), sum(counts[w] > 0 for w in own), n)
        assert g["held_out"] == (fold[i] == 0)
        if g["held_out"]:
            gain.append(g["score"] - g["base_score"])
    assert sum(gain) > 0


def test_odd_rows(spark):
    docs = spark.createDataFrame([(1, None, 1), (2, "", 2), (3, "a b", 3), (3, "a b", 3), (None, "c " * 3000, 4), (4, "x" * 5000, 5)], "doc_id long, text string, score int")
    got = mixing.score(docs).collect()
    assert sorted((r["doc_id"] or 0, r["n_tokens"]) for r in got) == [(0, 3001), (1, 1), (2, 1), (3, 3), (3, 3), (4, 2)]
    assert all(math.isfinite(r["score"]) for r in got)
    assert mixing.score(docs.where("false")).count() == 0


def steps(text):
    """Contexts and value of each bit of a text's classes."""
    h, _ = mixing._with_end(mixing.tokens(mixing.pa.array([text]), lower=True))
    cls = [None, None, *mixing._classes(h).tolist()]
    for a, b, c in zip(cls, cls[1:], cls[2:], strict=False):
        for k in range(mixing.CLASS_BITS):
            start = (k, c >> (mixing.CLASS_BITS - k))
            yield ((start,), (b, start), (a, b, start)), (c >> (mixing.CLASS_BITS - 1 - k)) & 1


def test_contexts_share_no_counts(spark):
    """Scores against plain counts of every context. No document has remainder 9, so weights and map are what they start as."""
    rng = np.random.default_rng(3)
    keep = [i for i in range(3000) if zlib.crc32(str(i).encode()) % 10 != 9][:1500]
    texts = {i: " ".join(f"w{x}" for x in rng.integers(0, 4000, 150)) for i in keep}
    docs = spark.createDataFrame(list(texts.items()), "doc_id long, text string")
    got = {r["doc_id"]: r["score"] for r in mixing.score(docs).collect()}

    bits, tokens, words_of, class_n = Counter(), Counter(), {}, Counter()
    for i, text in texts.items():
        fold = zlib.crc32(str(i).encode()) % 10
        if fold == 0:
            continue
        h, _ = mixing._with_end(mixing.tokens(mixing.pa.array([text]), lower=True))
        for x, c in zip(h.tolist(), mixing._classes(h).tolist(), strict=True):
            tokens[x] += 1
            class_n[c] += 1
            words_of.setdefault(c, set()).add(x)
        for contexts, bit in steps(text):
            bits.update((c, bit) for c in contexts)
    grid = np.linspace(-8, 8, mixing.MAP_STEPS)
    for i in keep[:20]:
        want = 0.0
        for contexts, bit in steps(texts[i]):
            s = sum(math.log((bits[c, 1] + mixing.PRIOR) / (bits[c, 0] + mixing.PRIOR)) for c in contexts) / mixing.CONTEXTS
            p = 0.5 * (mixing._squash(s) + np.interp(s, grid, mixing._squash(grid)))
            want += math.log10(p if bit else 1 - p)
        h, _ = mixing._with_end(mixing.tokens(mixing.pa.array([texts[i]]), lower=True))
        for x, c in zip(h.tolist(), mixing._classes(h).tolist(), strict=True):
            want += math.log10((tokens[x] + mixing.ALPHA) / (class_n[c] + mixing.ALPHA * (len(words_of.get(c, ())) + 1)))
        assert got[i] == pytest.approx(want, rel=1e-4)


def test_score_is_a_function_of_the_table(spark, sf):
    docs = spark.read.parquet(f"{sf}/documents.parquet")
    one, many = ({r["doc_id"]: r["score"] for r in mixing.score(docs.repartition(n)).collect()} for n in (1, 16))
    assert one.keys() == many.keys()
    for k in one:
        assert one[k] == pytest.approx(many[k], rel=1e-6, abs=1e-6)


def test_weights_and_map_against_plain_newton(spark):
    """The same steps over plain counts, in one piece."""
    rng = np.random.default_rng(5)
    texts = {i: " ".join(f"w{min(x, y)}" for x, y in rng.integers(0, 60, (80, 2))) for i in range(300)}
    texts[7] = None
    known = mixing.learn(spark.createDataFrame(list(texts.items()), "doc_id long, text string").repartition(3))
    fold = {i: zlib.crc32(str(i).encode()) % 10 for i in texts}
    bits = Counter()
    for i, text in texts.items():
        if 0 < fold[i] < 9:
            for contexts, bit in steps(text or ""):
                bits.update((c, bit) for c in contexts)
    x, y = [], []
    for i, text in texts.items():
        if fold[i] == 9:
            for contexts, bit in steps(text or ""):
                x.append([*(math.log((bits[c, 1] + mixing.PRIOR) / (bits[c, 0] + mixing.PRIOR)) for c in contexts), 0.3])
                y.append(bit)
    x, y = np.array(x).reshape(-1, mixing.CLASS_BITS, 4), np.array(y, float).reshape(-1, mixing.CLASS_BITS)
    w = mixing.START.astype(float)
    for _ in range(mixing.ROUNDS):
        for b in range(mixing.CLASS_BITS):
            p = 1 / (1 + np.exp(-(x[:, b] @ w[b])))
            g = x[:, b].T @ (p - y[:, b]) + mixing.RIDGE * (w[b] - mixing.START[b])
            w[b] -= np.linalg.inv(x[:, b].T @ (x[:, b] * (p * (1 - p))[:, None]) + mixing.RIDGE * np.eye(4)) @ g
    assert known.model["weights"] == pytest.approx(w, abs=2e-3)
    ones, tries = np.zeros((mixing.CLASS_BITS, mixing.MAP_STEPS)), np.zeros((mixing.CLASS_BITS, mixing.MAP_STEPS))
    for b in range(mixing.CLASS_BITS):
        j = np.rint((np.clip(x[:, b] @ w[b], -8, 8) + 8) * 2).astype(int)
        np.add.at(ones[b], j, y[:, b])
        np.add.at(tries[b], j, 1)
    want = (ones + 8 * mixing._squash(np.linspace(-8, 8, mixing.MAP_STEPS))) / (tries + 8)
    assert np.abs(known.model["map"] - want).mean() < 2e-3  # a few bits lie on the edge of two steps


def test_long_text_and_clashing_names(spark):
    docs = spark.createDataFrame([(i, "a b c d " * (50000 if i == 3 else 5), 1, 2, 3) for i in range(30)], "doc_id long, text string, fold int, n_bytes int, base long")
    got = {r["doc_id"]: r for r in mixing.score(docs).collect()}
    assert got[3]["n_tokens"] == 200001 and all(math.isfinite(r["score"]) for r in got.values())


def test_answers_send_what_bits_leave_aside():
    """Answers come back whole, and are shorter than the counts along every bit."""
    rng = np.random.default_rng(3)
    table = np.unique((rng.integers(0, 4000, 60_000) << mixing.CLASS_BITS) | rng.integers(0, mixing.CLASSES, 60_000))
    counts = rng.zipf(1.5, len(table)).clip(max=5000).astype(np.int64)
    t = np.unique(np.r_[table[::2], (rng.integers(0, 5000, 3000) << mixing.CLASS_BITS) | rng.integers(0, mixing.CLASSES, 3000)])
    n = mixing._paths(table, counts, t)
    raw = mixing._pack_paths(n, t)
    assert (mixing._unpack_paths(raw, t) == n).all()
    whole = sum(len(mixing._squeeze(n[k][mixing._starts(t, k)])) for k in range(mixing.CLASS_BITS + 1))
    print(len(raw), whole)
    assert len(raw) < 0.8 * whole
