"""Near-duplicates against all pairs, components, odd inputs."""

import math
import random
import re

import numpy as np
import pytest

from ladle.llm import graph
from ladle.llm import tensor_minhash as t

WORD = re.compile(r"[^\x20\x09-\x0D]+")


def shingles(text):
    w = WORD.findall(re.sub("[A-Z]", lambda m: m[0].lower(), text or ""))
    return {tuple(w)} if 0 < len(w) < 5 else {tuple(w[i : i + 5]) for i in range(len(w) - 4)}


def brute(rows):
    sets = {k: shingles(x) for k, x in rows}
    up = {k: k for k in sets}

    def root(k):
        while up[k] != k:
            k = up[k]
        return k

    keys = sorted(sets)
    for i, a in enumerate(keys):
        for b in keys[:i]:
            both = len(sets[a] & sets[b])
            if both and 100 * both >= 75 * len(sets[a] | sets[b]):
                x, y = root(a), root(b)
                up[max(x, y)] = min(x, y)
    return sorted((k, len(sets[k]), root(k), root(k) == k) for k in keys)


def test_edited_copies(spark):
    """Groups of edited copies around one text, with many pairs close to the threshold."""
    rng = random.Random(5)
    rows, k = [], 0
    for size in (60, 25, 12, 3):
        base = [f"w{rng.randrange(5000)}" for _ in range(120)]
        for _ in range(size):
            words = list(base)
            for _ in range(rng.choice([0, 1, 2, 3, 4, 5, 6, 8])):
                words[rng.randrange(len(words))] = f"e{rng.random()}"
            rows.append((k * 7 % 1009, " ".join(words[: rng.choice([120, 120, 110])])))
            k += 1
    rows += [(2000 + i, " ".join(base[:60] + [f"z{rng.random()}" for _ in range(90)])) for i in range(30)]
    got = t.near_duplicates(spark.createDataFrame(rows, "doc_id long, text string")).drop("n_links").collect()
    assert sorted(tuple(r) for r in got) == brute(rows)


def test_odd_rows(spark):
    rows = [(9, "A b"), (4, "a  B"), (5, "a b c d"), (6, None), (7, ""), (8, None), (3, "x " * 4000), (2, "x " * 20), (1, "a b c d e f g"), (0, "a b c d e f h")]
    docs = spark.createDataFrame([(*r, 1) for r in rows] + [(None, "a b", 2), (4, "a  B", 3)], "doc_id long, text string, n int")
    got = t.near_duplicates(docs).drop("n_links").collect()
    assert len(got) == len(rows) + 2
    assert sorted({tuple(r) for r in got if r["doc_id"] is not None}) == brute(rows)
    assert [(r["component_id"], r["kept"]) for r in got if r["doc_id"] is None] == [(None, True)]
    assert t.near_duplicates(docs.where("false")).count() == 0


def test_bound_prunes_no_link():
    """The bits beyond a pivot never say less than two sets share."""
    rng = np.random.default_rng(3)
    for _ in range(300):
        pool = rng.integers(0, 2**63, 80).astype(np.uint64)
        p, x, y = (set(rng.choice(pool, rng.integers(1, 60), replace=False).tolist()) for _ in range(3))
        bits = [{(h >> 17) % t.BITS for h in s - p} for s in (x, y)]
        double = [len(s - p) - len(b) for s, b in zip((x, y), bits, strict=True)]
        extra = min(len(x - p), len(y - p), len(bits[0] & bits[1]) + min(double))
        assert len(x & y) <= min(len(x & p), len(y & p)) + extra


@pytest.mark.parametrize("edges,want", [
    ([], {}), ([(1, 1)], {}), ([(i, i + 1) for i in range(40)], {i: 0 for i in range(41)}),
    ([(0, i) for i in range(1, 30)] + [(50, 51), (51, 52), (None, 3)], {**{i: 0 for i in range(30)}, 50: 50, 51: 50, 52: 50}),
])
def test_components(spark, edges, want):
    got = graph.components(spark.createDataFrame(edges, "a long, b long")).collect()
    assert {r["node"]: r["component"] for r in got} == want and len(got) == len(want)


@pytest.mark.parametrize("percent", [50, 75, 90])
def test_sketches_rule_out_no_link(percent):
    """The binomial tail below the bound, written out for the pair at the threshold."""
    p = (1 + percent / 100) / 2
    tail = [math.comb(96, k) * p**k * (1 - p) ** (96 - k) for k in range(97)]
    bound = t._agree(percent)
    assert sum(tail[:bound]) <= 1e-8 < sum(tail[: bound + 1])
