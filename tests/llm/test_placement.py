"""Placement: the filled table against turn-by-turn claims, balance, little movement, odd inputs."""

from collections import Counter

import pytest

from ladle.llm import placement as p

NAMES = [f"shard-{i:03d}" for i in range(24)]


def by_turns(shards, size):
    """Each shard's whole ranking, then turn by turn the best free slot."""
    ranks = [[(p._number(s, "offset") + i * (p._number(s, "skip") % (size - 1) + 1)) % size for i in range(size)] for s in shards]
    slots, turn = {}, 0
    while len(slots) < size:
        k = turn % len(shards)
        slots[next(x for x in ranks[k] if x not in slots)] = k
        turn += 1
    return [slots[i] for i in range(size)]


@pytest.mark.parametrize("size,n", [(2, 1), (13, 3), (251, 24), (251, 1)])
def test_fill(size, n):
    assert p.fill(NAMES[:n], size) == by_turns(NAMES[:n], size)


def test_balance_weights_and_movement():
    full = p.fill(NAMES)
    n = Counter(full)
    assert max(n.values()) - min(n.values()) <= 1
    less = p.fill(NAMES[:-1])
    moved = sum(a != b for a, b in zip(full, less, strict=True) if a != len(NAMES) - 1)
    assert moved < 0.1 * p.SIZE
    heavy = Counter(p.fill(NAMES[:3], 251, {NAMES[0]: 2}))
    assert abs(heavy[0] - 2 * heavy[1]) <= 2
    for bad in ([], ["a", "a"]):
        with pytest.raises(ValueError):
            p.fill(bad)
    with pytest.raises(ValueError):
        p.fill(["a"], 10)


def test_rows(spark, sf):
    docs = spark.read.parquet(f"{sf}/documents.parquet")
    got = p.place(docs.select("doc_id"), NAMES).collect()
    table = p.fill(NAMES)
    assert len(got) == docs.count() and all(r["shard"] == NAMES[table[r["slot"]]] for r in got)


def test_odd_rows(spark, tmp_path):
    docs = spark.createDataFrame([(1, "a", "x"), (1, "b", "y"), (None, "c", "z"), (None, "d", None)], "doc_id long, text string, shard string")
    got = p.place(docs, NAMES).collect()
    assert len(got) == 4 and got[0].asDict().keys() == {"doc_id", "text", "slot", "shard"}
    assert len({r["shard"] for r in got if r["doc_id"] == 1}) == len({r["slot"] for r in got if r["doc_id"] is None}) == 1
    assert len({r["slot"] for r in p.place(docs, NAMES, spread=["text"]).collect() if r["doc_id"] is None}) == 2
    assert p.place(docs.where("false"), NAMES).count() == 0
    p.write_placed(docs, str(tmp_path / "out"), NAMES)
    assert spark.read.parquet(str(tmp_path / "out")).count() == 4


def test_read_back(spark, tmp_path):
    """Each shard is a folder of its own, with whole texts; a very long one, too."""
    docs = spark.createDataFrame([(i, "text " * (i + 1) + ("x" * 2_000_000 if i == 3 else "")) for i in range(200)] + [(None, "a"), (None, None)], "doc_id long, text string")
    path = str(tmp_path / "placed")
    p.write_placed(docs, path, NAMES, spread=["text"])
    back = p.read_placed(spark, path, "doc_id long, text string")
    assert sorted(((r["doc_id"], r["text"]) for r in back.collect()), key=repr) == sorted(((r["doc_id"], r["text"]) for r in docs.collect()), key=repr)
    one = back.where("shard = 'shard-003'")
    assert {r["slot"] for r in one.collect()} == {r["slot"] for r in p.place(docs, NAMES, spread=["text"]).where("shard = 'shard-003'").collect()}
    p.write_placed(docs.where("false"), str(tmp_path / "none"), NAMES)
    assert p.read_placed(spark, str(tmp_path / "none"), "doc_id long, text string").count() == 0
