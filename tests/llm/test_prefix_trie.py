"""Prefix trie against a brute force over plain lists; odd inputs; long conversations in stretches."""

import hashlib
import random
import zlib

import pytest

from ladle.llm import prefix_trie as pt

SCHEMA = "conv_id long, turn long, role string, text string, depth int, a string"


def digest(t):
    return hashlib.md5(f"{len(t[0].encode())}:{t[0]}{t[1]}".encode()).digest()


def brute(rows):
    convs = {}
    for c, turn, role, text, *_ in rows:
        if c is not None:
            convs.setdefault(c, []).append((turn is not None, turn or 0, (role or "", text or "")))
    own = {c: [t[2] for t in sorted(ts, key=lambda t: (t[0], t[1], digest(t[2])))] for c, ts in convs.items()}
    built = {}
    for c, ts in own.items():
        h = zlib.crc32(str(c).encode()) % 9
        donor = c - int(c - 5 * int(c / 5))
        built[c] = tuple(own.get(donor, [])[:h] + ts[h:])
    nodes = {}
    for c, s in built.items():
        for d in range(len(s) + 1):
            nodes.setdefault(s[:d], []).append(c)
    out = []
    for k, members in nodes.items():
        under = [x for x in nodes if x[: len(k)] == k]
        leaf = [x for x in under if not any(len(y) == len(x) + 1 and y[:-1] == x for y in under)]
        ends = sorted(c for c in members if len(built[c]) == len(k))
        out.append((
            min(members), len(k), min(nodes[k[:-1]]) if k else None, len(members), sum(len(x) == len(k) + 1 for x in under), len(leaf),
            sum((len(nodes[x]) - 1) * len(x[-1][1].encode()) for x in under if x), hashlib.sha256(",".join(map(str, ends)).encode()).hexdigest(),
        ))
    return sorted(out, key=repr)


def got(spark, rows):
    df = spark.createDataFrame([(*r, 1, "x") for r in rows], SCHEMA)
    cols = ["conv_id", "depth", "parent_conv_id", "n_convs", "n_children", "n_leaves", "saved_tokens", "ends_sha256"]
    return sorted((tuple(r) for r in pt.trie(df).select(*cols).collect()), key=repr)


def some(rng, n, texts, turns=12):
    rows = []
    for c in rng.sample(range(-40, 200), n):
        rows += [(c, t, rng.choice(["user", "bot"]) if t > 2 else "user", rng.choice(texts) if t > 1 else texts[0]) for t in range(rng.randrange(1, turns))]
    return rows


@pytest.mark.parametrize("seed", [0, 1])
def test_against_brute_force(spark, seed):
    rng = random.Random(seed)
    rows = some(rng, 90, ["hi", "yes", "no é", ""])
    rows += [(300 + i, t, "user", "same") for i in range(0, 40) for t in range(2)]
    rows += [(None, 1, "user", "lost"), (7, None, None, None), (7, None, "user", "x"), (7, 3, "user", "tie"), (7, 3, "bot", "tie"), (7, 3, "bot", "tie")]
    assert got(spark, rows) == brute(rows)


def test_long_conversations(spark, monkeypatch):
    """Stretches of 5 turns, every key hot: conversations of 60 turns that part at many depths."""
    monkeypatch.setattr(pt, "STRETCH", 5)
    monkeypatch.setattr(pt, "HOT_ROWS", 3)
    base = [("user", f"t{i}") for i in range(60)]
    rows = []
    for c in range(0, 60, 5):
        part = 60 - 4 * (c // 5)
        rows += [(c, i, r, t if i < part else f"own {c % 3} {i}") for i, (r, t) in enumerate(base)]
    assert got(spark, rows) == brute(rows)


def test_only_root(spark):
    """Conversation 1 takes h turns from a missing donor and has no more of its own; an empty table has no node."""
    c = next(c for c in range(1, 100) if c % 5 and zlib.crc32(str(c).encode()) % 9 > 1)
    rows = [(c, 0, "user", "gone")]
    assert got(spark, rows) == brute(rows)
    assert got(spark, rows)[0][:6] == (c, 0, None, 1, 0, 1)
    assert pt.trie(spark.createDataFrame([], SCHEMA)).count() == 0


def test_end_lists_in_pieces(spark):
    """A hot end list reaches the hash in order although many tasks hold pieces of it."""
    ids = [i * 7 % 10007 for i in range(10007)]
    ends = spark.createDataFrame([(1, 2, i) for i in ids] + [(3, 4, 9)], "a long, b long, conv_id long")
    pieces = pt.end_pieces(ends, 6)
    assert pieces.where("a = 1").count() > 4
    done = pt.end_hashes(pieces).collect()
    assert {(r["a"], r["ends_sha256"]) for r in done} == {(1, hashlib.sha256(",".join(map(str, sorted(ids))).encode()).hexdigest()), (3, hashlib.sha256(b"9").hexdigest())}


def test_whole_table(spark, sf):
    rows = [tuple(r) for r in spark.read.parquet(f"{sf}/conversations.parquet").select("conv_id", "turn", "role", "text").collect()]
    assert got(spark, rows) == brute(rows)
