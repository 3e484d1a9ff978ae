"""Revisits against a plain walk over all records, with parts of URLs in several partitions; canonical URLs; odd inputs."""

import random

import pytest
from pyspark.sql import functions as F

from ladle.llm import revisits

SCHEMA = "record_id long, url string, date long, status int, headers map<string,string>, note string"


def brute(rows, key_of):
    out = []
    for i, url, date, status, headers, _ in rows:
        if status != 304:
            continue
        headers, key = headers or {}, key_of[url]
        earlier = [r for r in rows if r[3] == 200 and key is not None and key_of[r[1]] == key and ((r[2] is not None, r[2] or 0), r[0]) < ((date is not None, date or 0), i)]
        best = max(earlier, key=lambda r: ((r[2] is not None, r[2] or 0), r[0]), default=None)
        asked = next((h for h in ("etag", "last-modified") if headers.get(h) is not None), None)
        if best is None:
            what = "missing"
        elif asked is None:
            what = "unvalidated"
        else:
            a, b = headers[asked], (best[4] or {}).get(asked)
            what = "resolved" if b is not None and a.removeprefix("W/") == b.removeprefix("W/") else "mismatch"
        merged = {**(best[4] or {}), **{k: v for k, v in headers.items() if k in revisits.PERMITTED and v is not None}} if what == "resolved" else None
        out.append((i, what, best and best[0], merged and tuple(sorted(merged.items()))))
    return sorted(out)


@pytest.mark.parametrize("part_bytes", [1 << 30, 1])
def test_against_plain_walk(spark, monkeypatch, part_bytes):
    monkeypatch.setattr(revisits, "width", lambda df, n: 7)
    rng = random.Random(part_bytes)
    urls = ["http://a.example/x", "https://www.A.example:443/x/", "http://a.example/y?b=1&a=2&utm_source=q#f", "https://a.example/y?a=2&b=1", None, "ftp://a/b", "http://b.example"]
    rows = []
    for i in range(600):
        tag, mod = rng.choice([None, '"1"', 'W/"1"', '"2"']), rng.choice([None, "m1", "m2"])
        headers = {k: v for k, v in (("etag", tag), ("last-modified", mod), ("date", f"d{i}"), ("content-length", str(i)), ("x", None)) if v is not None or k == "x"}
        rows.append((i, urls[0] if rng.random() < 0.4 else rng.choice(urls), rng.choice([None, *range(40)]), rng.choice([200, 304, 304, 404]), rng.choice([headers, headers, headers, None]), "n"))
    table = spark.createDataFrame(rows, SCHEMA)
    key_of = {u: spark.createDataFrame([(u,)], "u string").select(revisits.canonical(F.col("u"))).first()[0] for u in urls}
    assert key_of[urls[0]] == key_of[urls[1]] == "a.example/x" and key_of[urls[2]] == key_of[urls[3]] == "a.example/y?a=2&b=1"
    assert key_of[None] is None and key_of["ftp://a/b"] is None and key_of["http://b.example"] == "b.example/"
    got = sorted((r["record_id"], r["outcome"], r["response_id"], None if r["headers"] is None else tuple(sorted(r["headers"].items()))) for r in revisits.resolve(table).collect())
    fix = [(i, w, b, None if m is None else m) for i, w, b, m in brute(rows, key_of)]
    assert [g[:3] for g in got] == [f[:3] for f in fix]
    assert [dict(g[3]) if g[3] else None for g in got] == [dict(f[3]) if f[3] else None for f in fix]


def test_empty(spark):
    none = spark.createDataFrame([], SCHEMA)
    assert revisits.resolve(none).count() == 0
    only = spark.createDataFrame([(1, "http://a/", 1, 304, None, "x"), (2, None, None, 304, {}, None)], SCHEMA)
    assert {r["outcome"] for r in revisits.resolve(only).collect()} == {"missing"}
