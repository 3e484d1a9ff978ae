"""Language ID: code lengths against a plain PPM, accuracy on held-out rows, odd inputs."""

import math

import numpy as np
import pytest
from pyspark.sql import functions as F

from ladle.llm import ppm


def plain_bits(texts, text, order):
    """PPM with escape method C and full exclusion, written out byte by byte."""
    seen = [{} for _ in range(order + 1)]
    for t in texts:
        for i in range(len(t)):
            for k in range(order + 1):
                if i >= k:
                    seen[k].setdefault(t[i - k : i], {}).setdefault(t[i], 0)
                    seen[k][t[i - k : i]][t[i]] += 1
    bits = 0.0
    for i, s in enumerate(text):
        out: set = set()
        for k in range(min(order, i), -1, -1):
            left = {x: n for x, n in seen[k].get(text[i - k : i], {}).items() if x not in out}
            if not left:
                continue
            whole = sum(left.values()) + len(left)
            if s in left:
                bits -= math.log2(left[s] / whole)
                break
            bits -= math.log2(len(left) / whole)
            out |= set(left)
        else:
            bits += math.log2(256 - len(out))
    return bits


@pytest.mark.parametrize("order", [0, 1, 3])
def test_code_lengths(order):
    samples = {"a": [b"abracadabra", b"a", "été".encode()], "b": [b"hello hello yellow", b""]}
    model = ppm.build(samples, order)
    texts = [b"abra", b"", b"hello x", "éabr".encode(), b"zzz\xff", b"yellow" * 50]
    off = np.r_[0, np.cumsum([len(t) for t in texts])].astype(np.int64)
    got = ppm.code_lengths(model, np.frombuffer(b"".join(texts), np.uint8), off)
    for i, t in enumerate(texts):
        for j, name in enumerate(model["names"]):
            assert got[i, j] == pytest.approx(plain_bits(samples[name], t, order), rel=1e-5, abs=1e-4)


def test_slices_do_not_matter(monkeypatch):
    model = ppm.build({"a": [b"abracadabra"], "b": [b"hello world"]})
    data = np.frombuffer(b"abracadabra hello" * 20, np.uint8)
    off = np.array([0, 5, 5, 100, len(data)], np.int64)
    whole = ppm.code_lengths(model, data, off)
    monkeypatch.setattr(ppm, "SLICE", 7)
    assert np.allclose(whole, ppm.code_lengths(model, data, off))


def test_held_out_accuracy(spark, sf):
    docs = spark.read.parquet(f"{sf}/documents.parquet")
    got = ppm.detect(docs).join(docs.select("doc_id", "lang"), "doc_id").where("held_out")
    n, right = got.agg(F.count("*"), F.sum((F.col("lang") == F.col("lang_pred")).cast("int"))).first()
    assert n > 20 and right / n > 0.9


def test_odd_rows(spark):
    rows = [(1, "le chat est dans la maison", "fr", 1), (2, "the cat is in the house", "en", 2), (3, None, "en", 3), (4, "", None, 4),
            (5, "123 !!", "fr", 5), (6, "the dog", None, 6), (None, "the bird", "en", 7), (2, "the cat is in the house", "en", 2)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string, score int")
    got = ppm.detect(docs).collect()
    assert len(got) == 8
    by = {r["doc_id"]: r for r in got}
    assert by[3]["lang_pred"] == by[4]["lang_pred"] == by[5]["lang_pred"] == "und" and by[3]["score"] == 0
    assert all(0 <= r["score"] <= 1 for r in got)
    empty = ppm.detect(docs.where("false"))
    assert empty.count() == 0 and empty.columns == ["doc_id", "held_out", "lang_pred", "score"]
    assert {r["lang_pred"] for r in ppm.detect(docs.withColumn("lang", F.lit(None).cast("string"))).collect()} == {"und"}


def test_language_of_long_texts_only(spark):
    """A language without a text of at most SAMPLE_BYTES is learned all the same; the others learn from short texts alone."""
    near, far = "the quick brown fox jumps over it ", "zażółć gęślą jaźń szybko "
    big = ppm.SAMPLE_BYTES // len(far) + 10
    rows = [(i, near * 5, "en") for i in range(20)] + [(100 + i, far * (big + i), "pl") for i in range(5)] + [(200, far * big, "en")]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string")
    model = ppm.fit(docs)
    assert model["names"] == ["en", "pl"]
    got = {r["doc_id"]: r["lang_pred"] for r in ppm.identify(docs, model).collect()}
    assert {got[i] for i in range(20)} == {"en"} and {got[100 + i] for i in range(5)} == {"pl"} and got[200] == "pl"
