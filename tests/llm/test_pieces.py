"""Piece encoding: Viterbi against brute force, exact round trips, odd inputs."""

import math
import zlib

import numpy as np
import public_tokenizers as P
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from ladle.llm import pieces

PATH = P.path("piece_bpe_32k.model")


def toy():
    vocab = ["", *[f"<{b}>" for b in range(256)], "▁", "a", "b", "ab", "▁a", "ba", "aba", "▁▁", "bb"]
    scores = [0.0] * 257 + [-3.0, -2.0, -2.5, -3.0, -3.5, -2.9, -4.0, -5.0, -5.0]
    return pieces.Encoder(vocab, scores, list(range(1, 257)), set(range(257))), vocab, scores


def brute(vocab, scores, text):
    """Best (score, fewer pieces) over all segmentations of a text that the pieces can spell."""
    best = {0: (0.0, 0)}
    for e in range(1, len(text) + 1):
        for i in range(257, len(vocab)):
            a = e - len(vocab[i])
            if a >= 0 and a in best and text[a:e] == vocab[i]:
                new = (best[a][0] + scores[i], best[a][1] - 1)
                if e not in best or new > best[e]:
                    best[e] = new
    return best[len(text)]


@given(st.text("ab ", max_size=12))
@settings(max_examples=200, deadline=None)
def test_best_segmentation(text):
    e, vocab, scores = toy()
    ids = np.frombuffer(e.encode(text), np.int32)
    marked = "▁" + text.replace(" ", "▁") if text else ""
    assert "".join(vocab[i] for i in ids) == marked
    want = brute(vocab, scores, marked)
    assert sum(scores[i] for i in ids) == pytest.approx(want[0]) and len(ids) == -want[1]


@given(st.one_of(st.text(max_size=40), st.text("ab é▁\x00\n\t中 ", max_size=30)))
@settings(max_examples=300, deadline=None)
def test_round_trip(text):
    e = pieces.load(PATH)
    try:
        text.encode()
    except UnicodeEncodeError:
        return
    assert e.decode(np.frombuffer(e.encode(text), np.int32)) == text


def test_table_and_rows(spark, sf):
    docs = spark.read.parquet(f"{sf}/documents.parquet").select("doc_id", "text").limit(50)
    both = pieces.decode(pieces.encode(docs, PATH), PATH).collect()
    assert all(r["text"] == r["decoded"] for r in both) and all(len(r["ids"]) > 0 for r in both if r["text"])
    got = {r["doc_id"]: r for r in pieces.digest(docs, PATH).collect()}
    for r in both:
        assert got[r["doc_id"]]["ids_crc32"] == zlib.crc32(np.array(r["ids"], "<u4").tobytes()) and got[r["doc_id"]]["round_trip"]


def test_odd_rows(spark):
    docs = spark.createDataFrame([(1, None, 1), (2, "", 2), (3, "a  b ", 3), (3, "a  b ", 3), (None, "x" * 20000, 4)], "doc_id long, text string, n_pieces int")
    got = pieces.digest(docs, PATH).collect()
    assert len(got) == 5 and {r["round_trip"] for r in got} == {None, True}
    rows = pieces.encode(docs, PATH).collect()
    assert [r["ids"] for r in rows if r["doc_id"] == 1] == [None] and [r["ids"] for r in rows if r["doc_id"] == 2] == [[]]
    assert pieces.encode(docs, PATH, ids="n_pieces").columns == ["doc_id", "text", "n_pieces"]
    assert pieces.digest(docs.where("false"), PATH).count() == 0
    assert math.isclose(pieces.BYTE_SCORE, -30)
