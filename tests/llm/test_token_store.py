"""Token store: ids against the tokenizer on whole texts, the hash function, keyed access, odd inputs."""

import zlib

import numpy as np
import public_tokenizers as P
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from tokenizers import Tokenizer

from ladle.llm import token_store as ts

PATH = P.path("byte_bpe_50k.json")


@pytest.fixture(scope="module")
def coder():
    return ts.Tokens(PATH), Tokenizer.from_file(PATH)


@given(st.one_of(st.text(max_size=40), st.text("ab 'sé\n\t\x1c　.!<|endoftext|>", max_size=40)))
@settings(max_examples=400, deadline=None)
def test_same_as_whole_text(coder, text):
    own, lib = coder
    assert np.frombuffer(own.encode(text), "<u2").tolist() == lib.encode(text, add_special_tokens=False).ids


def test_perfect_hash():
    ids = np.unique(np.random.default_rng(0).integers(-(2**62), 2**62, 20000))
    levels = ts.build_hash(ts._key(ids))
    got = ts.look_up(levels, ts._key(ids))
    assert sorted(got.tolist()) == list(range(len(ids)))
    assert sum(map(len, levels)) < 4 * len(ids)
    assert ts.build_hash(np.zeros(0, np.uint64)) == []


def want(rows):
    lib = Tokenizer.from_file(PATH)
    out, start = [], 0
    for key, text in sorted(rows, key=lambda r: (r[0] is not None, r[0])):
        ids = [*lib.encode(text or "", add_special_tokens=False).ids, 2]
        out.append((key, start, len(ids), zlib.crc32(np.array(ids, "<u4").tobytes())))
        start += len(ids)
    return out


def test_table(spark, sf, monkeypatch):
    docs = spark.read.parquet(f"{sf}/documents.parquet").select("doc_id", "text")
    got = ts.read_back(ts.write_store(docs, PATH), docs.select("doc_id")).collect()
    assert sorted(tuple(r) for r in got) == want([tuple(r) for r in docs.collect()])


def test_keyed_access_and_odd_rows(spark):
    docs = spark.createDataFrame([(5, "five", 1), (2, None, 2), (9, "", 3), (None, "nameless", 4), (-3, "a  b\n", 5), (9, "again", 6)], "doc_id long, text string, n int")
    store = ts.write_store(docs, PATH)
    ids = store.read(store.find(spark.createDataFrame([(5,), (77,), (9,)], "doc_id long"))).collect()
    lib = Tokenizer.from_file(PATH)
    text = {(r["doc_id"], lib.decode(np.frombuffer(r["ids"], "<u4").tolist()[:-1])) for r in ids}
    assert text == {(5, "five"), (9, ""), (9, "again")}
    got = ts.read_back(store, docs.select("doc_id")).collect()
    assert sorted(r["n_tokens"] for r in got) == sorted(w[2] for w in want([(r[0], r[1]) for r in docs.collect()]))
    assert [r["start"] for r in got if r["doc_id"] is None] == [0]
    none = ts.write_store(docs.where("false"), PATH)
    assert ts.read_back(none, docs.where("false").select("doc_id")).count() == 0


def test_packed_look_up():
    """The packed form numbers known and unknown keys as the plain levels do."""
    rng = np.random.default_rng(4)
    for n in (0, 1, 63, 64, 65, 5000):
        ids = np.unique(rng.integers(-(2**62), 2**62, n))
        levels = ts.build_hash(ts._key(ids))
        asked = ts._key(np.r_[ids, rng.integers(-(2**62), 2**62, 100)])
        assert ts.look_up_packed(*ts.pack(levels), asked).tolist() == ts.look_up(levels, asked).tolist()


def test_batches(coder):
    """Whole batches, with slices, nulls, a very long text and tokens spelled out, as text by text."""
    import pyarrow as pa

    own, lib = coder
    texts = ["x", None, "", "a b, c.\n\nD  e", "word " * 300000 + "end", "y<|endoftext|> z a\x85 b　 c", " É l'été, don't", "A" * 10000]
    words = ts.Tokens(P.path("word_bpe_49k.json"))
    for coder_, lib_ in ((own, lib), (words, Tokenizer.from_file(P.path("word_bpe_49k.json")))):
        ids, ptr = coder_.batch(pa.array(["skip", *texts]).slice(1))
        assert [ids[a:b].tolist() for a, b in zip(ptr, ptr[1:], strict=False)] == [lib_.encode(t or "", add_special_tokens=False).ids for t in texts]


@given(st.one_of(st.text(max_size=40), st.text("ab 'sé\n\t\x1c　.!<|endoftext|>ÀÉß̈", max_size=40)))
@settings(max_examples=400, deadline=None)
def test_word_tokenizer_same_as_whole_text(word_coder, text):
    own, lib = word_coder
    assert np.frombuffer(own.encode(text), "<u2").tolist() == lib.encode(text, add_special_tokens=False).ids


@pytest.fixture(scope="module")
def word_coder():
    path = P.path("word_bpe_49k.json")
    return ts.Tokens(path), Tokenizer.from_file(path)
