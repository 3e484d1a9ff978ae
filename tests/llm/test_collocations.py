"""Phrase collocations against a brute force over plain strings; odd inputs. The registered query is checked with its SQL in test_queries."""

import random
import re
from collections import Counter, defaultdict

import numpy as np
import pyarrow as pa
import pytest

from ladle.llm import collocations as co


def words_of(text):
    low = "".join(c.lower() if "A" <= c <= "Z" else c for c in text or "")
    return [re.findall("[^\x20\x09]+", p) for p in re.split("[.,;:!?\x0a-\x0d]", low)]


def brute(rows, longest, least, top, share):
    f, n = defaultdict(Counter), Counter()
    for lang, text in rows:
        lang = "und" if lang is None else lang
        for ws in words_of(text):
            n[lang] += len(ws)
            for k in range(1, longest + 1):
                f[lang].update(tuple(ws[i : i + k]) for i in range(len(ws) - k + 1))
    out = []
    for lang, c in f.items():
        cand = {p: a for p, a in c.items() if len(p) > 1 and a >= least}
        longer = Counter()
        for p, a in cand.items():
            for m in range(2, len(p)):
                for i in range(len(p) - m + 1):
                    longer[p[i : i + m]] = max(longer[p[i : i + m]], a)
        rows_ = []
        for p, a in cand.items():
            if longer[p] and 100 * longer[p] >= share * a:
                continue
            score, _, l, r = min((co.SCALE * a * a // (c[p[:k]] * c[p[k:]]), k, c[p[:k]], c[p[k:]]) for k in range(1, len(p)))
            rows_.append((-score, -a, " ".join(p).encode(), l, r))
        for rank, (s, a, p, l, r) in enumerate(sorted(rows_)[:top], 1):
            out.append((lang, rank, p.decode(), -a, l, r, n[lang], -s))
    return sorted(out)


def got(df):
    return sorted(tuple(r) for r in df.select("lang", "rank", "phrase", "a", "l", "r", "n", "score").collect())


@pytest.mark.parametrize(("longest", "least", "top"), [(3, 3, 2000), (2, 2, 5), (4, 4, 10)])
def test_against_brute_force(spark, longest, least, top):
    rng = random.Random(longest)
    vocab = ["the", "of", "New", "york", "é", "Straße", "a", "x\x1cy", "　", "rain"]
    rows = []
    for i in range(300):
        parts = [rng.choice(vocab) + rng.choice([" ", "  ", "\t", ", ", ".", "\n", " ", " "]) for _ in range(rng.randrange(40))]
        rows.append((i, "".join(parts), rng.choice(["en", "de", None, "und"])))
    rows += [(900 + i, "new york city is big", "en") for i in range(50)] + [(i, None, "fr") for i in range(3)] + [(0, "", "")]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string").withColumn("n", co.F.lit(1)).withColumn("size", co.F.lit("x"))
    assert got(co.collocations(docs, longest, least, top)) == brute([(r[2], r[1]) for r in rows], longest, least, top, co.SHARE)


def test_whole_table(spark, sf):
    docs = spark.read.parquet(f"{sf}/documents.parquet")
    assert got(co.collocations(docs)) == brute([(r["lang"], r["text"]) for r in docs.collect()], co.LONGEST, co.LEAST, co.TOP, co.SHARE)


def test_long_text_and_empty_table(spark):
    """One text of a megabyte without a space, one of 200,000 words; and no rows at all."""
    docs = spark.createDataFrame([(1, "w" * 1_100_000 + " end", "en"), (2, "a b " * 100_000, "en")], "doc_id long, text string, lang string")
    assert got(co.collocations(docs)) == brute([("en", r["text"]) for r in docs.collect()], 3, 10, 2000, 50)
    assert co.collocations(docs.where("false")).count() == 0


def test_full_filter_and_no_codes_change_nothing(spark, monkeypatch):
    """Where the bitmap tells nothing apart every word may be frequent; without short numbers words are told by their hash."""
    rows = [("en", f"a b c{i % 7} d. rare{i}") for i in range(200)]
    docs = spark.createDataFrame([(i, t, lang) for i, (lang, t) in enumerate(rows)], "doc_id long, text string, lang string")
    plain = co.vocabulary

    def full(texts, least):
        known = plain(texts, least)
        return co.Vocabulary(known.words, np.full(co.FILTER_BITS // 8, 255, np.uint8), known.keys, known.codes)

    monkeypatch.setattr(co, "vocabulary", full)
    assert got(co.collocations(docs)) == brute(rows, 3, 10, 2000, 50)
    monkeypatch.setattr(co, "vocabulary", plain)
    monkeypatch.setattr(co, "CODES", 2)
    assert got(co.collocations(docs)) == brute(rows, 3, 10, 2000, 50)


def test_windows_start_at_every_word():
    """Each word starts one window; distinct windows of a batch carry their number; a rare word ends its window."""
    batch = pa.RecordBatch.from_pydict({"lang": ["en", "en"], "text": ["a b c, a b c", "b c odd b"]})
    r = co._read(batch)
    strings = r.strings.to_pylist()
    keys = np.sort(r.key[[strings.index(x) for x in "abc"]])

    class Shared:
        value = (np.zeros(co.FILTER_BITS // 8, np.uint8), keys, np.arange(3) + 2)

    name = {co.PAD: "", co.RARE: "?", **{int(i + 2): strings[r.key.tolist().index(k)] for i, k in enumerate(keys.tolist())}}
    out = next(co._windows(Shared, 3)(iter([batch]))).to_pylist()
    assert sorted((name[x["w1"]], name[x["w2"]], name[x["w3"]], x["n"]) for x in out) == [
        ("?", "", "", 1), ("a", "b", "c", 2), ("b", "", "", 1), ("b", "c", "", 2), ("b", "c", "?", 1), ("c", "", "", 2), ("c", "?", "", 1)]


def test_counts_beyond_64_bits(spark):
    """Products of counts of 10**12 are exact."""
    a, l, r = 10**12 - 1, 10**12 + 7, 10**12 + 9
    counts = spark.createDataFrame([("en", [5, 6], a), ("en", [5], l), ("en", [6], r), ("en", [], 2 * l)], "lang string, ws array<long>, f long")
    words = spark.createDataFrame([(5, "x"), (6, "y")], "code long, word string")
    assert got(co.rank(counts, words, co.TOP, co.SHARE)) == [("en", 1, "x y", a, l, r, 2 * l, co.SCALE * a * a // (l * r))]
