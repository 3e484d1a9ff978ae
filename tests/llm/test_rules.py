"""Quality rules: statistics against brute force, what the learner finds, its ordered expression, odd inputs."""

import re
from collections import Counter

from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from ladle.llm import rules

WORD = re.compile(r"[^\x20\x09-\x0D]+")


def brute(text):
    text = text or ""
    w = WORD.findall(text)
    grams = [tuple(w[i : i + 3]) for i in range(len(w) - 2)]
    n = Counter(grams)
    marked = {i + k for i, g in enumerate(grams) if n[g] > 1 for k in range(3)}
    lines = [x for x in text.split("\n") if WORD.search(x)]
    return (len(w), sum(map(len, w)), sum(c in "#*$%&|<>" for c in text), len(lines) - len(set(lines)), len(marked))


def check(rows, got):
    for r in got:
        want = brute(rows[r["doc_id"]])
        assert (r["n_words"], r["word_chars"], r["n_symbols"], r["n_dup_lines"], r["n_repeat_words"]) == want
        assert r["base_failed"] == (want[0] < 50 or 100 * want[4] > 50 * want[0])


def test_whole_table(spark, sf):
    docs, labels = spark.read.parquet(f"{sf}/documents.parquet"), spark.read.parquet(f"{sf}/labels.parquet")
    got = rules.judge(docs, labels).collect()
    rows = {r["doc_id"]: r["text"] for r in docs.collect()}
    assert len(got) == len(rows)
    check(rows, got)
    assert not any(r["kept"] for r in got if r["base_failed"])
    bad = {r["doc_id"]: r["quality"] == 0 for r in labels.collect()}
    good = [r["kept"] or r["base_failed"] for r in got if bad.get(r["doc_id"]) is False]
    assert sum(good) / len(good) > 0.95


@given(st.lists(st.text("ab \n\t#é\x0b\x1c", max_size=60), min_size=1, max_size=8))
@settings(max_examples=15, deadline=None)
def test_statistics(spark, texts):
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    got = rules.statistics(docs).withColumn("base_failed", rules.base_failed()).collect()
    check(dict(enumerate(texts)), got)


def test_learned_list(spark):
    """Two kinds of bad rows, each told by a conjunction."""
    rows = []
    for i in range(900):
        words, symbols, upper, repeat = 100 + i % 7, i % 3, i % 11, (i * 7) % 20
        bad = i % 5 == 0
        if bad and i % 2:
            symbols, upper = 200, 300
        elif bad:
            repeat = 90
        rows.append((i, bad, words, 500, symbols, 0, repeat, 1, upper, 3))
    table = spark.createDataFrame(rows, "doc_id long, bad boolean, n_words long, word_chars long, n_symbols long, n_dup_lines long, n_repeat_words long, n_lines long, n_upper long, n_marks long")
    found = rules.learn(table)
    assert 1 < len(found.rules) <= rules.MAX_RULES and found.sql().startswith("CASE WHEN")
    wrong = table.select(F.col("bad").alias("b"), found.verdict().alias("v")).where("b = v").count()
    assert wrong == 0
    plain = {f: s.replace("CAST(n_words AS DOUBLE)", "n_words") for f, s in rules.FEATURES.items()}
    for r in table.withColumn("v", found.verdict()).limit(60).collect():
        env = {**r.asDict(), "greatest": max}
        hit = any(all(eval(f"({plain[f]}) {side} {t}", {"greatest": max}, env) for f, side, t in rule) for rule in found.rules)
        assert r["v"] == (not hit)
    assert rules.learn(table.where("false")).rules == [] and rules.learn(table.withColumn("bad", F.lit(None).cast("boolean"))).sql() == "true"


def test_odd_rows(spark):
    docs = spark.createDataFrame([(1, None, 1), (2, "", 2), (3, "a b c " * 40, 3), (3, "w%d " * 3, 3), (None, " ".join(f"w{i}" for i in range(60)), 4)], "doc_id long, text string, n_words int")
    labels = spark.createDataFrame([(1, 0), (None, 1), (77, 0), (3, None)], "doc_id long, quality int")
    got = {(r["doc_id"], r["n_words"]): (r["base_failed"], r["kept"]) for r in rules.judge(docs, labels).collect()}
    assert got == {(1, 0): (True, False), (2, 0): (True, False), (3, 120): (True, False), (3, 3): (True, False), (None, 60): (False, True)}
    assert rules.judge(docs.where("false"), labels.where("false")).count() == 0
