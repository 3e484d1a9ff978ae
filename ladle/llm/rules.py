"""Quality rules: text statistics as built-in expressions, and decision lists learned from labelled statistics.

Learning is sequential covering. Labelled rows are dealt by a hash into a growing and a pruning part. A rule grows by adding the
threshold test with the highest information gain on the growing rows that no earlier rule covers; it is cut back to
the prefix that does best on the pruning rows, and joins the list if it is right there more often than LEAST_RIGHT. Rows that it
covers are set aside and the next rule grows, until a rule fails or the list has MAX_RULES rules (of at most MAX_TESTS tests; both are arguments). Every step is one grouped count of (feature, bin) over the
whole labelled table; the driver sees only those counts. The list becomes one ordered conditional expression
(``CASE WHEN ... THEN false ... ELSE true END``) that Spark evaluates with the statistics. No Python runs on rows.

Cases: a null or wordless text has zero counts and fails the base rules. Null labels and labels of unknown documents are not learned
from; without labels, or if no rule holds up, the list is empty and keeps everything. Repeated rows count and are judged
each. Of equal gains the test first by feature, threshold and side wins. Extra columns are ignored. Repeated windows within
a text are told by 64-bit hashes of their words.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ladle.llm.common import SPACE
from ladle.session import materialize

SYMBOLS = "#*$%&|<>"
MIN_WORDS = 50
BINS = 32
#: Bounds of what is learned, arguments of ``learn`` and ``judge``: tests in a rule and rules in a list. None: no bound.
MAX_TESTS = 4
MAX_RULES = 8
LEAST_RIGHT = 0.8
LEAST_COVER = 3
COUNTS = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "n_lines", "n_upper", "n_marks")

#: Features of a rule, as SQL over the statistics.
FEATURES = {
    "n_words": "CAST(n_words AS DOUBLE)",
    "chars_per_word": "word_chars / greatest(n_words, 1)",
    "symbol_share": "n_symbols / greatest(word_chars, 1)",
    "dup_line_share": "n_dup_lines / greatest(n_lines, 1)",
    "repeat_share": "n_repeat_words / greatest(n_words, 1)",
    "upper_share": "n_upper / greatest(word_chars, 1)",
    "mark_share": "n_marks / greatest(word_chars, 1)",
}


def _bound(value: Column, use) -> Column:
    """``use(value)`` with the value worked out once: a lambda's variable is not expanded."""
    return F.element_at(F.transform(F.array(value), use), 1)


def _only(text: Column, kept: str) -> Column:
    """Number of characters of ``text`` in a character class."""
    return F.length(F.regexp_replace(text, f"[^{kept}]+", "")).cast("long")


def repeated_words(words: Column, n: int = 3) -> Column:
    """How many words stand in an n-word window that occurs at least twice in the array."""

    def marked(s: Column) -> Column:
        twin = lambda x, j: ((j > 0) & (F.get(s, j - 1)["h"] == x["h"])) | F.coalesce(F.get(s, j + 1)["h"] == x["h"], F.lit(False))
        return F.sort_array(F.transform(F.filter(s, twin), lambda x: x["i"]))

    def covered(p: Column) -> Column:
        step = F.transform(p, lambda x, j: F.least(F.lit(n), F.coalesce(F.get(p, j + 1) - x, F.lit(n))))
        return F.aggregate(step, F.lit(0), lambda a, x: a + x)

    def over(h: Column) -> Column:
        pairs = F.sort_array(F.transform(h, lambda x, i: F.struct(x.alias("h"), i.alias("i"))))
        return F.when(F.size(F.array_distinct(h)) == F.size(h), F.lit(0)).otherwise(_bound(_bound(pairs, marked), covered))

    def windows(w: Column) -> Column:
        return F.transform(F.sequence(F.lit(0), F.size(w) - n), lambda i: F.xxhash64(*[F.get(w, i + k) for k in range(n)]))

    return F.when(F.size(words) < n, F.lit(0)).otherwise(_bound(_bound(words, windows), over)).cast("long")


def statistics(docs: DataFrame, key: str = "doc_id", text: str = "text") -> DataFrame:
    """Per row: doc_id and COUNTS."""
    t = F.coalesce(F.col(text), F.lit(""))
    base = docs.select(F.col(key).alias("doc_id"), t.alias("t"))
    words = F.array_remove(F.split("t", SPACE), "")
    lines = F.filter(F.split("t", "\n"), lambda x: x.rlike(r"[^\x20\x09-\x0D]"))

    def of_words(w: Column) -> Column:
        return F.struct(F.size(w).cast("long").alias("n_words"), repeated_words(w).alias("n_repeat_words"))

    def of_lines(x: Column) -> Column:
        return F.struct(F.size(x).cast("long").alias("n_lines"), (F.size(x) - F.size(F.array_distinct(x))).cast("long").alias("n_dup_lines"))

    out = base.select(
        "doc_id", _bound(words, of_words).alias("w"), _bound(lines, of_lines).alias("l"),
        F.length(F.regexp_replace("t", SPACE, "")).cast("long").alias("word_chars"),
        _only(F.col("t"), r"#*$%&|<>").alias("n_symbols"), _only(F.col("t"), r"\p{Lu}").alias("n_upper"), _only(F.col("t"), r"!?.,;:").alias("n_marks"),
    )
    return out.select("doc_id", "w.n_words", "word_chars", "n_symbols", "l.n_dup_lines", "w.n_repeat_words", "l.n_lines", "n_upper", "n_marks")


def base_failed() -> Column:
    return (F.col("n_words") < MIN_WORDS) | (100 * F.col("n_repeat_words") > 50 * F.col("n_words"))


class DecisionList:
    """Ordered rules; a rule is a list of (feature, side, threshold), sides ``<=`` and ``>``. A row that a rule covers is bad."""

    def __init__(self, rules: list[list[tuple[str, str, float]]]):
        self.rules = rules

    @staticmethod
    def test(feature: str, side: str, threshold: float) -> str:
        return f"{FEATURES[feature]} {side} {threshold!r}D"

    def sql(self) -> str:
        """The verdict as a conditional expression: true keeps."""
        whens = " ".join(f"WHEN {' AND '.join(self.test(*t) for t in rule)} THEN false" for rule in self.rules)
        return f"CASE {whens} ELSE true END" if whens else "true"

    def verdict(self) -> Column:
        return F.expr(self.sql())


def _gain(p: float, n: float, p0: float, n0: float) -> float:
    if not p or not p0:
        return 0.0
    return p * (math.log2(p / (p + n)) - math.log2(p0 / (p0 + n0)))


def _covers(rule: list[tuple[str, str, int]]) -> Column:
    """A rule over bins: side ``<=`` means at most that bin."""
    cond = F.lit(True)
    for feature, side, b in rule:
        cond = cond & ((F.col(feature) <= b) if side == "<=" else (F.col(feature) > b))
    return cond


def learn(labelled: DataFrame, bad: str = "bad", max_tests: int | None = MAX_TESTS, max_rules: int | None = MAX_RULES) -> DecisionList:
    """Decision list from rows with COUNTS and a boolean ``bad`` (and doc_id, which only deals rows into the two parts)."""
    names = list(FEATURES)
    rows = labelled.where(F.col(bad).isNotNull()).select(
        F.col(bad).cast("long").alias("y"), (F.pmod(F.xxhash64("doc_id"), F.lit(3)) > 0).alias("grow"), *[F.expr(s).alias(f) for f, s in FEATURES.items()]
    )
    # Cut points: quantiles of all rows and of the bad ones.
    at = [i / BINS for i in range(1, BINS)]
    asked = [F.percentile_approx(v, at, 10000).alias(f"{f}_{k}") for f in names for k, v in (("all", F.col(f)), ("bad", F.when(F.col("y") == 1, F.col(f))))]
    got = rows.agg(*asked).first().asDict()
    cuts = {f: sorted({*(got[f"{f}_all"] or ()), *(got[f"{f}_bad"] or ())}) for f in names}

    def bin_of(f: str) -> Column:
        out = F.lit(len(cuts[f]))
        for i in range(len(cuts[f]) - 1, -1, -1):
            out = F.when(F.col(f) <= F.lit(cuts[f][i]), F.lit(i)).otherwise(out)
        return out.alias(f)

    cells = materialize(rows.select("y", "grow", *[bin_of(f) for f in names]).groupBy("y", "grow", *names).agg(F.count(F.lit(1)).alias("rows")), "cells")
    left = F.lit(True)
    rules: list[list[tuple[str, str, int]]] = []

    def histogram(cond: Column) -> dict[str, dict[int, tuple[int, int]]]:
        pairs = F.explode(F.array(*[F.struct(F.lit(f).alias("f"), F.col(f).alias("b")) for f in names])).alias("x")
        out: dict = {f: {} for f in names}
        for r in cells.where(cond).select("y", "rows", pairs).groupBy("x.f", "x.b").agg(F.sum(F.col("y") * F.col("rows")).alias("p"), F.sum("rows").alias("all")).collect():
            out[r["f"]][r["b"]] = (r["p"], r["all"] - r["p"])
        return out

    while max_rules is None or len(rules) < max_rules:
        rule: list[tuple[str, str, int]] = []
        while max_tests is None or len(rule) < max_tests:
            bins = histogram(F.col("grow") & left & _covers(rule))
            p0 = sum(p for p, _ in bins[names[0]].values())
            n0 = sum(n for _, n in bins[names[0]].values())
            if not p0 or not n0:
                break
            best, test = 1e-9, None
            for f in names:
                p = n = 0
                for b in range(len(cuts[f])):
                    dp, dn = bins[f].get(b, (0, 0))
                    p, n = p + dp, n + dn
                    for side, q, m in (("<=", p, n), (">", p0 - p, n0 - n)):
                        if q >= LEAST_COVER and (g := _gain(q, m, p0, n0)) > best:
                            best, test = g, (f, side, b)
            if test is None:
                break
            rule.append(test)
        if not rule:
            break
        sums = [F.sum(F.when(_covers(rule[:k]), F.col(v))).alias(f"{v}{k}") for k in range(1, len(rule) + 1) for v in ("hit", "rows")]
        r = cells.where(~F.col("grow") & left).withColumn("hit", F.col("y") * F.col("rows")).agg(*sums).first()
        tried = [((r[f"hit{k}"] or 0), (r[f"rows{k}"] or 0), k) for k in range(1, len(rule) + 1)]
        hit, all_, k = max(tried, key=lambda x: ((2 * x[0] - x[1]) / x[1] if x[1] else -1, x[0], -x[2]))
        if not hit or hit / all_ < LEAST_RIGHT:
            break
        rules.append(rule[:k])
        left = left & ~_covers(rule[:k])

    def threshold(f: str, b: int) -> float:
        """Half way to the next cut point, so that a test does not hug the rows it was learned from."""
        return float(cuts[f][b] if b + 1 == len(cuts[f]) else (cuts[f][b] + cuts[f][b + 1]) / 2)

    return DecisionList([[(f, side, threshold(f, b)) for f, side, b in rule] for rule in rules])


def judge(docs: DataFrame, labels: DataFrame, key: str = "doc_id", text: str = "text", label: str = "quality", max_tests: int | None = MAX_TESTS, max_rules: int | None = MAX_RULES) -> DataFrame:
    """Per row: doc_id, COUNTS, base_failed, kept."""
    stats = materialize(statistics(docs, key, text), "statistics")
    known = labels.where(F.col(label).isNotNull()).select(F.col(key).alias("doc_id"), (F.col(label) == 0).alias("bad"))
    found = learn(stats.join(known, "doc_id").where(~base_failed()), max_tests=max_tests, max_rules=max_rules)
    return stats.select("*", base_failed().alias("base_failed"), (~base_failed() & found.verdict()).alias("kept"))
