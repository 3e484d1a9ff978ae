import random

import pytest
from pyspark.sql import functions as F

from ladle.operators import evaluation, ordering, ranks, sampling, skew
from ladle.operators.ordering import measured_ranks, row_positions
from ladle.operators.skew import spread_join


def sample(n=3000, seed=1):
    """A third of the rows share one value, a third one group; some values and groups are NULL."""
    r = random.Random(seed)
    rows = []
    for i in range(n):
        g = None if i % 50 == 0 else ("hot" if i % 3 == 0 else f"g{r.randrange(20)}")
        v = None if i % 41 == 0 else (0.5 if i % 3 == 1 else r.choice([r.uniform(-5, 5), float(r.randrange(4))]))
        rows.append((i, g, v, r.randrange(2)))
    return rows


def brute_pct(rows, by_group):
    out = {}
    parts = {}
    for i, g, v, _ in rows:
        if v is not None and not (by_group and g is None):
            parts.setdefault(g if by_group else 0, []).append((v, i))
    for vals in parts.values():
        only = sorted(v for v, _ in vals)
        for v, i in vals:
            low = sum(1 for x in only if x < v)
            same = only.count(v)
            out[i] = (low + (same + 1) / 2) / len(only)
    return out


@pytest.mark.parametrize("groups", [[], ["g"]])
@pytest.mark.parametrize("buckets", [1, 2, 16, 100])
def test_value_ranks_do_not_depend_on_cells(spark, groups, buckets):
    rows = [r for r in sample() if not groups or r[1] is not None]
    df = spark.createDataFrame(rows, "id long, g string, v double, label int")
    out = measured_ranks(df, "v", groups, {"pos": F.col("label")}, buckets)
    got = {(r["g"] if groups else 0, r["v"]): r for r in out.table.collect()}
    assert len(got) == out.distinct
    for (g, v), r in got.items():
        part = [x for x in rows if x[2] is not None and (not groups or x[1] == g)]
        assert r["n"] == sum(x[2] == v for x in part)
        assert r["before_n"] == sum(x[2] < v for x in part)
        assert r["before_pos"] == sum(x[3] for x in part if x[2] < v)
        assert r["total_n"] == len(part)
        later = [x[2] for x in part if x[2] > v]
        assert r["next_value"] == (min(later) if later else None)


@pytest.mark.parametrize("groups", [[], ["g"]])
def test_rank_pct(spark, groups, monkeypatch):
    rows = sample()
    df = spark.createDataFrame(rows, "id long, g string, v double, label int").repartition(5)
    want = brute_pct(rows, bool(groups))
    for broadcast, hot in ((10**9, 10**9), (0, 10**9), (0, 100)):
        monkeypatch.setattr(skew.attach, "__defaults__", ("left", None, broadcast, False))
        monkeypatch.setattr(skew, "HOT_ROWS", hot)
        got = {r.id: r.rank_pct for r in ranks.rank_pct(df, "v", groups=groups).collect()}
        assert len(got) == len(rows)
        assert all(got[i] == pytest.approx(want[i]) if i in want else got[i] is None for i in got)


def test_known_percentiles(spark):
    df = spark.createDataFrame([(1, 1.0), (2, 2.0), (3, 2.0), (4, 3.0)], "id int, v double")
    got = [r.rank_pct for r in ranks.rank_pct(df, "v").orderBy("id").collect()]
    assert got == [0.25, 0.625, 0.625, 1.0]


@pytest.mark.parametrize("groups", [[], ["g"]])
@pytest.mark.parametrize("buckets", [1, 3, 100])
def test_row_positions(spark, groups, buckets):
    rows = sample()
    df = spark.createDataFrame(rows, "id long, g string, v double, label int")
    got = {r.id: r.position for r in row_positions(
        df, [("v", "desc"), "id"], groups, buckets=buckets).collect()}
    parts = {}
    for i, g, v, _ in rows:
        parts.setdefault(g if groups else 0, []).append((v is None, -(v or 0), i))
    want = {k[2]: p for part in parts.values() for p, k in enumerate(sorted(part), 1)}
    assert got == want


def test_spread_join_equals_plain_join(spark):
    rows = sample()
    df = spark.createDataFrame(rows, "id long, g string, v double, label int").repartition(4)
    table = df.groupBy("g").agg(F.count(F.lit(1)).alias("n"), F.max("id").alias("top"))
    got = spread_join(df, table, ["g"], "n", hot_rows=20)
    want = {r.g: (r.n, r.top) for r in table.collect()}
    out = got.collect()
    assert len(out) == len(rows) and all((r.n, r.top) == want[r.g] for r in out)
    assert sorted(got.columns) == sorted([*df.columns, "n", "top"])


def test_ranked_lists(spark):
    rows = sample()
    df = spark.createDataFrame(rows, "id long, g string, v double, label int")
    full = ranks.ranked(df, "v", "id", ["g"])
    best = ranks.ranked(df, "v", "id", ["g"], 3)
    a = {(r.g, r.rank): r.id for r in full.where("rank <= 3").collect()}
    assert a == {(r.g, r.rank): r.id for r in best.collect()}
    assert [r.id for r in ranks.ranked(df, "v", "id", top_k=5).orderBy("rank").collect()] == [
        r.id for r in ranks.ranked(df, "v", "id").where("rank <= 5").orderBy("rank").collect()]


def test_quantiles(spark):
    df = spark.createDataFrame([(v,) for v in (4.0, 1.0, 3.0, 2.0)], "v double")
    assert ordering.exact_quantiles(df, "v", {"q": 0.5}).first().q == 3.0
    assert ordering.exact_quantiles(df, "v", {"q": 0.5}, method="linear").first().q == 2.5
    assert ordering.exact_quantiles(df.where("v < 0"), "v", {"q": 0.5}).first().q is None


def auc_of(spark, ys, ss):
    df = spark.createDataFrame(list(zip(ys, ss)), "label int, score double")
    return evaluation.roc_auc(df).first().roc_auc


def test_auc(spark):
    assert auc_of(spark, [0, 0, 1, 1], [0.1, 0.4, 0.35, 0.8]) == 0.75
    assert auc_of(spark, [1, 1], [0.1, 0.4]) is None
    assert auc_of(spark, [], []) is None
    rows = [(r[3], r[2]) for r in sample() if r[2] is not None]
    pos, neg = [s for y, s in rows if y], [s for y, s in rows if not y]
    want = sum((p > n) + 0.5 * (p == n) for p in pos for n in neg) / (len(pos) * len(neg))
    assert auc_of(spark, *zip(*rows)) == pytest.approx(want, abs=1e-12)


def test_precision(spark):
    df = spark.createDataFrame(
        [(1, 0.9, 1, "a"), (0, 0.1, 2, "a"), (1, 0.8, 3, "b"), (0, 0.2, 4, "b")], "label int, score double, id int, g string")
    assert evaluation.precision_at_k(df, k=5).first()[0] == 0.5
    assert evaluation.precision_at_k(df.where("id < 0")).first()[0] is None
    macro = evaluation.macro_precision(evaluation.grouped_precision_at_k(df, "g", k=1)).first()
    assert (macro[0], macro[1]) == (1.0, 2)


def test_fold_summary_and_leaderboard(spark):
    df = spark.createDataFrame([("a", 0.5), ("a", 0.7), ("a", 0.9), ("b", 0.6)], "model string, auc double")
    rows = {r.model: r for r in evaluation.leaderboard(evaluation.fold_summary(df), "model", "mean_auc").collect()}
    assert rows["a"].median_auc == 0.7 and rows["a"].winner and not rows["b"].winner
    assert rows["a"].std_auc == pytest.approx(0.16329931618554522) and rows["b"].std_auc == 0.0


def test_one_order_for_every_k(spark):
    """NaN after the values, NULL after NaN, texts in either direction, the smallest long: the same for small and large k."""
    nan = float("nan")
    df = spark.createDataFrame([(1, nan, "b", -(2**63)), (2, 1.0, None, 5), (3, None, "a", None), (4, 2.0, "c", 2**63 - 1)], "id long, v double, t string, n long")
    for col, want in (("v", [4, 2, 1, 3]), ("t", [4, 1, 3, 2]), ("n", [4, 2, 1, 3])):
        for k in (4, 1001, None):
            assert [r.id for r in ranks.ranked(df, col, "id", top_k=k).orderBy("rank").collect()] == want
        for k in (4, 1001):
            got = ranks.ranked(df.withColumn("g", F.lit(1)), col, "id", ["g"], k)
            assert [r.id for r in got.orderBy("rank").collect()] == want
    assert {r.id: r.rank_pct for r in ranks.rank_pct(df, "v").collect()} == {1: None, 2: 0.5, 3: None, 4: 1.0}


def test_many_hot_keys(spark):
    """More hot keys than the former fixed list held; every one is split by its own rows."""
    rows = spark.range(6000).select((F.col("id") % 1500).alias("k"), "id")
    table = rows.groupBy("k").agg(F.count("*").alias("n"), F.max("id").alias("top"))
    got = spread_join(rows, table, ["k"], "n", hot_rows=1)
    assert got.count() == 6000 and got.where("top % 1500 <> k").count() == 0


def test_exact_quotas_under_repeated_keys(spark):
    """Twenty rows over ten keys, and one key that half of all rows share: quotas hold whatever the order of the rows."""
    pairs = spark.createDataFrame([(i % 10, i) for i in range(20)], "k long, v long")
    for n in (0, 1, 3, 7, 20, 50):
        got = sampling.hash_sample(pairs, "k", n)
        assert got.columns == ["k", "v"] and got.count() == min(n, 20)
    hot = spark.createDataFrame([(7 if i % 2 else i, i, i % 3 == 0) for i in range(600)] + [(None, 600, True), (None, 601, True)], "k long, v long, y boolean")
    first = {r["v"] for r in sampling.hash_sample(hot, "k", 200).collect()}
    assert len(first) == 200 and first == {r["v"] for r in sampling.hash_sample(hot.repartition(7), "k", 200).collect()}
    marked = sampling.mark_fraction(hot, "k", 0.25)
    assert marked.where("hit_first").count() == 75 and marked.where("hit_second").count() == 75
    split = sampling.stratified_split(hot, "y", "k")
    for y, n in ((True, 202), (False, 400)):
        test = round(n * 0.15)
        assert split.where(F.col("y") == y).groupBy("split").count().where("split = 'test'").first()["count"] == test
    assert split.count() == 602 and set(split.columns) == {"k", "v", "y", "split"}


def test_cells_follow_the_number_of_rows():
    from ladle.functions.hashing import CELL_ROWS, MOST_DIGITS, cell_digits

    assert cell_digits(0) == 1 and cell_digits(CELL_ROWS * 16) == 1 and cell_digits(CELL_ROWS * 17) == 2 and cell_digits(10**15) == MOST_DIGITS
