"""Dedupe, split, popularity, ranks and ranking metrics."""

from __future__ import annotations

from pyspark.sql import functions as F

from ladle.functions.flags import binary_label
from ladle.operators import dedupe, evaluation, popularity, ranks, sampling
from ladle.plans import inputs
from ladle.plans.catalog.registry import query, rounded
from ladle.session import materialize
from ladle.plans.inputs import ITEMS_SQL, LABELLED_SQL, RATINGS_SQL

SPLIT_CTE = """ordered AS (
  SELECT *, md5('42:' || id) AS h, count(*) OVER (PARTITION BY label) AS total,
         row_number() OVER (PARTITION BY label ORDER BY md5('42:' || id), id) AS r FROM ratings),
quotas AS (
  SELECT *, round(total * (1.0::DOUBLE - 0.7::DOUBLE - 0.15::DOUBLE)) AS n_test FROM ordered),
parts AS (
  SELECT *, CASE WHEN r <= n_test THEN 'test'
                 WHEN r <= n_test + round((total - n_test) * (0.15::DOUBLE / (0.7::DOUBLE + 0.15::DOUBLE))) THEN 'val'
                 ELSE 'train' END AS split FROM quotas)"""


def _split(spark, sf):
    return sampling.stratified_split(inputs.ratings(spark, sf), "label", "id")


def _stored_split(spark, sf):
    """The split as the table later stages read."""
    return materialize(_split(spark, sf).select("id", "rating", "label", "grp", "split"), "split")


@query("popularity_ranking", """
SELECT a.n_samples, a.roc_auc, g.macro_avg_precision_at_k, g.num_groups FROM (
  SELECT count(*) AS n_samples,
         round((sum(CASE WHEN label = 1 THEN rk END) - sum(label) * (sum(label) + 1) / 2.0::DOUBLE)
           / (sum(label)::DOUBLE * (count(*) - sum(label))), 8) AS roc_auc
  FROM (SELECT label, rank() OVER (ORDER BY score) + (count(*) OVER (PARTITION BY score) - 1) / 2.0::DOUBLE AS rk
        FROM scored)) a,
 (SELECT round(avg(p), 8) AS macro_avg_precision_at_k, count(*) AS num_groups FROM (
    SELECT grp, sum(label)::DOUBLE / count(*) AS p FROM (
      SELECT grp, label, row_number() OVER (PARTITION BY grp ORDER BY score DESC, id) AS rn FROM scored)
    WHERE rn <= 5 GROUP BY grp)) g""",
       (RATINGS_SQL, SPLIT_CTE, """fitted AS (
  SELECT grp, avg(rating) AS mean FROM parts WHERE split = 'train' GROUP BY grp),
scored AS (
  SELECT p.id, p.label, p.grp, round(coalesce(f.mean, (SELECT avg(rating) FROM parts WHERE split = 'train')), 9) AS score
  FROM parts p LEFT JOIN fitted f USING (grp) WHERE split = 'val')"""))
def popularity_ranking(spark, sf):
    """Flagship: label, split, fit group means on train, score val, AUC and grouped precision@5."""
    split = _stored_split(spark, sf)
    model = popularity.fit_popularity(split.where("split = 'train'"), "grp", "rating")
    scored = model.score(split.where("split = 'val'").select("id", "label", "grp"))
    out = evaluation.evaluate(rounded(scored, "score", digits=9), "grp")
    return rounded(out.select("n_samples", "roc_auc", "macro_avg_precision_at_k", "num_groups"),
                   "roc_auc", "macro_avg_precision_at_k")


@query("dedupe_first", """
SELECT recipe_id, recipe_name, url FROM (
  SELECT *, row_number() OVER (PARTITION BY recipe_name, url ORDER BY recipe_id) AS rn FROM items) WHERE rn = 1""",
       (ITEMS_SQL,))
def dedupe_first(spark, sf):
    df = inputs.items(spark, sf).select("recipe_id", "recipe_name", "url")
    return dedupe.dedupe_first(df, ["recipe_name", "url"], ["recipe_id"])


@query("duplicate_count", """
SELECT count(*) AS row_count, count(DISTINCT (recipe_name, url)) AS key_count,
       count(*) - count(DISTINCT (recipe_name, url)) AS duplicate_count FROM items""", (ITEMS_SQL,))
def duplicate_count(spark, sf):
    return dedupe.duplicate_count(inputs.items(spark, sf), ["recipe_name", "url"])


@query("binary_label", """
SELECT grp, count(*) AS n, sum(label)::BIGINT AS positive FROM ratings GROUP BY grp""", (RATINGS_SQL,))
def labels_by_group(spark, sf):
    df = inputs.ratings(spark, sf).withColumn("label", binary_label(F.col("rating")))
    return df.groupBy("grp").agg(F.count(F.lit(1)).alias("n"), F.sum("label").alias("positive"))


@query("stratified_split", "SELECT id, label, split FROM parts", (RATINGS_SQL, SPLIT_CTE))
def stratified_split(spark, sf):
    return _split(spark, sf).select("id", "label", "split")


@query("class_balance", """
SELECT split, count(*) AS rows, sum(label)::BIGINT AS positive, (count(*) - sum(label))::BIGINT AS negative,
       round(sum(label)::DOUBLE / count(*), 4) AS positive_rate FROM parts GROUP BY split""", (RATINGS_SQL, SPLIT_CTE))
def class_balance(spark, sf):
    return sampling.class_balance(_split(spark, sf), "label", "split")


@query("hash_sample", """
SELECT id, rating FROM ratings ORDER BY md5('42:' || id), id LIMIT 500""", (RATINGS_SQL,))
def hash_sample(spark, sf):
    return sampling.hash_sample(inputs.ratings(spark, sf), "id", 500).select("id", "rating")


@query("fold_assignment", """
SELECT doc_id, label, ((row_number() OVER (PARTITION BY label ORDER BY md5('42:' || doc_id), doc_id) - 1) % 5)::INTEGER AS fold
FROM labelled""", (LABELLED_SQL,))
def fold_assignment(spark, sf):
    df = inputs.labelled_text(spark, sf).select("doc_id", "label")
    return sampling.fold_assignment(df, "label", "doc_id")


@query("repeated_folds", """
SELECT doc_id, label, repeat,
       ((row_number() OVER (PARTITION BY repeat, label ORDER BY md5('42:' || repeat || ':' || doc_id), doc_id) - 1) % 5)::INTEGER AS fold
FROM (SELECT doc_id, label, unnest(range(10))::INTEGER AS repeat FROM labelled)""", (LABELLED_SQL,))
def repeated_folds(spark, sf):
    return sampling.repeated_folds(inputs.labelled_text(spark, sf), "label", "doc_id")


@query("group_stats", """
SELECT grp, round(avg(rating), 8) AS mean, round(stddev_samp(rating), 8) AS std, count(rating) AS count,
       (SELECT round(avg(m), 8) FROM (SELECT avg(rating) AS m FROM ratings GROUP BY grp)) AS mean_of_means
FROM ratings GROUP BY grp""", (RATINGS_SQL,))
def group_stats(spark, sf):
    stats = popularity.group_stats(inputs.ratings(spark, sf), "grp", "rating")
    overall = stats.select(F.avg("mean")).scalar()
    return rounded(stats.withColumn("mean_of_means", overall), "mean", "std", "mean_of_means")


@query("group_zscore", """
SELECT p.id, round(CASE WHEN f.s <> 0 THEN (rating - f.m) / f.s
       ELSE rating - coalesce(f.m, (SELECT avg(m) FROM fitted)) END, 8) AS zscore
FROM parts p LEFT JOIN fitted f USING (grp) WHERE split <> 'train'""",
       (RATINGS_SQL, SPLIT_CTE, """fitted AS (
  SELECT grp, avg(rating) AS m, stddev_samp(rating) AS s FROM parts WHERE split = 'train' GROUP BY grp)"""))
def group_zscore(spark, sf):
    split = _stored_split(spark, sf)
    model = popularity.fit_popularity(split.where("split = 'train'"), "grp", "rating")
    rest = split.where("split <> 'train'").select("id", "grp", "rating")
    return rounded(model.zscore(rest, "rating"), "zscore").select("id", "zscore")


@query("group_rank_pct", """
SELECT id, round((rank() OVER (PARTITION BY grp ORDER BY rating)
       + (count(*) OVER (PARTITION BY grp, rating) - 1) / 2.0::DOUBLE) / count(*) OVER (PARTITION BY grp), 8) AS rank_pct
FROM ratings""", (RATINGS_SQL,))
def group_rank_pct(spark, sf):
    df = inputs.ratings(spark, sf).select("id", "grp", "rating")
    return rounded(ranks.rank_pct(df, "rating", "rank_pct", ["grp"]), "rank_pct").select("id", "rank_pct")


@query("popularity_score", """
SELECT p.id, p.label, round(coalesce(f.m, (SELECT avg(rating) FROM parts WHERE split = 'train')), 8) AS score
FROM parts p LEFT JOIN fitted f USING (grp) WHERE split = 'val'""",
       (RATINGS_SQL, SPLIT_CTE, """fitted AS (
  SELECT grp, avg(rating) AS m FROM parts WHERE split = 'train' GROUP BY grp)"""))
def popularity_score(spark, sf):
    split = _stored_split(spark, sf)
    model = popularity.fit_popularity(split.where("split = 'train'"), "grp", "rating")
    return rounded(model.score(split.where("split = 'val'").select("id", "label", "grp")), "score").drop("grp")


@query("batch_rank_pct", """
SELECT id, round((rank() OVER (ORDER BY score) + (count(*) OVER (PARTITION BY score) - 1) / 2.0::DOUBLE)
       / count(*) OVER (), 8) AS rank_pct FROM ratings""", (RATINGS_SQL,))
def batch_rank_pct(spark, sf):
    df = inputs.ratings(spark, sf).select("id", "score")
    return rounded(ranks.rank_pct(df, "score"), "rank_pct").select("id", "rank_pct")


@query("rank_blend", """
SELECT id, round(0.5::DOUBLE * (rank() OVER (ORDER BY score) + (count(*) OVER (PARTITION BY score) - 1) / 2.0::DOUBLE) / count(*) OVER ()
  + 0.5::DOUBLE * (rank() OVER (ORDER BY discount) + (count(*) OVER (PARTITION BY discount) - 1) / 2.0::DOUBLE) / count(*) OVER (), 8) AS blend
FROM ratings""", (RATINGS_SQL,))
def rank_blend(spark, sf):
    df = inputs.ratings(spark, sf).select("id", "score", "discount")
    out = ranks.rank_blend(df, {"score": 0.5, "discount": 0.5}, "blend")
    return rounded(out, "blend").select("id", "blend")


@query("probability_blend", """
SELECT id, round(0.25::DOUBLE * discount + 0.75::DOUBLE * (rating / 5.0::DOUBLE), 8) AS blend FROM ratings""", (RATINGS_SQL,))
def probability_blend(spark, sf):
    df = inputs.ratings(spark, sf).withColumn("scaled", F.col("rating") / 5.0)
    return rounded(ranks.probability_blend(df, {"discount": 0.25, "scaled": 0.75}, "blend"), "blend").select("id", "blend")


AUC = """round((sum(CASE WHEN label = 1 THEN rk END) - sum(label) * (sum(label) + 1) / 2.0::DOUBLE)
           / (sum(label)::DOUBLE * (count(*) - sum(label))), 8)"""


@query("roc_auc", f"""
SELECT {AUC} AS roc_auc
FROM (SELECT label, rank() OVER (ORDER BY score) + (count(*) OVER (PARTITION BY score) - 1) / 2.0::DOUBLE AS rk FROM ratings)""",
       (RATINGS_SQL,))
def roc_auc(spark, sf):
    return rounded(evaluation.roc_auc(inputs.ratings(spark, sf)), "roc_auc")


@query("roc_auc_by_group", f"""
SELECT grp, {AUC} AS roc_auc
FROM (SELECT grp, label, rank() OVER (PARTITION BY grp ORDER BY score)
      + (count(*) OVER (PARTITION BY grp, score) - 1) / 2.0::DOUBLE AS rk FROM ratings) GROUP BY grp""", (RATINGS_SQL,))
def roc_auc_by_group(spark, sf):
    return rounded(evaluation.roc_auc(inputs.ratings(spark, sf), groups=["grp"]), "roc_auc")


@query("roc_points", """
SELECT discount AS threshold,
       round(sum(sum(1 - label)) OVER w / sum(sum(1 - label)) OVER ()::DOUBLE, 8) AS fpr,
       round(sum(sum(label)) OVER w / sum(sum(label)) OVER ()::DOUBLE, 8) AS tpr
FROM ratings GROUP BY discount WINDOW w AS (ORDER BY discount DESC)
UNION ALL SELECT 'infinity'::DOUBLE, 0.0::DOUBLE, 0.0::DOUBLE""", (RATINGS_SQL,))
def roc_points(spark, sf):
    return rounded(evaluation.roc_points(inputs.ratings(spark, sf), score="discount"), "fpr", "tpr")


@query("precision_at_k", """
SELECT round(sum(label)::DOUBLE / count(*), 8) AS precision_at_k
FROM (SELECT label FROM ratings ORDER BY score DESC, id LIMIT 5)""", (RATINGS_SQL,))
def precision_at_k(spark, sf):
    return rounded(evaluation.precision_at_k(inputs.ratings(spark, sf)), "precision_at_k")


PER_GROUP = """per_group AS (
  SELECT grp, sum(label) FILTER (rn <= 5)::DOUBLE / least(count(*), 5) AS precision_at_k, count(*) AS group_size
  FROM (SELECT grp, label, row_number() OVER (PARTITION BY grp ORDER BY score DESC, id) AS rn FROM ratings) GROUP BY grp)"""


@query("grouped_precision_at_k", """
SELECT grp, round(precision_at_k, 8) AS precision_at_k, group_size,
       round((SELECT avg(precision_at_k) FROM per_group), 8) AS macro_avg, (SELECT count(*) FROM per_group) AS num_groups
FROM per_group""", (RATINGS_SQL, PER_GROUP))
def grouped_precision_at_k(spark, sf):
    per = materialize(evaluation.grouped_precision_at_k(inputs.ratings(spark, sf), "grp"), "per-group")
    macro = evaluation.macro_precision(per)
    out = per.withColumn("m", macro.select(F.struct("*")).scalar()).select(
        *per.columns, F.col("m.macro_avg_precision_at_k").alias("macro_avg"), "m.num_groups")
    return rounded(out, "precision_at_k", "macro_avg")


@query("largest_groups", """
SELECT grp, round(precision_at_k, 8) AS precision_at_k, group_size FROM per_group ORDER BY group_size DESC, grp LIMIT 20""",
       (RATINGS_SQL, PER_GROUP))
def largest_groups(spark, sf):
    per = evaluation.grouped_precision_at_k(inputs.ratings(spark, sf), "grp")
    return rounded(evaluation.largest_groups(per, "grp"), "precision_at_k")


@query("evaluate_bundle", f"""
SELECT (SELECT count(*) FROM ratings) AS n_samples, (SELECT round(avg(label), 8) FROM ratings) AS positive_rate,
  (SELECT {AUC} FROM (SELECT label, rank() OVER (ORDER BY score) + (count(*) OVER (PARTITION BY score) - 1) / 2.0::DOUBLE AS rk FROM ratings)) AS roc_auc,
  (SELECT round(avg(label), 8) FROM (SELECT label FROM ratings ORDER BY score DESC, id LIMIT 5)) AS precision_at_k_overall,
  5 AS k, (SELECT round(avg(precision_at_k), 8) FROM per_group) AS macro_avg_precision_at_k,
  (SELECT count(*) FROM per_group) AS num_groups""", (RATINGS_SQL, PER_GROUP))
def evaluate_bundle(spark, sf):
    out = evaluation.evaluate(inputs.ratings(spark, sf), "grp")
    return rounded(out, "positive_rate", "roc_auc", "precision_at_k_overall", "macro_avg_precision_at_k")


@query("fold_summary", """
SELECT grp AS model, round(avg(score), 6) AS mean_auc, round(stddev_pop(score), 6) AS std_auc,
       round(quantile_cont(score, 0.5), 6) AS median_auc, min(score) AS min_auc, max(score) AS max_auc, count(score) AS n_folds
FROM ratings GROUP BY grp""", (RATINGS_SQL,))
def fold_summary(spark, sf):
    df = inputs.ratings(spark, sf).select(F.col("grp").alias("model"), F.col("score").alias("auc"))
    return rounded(evaluation.fold_summary(df), "mean_auc", "std_auc", "median_auc", digits=6)


@query("oof_average", """
SELECT l_orderkey AS row_id, round(avg(l_discount), 8) AS oof_score, count(*) AS n_scores FROM lineitem GROUP BY l_orderkey""")
def oof_average(spark, sf):
    df = inputs.table(spark, sf, "lineitem").select(F.col("l_orderkey").alias("row_id"), F.col("l_discount").alias("score"))
    return rounded(evaluation.oof_average(df, "row_id"), "oof_score")


@query("leaderboard", """
WITH m AS (SELECT grp AS model, round(avg(rating), 8) AS metric FROM ratings GROUP BY grp)
SELECT model, metric, model = (SELECT model FROM m ORDER BY metric DESC, model DESC LIMIT 1) AS winner FROM m""",
       (RATINGS_SQL,))
def leaderboard(spark, sf):
    df = inputs.ratings(spark, sf).groupBy(F.col("grp").alias("model")).agg(F.round(F.avg("rating"), 8).alias("metric"))
    return evaluation.leaderboard(df, "model", "metric")


@query("order_batches", """
SELECT o_orderkey, ((row_number() OVER (ORDER BY o_orderdate, o_orderkey) - 1) // 20)::BIGINT AS batch_id FROM orders""")
def order_batches(spark, sf):
    df = inputs.table(spark, sf, "orders").select("o_orderkey", "o_orderdate")
    return ranks.batches(df, ["o_orderdate", "o_orderkey"], 20).select("o_orderkey", "batch_id")


@query("numbered_ids", """
SELECT o_orderkey, 'test_' || (row_number() OVER (ORDER BY o_orderkey) - 1) AS recipe_id FROM orders""")
def numbered_ids(spark, sf):
    df = inputs.table(spark, sf, "orders").select("o_orderkey")
    return ranks.numbered_ids(df, ["o_orderkey"], "test_", "recipe_id")
