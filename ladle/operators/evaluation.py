"""Exact ranking metrics: ROC-AUC, ROC points, precision@k, bundles and fold summaries."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ladle.operators.ordering import exact_quantiles, value_ranks
from ladle.operators.ranks import ranked
from ladle.session import materialize

_WIDE = "decimal(38,0)"


def _curve(df: DataFrame, label: str, score: str, groups: Sequence[str]) -> DataFrame:
    pos = (F.col(label) == 1).cast("bigint")
    neg = (F.col(label) == 0).cast("bigint")
    return value_ranks(df, score, groups, {"pos": pos, "neg": neg})


def roc_auc(df: DataFrame, label: str = "label", score: str = "score", groups: Sequence[str] = ()) -> DataFrame:
    """Area under the ROC curve with ties counted half, per group or overall; NULL with one class only.

    Rows are first combined per score, then only sums of whole numbers are needed.
    """
    curve = _curve(df, label, score, groups)
    above = F.col("total_pos") - F.col("before_pos") - F.col("pos")
    twice = F.col("neg").cast("decimal(19,0)") * (above * 2 + F.col("pos")).cast("decimal(19,0)")
    pairs = F.max("total_pos").cast("double") * F.max("total_neg").cast("double")
    auc = F.sum(twice.cast(_WIDE)).cast("double") / F.nullif(pairs * 2.0, F.lit(0.0))
    return curve.groupBy(*groups).agg(auc.alias("roc_auc"))


def roc_points(df: DataFrame, label: str = "label", score: str = "score") -> DataFrame:
    """(threshold, fpr, tpr): the start point, no row above an infinite threshold, and for every distinct score the rates among rows scored
    at or above it. An empty table has no point."""
    curve = _curve(df, label, score, ())

    def rate(x: str) -> Column:
        above = (F.col(f"total_{x}") - F.col(f"before_{x}")).cast("double")
        return above / F.nullif(F.col(f"total_{x}").cast("double"), F.lit(0.0))

    points = curve.select(F.col(score).cast("double").alias("threshold"), rate("neg").alias("fpr"), rate("pos").alias("tpr"))
    nothing = F.lit(0.0)
    start = df.where(F.col(score).isNotNull()).limit(1).select(F.lit(float("inf")).alias("threshold"), nothing.alias("fpr"), nothing.alias("tpr"))
    return points.union(start)


def precision_at_k(
    df: DataFrame, label: str = "label", score: str = "score", k: int = 5, tie: str = "id"
) -> DataFrame:
    """Share of positives among the ``k`` best rows (fewer if there are fewer); NULL for an empty table."""
    best = df.select(label, score, tie).orderBy(F.desc_nulls_last(score), tie).limit(k)
    return best.agg((F.sum(label) / F.nullif(F.count(F.lit(1)), F.lit(0))).cast("double").alias("precision_at_k"))


def grouped_precision_at_k(
    df: DataFrame, group: str, label: str = "label", score: str = "score", k: int = 5, tie: str = "id"
) -> DataFrame:
    """Precision@k and size per group. Rows beyond k per group and task are dropped before the shuffle."""
    known = df.where(F.col(group).isNotNull())
    best = ranked(known.select(group, label, score, tie), score, tie, [group], k, "__rn")
    top = best.groupBy(group).agg((F.sum(label) / F.count(F.lit(1))).cast("double").alias("precision_at_k"))
    sizes = known.groupBy(group).agg(F.count(F.lit(1)).alias("group_size"))
    return sizes.join(top, group).select(group, "precision_at_k", "group_size")


def macro_precision(per_group: DataFrame) -> DataFrame:
    return per_group.agg(
        F.avg("precision_at_k").alias("macro_avg_precision_at_k"), F.count(F.lit(1)).alias("num_groups")
    )


def largest_groups(per_group: DataFrame, group: str, n: int = 20) -> DataFrame:
    """The ``n`` largest groups of a per-group table, the data behind a bar chart."""
    return per_group.orderBy(F.desc("group_size"), group).limit(n)


def evaluate(
    df: DataFrame,
    group: str | None = None,
    label: str = "label",
    score: str = "score",
    k: int = 5,
    tie: str = "id",
) -> DataFrame:
    """One row: sample count, positive rate, AUC, precision@k, k, and macro precision@k over groups.

    The predictions are stored once as a narrow table, which every metric then reads.
    """
    df = materialize(df.select(*dict.fromkeys([label, score, tie, *([group] if group else [])])), "predictions")
    out = df.agg(
        F.count(F.lit(1)).alias("n_samples"),
        F.avg(F.col(label).cast("double")).alias("positive_rate"),
    )
    out = out.withColumns({
        "roc_auc": roc_auc(df, label, score).scalar(),
        "precision_at_k_overall": precision_at_k(df, label, score, k, tie).scalar(),
        "k": F.lit(k),
    })
    if group is not None:
        macro = macro_precision(grouped_precision_at_k(df, group, label, score, k, tie))
        out = out.withColumn("__m", macro.select(F.struct("*")).scalar()).select(
            "*", "__m.macro_avg_precision_at_k", "__m.num_groups").drop("__m")
    return out


def evaluate_models(
    df: DataFrame, models: DataFrame, group: str | None = None, label: str = "label", score: str = "score", k: int = 5, tie: str = "id",
) -> DataFrame:
    """The row of ``evaluate`` for each of ``models`` (model), whose predictions are stacked in ``df``: all models in the same passes."""
    df = materialize(df.select(*dict.fromkeys(["model", label, score, tie, *([group] if group else [])])), "predictions")
    counted = df.groupBy("model").agg(F.count(F.lit(1)).alias("n_samples"), F.avg(F.col(label).cast("double")).alias("positive_rate"))
    rank = F.row_number().over(Window.partitionBy("model").orderBy(F.desc_nulls_last(score), tie))
    best = df.withColumn("__rn", rank).where(F.col("__rn") <= k).groupBy("model").agg(
        (F.sum(label) / F.count(F.lit(1))).cast("double").alias("precision_at_k_overall"))
    out = models.join(counted, "model", "left").join(roc_auc(df, label, score, ["model"]), "model", "left").join(best, "model", "left")
    columns = [F.coalesce("n_samples", F.lit(0).cast("bigint")).alias("n_samples"), "positive_rate", "roc_auc", "precision_at_k_overall", F.lit(k).alias("k")]
    if group is not None:
        both = df.withColumn("__group", F.when(F.col(group).isNotNull(), F.struct("model", group)))
        macro = grouped_precision_at_k(both, "__group", label, score, k, tie).groupBy(F.col("__group.model").alias("model")).agg(
            F.avg("precision_at_k").alias("macro_avg_precision_at_k"), F.count(F.lit(1)).alias("num_groups"))
        out = out.join(macro, "model", "left")
        columns += ["macro_avg_precision_at_k", F.coalesce("num_groups", F.lit(0).cast("bigint")).alias("num_groups")]
    return out.select(*columns, "model")


def fold_summary(df: DataFrame, model: str = "model", value: str = "auc") -> DataFrame:
    """Mean, population deviation, exact median, extremes and count of fold scores per model."""
    df = df.where(F.col(model).isNotNull())
    base = df.groupBy(model).agg(
        F.avg(value).alias("mean_auc"),
        F.stddev_pop(value).alias("std_auc"),
        F.min(value).alias("min_auc"),
        F.max(value).alias("max_auc"),
        F.count(value).alias("n_folds"),
    )
    median = exact_quantiles(df, value, {"median_auc": 0.5}, [model], "linear")
    return base.join(median, model, "left").select(
        model, "mean_auc", "std_auc", "median_auc", "min_auc", "max_auc", "n_folds"
    )


def oof_average(df: DataFrame, key: str, score: str = "score") -> DataFrame:
    """Mean held-out score per row over all repeats."""
    return df.groupBy(key).agg(F.avg(score).alias("oof_score"), F.count(score).alias("n_scores"))


def leaderboard(df: DataFrame, model: str, metric: str) -> DataFrame:
    """Models by metric, best first, with the winner marked. One row per model, so the sort is small."""
    best = df.select(F.max_by(model, F.struct(F.col(metric), F.col(model)))).scalar()
    return df.withColumn("winner", F.col(model) == best).orderBy(F.desc(metric), F.desc(model))
