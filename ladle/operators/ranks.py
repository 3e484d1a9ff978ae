"""Percentile ranks, blends, ranked lists and batches."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from ladle.operators.ordering import row_positions, sort_keys, value_ranks
from ladle.operators.skew import attach
from ladle.session import materialize

# Spark drops rows beyond k before the shuffle only up to this limit (its own default). The order is the same for any k.
_PRUNED_K = 1000


def rank_pct(df: DataFrame, value: str, name: str = "rank_pct", groups: Sequence[str] = ()) -> DataFrame:
    """Average-rank percentile of ``value`` in its group (or the whole table); ties share their mean rank.

    NULL and NaN values get NULL and do not count; so do rows of a NULL group.
    """
    groups = list(groups)
    known = df
    for g in groups:
        known = known.where(F.col(g).isNotNull())
    table = value_ranks(known, value, groups).select(
        *groups,
        value,
        F.col("n").alias("__n"),
        ((F.col("before_n") + (F.col("n") + 1) / F.lit(2.0)) / F.col("total_n")).cast("double").alias(name),
    )
    return attach(df, table, [*groups, value], weight="__n").drop("__n")


def rank_blend(
    df: DataFrame, weights: Mapping[str, float], name: str = "score", groups: Sequence[str] = ()
) -> DataFrame:
    """Weighted sum of percentile ranks of several score columns, within each group."""
    out, total = df, F.lit(0.0)
    for i, (col, weight) in enumerate(weights.items()):
        out = rank_pct(out, col, f"__p{i}", groups)
        total = total + F.lit(float(weight)) * F.col(f"__p{i}")
    return out.withColumn(name, total).drop(*[f"__p{i}" for i in range(len(weights))])


def probability_blend(df: DataFrame, weights: Mapping[str, float], name: str = "score") -> DataFrame:
    total = F.lit(0.0)
    for col, weight in weights.items():
        total = total + F.lit(float(weight)) * F.col(col)
    return df.withColumn(name, total)


def ranked(
    df: DataFrame,
    score: str,
    tie: str,
    groups: Sequence[str] = (),
    top_k: int | None = None,
    name: str = "rank",
) -> DataFrame:
    """1-based rank by score (descending, then NaN, then NULL), ties by ``tie``; optionally only the best ``top_k``.

    One order for every ``top_k``. A small one is pruned per task before the shuffle; otherwise the scored rows are
    stored once and positions come from range partitions.
    """
    by = sort_keys(df, [(score, "desc"), tie])
    if top_k is not None and top_k <= _PRUNED_K and groups:
        return df.withColumn(name, F.row_number().over(Window.partitionBy(*groups).orderBy(*by)).cast("bigint")).where(F.col(name) <= top_k)
    if top_k is not None and top_k <= _PRUNED_K:
        best = df.orderBy(*by).limit(top_k)  # at most top_k rows are left
        return best.withColumn(name, F.row_number().over(Window.orderBy(*by)).cast("bigint"))
    out = row_positions(materialize(df, "scored"), [(score, "desc"), tie], groups, name)
    return out if top_k is None else out.where(F.col(name) <= top_k)


def batches(df: DataFrame, order: Sequence[str], size: int, name: str = "batch_id") -> DataFrame:
    """Consecutive batches of ``size`` rows in the given total order, numbered from 0."""
    placed = row_positions(df, list(order), name="__pos")
    return placed.withColumn(name, F.floor((F.col("__pos") - 1) / F.lit(size)).cast("bigint")).drop("__pos")


def numbered_ids(df: DataFrame, order: Sequence[str], prefix: str, name: str, start: int = 0) -> DataFrame:
    """Synthetic ids ``prefix`` + position in a total order."""
    placed = row_positions(df, list(order), name="__pos")
    text = (F.col("__pos") + F.lit(start - 1)).cast("string")
    return placed.withColumn(name, F.concat(F.lit(prefix), text)).drop("__pos")


def latest(df: DataFrame, order: str, n: int, tie: str | None = None) -> DataFrame:
    """The ``n`` newest rows (a bounded report: each task keeps its own n best first)."""
    keys = [F.desc(order)] + ([F.desc(tie)] if tie else [])
    return df.orderBy(*keys).limit(n)
