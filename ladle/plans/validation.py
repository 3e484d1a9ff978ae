"""Checks that span several operators: alert verification and production validation."""

from __future__ import annotations

from collections.abc import Callable, Mapping, Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ladle.functions import fixed
from ladle.operators import drift, evaluation, inject, quality, ranks
from ladle.operators.dedupe import dedupe_first
from ladle.operators.skew import attach
from ladle.session import materialize

# Scenarios and whether each must be noticed.
EXPECTED = {
    "clean_baseline": False,
    "missing_values": True,
    "out_of_range": True,
    "schema_swap": True,
    "schema_change": True,
}


def scenarios(clean: DataFrame, seed: int = 42) -> dict[str, DataFrame]:
    return {
        "clean_baseline": clean,
        "missing_values": inject.fault_nulls(clean, seed=seed).drop("affected"),
        "out_of_range": inject.fault_ranges(clean, seed=seed).drop("affected"),
        "schema_swap": inject.column_swap(clean).drop("affected"),
        "schema_change": inject.column_change(clean).drop("affected"),
    }


def alert_verification(
    clean: DataFrame,
    order: str = "recipe_id",
    columns: Sequence[str] = tuple(fixed.PLAUSIBLE),
    seed: int = 42,
    expected: Mapping[str, bool] = EXPECTED,
) -> DataFrame:
    """Inject every fault, run quality checks and drift tests on each, and compare with what was injected."""
    faulty = scenarios(clean, seed)
    issues = None
    comparable = None
    for name, batch in faulty.items():
        row = quality.batch_findings(batch, clean, order).agg(F.count(F.lit(1)).alias("quality_check_issues"))
        row = row.withColumn("scenario", F.lit(name))
        issues = row if issues is None else issues.unionByName(row)
        if not drift.drift_columns(batch, columns)[1]:  # a changed schema cannot be compared
            part = batch.select(F.lit(name).alias("scenario"), *columns)
            comparable = part if comparable is None else comparable.unionByName(part)
    names = [n for n, b in faulty.items() if not drift.drift_columns(b, columns)[1]]
    reference = clean.select(F.explode(F.array(*[F.lit(n) for n in names])).alias("scenario"), *columns)
    report = drift.drift_report(comparable, reference, columns, groups=["scenario"])
    found = drift.dataset_drift(report, groups=["scenario"]).drop("drifted_column_share")
    return drift.verify_alerts(issues.join(found, "scenario", "left"), expected)


def attach_predictions(rows: DataFrame, predictions: DataFrame, key: str, order: Sequence) -> DataFrame:
    """Left join of predictions by id; of several for one id the one returned last, by ``order``, counts."""
    last = dedupe_first(predictions, [key], [F.desc(c) for c in order])
    return attach(rows, last.select(key, F.col("score").alias("predicted_score")), [key])


def production_validation(
    rows: DataFrame,
    score_batches: Callable[[DataFrame], DataFrame],
    key: str = "recipe_id",
    order: Sequence[str] = ("pos",),
    batch_size: int = 20,
    offline_auc: float | None = None,
    batch_value: str | None = None,
) -> DataFrame:
    """Score candidates in fixed batches, each ranked by itself, and compare the pooled AUC with the offline one.

    ``score_batches`` gets the rows with ``batch_id`` and returns ``(key, score, batch_id, returned)``; ``returned`` orders the
    predictions of a batch. Of several predictions for one id the last by batch and position counts. ``batch_value`` names a
    column with one value a batch, such as its latency; its mean and maximum are over batches, not rows.
    """
    batched = materialize(ranks.batches(rows, list(order), batch_size), "batched")
    predicted = materialize(score_batches(batched), "returned")
    joined = materialize(attach_predictions(rows, predicted, key, ["batch_id", "returned"]), "predicted")
    scored = joined.where(F.col("predicted_score").isNotNull())
    auc = evaluation.roc_auc(scored, "label", "predicted_score").scalar()
    out = joined.agg(
        F.count(F.lit(1)).alias("candidates_sent"),
        F.count("predicted_score").alias("candidates_scored"),
        F.count(F.when(F.col("predicted_score").isNull(), 1)).alias("candidates_missing_prediction"),
        F.avg("predicted_score").alias("mean_score"),
        F.max("predicted_score").alias("max_score"),
    )
    offline = F.lit(offline_auc).cast("double")
    out = out.withColumns({"production_roc_auc": auc, "offline_validation_roc_auc": offline}).withColumns({
        "auc_delta": F.col("production_roc_auc") - offline,
        "passed": F.col("production_roc_auc").isNotNull() & (F.col("candidates_missing_prediction") == 0),
    })
    if batch_value is not None:
        per_batch = predicted.groupBy("batch_id").agg(F.max(batch_value).alias("v"))
        out = out.withColumns({f"{f.__name__}_batch_value": per_batch.select(f("v")).scalar() for f in (F.mean, F.max)})
    return out
