"""Two-sample drift tests between a reference and a current table."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ladle.functions import fixed
from ladle.operators.ordering import value_ranks


def drift_columns(df: DataFrame, columns: Sequence[str]) -> tuple[list[str], list[str]]:
    """Present and missing drift columns; a missing one is itself a sign of schema drift."""
    return [c for c in columns if c in df.columns], [c for c in columns if c not in df.columns]


def _stack(df: DataFrame, columns: Sequence[str], current: bool, groups: Sequence[str] = ()) -> DataFrame:
    pairs = F.array(*[F.struct(F.lit(c).alias("column"), F.col(c).cast("double").alias("v")) for c in columns])
    return df.select(*groups, F.explode(pairs).alias("p")).select(
        *groups, "p.column", "p.v", F.lit(1 if current else 0).cast("bigint").alias("cur"),
        F.lit(0 if current else 1).cast("bigint").alias("ref"),
    ).where(F.col("v").isNotNull() & ~F.isnan("v"))


def _steps(
    current: DataFrame, reference: DataFrame, columns: Sequence[str], groups: Sequence[str] = ()
) -> DataFrame:
    """Both empirical distribution functions at every distinct value of every column."""
    both = _stack(reference, columns, False, groups).unionByName(_stack(current, columns, True, groups))
    ranks = value_ranks(both, "v", [*groups, "column"], {"cur": F.col("cur"), "ref": F.col("ref")})

    def share(x: str) -> Column:
        total = F.nullif(F.col(f"total_{x}").cast("double"), F.lit(0.0))
        return (F.col(f"before_{x}") + F.col(x)).cast("double") / total

    return ranks.select(
        *groups, "column", "v", "next_value", "n", "cur", "ref", "total_cur", "total_ref",
        (share("cur") - share("ref")).alias("gap"),
    )


def kolmogorov_p(d: Column, n: Column, m: Column, terms: int = 101) -> Column:
    """Asymptotic two-sided p-value of the two-sample statistic."""
    en = F.sqrt(n.cast("double") * m.cast("double") / (n + m).cast("double"))
    x = en * d
    series = F.aggregate(
        F.sequence(F.lit(1), F.lit(terms - 1)),
        F.lit(0.0),
        lambda acc, k: acc + F.when(k % 2 == 1, F.lit(2.0)).otherwise(F.lit(-2.0)) * F.exp(
            F.lit(-2.0) * k * k * x * x),
    )
    p = F.least(F.greatest(series, F.lit(0.0)), F.lit(1.0))
    # Below 0.2 the alternating series has not settled while the true value is 1 to twelve digits.
    return F.when(x < 0.2, F.lit(1.0)).otherwise(p)


def _summary(
    current: DataFrame, reference: DataFrame, columns: Sequence[str], groups: Sequence[str] = ()
) -> DataFrame:
    """Per column: sizes, largest gap with its p-value, and the area between both distribution functions
    over the reference deviation. Both tests come from one rank table."""
    keys = [*groups, "column"]
    base = _steps(current, reference, columns, groups).groupBy(*keys).agg(
        F.max("total_cur").alias("n_current"),
        F.max("total_ref").alias("n_reference"),
        F.max(F.abs("gap")).alias("ks_statistic"),
        F.coalesce(F.sum(F.abs("gap") * (F.col("next_value") - F.col("v"))), F.lit(0.0)).alias("area"),
    )
    dev = _stack(reference, columns, False).groupBy("column").agg(F.stddev_pop("v").alias("dev"))
    p = kolmogorov_p(F.col("ks_statistic"), F.col("n_current"), F.col("n_reference"))
    return base.join(dev, "column").select(
        *keys, "n_current", "n_reference", "ks_statistic", p.alias("ks_p_value"),
        (F.col("area") / F.greatest(F.col("dev"), F.lit(0.001))).alias("distance"),
    )


def _below(c: str, alpha: float) -> Column:
    return F.coalesce(F.col(c) < alpha, F.lit(False))


def ks_drift(
    current: DataFrame, reference: DataFrame, columns: Sequence[str], alpha: float = fixed.P_DRIFTED
) -> DataFrame:
    """Kolmogorov-Smirnov per column: sizes, statistic, p-value and the decision ``p < alpha``."""
    return _summary(current, reference, columns).select(
        "column", "n_current", "n_reference", F.col("ks_statistic").alias("statistic"),
        F.col("ks_p_value").alias("p_value"), _below("ks_p_value", alpha).alias("drifted"),
    )


def wasserstein_drift(
    current: DataFrame, reference: DataFrame, columns: Sequence[str], at_least: float = fixed.DISTANCE_DRIFTED
) -> DataFrame:
    """Area between both distribution functions over the reference deviation; drifted from ``at_least``."""
    return _summary(current, reference, columns).select(
        "column", F.col("distance").alias("statistic"), (F.col("distance") >= at_least).alias("drifted")
    )


def drift_report(
    current: DataFrame,
    reference: DataFrame,
    columns: Sequence[str],
    method: str = "wasserstein",
    groups: Sequence[str] = (),
) -> DataFrame:
    """Per column: the method, its value and its decision.

    ``method`` is ``ks`` (p-value) or ``wasserstein`` (distance over the reference deviation); it never depends on the
    number of rows, and it is part of the result, so a distance is never read as a p-value. ``groups`` name columns of
    both tables that separate several comparisons made in one pass.
    """
    if method not in ("ks", "wasserstein"):
        raise ValueError(f"unknown method {method}")
    p_value = method == "ks"
    return _summary(current, reference, columns, groups).select(
        *groups,
        "column",
        F.lit("ks_p_value" if p_value else "wasserstein_normed").alias("method"),
        F.col("ks_p_value" if p_value else "distance").alias("value"),
        (_below("ks_p_value", fixed.P_DRIFTED) if p_value else F.col("distance") >= fixed.DISTANCE_DRIFTED).alias("drifted"),
    )


def dataset_drift(
    per_column: DataFrame, above: float = fixed.SHARE_DRIFTED, groups: Sequence[str] = ()
) -> DataFrame:
    """Share of drifted columns and the verdict ``share > above``."""
    share = F.avg(F.col("drifted").cast("double"))
    return per_column.groupBy(*groups).agg(
        share.alias("drifted_column_share"),
        F.coalesce(share > above, F.lit(False)).alias("dataset_drift_detected"),
    )


def verify_alerts(results: DataFrame, expected: Mapping[str, bool]) -> DataFrame:
    """Compare ``(scenario, quality_check_issues, dataset_drift_detected)`` with what was injected."""
    want = F.create_map(*[x for k, v in expected.items() for x in (F.lit(k), F.lit(v))])
    detected = (F.col("quality_check_issues") > 0) | F.coalesce("dataset_drift_detected", F.lit(False))
    return results.select(
        "scenario",
        want[F.col("scenario")].alias("expected_anomaly"),
        detected.alias("detected_anomaly"),
        (detected == want[F.col("scenario")]).alias("correctly_classified"),
        "quality_check_issues",
        F.coalesce("dataset_drift_detected", F.lit(False)).alias("dataset_drift_detected"),
    )
