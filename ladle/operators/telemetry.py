"""Request telemetry: counts, error rates and exact latency percentiles."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ladle.operators.ordering import exact_quantiles
from ladle.operators.ranks import latest


def counters(status: str = "status_code") -> list[Column]:
    """Count, server errors and error rate (four decimals)."""
    n = F.count(F.lit(1))
    bad = F.count(F.when(F.col(status) >= 500, 1))
    rate = F.coalesce(F.round(bad / F.nullif(n, F.lit(0)), 4), F.lit(0.0))
    return [n.alias("request_count"), bad.alias("error_count"), rate.alias("error_rate")]


def telemetry_overall(log: DataFrame, latency: str = "latency_ms", status: str = "status_code") -> DataFrame:
    """One row: counters, mean, p50 and p95 (nearest rank, two decimals)."""
    base = log.agg(*counters(status), F.round(F.avg(latency), 2).alias("mean_ms"))
    q = exact_quantiles(log, latency, {"p50": 0.5, "p95": 0.95})
    return base.withColumn("__q", q.select(F.struct("p50", "p95")).scalar()).select(
        *base.columns, F.round("__q.p50", 2).alias("p50_ms"), F.round("__q.p95", 2).alias("p95_ms"))


def telemetry_by_path(log: DataFrame, latency: str = "latency_ms", status: str = "status_code") -> DataFrame:
    """Counters, mean and p95 per ``method path``; a path with a third of all requests stays spread."""
    keyed = log.withColumn("endpoint", F.concat_ws(" ", "method", "path"))
    n, bad, _ = counters(status)
    base = keyed.groupBy("endpoint").agg(
        n.alias("count"), bad.alias("error_count"), F.round(F.avg(latency), 2).alias("mean_latency_ms")
    )
    q = exact_quantiles(keyed, latency, {"p95_latency_ms": 0.95}, ["endpoint"])
    return base.join(q.withColumn("p95_latency_ms", F.round("p95_latency_ms", 2)), "endpoint", "left")


def recent_requests(log: DataFrame, n: int = 2000, order: str = "ts", tie: str = "event_id") -> DataFrame:
    return latest(log, order, n, tie)
