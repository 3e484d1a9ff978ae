"""Run selection, promotion gate and champion registry as table logic."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def latest_run(runs: DataFrame, run_name: str, status: str = "FINISHED") -> DataFrame:
    """The newest run with this name and status; no row when there is none."""
    return (
        runs.where((F.col("run_name") == run_name) & (F.col("status") == status))
        .orderBy(F.desc("start_time"), F.desc("run_id"))
        .limit(1)
    )


def decision(candidate: Column, champion: Column, has_champion: Column) -> Column:
    """Promote when there is no champion yet or the metric is strictly greater; a missing metric is skipped.

    Without a champion the bar is 0, as for a first run.
    """
    bar = F.when(has_champion, champion).otherwise(F.lit(0.0))
    return (
        F.when(candidate.isNull(), "skipped: missing validation metric")
        .when(candidate > F.coalesce(bar, F.lit(0.0)), "promoted")
        .otherwise("skipped: no improvement")
    )


def promotion_decision(
    runs: DataFrame, registry: DataFrame, run_name: str, metric: str, alias: str = "champion"
) -> DataFrame:
    """One row ``(run_id, candidate, champion, decision)``; also when no finished run exists.

    ``runs`` has a ``metrics`` map; ``registry`` rows are promoted versions with alias, metric and time.
    """
    champion = registry.where(F.col("alias") == alias).agg(
        F.max_by("metric_value", F.struct("promoted_at", "version")).alias("champion"),
        (F.count(F.lit(1)) > 0).alias("has_champion"),
    )
    best = latest_run(runs, run_name).select(
        "run_id", F.try_element_at("metrics", F.lit(metric)).cast("double").alias("candidate")
    )
    pick = best.agg(F.first("run_id").alias("run_id"), F.first("candidate").alias("candidate"))
    out = pick.withColumns({
        "champion": champion.select("champion").scalar(), "__has": champion.select("has_champion").scalar()
    })
    verdict = F.when(F.col("run_id").isNull(), "skipped: no candidate run found").otherwise(
        decision(F.col("candidate"), F.col("champion"), F.col("__has"))
    )
    return out.withColumn("decision", verdict).drop("__has")


def register(
    registry: DataFrame, decisions: DataFrame, alias: str, promoted_at: Column, tags: Mapping[str, str] | None = None
) -> DataFrame:
    """Registry rows to append for promoted runs: next version, metric, alias, time and tags.

    The alias belongs to the newest version that carries it, so appending moves it. Only decisions that
    passed the gate produce a row.
    """
    last = registry.agg(F.coalesce(F.max("version"), F.lit(0))).scalar()
    pairs = [x for k, v in (tags or {}).items() for x in (F.lit(k), F.lit(v))]
    tag_map = F.create_map(*pairs).cast("map<string,string>")
    return decisions.where(F.col("decision") == "promoted").select(
        (last + 1).cast("bigint").alias("version"),
        "run_id",
        F.col("candidate").alias("metric_value"),
        F.lit(alias).alias("alias"),
        promoted_at.alias("promoted_at"),
        tag_map.alias("tags"),
    )


def current_champion(registry: DataFrame, alias: str = "champion") -> DataFrame:
    """The newest version that carries the alias, with its tags where the registry has them."""
    shown = [c for c in ("version", "run_id", "metric_value", "tags") if c in registry.columns]
    newest = F.max_by(F.struct(*shown), F.struct("promoted_at", "version"))
    return registry.where(F.col("alias") == alias).agg(newest.alias("c")).select("c.*")
