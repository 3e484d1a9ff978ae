"""Group rating statistics and the popularity ranker built on them."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ladle.operators.skew import attach
from ladle.session import materialize


def group_stats(df: DataFrame, group: str, value: str) -> DataFrame:
    """Mean, sample deviation and count per group; NULL groups are left out. Combines before the shuffle."""
    return (
        df.where(F.col(group).isNotNull())
        .groupBy(group)
        .agg(
            F.avg(value).alias("mean"),
            F.stddev_samp(value).alias("std"),
            F.count(value).alias("count"),
        )
    )


@dataclass
class PopularityModel:
    """Fitted group statistics: one stored row per group plus the two global means."""

    group: str
    stats: DataFrame
    mean_of_means: float | None
    row_mean: float | None

    def score(self, df: DataFrame, name: str = "score") -> DataFrame:
        """Group mean, or the row-weighted global mean for an unseen or NULL group."""
        table = self.stats.select(self.group, F.col("mean").alias(name), F.col("count").alias("__count"))
        out = attach(df, table, [self.group], weight="__count", stored=True).drop("__count")
        return out.withColumn(name, F.coalesce(name, F.lit(self.row_mean).cast("double")))

    def zscore(self, df: DataFrame, value: str, name: str = "zscore") -> DataFrame:
        """Deviation from the group mean in group deviations.

        A group without spread gives the plain difference, an unseen group the difference to the mean
        of group means, and no statistics at all give 0.
        """
        table = self.stats.select(
            self.group, F.col("mean").alias("__mean"), F.col("std").alias("__std"), F.col("count").alias("__count")
        )
        out = attach(df, table, [self.group], weight="__count", stored=True)
        v = F.col(value)
        base = F.coalesce("__mean", F.lit(self.mean_of_means).cast("double"))
        usable = F.coalesce(F.col("__std") != 0, F.lit(False))
        return out.withColumn(
            name,
            F.when(usable, (v - F.col("__mean")) / F.col("__std"))
            .when(base.isNotNull(), v - base)
            .otherwise(F.lit(0.0)),
        ).drop("__mean", "__std", "__count")

    def save(self, path: str) -> None:
        """Store the statistics; the global means travel as a one-row table beside them."""
        spark = self.stats.sparkSession
        self.stats.write.mode("overwrite").parquet(f"{path}/stats")
        spark.range(1).select(
            F.lit(self.group).alias("group"),
            F.lit(self.mean_of_means).cast("double").alias("mean_of_means"),
            F.lit(self.row_mean).cast("double").alias("row_mean"),
        ).write.mode("overwrite").parquet(f"{path}/globals")

    @staticmethod
    def load(spark: SparkSession, path: str) -> "PopularityModel":
        g = spark.read.parquet(f"{path}/globals").first()
        return PopularityModel(g["group"], spark.read.parquet(f"{path}/stats"), g["mean_of_means"], g["row_mean"])


def fit_popularity(df: DataFrame, group: str, value: str) -> PopularityModel:
    """Fit on the training rows. ``df`` is read once; rows of NULL groups count in the global mean only."""
    raw = df.groupBy(group).agg(
        F.avg(value).alias("mean"),
        F.stddev_samp(value).alias("std"),
        F.count(value).alias("count"),
        F.sum(value).alias("total"),
    )
    table = materialize(raw, "popularity")
    g = table.agg(
        F.avg(F.when(F.col(group).isNotNull(), F.col("mean"))).alias("mom"),
        (F.sum("total") / F.nullif(F.sum("count"), F.lit(0))).alias("mean"),
    ).first()
    stats = table.where(F.col(group).isNotNull()).drop("total")
    return PopularityModel(group, stats, g["mom"], g["mean"])
