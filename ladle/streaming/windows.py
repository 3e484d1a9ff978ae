"""Request telemetry over event-time windows."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ladle.operators.telemetry import counters


def stream_table(spark: SparkSession, folder: str, schema: T.StructType, pattern: str = "*.parquet",
                 files_per_batch: int | None = None) -> DataFrame:
    """Parquet files of a folder as a stream."""
    reader = spark.readStream.schema(schema).option("pathGlobFilter", pattern)
    if files_per_batch:
        reader = reader.option("maxFilesPerTrigger", files_per_batch)
    return reader.parquet(folder)


def windowed_telemetry(
    log: DataFrame,
    width: str = "5 minutes",
    slide: str | None = None,
    lateness: str = "10 minutes",
    ts: str = "ts",
    accuracy: int = 10_000,
) -> DataFrame:
    """Per window and path: counters, mean and approximate p95. Works on a stream and on a table.

    State holds one small sketch per open window and path; rows later than ``lateness`` are dropped.
    """
    timed = log.withColumn(ts, F.col(ts).cast("timestamp")).withWatermark(ts, lateness)
    window = F.window(ts, width, slide) if slide else F.window(ts, width)
    return (
        timed.groupBy(window.alias("w"), "path")
        .agg(
            *counters(),
            F.avg("latency_ms").alias("mean_ms"),
            F.percentile_approx("latency_ms", 0.95, accuracy).alias("p95_ms"),
        )
        .select(F.col("w.start").alias("window_start"), F.col("w.end").alias("window_end"), "path",
                "request_count", "error_count", "error_rate", "mean_ms", "p95_ms")
    )
