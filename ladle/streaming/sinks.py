"""Starting streams: replay until the input is drained, continuous quarantine, per-batch monitoring."""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from ladle.operators.drift import dataset_drift, drift_columns, drift_report
from ladle.operators.quality import batch_findings
from ladle.session import scratch_path


def append_to(df: DataFrame, path: str, checkpoint: str, available_now: bool = False,
              partition_by: Sequence[str] = ()) -> StreamingQuery:
    """Append a stream to a Parquet table, exactly once by its checkpoint."""
    writer = df.writeStream.format("parquet").outputMode("append").option("checkpointLocation", checkpoint)
    if partition_by:
        writer = writer.partitionBy(*partition_by)
    if available_now:
        writer = writer.trigger(availableNow=True)
    return writer.start(path)


def replay(df: DataFrame, name: str = "replay") -> DataFrame:
    """Run a stream over everything available, then read what it appended."""
    spark = df.sparkSession
    out, state = scratch_path(spark, name), scratch_path(spark, f"{name}-state")
    append_to(df, out, state, available_now=True).awaitTermination()
    return spark.read.schema(df.schema).parquet(out)


def quarantine_stream(df: DataFrame, errors: Column, path: str, checkpoint: str,
                      available_now: bool = False) -> StreamingQuery:
    """Every row lands once under ``path/valid=true`` or, with its errors, under ``path/valid=false``."""
    marked = df.withColumn("errors", errors).withColumn("valid", F.size("errors") == 0)
    return append_to(marked, path, checkpoint, available_now, ["valid"])


def monitor_stream(
    df: DataFrame,
    reference: DataFrame,
    order: str,
    columns: Sequence[str],
    path: str,
    checkpoint: str,
    available_now: bool = False,
    on_batch: Callable[[DataFrame, int], None] | None = None,
) -> StreamingQuery:
    """Quality and drift of every micro-batch against a fixed reference table.

    A batch writes one row to its own folder ``batch_id=N``; a batch that runs again overwrites it.
    """

    def check(batch: DataFrame, batch_id: int) -> None:
        batch = batch.persist()
        try:
            findings = batch_findings(batch, reference, order)
            present, missing = drift_columns(batch, columns)
            if present:
                drift = dataset_drift(drift_report(batch, reference, present))
            else:
                drift = batch.agg(F.lit(None).cast("double").alias("drifted_column_share"),
                                  F.lit(False).alias("dataset_drift_detected"))
            out = drift.withColumns({
                "row_count": batch.select(F.count(F.lit(1))).scalar(),
                "issue_count": findings.select(F.count(F.lit(1))).scalar(),
                "missing_columns": F.array(*[F.lit(c) for c in missing]).cast("array<string>"),
            })
            out.write.mode("overwrite").parquet(f"{path}/batch_id={batch_id}")
            if on_batch:
                on_batch(out, batch_id)
        finally:
            batch.unpersist()

    writer = df.writeStream.foreachBatch(check).option("checkpointLocation", checkpoint)
    if available_now:
        writer = writer.trigger(availableNow=True)
    return writer.start()
