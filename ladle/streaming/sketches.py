"""Drift over the last batches of a stream, from one small sketch a batch and column.

Each micro-batch stores a KLL quantile sketch of every column (Spark's own aggregate), so a batch is read once and its rows are not kept. The
sketches of any run of batches merge into that of all their rows. The distance to a reference is the largest gap of both
distribution functions, looked at where either sketch ends one of GRID equal shares of its rows, and comes with the bound within
which the exact Kolmogorov-Smirnov distance lies: what the sketches may be wrong by in rank, one share, and one row of each side.

Cases: NULL and NaN values are left out. A batch without a value of a column stores no sketch of it; without one in the whole run, or in the
reference, distance and bound are NULL. A batch that runs again overwrites its own folder.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery
from pyspark.sql.window import Window

#: Size of a sketch. Its error in rank falls almost as 1 / K; at most 65,535.
K = 2000
GRID = 256
#: Error in rank of a sketch, with probability 0.99 (fixed values of the published sketch: factor and power).
_FACTOR, _POWER = 2.296, 0.9723


def rank_error(k: int = K) -> float:
    return _FACTOR / k**_POWER


def sketches(df: DataFrame, columns: Sequence[str], k: int = K) -> DataFrame:
    """(column, n, sketch) of the columns that are there."""
    there = [c for c in columns if c in df.columns]
    pairs = F.array(*[F.struct(F.lit(c).alias("column"), F.col(c).cast("double").alias("v")) for c in there])
    long = df.select(F.explode(pairs).alias("p")).select("p.column", "p.v").where("v IS NOT NULL AND NOT isnan(v)")
    return long.groupBy("column").agg(F.count(F.lit(1)).alias("n"), F.kll_sketch_agg_double("v", k).alias("sketch"))


def sketch_stream(df: DataFrame, columns: Sequence[str], path: str, checkpoint: str, available_now: bool = False, k: int = K) -> StreamingQuery:
    """Sketches of every micro-batch under ``path/batch_id=N``."""

    def store(batch: DataFrame, batch_id: int) -> None:
        sketches(batch, columns, k).write.mode("overwrite").parquet(f"{path}/batch_id={batch_id}")

    writer = df.writeStream.foreachBatch(store).option("checkpointLocation", checkpoint)
    if available_now:
        writer = writer.trigger(availableNow=True)
    return writer.start()


def stored(spark: SparkSession, path: str) -> DataFrame:
    """(batch_id, column, n, sketch) of all batches of a stream."""
    return spark.read.parquet(path).withColumn("batch_id", F.col("batch_id").cast("long"))


def last_batches(batches: DataFrame, n: int) -> DataFrame:
    """(batch_id, column, n, sketch): for every batch the sketches of it and the ``n`` - 1 before it, merged."""
    ids = batches.select("batch_id").distinct()
    # Each batch counts for the n runs that end with it or one of the next; a run ends with a batch that is there.
    line = Window.orderBy("batch_id")  # one row a batch
    numbered = ids.withColumn("no", F.row_number().over(line))
    ends = numbered.select(F.col("batch_id").alias("end"), F.col("no").alias("end_no"))
    member = numbered.withColumn("end_no", F.explode(F.sequence(F.col("no"), F.col("no") + n - 1))).join(ends, "end_no").select("batch_id", "end")
    return batches.join(member, "batch_id").groupBy(F.col("end").alias("batch_id"), "column").agg(F.sum("n").alias("n"), F.kll_merge_agg_double("sketch").alias("sketch"))


def _shares(sketch: str) -> Column:
    """The values that cut a sketch's rows into GRID equal shares, ends included."""
    return F.kll_sketch_get_quantile_double(F.col(sketch), F.array(*[F.lit(i / GRID) for i in range(GRID + 1)]))


def _below(shares: Column, x: Column) -> Column:
    """Share of the rows at or below ``x``, but for one of GRID shares."""
    return F.size(F.filter(shares, lambda y: y <= x)) / GRID


def sketch_drift(current: DataFrame, reference: DataFrame, keys: Sequence[str] = (), k: int = K) -> DataFrame:
    """(keys, column, n_current, n_reference, distance, bound): the exact distance is at most ``bound`` away from ``distance``, with
    the probability of the sketches. ``keys`` are columns of ``current`` that tell several runs apart."""
    right = reference.select("column", F.col("n").alias("n_reference"), F.col("sketch").alias("ref"))
    both = current.withColumnRenamed("n", "n_current").join(right, "column", "left")
    both = both.withColumns({"__c": _shares("sketch"), "__r": _shares("ref")})
    gap = F.aggregate(F.array_distinct(F.concat("__c", "__r")), F.lit(0.0), lambda a, x: F.greatest(a, F.abs(_below(F.col("__c"), x) - _below(F.col("__r"), x))))
    # A sketch of no more than k values holds them all.
    error = lambda n: F.when(F.col(n) > k, rank_error(k)).otherwise(0.0)
    known = F.col("ref").isNotNull()
    return both.select(
        *keys, "column", "n_current", "n_reference", F.when(known, gap).alias("distance"),
        F.when(known, error("n_current") + error("n_reference") + 1.0 / GRID + 1 / F.col("n_current") + 1 / F.col("n_reference")).alias("bound"),
    )
