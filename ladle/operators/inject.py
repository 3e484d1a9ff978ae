"""Table faults with known ground truth, for closed-loop tests of the monitors."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ladle.functions.hashing import hash_int, seeded_hash
from ladle.operators.sampling import mark_fraction

_MARKS = ("__first", "__second")


def fault_nulls(
    df: DataFrame,
    key: str = "recipe_id",
    columns: Sequence[str] = ("cook_time_minutes", "calories"),
    frac: float = 0.25,
    seed: int = 42,
    flag: str = "affected",
) -> DataFrame:
    """NULL the columns on exactly ``max(1, floor(n * frac))`` rows and flag those rows."""
    marked = mark_fraction(df, key, frac, seed, *_MARKS)
    hit = F.col("__first") | F.col("__second")
    return marked.withColumns(
        {**{c: F.when(~hit, F.col(c)) for c in columns}, flag: hit}
    ).drop(*_MARKS)


def fault_ranges(
    df: DataFrame,
    key: str = "recipe_id",
    time: str = "cook_time_minutes",
    calories: str = "calories",
    frac: float = 0.20,
    seed: int = 42,
    flag: str = "affected",
) -> DataFrame:
    """Half of the chosen rows get a negative time (-5..-59), half calories of 50,000-199,999."""
    marked = mark_fraction(df, key, frac, seed, *_MARKS)
    h = seeded_hash(F.col(key), f"{seed}:value")
    return marked.withColumns({
        time: F.when(F.col("__first"), -hash_int(h, 5, 60).cast("double")).otherwise(F.col(time)),
        calories: F.when(F.col("__second"), hash_int(h, 50_000, 200_000).cast("double")).otherwise(F.col(calories)),
        flag: F.col("__first") | F.col("__second"),
    }).drop(*_MARKS)


def column_swap(df: DataFrame, a: str = "cook_time_minutes", b: str = "calories", flag: str = "affected") -> DataFrame:
    """Swap the values of two columns on all rows; the names stay."""
    return df.withColumns({a: F.col(b), b: F.col(a), flag: F.lit(True)})


def column_change(
    df: DataFrame,
    old: str = "cook_time_minutes",
    new: str = "cook_minutes",
    dropped: str = "calories",
    flag: str = "affected",
) -> DataFrame:
    """Rename one column and drop another."""
    return df.withColumnRenamed(old, new).drop(dropped).withColumn(flag, F.lit(True))


def manifest(faulty: DataFrame, kind: str, key: str = "recipe_id", flag: str = "affected") -> DataFrame:
    """Ground truth as a table: one row per affected key."""
    return faulty.where(F.col(flag)).select(F.lit(kind).alias("corruption_type"), F.col(key))


def manifest_counts(manifests: DataFrame) -> DataFrame:
    return manifests.groupBy("corruption_type").agg(F.count(F.lit(1)).alias("affected_row_count"))
