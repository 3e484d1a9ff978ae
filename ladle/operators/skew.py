"""Joins that stay balanced when one key holds a large share of the rows."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ladle.session import materialize, measured_bytes

BROADCAST_BYTES = 8 * 1024 * 1024
# A key is split if it has more rows than this, or than one of SHARES equal parts of all rows if that is more.
HOT_ROWS = 100_000
SHARES = 8192


def same(left: DataFrame, right: DataFrame, keys: Sequence[str]) -> Column:
    """Null-safe equality on ``keys``: a NULL group is a group like any other."""
    cond = F.lit(True)
    for k in keys:
        cond = cond & left[k].eqNullSafe(right[k])
    return cond


def join_same(left: DataFrame, right: DataFrame, keys: Sequence[str], how: str = "left") -> DataFrame:
    """Null-safe equi-join that keeps one copy of the key columns."""
    renamed = right.select(
        *[F.col(k).alias(f"__r_{k}") for k in keys],
        *[F.col(c) for c in right.columns if c not in keys],
    )
    cond = None
    for k in keys:
        part = F.col(k).eqNullSafe(F.col(f"__r_{k}"))
        cond = part if cond is None else cond & part
    return left.join(renamed, cond, how).drop(*[f"__r_{k}" for k in keys])


def row_salt(df: DataFrame, salts: Column) -> Column:
    """Salt from the task and the row's content.

    Copies of one row in different tasks get different salts, and a task that runs again gives every
    row the salt it had before, so a retry cannot lose or double rows.
    """
    plain = [c for c, t in df.dtypes if not t.startswith("map") and t not in ("variant",)]
    return F.pmod(F.xxhash64(F.spark_partition_id(), *plain), salts).cast("int")


def spread_join(
    rows: DataFrame,
    table: DataFrame,
    on: Sequence[str],
    weight: str | None = None,
    how: str = "left",
    hot_rows: int | None = None,
) -> DataFrame:
    """Join ``rows`` to a table with one row per key, splitting every key with too many rows for one task.

    ``weight`` names the column of ``table`` that says how many rows of ``rows`` carry the key; without
    it the count is taken here. A key of w rows is dealt to ceil(w / limit) tasks. The limit is at least one of SHARES
    equal parts of all rows, so there are at most SHARES hot keys, whatever the data: that bounds the broadcast.
    """
    on = list(on)
    if weight is None:
        counts = rows.groupBy(*on).agg(F.count(F.lit(1)).alias("__w"))
    else:
        counts = table.select(*on, F.col(weight).alias("__w"))
    total = counts.agg(F.sum("__w")).first()[0] or 0
    limit = max(HOT_ROWS if hot_rows is None else hot_rows, total // SHARES)
    hot = counts.where(F.col("__w") > limit).select(*on, F.ceil(F.col("__w") / F.lit(limit)).cast("int").alias("__hot"))
    parts = F.coalesce("__hot", F.lit(1))
    spread = join_same(rows, F.broadcast(hot), on)
    left = spread.withColumn("__s", F.when(F.col("__hot").isNull(), F.lit(0)).otherwise(row_salt(rows, parts))).drop("__hot")
    right = join_same(table, F.broadcast(hot), on).withColumn("__s", F.explode(F.sequence(F.lit(0), parts - 1))).drop("__hot")
    return join_same(left, right, [*on, "__s"], how).drop("__s")


def attach(
    rows: DataFrame,
    table: DataFrame,
    on: Sequence[str],
    how: str = "left",
    weight: str | None = None,
    max_bytes: int = BROADCAST_BYTES,
    stored: bool = False,
) -> DataFrame:
    """Join ``rows`` to a fitted table whose size is measured first.

    The table is written once; if its files are small it is broadcast and ``rows`` do not move,
    otherwise the join shuffles with hot keys split.
    """
    table = table if stored else materialize(table, "fitted")
    if measured_bytes(table) <= max_bytes:
        return join_same(rows, F.broadcast(table), list(on), how)
    return spread_join(rows, table, on, weight, how)
