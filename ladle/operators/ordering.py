"""Exact global and grouped positions, ranks and running totals without a one-task window.

Rows are dealt by the engine's range partitioning over the real sort order and stored with the number of their partition. Each
partition is ordered by itself, a table of partition totals (at most one row per group and partition) supplies the
offsets, and the sum of both is the exact answer wherever the bounds lie: the engine's sample only affects balance.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.window import Window

from ladle.session import materialize, shuffle_width

_IN_PARTITION = (1 << 33) - 1


def present(df: DataFrame, name: str) -> Column:
    """Neither NULL nor NaN."""
    known = F.col(name).isNotNull()
    return known & ~F.isnan(name) if isinstance(df.schema[name].dataType, (T.DoubleType, T.FloatType)) else known


def sort_keys(df: DataFrame, order: Sequence[str | tuple[str, str]]) -> list[Column]:
    """Sort columns of an ordering such as ``[("score", "desc"), "id"]``: in either direction values come first, then NaN, then NULL."""
    out = []
    for item in order:
        name, direction = item if isinstance(item, tuple) else (item, "asc")
        if isinstance(df.schema[name].dataType, (T.DoubleType, T.FloatType)):
            out.append(F.when(F.col(name).isNull(), 2).when(F.isnan(name), 1).otherwise(0).asc())
        out.append(F.col(name).desc_nulls_last() if direction == "desc" else F.col(name).asc_nulls_last())
    return out


def _solid(df: DataFrame, groups: Sequence[str]) -> tuple[DataFrame, list[str]]:
    """Group columns as never-NULL key columns, so windows and joins on them share one shuffle."""
    cols: dict[str, Column] = {}
    for i, g in enumerate(groups):
        kind = df.schema[g].dataType
        if isinstance(kind, (T.DateType, T.TimestampType, T.TimestampNTZType)):
            blank = F.lit("1970-01-01").cast(kind)
        elif isinstance(kind, T.StringType):
            blank = F.lit("")
        else:
            blank = F.lit(0).cast(kind)
        cols[f"__g{i}"] = F.coalesce(F.col(g), blank)
        cols[f"__z{i}"] = F.col(g).isNull()
    return (df.withColumns(cols) if cols else df), list(cols)


def positions_in_cells(
    df: DataFrame, cell: str, order: Column | Sequence[Column], groups: Sequence[str] = (), name: str = "position"
) -> DataFrame:
    """1-based position in ``order`` per group, given a ``cell`` column that grows with the order.

    The window over (group, cell) is the only move of the rows; the offsets arrive by a join on the same keys.
    """
    order = [order] if isinstance(order, Column) else list(order)
    keyed, keys = _solid(df, list(groups))
    local = keyed.withColumn(name, F.row_number().over(Window.partitionBy(*keys, cell).orderBy(*order)))
    earlier = Window.partitionBy(*keys).orderBy(cell).rowsBetween(Window.unboundedPreceding, -1)
    offsets = (
        keyed.groupBy(*keys, cell)
        .agg(F.count(F.lit(1)).alias("__n"))
        .select(*keys, cell, F.coalesce(F.sum("__n").over(earlier), F.lit(0)).alias("__off"))
    )
    return (
        local.join(offsets, [*keys, cell])
        .withColumn(name, (F.col(name) + F.col("__off")).cast("bigint"))
        .select(*df.columns, name)
    )


def row_positions(
    df: DataFrame,
    order: Sequence[str | tuple[str, str]],
    groups: Sequence[str] = (),
    name: str = "position",
    buckets: int | None = None,
) -> DataFrame:
    """Exact ``row_number`` over a total order, per group or over the whole table.

    ``order`` must be total (end with a unique column). A group with a third of all rows is spread over a third
    of the partitions. Without groups the rows move once: their place in the sorted partition is their number.
    """
    buckets = buckets or shuffle_width(df.sparkSession)
    groups = list(groups)
    by = sort_keys(df, order)
    if groups:
        keyed, keys = _solid(df, groups)
        dealt = keyed.repartitionByRange(buckets, *keys, *by).withColumn("__cell", F.spark_partition_id()).drop(*keys)
        return positions_in_cells(materialize(dealt, "dealt"), "__cell", by, groups, name).drop("__cell")
    dealt = df.repartitionByRange(buckets, *by).sortWithinPartitions(*by).withColumn("__at", F.monotonically_increasing_id())
    dealt = materialize(dealt, "dealt").withColumn("__cell", F.shiftright("__at", 33))
    earlier = Window.orderBy("__cell").rowsBetween(Window.unboundedPreceding, -1)  # one row a partition
    offsets = dealt.groupBy("__cell").agg(F.count(F.lit(1)).alias("__n")).select(
        "__cell", F.coalesce(F.sum("__n").over(earlier), F.lit(0)).alias("__off"))
    place = F.col("__at").bitwiseAND(F.lit(_IN_PARTITION)) + 1 + F.col("__off")
    return dealt.join(F.broadcast(offsets), "__cell").select(*df.columns, place.cast("bigint").alias(name))


@dataclass(frozen=True)
class Ranks:
    """Rank table with what is known about its size: distinct (group, value) pairs and the largest count."""

    table: DataFrame
    distinct: int
    largest: int


def value_ranks(
    df: DataFrame,
    value: str,
    groups: Sequence[str] = (),
    sums: Mapping[str, Column] | None = None,
    buckets: int | None = None,
) -> DataFrame:
    """One row per (group, distinct value) with ``n``, the given sums, what lies before, and totals.

    Columns: groups, value, ``n``, each sum; ``before_<x>`` = total over smaller values of the group;
    ``total_<x>`` = total of the group; ``next_value`` = the next larger value. NULL and NaN values are left out.
    Rows are combined per value before the shuffle, so a hot value costs one row per map task.
    """
    return measured_ranks(df, value, groups, sums, buckets).table


def measured_ranks(
    df: DataFrame,
    value: str,
    groups: Sequence[str] = (),
    sums: Mapping[str, Column] | None = None,
    buckets: int | None = None,
) -> Ranks:
    """``value_ranks`` with its measured size.

    The input is read once: counts per value are stored, and everything after works on that table.
    """
    buckets = buckets or shuffle_width(df.sparkSession)
    groups = list(groups)
    sums = dict(sums or {})
    names = ["n", *sums]
    stored = materialize(
        df.where(present(df, value))
        .groupBy(*groups, value)
        .agg(F.count(F.lit(1)).alias("n"), *[F.sum(c).alias(s) for s, c in sums.items()]),
        "per-value",
    )
    size = stored.agg(F.count(F.lit(1)).alias("d"), F.max("n").alias("m")).first()
    keyed, keys = _solid(stored, groups)
    dealt = keyed.repartitionByRange(buckets, *keys, value).withColumn("__cell", F.spark_partition_id()).drop(*keys)
    table = _running(materialize(dealt, "dealt"), value, groups, names)
    return Ranks(table, size["d"], size["m"] or 0)


def _running(per_value: DataFrame, value: str, groups: list[str], names: list[str]) -> DataFrame:
    """Running totals over celled per-value rows: inside the cell, plus the totals of earlier cells."""
    keyed, keys = _solid(per_value, groups)
    cells = keyed.groupBy(*keys, "__cell").agg(
        *[F.sum(x).alias(f"__t_{x}") for x in names], F.min(value).alias("__first")
    )
    ordered = Window.partitionBy(*keys).orderBy("__cell")
    earlier = ordered.rowsBetween(Window.unboundedPreceding, -1)
    whole = Window.partitionBy(*keys)
    offsets = cells.select(
        *keys,
        "__cell",
        *[F.coalesce(F.sum(f"__t_{x}").over(earlier), F.lit(0)).alias(f"__o_{x}") for x in names],
        *[F.sum(f"__t_{x}").over(whole).alias(f"total_{x}") for x in names],
        F.lead("__first").over(ordered).alias("__next"),
    )
    inside = Window.partitionBy(*keys, "__cell").orderBy(value)
    running = inside.rowsBetween(Window.unboundedPreceding, -1)
    local = keyed.select(
        "*",
        *[F.coalesce(F.sum(x).over(running), F.lit(0)).alias(f"__l_{x}") for x in names],
        F.lead(value).over(inside).alias("__lead"),
    )
    return local.join(offsets, [*keys, "__cell"]).select(
        *groups,
        value,
        *names,
        *[(F.col(f"__l_{x}") + F.col(f"__o_{x}")).alias(f"before_{x}") for x in names],
        *[f"total_{x}" for x in names],
        F.coalesce("__lead", "__next").alias("next_value"),
    )


def exact_quantiles(
    df: DataFrame,
    value: str,
    probs: Mapping[str, float],
    groups: Sequence[str] = (),
    method: str = "nearest",
) -> DataFrame:
    """Exact quantiles per group from the rank table.

    ``nearest`` takes the element at 0-based index ``min(n-1, floor(n*p))``; ``linear`` interpolates
    between the neighbours of ``(n-1)*p`` (the median for p = 0.5).
    """
    groups = list(groups)
    ranks = value_ranks(df, value, groups)

    def at(index: Column) -> Column:
        hit = (F.col("before_n") <= index) & (index < F.col("before_n") + F.col("n"))
        return F.max(F.when(hit, F.col(value)))

    total = F.col("total_n")
    aggs = []
    for name, p in probs.items():
        if method == "nearest":
            index = F.least(total - 1, F.floor(total.cast("double") * F.lit(float(p))))
            aggs.append(at(index).alias(name))
        else:
            spot = (total - 1).cast("double") * F.lit(float(p))
            low = at(F.floor(spot))
            high = at(F.ceil(spot))
            share = F.max(spot - F.floor(spot))
            aggs.append((low + (high - low) * share).alias(name))
    return ranks.groupBy(*groups).agg(*aggs)
