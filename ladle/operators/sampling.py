"""Seeded samples, exact-quota splits and fold assignment that do not depend on row order.

Rows are ordered by the MD5 of ``seed:key``. Each key's rows are counted first, so a key that a third of the rows share is one row. The
leading digits of the hash form uniform cells, as many as the number of keys asks for; the exact k-th row of a stratum is found
from cell counts plus one cell, and choosing rows is then a narrow filter: the table itself is not shuffled. Only where
a quota ends among rows that share a key are those rows numbered, by a hash of all their columns.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from ladle.functions.hashing import cell_digits, hash_cell, seeded_hash
from ladle.operators.ordering import positions_in_cells, row_positions
from ladle.operators.skew import attach
from ladle.session import materialize


def _spot(key: str, seed: int | str) -> Column:
    return F.struct(seeded_hash(F.col(key), seed).alias("h"), F.col(key).alias("k"))


def hash_cutoffs(
    df: DataFrame, key: str, seed: int | str, quotas: Mapping[str, Column], strata: Sequence[str] = ()
) -> DataFrame:
    """Per stratum and named quota (an expression over ``total``) where its k-th row is: ``cut_<name>`` is the place of its key,
    ``keep_<name>`` how many rows of that key belong to the quota and ``copies_<name>`` how many there are.

    A quota of 0 gives NULL. The result has one row per stratum and is stored. The k-th row's cell is found from counts;
    only the keys of those few cells are sorted.
    """
    strata = list(strata)
    keys = materialize(df.select(*strata, _spot(key, seed).alias("o")).groupBy(*strata, "o").agg(F.count(F.lit(1)).alias("copies")), "keys")
    keys = keys.withColumn("cell", hash_cell(F.col("o.h"), cell_digits(keys.count())))
    w = Window.partitionBy(*strata)
    running = w.orderBy("cell").rowsBetween(Window.unboundedPreceding, 0)
    cells = (
        keys.groupBy(*strata, "cell")
        .agg(F.sum("copies").alias("n"))
        .select(*strata, "cell", "n", (F.sum("n").over(running) - F.col("n")).alias("before"),
                F.sum("n").over(w).alias("total"))
    )
    wanted = cells.select(
        *strata, "cell", "n", "before",
        F.explode(F.array(*[
            F.struct(F.lit(name).alias("quota"), q.cast("bigint").alias("k")) for name, q in quotas.items()
        ])).alias("w"),
    ).select(*strata, "cell", F.col("w.quota").alias("quota"), (F.col("w.k") - F.col("before")).alias("at"),
             "n").where((F.col("at") > 0) & (F.col("at") <= F.col("n"))).drop("n")
    inside = attach(keys, wanted, [*strata, "cell"], "inner")
    up_to = F.sum("copies").over(Window.partitionBy(*strata, "cell", "quota").orderBy("o").rowsBetween(Window.unboundedPreceding, 0))
    cut = inside.withColumn("__to", up_to).where((F.col("__to") >= F.col("at")) & (F.col("__to") - F.col("copies") < F.col("at")))
    keep = F.col("at") - F.col("__to") + F.col("copies")
    picked = {"cut": F.col("o"), "keep": keep, "copies": F.col("copies")}
    found = cut.groupBy(*strata).agg(
        *[F.max(F.when(F.col("quota") == name, c)).alias(f"{what}_{name}") for name in quotas for what, c in picked.items()]
    )
    return materialize(found, "cuts")


def _marked(df: DataFrame, key: str, seed: int | str, quotas: Mapping[str, Column], strata: Sequence[str] = ()) -> tuple[DataFrame, dict[str, Column]]:
    """``df`` with helper columns (their names begin with ``__``), and for each quota whether a row belongs to it."""
    cuts = hash_cutoffs(df, key, seed, quotas, strata)
    names = {c: f"__{c}" for c in cuts.columns if c not in strata}
    if strata:
        out = attach(df, cuts.withColumnsRenamed(names), strata, stored=True)
    else:
        out = df.withColumns({n: cuts.select(c).scalar() for c, n in names.items()})
    spot = _spot(key, seed)
    cut_within = F.lit(False)
    for q in quotas:
        cut_within = cut_within | (F.col(f"copies_{q}") > F.col(f"keep_{q}"))
    if cuts.where(cut_within).isEmpty():
        return out, {q: F.coalesce(spot <= F.col(f"__cut_{q}"), F.lit(False)) for q in quotas}
    tie = F.lit(False)
    for q in quotas:
        tie = tie | F.coalesce((spot == F.col(f"__cut_{q}")) & (F.col(f"__copies_{q}") > F.col(f"__keep_{q}")), F.lit(False))
    plain = [c for c, t in df.dtypes if "map<" not in t and "variant" not in t]
    ties = out.where(tie).withColumn("__row", F.xxhash64(*plain))
    numbered = row_positions(ties, ["__row"], [*strata, key], "__nth").drop("__row")
    out = out.where(~tie).withColumn("__nth", F.lit(1).cast("bigint")).unionByName(numbered)
    inside = {
        q: F.coalesce((spot < F.col(f"__cut_{q}")) | (spot == F.col(f"__cut_{q}")) & ((F.col(f"__copies_{q}") == F.col(f"__keep_{q}")) | (F.col("__nth") <= F.col(f"__keep_{q}"))), F.lit(False))
        for q in quotas
    }
    return out, inside


def stratified_split(
    df: DataFrame,
    label: str,
    key: str,
    train: float = 0.70,
    val: float = 0.15,
    seed: int = 42,
    name: str = "split",
) -> DataFrame:
    """Add a split column with exact quotas per label: test first, then val from the rest, else train."""
    test = 1.0 - train - val
    if test <= 0:
        raise ValueError(f"train + val must be below 1.0 (test share would be {test:.3f})")
    total = F.col("total").cast("double")
    n_test = F.round(total * F.lit(test))
    n_val = F.round((total - n_test) * F.lit(val / (train + val)))
    marked, inside = _marked(df, key, seed, {"test": n_test, "val": n_test + n_val}, [label])
    part = F.when(inside["test"], "test").when(inside["val"], "val").otherwise("train")
    return marked.select(*[c for c in df.columns if c != name], part.alias(name))


def hash_sample(df: DataFrame, key: str, n: int, seed: int = 42) -> DataFrame:
    """Exactly ``min(n, rows)`` rows, uniform without replacement, the same for any row order."""
    marked, inside = _marked(df, key, seed, {"n": F.least(F.col("total"), F.lit(n))})
    return marked.where(inside["n"]).select(*df.columns)


def mark_fraction(
    df: DataFrame, key: str, frac: float, seed: int = 42, first: str = "hit_first", second: str = "hit_second"
) -> DataFrame:
    """Mark exactly ``max(1, floor(n * frac))`` rows, as two halves (the first is rounded down)."""
    k = F.greatest(F.lit(1), F.floor(F.col("total").cast("double") * F.lit(float(frac))))
    marked, inside = _marked(df, key, seed, {"half": F.floor(k / 2), "all": k})
    return marked.select(*df.columns, inside["half"].alias(first), (inside["all"] & ~inside["half"]).alias(second))


def fold_assignment(
    df: DataFrame, label: str, key: str, folds: int = 5, seed: int | Column = 42, name: str = "fold",
    extra: Sequence[str] = (),
) -> DataFrame:
    """Stratified folds 0..folds-1, dealt round-robin in hash order within each label.

    Hash cells split even a label that holds all rows over many tasks.
    """
    hashed = df.withColumn("__o", F.struct(seeded_hash(F.col(key), seed).alias("h"), F.col(key).alias("k")))
    celled = hashed.withColumn("__cell", hash_cell(F.col("__o.h"), cell_digits(df.count())))
    placed = positions_in_cells(celled, "__cell", F.col("__o"), [*extra, label], "__pos")
    fold = F.pmod(F.col("__pos") - 1, F.lit(folds)).cast("int")
    return placed.withColumn(name, fold).drop("__o", "__cell", "__pos")


def repeated_folds(
    df: DataFrame, label: str, key: str, folds: int = 5, repeats: int = 10, seed: int = 42
) -> DataFrame:
    """(key, label, repeat, fold) for every repeat, in one shuffle of narrow rows."""
    narrow = df.select(key, label).withColumn("repeat", F.explode(F.sequence(F.lit(0), F.lit(repeats - 1))))
    own_seed = F.concat(F.lit(f"{seed}:"), F.col("repeat").cast("string"))
    return fold_assignment(narrow, label, key, folds, own_seed, "fold", ["repeat"])


def class_balance(df: DataFrame, label: str, split: str) -> DataFrame:
    """Rows, positives, negatives and positive rate (four decimals) per split."""
    n = F.count(F.lit(1))
    pos = F.count(F.when(F.col(label) == 1, 1))
    return df.groupBy(split).agg(
        n.alias("rows"),
        pos.alias("positive"),
        F.count(F.when(F.col(label) == 0, 1)).alias("negative"),
        F.round(pos / F.nullif(n, F.lit(0)), 4).alias("positive_rate"),
    )
