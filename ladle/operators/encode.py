"""Model inputs: exact-median imputation, population scaling, mode imputation and one-hot encoding."""

from __future__ import annotations

import json
from collections.abc import Sequence
from dataclasses import dataclass, field

from pyspark.ml import Pipeline, PipelineModel
from pyspark.ml.feature import OneHotEncoder, VectorAssembler
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ladle.functions import fixed
from ladle.operators.ordering import exact_quantiles, row_positions
from ladle.operators.skew import attach
from ladle.session import materialize


def guard_inputs(columns: Sequence[str], forbidden: Sequence[str] = tuple(fixed.RATING_DERIVED)) -> list[str]:
    """Refuse model inputs that derive from the rating."""
    leaked = sorted(set(columns) & set(forbidden))
    if leaked:
        raise ValueError(f"inputs derived from the target: {leaked}")
    return list(columns)


def number(c: str) -> Column:
    """The column as a number; NaN is missing."""
    return F.nanvl(F.col(c).cast("double"), F.lit(None).cast("double"))


def medians(df: DataFrame, columns: Sequence[str]) -> dict[str, float]:
    """Exact median per column, all columns in one pass."""
    pairs = F.array(*[F.struct(F.lit(c).alias("column"), number(c).alias("v")) for c in columns])
    long = df.select(F.explode(pairs).alias("p")).select("p.column", "p.v")
    rows = exact_quantiles(long, "v", {"median": 0.5}, ["column"], "linear").collect()  # one row per column
    return {r["column"]: r["median"] for r in rows}


def modes(df: DataFrame, columns: Sequence[str]) -> dict[str, str]:
    """Most frequent value per column, the smaller one on a tie; counts combine before the shuffle."""
    pairs = F.array(*[F.struct(F.lit(c).alias("column"), F.col(c).cast("string").alias("v")) for c in columns])
    counts = (
        df.select(F.explode(pairs).alias("p")).select("p.column", "p.v").where(F.col("v").isNotNull())
        .groupBy("column", "v").agg(F.count(F.lit(1)).alias("n"))
    )
    best = counts.groupBy("column").agg(F.min_by("v", F.struct(-F.col("n"), F.col("v"))).alias("mode"))
    return {r["column"]: r["mode"] for r in best.collect()}


def category_table(df: DataFrame, column: str) -> DataFrame:
    """(column, index, n) of the distinct values: most frequent first, then by value. Stored; it never visits the driver."""
    counts = df.groupBy(column).agg(F.count(F.lit(1)).alias("n"))
    placed = row_positions(counts, [("n", "desc"), column], name="__pos")
    return materialize(placed.select(column, (F.col("__pos") - 1).cast("double").alias("index"), "n"), "categories")


@dataclass
class InputEncoder:
    """Fitted fill values and scales, a table of categories for each categorical column, and the one-hot stages."""

    numeric: list[str]
    categorical: list[str]
    fill: dict[str, float]
    mode: dict[str, str]
    mean: dict[str, float]
    std: dict[str, float]
    tables: dict[str, DataFrame] = field(default_factory=dict)
    stages: PipelineModel | None = None

    def scaled(self, df: DataFrame) -> DataFrame:
        """Numeric columns imputed and standardised, categorical ones imputed."""
        cols = {}
        for c in self.numeric:
            filled = F.coalesce(number(c), F.lit(self.fill.get(c, 0.0)))
            cols[c] = (filled - F.lit(self.mean[c])) / F.lit(self.std[c] or 1.0)
        for c in self.categorical:
            cols[c] = F.coalesce(F.col(c).cast("string"), F.lit(self.mode.get(c, "")))
        return df.withColumns(cols)

    def indexed(self, df: DataFrame) -> DataFrame:
        """Scaled rows with an index for each categorical value; an unseen value gets one past the last."""
        out = self.scaled(df)
        for c in self.categorical:
            table = self.tables[c]
            known = attach(out, table.withColumnsRenamed({"index": f"__i_{c}", "n": f"__n_{c}"}), [c], weight=f"__n_{c}", stored=True)
            size = table.agg(F.count(F.lit(1)).cast("double")).scalar()
            out = known.withColumn(f"__i_{c}", F.coalesce(F.col(f"__i_{c}"), size)).drop(f"__n_{c}")
        return out

    def save(self, path: str) -> None:
        """Settings as a row of JSON, categories as tables, the one-hot stages as Spark writes them."""
        spark = self.stages_session()
        settings = {k: getattr(self, k) for k in ("numeric", "categorical", "fill", "mode", "mean", "std")}
        spark.range(1).select(F.lit(json.dumps(settings)).alias("settings")).write.mode("overwrite").parquet(f"{path}/settings")
        for i, c in enumerate(self.categorical):
            self.tables[c].write.mode("overwrite").parquet(f"{path}/categories-{i}")
        self.stages.write().overwrite().save(f"{path}/stages")

    def stages_session(self) -> SparkSession:
        return next(iter(self.tables.values())).sparkSession if self.tables else SparkSession.active()

    @staticmethod
    def load(spark: SparkSession, path: str) -> InputEncoder:
        settings = json.loads(spark.read.parquet(f"{path}/settings").first()["settings"])
        tables = {c: spark.read.parquet(f"{path}/categories-{i}") for i, c in enumerate(settings["categorical"])}
        return InputEncoder(**settings, tables=tables, stages=PipelineModel.load(f"{path}/stages"))

    def transform(self, df: DataFrame) -> DataFrame:
        """Add ``features``, sparse in the categories; an unseen category is all zeros."""
        return self.stages.transform(self.indexed(df))


def fit_encoder(
    df: DataFrame,
    numeric: Sequence[str] = tuple(fixed.NUMERIC_INPUTS),
    categorical: Sequence[str] = tuple(fixed.CATEGORICAL_INPUTS),
) -> InputEncoder:
    numeric, categorical = guard_inputs(numeric), guard_inputs(categorical)
    fill = medians(df, numeric)
    mode = modes(df, categorical) if categorical else {}
    filled = {c: F.coalesce(number(c), F.lit(fill.get(c, 0.0))) for c in numeric}
    stats = df.agg(
        *[F.avg(x).alias(f"m_{c}") for c, x in filled.items()],
        *[F.stddev_pop(x).alias(f"s_{c}") for c, x in filled.items()],
    ).first()
    enc = InputEncoder(
        numeric, categorical, fill, mode, {c: stats[f"m_{c}"] for c in numeric}, {c: stats[f"s_{c}"] for c in numeric}
    )
    scaled = enc.scaled(df)
    enc.tables = {c: category_table(scaled, c) for c in categorical}
    hot = [f"__h_{c}" for c in categorical]
    stages = [OneHotEncoder(inputCols=[f"__i_{c}" for c in categorical], outputCols=hot, dropLast=True, handleInvalid="keep")] if categorical else []
    stages.append(VectorAssembler(inputCols=[*numeric, *hot], outputCol="features"))
    enc.stages = Pipeline(stages=stages).fit(enc.indexed(df))
    return enc
