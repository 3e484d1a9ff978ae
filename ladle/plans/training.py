"""Rankers: text and structured models, grid search, repeated cross-validation and the blended champion."""

from __future__ import annotations

import json
from collections.abc import Callable, Iterator, Mapping, Sequence
from dataclasses import asdict, dataclass

import numpy as np
import pyarrow as pa
from pyspark.ml.classification import GBTClassifier
from pyspark.ml.evaluation import BinaryClassificationEvaluator
from pyspark.ml.param import Param
from pyspark.ml.tuning import CrossValidator
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import DoubleType, StructField, StructType

from ladle.functions.scores import positive_score
from ladle.functions.text import model_text
from ladle.operators import evaluation, linear, sampling
from ladle.operators.encode import InputEncoder, fit_encoder
from ladle.operators.ranks import rank_blend
from ladle.operators.skew import attach
from ladle.operators.tfidf import VOCABULARY_BYTES, TextCounts, TfidfModel, fit_counts
from ladle.session import materialize, measured_bytes
from ladle.sources.readers import file_exists


@dataclass(frozen=True)
class TextSpec:
    """A text ranker: analyzer, n-gram range, vocabulary floor, and the linear model on top."""

    analyzer: str
    low: int
    high: int
    min_df: int
    sublinear: bool
    model: str  # "logistic" or "svm"
    c: float
    l1: bool = False
    balanced: bool = False


# The tuned rankers and the blends compared on identical folds.
RANKERS = {
    "char_logistic": TextSpec("char_wb", 3, 5, 3, True, "logistic", 3.0, l1=True),
    "word_logistic": TextSpec("word", 1, 3, 3, True, "logistic", 10.0, balanced=True),
    "char_svm": TextSpec("char_wb", 2, 4, 3, True, "svm", 0.03, balanced=True),
    "word_svm": TextSpec("word", 1, 3, 3, True, "svm", 10.0),
}
PROBABILITY_BLENDS = {
    "logistic_blend_25char_75word": {"char_logistic": 0.25, "word_logistic": 0.75},
    "logistic_blend_50char_50word": {"char_logistic": 0.50, "word_logistic": 0.50},
    "logistic_blend_75char_25word": {"char_logistic": 0.75, "word_logistic": 0.25},
}
RANK_BLENDS = {
    "svm_blend_50char_50word": {"char_svm": 0.50, "word_svm": 0.50},
    "char_logistic_plus_word_svm": {"char_logistic": 0.50, "word_svm": 0.50},
    "char_logistic_plus_char_svm": {"char_logistic": 0.50, "char_svm": 0.50},
    "char_svm_plus_word_svm_plus_char_logistic": {"char_logistic": 0.40, "char_svm": 0.30, "word_svm": 0.30},
    "all_four": {"char_logistic": 0.40, "word_logistic": 0.20, "char_svm": 0.30, "word_svm": 0.10},
}
#: Coefficients of all fits that go through the rows together.
MAX_TOGETHER = 1 << 25
#: Bytes of binned inputs in one partition of the rows that trees are fitted on.
BINNED_BYTES = 1 << 25
CHAMPION = {"char_logistic": 0.50, "word_svm": 0.50}
LOGISTIC_GRID = [(c, w) for w in (False, True) for c in (0.01, 0.1, 1.0, 10.0)]
GBT_GRID = {
    "maxIter": [100, 200, 400],
    "maxDepth": [2, 3, 4],
    "stepSize": [0.03, 0.1],
    "minInstancesPerNode": [1, 3],
    "subsamplingRate": [0.8, 1.0],
    "featureSubsetStrategy": ["0.8", "all"],
}
# Search space of the text rankers.
TEXT_GRID = {
    "char_ranges": [(2, 4), (3, 5), (4, 6), (5, 7)],
    "word_ranges": [(1, 1), (1, 2), (1, 3)],
    "min_df": [1, 2, 3],
    "sublinear": [False, True],
    "logistic_c": [0.03, 0.1, 0.3, 1.0, 3.0, 10.0],
    "svm_c": [0.001, 0.003, 0.01, 0.03, 0.1, 0.3, 1.0, 3.0, 10.0],
}


def class_counts(df: DataFrame, label: str = "label") -> dict[int, int]:
    """Rows per class of a binary label (two rows)."""
    return {int(r[label]): r["n"] for r in df.groupBy(label).agg(F.count(F.lit(1)).alias("n")).collect()}


def class_weight(counts: Mapping[int, int], label: str = "label"):
    """Weight ``n / (classes * n_class)`` of each row's class."""
    total = sum(counts.values())
    out = F.lit(1.0)
    for cls, n in counts.items():
        out = F.when(F.col(label) == cls, F.lit(total / (len(counts) * n))).otherwise(out)
    return out


@dataclass
class TextRanker:
    """A fitted text ranker as tables: ``tfidf`` and the non-zero ``coefficients`` (index, coefficient), stored."""

    spec: TextSpec
    tfidf: TfidfModel
    coefficients: DataFrame
    intercept: float

    def score_counts(self, rows: DataFrame, counts: DataFrame | TextCounts, key: str, name: str) -> DataFrame:
        """Score rows from term counts made with this ranker's analyzer.

        No vector is made: the terms meet their IDF and coefficient, and a document's sums give its margin.
        """
        terms = self.tfidf.vocabulary.join(self.coefficients, "index", "left").select("term", "df", "idf", "coefficient")
        return self._scored(rows, self._margins(terms, counts, key), key, name)

    def _margins(self, terms: DataFrame, counts: DataFrame | TextCounts, key: str) -> DataFrame:
        """(key, __margin) without the intercept, for each document with a known term."""
        if isinstance(counts, TextCounts) and measured_bytes(self.tfidf.vocabulary) <= VOCABULARY_BYTES:
            sublinear = self.tfidf.sublinear

            def finish(owner, n, tf, idf, coefficient, _) -> list[pa.Array]:
                w = (1.0 + np.log(tf) if sublinear else tf) * idf
                return [pa.array(np.bincount(owner, w * coefficient, n) / np.sqrt(np.bincount(owner, w * w, n)))]

            schema = StructType([counts.df.schema[counts.key], StructField("__margin", DoubleType())])
            return counts.known(terms.withColumn("coefficient", F.coalesce("coefficient", F.lit(0.0))), ["idf", "coefficient"], finish, schema)
        counts = counts.long() if isinstance(counts, TextCounts) else counts
        known = attach(counts, terms, ["term"], "inner", weight="df")
        tf = F.col("tf").cast("double")
        w = (F.lit(1.0) + F.log(tf) if self.tfidf.sublinear else tf) * F.col("idf")
        return known.select(key, w.alias("w"), F.coalesce("coefficient", F.lit(0.0)).alias("c")).groupBy(key).agg(
            (F.sum(F.col("w") * F.col("c")) / F.sqrt(F.sum(F.col("w") * F.col("w")))).alias("__margin"))

    def _scored(self, rows: DataFrame, sums: DataFrame, key: str, name: str) -> DataFrame:
        margin = F.coalesce("__margin", F.lit(0.0)) + F.lit(self.intercept)
        score = margin if self.spec.model == "svm" else F.lit(1.0) / (F.lit(1.0) + F.exp(-margin))
        return rows.join(sums, key, "left").select(*rows.columns, score.alias(name))

    def score(self, df: DataFrame, key: str, text: str, name: str = "score") -> DataFrame:
        cleaned = df.select(key, model_text(F.col(text)).alias("__text"))
        counts = TextCounts(cleaned, key, "__text", self.spec.analyzer, self.spec.low, self.spec.high)
        return self.score_counts(df, counts, key, name)

    def save(self, path: str) -> None:
        self.tfidf.save(f"{path}/tfidf")
        self.coefficients.write.mode("overwrite").parquet(f"{path}/coefficients")
        spark = self.coefficients.sparkSession
        spark.range(1).select(F.lit(json.dumps(asdict(self.spec))).alias("spec"), F.lit(self.intercept).alias("intercept")).write.mode("overwrite").parquet(f"{path}/settings")

    @staticmethod
    def load(spark: SparkSession, path: str) -> TextRanker:
        settings = spark.read.parquet(f"{path}/settings").first()
        return TextRanker(TextSpec(**json.loads(settings["spec"])), TfidfModel.load(spark, f"{path}/tfidf"), spark.read.parquet(f"{path}/coefficients"), settings["intercept"])


def text_counts(df: DataFrame, spec: TextSpec, key: str, text: str) -> TextCounts:
    """Term counts of cleaned texts, which are stored; fits on parts of the rows filter these."""
    cleaned = df.select(key, model_text(F.col(text)).alias("__text"))
    return TextCounts(materialize(cleaned, "cleaned"), key, "__text", spec.analyzer, spec.low, spec.high)


def text_design(rows: DataFrame, weights: DataFrame, key: str, size: int, row_weight: Column | None = None) -> linear.Design:
    """Rows (key, label) with their document weights, stored for the passes of a fit. A row without known terms keeps the intercept."""
    none = F.array()
    joined = rows.join(weights.select(key, "indices", "weights"), key, "left")
    table = joined.select(
        F.col("label").cast("int").alias("y"), (F.lit(1.0) if row_weight is None else row_weight).cast("double").alias("s"),
        F.coalesce("indices", none.cast("array<int>")).alias("indices"), F.coalesce("weights", none.cast("array<double>")).alias("weights"),
    )
    return linear.Design(materialize(table, "training"), size)


def structured_design(df: DataFrame, size: int, row_weight: Column | None = None) -> linear.Design:
    """Rows with an ML vector ``features`` and a label, as a design."""
    v = F.unwrap_udt("features")
    every = F.sequence(F.lit(0), F.lit(size - 1))
    table = df.select(
        F.col("label").cast("int").alias("y"), (F.lit(1.0) if row_weight is None else row_weight).cast("double").alias("s"),
        F.when(v["type"] == 0, v["indices"]).otherwise(every).alias("indices"), v["values"].alias("weights"),
    )
    return linear.Design(materialize(table, "training"), size)


def linear_steps(inputs: int, spec: TextSpec, tol: float, passes: int):
    """Solver of what ``spec`` asks for; the intercept is penalised like any other input."""
    if spec.l1:
        if spec.model != "logistic":
            raise ValueError("an absolute penalty is for the logistic model")
        return linear.l1_logistic_steps(inputs, spec.c, tol, steps=passes)
    return linear.newton_cg_steps(inputs, spec.c, "logistic" if spec.model == "logistic" else "squared_hinge", tol, passes)


def fit_linear(design: linear.Design, spec: TextSpec, tol: float = 1e-4, passes: int = 400) -> linear.Fit:
    return linear.solve(design, linear_steps(design.inputs, spec, tol, passes))


def fit_ranker(
    rows: DataFrame, counts: DataFrame | TextCounts, spec: TextSpec, key: str, max_iter: int = 400, tol: float = 1e-4
) -> TextRanker:
    """Fit on ``rows`` (key, label); ``counts`` may hold more documents, only those of ``rows`` are used. ``max_iter`` bounds the
    passes over the rows."""
    own = counts.only(rows) if isinstance(counts, TextCounts) else counts.join(rows.select(key), key, "left_semi")
    classes = class_counts(rows)
    n = sum(classes.values())
    tfidf = fit_counts(own, n, spec.analyzer, spec.low, spec.high, spec.min_df, spec.sublinear)
    weight = class_weight(classes) if spec.balanced else None
    fit = fit_linear(text_design(rows, tfidf.weights(own, key, named=False), key, tfidf.size, weight), spec, tol, max_iter)
    kept = fit.w[:-1].nonzero()[0]
    known = pa.table({"index": pa.array(kept, pa.int32()), "coefficient": pa.array(fit.w[kept], pa.float64())})
    table = materialize(rows.sparkSession.createDataFrame(known), "coefficients")
    return TextRanker(spec, tfidf, table, float(fit.w[-1]))


@dataclass
class ChampionRanker:
    """Weighted rank blend of text rankers. Scores are relative to the batch they are ranked in."""

    rankers: dict[str, TextRanker]
    weights: Mapping[str, float]

    def score(self, df: DataFrame, key: str, text: str, groups: Sequence[str] = (), name: str = "score") -> DataFrame:
        out = df
        for ranker_name in self.weights:
            part = self.rankers[ranker_name].score(df.select(key, text), key, text, f"__{ranker_name}")
            out = out.join(part.select(key, f"__{ranker_name}"), key)
        out = materialize(out, "component-scores")
        blended = rank_blend(out, {f"__{n}": w for n, w in self.weights.items()}, name, groups)
        return blended.drop(*[f"__{n}" for n in self.weights])

    def save(self, path: str) -> None:
        for name, ranker in self.rankers.items():
            ranker.save(f"{path}/{name}")
        spark = next(iter(self.rankers.values())).coefficients.sparkSession
        spark.range(1).select(F.lit(json.dumps(dict(self.weights))).alias("weights")).write.mode("overwrite").parquet(f"{path}/blend")

    @staticmethod
    def load(spark: SparkSession, path: str) -> ChampionRanker:
        weights = json.loads(spark.read.parquet(f"{path}/blend").first()["weights"])
        return ChampionRanker({name: TextRanker.load(spark, f"{path}/{name}") for name in weights}, weights)


def fit_champion(
    df: DataFrame, key: str, text: str, weights: Mapping[str, float] = CHAMPION,
    rankers: Mapping[str, TextSpec] = RANKERS, max_iter: int = 400,
) -> ChampionRanker:
    rows = df.select(key, "label")
    fitted = {
        name: fit_ranker(rows, text_counts(df, rankers[name], key, text), rankers[name], key, max_iter)
        for name in weights
    }
    return ChampionRanker(fitted, weights)


def blended(
    df: DataFrame, probability_blends: Mapping[str, Mapping[str, float]], rank_blends: Mapping[str, Mapping[str, float]], groups: Sequence[str] = (),
) -> DataFrame:
    """A column for each blend of the rankers' score columns."""
    for name, weights in probability_blends.items():
        df = df.withColumn(name, sum(F.lit(w) * F.col(c) for c, w in weights.items()))
    for name, weights in rank_blends.items():
        df = rank_blend(df, weights, name, groups)
    return df


def validation_scores(
    train: DataFrame, held: DataFrame, key: str, text: str, specs: Mapping[str, TextSpec] = RANKERS,
    probability_blends: Mapping[str, Mapping[str, float]] = PROBABILITY_BLENDS, rank_blends: Mapping[str, Mapping[str, float]] = RANK_BLENDS, max_iter: int = 400,
) -> DataFrame:
    """Rows of ``held`` without their text, with a score column for each ranker fitted on ``train`` and for each blend."""
    rows, counts, out = train.select(key, "label"), {}, held
    for name, spec in specs.items():
        terms = (spec.analyzer, spec.low, spec.high)
        if terms not in counts:
            counts[terms] = text_counts(train, spec, key, text)
        out = fit_ranker(rows, counts[terms], spec, key, max_iter).score(out, key, text, name)
    return materialize(blended(materialize(out.drop(text), "component-scores"), probability_blends, rank_blends), "validation")


def fold_vocabulary(counts: DataFrame, folds: DataFrame, key: str, min_df: int = 1) -> DataFrame:
    """(repeat, fold, term, df, idf) of the documents outside each fold, by subtraction: what all documents hold less what the fold holds.

    ``counts`` (key, term, tf) is grouped once for all documents and once for all folds, whatever their number.
    """
    sizes = folds.groupBy("repeat", "fold").agg(F.count(F.lit(1)).alias("n")).collect()  # one row a fold
    in_repeat: dict[int, int] = {}
    for r in sizes:
        in_repeat[r["repeat"]] = in_repeat.get(r["repeat"], 0) + r["n"]
    every = F.array(*[F.struct(F.lit(r["repeat"]).alias("repeat"), F.lit(r["fold"]).alias("fold"), F.lit(in_repeat[r["repeat"]] - r["n"]).alias("n")) for r in sizes])
    known = counts.join(folds.select(key).distinct(), key, "left_semi")
    total = known.groupBy("term").agg(F.count(F.lit(1)).alias("all")).select("term", "all", F.explode(every).alias("f")).select("term", "all", "f.*")
    held = counts.join(folds.select(key, "repeat", "fold"), key).groupBy("repeat", "fold", "term").agg(F.count(F.lit(1)).alias("held"))
    df = F.col("all") - F.coalesce("held", F.lit(0))
    out = total.join(held, ["repeat", "fold", "term"], "left").withColumn("df", df).where(F.col("df") >= min_df)
    idf = F.log((F.lit(1.0) + F.col("n")) / (F.lit(1.0) + F.col("df"))) + F.lit(1.0)
    return out.select("repeat", "fold", "term", "df", idf.alias("idf"))


@dataclass
class FoldViews:
    """What each fit sees of a table (key, y, folds, indices, tf): inputs weighed by the IDF of its own training documents, class weights of
    its own, and weight 0 for the documents it must not learn from."""

    fits: list[tuple[TextSpec, int, int]]
    idf: dict[tuple[int, int], np.ndarray]
    df: dict[tuple[int, int], np.ndarray]
    classes: dict[tuple[int, int], dict[int, int]]

    def read(self, batch: pa.RecordBatch) -> tuple:
        n = batch.num_rows
        count = batch.column("indices").value_lengths().to_numpy(zero_copy_only=False).astype(np.int64)
        index = batch.column("indices").flatten().to_numpy(zero_copy_only=False).astype(np.int64)
        tf = batch.column("tf").flatten().to_numpy(zero_copy_only=False).astype(float)
        folds = batch.column("folds").flatten().to_numpy(zero_copy_only=False).reshape(n, -1)
        return np.repeat(np.arange(n), count), index, tf, folds, batch.column("y").to_numpy(zero_copy_only=False)

    def view(self, held: tuple, i: int) -> linear.Rows:
        owner, index, tf, folds, y = held
        spec, repeat, fold = self.fits[i]
        n, inputs = len(y), len(self.idf[repeat, fold])
        idf = np.where(self.df[repeat, fold] >= spec.min_df, self.idf[repeat, fold], 0.0)
        value = (1.0 + np.log(tf) if spec.sublinear else tf) * idf[index]
        norm = np.sqrt(np.bincount(owner, value**2, n))
        value = value / np.where(norm > 0, norm, 1.0)[owner]
        size = self.classes[repeat, fold]
        weight = {c: sum(size.values()) / (len(size) * k) if spec.balanced else 1.0 for c, k in size.items()}
        s = np.where(folds[:, repeat] == fold, 0.0, np.where(y > 0, weight.get(1, 0.0), weight.get(0, 0.0)))
        return linear.Rows(np.where(y > 0, 1.0, -1.0), s, np.r_[owner, np.arange(n)], np.r_[index, np.full(n, inputs)], np.r_[value, np.ones(n)], inputs + 1)


def fold_scores(
    rows: DataFrame, counts: DataFrame, specs: Mapping[str, TextSpec], folds: DataFrame, key: str, max_iter: int = 400, tol: float = 1e-4,
) -> DataFrame:
    """Held-out scores (key, label, repeat, fold, model, score) of rankers that share ``counts``, on identical folds.

    All fits of all folds go through the rows together: their number of passes is that of the slowest fit. Vocabulary, IDF and class
    weights of each fold are those of its training documents, found by subtraction.
    """
    least = min(s.min_df for s in specs.values())
    own = counts.join(rows.select(key), key, "left_semi")
    model = fit_counts(own, rows.count(), *next((s.analyzer, s.low, s.high) for s in specs.values()), least)
    size, combos = model.size, [(r["repeat"], r["fold"]) for r in folds.select("repeat", "fold").distinct().orderBy("repeat", "fold").collect()]
    if size * len(combos) * len(specs) > MAX_TOGETHER:
        raise ValueError(f"at most {MAX_TOGETHER} coefficients together")
    stats = fold_vocabulary(own, folds, key, least).join(model.vocabulary.select("term", "index"), "term").select("repeat", "fold", "index", "df", "idf").toArrow()
    place = {c: i for i, c in enumerate(combos)}
    span = 1 + max((f for _, f in combos), default=0)  # ascending like ``combos``; no Python object a term
    at = np.searchsorted([r * span + f for r, f in combos], stats.column("repeat").to_numpy().astype(np.int64) * span + stats.column("fold").to_numpy())
    idf, df = np.zeros((len(combos), size)), np.zeros((len(combos), size), np.int64)
    idf[at, stats.column("index").to_numpy()], df[at, stats.column("index").to_numpy()] = stats.column("idf").to_numpy(), stats.column("df").to_numpy()
    classes: dict = {c: {} for c in combos}
    totals: dict = {}
    for r in folds.select(key, "repeat", "fold").join(rows.select(key, "label"), key).groupBy("repeat", "fold", "label").count().collect():  # two rows a fold
        totals[r["repeat"], r["label"]] = totals.get((r["repeat"], r["label"]), 0) + r["count"]
        classes[r["repeat"], r["fold"]][r["label"]] = r["count"]
    for (r, f), held in classes.items():
        left = {c: n - held.get(c, 0) for (q, c), n in totals.items() if q == r}
        classes[r, f] = {int(c): n for c, n in left.items() if n}

    repeats = F.transform(F.array_sort(F.collect_list(F.struct("repeat", "fold"))), lambda x: x["fold"])
    terms = own.join(model.vocabulary.select("term", "index"), "term").groupBy(key).agg(F.sort_array(F.collect_list(F.struct("index", "tf"))).alias("t"))
    table = rows.select(key, "label").join(folds.groupBy(key).agg(repeats.alias("folds")), key).join(terms, key, "left").select(
        key, "label", F.coalesce(F.col("label"), F.lit(0)).cast("int").alias("y"), "folds", F.coalesce(F.transform("t", lambda x: x["index"]), F.array().cast("array<int>")).alias("indices"),
        F.coalesce(F.transform("t", lambda x: x["tf"].cast("double")), F.array().cast("array<double>")).alias("tf"),
    )
    table = materialize(table, "folded")
    fits = [(spec, r, f) for spec in specs.values() for r, f in combos]
    views = FoldViews(fits, {c: idf[i] for c, i in place.items()}, {c: df[i] for c, i in place.items()}, classes)
    shared = rows.sparkSession.sparkContext.broadcast(views)

    def seen(batch: pa.RecordBatch, live: Sequence[int]):
        held = shared.value.read(batch)
        return [(shared.value.view(held, i) for i in live)]

    solvers = [linear_steps(size, spec, tol, max_iter) for spec, _, _ in fits]
    found = linear.solve_together(table.select("y", "folds", "indices", "tf"), seen, solvers)
    names = [name for name in specs for _ in combos]
    weights = rows.sparkSession.sparkContext.broadcast([f.w for f in found])

    def score(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            held = shared.value.read(batch)
            for i, (spec, r, f) in enumerate(fits):
                out = np.flatnonzero(held[3][:, r] == f)
                if not len(out):
                    continue
                margin = shared.value.view(held, i).dot(weights.value[i])[out]
                value = margin if spec.model == "svm" else 1 / (1 + np.exp(-margin))
                kept = [batch.column(c).take(pa.array(out)) for c in (key, "label")]
                same = [pa.repeat(pa.scalar(v, t), len(out)) for v, t in ((r, pa.int32()), (f, pa.int32()), (names[i], pa.string()))]
                yield pa.RecordBatch.from_arrays([*kept, *same, pa.array(value)], [key, "label", "repeat", "fold", "model", "score"])

    types = dict(table.dtypes)
    return table.mapInArrow(score, f"`{key}` {types[key]}, label {types['label']}, repeat int, fold int, model string, score double")


def repeated_cv(
    df: DataFrame, key: str, text: str, specs: Mapping[str, TextSpec] = RANKERS,
    probability_blends: Mapping[str, Mapping[str, float]] = PROBABILITY_BLENDS,
    rank_blends: Mapping[str, Mapping[str, float]] = RANK_BLENDS,
    n_folds: int = 5, repeats: int = 10, seed: int = 42, max_iter: int = 400,
) -> tuple[DataFrame, DataFrame]:
    """Fold AUC per model and blend ``(model, repeat, fold, auc)``, and all held-out scores."""
    rows = materialize(df.select(key, "label"), "rows")
    folds = materialize(sampling.repeated_folds(rows, "label", key, n_folds, repeats, seed), "folds")
    alike: dict[tuple, dict[str, TextSpec]] = {}
    for name, spec in specs.items():
        alike.setdefault((spec.analyzer, spec.low, spec.high), {})[name] = spec
    parts = None
    for same in alike.values():
        part = fold_scores(rows, text_counts(df, next(iter(same.values())), key, text), same, folds, key, max_iter)
        parts = part if parts is None else parts.union(part)
    scores = materialize(parts, "fold-scores")
    wide = scores.groupBy(key, "label", "repeat", "fold").agg(*[F.max(F.when(F.col("model") == name, F.col("score"))).alias(name) for name in specs])
    wide = blended(wide, probability_blends, rank_blends, ["repeat", "fold"])
    models = [*specs, *probability_blends, *rank_blends]
    pairs = F.array(*[F.struct(F.lit(m).alias("model"), F.col(m).cast("double").alias("score")) for m in models])
    long = wide.select(key, "label", "repeat", "fold", F.explode(pairs).alias("p")).select(
        key, "label", "repeat", "fold", "p.model", "p.score")
    auc = evaluation.roc_auc(long, groups=["model", "repeat", "fold"]).withColumnRenamed("roc_auc", "auc")
    return auc, long


def grid_search(
    data: DataFrame, estimator, grid: Sequence[Mapping[Param, object]], n_folds: int = 5, parallelism: int = 4
) -> DataFrame:
    """Mean held-out AUC of every parameter point over the folds in column ``fold``; exact AUC, best first."""
    metric = BinaryClassificationEvaluator(labelCol="label", metricName="areaUnderROC", numBins=0)
    cv = CrossValidator(
        estimator=estimator, estimatorParamMaps=list(grid), evaluator=metric, numFolds=n_folds, foldCol="fold",
        parallelism=parallelism,
    ).fit(data)
    rows = []
    for point, score in zip(grid, cv.avgMetrics):
        text = ", ".join(f"{p.name}={v}" for p, v in sorted(point.items(), key=lambda kv: kv[0].name))
        rows.append((text, float(score)))
    return data.sparkSession.createDataFrame(rows, "params string, mean_auc double").orderBy(
        F.desc("mean_auc"), "params")


def tune_text(
    df: DataFrame, key: str, text: str, analyzer: str, ranges: Sequence[tuple[int, int]],
    min_dfs: Sequence[int], sublinears: Sequence[bool], model: str, cs: Sequence[float],
    l1s: Sequence[bool] = (False,), balances: Sequence[bool] = (False,), n_folds: int = 5, max_iter: int = 400,
    ledger: str | None = None,
) -> DataFrame:
    """Mean held-out AUC of every point of a grid of text and model settings, best first.

    All points and folds of an n-gram range go through the rows together, as many at a time as MAX_TOGETHER allows. With ``ledger``
    (a folder) the points of each range are appended once they are done, and a restart goes on after them.
    """
    spark = df.sparkSession
    rows = materialize(df.select(key, "label"), "rows")
    folds = materialize(sampling.fold_assignment(rows, "label", key, n_folds).select(key, F.lit(0).alias("repeat"), "fold"), "folds")
    parts = []
    for low, high in ranges:
        done = f"{ledger}/{analyzer}-{low}-{high}-{model}" if ledger else None
        if done and file_exists(spark, f"{done}/_SUCCESS"):
            parts.append(spark.read.parquet(done))
            continue
        points = [TextSpec(analyzer, low, high, m, s, model, c, l1, b) for m in min_dfs for s in sublinears for c in cs for l1 in l1s for b in balances]
        counts = text_counts(df, points[0], key, text)
        terms = counts.select("term").distinct().count()
        at_once = max(1, MAX_TOGETHER // max(1, terms * n_folds))
        scores = None
        for i in range(0, len(points), at_once):
            part = materialize(fold_scores(rows, counts, {str(p): p for p in points[i : i + at_once]}, folds, key, max_iter), "tuning")
            scores = part if scores is None else scores.union(part)
        auc = evaluation.roc_auc(scores, groups=["model", "fold"])
        means = auc.groupBy(F.col("model").alias("params")).agg(F.avg("roc_auc").alias("mean_auc"))
        if done:
            means.write.mode("overwrite").parquet(done)
            means = spark.read.parquet(done)
        parts.append(means)
    out = parts[0]
    for part in parts[1:]:
        out = out.union(part)
    return out.orderBy(F.desc("mean_auc"), "params")


def spread_rows(df: DataFrame, rows: int, inputs: int) -> DataFrame:
    """``df`` in so many partitions that none is more than BINNED_BYTES once trees keep a number for each input of each row; stored
    sparse rows are far smaller, so the files' own partitions do not tell."""
    parts = -(-rows * inputs * 4 // BINNED_BYTES)
    return df.repartition(parts) if parts > df.rdd.getNumPartitions() else df


def fit_structured(
    train: DataFrame, numeric: Sequence[str], categorical: Sequence[str],
    estimator: Callable[[int, bool], object], balanced: bool = False,
) -> Callable[[DataFrame], DataFrame]:
    """Encode and fit a classifier on structured inputs; returns the scorer."""
    enc = fit_encoder(train, numeric, categorical)
    data = enc.transform(train)
    classes = class_counts(train)
    if balanced:
        data = data.withColumn("weight", class_weight(classes))
    stored = materialize(data.select("features", "label", *(["weight"] if balanced else [])), "training")
    inputs = stored.schema["features"].metadata["ml_attr"]["num_attrs"]
    model = estimator(sum(classes.values()), balanced).fit(spread_rows(stored, sum(classes.values()), inputs))

    def score(df: DataFrame) -> DataFrame:
        out = model.transform(enc.transform(df))
        return out.withColumn("score", positive_score(out)).select(*df.columns, "score")

    return score


@dataclass
class StructuredLogistic:
    """A logistic model of structured inputs: the encoder, the coefficients with the intercept last, and the fit they come from."""

    encoder: InputEncoder
    candidate: linear.Candidate
    fit: linear.Fit

    def score(self, df: DataFrame, name: str = "score") -> DataFrame:
        v = F.unwrap_udt("features")
        size = len(self.fit.w) - 1
        w = F.array(*[F.lit(float(x)) for x in self.fit.w[:-1]])
        pairs = F.arrays_zip(F.when(v["type"] == 0, v["indices"]).otherwise(F.sequence(F.lit(0), F.lit(size - 1))).alias("i"), v["values"].alias("v"))
        margin = F.aggregate(pairs, F.lit(float(self.fit.w[-1])), lambda a, x: a + x["v"] * F.get(w, x["i"]))
        return self.encoder.transform(df).select(*df.columns, (F.lit(1.0) / (F.lit(1.0) + F.exp(-margin))).alias(name))


def structured_candidates(
    train: DataFrame, numeric: Sequence[str], categorical: Sequence[str], grid: Sequence[tuple[float, bool]] = LOGISTIC_GRID
) -> list[StructuredLogistic]:
    """Every candidate of the grid (inverse strength, balanced classes) at its optimum, fitted together."""
    enc = fit_encoder(train, numeric, categorical)
    data = enc.transform(train).select("features", "label")
    size = int(data.agg(F.max(F.coalesce(F.unwrap_udt("features")["size"], F.size(F.unwrap_udt("features")["values"])))).first()[0] or 0)
    candidates = [linear.Candidate(c, balanced) for c, balanced in grid]
    fits = linear.newton_logistic(structured_design(data, size, class_weight(class_counts(train))), candidates)
    return [StructuredLogistic(enc, c, f) for c, f in zip(candidates, fits, strict=True)]


def choose_candidate(models: Sequence[StructuredLogistic], held: DataFrame, key: str) -> tuple[StructuredLogistic, DataFrame]:
    """The model with the best AUC on ``held``, and (candidate, c, balanced, roc_auc) of all; the first of equals wins."""
    parts = None
    for i, m in enumerate(models):
        part = m.score(held.select(key, "label", *m.encoder.numeric, *m.encoder.categorical)).select("label", "score", F.lit(i).alias("candidate"))
        parts = part if parts is None else parts.union(part)
    auc = evaluation.roc_auc(parts, groups=["candidate"]).select("candidate", "roc_auc")
    settings = held.sparkSession.createDataFrame([(i, m.candidate.c, m.candidate.balanced) for i, m in enumerate(models)], "candidate int, c double, balanced boolean")
    table = materialize(settings.join(F.broadcast(auc), "candidate", "left"), "candidates")
    best = table.orderBy(F.desc_nulls_last("roc_auc"), "candidate").first()
    return models[best["candidate"]], table


def boosted_trees(**params) -> Callable[[int, bool], object]:
    settings = {"maxIter": 100, "maxDepth": 2, "stepSize": 0.1, "seed": 42, **params}
    return lambda n, weighted: GBTClassifier(labelCol="label", featuresCol="features", **settings)


def compare_models(predictions: Mapping[str, DataFrame], group: str | None = None, tie: str = "id", k: int = 5) -> DataFrame:
    """Metric bundle per model, best AUC first; the candidate is chosen by the gate, not here."""
    stacked = None
    for name, df in predictions.items():
        part = df.select(F.lit(name).alias("model"), *dict.fromkeys(["label", "score", tie, *([group] if group else [])]))
        stacked = part if stacked is None else stacked.unionByName(part)
    spark = stacked.sparkSession
    return evaluation.evaluate_models(stacked, spark.createDataFrame([(m,) for m in predictions], "model string"), group, k=k, tie=tie).orderBy(
        F.desc_nulls_last("roc_auc"), "model")
