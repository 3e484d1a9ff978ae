"""The fitted operators as Spark ML estimators and transformers, for use in a ``Pipeline``.

Settings are ``Params``; a fitted stage keeps its state in tables beside the metadata that Spark writes. So a pipeline that holds these
stages, alone or among Spark's own, is saved and loaded like any other (``PipelineModel.save`` and ``.load``), and its tables stay
tables. A loaded stage has the uid and the settings of the saved one. Saving where something is already raises an error, unless
``write().overwrite()`` is used.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.ml import Estimator, Model, Transformer
from pyspark.ml.param import Param, Params, TypeConverters
from pyspark.ml.util import DefaultParamsReader, DefaultParamsWriter, MLReadable, MLReader, MLWritable, MLWriter
from pyspark.sql import DataFrame, SparkSession

from ladle.functions import fixed
from ladle.operators.encode import InputEncoder, fit_encoder
from ladle.operators.popularity import PopularityModel, fit_popularity
from ladle.operators.ranks import rank_blend
from ladle.operators.tfidf import TfidfModel, fit_tfidf, to_vectors


def _param(name: str, doc: str, converter=None) -> Param:
    return Param(Params._dummy(), name, doc, converter)


class _Writer(MLWriter):
    def __init__(self, stage: TableBacked):
        super().__init__()
        self.stage = stage

    def saveImpl(self, path: str) -> None:  # noqa: N802
        DefaultParamsWriter.saveMetadata(self.stage, path, self.sparkSession)
        self.stage.save_state(f"{path}/state")


class _Reader(MLReader):
    def __init__(self, cls: type):
        super().__init__()
        self.cls = cls

    def load(self, path: str):
        metadata = DefaultParamsReader.loadMetadata(path, self.sparkSession)
        stage = self.cls()
        stage._resetUid(metadata["uid"])
        DefaultParamsReader.getAndSetParams(stage, metadata)
        stage.load_state(self.sparkSession, f"{path}/state")
        return stage


class TableBacked(MLWritable, MLReadable):
    """Written as metadata plus whatever tables the stage keeps; a stage without state keeps none."""

    def write(self) -> MLWriter:
        return _Writer(self)

    @classmethod
    def read(cls) -> MLReader:
        return _Reader(cls)

    def save_state(self, path: str) -> None:
        pass

    def load_state(self, spark: SparkSession, path: str) -> None:
        pass


class _Popularity(Params):
    group_col = _param("group_col", "column whose mean rating is the score", TypeConverters.toString)
    rating_col = _param("rating_col", "column of ratings", TypeConverters.toString)
    score_col = _param("score_col", "column of scores", TypeConverters.toString)


class PopularityRankerModel(Model, _Popularity, TableBacked):
    fitted: PopularityModel

    def _transform(self, dataset: DataFrame) -> DataFrame:
        return self.fitted.score(dataset, self.getOrDefault(self.score_col))

    def save_state(self, path: str) -> None:
        self.fitted.save(path)

    def load_state(self, spark: SparkSession, path: str) -> None:
        self.fitted = PopularityModel.load(spark, path)


class PopularityRanker(Estimator, _Popularity, TableBacked):
    """Scores rows by the mean rating of their group in the fitted rows."""

    def __init__(self, group_col: str = "cuisine_path", rating_col: str = "rating", score_col: str = "score"):
        super().__init__()
        self._set(group_col=group_col, rating_col=rating_col, score_col=score_col)

    def _fit(self, dataset: DataFrame) -> PopularityRankerModel:
        model = self._copyValues(PopularityRankerModel())
        model.fitted = fit_popularity(dataset, self.getOrDefault(self.group_col), self.getOrDefault(self.rating_col))
        return model


class _Terms(Params):
    key_col = _param("key_col", "column that is unique per row", TypeConverters.toString)
    text_col = _param("text_col", "column of texts", TypeConverters.toString)
    output_col = _param("output_col", "column of term vectors", TypeConverters.toString)
    analyzer = _param("analyzer", "word or char_wb", TypeConverters.toString)
    low = _param("low", "fewest words or characters of a term", TypeConverters.toInt)
    high = _param("high", "most words or characters of a term", TypeConverters.toInt)
    min_df = _param("min_df", "fewest documents of a term", TypeConverters.toInt)
    sublinear = _param("sublinear", "whether 1 + ln(tf) replaces tf", TypeConverters.toBoolean)


class TfidfVectorizerModel(Model, _Terms, TableBacked):
    fitted: TfidfModel

    def _transform(self, dataset: DataFrame) -> DataFrame:
        key = self.getOrDefault(self.key_col)
        weights = self.fitted.transform(dataset, key, self.getOrDefault(self.text_col), named=False)
        return to_vectors(dataset, weights, key, self.fitted.size, self.getOrDefault(self.output_col))

    def save_state(self, path: str) -> None:
        self.fitted.save(path)

    def load_state(self, spark: SparkSession, path: str) -> None:
        self.fitted = TfidfModel.load(spark, path)


class TfidfVectorizer(Estimator, _Terms, TableBacked):
    """Smooth-IDF, L2-normalised term vectors of a text column; ``key_col`` is unique per row."""

    def __init__(self, key_col: str = "id", text_col: str = "text", output_col: str = "features", analyzer: str = "word",
                 low: int = 1, high: int = 1, min_df: int = 1, sublinear: bool = False):
        super().__init__()
        self._set(key_col=key_col, text_col=text_col, output_col=output_col, analyzer=analyzer, low=low, high=high, min_df=min_df, sublinear=sublinear)

    def _fit(self, dataset: DataFrame) -> TfidfVectorizerModel:
        model = self._copyValues(TfidfVectorizerModel())
        settings = [self.getOrDefault(p) for p in (self.key_col, self.text_col, self.analyzer, self.low, self.high, self.min_df, self.sublinear)]
        model.fitted, _ = fit_tfidf(dataset, *settings)
        return model


class _Inputs(Params):
    numeric = _param("numeric", "numeric columns", TypeConverters.toListString)
    categorical = _param("categorical", "categorical columns", TypeConverters.toListString)


class StructuredEncoderModel(Model, _Inputs, TableBacked):
    fitted: InputEncoder

    def _transform(self, dataset: DataFrame) -> DataFrame:
        return self.fitted.transform(dataset)

    def save_state(self, path: str) -> None:
        self.fitted.save(path)

    def load_state(self, spark: SparkSession, path: str) -> None:
        self.fitted = InputEncoder.load(spark, path)


class StructuredEncoder(Estimator, _Inputs, TableBacked):
    """Exact-median imputation, population scaling, mode imputation and one-hot encoding into ``features``."""

    def __init__(self, numeric: Sequence[str] = tuple(fixed.NUMERIC_INPUTS),
                 categorical: Sequence[str] = tuple(fixed.CATEGORICAL_INPUTS)):
        super().__init__()
        self._set(numeric=list(numeric), categorical=list(categorical))

    def _fit(self, dataset: DataFrame) -> StructuredEncoderModel:
        model = self._copyValues(StructuredEncoderModel())
        model.fitted = fit_encoder(dataset, self.getOrDefault(self.numeric), self.getOrDefault(self.categorical))
        return model


class RankBlend(Transformer, TableBacked):
    """Weighted percentile ranks of several score columns within each group."""

    weights = _param("weights", "weight of each score column")
    score_col = _param("score_col", "column of blended scores", TypeConverters.toString)
    groups = _param("groups", "columns within whose groups ranks are taken", TypeConverters.toListString)

    def __init__(self, weights: Mapping[str, float] | None = None, score_col: str = "score", groups: Sequence[str] = ()):
        super().__init__()
        self._set(weights=dict(weights or {}), score_col=score_col, groups=list(groups))

    def _transform(self, dataset: DataFrame) -> DataFrame:
        return rank_blend(dataset, self.getOrDefault(self.weights), self.getOrDefault(self.score_col), self.getOrDefault(self.groups))
