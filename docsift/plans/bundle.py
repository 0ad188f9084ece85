"""A trained text model as one saved pipeline: vectoriser, classifier and class list together.

``TermVectorizer`` and ``LinearClassifier`` are Spark ML estimators over the table work
of ``operators.features`` and ``operators.linear``; their models go into a
``PipelineModel`` beside the library's own and are saved and loaded with it. The
vocabulary is a table in the bundle, the weights one row for each feature; both are
bounded by ``max_features``.

Rows with null text have no terms and get the prediction of a zero vector. Other
columns are carried along; row ids must be unique. Every model writes what its
``transform`` needs, so a loaded bundle depends on no table of the session it was made in.
"""

from __future__ import annotations

from collections.abc import Sequence

import numpy as np
import pyarrow as pa
from pyspark import keyword_only
from pyspark.ml import Estimator, Model, PipelineModel
from pyspark.ml.param import Param, Params, TypeConverters
from pyspark.ml.util import (
    DefaultParamsReadable,
    DefaultParamsReader,
    DefaultParamsWritable,
    DefaultParamsWriter,
    MLReadable,
    MLReader,
    MLWritable,
    MLWriter,
)
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from docsift.functions import text as T
from docsift.operators import classify as C
from docsift.operators import features as X
from docsift.operators import linear as LN
from docsift.sources.store import materialize


class _Writer(MLWriter):
    """Parameters and class list as metadata, the model's table beside them."""

    def __init__(self, instance: _TableModel):
        super().__init__()
        self.instance = instance

    def saveImpl(self, path: str) -> None:  # noqa: N802
        DefaultParamsWriter.saveMetadata(self.instance, path, self.sparkSession, {"more": self.instance.more()})
        self.instance.table().write.parquet(f"{path}/data")


class _Reader(MLReader):
    def __init__(self, kind: type):
        super().__init__()
        self.kind = kind

    def load(self, path: str) -> _TableModel:
        meta = DefaultParamsReader.loadMetadata(path, self.sparkSession)
        model = self.kind.restored(self.sparkSession.read.parquet(f"{path}/data"), meta["more"])
        model._resetUid(meta["uid"])
        DefaultParamsReader.getAndSetParams(model, meta)
        return model


class _TableModel(Model, MLWritable, MLReadable):
    """A model that is a table and a few values that JSON can hold."""

    def table(self) -> DataFrame:
        raise NotImplementedError

    def more(self) -> dict:
        return {}

    @classmethod
    def restored(cls, table: DataFrame, more: dict) -> _TableModel:
        raise NotImplementedError

    def write(self) -> MLWriter:
        return _Writer(self)

    @classmethod
    def read(cls) -> MLReader:
        return _Reader(cls)


class _TermParams(Params):
    rowId = Param(Params._dummy(), "rowId", "unique id of a row", TypeConverters.toString)
    inputCol = Param(Params._dummy(), "inputCol", "clean text", TypeConverters.toString)
    pattern = Param(Params._dummy(), "pattern", "token pattern of the vectoriser", TypeConverters.toString)
    config = Param(Params._dummy(), "config", "fields of TfidfConfig")
    vectors = Param(Params._dummy(), "vectors", "whether to give ML vectors, for the library's classifiers", TypeConverters.toBoolean)

    def __init__(self) -> None:
        super().__init__()
        fields = {k: getattr(X.STANDARD, k) for k in X.TfidfConfig.__dataclass_fields__}
        self._setDefault(rowId="doc_id", inputCol="clean", pattern="word2", config=fields, vectors=False)

    def tfidf(self) -> X.TfidfConfig:
        return X.TfidfConfig(**self.getOrDefault("config"))

    def terms(self, rows: DataFrame) -> DataFrame:
        """The rows with term counts in place of the text."""
        own, text = self.getOrDefault("rowId"), self.getOrDefault("inputCol")
        others = [c for c in rows.columns if c not in (own, text)]
        tokens = T.vector_tokens(F.coalesce(text, F.lit("")), self.getOrDefault("pattern"), accents=False)
        return X.document_terms(rows, own, tokens, self.tfidf(), *others)


class TermVectorizer(Estimator, _TermParams, DefaultParamsReadable, DefaultParamsWritable):
    """Fits the capped TF-IDF vocabulary of a clean text column."""

    @keyword_only
    def __init__(self, *, rowId="doc_id", inputCol="clean", pattern="word2", config=None, vectors=False):
        super().__init__()
        self._set(**self._input_kwargs)

    def _fit(self, dataset: DataFrame) -> TermVectorizerModel:
        vocabulary = materialize(X.fit_vocabulary(self.terms(dataset), self.tfidf()), "vocabulary")
        return self._copyValues(TermVectorizerModel(vocabulary))


class TermVectorizerModel(_TableModel, _TermParams):
    """Adds ``features``, in place of the text, from a ``(term, idx, df, idf)`` table."""

    def __init__(self, vocabulary: DataFrame):
        super().__init__()
        self.vocabulary = vocabulary

    def table(self) -> DataFrame:
        return self.vocabulary

    @classmethod
    def restored(cls, table: DataFrame, more: dict) -> TermVectorizerModel:
        return cls(table)

    def _transform(self, dataset: DataFrame) -> DataFrame:
        config = self.tfidf()
        rows = X.transform(self.terms(dataset), self.vocabulary, self.getOrDefault("rowId"), config)
        return X.to_vectors(rows, config.max_features) if self.getOrDefault("vectors") else rows


class _LinearParams(Params):
    labelCol = Param(Params._dummy(), "labelCol", "class of a row", TypeConverters.toString)
    loss = Param(Params._dummy(), "loss", "hinge or softmax", TypeConverters.toString)
    c = Param(Params._dummy(), "c", "weight of the loss", TypeConverters.toFloat)
    balanced = Param(Params._dummy(), "balanced", "whether classes weigh the same", TypeConverters.toBoolean)
    width = Param(Params._dummy(), "width", "number of features", TypeConverters.toInt)

    def __init__(self) -> None:
        super().__init__()
        self._setDefault(labelCol="category", loss=LN.SOFTMAX, c=1.0, balanced=True, width=X.STANDARD.max_features)


class LinearClassifier(Estimator, _LinearParams, DefaultParamsReadable, DefaultParamsWritable):
    """Regression or SVM of ``operators.linear`` on ``features array<struct<idx, weight>>``."""

    @keyword_only
    def __init__(self, *, labelCol="category", loss=LN.SOFTMAX, c=1.0, balanced=True, width=X.STANDARD.max_features):
        super().__init__()
        self._set(**self._input_kwargs)

    def _fit(self, dataset: DataFrame) -> LinearClassifierModel:
        label, problem = self.getOrDefault("labelCol"), LN.Problem(self.getOrDefault("c"))
        rows = materialize(dataset.select(label, "features"), "features")
        classes = list(C.class_counts(rows, label))
        blocks = LN.pack(rows, label, classes, self.getOrDefault("width"), balanced=self.getOrDefault("balanced"))
        fits = LN.fit(blocks, [problem], self.getOrDefault("loss"))
        return self._copyValues(LinearClassifierModel(classes, fits.of(problem)))


class LinearClassifierModel(_TableModel, _LinearParams):
    """Adds ``scores`` and ``y_pred`` in place of ``features``; classes are strings, numbers or booleans."""

    def __init__(self, classes: Sequence, weights: np.ndarray):
        super().__init__()
        self.classes, self.weights = list(classes), weights

    def table(self) -> DataFrame:
        """``(idx, weights)``; the last row is the intercept."""
        offsets = np.arange(len(self.weights) + 1, dtype=np.int32) * self.weights.shape[1]
        vectors = pa.ListArray.from_arrays(pa.array(offsets), pa.array(self.weights.ravel()))
        rows = pa.table({"idx": pa.array(np.arange(len(self.weights))), "weights": vectors})
        return SparkSession.active().createDataFrame(rows)

    def more(self) -> dict:
        return {"classes": self.classes}

    @classmethod
    def restored(cls, table: DataFrame, more: dict) -> LinearClassifierModel:
        held = table.toArrow().sort_by("idx").column("weights").combine_chunks()
        return cls(more["classes"], held.flatten().to_numpy().reshape(len(held), -1))

    def _transform(self, dataset: DataFrame) -> DataFrame:
        problem = LN.Problem(self.getOrDefault("c"))
        fits = LN.LinearFits([problem], self.classes, self.getOrDefault("loss"), self.weights, [], [], [], 0)
        return LN.predictions(dataset, fits, problem, *[c for c in dataset.columns if c != "features"])


def text_pipeline_model(
    vocabulary: DataFrame, fits: LN.LinearFits, problem: LN.Problem, config: X.TfidfConfig = X.STANDARD, **terms
) -> PipelineModel:
    """A bundle of a vocabulary and one of the fits made with it (a grid's best, say)."""
    first = TermVectorizerModel(vocabulary)
    first._set(config={k: getattr(config, k) for k in config.__dataclass_fields__}, **terms)
    second = LinearClassifierModel(fits.classes, fits.of(problem))
    second._set(loss=fits.loss, c=problem.c, width=config.max_features)
    return PipelineModel([first, second])
