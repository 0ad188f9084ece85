"""Queries over the test tables: one entry per operator, with its SQL check."""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from docsift.operators import classify as C
from docsift.operators import features as X
from docsift.operators import linear as LN
from docsift.operators import splits as S
from docsift.plans.corpus import Corpus, Words, prepare, prepare_words
from docsift.sources.store import materialize, spread

Run = Callable[[SparkSession, str], DataFrame]


@dataclass(frozen=True)
class Query:
    run: Run
    operators: tuple[str, ...]
    sql: str | None


QUERIES: dict[str, Query] = {}


def query(operators: str, sql: str | None = None) -> Callable[[Run], Run]:
    """Register a function under its own name for the listed operator ids."""

    def register(run: Run) -> Run:
        name = run.__name__
        if name in QUERIES:
            raise ValueError(f"query {name} is registered twice")
        QUERIES[name] = Query(run, tuple(operators.split()), sql)
        return run

    return register


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def documents(spark: SparkSession, sf_dir: str, *columns: str) -> DataFrame:
    """Documents with the needed columns, spread over the cores."""
    rows = table(spark, sf_dir, "documents").select("doc_id", *columns)
    return spread(rows, "doc_id") if "text" in columns else rows


_written: dict[tuple, object] = {}


def once(spark: SparkSession, sf_dir: str, name: str, make: Callable[[], object]):
    """Tables and models that a user writes once and reads in later steps."""
    key = (spark.sparkContext.applicationId, sf_dir, name)
    if key not in _written:
        _written[key] = make()
    return _written[key]


def forget() -> None:
    _written.clear()


def corpus(spark: SparkSession, sf_dir: str) -> Corpus:
    """The prepared corpus with the language as category."""
    make = lambda: prepare(table(spark, sf_dir, "documents"), "lang")
    return once(spark, sf_dir, "corpus", make)


def words(spark: SparkSession, sf_dir: str, raw: bool = False) -> Words:
    """Words and split of the same corpus, and on demand the words of its raw texts."""
    make = lambda: prepare_words(table(spark, sf_dir, "documents"), "lang", raw=raw)
    return once(spark, sf_dir, f"words {raw}", make)


def fitted_vocabulary(spark: SparkSession, sf_dir: str, config: X.TfidfConfig = X.STANDARD) -> DataFrame:
    """The vocabulary of the training part, written once."""
    make = lambda: materialize(X.fit_vocabulary(words(spark, sf_dir).train(), config), "vocabulary")
    return once(spark, sf_dir, f"vocabulary {config}", make)


def naive_bayes(spark: SparkSession, sf_dir: str, alpha: float = 0.1) -> C.NaiveBayes:
    """The text model, fit on the words of the training part."""

    def fit() -> C.NaiveBayes:
        train, fitted = words(spark, sf_dir).train(), fitted_vocabulary(spark, sf_dir)
        return C.fit_naive_bayes(train, "doc_id", "category", alpha, vocabulary=fitted)

    return once(spark, sf_dir, f"naive bayes {alpha}", fit)


def naive_bayes_predictions(spark: SparkSession, sf_dir: str) -> DataFrame:
    """``(doc_id, y_true, scores, y_pred)`` of the text model on all usable documents."""

    def score() -> DataFrame:
        rows = words(spark, sf_dir).words.withColumnRenamed("category", "y_true")
        return materialize(LN.score_bayes(rows, naive_bayes(spark, sf_dir), "doc_id", merged=True), "text-scores")

    return once(spark, sf_dir, "naive bayes predictions", score)


def document_vectors(spark: SparkSession, sf_dir: str) -> DataFrame:
    """``(doc_id, y_true, embedding)``: precomputed vectors joined on the document id."""
    vectors = table(spark, sf_dir, "embeddings").select(F.col("vec_id").alias("doc_id"), "embedding")
    return documents(spark, sf_dir, "lang").withColumnRenamed("lang", "y_true").join(vectors, "doc_id")


def vector_model(spark: SparkSession, sf_dir: str) -> C.NearestCentroid:
    """The embedding model, fit on the training part of the corpus."""

    def fit() -> C.NearestCentroid:
        train = S.take_train(document_vectors(spark, sf_dir), words(spark, sf_dir).split, "doc_id")
        return C.fit_centroids(train, "y_true", "embedding")

    return once(spark, sf_dir, "vector model", fit)


def vector_predictions(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Nearest-centroid predictions of the language of all documents."""
    scored = C.score_centroids(document_vectors(spark, sf_dir), vector_model(spark, sf_dir), "embedding")
    return scored.drop("embedding")


def label_split(spark: SparkSession, sf_dir: str) -> DataFrame:
    """``(vec_id, is_test)`` of the embeddings, stratified by label."""

    def make() -> DataFrame:
        rows = table(spark, sf_dir, "embeddings").select("vec_id", "label")
        return materialize(S.stratified_split(rows, "vec_id", "label").select("vec_id", "is_test"), "label-split")

    return once(spark, sf_dir, "label split", make)


def label_model(spark: SparkSession, sf_dir: str) -> C.NearestCentroid:
    """Centroids of the embedding labels, fit on the training part."""

    def fit() -> C.NearestCentroid:
        train = S.take_train(table(spark, sf_dir, "embeddings"), label_split(spark, sf_dir), "vec_id")
        return C.fit_centroids(train, "label", "embedding")

    return once(spark, sf_dir, "label model", fit)


def label_predictions(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Nearest-centroid predictions of all embedding labels: ``(vec_id, y_true, scores, y_pred)``."""
    rows = table(spark, sf_dir, "embeddings").withColumnRenamed("label", "y_true")
    return C.score_centroids(rows, label_model(spark, sf_dir), "embedding").drop("embedding")


def label_test_predictions(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The predictions that evaluations use: those of the test part."""
    return S.take_test(label_predictions(spark, sf_dir), label_split(spark, sf_dir), "vec_id")


def label_classes(spark: SparkSession, sf_dir: str) -> list:
    return label_model(spark, sf_dir).classes


def rounded(df: DataFrame, *columns: str, places: int = 6) -> DataFrame:
    return df.withColumns({c: F.round(F.col(c).cast("double"), places) for c in columns})
