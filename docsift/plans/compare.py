"""Comparing models: training runs, ablation, comparison tables, saved models."""

from __future__ import annotations

import json
import time
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from docsift.operators import classify as C
from docsift.operators import evaluate as E
from docsift.operators import features as X
from docsift.operators import linear as LN
from docsift.operators import splits as S
from docsift.plans.corpus import MAX_BROADCAST_IDS
from docsift.sources.store import broadcast_within, materialize

# Weight file size in MiB added for the downloaded encoder.
ENCODER_MB = 90.0

# Ways to name the best model.
BY_TEST_F1 = (("f1_macro", True),)
BY_WEIGHTED_F1 = (("f1_weighted", True), ("cv_f1_mean", True), ("infer_ms", False))


def run_models(
    fits: dict[str, Callable[[], Callable[[], DataFrame]]],
) -> tuple[DataFrame, dict[str, tuple[float, float]]]:
    """Fit models one after another; every fit is a Spark job of its own.

    Each entry fits and returns a function giving ``(y_true, y_pred, ...)`` test
    predictions. Returns written predictions of all models with a ``model``
    column, and ``{model: (fit seconds, predict seconds)}``.
    """
    parts, seconds = None, {}
    for name, fit in fits.items():
        t0 = time.perf_counter()
        predict = fit()
        t1 = time.perf_counter()
        rows = materialize(predict().select(F.lit(name).alias("model"), "y_true", "y_pred"), "predictions")
        seconds[name] = (t1 - t0, time.perf_counter() - t1)
        parts = rows if parts is None else parts.unionByName(rows)
    return parts, seconds


def results_table(predictions: DataFrame, seconds: dict[str, tuple[float, float]]) -> DataFrame:
    """Metrics of all models in one job, with train time and latency per document."""
    spark = predictions.sparkSession
    times = spark.createDataFrame(
        [(m, a, b) for m, (a, b) in seconds.items()], "model string, train_seconds double, infer_seconds double"
    )
    joined = E.model_metrics(predictions).join(F.broadcast(times), "model")
    return joined.withColumn("infer_ms_per_doc", F.col("infer_seconds") * 1000.0 / F.col("num_test_samples"))


def ablation(
    variants: dict[str, DataFrame], split: DataFrame, row_id: str, category: str, alpha: float = 0.1,
    config: X.TfidfConfig = X.STANDARD,
) -> DataFrame:
    """The same classifier on different inputs (raw and clean, each as terms or words): macro F1 each.

    The ids of the test set go to every task while they fit.
    """
    parts = None
    ids = broadcast_within(split.filter("is_test").select(row_id), MAX_BROADCAST_IDS)
    for name, terms in variants.items():
        if "words" in terms.columns and not X.by_words(config):
            terms = X.words_as_terms(terms, row_id, config, category)
        model = C.fit_naive_bayes(terms.join(ids, row_id, "left_anti"), row_id, category, alpha, config)
        test = terms.join(ids, row_id, "left_semi").withColumnRenamed(category, "y_true")
        score = LN.score_bayes if "words" in terms.columns else C.score_naive_bayes
        rows = score(test, model, row_id).select(F.lit(name).alias("model"), "y_true", "y_pred")
        parts = rows if parts is None else parts.unionByName(rows)
    return E.model_metrics(parts).select("model", "f1_macro")


REPORT_COLUMNS = {
    "model": "Model",
    "accuracy": "Accuracy",
    "precision_weighted": "Precision (W)",
    "recall_weighted": "Recall (W)",
    "f1_weighted": "F1 Weighted",
    "f1_macro": "F1 Macro",
}


def merged_report(metrics: DataFrame, kind: str) -> DataFrame:
    """Report column names with a constant type column."""
    return metrics.select(
        *[F.col(a).alias(b) for a, b in REPORT_COLUMNS.items()], F.lit(kind).alias("Type")
    )


def comparison_table(classic: DataFrame, advanced: DataFrame, sizes: DataFrame) -> DataFrame:
    """The best classic model and every advanced model, with artifact sizes.

    ``sizes(model, size_mb)`` may lack models; these count as zero.
    """
    names = ["model", "accuracy", "precision_macro", "recall_macro", "f1_macro"]
    best = E.best_model(classic, *BY_TEST_F1).select(*names)
    rows = best.unionByName(advanced.select(*names))
    return rows.join(sizes, "model", "left").withColumn("size_mb", F.round(F.coalesce("size_mb", F.lit(0.0)), 2))


def save_naive_bayes(model: C.NaiveBayes, path: str) -> None:
    """Term table as Parquet next to a one-row JSON description."""
    model.terms.write.mode("overwrite").parquet(f"{path}/terms")
    config = {k: getattr(model.config, k) for k in model.config.__dataclass_fields__}
    meta = json.dumps(
        {"classes": model.classes, "priors": model.priors, "name": model.name, "config": config}
    )
    spark = model.terms.sparkSession
    spark.createDataFrame([(meta,)], "value string").coalesce(1).write.mode("overwrite").text(f"{path}/meta")


def load_naive_bayes(spark: SparkSession, path: str) -> C.NaiveBayes:
    meta = json.loads(spark.read.text(f"{path}/meta").first()[0])
    terms = spark.read.parquet(f"{path}/terms")
    return C.NaiveBayes(meta["classes"], meta["priors"], terms, X.TfidfConfig(**meta["config"]), meta["name"])


def reevaluate(model: C.NaiveBayes, terms: DataFrame, split: DataFrame, row_id: str, category: str) -> DataFrame:
    """Metrics of a saved model on the saved test split, without training; documents come as terms or words."""
    if "words" in terms.columns:
        test = terms.join(broadcast_within(split.filter("is_test").select(row_id), MAX_BROADCAST_IDS), row_id, "left_semi")
        scored = LN.score_bayes(test.withColumnRenamed(category, "y_true"), model, row_id, merged=True)
    else:
        scored = C.score_naive_bayes(S.take_test(terms, split, row_id).withColumnRenamed(category, "y_true"), model, row_id)
    return E.model_metrics(scored.withColumn("model", F.lit(model.name)))
