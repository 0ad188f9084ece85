import math

import pytest
from pyspark.ml.linalg import Vectors
from pyspark.sql import functions as F

from docsift.operators import evaluate as E
from docsift.operators import linear as LN
from docsift.plans import compare as CM
from docsift.plans import fits as FT


@pytest.fixture(scope="module")
def training(spark):
    """Three classes on three features, cleanly apart but unbalanced."""
    rows = []
    for i in range(90):
        c = "abc"[0 if i < 50 else 1 if i < 75 else 2]
        place = "abc".index(c)
        values = [0.1 * ((i * 7 + j) % 5) + (1.0 if j == place else 0.0) for j in range(3)]
        rows.append((i, c, i % 3, Vectors.dense(values)))
    df = spark.createDataFrame(rows, ["id", "category", "fold", "features"])
    return FT.training_set(df, "category")


def scores(training, model):
    rows = training.rows.withColumnRenamed("category", "y_true")
    return FT.predictions(model, rows, training.classes, "id", "y_true")


def test_balanced_weights(training):
    weights = {r["category"]: r["weight"] for r in training.rows.select("category", "weight").distinct().collect()}
    assert math.isclose(weights["a"], 90 / (3 * 50)) and math.isclose(weights["c"], 90 / (3 * 15))


@pytest.mark.parametrize("make", ["lr", "svm", "forest"])
def test_models_learn(training, make):
    estimator = {
        "lr": lambda: FT.logistic_regression(training.n, max_iter=50),
        "svm": lambda: FT.linear_svm(training.n, max_iter=10),
        "forest": lambda: FT.random_forest(trees=10, depth=5),
    }[make]()
    out = scores(training, estimator.fit(training.rows))
    assert E.averages(E.class_metrics(out)).first()["f1_macro"] > 0.95
    for r in out.collect():
        assert math.isclose(sum(r["scores"]), 1.0, rel_tol=1e-6)


def test_calibration(spark):
    rows = labelled(spark, 90)
    blocks = LN.pack(rows, "category", ["a", "b", "c"], 3, "fold", balanced=False)
    model = FT.fit_calibrated_svm(blocks, rows, folds=3)
    out = FT.score_calibrated_svm(model, rows.withColumnRenamed("category", "y_true"), "id", "y_true").collect()
    assert all(math.isclose(sum(r["scores"]), 1.0, rel_tol=1e-9) for r in out)
    assert sum(r["y_true"] == r["y_pred"] for r in out) / len(out) > 0.95


def labelled(spark, n):
    rows = []
    for i in range(n):
        c = "abc"[0 if i < n // 2 else 1 if i < n * 5 // 6 else 2]
        values = [0.1 * ((i * 7 + j) % 5) + (1.0 if j == "abc".index(c) else 0.0) for j in range(3)]
        rows.append((i, c, i % 3, list(enumerate(values))))
    return spark.createDataFrame(rows, "id int, category string, fold int, features array<struct<idx:int,weight:double>>")


def test_platt_separates(spark):
    rows = [(0, float(m), (m > 0) != (m % 7 == 0)) for m in range(-40, 41)]
    df = spark.createDataFrame(rows, "g int, margin double, positive boolean")
    state = FT.platt_scaling(df, ["g"])
    assert state.loc[0, "a"] < 0 and abs(state.loc[0, "b"]) < 1


def test_grid_search_uses_the_folds(training):
    lr = FT.logistic_regression(training.n, max_iter=20)
    found = FT.grid_search(lr, FT.regression_grid(lr, training.n, [0.1, 5.0]), training.rows, folds=3)
    assert len(found.avgMetrics) == 2 and max(found.avgMetrics) > 0.9
    assert len(FT.svm_grid(FT.linear_svm(9), 9)) == 4 and len(FT.forest_grid(FT.random_forest())) == 2


def test_top_terms_per_class(spark, training):
    model = FT.logistic_regression(training.n, max_iter=30).fit(training.rows)
    vocabulary = spark.createDataFrame([(0, "alpha"), (1, "beta"), (2, "gamma")], "idx int, term string")
    top = FT.top_class_terms(FT.coefficient_table(model, training.classes, vocabulary), k=1).collect()
    assert {r["class"]: r["term"] for r in top} == {"a": "alpha", "b": "beta", "c": "gamma"}


def test_saved_ml_model(spark, training, tmp_path):
    from pyspark.ml import Pipeline

    from docsift.sources.store import load_model, save_model

    model = Pipeline(stages=[FT.logistic_regression(training.n, max_iter=20)]).fit(training.rows)
    save_model(model, str(tmp_path / "m"))
    back = load_model(str(tmp_path / "m")).transform(training.rows).select("id", "prediction")
    assert back.exceptAll(model.transform(training.rows).select("id", "prediction")).count() == 0


def test_model_run_and_tables(spark, training):
    rows = training.rows.withColumnRenamed("category", "y_true")

    def fit(c):
        def run():
            model = FT.logistic_regression(training.n, c, max_iter=20).fit(training.rows)
            return lambda: FT.predictions(model, rows, training.classes, "id", "y_true")

        return run

    predictions, seconds = CM.run_models({"strong": fit(5.0), "weak": fit(0.01)})
    table = CM.results_table(predictions, seconds)
    assert {r["model"] for r in table.collect()} == {"strong", "weak"}
    best = E.best_model(table, *CM.BY_TEST_F1).first()
    assert best["infer_ms_per_doc"] > 0 and best["train_seconds"] > 0
    timed = E.with_latency(E.model_metrics(predictions), F.lit(0.9)).first()
    assert math.isclose(timed["avg_latency_ms_per_doc"], 10.0)


def test_naive_bayes_folds(spark, small):
    from docsift.plans.registry import corpus

    c = corpus(spark, small)
    folds = c.split.select("doc_id", "fold")
    out = FT.naive_bayes_fold_predictions(c.train_terms().join(folds, "doc_id"), "doc_id", "category", folds=2)
    scored = FT.fold_scores(out)
    assert scored.count() == 2
