"""The registered fits: vocabulary, weights, trees and grids as in the reference's training job."""

import math

import pytest
from pyspark.ml.linalg import Vectors

from docsift.operators import features as X
from docsift.operators import linear as LN
from docsift.plans import all_queries, fits as FT
from docsift.plans import queries_models as QM


def test_fits_see_the_whole_vocabulary(spark, small):
    train, test, vocabulary = QM._training(spark, small)
    expected = X.fit_vocabulary(QM.corpus(spark, small).train_terms()).count()
    assert vocabulary.count() == expected
    assert train.rows.first()["features"].size == test.first()["features"].size == 30_000
    sizes = {r["category"]: r["count"] for r in train.rows.groupBy("category").count().collect()}
    for r in train.rows.select("category", "weight").distinct().collect():
        assert math.isclose(r["weight"], train.n / (len(sizes) * sizes[r["category"]]))


def test_calibration_is_small_and_unweighted(spark, small, monkeypatch):
    seen = []

    class Fitted(Exception):
        pass

    def fit(blocks, rows):
        seen.append(blocks)
        raise Fitted

    monkeypatch.setattr(FT, "fit_calibrated_svm", fit)
    with pytest.raises(Fitted):
        QM.calibrated_svm_metrics(spark, small)
    assert seen[0].class_weights(LN.Problem(1.0)).tolist() == [1.0] * len(seen[0].classes)
    assert seen[0].width == 5_000


@pytest.fixture
def quick(spark, small, monkeypatch):
    """Forests of three trees and the first grid point only; ``asked`` lists what the queries asked for."""
    asked, real, kept = [], FT.random_forest, QM._training(spark, small)

    class Found:
        def __init__(self, estimator, grid, rows):
            asked.append((type(estimator).__name__, len(grid)))
            self.avgMetrics = [0.5] * len(grid)
            self.bestModel = real(trees=3, depth=3).fit(rows)

    def forest(*args, **more):
        asked.append(real(*args, **more).getNumTrees())
        return real(trees=3, depth=3)

    monkeypatch.setattr(FT, "random_forest", forest)
    monkeypatch.setattr(FT, "grid_search", Found)
    monkeypatch.setattr(QM, "_training", lambda *_: kept)
    real_once = QM.once
    own = lambda name: name in ("forest", "grid of Random Forest")
    monkeypatch.setattr(QM, "once", lambda s, d, n, make: make() if own(n) else real_once(s, d, n, make))
    return asked


def test_forests_have_all_trees(spark, small, quick):
    QM.random_forest_metrics(spark, small)
    assert QM.forest_grid_scores(spark, small).count() == 2
    assert [n for n in quick if isinstance(n, int)] == [200, 200]


def test_svm_grid_points_reach_the_fits(spark):
    rows = [(i, "ab"[i % 2], Vectors.dense([float(i % 2) + 0.1 * (i % 7), 1.0])) for i in range(40)]
    train = FT.training_set(spark.createDataFrame(rows, ["id", "category", "features"]), "category")
    svm = FT.linear_svm(train.n, max_iter=5)
    used = [svm.copy(point).getClassifier().getRegParam() for point in FT.svm_grid(svm, train.n)]
    assert used == [1.0 / (c * train.n) for c in FT.SVM_GRID]
    fits = [svm.fit(train.rows, point).models[0].coefficients.toArray().tolist() for point in FT.svm_grid(svm, train.n)]
    assert fits[0] != fits[-1]


def test_all_grids_and_the_model_run_are_registered():
    assert {"grid_search_scores", "svm_grid_scores", "forest_grid_scores", "trained_models"} <= set(all_queries())


def test_trained_models(spark, small, quick):
    found = {r["model"]: r for r in QM.trained_models(spark, small).collect()}
    assert set(found) == {"Logistic Regression", "Linear SVM", "Random Forest", "Naive Bayes"}
    assert len({r["num_test_samples"] for r in found.values()}) == 1
    assert ("RandomForestClassifier", 2) in quick
    for name, points in (("Linear SVM", 4), ("Logistic Regression", 3)):
        fits = QM._linear_grid(spark, small, name)
        assert len(fits.problems) == points * 6 and all(fits.converged)
