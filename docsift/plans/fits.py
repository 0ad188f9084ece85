"""Model fits: Spark ML's regression and SVM, forests, calibration, grid search."""

from __future__ import annotations

import warnings
from collections.abc import Callable, Sequence
from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.ml import Estimator, Model
from pyspark.ml.classification import LinearSVC, LogisticRegression, OneVsRest, RandomForestClassifier
from pyspark.ml.evaluation import Evaluator
from pyspark.ml.functions import vector_to_array
from pyspark.ml.tuning import CrossValidator, CrossValidatorModel, ParamGridBuilder
from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from docsift.functions import vectors as V
from docsift.operators import classify as C
from docsift.operators import evaluate as E
from docsift.operators import features as X
from docsift.operators import forest as FR
from docsift.operators import linear as LN
from docsift.sources.store import materialize

# Parameter grids, tree counts and seed.
SEED = 42
LR_GRID = [0.1, 1.0, 5.0]
SVM_GRID = [0.1, 0.5, 1.0, 2.0]
NB_GRID = [0.01, 0.1, 0.5, 1.0]
FOREST_TREES = 200
FOREST_DEPTHS = [30]
FOREST_MIN_ROWS = [1, 2]
TOLERANCE = 1e-4


class MacroF1(Evaluator):
    """F1 averaged over the classes that occur as truth or prediction."""

    def __init__(self, label: str = "label", prediction: str = "prediction") -> None:
        super().__init__()
        self.label, self.prediction = label, prediction

    def _evaluate(self, dataset: DataFrame) -> float:
        pairs = dataset.select(F.col(self.label).alias("y_true"), F.col(self.prediction).alias("y_pred"))
        return E.averages(E.class_metrics(pairs)).first()["f1_macro"]

    def isLargerBetter(self) -> bool:
        return True


@dataclass
class TrainingSet:
    """Vectors with ``label`` (class index), ``weight`` and optional ``fold``."""

    rows: DataFrame
    classes: list
    n: int


def training_set(vectors: DataFrame, category: str, balanced: bool = True) -> TrainingSet:
    sizes = C.class_counts(vectors, category)
    classes, n = list(sizes), sum(sizes.values())
    place = F.array_position(C.class_array(classes), F.col(category)) - 1
    weights = [n / (len(classes) * sizes[c]) if balanced else 1.0 for c in classes]
    rows = vectors.dropna(subset=[category]).withColumn("label", place.cast("double"))
    rows = rows.withColumn("weight", F.get(F.array(*[F.lit(w) for w in weights]), place.cast("int")))
    return TrainingSet(rows, classes, n)


def logistic_regression(n: int, c: float = 1.0, max_iter: int = 1000) -> LogisticRegression:
    return LogisticRegression(
        family="multinomial",
        standardization=False,
        regParam=1.0 / (c * n),
        maxIter=max_iter,
        tol=TOLERANCE,
        weightCol="weight",
    )


def linear_svm(n: int, c: float = 1.0, max_iter: int = 2000, parallelism: int = 4) -> OneVsRest:
    """The library's SVM, which minimises plain hinge loss; ``operators.linear`` fits the squared one."""
    svc = LinearSVC(standardization=False, regParam=1.0 / (c * n), maxIter=max_iter, tol=TOLERANCE)
    return OneVsRest(classifier=svc, weightCol="weight", parallelism=parallelism)


def random_forest(trees: int = FOREST_TREES, depth: int = 30, min_rows: int = 1) -> RandomForestClassifier:
    """The library's forest, which holds every row densely; ``fit_forest`` grows one with its settings from sparse rows."""
    return RandomForestClassifier(
        numTrees=trees, maxDepth=depth, minInstancesPerNode=min_rows, weightCol="weight", seed=SEED
    )


def _setting(forest: RandomForestClassifier, left_out: int = FR.NONE_LEFT_OUT) -> FR.Setting:
    """Trees, depth, smallest leaf and seed; the rest is as the library has it by default."""
    return FR.Setting(
        forest.getNumTrees(), forest.getMaxDepth(), forest.getMinInstancesPerNode(), left_out, forest.getSeed()
    )


def fit_forest(forest: RandomForestClassifier, rows: DataFrame, row_id: str = "doc_id") -> FR.Forest:
    """A forest of the settings on rows of a training set."""
    packed = FR.pack(rows, row_id)
    try:
        return FR.fit(packed, [_setting(forest)])[0]
    finally:
        packed.release()


@dataclass
class ForestSearch:
    """Macro F1 of the grid's points, averaged over the folds, and the best one fitted on all rows."""

    avgMetrics: list[float]  # noqa: N815 (named as the library's)
    bestModel: FR.Forest  # noqa: N815


def forest_search(
    forest: RandomForestClassifier, grid: list, rows: DataFrame, folds: int = 5, row_id: str = "doc_id"
) -> ForestSearch:
    """All points and folds grow side by side; ties go to the first point."""
    points = [forest.copy(point) for point in grid]
    asked = [(i, k) for i in range(len(points)) for k in range(folds)]
    packed = FR.pack(rows, row_id)
    try:
        found = FR.fit(packed, [_setting(points[i], k) for i, k in asked])
        parts = None
        for (i, k), fitted in zip(asked, found, strict=True):
            unseen = rows.filter(F.col("fold") == k).withColumnRenamed("label", "y_true")
            part = FR.predictions(unseen, fitted, [float(c) for c in range(len(packed.weights))], "fold", "y_true")
            part = part.select(F.lit(i).alias("point"), "fold", "y_true", "y_pred")
            parts = part if parts is None else parts.unionByName(part)
        scores = E.averages(E.class_metrics(parts, ["point", "fold"]), ["point", "fold"])
        means = {r["point"]: r["f1"] for r in scores.groupBy("point").agg(F.avg("f1_macro").alias("f1")).collect()}
        best = max(means, key=lambda i: (means[i], -i))
        return ForestSearch([means[i] for i in range(len(points))], FR.fit(packed, [_setting(points[best])])[0])
    finally:
        packed.release()


def predictions(model: Model | FR.Forest, rows: DataFrame, classes: Sequence, row_id: str, *keep: str) -> DataFrame:
    """``(row_id, ..., scores, y_pred)``: probabilities where the model has them,
    else confidences from margins."""
    if isinstance(model, FR.Forest):
        return FR.predictions(rows, model, classes, row_id, *keep)
    out = model.transform(rows)
    if "probability" in out.columns:
        scores = vector_to_array("probability")
    else:
        scores = V.margin_confidence(vector_to_array("rawPrediction"))
    y_pred = F.get(C.class_array(list(classes)), F.col("prediction").cast("int"))
    return out.select(row_id, *keep, scores.alias("scores"), y_pred.alias("y_pred"))


def grid_search(
    estimator: Estimator, grid: list, rows: DataFrame, folds: int = 5, parallelism: int = 4
) -> CrossValidatorModel | ForestSearch:
    """Cross-validated grid by macro F1 over the given ``fold`` column, then a refit."""
    if isinstance(estimator, RandomForestClassifier):
        return forest_search(estimator, grid, rows, folds)
    search = CrossValidator(
        estimator=estimator,
        estimatorParamMaps=grid,
        evaluator=MacroF1(),
        numFolds=folds,
        foldCol="fold",
        parallelism=parallelism,
        seed=SEED,
    )
    return search.fit(rows)


def regression_grid(lr: LogisticRegression, n: int, values: Sequence[float] = LR_GRID) -> list:
    return ParamGridBuilder().addGrid(lr.regParam, [1.0 / (c * n) for c in values]).build()


def svm_grid(ovr: OneVsRest, n: int, values: Sequence[float] = SVM_GRID) -> list:
    # points name the inner parameter: a copy of OneVsRest takes its own classifier again, not one of the point
    return ParamGridBuilder().addGrid(ovr.getClassifier().regParam, [1.0 / (c * n) for c in values]).build()


def forest_grid(forest: RandomForestClassifier) -> list:
    return (
        ParamGridBuilder()
        .addGrid(forest.maxDepth, FOREST_DEPTHS)
        .addGrid(forest.minInstancesPerNode, FOREST_MIN_ROWS)
        .build()
    )


def fold_predictions(
    fit: Callable[[DataFrame], Callable[[DataFrame], DataFrame]], rows: DataFrame, folds: int = 5
) -> DataFrame:
    """Out-of-fold predictions of one model with their ``fold``. ``fit`` takes
    training rows and returns a scorer."""
    parts = []
    for k in range(folds):
        score = fit(rows.filter(F.col("fold") != k))
        parts.append(score(rows.filter(F.col("fold") == k)).withColumn("fold", F.lit(k)))
    out = parts[0]
    for part in parts[1:]:
        out = out.unionByName(part)
    return out


def fold_scores(out_of_fold: DataFrame) -> DataFrame:
    """Macro F1 per fold in one job over all folds."""
    return E.averages(E.class_metrics(out_of_fold, ["fold"]), ["fold"]).select("fold", "f1_macro")


def naive_bayes_fold_predictions(
    terms: DataFrame, row_id: str, category: str, alpha: float = 0.1, config: X.TfidfConfig = X.STANDARD,
    vocabulary: DataFrame | None = None, folds: int = 5,
) -> DataFrame:
    """Cross-validation of naive Bayes. With a ``vocabulary`` the features are fit
    once outside the folds; without one they are refit in every fold."""

    def fit(train: DataFrame):
        model = C.fit_naive_bayes(train.drop("fold"), row_id, category, alpha, config, vocabulary)
        return lambda rows: C.score_naive_bayes(
            rows.drop("fold").withColumnRenamed(category, "y_true"), model, row_id
        )

    return fold_predictions(fit, terms, folds)


def platt_scaling(margins: DataFrame, by: Sequence[str], steps: int = 100, tolerance: float = 1e-6) -> pd.DataFrame:
    """Sigmoid parameters ``a, b`` per group for rows ``(*by, margin, positive)``.

    Newton's method for all groups together: each step is one grouped sum, and the
    driver holds one row per group; a fit that stops on the
    limit warns. Targets are smoothed by the group's counts.
    """
    counts = margins.groupBy(*by).agg(
        F.count_if("positive").alias("pos"), F.count_if(~F.col("positive")).alias("neg")
    ).toPandas()
    state = counts.assign(a=0.0, b=np.log((counts["neg"] + 1.0) / (counts["pos"] + 1.0)))
    for _ in range(steps):
        side = F.broadcast(margins.sparkSession.createDataFrame(state))
        z = F.col("a") * F.col("margin") + F.col("b")
        p = F.lit(1.0) / (F.lit(1.0) + F.exp(z))
        target = F.when(F.col("positive"), (F.col("pos") + 1.0) / (F.col("pos") + 2.0)).otherwise(
            1.0 / (F.col("neg") + 2.0)
        )
        sums = (
            margins.join(side, list(by))
            .select(*by, "margin", (target - p).alias("slope"), (p * (1 - p)).alias("bend"))
            .groupBy(*by)
            .agg(
                F.sum(F.col("slope") * F.col("margin")).alias("ga"),
                F.sum("slope").alias("gb"),
                F.sum(F.col("bend") * F.col("margin") * F.col("margin")).alias("haa"),
                F.sum(F.col("bend") * F.col("margin")).alias("hab"),
                F.sum("bend").alias("hbb"),
            )
            .toPandas()
        )
        merged = state.merge(sums, on=list(by))
        haa, hbb = merged["haa"] + 1e-12, merged["hbb"] + 1e-12
        det = haa * hbb - merged["hab"] ** 2
        da = -(hbb * merged["ga"] - merged["hab"] * merged["gb"]) / det
        db = -(haa * merged["gb"] - merged["hab"] * merged["ga"]) / det
        # where margins separate the classes the curve is nearly flat: no step is longer than one
        da, db = da.clip(-1.0, 1.0), db.clip(-1.0, 1.0)
        state = merged[[*by, "pos", "neg"]].assign(a=merged["a"] + da, b=merged["b"] + db)
        if max(da.abs().max(), db.abs().max()) < tolerance:
            return state
    warnings.warn(f"the sigmoids have not settled after {steps} steps", stacklevel=2)
    return state


@dataclass
class CalibratedSvm:
    """One SVM and one sigmoid per class and fold; probabilities are averaged."""

    fits: LN.LinearFits
    sigmoids: list[list[tuple[float, float]]]
    name: str = "Calibrated SVM"


def fit_calibrated_svm(
    blocks: LN.Blocks, rows: DataFrame, label: str = "category", c: float = 1.0, folds: int = 5
) -> CalibratedSvm:
    """The SVMs of all folds in shared passes, then sigmoids of the margins of the rows that they did not see.

    ``rows`` are those of the blocks, with ``features``, ``label`` and ``fold``.
    """
    fits = LN.fit(blocks, [LN.Problem(c, k) for k in range(folds)], LN.HINGE)
    k = len(fits.classes)
    own = F.slice("margins", F.col("fold") * k + 1, k)
    unseen = LN.margins(rows.dropna(subset=[label]), fits.weights, "fold", label).select(
        F.col("fold").cast("int").alias("fold"), label, F.posexplode(own).alias("class", "margin")
    )
    positive = F.array_position(C.class_array(fits.classes), F.col(label)) - 1 == F.col("class")
    unseen = materialize(unseen.select("fold", "class", "margin", positive.alias("positive")), "margins")
    state = platt_scaling(unseen, ["fold", "class"]).set_index(["fold", "class"])
    sigmoids = [
        [tuple(map(float, state.loc[(f, i), ["a", "b"]])) if (f, i) in state.index else (0.0, 0.0) for i in range(k)]
        for f in range(folds)
    ]
    return CalibratedSvm(fits, sigmoids)


def score_calibrated_svm(model: CalibratedSvm, rows: DataFrame, *keep: str) -> DataFrame:
    """``(*keep, scores, y_pred)`` of rows with ``features``."""
    folds, k = len(model.sigmoids), len(model.fits.classes)

    def probabilities(fold: int):
        raw = F.array(
            *[
                1.0 / (1.0 + F.exp(F.lit(a) * F.col("margins")[fold * k + i] + F.lit(b)))
                for i, (a, b) in enumerate(model.sigmoids[fold])
            ]
        )
        return F.transform(raw, lambda x: x / F.greatest(V.array_sum(raw), F.lit(1e-12)))

    total = probabilities(0)
    for fold in range(1, folds):
        total = F.zip_with(total, probabilities(fold), lambda x, y: x + y)
    found = LN.margins(rows, model.fits.weights, *keep)
    scored = found.select(*keep, F.transform(total, lambda x: x / F.lit(float(folds))).alias("scores"))
    return scored.withColumn("y_pred", F.get(C.class_array(model.fits.classes), V.argmax(F.col("scores"))))


def coefficient_table(model: Model, classes: Sequence, vocabulary: DataFrame) -> DataFrame:
    """``(class, term, weight)`` of a linear model: its size is the model's."""
    if hasattr(model, "coefficientMatrix"):
        matrix = model.coefficientMatrix.toArray()
    else:
        matrix = np.stack([m.coefficients.toArray() for m in model.models])
    return coefficient_rows(vocabulary, classes, matrix)


def coefficient_rows(vocabulary: DataFrame, classes: Sequence, matrix: np.ndarray) -> DataFrame:
    """``(class, term, weight)`` of a matrix with one row for each class."""
    long = pd.DataFrame(
        {
            "class": np.repeat([str(c) for c in classes], matrix.shape[1]),
            "idx": np.tile(np.arange(matrix.shape[1]), matrix.shape[0]),
            "weight": matrix.ravel(),
        }
    )
    table = vocabulary.sparkSession.createDataFrame(long, "class string, idx int, weight double")
    return table.join(vocabulary.select("idx", "term"), "idx").select("class", "term", "weight")


def top_class_terms(weights: DataFrame, k: int = 10, classes: int = 5) -> DataFrame:
    """The strongest terms of the first classes in name order."""
    first = weights.select("class").distinct().orderBy("class").limit(classes)
    order = W.partitionBy("class").orderBy(F.desc("weight"), F.asc("term"))
    ranked = weights.join(F.broadcast(first), "class", "left_semi").withColumn("rank", F.row_number().over(order))
    return ranked.filter(F.col("rank") <= k)
