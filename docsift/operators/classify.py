"""Classifiers that are plain aggregations: naive Bayes and nearest centroid.

A fitted model is a small table with arrays in class order plus the class list.
Scoring adds up the arrays per document; rows are not multiplied by classes.
"""

from __future__ import annotations

import math
from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from docsift.functions import vectors as V
from docsift.operators import features as X
from docsift.operators.labels import class_names
from docsift.sources.store import broadcast_within, materialize


MAX_BROADCAST_VALUES = 20_000_000


@dataclass
class NaiveBayes:
    """``terms(term, idf, weights array<double>)`` and log priors in class order."""

    classes: list
    priors: list[float]
    terms: DataFrame
    config: X.TfidfConfig
    name: str = "Naive Bayes"


def class_counts(df: DataFrame, category: str) -> dict:
    """Rows per class; the class list is checked to be small before it is read."""
    classes = class_names(df, category)
    rows = df.dropna(subset=[category]).groupBy(category).agg(F.count(F.lit(1)).alias("n")).collect()
    sizes = {r[category]: r["n"] for r in rows}
    return {c: sizes[c] for c in classes}


def class_term_sums(features: DataFrame, category: str, classes: list) -> DataFrame:
    """``(idx, sums array<double>)``: TF-IDF weight per class, combined map-side."""
    rows = X.long_weights(features.select(category, "features"))
    of_class = [F.sum(F.when(F.col(category) == F.lit(c), F.col("weight")).otherwise(0.0)) for c in classes]
    return rows.groupBy("idx").agg(F.array(*of_class).alias("sums"))


def smoothed_weights(sums: DataFrame, classes: list, alpha: float) -> DataFrame:
    """Log probabilities ``ln(N_ct + a) - ln(N_c + a V)`` per term in class order."""
    totals = [
        F.log(F.sum(F.col("sums")[i]) + F.lit(alpha) * F.count(F.lit(1))) for i in range(len(classes))
    ]
    totals = sums.agg(F.array(*totals)).scalar()
    weights = F.zip_with("sums", "totals", lambda s, t: F.log(s + F.lit(alpha)) - t)
    return sums.withColumn("totals", totals).select("term", "idf", weights.alias("weights"))


def fit_naive_bayes(
    terms: DataFrame,
    row_id: str,
    category: str,
    alpha: float = 0.1,
    config: X.TfidfConfig = X.STANDARD,
    vocabulary: DataFrame | None = None,
) -> NaiveBayes:
    """Multinomial naive Bayes on TF-IDF weights with additive smoothing.

    ``terms`` comes from ``document_terms`` with the category kept.
    """
    sizes = class_counts(terms, category)
    classes = list(sizes)
    total = sum(sizes.values())
    priors = [math.log(n / total) for n in sizes.values()]
    if vocabulary is None:
        vocabulary = materialize(X.fit_vocabulary(terms, config), "vocabulary")
    features = X.transform(terms, vocabulary, row_id, config)
    zeros = F.array(*[F.lit(0.0) for _ in classes])
    seen = class_term_sums(features, category, classes)
    sums = vocabulary.select("idx", "term", "idf").join(seen, "idx", "left")
    sums = materialize(sums.withColumn("sums", F.coalesce("sums", zeros)), "class-terms")
    return NaiveBayes(classes, priors, smoothed_weights(sums, classes, alpha), config)


def naive_bayes_grid(
    features: DataFrame, row_id: str, category: str, alphas: Sequence[float], folds: int = 5
) -> DataFrame:
    """Cross-validated predictions for every smoothing value:
    ``(row_id, fold, y_true, alpha, y_pred)``.

    ``features`` is a written ``transform`` table with a ``fold`` column. A model
    without one fold is the sum of the others, so all folds and values share one
    pass over the class sums and one over the rows, instead of one fit each.
    """
    features = features.dropna(subset=[category])
    classes = class_names(features, category)
    counts = features.groupBy(category, "fold").agg(F.count(F.lit(1)).alias("n")).collect()
    sizes = {(r[category], r["fold"]): r["n"] for r in counts}
    k, places = len(classes), range(len(classes))
    rows = X.long_weights(features.select(category, "fold", "features"))
    of_class = [F.sum(F.when(F.col(category) == F.lit(c), F.col("weight")).otherwise(0.0)) for c in classes]
    parts = materialize(rows.groupBy("idx", "fold").agg(F.array(*of_class).alias("part")), "fold-sums")
    whole = parts.groupBy("idx").agg(F.array(*[F.sum(F.col("part")[i]) for i in places]).alias("whole"))
    every = F.explode(F.sequence(F.lit(0), F.lit(folds - 1))).alias("fold")
    rest = F.zip_with(
        "whole",
        F.coalesce("part", F.array(*[F.lit(0.0) for _ in places])),
        lambda x, y: F.greatest(x - y, F.lit(0.0)),
    )
    kept = whole.select("idx", "whole", every).join(parts, ["idx", "fold"], "left").select("idx", "fold", rest.alias("rest"))
    totals = kept.groupBy("fold").agg(
        F.array(*[F.sum(F.col("rest")[i]) for i in places]).alias("total"), F.count(F.lit(1)).alias("terms")
    )
    logs = [
        F.log(F.col("rest")[i] + F.lit(a)) - F.log(F.col("total")[i] + F.lit(a) * F.col("terms"))
        for a in alphas
        for i in places
    ]
    model = kept.join(F.broadcast(totals), "fold").select("idx", "fold", F.array(*logs).alias("logs"))
    model = materialize(model, "fold-models")
    side = broadcast_within(model, MAX_BROADCAST_VALUES // (len(alphas) * k))
    summed = (
        features.select(row_id, category, "fold", F.inline_outer("features"))
        .join(side, ["idx", "fold"], "left")
        .groupBy(row_id, category, "fold")
        .agg(*[F.sum(F.col("weight") * F.col("logs")[j]).alias(f"s{j}") for j in range(len(alphas) * k)])
    )

    def prior(c, fold: int) -> Column:
        seen = sum(n for (d, f), n in sizes.items() if d == c and f != fold)
        return F.lit(math.log(seen / sum(n for (_, f), n in sizes.items() if f != fold)) if seen else -math.inf)

    def joint(j: int, i: int) -> Column:
        per_fold = F.get(F.array(*[prior(classes[i], f) for f in range(folds)]), F.col("fold"))
        return F.coalesce(F.col(f"s{j * k + i}"), F.lit(0.0)) + per_fold

    named = class_array(classes)
    choices = [
        F.struct(
            F.lit(float(a)).alias("alpha"),
            F.get(named, V.argmax(F.array(*[joint(j, i) for i in places]))).alias("y_pred"),
        )
        for j, a in enumerate(alphas)
    ]
    return summed.select(row_id, "fold", F.col(category).alias("y_true"), F.inline(F.array(*choices)))


def _model_side(model: NaiveBayes) -> DataFrame:
    values = model.config.max_features * (len(model.classes) + 1)
    return F.broadcast(model.terms) if values <= MAX_BROADCAST_VALUES else model.terms


def score_naive_bayes(terms: DataFrame, model: NaiveBayes, row_id: str) -> DataFrame:
    """``(row_id, ..., scores array<double>, y_pred)`` with class probabilities.

    The unit-length scaling is linear, so weights, squares and class scores are
    summed in one pass; each document leaves the map side as one row. Documents
    without a known term fall back to the priors.
    """
    others = [c for c in terms.columns if c not in ("terms", row_id)]
    raw = X.term_weight(model.config)
    places = range(len(model.classes))
    summed = (
        terms.select(row_id, *others, F.inline_outer("terms"))
        .join(_model_side(model), "term", "left")
        .groupBy(row_id, *others)
        .agg(
            F.sum(raw * raw).alias("square"),
            *[F.sum(raw * F.col("weights")[i]).alias(f"s{i}") for i in places],
        )
    )
    joint = F.array(
        *[F.coalesce(F.col(f"s{i}") / F.sqrt("square"), F.lit(0.0)) + F.lit(model.priors[i]) for i in places]
    )
    return with_prediction(
        summed.select(row_id, *others, joint.alias("joint")), V.softmax(F.col("joint")), model.classes, "joint"
    )


def class_array(classes: list) -> Column:
    return F.array(*[F.lit(c) for c in classes])


def with_prediction(df: DataFrame, scores: Column, classes: list, drop: str) -> DataFrame:
    """Add ``scores`` and the class of the largest one (lowest index on ties)."""
    place = V.argmax(F.col(drop))
    return df.select("*", scores.alias("scores"), F.get(class_array(classes), place).alias("y_pred")).drop(drop)


@dataclass
class NearestCentroid:
    """``table(category, centroid array<double>)``, one unit vector per class."""

    classes: list
    table: DataFrame
    name: str = "Nearest centroid"


def centroids(df: DataFrame, category: str, vector: str) -> DataFrame:
    """Unit-length mean vector per class; dimensions are averaged map-side."""
    means = (
        df.select(category, F.posexplode(vector).alias("i", "x"))
        .groupBy(category, "i")
        .agg(F.avg(F.col("x").cast("double")).alias("x"))
    )
    ordered = F.sort_array(F.collect_list(F.struct("i", "x")))
    centroid = F.transform(ordered, lambda e: e["x"])
    return means.groupBy(category).agg(V.l2_normalize(centroid).alias("centroid"))


def fit_centroids(df: DataFrame, category: str, vector: str) -> NearestCentroid:
    df = df.dropna(subset=[category, vector])
    classes = class_names(df, category)
    return NearestCentroid(classes, materialize(centroids(df, category, vector), "centroids"))


def score_centroids(df: DataFrame, model: NearestCentroid, vector: str) -> DataFrame:
    """Cosine similarity to every centroid inside the row; no shuffle.

    The model has one short row per class and reaches every task as a scalar.
    """
    category = model.table.columns[0]
    ordered = F.sort_array(F.collect_list(F.struct(category, "centroid")))
    table = model.table.agg(F.transform(ordered, lambda e: e["centroid"])).scalar()
    margins = F.transform("centroids", lambda c: V.dot(F.col("unit"), c))
    scored = (
        df.withColumn("centroids", table)
        .withColumn("unit", V.l2_normalize(F.col(vector)))
        .withColumn("margins", margins)
        .drop("centroids", "unit")
    )
    return with_prediction(scored, V.margin_confidence(F.col("margins")), model.classes, "margins")
