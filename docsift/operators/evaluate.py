"""Evaluation of predictions ``(y_true, y_pred[, scores])``.

Everything starts from confusion counts, which are combined map-side and have at
most classes squared rows. ``by`` evaluates many models in one job.
"""

from __future__ import annotations

import math
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from docsift.functions import text as T

#: Score ranges for each factor e of the distance from 0 or 1, and the outermost range.
SCORE_STEPS = 64
LAST_RANGE = 100_000


def misclassified(df: DataFrame) -> DataFrame:
    return df.filter(F.col("y_true") != F.col("y_pred"))


def confusion_counts(df: DataFrame, by: Sequence[str] = ()) -> DataFrame:
    return df.groupBy(*by, "y_true", "y_pred").agg(F.count(F.lit(1)).alias("n"))


def _classes(counts: DataFrame, by: Sequence[str]) -> DataFrame:
    named = counts.select(*by, F.explode(F.array("y_true", "y_pred")).alias("class"))
    return named.groupBy(*by).agg(F.sort_array(F.collect_set("class")).alias("classes"))


def confusion_matrix(df: DataFrame, labels: Sequence | None = None, by: Sequence[str] = ()) -> DataFrame:
    """Long matrix ``(y_true, y_pred, n, rate)`` with zero cells; rates per true class."""
    counts = confusion_counts(df, by)
    classes = _classes(counts, by)
    if labels is not None:
        classes = classes.withColumn("classes", F.array(*[F.lit(x) for x in labels]))
    cells = classes.select(*by, F.explode("classes").alias("y_true"), "classes").select(
        *by, "y_true", F.explode("classes").alias("y_pred")
    )
    filled = cells.join(counts, [*by, "y_true", "y_pred"], "left").withColumn("n", F.coalesce("n", F.lit(0)))
    support = F.sum("n").over(W.partitionBy(*by, "y_true"))
    rate = F.when(support > 0, F.col("n") / support).otherwise(0.0)
    return filled.withColumn("rate", rate)


def accuracy(df: DataFrame, by: Sequence[str] = ()) -> DataFrame:
    hit = F.when(F.col("y_true") == F.col("y_pred"), 1.0).otherwise(0.0)
    return df.groupBy(*by).agg(F.avg(hit).alias("accuracy"))


def _ratio(part: Column, whole: Column) -> Column:
    return F.when(whole > 0, part / whole).otherwise(F.lit(0.0))


def class_metrics(df: DataFrame, by: Sequence[str] = ()) -> DataFrame:
    """Precision, recall, F1 and support per class of true or predicted labels;
    zero where undefined. True and predicted marginals come from one grouping."""
    counts = confusion_counts(df, by)
    zero = F.lit(0).cast("long")
    hit = F.when(F.col("y_true") == F.col("y_pred"), F.col("n")).otherwise(zero)
    sides = F.inline(
        F.array(
            F.struct(F.col("y_true").alias("class"), F.col("n").alias("t"), zero.alias("p"), hit.alias("h")),
            F.struct(F.col("y_pred").alias("class"), zero.alias("t"), F.col("n").alias("p"), zero.alias("h")),
        )
    )
    sums = counts.select(*by, sides).groupBy(*by, "class").agg(
        F.sum("t").alias("support"), F.sum("p").alias("predicted"), F.sum("h").alias("hits")
    )
    return sums.select(
        *by,
        "class",
        _ratio(F.col("hits"), F.col("predicted")).alias("precision"),
        _ratio(F.col("hits"), F.col("support")).alias("recall"),
        _ratio(F.col("hits") * 2, F.col("support") + F.col("predicted")).alias("f1"),
        "support",
        "hits",
    )


def averages(metrics: DataFrame, by: Sequence[str] = ()) -> DataFrame:
    """Macro and support-weighted averages with accuracy, one row per ``by``."""

    def weighted(name: str) -> Column:
        return _ratio(F.sum(F.col(name) * F.col("support")), F.sum("support"))

    return metrics.groupBy(*by).agg(
        _ratio(F.sum("hits"), F.sum("support")).alias("accuracy"),
        F.avg("precision").alias("precision_macro"),
        weighted("precision").alias("precision_weighted"),
        F.avg("recall").alias("recall_macro"),
        weighted("recall").alias("recall_weighted"),
        F.avg("f1").alias("f1_macro"),
        weighted("f1").alias("f1_weighted"),
        F.sum("support").alias("num_test_samples"),
    )


def classification_report(df: DataFrame, by: Sequence[str] = ()) -> DataFrame:
    """Class rows, then accuracy, macro avg and weighted avg. The accuracy row
    repeats the accuracy in every column."""
    metrics = class_metrics(df, by)
    rows = metrics.select(
        *by,
        F.col("class").cast("string").alias("class"),
        "precision",
        "recall",
        "f1",
        F.col("support").cast("double").alias("support"),
    )
    support = F.col("num_test_samples").cast("double")

    def row(label: str, *names: str) -> Column:
        precision, recall, f1 = (F.col(n) for n in names)
        last = F.col("accuracy") if label == "accuracy" else support
        return F.struct(
            F.lit(label).alias("class"), precision.alias("precision"), recall.alias("recall"),
            f1.alias("f1"), last.alias("support"),
        )

    summary = averages(metrics, by).select(
        *by,
        F.inline(
            F.array(
                row("accuracy", "accuracy", "accuracy", "accuracy"),
                row("macro avg", "precision_macro", "recall_macro", "f1_macro"),
                row("weighted avg", "precision_weighted", "recall_weighted", "f1_weighted"),
            )
        ),
    )
    return rows.unionByName(summary)


def model_metrics(df: DataFrame, by: Sequence[str] = ("model",)) -> DataFrame:
    """Seven scores and the number of test rows per model."""
    return averages(class_metrics(df, by), by)


def with_latency(metrics: DataFrame, seconds: Column) -> DataFrame:
    """Total and per-document times next to the scores."""
    n = F.col("num_test_samples")
    return metrics.withColumn("total_inference_time_sec", seconds).withColumn(
        "avg_latency_ms_per_doc", F.when(n > 0, seconds / n * 1000.0).otherwise(0.0)
    )


def top_confusions(df: DataFrame, k: int = 5) -> DataFrame:
    counts = confusion_counts(misclassified(df))
    return counts.orderBy(F.desc("n"), "y_true", "y_pred").limit(k)


def misclassified_examples(df: DataFrame, row_id: str, text: str, n: int = 3, length: int = 200) -> DataFrame:
    """The first wrong rows with a masked preview; only these rows are masked."""
    first = misclassified(df).orderBy(row_id).limit(n)
    shown = F.concat(T.mask_pii(F.substring(text, 1, length)), F.lit("..."))
    return first.select(row_id, "y_true", "y_pred", shown.alias("example"))


def cv_summary(scores: DataFrame, value: str, by: Sequence[str] = ()) -> DataFrame:
    return scores.groupBy(*by).agg(
        F.avg(value).alias("cv_mean"), F.stddev_pop(value).alias("cv_std")
    )


def best_and_worst(metrics: DataFrame, name: str = "model", value: str = "f1_macro") -> DataFrame:
    """Best and worst row by one metric and the gap; the first name wins a tie."""
    best = F.min_by(name, F.struct(-F.col(value), F.col(name)))
    worst = F.min_by(name, F.struct(F.col(value), F.col(name)))
    return metrics.agg(
        best.alias("best"), worst.alias("worst"), (F.max(value) - F.min(value)).alias("gap")
    )


def best_model(metrics: DataFrame, *criteria: tuple[str, bool], name: str = "model") -> DataFrame:
    """The first row by ordered criteria ``(column, descending)``, then by name."""
    order = [F.desc(c) if down else F.asc(c) for c, down in criteria]
    return metrics.orderBy(*order, F.asc(name)).limit(1)


def epoch_log(log: DataFrame, epoch: str, order: Column, **metrics: str) -> DataFrame:
    """Sparse training-log rows to one row per epoch: the first value of each
    metric in log order. ``metrics`` maps output to input columns."""

    def first(column: str) -> Column:
        return F.min_by(F.when(F.col(column).isNotNull(), F.col(column)), F.when(F.col(column).isNotNull(), order))

    return log.groupBy(epoch).agg(*[first(c).alias(out) for out, c in metrics.items()])


def overfitting_gap(epochs: DataFrame, epoch: str, train: str, validation: str) -> DataFrame:
    """Last validation loss minus last training loss; zero when a loss is missing."""
    last = epochs.agg(
        F.max_by(train, epoch).alias("train_loss"),
        F.max_by(validation, epoch).alias("validation_loss"),
        F.count_if(F.col(train).isNull() | F.col(validation).isNull()).alias("gaps"),
    )
    gap = F.when(F.col("gaps") == 0, F.col("validation_loss") - F.col("train_loss")).otherwise(0.0)
    return last.select("train_loss", "validation_loss", gap.alias("loss_gap"))


def one_vs_rest(df: DataFrame, classes: Sequence, by: Sequence[str] = ()) -> DataFrame:
    """``(class, score, pos, neg)`` counts per distinct score, unrounded."""
    names = F.array(*[F.lit(c) for c in classes])
    long = df.select(*by, "y_true", F.posexplode("scores").alias("i", "score")).select(
        *by, F.get(names, "i").alias("class"), "score", "y_true"
    )
    hit = F.col("y_true") == F.col("class")
    return long.groupBy(*by, "class", "score").agg(
        F.count_if(hit).alias("pos"), F.count_if(~hit).alias("neg")
    )


def _score_range(score: Column) -> Column:
    """A range number that never falls as the score rises: steps of the logarithm of
    the distance from 0 or 1, where confidences crowd. There are under 60,000."""
    low = F.floor(F.log(score) * SCORE_STEPS)
    high = F.ceil(F.log(1 - score) * -SCORE_STEPS)
    end = F.lit(LAST_RANGE)
    inner = F.when(score < 0.5, low).otherwise(high)
    return F.when(score <= 0, -end).when(score >= 1, end).otherwise(F.coalesce(inner, -end - 1)).cast("int")


def _accumulated(df: DataFrame, classes: Sequence, by: Sequence[str]) -> DataFrame:
    """Score counts with ``up_*``, the counts at this or a higher score, and ``all_*``.

    Only the totals of the score ranges meet per class; scores are sorted within
    their range.
    """
    keys = [*by, "class", "range"]
    counts = one_vs_rest(df, classes, by).withColumn("range", _score_range(F.col("score")))
    whole = W.partitionBy(*by, "class")
    higher = whole.orderBy(F.desc("range")).rowsBetween(W.unboundedPreceding, -1)
    sums = counts.groupBy(*keys).agg(F.sum("pos").alias("pos"), F.sum("neg").alias("neg"))
    totals = sums.select(
        *keys,
        *[F.coalesce(F.sum(n).over(higher), F.lit(0)).alias(f"higher_{n}") for n in ("pos", "neg")],
        *[F.sum(n).over(whole).alias(f"all_{n}") for n in ("pos", "neg")],
    )
    within = W.partitionBy(*keys).orderBy(F.desc("score")).rowsBetween(W.unboundedPreceding, 0)
    rows = counts.join(totals, keys)
    for n in ("pos", "neg"):
        rows = rows.withColumn(f"up_{n}", F.col(f"higher_{n}") + F.sum(n).over(within))
    return rows


def roc_points(df: DataFrame, classes: Sequence, by: Sequence[str] = ()) -> DataFrame:
    """ROC points per class, one for each distinct score."""
    rows = _accumulated(df, classes, by)
    fpr, tpr = (_ratio(F.col(f"up_{n}"), F.col(f"all_{n}")) for n in ("neg", "pos"))
    return rows.select(*by, "class", "score", fpr.alias("fpr"), tpr.alias("tpr"))


def roc_auc(df: DataFrame, classes: Sequence, by: Sequence[str] = ()) -> DataFrame:
    """Area per class by trapezoids; zero where a class or its rest has no row."""
    rows = _accumulated(df, classes, by)
    width = _ratio(F.col("neg"), F.col("all_neg"))
    height = _ratio(F.col("up_pos") * 2 - F.col("pos"), F.col("all_pos") * 2)
    return rows.select(*by, "class", (width * height).alias("a")).groupBy(*by, "class").agg(F.sum("a").alias("auc"))


def macro_auc(df: DataFrame, classes: Sequence, by: Sequence[str] = ()) -> DataFrame:
    return roc_auc(df, classes, by).groupBy(*by).agg(F.avg("auc").alias("macro_auc"))


def align(first: DataFrame, second: DataFrame, row_id: str, truth: str = "y_true") -> DataFrame:
    """Two models' predictions per document with an agreement flag."""
    a = first.select(row_id, truth, F.col("y_pred").alias("pred_a"))
    b = second.select(row_id, F.col("y_pred").alias("pred_b"))
    return a.join(b, row_id).withColumn("agreement", F.col("pred_a").eqNullSafe(F.col("pred_b")))


def agreement_rate(aligned: DataFrame) -> DataFrame:
    return aligned.agg(
        F.count(F.lit(1)).alias("n"),
        F.avg(F.when(F.col("agreement"), 1.0).otherwise(0.0)).alias("agreement_rate"),
    )


def _upper_normal(z: Column) -> Column:
    """Twice the upper normal tail of ``z >= 0`` (rational form, error < 1.5e-7).

    Fixed values: coefficients of Abramowitz and Stegun 7.1.26.
    """
    x = z / F.sqrt(F.lit(2.0))
    t = F.lit(1.0) / (F.lit(1.0) + F.lit(0.3275911) * x)
    series = F.lit(0.0)
    for c in (1.061405429, -1.453152027, 1.421413741, -0.284496736, 0.254829592):
        series = (series + F.lit(c)) * t
    return series * F.exp(-x * x)


def _log_factorial(x: Column) -> Column:
    """Logarithm of ``x!`` by Stirling's series, ten places further on."""
    z = x.cast("double") + 11.0
    series = F.lit(1 / 12) / z - F.lit(1 / 360) / F.pow(z, F.lit(3.0)) + F.lit(1 / 1260) / F.pow(z, F.lit(5.0))
    far = (z - 0.5) * F.log(z) - z + F.lit(0.5 * math.log(2 * math.pi)) + series
    for j in range(1, 11):
        far = far - F.log(x.cast("double") + float(j))
    return far


def _exact_p(b: Column, c: Column) -> Column:
    """Two-sided binomial test: terms from the smaller count downwards, largest first.

    Terms further than twelve roots of ``n`` away are below any double's precision,
    so the sum is exact while its length grows with the root of the pairs only.
    """
    n, low = b + c, F.least(b, c)
    largest = _log_factorial(n) - _log_factorial(low) - _log_factorial(n - low) - n * math.log(2.0)
    start = F.struct(largest.alias("term"), F.lit(0.0).alias("sum"))
    steps = F.least(low, F.ceil(F.sqrt(n.cast("double")) * 12 + 60).cast("long"))

    def step(acc: Column, i: Column) -> Column:
        ratio = (low - i).cast("double") / (n - low + i + 1).cast("double")
        nxt = F.when(ratio > 0, acc["term"] + F.log(ratio)).otherwise(acc["term"])
        return F.struct(nxt.alias("term"), (acc["sum"] + F.exp(acc["term"])).alias("sum"))

    tail = F.aggregate(F.sequence(F.lit(0).cast("long"), steps), start, step, lambda acc: acc["sum"])
    return F.least(F.lit(1.0), tail * 2)


def mcnemar(aligned: DataFrame, truth: str = "y_true", method: str = "exact") -> DataFrame:
    """Discordant pairs, continuity-corrected statistic and p-value.

    ``method`` is ``exact`` (binomial) or ``normal``, at every number of pairs.
    """
    if method not in ("exact", "normal"):
        raise ValueError(f"method is exact or normal, not {method}")
    right_a, right_b = F.col("pred_a") == F.col(truth), F.col("pred_b") == F.col(truth)
    pairs = aligned.agg(
        F.count_if(right_a & ~right_b).alias("b"), F.count_if(~right_a & right_b).alias("c")
    )
    b, c = F.col("b"), F.col("c")
    n = b + c
    edge = F.greatest(F.abs(b - c) - 1, F.lit(0)).cast("double")
    statistic = F.when(n > 0, edge * edge / n).otherwise(0.0)
    found = _exact_p(b, c) if method == "exact" else _upper_normal(F.sqrt(statistic))
    return pairs.select("b", "c", statistic.alias("statistic"), F.when(n == 0, 1.0).otherwise(found).alias("p_value"))


def f1_difference(first: DataFrame, second: DataFrame) -> DataFrame:
    """Second minus first F1 per class; a class missing on one side counts as 0."""
    a = first.select("class", F.col("f1").alias("f1_a"))
    b = second.select("class", F.col("f1").alias("f1_b"))
    zero = F.lit(0.0)
    return a.join(b, "class", "full").select(
        "class", (F.coalesce("f1_b", zero) - F.coalesce("f1_a", zero)).alias("f1_difference")
    )


def compare_reports(baseline: DataFrame, candidate: DataFrame, latency: str = "latency_ms") -> DataFrame:
    """Two one-row reports side by side: deltas and latency ratio (floor 0.001)."""
    names = ["model", "accuracy", "f1_macro", latency]
    whole = baseline.agg(F.max(F.struct(*names))).scalar()
    row = candidate.select(*names).withColumn("base", whole)
    base = F.col("base")
    return row.select(
        base["model"].alias("baseline"),
        F.col("model").alias("candidate"),
        (F.col("accuracy") - base["accuracy"]).alias("accuracy_delta"),
        (F.col("f1_macro") - base["f1_macro"]).alias("f1_delta"),
        (F.col(latency) / F.greatest(F.coalesce(base[latency], F.lit(0.01)), F.lit(0.001))).alias("latency_ratio"),
    )
