"""Score and embedding arrays: softmax, argmax, top candidates, norms, pooling."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from docsift.functions.arrays import bind


def array_sum(values: Column) -> Column:
    return F.aggregate(values, F.lit(0.0), lambda a, x: a + x.cast("double"))


def dot(a: Column, b: Column) -> Column:
    return array_sum(F.zip_with(a, b, lambda x, y: x.cast("double") * y.cast("double")))


def softmax(values: Column) -> Column:
    """Shifted by the maximum, so large margins do not overflow."""

    def shares(v: Column) -> Column:
        top = F.array_max(v)
        powers = bind(top, lambda m: F.transform(v, lambda x: F.exp(x - m)))
        return bind(powers, lambda p: bind(array_sum(p), lambda s: F.transform(p, lambda x: x / s)))

    return bind(values, shares)


def margin_confidence(margins: Column) -> Column:
    """Class margins to confidences: z-scores (population deviation + 1e-6) times
    two through softmax; one margin means two classes at -4 and +4 times it."""

    def many(v: Column) -> Column:
        n = F.size(v).cast("double")

        def scaled(mean: Column) -> Column:
            spread = F.sqrt(array_sum(F.transform(v, lambda x: (x - mean) * (x - mean))) / n)
            return bind(
                spread + F.lit(1e-6),
                lambda d: softmax(F.transform(v, lambda x: (x - mean) / d * F.lit(2.0))),
            )

        return bind(array_sum(v) / n, scaled)

    def one(v: Column) -> Column:
        return softmax(F.array(v[0] * F.lit(-4.0), v[0] * F.lit(4.0)))

    return bind(margins, lambda v: F.when(F.size(v) == 1, one(v)).otherwise(many(v)))


def one_hot(index: Column, classes: int) -> Column:
    places = F.sequence(F.lit(0), F.lit(classes - 1))
    return F.transform(places, lambda i: F.when(i == index, F.lit(1.0)).otherwise(F.lit(0.0)))


def argmax(values: Column) -> Column:
    """Index of the largest value; the lowest index wins a tie."""
    return bind(values, lambda v: (F.array_position(v, F.array_max(v)) - 1).cast("int"))


def top_candidates(scores: Column, classes: Column, k: int = 3) -> Column:
    """``array<struct<category, confidence>>``, best first, ties by class index."""
    ranked = F.sort_array(
        F.transform(
            scores,
            lambda s, i: F.struct((-s).alias("down"), i.alias("i"), s.alias("confidence")),
        )
    )
    return F.transform(
        F.slice(ranked, 1, k),
        lambda e: F.struct(
            F.get(classes, e["i"]).alias("category"), F.round(e["confidence"], 4).alias("confidence")
        ),
    )


def l2_norm(vector: Column) -> Column:
    return F.sqrt(dot(vector, vector))


def l2_normalize(vector: Column, floor: float = 1e-12) -> Column:
    return bind(
        vector,
        lambda v: bind(
            F.greatest(l2_norm(v), F.lit(floor)),
            lambda n: F.transform(v, lambda x: x.cast("double") / n),
        ),
    )


def mean_pool(tokens: DataFrame, row_id: str, vector: str = "vec", mask: str = "mask", floor: float = 1e-9) -> DataFrame:
    """Masked mean of token vectors: rows ``(row_id, token, mask, vec)`` to
    ``(row_id, pooled)``. Dimensions are summed map-side before the shuffle."""
    places = tokens.select(row_id, F.col(mask).cast("double").alias("m"), F.posexplode(vector).alias("i", "x"))
    sums = places.groupBy(row_id, "i").agg(
        (F.sum(F.col("x") * F.col("m")) / F.greatest(F.sum("m"), F.lit(floor))).alias("x")
    )
    ordered = F.sort_array(F.collect_list(F.struct("i", "x")))
    return sums.groupBy(row_id).agg(F.transform(ordered, lambda e: e["x"]).alias("pooled"))
