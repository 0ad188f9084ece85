"""Mixing sources to target weights, with DataFrame functions only.

Every source gets a target: its weight's share of the budget, but at most a
multiple of its size; what it cannot take goes to the others by weight. A target
is met by complete passes over the source and then by a weighted sample without
replacement: each document has the key ``-ln(u) / w`` (Efraimidis and Spirakis),
``u`` from a hash of its id and ``w`` its quality weight; documents are taken in
key order while the middle of the next one lies within what is left.

Defined results: null text has size 0, null source is a source of its own that
orders last, null or missing quality weighs 1 and weights of 0 or less come last.
Rows equal in id, source and size are taken or left together. A source of size 0
has target 0. An empty table gives an empty mix.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from docsift.llm.common import free_name, group_key, n_words, repeat_rows, running_totals
from docsift.sources.store import materialize

WEIGHTS = (3, 1, 2)
SHARE = 1.5
CAP = 2.0
SEED = 7
DIGITS = 13


def label_weights(labels: DataFrame, label: str = "quality", id_col: str = "doc_id") -> DataFrame:
    """``(doc_id, weight)``: 2 for good documents, 0.5 for bad ones, between for contradicting labels."""
    known = labels.filter(F.col(id_col).isNotNull() & F.col(label).isNotNull())
    weight = (F.avg(F.col(label).cast("double")) * 1.5 + 0.5).alias("weight")
    return known.groupBy(F.col(id_col).alias("doc_id")).agg(weight)


def uniform(doc_id: str, seed: int = SEED) -> Column:
    """A number strictly between 0 and 1 that depends on the id and the seed only."""
    name = F.coalesce(F.col(doc_id).cast("string"), F.lit(""))
    digits = F.substring(F.md5(F.concat(F.lit(f"{seed}:"), name)), 1, DIGITS)
    return (F.conv(digits, 16, 10).cast("double") + 0.5) / float(16**DIGITS)


def targets(sources: DataFrame, weights: Sequence[int], share: float, cap: float) -> DataFrame:
    """``(source_key, source_size, target)`` from ``(source_key, source_size)``.

    With ``t`` a common level, a source takes ``min(cap * size, t * weight)``; the
    level that spends the budget is the largest of those that result when the
    first 0, 1, 2, ... sources in order of ``cap * size / weight`` are full.
    """
    placed = running_totals(sources.withColumn("one", F.lit(1).cast("long")), ["one"], ["source_key"])
    turn = F.pmod(F.col("before_one"), F.lit(len(weights))).cast("int") + 1
    weight = F.element_at(F.array(*[F.lit(w) for w in weights]), turn).cast("long")
    weighted = placed.select("source_key", "source_size", weight.alias("weight"))
    weighted = materialize(weighted.withColumn("room", F.col("source_size") * cap / F.col("weight")), "weights")
    filled = running_totals(weighted, ["source_size", "weight"], ["room", "source_key"])
    left = F.col("all_source_size") * share - F.col("before_source_size") * cap
    level = filled.agg(F.max(left / (F.col("all_weight") - F.col("before_weight")))).first()[0] or 0.0
    target = F.least(F.col("source_size") * cap, F.col("weight") * F.lit(level))
    return weighted.select("source_key", "source_size", target.alias("target"))


def plan_mix(
    documents: DataFrame,
    quality: DataFrame | None = None,
    weights: Sequence[int] = WEIGHTS,
    share: float = SHARE,
    cap: float = CAP,
    seed: int = SEED,
    id_col: str = "doc_id",
    text_col: str = "text",
    source_col: str = "source",
) -> DataFrame:
    """``(doc_id, source_key, size, n_rows, source_size, target, copies, taken)``.

    One row for equal ``(doc_id, source, size)``; ``copies`` is how often the mix
    takes each such document and ``taken`` the words it takes of one.
    """
    keys = ["doc_id", "source_key", "size"]
    units = documents.select(
        F.col(id_col).alias("doc_id"), group_key(source_col).alias("source_key"), n_words(text_col).alias("size")
    )
    units = units.groupBy(*keys).agg(F.count(F.lit(1)).alias("n_rows"))
    if quality is not None:
        units = units.join(quality.select("doc_id", "weight"), "doc_id", "left")
    weight = F.coalesce(F.col("weight"), F.lit(1.0)) if quality is not None else F.lit(1.0)
    last = F.lit(float("inf"))
    key = F.when(weight > 0, -F.log(uniform("doc_id", seed)) / weight).otherwise(last)
    mass = (F.col("size") * F.col("n_rows")).alias("mass")
    units = materialize(units.select(*keys, "n_rows", key.alias("key"), mass), "units")
    sources = units.groupBy("source_key").agg(F.sum("mass").alias("source_size"))
    size, target = F.col("source_size"), F.col("target")
    epochs = F.when(size > 0, F.floor(target / size)).otherwise(F.lit(0)).cast("long")
    plan = targets(sources, weights, share, cap).withColumn("epochs", epochs)
    plan = materialize(plan.withColumn("left", target - F.col("epochs") * size), "plan")
    order = ["key", "doc_id", "size"]
    placed = running_totals(units, ["mass"], order, ["source_key"], plan)
    partly = (F.col("left") > 0) & (F.col("before_mass") + F.col("mass") / 2 <= F.col("left"))
    copies = F.col("epochs") + partly.cast("long")
    return placed.select(
        *keys, "n_rows", "source_size", "target", copies.alias("copies"), (copies * F.col("size")).alias("taken")
    )


def mixed_documents(
    documents: DataFrame,
    plan: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    source_col: str = "source",
) -> DataFrame:
    """The documents of the mix with all their columns, each as often as it is taken."""
    names = {c: free_name(documents.columns, f"mix_{c}") for c in ("id", "source", "size", "copies")}
    mine = {c: free_name(documents.columns, f"own_{c}") for c in ("source", "size")}
    taken = plan.filter("copies > 0").select(
        F.col("doc_id").alias(names["id"]),
        F.col("source_key").alias(names["source"]),
        F.col("size").alias(names["size"]),
        F.col("copies").alias(names["copies"]),
    )
    rows = documents.withColumns({mine["source"]: group_key(source_col), mine["size"]: n_words(text_col)})
    same = (
        F.col(id_col).eqNullSafe(F.col(names["id"]))
        & (F.col(mine["source"]) == F.col(names["source"]))
        & (F.col(mine["size"]) == F.col(names["size"]))
    )
    return repeat_rows(rows.join(taken, same), F.col(names["copies"])).select(*documents.columns)


def mix(documents: DataFrame, quality: DataFrame | None = None, **options) -> DataFrame:
    """One row per document: ``doc_id, size, source_size, target, taken``; options as in :func:`plan_mix`."""
    rows = repeat_rows(plan_mix(documents, quality, **options), F.col("n_rows"))
    return rows.select("doc_id", "size", "source_size", "target", "taken")
