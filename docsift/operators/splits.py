"""Exact stratified splits that never put one class into one task.

Rows are ordered inside a class by ``md5(seed:id)``. The first hex digits of the
hash cut each class into even buckets. Bucket counts and their running sums are
small; ranking is needed only inside a bucket.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from docsift.operators.labels import per_class
from docsift.sources.store import materialize

BUCKET_DIGITS = 3


def hash_order(row_id: str, seed: int) -> Column:
    return F.md5(F.concat(F.lit(f"{seed}:"), F.col(row_id).cast("string")))


def _keyed(df: DataFrame, row_id: str, category: str, seed: int) -> DataFrame:
    h = hash_order(row_id, seed)
    return df.select(
        F.col(category).alias("c"),
        F.col(row_id).alias("id"),
        h.alias("h"),
        F.substring(h, 1, BUCKET_DIGITS).alias("bucket"),
    ).dropna(subset=["c"])


def _running_counts(keyed: DataFrame) -> DataFrame:
    """Per class and bucket: rows, rows in earlier buckets, rows of the class."""
    counts = keyed.groupBy("c", "bucket").agg(F.count(F.lit(1)).alias("n"))
    by_class = W.partitionBy("c")
    before = by_class.orderBy("bucket").rowsBetween(W.unboundedPreceding, -1)
    return counts.select(
        "c",
        "bucket",
        "n",
        F.coalesce(F.sum("n").over(before), F.lit(0)).alias("before"),
        F.sum("n").over(by_class).alias("class_rows"),
    )


def stratified_cutoffs(
    df: DataFrame, row_id: str, category: str, test_share: float = 0.2, seed: int = 42, mark=None
) -> DataFrame:
    """``(c, cut)``: the last test row of every class in hash order."""
    keyed = _keyed(df, row_id, category, seed)
    wanted = F.round(F.col("class_rows") * F.lit(test_share)).cast("long")
    edge = (
        _running_counts(keyed)
        .withColumn("wanted", wanted)
        .filter((F.col("before") < F.col("wanted")) & (F.col("wanted") <= F.col("before") + F.col("n")))
        .select("c", "bucket", (F.col("wanted") - F.col("before")).alias("place"))
    )
    inside = W.partitionBy("c").orderBy("h", "id")
    mark = mark or per_class(keyed, "c")
    return (
        keyed.join(mark(edge), ["c", "bucket"])
        .withColumn("place_here", F.row_number().over(inside))
        .filter(F.col("place_here") == F.col("place"))
        .select("c", F.struct("h", "id").alias("cut"))
    )


def stratified_split(
    df: DataFrame, row_id: str, category: str, test_share: float = 0.2, seed: int = 42
) -> DataFrame:
    """Add ``is_test``; every class gives ``round(share * rows)`` test rows.

    The cut-offs hold one row per class, so rows are assigned without a shuffle.
    """
    mark = per_class(df, category)
    cutoffs = stratified_cutoffs(df, row_id, category, test_share, seed, mark)
    cutoffs = cutoffs.select(F.col("c").alias("__class"), F.col("cut").alias("__cut"))
    here = F.struct(hash_order(row_id, seed).alias("h"), F.col(row_id).alias("id"))
    joined = df.join(mark(cutoffs), F.col(category) == F.col("__class"), "left")
    is_test = F.coalesce(here <= F.col("__cut"), F.lit(False))
    return joined.withColumn("is_test", is_test).drop("__class", "__cut")


def stratified_folds(
    df: DataFrame, row_id: str, category: str, folds: int = 5, seed: int = 42
) -> DataFrame:
    """``(row_id, category, fold)`` with fold sizes per class differing by at most one."""
    keyed = _keyed(df, row_id, category, seed)
    before = _running_counts(keyed).select("c", "bucket", "before")
    inside = W.partitionBy("c", "bucket").orderBy("h", "id")
    ranked = keyed.withColumn("place", F.row_number().over(inside)).join(before, ["c", "bucket"])
    fold = F.pmod(F.col("before") + F.col("place") - 1, F.lit(folds)).cast("int")
    return ranked.select(F.col("id").alias(row_id), F.col("c").alias(category), fold.alias("fold"))


def hashed_folds(df: DataFrame, row_id: str, folds: int = 5, seed: int = 42) -> DataFrame:
    """Approximate folds without any shuffle."""
    return df.withColumn("fold", F.pmod(F.xxhash64(F.lit(seed), row_id), F.lit(folds)).cast("int"))


def split_table(
    df: DataFrame, row_id: str, category: str, test_share: float = 0.2, folds: int = 5, seed: int = 42
) -> DataFrame:
    """``(row_id, is_test, fold)`` to be written once and reused by every model.

    The rows of ``stratified_split`` and ``stratified_folds`` from one ranking: a row's
    place in its class is the rows in earlier buckets plus its rank in its own. Keys are
    written without text, so ``df`` is read once. Ids are unique; rows without a category
    are in no part.
    """
    keyed = materialize(_keyed(df.select(row_id, category), row_id, category, seed), "split-keys")
    counts = _running_counts(keyed).drop("n")
    inside = W.partitionBy("c", "bucket").orderBy("h", "id")
    rank = keyed.withColumn("rank", F.row_number().over(inside)).join(counts, ["c", "bucket"])
    place = F.col("before") + F.col("rank")
    is_test = place <= F.round(F.col("class_rows") * F.lit(test_share)).cast("long")
    fold = F.pmod(place - 1, F.lit(folds)).cast("int")
    return rank.select(F.col("id").alias(row_id), is_test.alias("is_test"), fold.alias("fold"))


def take_test(df: DataFrame, split: DataFrame, row_id: str) -> DataFrame:
    return df.join(split.filter("is_test").select(row_id), row_id, "left_semi")


def take_train(df: DataFrame, split: DataFrame, row_id: str) -> DataFrame:
    """Everything that is not in the saved test set."""
    return df.join(split.filter("is_test").select(row_id), row_id, "left_anti")


def attach_split(df: DataFrame, split: DataFrame, row_id: str) -> DataFrame:
    return df.join(split, row_id)
