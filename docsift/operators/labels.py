"""Category dimensions: encode, decode, set differences."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from docsift.sources.store import broadcast_within, within

#: Classes that a class list or a broadcast dimension may have unless the caller says otherwise.
MAX_CLASSES = 1_000


def class_names(df: DataFrame, category: str, most: int | None = None) -> list:
    """Distinct classes in order, as the fixed class list of a model; more than ``most`` are refused."""
    most = MAX_CLASSES if most is None else most
    rows = df.select(category).dropna().distinct().limit(most + 1).collect()
    if len(rows) > most:
        raise ValueError(f"{category} has more than {most} classes; allow more if it is a class label")
    return sorted(r[0] for r in rows)


def per_class(df: DataFrame, category: str, most: int | None = None) -> Callable[[DataFrame], DataFrame]:
    """How to mark a table with one row per class for a join: broadcast when the
    column really has few classes (checked by a scan of that column), else not at all."""
    few = within(df.select(category).distinct(), MAX_CLASSES if most is None else most)
    return F.broadcast if few else lambda table: table


def label_dimension(df: DataFrame, category: str) -> DataFrame:
    """``(category, label_index)`` with alphabetical indices. A class label has few
    values, so its one ordered window holds few rows."""
    names = df.select(category).dropna().distinct()
    order = W.partitionBy(F.lit(0)).orderBy(category)
    return names.withColumn("label_index", F.row_number().over(order) - 1)


def encode(df: DataFrame, labels: DataFrame, category: str) -> DataFrame:
    return df.join(broadcast_within(labels, MAX_CLASSES), category, "left")


def decode(df: DataFrame, labels: DataFrame, category: str) -> DataFrame:
    dimension = broadcast_within(labels.select("label_index", category), MAX_CLASSES)
    return df.join(dimension, "label_index", "left")


def missing_categories(catalogue: DataFrame, corpus: DataFrame, category: str) -> DataFrame:
    """Catalogue categories without a corpus row (left anti join)."""
    return catalogue.select(category).distinct().join(
        corpus.select(category).distinct(), category, "left_anti"
    )


def category_difference(catalogue: DataFrame, corpus: DataFrame, category: str) -> DataFrame:
    """The same as a set difference."""
    return catalogue.select(category).subtract(corpus.select(category))


def append_rows(first: DataFrame, *others: DataFrame) -> DataFrame:
    for other in others:
        first = first.unionByName(other)
    return first


def with_labels(documents: DataFrame, labels: DataFrame, row_id: str = "doc_id") -> DataFrame:
    return documents.join(labels, row_id)
