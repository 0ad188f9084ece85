"""Training-data pipeline: documents to token ids, in five stages written one after the other.

Each stage takes ``(spark, docs, sf_dir)``, works on all documents its predecessor
kept and returns a DataFrame, which is written as Parquet and read again as the
next stage's ``docs``. All but the last return the columns of ``docs``.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from docsift.llm import bpe, linking, mixing, neardup, quality, rules
from docsift.llm.common import read
from docsift.llm.queries import vocabulary_path
from docsift.sources.store import materialize


def quality_classifier(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the compression classifier accepts."""
    model = quality.fit_quality(read(spark, sf_dir, "documents"), read(spark, sf_dir, "labels"))
    return quality.keep_quality(docs, model)


def quality_rules(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that pass the base rule and are mostly content.

    The line field is trained on all labelled documents, not on those that the
    classifier left, among which hardly a bad one remains to learn from.
    """
    field = rules.fit_rules(read(spark, sf_dir, "documents"), read(spark, sf_dir, "labels"))
    return rules.keep_by_rules(docs, field)


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The document with the smallest id of every class of near-duplicates."""
    return linking.keep_first(docs, neardup.near_duplicates(docs))


def mixed_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The documents of the mix, each as often as it is taken."""
    plan = mixing.plan_mix(docs, mixing.label_weights(read(spark, sf_dir, "labels")))
    return mixing.mixed_documents(docs, plan)


def token_ids(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Number of tokens and digests of ids and decoded text of every document."""
    return bpe.encode_texts(docs, bpe.load_vocabulary(vocabulary_path()), digests=True)


STAGES = [
    ("quality classifier", quality_classifier),
    ("quality rules", quality_rules),
    ("near duplicates", near_duplicates),
    ("mixing", mixed_sources),
    ("tokens", token_ids),
]

#: Compression, Viterbi decoding, signatures and BPE have no SQL form; the tests use brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``; every result is written to the shared work folder."""
    docs = read(spark, sf_dir, "documents")
    for name, stage in STAGES:
        docs = materialize(stage(spark, docs, sf_dir), f"pipeline-{name.replace(' ', '-')}")
    return docs
