"""Batch dual scoring: two models per document with keywords and agreement."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from docsift.functions import text as T
from docsift.functions import vectors as V
from docsift.functions.arrays import settle, top_terms
from docsift.functions.validate import filename_or_default, validate
from docsift.operators import classify as C
from docsift.operators import features as X
from docsift.operators import lemmas as LM
from docsift.sources.store import materialize

# Keyword counts, preview length and candidate count.
KEYWORDS = 12
HISTORY_KEYWORDS = 5
PREVIEW = 350
CANDIDATES = 3


def checked_inputs(documents: DataFrame, lemmas: bool = False, lexicon: DataFrame | None = None) -> DataFrame:
    """``(doc_id, filename, text)`` cleaned once and checked, ready to be written.

    The written columns are narrow: the full text goes no further than here.
    ``lemmas`` puts noun lemmas into the tokens, as ``corpus.prepare`` does; give
    the lexicon that the model's corpus had, else the documents' own tokens are it.
    """
    raw, text = F.col("text"), F.col("stripped")
    cleaned = settle(documents, stripped=T.strip_blanks(F.coalesce(raw, F.lit(""))), tokens=T.clean_tokens(raw))
    if lemmas:
        cleaned = LM.lemmatize(materialize(cleaned, "inputs"), "doc_id", lexicon=lexicon)
    checked = validate(cleaned, "text", "tokens", "filename")
    tokens = F.col("tokens")
    return checked.select(
        "doc_id",
        filename_or_default(F.col("filename")).alias("filename"),
        "status",
        "reason",
        F.length(text).alias("text_length_chars"),
        T.word_count(text).alias("word_count_raw"),
        F.size(tokens).alias("word_count_clean"),
        top_terms(tokens, KEYWORDS).alias("keywords"),
        T.preview(text, PREVIEW).alias("text_preview"),
        F.array_join(tokens, " ").alias("clean"),
    )


def model_result(name: str, kind: str, classes: list, scores: Column, y_pred: Column) -> Column:
    """The result struct of one model; null when it has no scores."""
    best = F.array_max(scores)
    result = F.struct(
        F.lit(name).alias("model_name"),
        F.lit(kind).alias("model_type"),
        y_pred.cast("string").alias("category"),
        F.round(best, 4).alias("confidence"),
        T.percent_text(best).alias("confidence_percentage"),
        V.top_candidates(scores, C.class_array([str(c) for c in classes]), CANDIDATES).alias("top_candidates"),
    )
    return F.when(scores.isNotNull(), result)


def score_documents(
    checked: DataFrame,
    classic: C.NaiveBayes,
    advanced: DataFrame,
    advanced_classes: list,
    advanced_name: str = "Embedding classifier",
) -> DataFrame:
    """Dual predictions for the accepted rows of a written ``checked_inputs`` table.

    ``advanced`` is ``(doc_id, scores, y_pred)`` of the embedding model. Both
    results join on the unique document id.
    """
    accepted = checked.filter(F.col("status") == "accepted")
    tokens = T.vector_tokens(F.col("clean"), accents=False)
    terms = X.document_terms(accepted, "doc_id", tokens, classic.config)
    first = C.score_naive_bayes(terms, classic, "doc_id").select(
        "doc_id",
        model_result(
            classic.name, "Classic Machine Learning", classic.classes, F.col("scores"), F.col("y_pred")
        ).alias("classic_model"),
    )
    second = advanced.select(
        "doc_id",
        model_result(
            advanced_name, "Dense Embeddings", advanced_classes, F.col("scores"), F.col("y_pred")
        ).alias("advanced_model"),
    )
    base = accepted.drop("clean", "status", "reason")
    joined = base.join(first, "doc_id").join(second, "doc_id", "left")
    agreement = F.col("classic_model.category").eqNullSafe(F.col("advanced_model.category"))
    return joined.withColumn("models_agreement", agreement).withColumn("status", F.lit("success"))


def history_entries(scored: DataFrame, at: Column) -> DataFrame:
    """Flat history rows with the first five keywords."""
    fields = [
        F.col(f"{side}_model.{name}").alias(f"{side}_{name}")
        for side in ("classic", "advanced")
        for name in ("category", "confidence", "confidence_percentage")
    ]
    return scored.select(
        F.col("doc_id").alias("id"),
        at.alias("timestamp"),
        "filename",
        *fields,
        F.coalesce("models_agreement", F.lit(True)).alias("agreement"),
        F.slice(F.coalesce("keywords", F.array().cast("array<string>")), 1, HISTORY_KEYWORDS).alias("keywords"),
        F.coalesce("word_count_raw", F.lit(0)).alias("word_count"),
    )
