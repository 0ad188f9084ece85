"""Queries for the corpus profile, splits, joins, sorts and set operations."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from docsift.functions import text as T
from docsift.functions.arrays import settle
from docsift.operators import labels as L
from docsift.operators import profile as P
from docsift.operators import splits as S
from docsift.plans import sqltext as Q
from docsift.plans.registry import documents, query, rounded, table
from docsift.session import new_path
from docsift.sources import store as ST


def _clean(spark: SparkSession, sf: str) -> DataFrame:
    return P.clean_corpus(documents(spark, sf, "lang", "text"))


@query("A9 L1", f"WITH {Q.CLEAN} SELECT term, count(*) AS n FROM (SELECT unnest(tokens) AS term FROM clean) GROUP BY term ORDER BY n DESC, term LIMIT 15")
def top_corpus_terms(spark: SparkSession, sf: str) -> DataFrame:
    rows = P.with_clean_text(documents(spark, sf, "text"))
    return P.top_terms(rows, F.col("tokens"), 15)


@query("A9", f"WITH {Q.CLEAN} SELECT term, count(*) AS n FROM (SELECT unnest(tokens) AS term FROM clean) GROUP BY term")
def term_frequencies(spark: SparkSession, sf: str) -> DataFrame:
    rows = P.with_clean_text(documents(spark, sf, "text"))
    return P.term_frequencies(rows, F.col("tokens"))


@query("P1 J8", "SELECT count(*) AS n, count(DISTINCT doc_id) AS ids FROM documents JOIN labels USING (doc_id) WHERE quality IS NOT NULL AND text IS NOT NULL")
def rows_with_label_and_text(spark: SparkSession, sf: str) -> DataFrame:
    rows = documents(spark, sf, "text").join(table(spark, sf, "labels"), "doc_id", "left")
    kept = P.drop_null_rows(rows, "quality", "text")
    return kept.agg(F.count(F.lit(1)).alias("n"), F.countDistinct("doc_id").alias("ids"))


@query("P2", f"WITH {Q.CLEAN} SELECT doc_id FROM clean WHERE length({Q.stripped('clean')}) > 10")
def long_enough_documents(spark: SparkSession, sf: str) -> DataFrame:
    return P.keep_long_clean(_clean(spark, sf)).select("doc_id")


@query("P3", f"WITH {Q.CLEAN} SELECT count(*) AS total, count(*) FILTER (clean_words > 5) AS kept, round(100.0 * count(*) FILTER (clean_words > 5) / count(*), 6) AS retention_pct FROM clean")
def retention(spark: SparkSession, sf: str) -> DataFrame:
    return rounded(P.retention(_clean(spark, sf)), "retention_pct")


@query("P4", f"WITH {Q.CLEAN} SELECT doc_id, raw_chars, raw_words, clean_chars, clean_words FROM clean")
def document_lengths(spark: SparkSession, sf: str) -> DataFrame:
    return _clean(spark, sf).select("doc_id", "raw_chars", "raw_words", "clean_chars", "clean_words")


@query("P5", f"SELECT count(*) FILTER (len({Q.words('text')}) < 10) AS empty_or_short FROM documents")
def short_documents(spark: SparkSession, sf: str) -> DataFrame:
    return P.short_documents(documents(spark, sf, "text"))


@query(
    "P6",
    """WITH j AS (SELECT doc_id, lang, quality, toxic FROM documents LEFT JOIN labels USING (doc_id))
SELECT count(*) - count(doc_id) AS doc_id, count(*) - count(lang) AS lang, count(*) - count(quality) AS quality,
  count(*) - count(toxic) AS toxic, 4 * count(*) - count(doc_id) - count(lang) - count(quality) - count(toxic) AS missing_values FROM j""",
)
def null_counts(spark: SparkSession, sf: str) -> DataFrame:
    return P.null_counts(documents(spark, sf, "lang").join(table(spark, sf, "labels"), "doc_id", "left"))


@query("P12", "SELECT doc_id, md5(text) AS h FROM documents WHERE lang = 'de'")
def rows_of_category(spark: SparkSession, sf: str) -> DataFrame:
    return P.rows_of(table(spark, sf, "documents"), "lang", "de").select("doc_id", F.md5("text").alias("h"))


@query("A1", "SELECT count(*) AS total, count(DISTINCT lang) AS num_categories, CAST(5 AS BIGINT) AS num_columns FROM documents")
def corpus_size(spark: SparkSession, sf: str) -> DataFrame:
    return P.corpus_size(table(spark, sf, "documents"), "lang")


@query("A2", "SELECT lang, count(*) AS n, round(100.0 * count(*) / (SELECT count(*) FROM documents), 6) AS pct FROM documents GROUP BY lang")
def category_counts(spark: SparkSession, sf: str) -> DataFrame:
    return rounded(P.category_counts(documents(spark, sf, "lang"), "lang"), "pct")


@query(
    "A3",
    f"""WITH l AS (SELECT len({Q.words('text')}) AS v FROM documents)
SELECT min(v) AS min, max(v) AS max, round(avg(v), 6) AS mean, round(quantile_cont(v, 0.25), 6) AS p25,
  round(quantile_cont(v, 0.5), 6) AS median, round(quantile_cont(v, 0.75), 6) AS p75 FROM l""",
)
def word_length_summary(spark: SparkSession, sf: str) -> DataFrame:
    rows = settle(documents(spark, sf, "text"), n_words=T.word_count(F.col("text")))
    return rounded(P.length_summary(rows, "n_words"), "mean", "p25", "median", "p75")


@query(
    "A4 A8",
    f"""WITH {Q.CLEAN} SELECT count(*) AS total_samples, round(avg(raw_chars), 6) AS raw_avg_chars, round(avg(raw_words), 6) AS raw_avg_words,
  min(raw_words) AS raw_min_words, max(raw_words) AS raw_max_words, round(avg(clean_chars), 6) AS clean_avg_chars,
  round(avg(clean_words), 6) AS clean_avg_words, CAST(sum(clean_words) AS BIGINT) AS total_tokens,
  round(quantile_cont(raw_chars, 0.5), 6) AS raw_median_chars FROM clean""",
)
def corpus_metrics(spark: SparkSession, sf: str) -> DataFrame:
    metrics = P.corpus_metrics(_clean(spark, sf))
    return rounded(metrics, "raw_avg_chars", "raw_avg_words", "clean_avg_chars", "clean_avg_words", "raw_median_chars")


@query("A5", "SELECT count(*) AS total, count(*) - count(DISTINCT text) AS duplicates, count(DISTINCT text) AS remaining FROM documents")
def exact_duplicates(spark: SparkSession, sf: str) -> DataFrame:
    return P.duplicates(documents(spark, sf, "text"), F.col("text"))


_KEY = Q.regex("lower(text)", f"[^{Q.WORD}{Q.BLANK}]", "")


@query(
    "A6",
    f"""WITH {Q.CLEAN} SELECT count(*) - count(DISTINCT text) AS exact, count(*) - count(DISTINCT {_KEY}) AS near_duplicates,
  count(DISTINCT {_KEY}) AS remains_after_deduplication, count(*) FILTER (clean_words > 5) < count(*) AS deduplication_applied FROM clean""",
)
def duplicate_report(spark: SparkSession, sf: str) -> DataFrame:
    kept = P.keep_words(_clean(spark, sf)).select("doc_id")
    return P.duplicate_report(documents(spark, sf, "text"), "text", kept)


@query("A6", f"SELECT min(doc_id) AS doc_id FROM documents GROUP BY {_KEY}")
def documents_without_duplicates(spark: SparkSession, sf: str) -> DataFrame:
    rows = documents(spark, sf, "text")
    return P.drop_duplicates(rows, "doc_id", T.duplicate_key(F.col("text"))).select("doc_id")


@query("W8", "SELECT doc_id, row_number() OVER (PARTITION BY text ORDER BY doc_id) = 1 AS is_first FROM documents")
def first_of_duplicates(spark: SparkSession, sf: str) -> DataFrame:
    return P.mark_first(documents(spark, sf, "text"), "doc_id", F.col("text")).select("doc_id", "is_first")


@query("A7", f"SELECT count(DISTINCT w) AS vocabulary FROM (SELECT unnest({Q.words('lower(text)')}) AS w FROM documents)")
def raw_vocabulary(spark: SparkSession, sf: str) -> DataFrame:
    return P.vocabulary_size(documents(spark, sf, "text"), T.split_words(F.lower("text")))


@query("A7", f"WITH {Q.CLEAN} SELECT count(DISTINCT w) AS vocabulary FROM (SELECT unnest(tokens) AS w FROM clean)")
def clean_vocabulary(spark: SparkSession, sf: str) -> DataFrame:
    return P.vocabulary_size(P.with_clean_text(documents(spark, sf, "text")), F.col("tokens"))


@query("A10", "SELECT max(n) AS largest, min(n) AS smallest, round(max(n) / min(n), 6) AS ratio FROM (SELECT count(*) AS n FROM documents GROUP BY lang)")
def class_imbalance(spark: SparkSession, sf: str) -> DataFrame:
    return rounded(P.class_imbalance(documents(spark, sf, "lang"), "lang"), "ratio")


@query(
    "A12",
    f"""WITH l AS MATERIALIZED (SELECT len({Q.words('text')})::DOUBLE AS v FROM documents),
r AS (SELECT min(v) AS low, (max(v) - min(v)) / 30 AS width FROM l)
SELECT CAST(least(floor((v - low) / width), 29) AS BIGINT) AS bin,
  round(low + least(floor((v - low) / width), 29) * width, 6) AS bin_start, count(*) AS n FROM l, r GROUP BY ALL""",
)
def length_histogram(spark: SparkSession, sf: str) -> DataFrame:
    rows = settle(documents(spark, sf, "text"), n_words=T.word_count(F.col("text")))
    return rounded(P.histogram(rows, "n_words", 30), "bin_start")


@query("A24", "SELECT lang, (SELECT count(DISTINCT lang) FROM documents) AS total FROM documents GROUP BY lang")
def category_list(spark: SparkSession, sf: str) -> DataFrame:
    return P.category_list(documents(spark, sf, "lang"), "lang")


@query(
    "W1",
    f"""WITH {Q.CLEAN}, top AS (SELECT lang FROM documents GROUP BY lang ORDER BY count(*) DESC, lang LIMIT 5),
c AS (SELECT lang, term, count(*) AS n FROM (SELECT lang, unnest(tokens) AS term FROM clean WHERE lang IN (SELECT lang FROM top)) GROUP BY ALL)
SELECT lang, term, n, row_number() OVER (PARTITION BY lang ORDER BY n DESC, term) AS rank FROM c
QUALIFY row_number() OVER (PARTITION BY lang ORDER BY n DESC, term) <= 10""",
)
def top_terms_by_category(spark: SparkSession, sf: str) -> DataFrame:
    rows = documents(spark, sf, "lang", "text")
    return P.top_terms_by_category(rows, "lang", T.clean_tokens(F.col("text")))


@query("L2", "SELECT lang, count(*) AS n FROM documents GROUP BY lang ORDER BY n DESC, lang LIMIT 5")
def largest_categories(spark: SparkSession, sf: str) -> DataFrame:
    return P.top_categories(documents(spark, sf, "lang"), "lang")


@query("L4", "SELECT doc_id, lang FROM documents ORDER BY md5('42:' || doc_id), doc_id")
def shuffled_documents(spark: SparkSession, sf: str) -> DataFrame:
    return P.seeded_shuffle(documents(spark, sf, "lang"), "doc_id")


@query("L5", "SELECT doc_id, lang, n_chars FROM documents ORDER BY doc_id LIMIT 5")
def sample_rows(spark: SparkSession, sf: str) -> DataFrame:
    return P.first_rows(documents(spark, sf, "lang", "n_chars"), "doc_id", 5)


_SPLIT = f"WITH {Q.ranked('documents', 'lang')}"


@query("W2", f"{_SPLIT} SELECT doc_id, is_test FROM split")
def stratified_split(spark: SparkSession, sf: str) -> DataFrame:
    return S.stratified_split(documents(spark, sf, "lang"), "doc_id", "lang").select("doc_id", "is_test")


@query("W3", f"{_SPLIT} SELECT doc_id, category AS lang, fold FROM split")
def stratified_folds(spark: SparkSession, sf: str) -> DataFrame:
    return S.stratified_folds(documents(spark, sf, "lang"), "doc_id", "lang")


@query("S9", f"{_SPLIT} SELECT doc_id, is_test, fold FROM split")
def saved_split(spark: SparkSession, sf: str) -> DataFrame:
    path = new_path(spark, "split")
    ST.write_table(S.split_table(documents(spark, sf, "lang"), "doc_id", "lang"), path)
    return spark.read.parquet(path)


def _split(spark: SparkSession, sf: str) -> DataFrame:
    return S.stratified_split(documents(spark, sf, "lang"), "doc_id", "lang").select("doc_id", "is_test")


@query("J1 U3", f"{_SPLIT} SELECT doc_id, n_chars FROM documents JOIN split USING (doc_id) WHERE NOT is_test")
def training_rows(spark: SparkSession, sf: str) -> DataFrame:
    return S.take_train(documents(spark, sf, "n_chars"), _split(spark, sf), "doc_id")


@query("J1", f"{_SPLIT} SELECT doc_id, n_chars FROM documents JOIN split USING (doc_id) WHERE is_test")
def test_rows(spark: SparkSession, sf: str) -> DataFrame:
    return S.take_test(documents(spark, sf, "n_chars"), _split(spark, sf), "doc_id")


@query("U3", f"{_SPLIT} SELECT doc_id FROM documents EXCEPT SELECT doc_id FROM split WHERE is_test")
def training_ids(spark: SparkSession, sf: str) -> DataFrame:
    ids = documents(spark, sf)
    return ids.subtract(_split(spark, sf).filter("is_test").select("doc_id"))


@query("J2", f"{_SPLIT} SELECT doc_id, n_chars, is_test FROM documents JOIN split USING (doc_id)")
def rows_with_split(spark: SparkSession, sf: str) -> DataFrame:
    return S.attach_split(documents(spark, sf, "n_chars"), _split(spark, sf), "doc_id")


_BAD = "documents JOIN labels USING (doc_id) WHERE toxic = 1"


@query("J3", f"SELECT DISTINCT source FROM documents WHERE source NOT IN (SELECT source FROM {_BAD})")
def missing_categories(spark: SparkSession, sf: str) -> DataFrame:
    rows = documents(spark, sf, "source")
    present = rows.join(table(spark, sf, "labels").filter("toxic = 1"), "doc_id", "left_semi")
    return L.missing_categories(rows, present, "source")


@query("U2", f"SELECT source FROM documents EXCEPT SELECT source FROM {_BAD}")
def category_difference(spark: SparkSession, sf: str) -> DataFrame:
    rows = documents(spark, sf, "source")
    present = rows.join(table(spark, sf, "labels").filter("toxic = 1"), "doc_id", "left_semi")
    return L.category_difference(rows, present, "source")


_DIM = "dim AS (SELECT lang, row_number() OVER (ORDER BY lang) - 1 AS label_index FROM (SELECT DISTINCT lang FROM documents))"


@query("J4", f"WITH {_DIM} SELECT doc_id, lang, CAST(label_index AS INTEGER) AS label_index FROM documents JOIN dim USING (lang)")
def encoded_labels(spark: SparkSession, sf: str) -> DataFrame:
    rows = documents(spark, sf, "lang")
    return L.encode(rows, L.label_dimension(rows, "lang"), "lang").select("doc_id", "lang", "label_index")


@query("J4", "SELECT doc_id, lang FROM documents")
def decoded_labels(spark: SparkSession, sf: str) -> DataFrame:
    rows = documents(spark, sf, "lang")
    dim = L.label_dimension(rows, "lang")
    return L.decode(L.encode(rows, dim, "lang").select("doc_id", "label_index"), dim, "lang").select("doc_id", "lang")


@query("J8", "SELECT doc_id, lang, quality, toxic FROM documents JOIN labels USING (doc_id)")
def labelled_documents(spark: SparkSession, sf: str) -> DataFrame:
    return L.with_labels(documents(spark, sf, "lang"), table(spark, sf, "labels"))


@query(
    "U1",
    "SELECT doc_id AS id, lang AS category, n_chars AS size FROM documents UNION ALL SELECT conv_id, role, length(text) FROM conversations",
)
def appended_rows(spark: SparkSession, sf: str) -> DataFrame:
    first = documents(spark, sf, "lang", "n_chars").select(F.col("doc_id").alias("id"), F.col("lang").alias("category"), F.col("n_chars").alias("size"))
    other = table(spark, sf, "conversations").select(
        F.length("text").cast("long").alias("size"), F.col("role").alias("category"), F.col("conv_id").alias("id")
    )
    return L.append_rows(first, other)
