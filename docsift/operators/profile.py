"""Corpus profile: sizes, lengths, duplicates, vocabulary, class balance."""

from __future__ import annotations

import functools
import operator

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from docsift.functions import text as T
from docsift.functions.arrays import settle, term_counts
from docsift.operators import lemmas as LM
from docsift.sources.store import materialize


def drop_null_rows(df: DataFrame, *columns: str) -> DataFrame:
    return df.dropna(subset=list(columns))


def with_clean_text(df: DataFrame, text: str = "text", **options) -> DataFrame:
    """Add ``tokens`` and ``clean`` computed once per row, null texts dropped."""
    df = settle(df.dropna(subset=[text]), tokens=T.clean_tokens(F.col(text), **options))
    return df.withColumn("clean", F.array_join("tokens", " "))


def clean_corpus(df: DataFrame, text: str = "text", **options) -> DataFrame:
    """Cleaned text with raw and clean character and word counts."""
    return with_clean_text(df, text, **options).select(
        "*",
        F.length(text).alias("raw_chars"),
        T.word_count(F.col(text)).alias("raw_words"),
        F.length("clean").alias("clean_chars"),
        F.size("tokens").alias("clean_words"),
    )


def keep_long_clean(df: DataFrame, column: str = "clean", more_than: int = 10) -> DataFrame:
    return df.filter(F.length(T.strip_blanks(F.col(column))) > more_than)


def _percent(part: Column, whole: Column) -> Column:
    return F.when(whole > 0, part * F.lit(100.0) / whole)


def retention(df: DataFrame, words: str = "clean_words", more_than: int = 5) -> DataFrame:
    kept = F.count_if(F.col(words) > more_than)
    total = F.count(F.lit(1))
    return df.agg(
        total.alias("total"), kept.alias("kept"), _percent(kept, total).alias("retention_pct")
    )


def keep_words(df: DataFrame, words: str = "clean_words", more_than: int = 5) -> DataFrame:
    return df.filter(F.col(words) > more_than)


def short_documents(df: DataFrame, text: str = "text", below: int = 10) -> DataFrame:
    return df.agg(F.count_if(T.word_count(F.col(text)) < below).alias("empty_or_short"))


def null_counts(df: DataFrame) -> DataFrame:
    """Nulls per column and over all columns, in one pass."""
    per_column = [F.count_if(F.col(c).isNull()) for c in df.columns]
    return df.agg(
        *[n.alias(c) for n, c in zip(per_column, df.columns, strict=True)],
        functools.reduce(operator.add, per_column).alias("missing_values"),
    )


def corpus_size(df: DataFrame, category: str) -> DataFrame:
    return df.agg(
        F.count(F.lit(1)).alias("total"),
        F.countDistinct(category).alias("num_categories"),
    ).withColumn("num_columns", F.lit(len(df.columns)).cast("long"))


def category_counts(df: DataFrame, category: str) -> DataFrame:
    """Rows and share per category; the total is a scalar over the counts."""
    counts = df.filter(F.col(category).isNotNull()).groupBy(category).agg(F.count(F.lit(1)).alias("n"))
    total = counts.agg(F.sum("n")).scalar()
    return counts.withColumn("pct", F.col("n") * 100.0 / total)


def top_categories(df: DataFrame, category: str, k: int = 5) -> DataFrame:
    counts = df.groupBy(category).agg(F.count(F.lit(1)).alias("n"))
    return counts.orderBy(F.desc("n"), F.asc(category)).limit(k)


def class_imbalance(df: DataFrame, category: str) -> DataFrame:
    counts = df.groupBy(category).agg(F.count(F.lit(1)).alias("n"))
    return counts.agg(
        F.max("n").alias("largest"),
        F.min("n").alias("smallest"),
        (F.max("n") / F.min("n")).alias("ratio"),
    )


def category_list(df: DataFrame, category: str) -> DataFrame:
    names = df.select(category).distinct()
    total = names.agg(F.count(F.lit(1))).scalar()
    return names.withColumn("total", total).orderBy(category)


def rows_of(df: DataFrame, category: str, value) -> DataFrame:
    return df.filter(F.col(category) == F.lit(value))


def length_summary(df: DataFrame, value: str, approximate: bool = False) -> DataFrame:
    """Minimum, maximum, mean and quartiles (linear interpolation).

    Quartiles are taken over a value histogram, so one task sees distinct lengths
    and not rows.
    """
    shares = F.array(F.lit(0.25), F.lit(0.5), F.lit(0.75))
    counts = df.groupBy(F.col(value).alias("v")).agg(F.count(F.lit(1)).alias("n"))
    if approximate:
        cuts = df.agg(F.percentile_approx(value, [0.25, 0.5, 0.75], 10000)).scalar()
    else:
        cuts = F.percentile("v", shares, F.col("n"))
    summary = counts.agg(
        F.min("v").alias("min"),
        F.max("v").alias("max"),
        (F.sum(F.col("v") * F.col("n")) / F.sum("n")).alias("mean"),
        *([] if approximate else [cuts.alias("q")]),
    )
    if approximate:
        summary = summary.withColumn("q", cuts)
    return summary.select(
        "min", "max", "mean", F.col("q")[0].alias("p25"), F.col("q")[1].alias("median"), F.col("q")[2].alias("p75")
    )


def corpus_metrics(clean: DataFrame) -> DataFrame:
    """Raw and clean length metrics of a ``clean_corpus`` table in one row.

    One pass: sums per text length first, then totals and the median over them.
    """
    per_length = clean.groupBy("raw_chars").agg(
        F.count(F.lit(1)).alias("n"),
        F.sum("raw_words").alias("raw_words"),
        F.min("raw_words").alias("min_words"),
        F.max("raw_words").alias("max_words"),
        F.sum("clean_chars").alias("clean_chars"),
        F.sum("clean_words").alias("clean_words"),
    )
    n = F.sum("n")
    return per_length.agg(
        n.alias("total_samples"),
        (F.sum(F.col("raw_chars") * F.col("n")) / n).alias("raw_avg_chars"),
        (F.sum("raw_words") / n).alias("raw_avg_words"),
        F.min("min_words").alias("raw_min_words"),
        F.max("max_words").alias("raw_max_words"),
        (F.sum("clean_chars") / n).alias("clean_avg_chars"),
        (F.sum("clean_words") / n).alias("clean_avg_words"),
        F.sum("clean_words").cast("long").alias("total_tokens"),
        F.percentile("raw_chars", F.lit(0.5), F.col("n")).alias("raw_median_chars"),
    )


def duplicates(df: DataFrame, key: Column) -> DataFrame:
    """Rows beyond the first of each key. Copies are counted before the shuffle,
    so a key that holds much of the corpus costs no more than any other."""
    counts = df.groupBy(T.fingerprint(key).alias("key")).agg(F.count(F.lit(1)).alias("n"))
    total, distinct = F.coalesce(F.sum("n"), F.lit(0)), F.count(F.lit(1))
    return counts.agg(
        total.cast("long").alias("total"),
        (total - distinct).cast("long").alias("duplicates"),
        distinct.alias("remaining"),
    )


def duplicate_report(df: DataFrame, text: str, kept_rows: DataFrame) -> DataFrame:
    """Exact and normalised duplicates, rows left, and whether ``kept_rows`` is
    smaller than the corpus. Both keys are counted in one grouping."""
    column = F.col(text)
    both = df.select(
        F.inline(
            F.array(
                F.struct(F.lit("exact").alias("kind"), T.fingerprint(column).alias("key")),
                F.struct(F.lit("near").alias("kind"), T.fingerprint(T.duplicate_key(column)).alias("key")),
            )
        )
    )
    counts = both.groupBy("kind", "key").agg(F.count(F.lit(1)).alias("n"))
    extra = F.col("n") - 1
    exact, near = F.col("kind") == "exact", F.col("kind") == "near"
    kept = kept_rows.agg(F.count(F.lit(1))).scalar()
    report = counts.agg(
        F.sum(F.when(exact, extra)).cast("long").alias("exact"),
        F.sum(F.when(near, extra)).cast("long").alias("near_duplicates"),
        F.count_if(near).alias("remains_after_deduplication"),
        F.sum(F.when(near, F.col("n"))).cast("long").alias("total"),
    )
    return report.select(
        "exact",
        "near_duplicates",
        "remains_after_deduplication",
        (kept < F.col("total")).alias("deduplication_applied"),
    )


def mark_first(df: DataFrame, row_id: str, key: Column) -> DataFrame:
    """Add ``is_first``: the row with the lowest id among those of equal key.

    The lowest id per key comes from a map-side combined minimum and is joined
    back on the unique id, so a heavily repeated key never lands in one task.
    """
    firsts = df.groupBy(T.fingerprint(key).alias("key")).agg(F.min(row_id).alias(row_id))
    firsts = firsts.select(row_id, F.lit(True).alias("is_first"))
    marked = df.join(firsts, row_id, "left")
    return marked.withColumn("is_first", F.coalesce("is_first", F.lit(False)))


def drop_duplicates(df: DataFrame, row_id: str, key: Column) -> DataFrame:
    firsts = df.groupBy(T.fingerprint(key).alias("key")).agg(F.min(row_id).alias(row_id))
    return df.join(firsts.select(row_id), row_id, "left_semi")


def term_frequencies(df: DataFrame, tokens: Column) -> DataFrame:
    """Occurrences per term; each row sends every distinct term once."""
    return (
        df.select(F.inline(term_counts(tokens)))
        .groupBy("term")
        .agg(F.sum("n").cast("long").alias("n"))
    )


def top_terms(df: DataFrame, tokens: Column, k: int) -> DataFrame:
    return term_frequencies(df, tokens).orderBy(F.desc("n"), F.asc("term")).limit(k)


def vocabulary_size(df: DataFrame, tokens: Column, approximate: bool = False) -> DataFrame:
    terms = df.select(F.explode(F.array_distinct(tokens)).alias("term"))
    if approximate:
        return terms.agg(F.approx_count_distinct("term").alias("vocabulary"))
    return terms.agg(F.countDistinct("term").alias("vocabulary"))


def top_terms_by_category(
    df: DataFrame, category: str, tokens: Column, categories: int = 5, k: int = 10
) -> DataFrame:
    """Most frequent terms in each of the largest categories.

    ``tokens`` may be a cleaning expression over ``df``: finding the categories
    reads only their column, and other categories are never cleaned. The rank filter directly on ``row_number`` lets Spark cut every partition to
    ``k`` rows per category before the shuffle.
    """
    largest = top_categories(df.select(category), category, categories).select(category)
    counts = (
        df.select(category, F.inline(term_counts(tokens)))
        .join(F.broadcast(largest), category, "left_semi")
        .groupBy(category, "term")
        .agg(F.sum("n").cast("long").alias("n"))
    )
    order = W.partitionBy(category).orderBy(F.desc("n"), F.asc("term"))
    return counts.withColumn("rank", F.row_number().over(order)).filter(F.col("rank") <= k)


def share_above(df: DataFrame, value: Column, threshold: int) -> Column:
    """Percentage of rows above ``threshold`` as an aggregate Column."""
    return F.avg(F.when(value > threshold, F.lit(100.0)).otherwise(F.lit(0.0)))


def token_budget(df: DataFrame, text: str, limits: tuple[int, ...] = (256, 512), counter=None) -> DataFrame:
    """Share of documents over each model length; ``counter`` maps text to a count."""
    count = (counter or T.model_token_count)(F.col(text))
    counted = settle(df.select(text), n_tokens=count).select("n_tokens")
    return counted.agg(
        *[share_above(counted, F.col("n_tokens"), n).alias(f"pct_gt_{n}") for n in limits]
    )


def histogram(df: DataFrame, value: str, bins: int) -> DataFrame:
    """Equal-width bins over the value range; the last bin includes the maximum.

    Range and bins both come from the counts per value, which are made once.
    """
    values = df.groupBy(F.col(value).cast("double").alias("v")).agg(F.count(F.lit(1)).alias("n"))
    ends = values.agg(F.struct(F.min("v").alias("low"), F.max("v").alias("high"))).scalar()
    placed = values.withColumn("ends", ends).select("v", "n", "ends.low", "ends.high")
    width = (F.col("high") - F.col("low")) / bins
    index = F.when(width == 0, F.lit(0)).otherwise(
        F.least(F.floor((F.col("v") - F.col("low")) / width), F.lit(bins - 1))
    )
    return (
        placed.select(index.cast("long").alias("bin"), "low", width.alias("width"), "n")
        .groupBy("bin", (F.col("low") + F.col("bin") * F.col("width")).alias("bin_start"))
        .agg(F.sum("n").cast("long").alias("n"))
    )


def seeded_shuffle(df: DataFrame, row_id: str, seed: int = 42) -> DataFrame:
    """A reproducible random order (a range-partitioned sort on a hash)."""
    return df.orderBy(F.md5(F.concat(F.lit(f"{seed}:"), F.col(row_id).cast("string"))), row_id)


def first_rows(df: DataFrame, row_id: str, n: int) -> DataFrame:
    return df.orderBy(row_id).limit(n)


def cleaning_trace(
    df: DataFrame, row_id: str, text: str = "text", lexicon: DataFrame | None = None
) -> DataFrame:
    """Every cleaning step as a column: masked text, lower case without
    punctuation, tokens, tokens without stop words, their lemmas.

    The masked texts are written once, the other steps are made from them. Without a lexicon the
    traced tokens are it.
    """
    masked = materialize(settle(df, masked=T.mask_pii(F.col(text))), "trace")
    lowered = settle(masked, lowered=T.blank_non_words(F.lower("masked")))
    split = settle(lowered, tokens=T.split_words(F.col("lowered")))
    kept = settle(split, without_stop_words=T.drop_stop_words(F.col("tokens")))
    return LM.lemmatize(kept.withColumn("lemmas", F.col("without_stop_words")), row_id, "lemmas", lexicon)
