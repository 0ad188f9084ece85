"""TF-IDF over word n-grams as table work.

``tf = 1 + ln(count)``, ``idf = ln((1 + n) / (1 + df)) + 1``, rows scaled to unit
length. The vocabulary is capped, so its broadcast has a fixed size bound.

Documents come as ``terms`` (``document_terms``: every n-gram with its count) or as ``words``
(in order, joined by blanks). Of words only n-grams that can pass the cap are ever counted
by name, so neither the table nor a shuffle holds the many rare ones.
"""

from __future__ import annotations

import sys
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.cloudpickle import register_pickle_by_value
from pyspark.ml.linalg import VectorUDT
from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F
from pyspark.sql.types import StructField, StructType

from docsift.functions.arrays import ngrams, term_counts
from docsift.sources.store import materialize, within

register_pickle_by_value(sys.modules[__name__])


@dataclass(frozen=True)
class TfidfConfig:
    """Fixed values of the two vectorisers are the class attributes below."""

    max_features: int = 30_000
    low: int = 1
    high: int = 2
    min_df: int = 2
    max_df: float = 0.95
    sublinear: bool = True


STANDARD = TfidfConfig()
SMALL = TfidfConfig(max_features=5_000, min_df=1, max_df=1.0)
MAX_BROADCAST_TERMS = 1_000_000


#: Documents counted together.
ROWS = 256
TERMS = "array<struct<term:string,n:int>>"


def _counted(tokens: pa.ListArray, low: int, high: int) -> pa.ListArray:
    """Distinct words and pairs of neighbours with counts for every row, in the order of the terms."""
    lengths = tokens.value_lengths().fill_null(0).to_numpy(zero_copy_only=False).astype(np.int64)
    words = tokens.flatten().dictionary_encode()
    order = pc.sort_indices(words.dictionary).to_numpy()
    place = np.empty(len(order), np.int64)
    place[order] = np.arange(len(order))
    names, codes = words.dictionary.take(pa.array(order)), place[words.indices.to_numpy()]
    rows = np.repeat(np.arange(len(lengths)), lengths)
    base = len(names) + 1  # a key is row, word, and neighbour or 0
    keys = []
    if low == 1:
        keys.append((rows * base + codes) * base)
    if high == 2:
        pairs = np.flatnonzero(rows[1:] == rows[:-1])
        keys.append((rows[pairs] * base + codes[pairs]) * base + codes[pairs + 1] + 1)
    found, n = np.unique(np.concatenate(keys), return_counts=True)
    second = found % base
    neighbour = names.take(pa.array(second - 1, mask=second == 0))
    term = pc.binary_join_element_wise(names.take(pa.array(found // base % base)), neighbour, " ", null_handling="skip")
    ends = np.cumsum(np.bincount(found // (base * base), minlength=len(lengths)))
    entries = pa.StructArray.from_arrays([term, pa.array(n.astype(np.int32))], ["term", "n"])
    return pa.ListArray.from_arrays(pa.array(np.append(0, ends).astype(np.int32)), entries)


def document_terms(df: DataFrame, row_id: str, tokens: Column, config: TfidfConfig = STANDARD, *keep: str) -> DataFrame:
    """``(row_id, *keep, terms)``: distinct n-grams with counts, one row per document.

    Words (without blanks) and pairs are counted as numbers in Arrow batches, longer n-grams by column functions.
    """
    low, high = config.low, config.high
    if high > 2:
        terms = term_counts(ngrams(tokens, low, high))
        return df.select(row_id, *keep, terms.alias("terms"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for at in range(0, batch.num_rows, ROWS):
                part = batch.slice(at, ROWS)
                terms = _counted(part.column(part.num_columns - 1), low, high)
                yield pa.RecordBatch.from_arrays([*part.columns[:-1], terms], [row_id, *keep, "terms"])

    rows = df.select(row_id, *keep, tokens.alias("terms"))
    kept = [f"`{f.name}` {f.dataType.simpleString()}" for f in rows.schema.fields[:-1]]
    return rows.mapInArrow(run, ", ".join([*kept, f"terms {TERMS}"]))


def document_frequencies(terms: DataFrame) -> DataFrame:
    """``(term, df, tf)``: documents holding the term and total occurrences."""
    return (
        terms.select(F.inline("terms"))
        .groupBy("term")
        .agg(F.count(F.lit(1)).alias("df"), F.sum("n").cast("long").alias("tf"))
    )


def within_frequency(frequencies: DataFrame, documents: Column, config: TfidfConfig = STANDARD) -> DataFrame:
    """Terms in at least ``min_df`` documents and at most a share of ``max_df``."""
    return frequencies.filter(
        (F.col("df") >= config.min_df) & (F.col("df") <= F.lit(config.max_df) * documents)
    )


def capped(frequencies: DataFrame, config: TfidfConfig = STANDARD) -> DataFrame:
    """The most frequent terms, ties by term.

    A histogram over ranges of ``tf`` (a few thousand rows) tells which terms can
    be among them; only these are sorted, not as many from every partition.
    """
    grade = F.floor(F.log2("tf") * 64).alias("grade")
    sizes = frequencies.groupBy(grade).agg(F.count(F.lit(1)).alias("n"))
    order = W.partitionBy(F.lit(0)).orderBy(F.desc("grade"))
    enough = F.when(F.sum("n").over(order) >= config.max_features, F.col("grade"))
    cut = sizes.select(enough.alias("grade")).agg(F.max("grade")).scalar()
    likely = frequencies.filter(F.coalesce(grade >= cut, F.lit(True)))
    return likely.orderBy(F.desc("tf"), F.asc("term")).limit(config.max_features)


def fit_vocabulary(terms: DataFrame, config: TfidfConfig = STANDARD) -> DataFrame:
    """``(term, idx, df, idf)`` with alphabetical indices, from ``terms`` or ``words``.

    The frequency limits come first, then the cap; the ordered window sees the
    capped terms only.
    """
    documents = terms.agg(F.count(F.lit(1))).scalar()
    if "words" in terms.columns and by_words(config):
        kept = capped_words(terms, config)
    else:
        if "words" in terms.columns:
            terms = words_as_terms(terms, "words", config)
        kept = capped(within_frequency(document_frequencies(terms), documents, config), config)
    order = W.partitionBy(F.lit(0)).orderBy("term")
    idf = F.log((F.lit(1.0) + documents) / (F.lit(1.0) + F.col("df"))) + F.lit(1.0)
    return kept.select(
        "term", (F.row_number().over(order) - 1).alias("idx"), "df", idf.alias("idf")
    )


#: Bytes of text split together.
PIECE = 1 << 23
#: Ranges of hashes in which pairs of words are counted first.
BUCKETS = 1 << 20


def _pieces(texts: pa.Array) -> Iterator[slice]:
    ends = np.cumsum(pc.fill_null(pc.binary_length(texts), 0).to_numpy(zero_copy_only=False).astype(np.int64))
    at = 0
    while at < len(texts):
        to = max(at + 1, int(np.searchsorted(ends, (ends[at - 1] if at else 0) + PIECE, "right")))
        yield slice(at, to)
        at = to


def _split(texts: pa.Array) -> tuple[np.ndarray, pa.Array]:
    """Row and text of every word; a text without words gives an empty one."""
    lists = pc.split_pattern(texts.fill_null(""), " ")
    lengths = lists.value_lengths().to_numpy()
    return np.repeat(np.arange(len(lengths)), lengths), lists.flatten()


def _coded(texts: pa.Array, names: pa.Array) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Rows and codes of the words, -1 for those not in ``names``, and where a pair of known neighbours begins."""
    rows, words = _split(texts)
    codes = pc.index_in(words, value_set=names).fill_null(-1).to_numpy().astype(np.int64)
    known = codes >= 0
    return rows, codes, np.flatnonzero((rows[1:] == rows[:-1]) & known[1:] & known[:-1])


def _bucket(pairs: np.ndarray) -> np.ndarray:
    mixed = pairs.astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15)
    return (mixed >> np.uint64(65 - BUCKETS.bit_length())).astype(np.int64)


def _distinct(values: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Distinct numbers in order, with counts, by a plain sort."""
    ordered = np.sort(values)
    starts = np.flatnonzero(np.append(len(ordered) > 0, ordered[1:] != ordered[:-1]))
    return ordered[starts], np.diff(np.append(starts, len(ordered)))


def _in_documents(rows: np.ndarray, codes: np.ndarray, n: int) -> np.ndarray:
    """For each code the number of rows that hold it."""
    return np.bincount(_distinct(rows * n + codes)[0] % n, minlength=n)


def single_words(words: DataFrame) -> DataFrame:
    """``(term, df, tf)`` of the words; tasks add up large pieces before the shuffle."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = batch.column(0)
            for piece in _pieces(texts):
                rows, found = _split(texts[piece])
                found = found.dictionary_encode()
                codes, names = found.indices.to_numpy(), found.dictionary
                tf = np.bincount(codes, minlength=len(names))
                counts = [names, pa.array(_in_documents(rows, codes, len(names))), pa.array(tf)]
                yield pa.RecordBatch.from_arrays(counts, ["term", "df", "tf"]).filter(pc.not_equal(names, ""))

    parts = words.select("words").mapInArrow(run, "term string, df long, tf long")
    return parts.groupBy("term").agg(F.sum("df").alias("df"), F.sum("tf").alias("tf"))


def _pair_totals(words: DataFrame, names: pa.Array) -> np.ndarray:
    """Pairs of neighbours among ``names`` in each range of hashes: one bounded array per task, summed as a tree."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        totals = np.zeros(BUCKETS, np.int64)
        for batch in batches:
            texts = batch.column(0)
            for piece in _pieces(texts):
                _, codes, at = _coded(texts[piece], names)
                totals += np.bincount(_bucket(codes[at] * len(names) + codes[at + 1]), minlength=BUCKETS)
        yield pa.RecordBatch.from_arrays([pa.array([totals.tobytes()], pa.binary())], ["totals"])

    parts = words.select("words").mapInArrow(run, "totals binary").rdd
    return parts.map(lambda r: np.frombuffer(r[0], np.int64)).treeReduce(np.add)


def word_pairs(words: DataFrame, names: pa.Array, least: int) -> DataFrame:
    """``(term, df, tf)`` of pairs of neighbours among ``names``: all that occur ``least`` times, and some others.

    A range of hashes with fewer pairs than that holds none of them.
    """
    likely = _pair_totals(words, names) >= least

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = batch.column(0)
            for piece in _pieces(texts):
                rows, codes, at = _coded(texts[piece], names)
                pairs = codes[at] * len(names) + codes[at + 1]
                kept = np.flatnonzero(likely[_bucket(pairs)])
                found, tf = _distinct(pairs[kept])
                if len(found):
                    first, second = (names.take(pa.array(c)) for c in np.divmod(found, len(names)))
                    term = pc.binary_join_element_wise(first, second, " ")
                    df = _in_documents(rows[at[kept]], np.searchsorted(found, pairs[kept]), len(found))
                    yield pa.RecordBatch.from_arrays([term, pa.array(df), pa.array(tf)], ["term", "df", "tf"])

    parts = words.select("words").mapInArrow(run, "term string, df long, tf long")
    return parts.groupBy("term").agg(F.sum("df").alias("df"), F.sum("tf").alias("tf"))


def _arrow(df: DataFrame) -> pa.Table:
    return df.toArrow().combine_chunks()


def _column(table: pa.Table, name: str) -> pa.Array:
    column = table[name].combine_chunks()
    return column.combine_chunks() if isinstance(column, pa.ChunkedArray) else column


def by_words(config: TfidfConfig) -> bool:
    """Whether words are counted as such: single ones and pairs, with a cap that every task can hold."""
    return config.low == 1 and config.high <= 2 and config.max_features <= MAX_BROADCAST_TERMS


def capped_words(words: DataFrame, config: TfidfConfig = STANDARD) -> DataFrame:
    """``capped`` of all terms within the frequency limits, from ``words``.

    As many single words as the cap lets through bound from below how often a term of the vocabulary
    occurs, and a pair occurs no more often than either of its words: other pairs are not counted.
    """
    documents = words.count()
    singles = materialize(single_words(words), "single-words")
    limits = lambda f: within_frequency(f, F.lit(documents), config)
    if config.high == 1:
        return capped(limits(singles), config)
    first = capped(limits(singles), config).agg(F.count(F.lit(1)).alias("n"), F.min("tf").alias("tf")).first()
    least = max(config.min_df, first["tf"] if first["n"] == config.max_features else 1)
    frequent = singles.filter(F.col("tf") >= least).select("term")
    if not within(frequent, MAX_BROADCAST_TERMS):
        return capped(limits(document_frequencies(words_as_terms(words, "words", config))), config)
    pairs = materialize(word_pairs(words, _column(_arrow(frequent), "term"), least), "word-pairs")
    return capped(limits(singles.unionByName(pairs)), config)


def words_as_terms(words: DataFrame, row_id: str, config: TfidfConfig, *keep: str) -> DataFrame:
    """``document_terms`` of ``words``."""
    tokens = F.filter(F.split("words", " "), lambda t: t != "")
    return document_terms(words, row_id, tokens, config, *keep)


def term_weight(config: TfidfConfig = STANDARD) -> Column:
    tf = F.lit(1.0) + F.log(F.col("n").cast("double")) if config.sublinear else F.col("n").cast("double")
    return tf * F.col("idf")


def _as_side(vocabulary: DataFrame, config: TfidfConfig) -> DataFrame:
    return F.broadcast(vocabulary) if config.max_features <= MAX_BROADCAST_TERMS else vocabulary


def weighted_terms(terms: DataFrame, vocabulary: DataFrame, config: TfidfConfig = STANDARD) -> DataFrame:
    """Vocabulary terms of each document with raw weights; other terms are ignored."""
    others = [c for c in terms.columns if c != "terms"]
    side = _as_side(vocabulary.select("term", "idx", "idf"), config)
    return (
        terms.select(*others, F.inline("terms"))
        .join(side, "term")
        .select(*others, "term", "idx", term_weight(config).alias("raw"))
    )


def transform(
    terms: DataFrame, vocabulary: DataFrame, row_id: str, config: TfidfConfig = STANDARD, unit: bool = True
) -> DataFrame:
    """``(row_id, ..., features array<struct<idx, weight>>)``, unit length unless raw weights are asked for.

    Documents without a vocabulary term keep an empty array (a zero vector). A capped
    vocabulary goes to every task, so a document is weighted where it is, without a
    shuffle; a larger one is joined.
    """
    others = [c for c in terms.columns if c not in ("terms", "words", row_id)]
    if "words" in terms.columns and not by_words(config):
        terms = words_as_terms(terms, row_id, config, *others)
    if config.max_features > MAX_BROADCAST_TERMS:
        return _joined(terms, vocabulary, row_id, others, config, unit)
    known = _arrow(vocabulary.select("term", F.col("idx").cast("int").alias("idx"), "idf"))
    names, places = _column(known, "term"), known["idx"].to_numpy()
    idf, sublinear = known["idf"].to_numpy(), config.sublinear
    if "words" in terms.columns:
        return _weighted_words(terms, row_id, others, names, places, idf, sublinear, unit)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for at in range(0, batch.num_rows, ROWS):
                part = batch.slice(at, ROWS)
                lists = part.column(part.num_columns - 1)
                lengths = lists.value_lengths().fill_null(0).to_numpy(zero_copy_only=False)
                entries = lists.flatten()
                found = pc.index_in(entries.field("term"), value_set=names)
                hit = np.flatnonzero(found.is_valid().to_numpy(zero_copy_only=False))
                word = found.fill_null(0).to_numpy()[hit]
                rows = np.repeat(np.arange(len(lengths)), lengths)[hit]
                n = entries.field("n").to_numpy(zero_copy_only=False)[hit].astype(float)
                order = np.lexsort((places[word], rows))
                rows, word, n = rows[order], word[order], n[order]
                features = _weights(len(lengths), rows, places[word], n, idf[word], sublinear, unit)
                yield pa.RecordBatch.from_arrays([*part.columns[:-1], features], [row_id, *others, "features"])

    rows = terms.select(row_id, *others, "terms")
    return rows.mapInArrow(run, _features_schema(rows))


def _features_schema(rows: DataFrame) -> str:
    kept = [f"`{f.name}` {f.dataType.simpleString()}" for f in rows.schema.fields[:-1]]
    return ", ".join([*kept, "features array<struct<idx:int,weight:double>>"])


def _weights(
    size: int, rows: np.ndarray, places: np.ndarray, n: np.ndarray, idf: np.ndarray, sublinear: bool, unit: bool
) -> pa.ListArray:
    """Vectors of ``size`` rows, of unit length or raw, from counts in the order of rows and places."""
    weight = (1.0 + np.log(n) if sublinear else n) * idf
    if unit:
        weight = weight / np.sqrt(np.bincount(rows, weight * weight, minlength=size))[rows]
    ends = np.cumsum(np.bincount(rows, minlength=size))
    pairs = pa.StructArray.from_arrays([pa.array(places.astype(np.int32)), pa.array(weight)], ["idx", "weight"])
    return pa.ListArray.from_arrays(pa.array(np.append(0, ends).astype(np.int32)), pairs)


def _weighted_words(
    words: DataFrame, row_id: str, others: list[str], terms: pa.Array, places: np.ndarray, idf: np.ndarray,
    sublinear: bool, unit: bool,
) -> DataFrame:
    """Only terms of the vocabulary are counted: a word is a code, a pair the number of two codes."""
    parts = pc.split_pattern(terms, " ")
    is_pair = parts.value_lengths().to_numpy() == 2
    names = parts.flatten().unique()
    codes = pc.index_in(parts.flatten(), value_set=names).to_numpy().astype(np.int64)
    first = np.cumsum(1 + is_pair) - 1 - is_pair
    keys = codes[first] * (len(names) + 1)
    keys[is_pair] += codes[first[is_pair] + 1] + 1
    order = np.argsort(keys)
    keys, place_of = keys[order], places[order].astype(np.int64)
    idf_of, width = np.zeros(int(places.max(initial=-1)) + 1), int(places.max(initial=-1)) + 1
    idf_of[places] = idf

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for piece in _pieces(batch.column(batch.num_columns - 1)):
                part = batch.slice(piece.start, piece.stop - piece.start)
                row, code, at = _coded(part.column(part.num_columns - 1), names)
                alone = np.flatnonzero(code >= 0)
                row = np.concatenate([row[alone], row[at]])
                key = np.concatenate([code[alone] * (len(names) + 1), code[at] * (len(names) + 1) + code[at + 1] + 1])
                found = np.searchsorted(keys, key).clip(max=max(len(keys) - 1, 0))
                hit = keys[found] == key if len(keys) else np.zeros(0, bool)
                entries, n = _distinct(row[hit] * width + place_of[found[hit]])
                rows, place = np.divmod(entries, max(width, 1))
                features = _weights(part.num_rows, rows, place, n.astype(float), idf_of[place], sublinear, unit)
                yield pa.RecordBatch.from_arrays([*part.columns[:-1], features], [row_id, *others, "features"])

    rows = words.select(row_id, *others, "words")
    return rows.mapInArrow(run, _features_schema(rows))


def _joined(
    terms: DataFrame, vocabulary: DataFrame, row_id: str, others: list[str], config: TfidfConfig, unit: bool = True
) -> DataFrame:
    """One shuffle on the document id; a document's terms leave the map side as one row of numbers."""
    side = _as_side(vocabulary.select("term", "idx", "idf"), config)
    entry = F.when(F.col("idx").isNotNull(), F.struct("idx", term_weight(config).alias("raw")))
    grouped = (
        terms.select(row_id, *others, F.inline_outer("terms"))
        .join(side, "term", "left")
        .groupBy(row_id, *others)
        .agg(F.sort_array(F.collect_list(entry)).alias("entries"), F.sum(entry["raw"] * entry["raw"]).alias("square"))
    )
    norm = F.sqrt("square") if unit else F.lit(1.0)
    features = F.transform(
        "entries", lambda e: F.struct(e["idx"].alias("idx"), (e["raw"] / norm).alias("weight"))
    )
    return grouped.select(row_id, *others, features.alias("features"))


def long_weights(features: DataFrame) -> DataFrame:
    """``(..., idx, weight)``: one row per document and vocabulary term."""
    others = [c for c in features.columns if c != "features"]
    return features.select(*others, F.inline("features"))


def with_terms(weights: DataFrame, vocabulary: DataFrame, config: TfidfConfig = STANDARD) -> DataFrame:
    """Add the ``term`` of every ``idx``."""
    return weights.join(_as_side(vocabulary.select("idx", "term"), config), "idx")


def to_vectors(features: DataFrame, size: int) -> DataFrame:
    """Feature arrays as sparse ML vectors.

    The table is written in the physical layout of the vector type and read back
    under that type, so no row passes through Python. Iterative fits then read
    the written table.
    """
    others = [c for c in features.columns if c != "features"]
    layout = F.struct(
        F.lit(0).cast("byte").alias("type"),
        F.lit(size).cast("int").alias("size"),
        F.transform("features", lambda e: e["idx"].cast("int")).alias("indices"),
        F.transform("features", lambda e: e["weight"]).alias("values"),
    )
    table = features.select(*others, layout.alias("features"))
    kept = [f for f in table.schema.fields if f.name != "features"]
    return materialize(table, "vectors", StructType([*kept, StructField("features", VectorUDT())]))


def class_weights(df: DataFrame, category: str) -> DataFrame:
    """Balanced weights ``n / (K * n_c)``."""
    counts = df.dropna(subset=[category]).groupBy(category).agg(F.count(F.lit(1)).alias("n"))
    whole = counts.agg(F.struct(F.sum("n").alias("rows"), F.count(F.lit(1)).alias("classes"))).scalar()
    weight = F.col("whole.rows").cast("double") / (F.col("whole.classes") * F.col("n"))
    return counts.withColumn("whole", whole).select(category, "n", weight.alias("weight"))
