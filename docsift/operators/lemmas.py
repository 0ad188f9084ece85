"""Noun lemmas as table work: distinct tokens, candidate stems, lexicon check."""

from __future__ import annotations

import sys

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.cloudpickle import register_pickle_by_value
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from docsift.functions.text import PROTECTED
from docsift.sources.store import materialize, within

register_pickle_by_value(sys.modules[__name__])

# Public noun suffix rules of the WordNet morphology.
NOUN_RULES = [
    ("s", ""), ("ses", "s"), ("ves", "f"), ("xes", "x"), ("zes", "z"),
    ("ches", "ch"), ("shes", "sh"), ("men", "man"), ("ies", "y"),
]
MAX_BROADCAST_LEMMAS = 500_000
LEMMAS_OF_ROW = "__lemmas_of_row"


def stems(token: Column) -> Column:
    """Candidate stems of one token, in rule order."""
    candidates = [
        F.when(
            F.endswith(token, F.lit(suffix)) & (F.length(token) > len(suffix)),
            F.concat(F.substring(token, F.lit(1), F.length(token) - len(suffix)), F.lit(ending)),
        )
        for suffix, ending in NOUN_RULES
    ]
    return F.array_compact(F.array(*candidates))


def _counted_map(tokens: DataFrame, lexicon: DataFrame | None) -> DataFrame:
    """``(token, lemma, n)`` for tokens that change; ``n`` counts rows of ``tokens``."""
    counts = tokens.groupBy("token").agg(F.count(F.lit(1)).alias("n"))
    vocabulary = materialize(counts, "vocabulary")
    words = vocabulary.filter(~F.col("token").isin(PROTECTED))
    terms = lexicon.select("term").distinct() if lexicon is not None else vocabulary.select(F.col("token").alias("term"))
    forms = words.select("token", "n", F.explode(F.concat(F.array("token"), stems(F.col("token")))).alias("term"))
    accepted = forms.join(terms, "term", "left_semi")
    order = F.struct(F.length("term"), F.col("term"))
    found = accepted.groupBy("token").agg(F.min_by("term", order).alias("lemma"), F.max("n").alias("n"))
    return found.filter(F.col("token") != F.col("lemma"))


def lemma_map(tokens: DataFrame, lexicon: DataFrame | None = None) -> DataFrame:
    """``(token, lemma)`` for tokens that change, from a table with a ``token`` column.

    A stem counts when the lexicon (one column ``term``; by default the tokens
    themselves) holds it. The shortest accepted form wins, then the lowest.
    """
    return _counted_map(tokens, lexicon).drop("n")


def _changes(pairs: DataFrame, lemmas: DataFrame) -> DataFrame:
    """The pairs whose token has a lemma, where there are too many lemmas for a broadcast.

    The most frequent lemmas are broadcast. A token outside the first
    ``MAX_BROADCAST_LEMMAS`` is in at most that part of all pairs, so the rest
    joins by shuffle without a hot key.
    """
    hot = materialize(lemmas.orderBy(F.desc("n"), "token").limit(MAX_BROADCAST_LEMMAS), "hot-lemmas")
    rest = lemmas.join(hot, "token", "left_anti")
    return pairs.join(F.broadcast(hot), "token").unionByName(pairs.join(rest, "token"))


def _replaced(tokens: pa.ListArray, names: pa.Array, lemmas: pa.Array) -> pa.ListArray:
    """Token arrays with the lemma of every token that has one."""
    words = tokens.flatten()
    found = pc.index_in(words, value_set=names)
    changed = pc.if_else(found.is_valid(), lemmas.take(found), words)
    lengths = tokens.value_lengths().fill_null(0).to_numpy(zero_copy_only=False)
    offsets = pa.array(np.append(0, np.cumsum(lengths)).astype(np.int32))
    return pa.ListArray.from_arrays(offsets, changed, mask=tokens.is_null())


def _in_place(df: DataFrame, row_id: str, tokens: str, lemmas: DataFrame) -> DataFrame:
    """Lemmas that fit a broadcast go to every task; only the tokens visit Python and nothing is shuffled."""
    known = lemmas.select("token", "lemma").toArrow().combine_chunks()
    sent = df.sparkSession.sparkContext.broadcast([known[c].combine_chunks() for c in ("token", "lemma")])

    @F.arrow_udf("array<string>")
    def lemmas_of(held: pa.Array) -> pa.Array:
        return _replaced(held, *sent.value)

    return df.withColumn(tokens, F.when(F.col(row_id).isNull(), F.col(tokens)).otherwise(lemmas_of(tokens)))


def lemmatize(df: DataFrame, row_id: str, tokens: str = "tokens", lexicon: DataFrame | None = None) -> DataFrame:
    """``df`` with lemmas in place of its ``tokens``; other columns stay.

    Reads ``df`` several times: pass a written table, or columns that are cheap to make
    from one. Up to ``MAX_BROADCAST_LEMMAS`` lemmas go to every task; beyond, tokens that
    change are grouped as a small map per row id. The array is rewritten in place.
    Rows that share an id share a map; null, empty and null-id rows stay as they are.
    """
    pairs = df.filter(F.col(row_id).isNotNull()).select(row_id, F.explode(F.array_distinct(tokens)).alias("token"))
    lemmas = materialize(_counted_map(pairs, lexicon), "lemmas")
    if within(lemmas, MAX_BROADCAST_LEMMAS):
        return _in_place(df, row_id, tokens, lemmas)
    entry = F.struct("token", "lemma")
    maps = _changes(pairs, lemmas).groupBy(row_id).agg(F.map_from_entries(F.collect_set(entry)).alias(LEMMAS_OF_ROW))
    found = F.col(LEMMAS_OF_ROW)
    changed = F.transform(tokens, lambda t: F.coalesce(F.try_element_at(found, t), t))
    joined = df.join(maps, row_id, "left")
    return joined.withColumn(tokens, F.when(found.isNull(), F.col(tokens)).otherwise(changed)).select(*df.columns)
