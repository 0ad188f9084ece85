"""Array Columns that keep per-document work inside the row, so it needs no shuffle."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def bind(value: Column, body: Callable[[Column], Column]) -> Column:
    """Evaluate ``value`` once per row and hand it to ``body``.

    Inside a higher-order function an outer expression is evaluated again for
    every element; a lambda variable is not.
    """
    return F.transform(F.array(value), body)[0]


def settle(df: DataFrame, **columns: Column) -> DataFrame:
    """Add computed columns behind a one-row generator.

    Filters and projections above are not rewritten in terms of the expressions,
    so an expensive column (text cleaning) is computed exactly once per row.
    """
    packed = F.array(F.struct(*[c.alias(name) for name, c in columns.items()]))
    kept = [c for c in df.columns if c not in columns]
    return df.select(*kept, F.inline(packed))


def no_strings() -> Column:
    return F.array().cast("array<string>")


def ngrams(tokens: Column, low: int = 1, high: int = 2) -> Column:
    """All word n-grams with ``low <= n <= high`` in one array, shortest first."""

    def of_length(t: Column, n: int) -> Column:
        if n == 1:
            return t
        count = F.size(t) - F.lit(n - 1)
        joined = F.slice(t, 1, F.greatest(count, F.lit(0)))
        for k in range(1, n):
            shifted = F.slice(t, k + 1, F.greatest(count, F.lit(0)))
            joined = F.zip_with(joined, shifted, lambda a, b: F.concat(a, F.lit(" "), b))
        return F.when(count > 0, joined).otherwise(no_strings())

    return bind(tokens, lambda t: F.concat(*[of_length(t, n) for n in range(low, high + 1)]))


def _run_starts(ordered: Column, value) -> Column:
    """Indices where a new value begins in a sorted, non-empty array."""
    return F.filter(
        F.sequence(F.lit(0), F.size(ordered) - 1),
        lambda i: (i == 0) | (value(F.get(ordered, i)) != value(F.get(ordered, i - 1))),
    )


def _runs(ordered: Column, value, entry) -> Column:
    def counted(starts: Column) -> Column:
        def one(i: Column, j: Column) -> Column:
            n = F.coalesce(F.get(starts, j + 1), F.size(ordered)) - i
            return entry(F.get(ordered, i), n)

        return F.transform(starts, one)

    return bind(_run_starts(ordered, value), counted)


def term_counts(tokens: Column) -> Column:
    """Distinct tokens of one row as ``array<struct<term, n>>``, ordered by term.

    Sort and run boundaries replace the usual explode + groupBy(document, term),
    which would shuffle every token.
    """
    empty = F.array().cast("array<struct<term:string,n:int>>")

    def entry(term: Column, n: Column) -> Column:
        return F.struct(term.alias("term"), n.alias("n"))

    return bind(
        F.sort_array(tokens),
        lambda s: F.when(F.size(s) > 0, _runs(s, lambda x: x, entry)).otherwise(empty),
    )


def top_terms(tokens: Column, k: int) -> Column:
    """The ``k`` most frequent tokens of one row; ties go to the earlier first position."""
    empty = F.array().cast("array<struct<rank:int,pos:int,term:string>>")
    placed = F.transform(tokens, lambda x, i: F.struct(x.alias("term"), i.alias("pos")))

    def entry(first: Column, n: Column) -> Column:
        return F.struct((-n).alias("rank"), first["pos"].alias("pos"), first["term"].alias("term"))

    ranked = bind(
        F.sort_array(placed),
        lambda s: F.when(F.size(s) > 0, _runs(s, lambda x: x["term"], entry)).otherwise(empty),
    )
    return F.transform(F.slice(F.sort_array(ranked), 1, k), lambda e: e["term"])
