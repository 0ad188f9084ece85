"""What the operators share: tables, free column names, running totals, labelled samples."""

from __future__ import annotations

from collections.abc import Iterator, Sequence
from dataclasses import dataclass

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from docsift.sources.store import materialize, within

WORD = r"[^\x20\x09-\x0D]+"
FOLDS = 5


def read(spark: SparkSession, sf_dir: str, table: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{table}.parquet")


def free_name(columns: Sequence[str], name: str) -> str:
    """``name``, lengthened until no column has it."""
    taken = {c.lower() for c in columns}
    while name.lower() in taken:
        name += "_"
    return name


def text_or_empty(column: str) -> Column:
    return F.coalesce(F.col(column), F.lit(""))


def n_words(column: str) -> Column:
    """Words between ASCII white space, as a long; null counts as no text."""
    return F.coalesce(F.regexp_count(F.col(column), F.lit(WORD)), F.lit(0)).cast("long")


def group_key(column: str) -> Column:
    """A non-null string that orders as the column does by code point, null last."""
    return F.coalesce(F.concat(F.lit("0"), F.col(column).cast("string")), F.lit("1"))


def held_out(doc_id: str) -> Column:
    """Whether a document belongs to the fold that no model may learn from."""
    return F.coalesce(F.crc32(F.col(doc_id).cast("string")) % FOLDS == 0, F.lit(False))


def running_totals(
    df: DataFrame,
    values: Sequence[str],
    order: Sequence[str],
    groups: Sequence[str] = (),
    per_group: DataFrame | None = None,
) -> DataFrame:
    """Add ``before_v`` (sum of ``v`` over all earlier rows) and ``all_v`` for every value.

    Rows are range-partitioned by group and order and written with the number of
    their range; sums per range are small and give each range its start, so not
    even one group with every row meets in a single task. ``per_group`` adds its
    columns by joining those small sums. ``groups`` must not be null; rows equal
    in ``order`` take an arbitrary order among themselves.
    """
    rows = materialize(
        df.repartitionByRange(*groups, *order).withColumn("range_no", F.spark_partition_id()), "ordered"
    )
    ranges = rows.groupBy("range_no", *groups).agg(*[F.sum(v).alias(v) for v in values])
    whole = W.partitionBy(*groups)
    earlier = whole.orderBy("range_no").rowsBetween(W.unboundedPreceding, -1)
    starts = ranges.select(
        "range_no",
        *groups,
        *[F.coalesce(F.sum(v).over(earlier), F.lit(0)).alias(f"start_{v}") for v in values],
        *[F.sum(v).over(whole).alias(f"all_{v}") for v in values],
    )
    if per_group is not None:
        starts = starts.join(per_group, list(groups))
    inside = W.partitionBy("range_no", *groups).orderBy(*order).rowsBetween(W.unboundedPreceding, -1)
    before = {
        f"before_{v}": F.col(f"start_{v}") + F.coalesce(F.sum(v).over(inside), F.lit(0)) for v in values
    }
    joined = rows.join(starts, ["range_no", *groups]).withColumns(before)
    return joined.drop("range_no", *[f"start_{v}" for v in values])


def join_lookup(df: DataFrame, lookup: DataFrame, key: str, rows: int = 100_000, salts: int = 32) -> DataFrame:
    """Join a table with one row per ``key``, whose keys may be hot in ``df``.

    A lookup of at most ``rows`` rows is broadcast; a larger one is repeated
    ``salts`` times, so that the rows of a hot key spread over as many tasks.
    """
    if within(lookup, rows):
        return df.join(F.broadcast(lookup), key)
    salt = free_name([*df.columns, *lookup.columns], "salt")
    salted = lookup.withColumn(salt, F.explode(F.sequence(F.lit(0), F.lit(salts - 1))))
    spread = df.withColumn(salt, F.pmod(F.xxhash64(*df.columns), F.lit(salts)).cast("int"))
    return spread.join(salted, [key, salt]).drop(salt)


def repeat_rows(df: DataFrame, times: Column) -> DataFrame:
    """Every row ``times`` times, in two steps so that no array is long."""
    step = 10_000
    name = free_name(df.columns, "chunk")
    chunks = F.sequence(F.lit(0).cast("long"), F.ceil(times / step).cast("long") - 1)
    many = df.withColumn(name, F.explode(F.when(times > 0, chunks)))
    left = F.least(F.lit(step).cast("long"), times - F.col(name) * step).cast("int")
    return many.withColumn(name, F.explode(F.array_repeat(F.lit(0), left))).drop(name)


@dataclass(frozen=True)
class Sample:
    """``(text, label)`` rows, and the share of label 1 among all labelled documents."""

    rows: list[tuple[str, int]]
    share: float


def labelled_sample(
    documents: DataFrame,
    labels: DataFrame,
    label: str,
    per_label: int,
    max_chars: int,
    id_col: str = "doc_id",
    text_col: str = "text",
    seed: int = 0,
) -> Sample:
    """A bounded sample outside the held-out fold, to fit a model on.

    At most ``per_label`` ids of either label come in hash order; documents of
    over ``max_chars`` characters are left out of the fit. Ids with contradicting
    labels are not used.
    """
    ids = (
        labels.filter(F.col(id_col).isNotNull() & F.col(label).isin(0, 1) & ~held_out(id_col))
        .groupBy(F.col(id_col).alias("id"))
        .agg(F.min(label).cast("int").alias("low"), F.max(label).cast("int").alias("high"))
        .filter("low = high")
        .withColumn("h", F.md5(F.concat(F.lit(f"{seed}:"), F.col("id").cast("string"))))
    )
    share = ids.agg(F.avg("low")).first()[0]
    chosen = [ids.filter(F.col("low") == y).orderBy("h", "id").limit(per_label) for y in (0, 1)]
    rows = (
        documents.select(F.col(id_col).alias("id"), text_or_empty(text_col).alias("text"))
        .filter(F.length("text") <= max_chars)
        .join(F.broadcast(chosen[0].unionAll(chosen[1])), "id")
        .dropDuplicates(["id"])
        .select("text", "low", "h")
        .collect()
    )
    ordered = sorted(rows, key=lambda r: (r["h"], r["text"]))
    return Sample([(r["text"], r["low"]) for r in ordered], 0.5 if share is None else share)


def texts(batch: pa.RecordBatch, column: int | str) -> list[str]:
    return [t or "" for t in batch.column(column).to_pylist()]


def pieces(items: Sequence[str], chars: int) -> Iterator[slice]:
    """Slices of ``items`` of about ``chars`` characters, to bound what one step holds."""
    start = held = 0
    for i, item in enumerate(items):
        held += len(item)
        if held >= chars:
            yield slice(start, i + 1)
            start, held = i + 1, 0
    if start < len(items):
        yield slice(start, len(items))
