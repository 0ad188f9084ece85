"""Shards as runs of a Hilbert curve through document metadata, with DataFrame functions only.

Language, source and size are cut into cells, the cells of a document are one
point of a cube, and documents are ordered by the position of that point on the
Hilbert curve. Cutting the order into runs gives shards whose files cover small
boxes of the cube, so a filter on any of the dimensions skips most of them.

Defined results: null text has size 1 and the checksum of no bytes, null language
and source order last; rows equal in all columns take an arbitrary order among
themselves; an empty table gives no rows. With fewer documents than shards the
last shards stay empty.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from docsift.llm.common import group_key, join_lookup, running_totals, text_or_empty
from docsift.sources.store import materialize

SHARDS = 16
BITS = 8


def _turn(value: int, by: int, width: int) -> int:
    """Rotate the low ``width`` bits to the left."""
    by %= width
    return ((value << by) | (value >> (width - by))) & ((1 << width) - 1)


def curve_steps(dims: int) -> list[int]:
    """The curve as an automaton: entry ``state * 2**dims + cell`` is ``next * 2**dims + rank``.

    A state is the corner at which the curve enters a cube and the axis along which
    it leaves. The parts of a cube are visited in Gray-code order, seen from there.
    """
    parts = 1 << dims

    def ones(i: int) -> int:  # trailing set bits
        return (~i & (i + 1)).bit_length() - 1

    def entry(rank: int) -> int:
        i = 2 * ((rank - 1) // 2) if rank else 0
        return i ^ (i >> 1)

    def axis(rank: int) -> int:
        return 0 if rank == 0 else ones(rank if rank % 2 else rank - 1) % dims

    steps = [0] * (dims * parts * parts)
    for corner in range(parts):
        for way in range(dims):
            for rank in range(parts):
                cell = _turn(rank ^ (rank >> 1), way + 1, dims) ^ corner
                next_corner = corner ^ _turn(entry(rank), way + 1, dims)
                following = next_corner * dims + (way + axis(rank) + 1) % dims
                steps[(corner * dims + way) * parts + cell] = following * parts + rank
    return steps


def hilbert_index(cells: Sequence[Column], bits: int) -> Column:
    """Position on the curve of a point with coordinates of ``bits`` bits, as a long."""
    parts = 1 << len(cells)
    steps = F.array(*[F.lit(s) for s in curve_steps(len(cells))])
    digits = [F.lit(0).cast("int")] * bits
    for level in range(bits):
        digit = F.lit(0)
        for cell in cells:
            digit = digit * 2 + F.shiftright(cell.cast("int"), bits - 1 - level).bitwiseAND(F.lit(1))
        digits[level] = digit.cast("int")

    def follow(acc: Column, digit: Column) -> Column:
        step = F.element_at(steps, acc["state"] * parts + digit + 1)
        return F.struct(
            F.shiftright(step, len(cells)).cast("int").alias("state"),
            (acc["index"] * parts + step.bitwiseAND(F.lit(parts - 1))).cast("long").alias("index"),
        )

    start = F.struct(F.lit(0).cast("int").alias("state"), F.lit(0).cast("long").alias("index"))
    return F.aggregate(F.array(*digits), start, follow, lambda acc: acc["index"])


def size_cell(size: Column, bits: int = BITS) -> Column:
    """Eight cells for every doubling of the size, by its leading binary digits."""
    length = F.length(F.bin(size))
    below = F.when(length > 3, F.conv(F.substring(F.bin(size), 2, 3), 2, 10).cast("int")).otherwise(0)
    return F.least((length - 1) * 8 + below, F.lit((1 << bits) - 1)).cast("int")


def value_cells(df: DataFrame, key: str, cell: str, bits: int = BITS) -> DataFrame:
    """``(key, cell)``: cells in the order of the values, each of about as many rows."""
    counts = df.groupBy(key).agg(F.count(F.lit(1)).alias("n"))
    placed = running_totals(counts, ["n"], [key])
    place = F.floor(F.col("before_n") * (1 << bits) / F.col("all_n")).cast("int")
    return materialize(placed.select(key, place.alias(cell)), "cells")


def hilbert_shards(
    documents: DataFrame,
    shards: int = SHARDS,
    law: str = "rows",
    id_col: str = "doc_id",
    text_col: str = "text",
    lang_col: str = "lang",
    source_col: str = "source",
) -> DataFrame:
    """``(doc_id, size, text_crc32, law, hilbert, lang_cell, source_cell, size_cell, shard, slot)``.

    ``law`` is ``rows`` (shards differ by one row at most) or ``bytes`` (a document
    belongs where its middle byte falls). ``slot`` counts from 0 along the curve.
    """
    if law not in ("rows", "bytes"):
        raise ValueError(f"law is rows or bytes, not {law}")
    text = text_or_empty(text_col)
    rows = documents.select(
        F.col(id_col).alias("doc_id"),
        (F.octet_length(text) + 1).cast("long").alias("size"),
        F.crc32(text).alias("text_crc32"),
        group_key(lang_col).alias("lang_key"),
        group_key(source_col).alias("source_key"),
    )
    rows = materialize(rows, "metadata")
    for name in ("lang", "source"):
        rows = join_lookup(rows, value_cells(rows, f"{name}_key", f"{name}_cell"), f"{name}_key")
    rows = rows.withColumn("size_cell", size_cell(F.col("size")))
    cells = [F.col(c) for c in ("lang_cell", "source_cell", "size_cell")]
    rows = rows.withColumn("hilbert", hilbert_index(cells, BITS)).withColumn("one", F.lit(1).cast("long"))
    rows = materialize(rows.drop("lang_key", "source_key"), "points")
    values = ["one"] if law == "rows" else ["one", "size"]
    placed = running_totals(rows, values, ["hilbert", "text_crc32", "doc_id", "size"])
    at = F.col("before_one")
    if law == "rows":
        few = F.call_function("div", F.col("all_one"), F.lit(shards).cast("long"))
        larger = F.col("all_one") % shards
        edge = larger * (few + 1)
        here = at < edge
        each = F.when(here, few + 1).otherwise(F.greatest(few, F.lit(1)))
        beyond = F.when(here, at).otherwise(at - edge)
        shard = F.call_function("div", beyond, each) + F.when(here, 0).otherwise(larger)
        placed = placed.withColumns({"shard": shard.cast("int"), "slot": (beyond % each).cast("long")})
    else:
        middle = (F.col("before_size") + F.col("size") / 2) * shards / F.col("all_size")
        placed = placed.withColumn("shard", F.least(F.floor(middle), F.lit(shards - 1)).cast("int"))
        firsts = placed.groupBy("shard").agg(F.min("before_one").alias("first"))  # one row per shard
        placed = placed.join(F.broadcast(firsts), "shard").withColumn("slot", at - F.col("first"))
    return placed.select(
        "doc_id", "size", "text_crc32", F.lit(law).alias("law"), "hilbert", "lang_cell", "source_cell",
        "size_cell", "shard", "slot",
    )


def write_runs(rows: DataFrame, path: str) -> None:
    """Write rows with ``shard`` and ``slot``: every file is a run of the curve within one shard."""
    ordered = rows.repartitionByRange("shard", "slot").sortWithinPartitions("shard", "slot")
    ordered.write.partitionBy("shard").parquet(path)


def shard_boxes(assigned: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Rows, and smallest and largest value of every column, of each shard: what pruning reads."""
    found = [F.count(F.lit(1)).alias("n_rows")]
    for c in columns:
        found += [F.min(c).alias(f"min_{c}"), F.max(c).alias(f"max_{c}")]
    return assigned.groupBy("shard").agg(*found)
