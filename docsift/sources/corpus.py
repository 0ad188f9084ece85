"""Reading labelled corpora."""

from __future__ import annotations

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import Window as W
from pyspark.sql import functions as F
from pyspark.sql.types import StringType, StructField, StructType

from docsift.sources.store import broadcast_within, materialize

CORPUS_SCHEMA = StructType(
    [StructField("Category", StringType()), StructField("Resume", StringType())]
)


def read_corpus_csv(
    spark: SparkSession, path: str, schema: StructType = CORPUS_SCHEMA
) -> DataFrame:
    """CSV with quoted, multi-line text. One file is one task: for large files
    take ``read_large_csv``."""
    return (
        spark.read.schema(schema)
        .option("header", True)
        .option("multiLine", True)
        .option("quote", '"')
        .option("escape", '"')
        .csv(path)
    )


CHUNK_CHARS = 1 << 20
MAX_BROADCAST_BLOCKS = 1_000_000
_CHUNK = "file string, block long, chunk long, before int, quotes int, text string"
_PIECE = "file string, block long, chunk long, first boolean, continues boolean, opens boolean, text string"


def _chunks(lines: DataFrame, chars: int) -> DataFrame:
    """Lines of one file block in chunks of about ``chars``, with the parity of the
    quotes in the chunk and of those before it in its block."""

    def cut(batches):
        at, number, before, quotes, held, size = None, 0, 0, 0, [], 0

        def chunk():
            row = dict(zip(("file", "block"), at), chunk=number, before=before, quotes=quotes, text="\n".join(held))
            return pa.RecordBatch.from_pylist([row], schema)

        schema = pa.schema(
            [("file", pa.string()), ("block", pa.int64()), ("chunk", pa.int64()), ("before", pa.int32()),
             ("quotes", pa.int32()), ("text", pa.string())]
        )
        for batch in batches:
            for file, block, line in zip(*(c.to_pylist() for c in batch.columns)):
                if held and ((file, block) != at or size >= chars):
                    yield chunk()
                    number, before, quotes, held, size = number + 1, before ^ quotes, 0, [], 0
                if (file, block) != at:
                    at, number, before = (file, block), 0, 0
                held.append(line)
                size += len(line) + 1
                quotes ^= line.count('"') & 1
        if held:
            yield chunk()

    return lines.mapInArrow(cut, _CHUNK)


def _pieces(chunks: DataFrame) -> DataFrame:
    """Chunks cut at the line ends outside quotes. A piece that ``continues`` began
    in an earlier chunk; one that ``opens`` goes on in a later one."""

    def cut(batches):
        schema = pa.schema(
            [("file", pa.string()), ("block", pa.int64()), ("chunk", pa.int64()), ("first", pa.bool_()),
             ("continues", pa.bool_()), ("opens", pa.bool_()), ("text", pa.string())]
        )
        for batch in batches:
            for row in batch.to_pylist():
                quoted = row["start"] ^ row["before"]
                continues, held, found = bool(quoted), [], []
                top = row["block"] == 0 and row["chunk"] == 0
                place = {k: row[k] for k in ("file", "block", "chunk")}
                for line in row["text"].split("\n"):
                    held.append(line)
                    quoted ^= line.count('"') & 1
                    if not quoted:
                        found.append((continues, False, "\n".join(held)))
                        continues, held = False, []
                if held:
                    found.append((continues, not continues, "\n".join(held)))
                rows = [
                    dict(place, first=top and not i, continues=c, opens=o, text=t) for i, (c, o, t) in enumerate(found)
                ]
                yield pa.RecordBatch.from_pylist(rows, schema)

    return chunks.mapInArrow(cut, _PIECE)


def _spanning(pieces: DataFrame) -> DataFrame:
    """``(first, text)`` of the records that lie in several chunks.

    A piece belongs to the last opening one before it: in its block by a window,
    else in an earlier block by a window over one row per block.
    """
    parts = pieces.filter("continues OR opens").withColumn("opener", F.when(F.col("opens"), F.struct("block", "chunk")))
    in_block = W.partitionBy("file", "block").orderBy("chunk", "opens").rowsBetween(W.unboundedPreceding, W.currentRow)
    earlier = W.partitionBy("file").orderBy("block").rowsBetween(W.unboundedPreceding, -1)
    blocks = parts.groupBy("file", "block").agg(F.max("opener").alias("last"))
    blocks = blocks.select("file", "block", F.max("last").over(earlier).alias("earlier"))
    owned = parts.withColumn("near", F.last("opener", ignorenulls=True).over(in_block)).join(blocks, ["file", "block"])
    texts = F.sort_array(F.collect_list(F.struct("block", "chunk", "text")))
    return (
        owned.groupBy("file", F.coalesce("near", "earlier").alias("owner"))
        .agg(F.array_join(F.transform(texts, lambda t: t["text"]), "\n").alias("text"), F.max("first").alias("first"))
        .select("first", "text")
    )


def read_large_csv(
    spark: SparkSession, path: str, schema: StructType = CORPUS_SCHEMA, chunk_chars: int = CHUNK_CHARS
) -> DataFrame:
    """CSV with a header and quoted, multi-line text; every file is read by many tasks.

    Each file block reports the parity of its quotes; a prefix over the blocks
    tells which line ends are outside quotes, and records are put together across
    blocks. The chunks are written once, so later steps see the same blocks.
    Quotes must be doubled within quoted fields and stand nowhere else (RFC 4180).
    Empty lines give no row; a quote that is never closed takes the rest of its file.
    """
    lines = spark.read.option("lineSep", "\n").text(path)
    placed = lines.select(
        F.col("_metadata.file_path").alias("file"), F.col("_metadata.file_block_start").alias("block"), "value"
    )
    chunks = materialize(_chunks(placed, chunk_chars), "csv-chunks")
    before = W.partitionBy("file").orderBy("block").rowsBetween(W.unboundedPreceding, -1)
    blocks = chunks.groupBy("file", "block").agg(F.sum("quotes").alias("quotes"))
    start = (F.coalesce(F.sum("quotes").over(before), F.lit(0)) % 2).cast("int")
    starts = materialize(blocks.select("file", "block", start.alias("start")), "csv-blocks")
    states = chunks.join(broadcast_within(starts, MAX_BROADCAST_BLOCKS), ["file", "block"])
    pieces = materialize(_pieces(states), "csv-pieces")
    whole = pieces.filter("NOT continues AND NOT opens").select("first", "text")
    records = whole.unionByName(_spanning(pieces)).filter(~F.col("first"))
    text = F.regexp_replace("text", "\r$", "")
    options = {"quote": '"', "escape": '"', "multiLine": "true"}
    parsed = records.select(text.alias("text")).filter("text <> ''")
    return parsed.select(F.from_csv("text", schema.toDDL(), options).alias("row")).select("row.*")


def require_corpus(
    df: DataFrame, columns: tuple[str, ...] = ("Category", "Resume"), more_than: int = 100
) -> DataFrame:
    """Return ``df`` when it has the columns and more than ``more_than`` rows."""
    missing = [c for c in columns if c not in df.columns]
    if missing:
        raise ValueError(f"corpus lacks columns {missing}")
    if df.select(*columns).limit(more_than + 1).count() <= more_than:
        raise ValueError(f"corpus needs more than {more_than} rows")
    return df
