"""Streaming scoring of landing rows or files."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from docsift.operators import classify as C
from docsift.plans.scoring import checked_inputs, history_entries, score_documents
from docsift.sources.files import extract_text
from docsift.sources.store import materialize
from docsift.streaming.history import append_batch

INPUT_SCHEMA = "doc_id BIGINT, filename STRING, text STRING, received TIMESTAMP"


def landing_rows(spark: SparkSession, path: str, max_files: int = 1000) -> DataFrame:
    """JSON rows ``(doc_id, filename, text, received)`` as a stream."""
    return spark.readStream.schema(INPUT_SCHEMA).option("maxFilesPerTrigger", max_files).json(path)


def landing_files(spark: SparkSession, path: str, max_files: int = 1000, handlers=None) -> DataFrame:
    """Files of mixed formats as a stream of input rows; the id is a path hash."""
    schema = "path STRING, modificationTime TIMESTAMP, length BIGINT, content BINARY"
    files = (
        spark.readStream.format("binaryFile")
        .schema(schema)
        .option("maxFilesPerTrigger", max_files)
        .option("recursiveFileLookup", True)
        .load(path)
    )
    named = files.withColumn("filename", F.element_at(F.split("path", "/"), -1))
    texts = extract_text(named, handlers)
    return texts.select(
        F.xxhash64("path").alias("doc_id"), "filename", "text", F.current_timestamp().alias("received")
    )


def score_stream(
    inputs: DataFrame,
    classic: C.NaiveBayes,
    advanced: Callable[[DataFrame], DataFrame],
    advanced_classes: list,
    history_path: str,
    quarantine_path: str,
    checkpoint: str,
    **trigger,
) -> StreamingQuery:
    """Score every micro-batch into the history; rejected rows go to quarantine.

    ``advanced`` maps checked rows to ``(doc_id, scores, y_pred)``. Each batch
    writes to its own folder, so replays after a failure stay exactly once.
    """

    def one_batch(batch: DataFrame, batch_id: int) -> None:
        received = batch.select("doc_id", "received")
        checked = materialize(checked_inputs(batch.select("doc_id", "filename", "text")), "stream-batch")
        scored = score_documents(checked, classic, advanced(checked), advanced_classes)
        entries = history_entries(scored.join(received, "doc_id"), F.col("received"))
        append_batch(entries, history_path, batch_id)
        rejected = checked.filter(F.col("status") == "rejected").select("doc_id", "filename", "reason", "text_preview")
        append_batch(rejected, quarantine_path, batch_id)

    return (
        inputs.writeStream.foreachBatch(one_batch)
        .option("checkpointLocation", checkpoint)
        .trigger(**(trigger or {"availableNow": True}))
        .start()
    )
