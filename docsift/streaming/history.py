"""Append-only prediction history with a last-N view."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import Window as W
from pyspark.sql import functions as F

MAX_ITEMS = 100

ENTRY_SCHEMA = (
    "id BIGINT, timestamp TIMESTAMP, filename STRING, classic_category STRING, classic_confidence DOUBLE, "
    "classic_confidence_percentage STRING, advanced_category STRING, advanced_confidence DOUBLE, "
    "advanced_confidence_percentage STRING, agreement BOOLEAN, keywords ARRAY<STRING>, word_count INT"
)


def append_batch(entries: DataFrame, path: str, batch_id: int) -> None:
    """Write one batch to its own folder; a repeated batch replaces itself, so a
    restarted stream adds nothing twice."""
    entries.write.mode("overwrite").parquet(f"{path}/batch_id={batch_id}")


def read_history(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.schema(ENTRY_SCHEMA).option("basePath", path).option("recursiveFileLookup", True).parquet(path)


def latest(history: DataFrame, time: str = "timestamp", row_id: str = "id", n: int = MAX_ITEMS) -> DataFrame:
    """The last ``n`` entries, newest first."""
    return history.orderBy(F.desc(time), F.desc(row_id)).limit(n)


def latest_per(history: DataFrame, owner: str, time: str, row_id: str, n: int = MAX_ITEMS) -> DataFrame:
    """The last ``n`` entries of every owner; partitions are cut to ``n`` rows per
    owner before the shuffle."""
    order = W.partitionBy(owner).orderBy(F.desc(time), F.desc(row_id))
    return history.withColumn("place", F.row_number().over(order)).filter(F.col("place") <= n)


def clear(spark: SparkSession, path: str) -> None:
    """Replace the history by an empty table."""
    spark.createDataFrame([], ENTRY_SCHEMA).write.mode("overwrite").parquet(path)


def agreement_by_window(history: DataFrame, time: str, agreement: str, width: str, late: str | None = None) -> DataFrame:
    """Volume and agreement rate per tumbling window; ``late`` sets the watermark
    of a streaming input."""
    rows = history.withWatermark(time, late) if late else history
    return (
        rows.groupBy(F.window(time, width).alias("w"))
        .agg(
            F.count(F.lit(1)).alias("n"),
            F.avg(F.when(F.col(agreement), 1.0).otherwise(0.0)).alias("agreement_rate"),
        )
        .select(F.col("w.start").alias("window_start"), "n", "agreement_rate")
    )
