"""Tables, reports and models on shared storage."""

from __future__ import annotations

from pyspark.ml import PipelineModel
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from docsift.session import new_path


def materialize(df: DataFrame, name: str, schema: StructType | None = None) -> DataFrame:
    """Write ``df`` once to the shared work folder and go on from the files.

    This cuts lineage in a way that survives lost executors. ``schema`` may name
    another logical type with the same physical layout (ML vectors).
    """
    spark = df.sparkSession
    path = new_path(spark, name)
    df.write.parquet(path)
    return spark.read.schema(schema or df.schema).parquet(path)


def spread(df: DataFrame, key: str) -> DataFrame:
    """Hash-partition a scan that yields fewer splits than the cluster has cores.

    At scale a scan has more splits than cores and is returned as it is.
    """
    cores = df.sparkSession.sparkContext.defaultParallelism
    return df.repartition(cores, key) if df.rdd.getNumPartitions() < cores else df


def within(df: DataFrame, rows: int) -> bool:
    """Whether ``df`` has at most ``rows`` rows; stops counting just beyond."""
    return df.limit(rows + 1).count() <= rows


def broadcast_within(df: DataFrame, rows: int) -> DataFrame:
    """Mark a checked small side for broadcast; a larger one joins by shuffle."""
    return F.broadcast(df) if within(df, rows) else df


def write_table(df: DataFrame, path: str, mode: str = "errorifexists") -> None:
    df.write.mode(mode).parquet(path)


def write_report_csv(df: DataFrame, path: str, mode: str = "errorifexists") -> None:
    df.write.mode(mode).option("header", True).option("escape", '"').csv(path)


def write_report_json(df: DataFrame, path: str, mode: str = "errorifexists") -> None:
    """Nested columns become nested JSON; nulls are written, not skipped."""
    df.write.mode(mode).option("ignoreNullFields", False).json(path)


def read_report_json(
    spark: SparkSession, path: str, schema: StructType | str | None = None, multi_line: bool = False
) -> DataFrame:
    reader = spark.read.option("multiLine", multi_line)
    return (reader.schema(schema) if schema is not None else reader).json(path)


def save_model(model: PipelineModel, path: str) -> None:
    model.write().overwrite().save(path)


def load_model(path: str) -> PipelineModel:
    return PipelineModel.load(path)


def artifact_size(spark: SparkSession, path: str) -> DataFrame:
    """Size of a file or folder tree in MiB; file contents are never read."""
    files = (
        spark.read.format("binaryFile").option("recursiveFileLookup", True).load(path).select("length")
    )
    return files.agg((F.coalesce(F.sum("length"), F.lit(0)) / F.lit(1048576.0)).alias("size_mb"))
