"""Session settings and the shared work folder."""

from __future__ import annotations

import os
import uuid

from pyspark.sql import SparkSession

CHECKPOINT_DIR = "spark.checkpoint.dir"


def local_session(cores: int | str = "*", app: str = "docsift", **conf: str) -> SparkSession:
    """A local session for tests and benchmarks; clusters bring their own."""
    parallel = os.cpu_count() if cores == "*" else int(cores)
    builder = (
        SparkSession.builder.master(f"local[{cores}]")
        .appName(app)
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.driver.memory", "12g")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.sql.shuffle.partitions", str(parallel))
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.adaptive.coalescePartitions.parallelismFirst", "false")
        .config("spark.sql.adaptive.skewJoin.enabled", "true")
    )
    for key, value in conf.items():
        builder = builder.config(key, value)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def work_folder(spark: SparkSession) -> str:
    """The shared folder the cluster names in ``spark.checkpoint.dir``.

    Without one it is the warehouse, on a cluster only if that is no local folder.
    """
    folder = spark.conf.get(CHECKPOINT_DIR, None)
    if folder:
        return folder
    folder = spark.conf.get("spark.sql.warehouse.dir", None)
    scheme = folder.split(":", 1)[0] if folder and ":" in folder else "file"
    if not folder or (scheme == "file" and not spark.sparkContext.master.startswith("local")):
        raise RuntimeError(f"set {CHECKPOINT_DIR} to a folder every executor can reach")
    return folder


def new_path(spark: SparkSession, name: str) -> str:
    return f"{work_folder(spark).rstrip('/')}/docsift/{name}-{uuid.uuid4().hex}"
