"""Spark session and working-folder helpers."""

from __future__ import annotations

import os
import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession


def new_session(
    app: str = "tableflow",
    master: str | None = None,
    shuffle_partitions: int | None = None,
    driver_memory: str | None = None,
) -> SparkSession:
    """A session with the settings the library is tuned for.

    AQE does the run-time work here: it splits skewed join and rebalance partitions and merges small ones.
    """
    b = (
        SparkSession.builder.appName(app)
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.adaptive.skewJoin.enabled", "true")
        .config("spark.sql.adaptive.optimizeSkewsInRebalancePartitions.enabled", "true")
        .config("spark.ui.enabled", "false")
    )
    if master:
        b = b.master(master)
    if shuffle_partitions:
        b = b.config("spark.sql.shuffle.partitions", str(shuffle_partitions))
    if driver_memory:
        b = b.config("spark.driver.memory", driver_memory)
    return b.getOrCreate()


def work_root(spark: SparkSession) -> str:
    """The shared folder for written intermediate tables.

    It is the one the cluster names in ``spark.checkpoint.dir``. Only a local session, where driver and tasks
    share one machine, may fall back to a temporary folder.
    """
    named = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getConf().get("spark.checkpoint.dir")
    if named:
        return named.rstrip("/")
    if not spark.sparkContext.master.startswith("local"):
        raise RuntimeError("set spark.checkpoint.dir to a folder that every executor can reach")
    root = os.path.join(tempfile.gettempdir(), f"tableflow-{spark.sparkContext.applicationId}")
    os.makedirs(root, exist_ok=True)
    return root


def fresh_path(spark: SparkSession, name: str) -> str:
    """A path under the work root that nothing uses yet (not created)."""
    return f"{work_root(spark)}/{name}-{uuid.uuid4().hex[:12]}"


def pinned(df: DataFrame, name: str) -> DataFrame:
    """The same rows, computed once and written to the work root.

    Cuts the lineage before rows are used by several jobs, survives lost executors and gives Spark real sizes.
    """
    spark = df.sparkSession
    path = fresh_path(spark, name)
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)
