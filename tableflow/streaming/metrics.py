"""Feed metrics: per version from the log, and from a running query."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery, StreamingQueryListener

from tableflow.functions import cursor as C
from tableflow.operators import changes as CH
from tableflow.sources import log as L


def feed_metrics(
    spark: SparkSession, path: str, start: int, end: int | None = None, n_slots: int = 0,
    checkpoints: Mapping[int, C.Cursor] | None = None,
) -> DataFrame:
    """Per version: actions and bytes prepared for reading, rows where known, and files the checkpoints filter out."""
    last = L.latest_version(spark, path) if end is None else end
    parsed = L.actions(spark, path, start, last)
    acts = CH.route(L.file_actions(parsed).withColumn("is_full", F.lit(False)), n_slots)
    acts = acts.withColumn("keep", F.lit(True))
    if checkpoints:
        marked = C.resume_filter(acts, C.checkpoints_frame(spark, checkpoints)).select("version", "idx")
        acts = acts.drop("keep").join(
            marked.withColumn("keep", F.lit(True)), ["version", "idx"], "left"
        ).withColumn("keep", F.coalesce("keep", F.lit(False)))
    files = acts.groupBy("version").agg(
        F.count_if("keep").alias("files"),
        F.sum(F.when(F.col("keep"), F.coalesce("size", F.lit(0))).otherwise(0)).alias("bytes"),
        F.sum(F.when(F.col("keep"), F.coalesce("num_records", F.lit(0))).otherwise(0)).alias("rows"),
        F.count_if(~F.col("keep")).alias("filtered_files"),
    )
    heads = parsed.groupBy("version").agg(F.count("metaData").alias("schema_changes"))
    zero = F.lit(0).cast("bigint")
    return heads.join(files, "version", "left").select(
        "version",
        (F.coalesce("files", zero) + F.col("schema_changes")).alias("actions_prepared"),
        F.coalesce("files", zero).alias("files_prepared"),
        F.coalesce("bytes", zero).alias("bytes_prepared"),
        F.coalesce("rows", zero).alias("rows_prepared"),
        F.coalesce("filtered_files", zero).alias("files_filtered"),
        "schema_changes",
    )


def commit_metrics(spark: SparkSession, path: str) -> DataFrame:
    """Per version: data files added and removed."""
    return L.actions(spark, path).groupBy("version").agg(
        F.count("add").alias("data_files"), F.count("remove").alias("removed_files")
    )


def progress(query: StreamingQuery) -> dict[str, object]:
    """Latency and volume of the last micro-batch."""
    last = query.lastProgress
    if not last:
        return {}
    took = last["durationMs"]
    return {
        "batch": last["batchId"],
        "input_rows": last["numInputRows"],
        "list_ms": took.get("latestOffset", 0),
        "plan_ms": took.get("queryPlanning", 0),
        "read_and_write_ms": took.get("addBatch", 0),
        "total_ms": took.get("triggerExecution", 0),
    }


class ProgressLog(StreamingQueryListener):
    """Collects batch progress of all queries of a session; add with ``spark.streams.addListener``."""

    def __init__(self):
        self.batches: list[dict[str, object]] = []

    def onQueryStarted(self, event):
        pass

    def onQueryProgress(self, event):
        p = event.progress
        self.batches.append({"query": p.name, "batch": p.batchId, "rows": p.numInputRows,
                             "total_ms": p.durationMs.get("triggerExecution", 0)})

    def onQueryTerminated(self, event):
        pass
