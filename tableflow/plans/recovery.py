"""What failed tries leave behind: data files whose commit never reached the log.

Files become visible by their log entry only, so such files are harmless, but they stay. The log is reconciled with the
commit folders on disk by an anti-join. A writer that is still at work has folders of this kind too, so only those older
than a given age are looked at.
"""

from __future__ import annotations

import time

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tableflow import storage
from tableflow.sources import log as L

#: Longer than any write takes.
AGE_S = 24 * 3600
_FOLDER = f"{L.DATA_COMMIT}="


def published(spark: SparkSession, path: str) -> DataFrame:
    """(token) of every commit folder that the log names in an added file."""
    disk = F.expr(storage.disk_path("path"))
    token = F.regexp_extract(disk, f"^{_FOLDER}([^/]+)/", 1)
    return L.file_actions(L.actions(spark, path)).select(token.alias("token")).where("token <> ''").distinct()


def orphans(spark: SparkSession, path: str, older_than_s: float = AGE_S, now: float | None = None) -> DataFrame:
    """(token, files, bytes, last_ms) of the commit folders that no log entry names, the last file being old enough."""
    path = path.rstrip("/")
    empty = "token string, files bigint, bytes bigint, last_ms bigint"
    if not storage.any_like(spark, path, _FOLDER):
        return spark.createDataFrame([], empty)
    files = (
        storage.reader(spark, path).format("binaryFile").option("recursiveFileLookup", "true")
        .load(f"{storage.glob_safe(path)}/{_FOLDER}*").select("path", "length", "modificationTime")
    )
    token = F.regexp_extract(F.expr("try_url_decode(replace(path, '+', '%2B'))"), f"/{_FOLDER}([^/]+)/", 1)
    folders = files.groupBy(token.alias("token")).agg(
        F.count(F.lit(1)).alias("files"), F.sum("length").alias("bytes"), F.unix_millis(F.max("modificationTime")).alias("last_ms")
    )
    if L.table_exists(spark, path):
        folders = folders.join(published(spark, path), "token", "left_anti")
    limit = ((time.time() if now is None else now) - older_than_s) * 1000
    return folders.where(F.col("last_ms") <= int(limit))


def remove_orphans(spark: SparkSession, path: str, older_than_s: float = AGE_S, now: float | None = None) -> list[str]:
    """Delete the folders that ``orphans`` finds; their tokens."""
    path = path.rstrip("/")
    tokens = sorted(r.token for r in orphans(spark, path, older_than_s, now).select("token").collect())  # one per failed try
    for t in tokens:
        storage.delete(spark, f"{path}/{_FOLDER}{t}")
    return tokens
