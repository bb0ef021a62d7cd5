"""The table log as a DataFrame of actions, and publishing new versions.

A table is a folder of Parquet files with a ``_delta_log`` folder of JSON-lines files, one per version, named by
the 20-digit version number. An action's position inside its commit is part of every cursor. Log files of usual size
are read as one text value and split into lines; if any is larger than WHOLE_FILE_BYTES, lines are read from file
splits and numbered across them, so that no task ever holds a long commit.
"""

from __future__ import annotations

import datetime as dt
import json
import time
import uuid
from collections.abc import Mapping, Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tableflow import storage
from tableflow.operators import ordered
from tableflow.options import EARLIEST, LATEST

LOG_DIR = "_delta_log"
STAGE_DIR = "_staged_commits"
DATA_COMMIT = "_commit"
WHOLE_FILE_BYTES = 32 << 20
LOGS_PER_WRITER = 20
MAX_LOG_WRITERS = 1000
READER_VERSION = 1
FOLDER_FILES = "folderFiles"  # tag: how many files were published in the action's commit folder

ACTION_SCHEMA = """
commitInfo struct<timestamp:bigint, operation:string>,
protocol struct<minReaderVersion:int, minWriterVersion:int>,
txn struct<appId:string, version:bigint, part:int, low:bigint, high:bigint, messages:bigint, lastUpdated:bigint>,
metaData struct<id:string, schemaString:string, partitionColumns:array<string>, createdTime:bigint>,
add struct<path:string, partitionValues:map<string,string>, size:bigint, modificationTime:bigint,
           dataChange:boolean, stats:string, tags:map<string,string>>,
remove struct<path:string, partitionValues:map<string,string>, size:bigint, deletionTimestamp:bigint,
              dataChange:boolean, stats:string, tags:map<string,string>>
"""


class LogError(RuntimeError):
    """The table log is missing, has a gap or cannot be read."""


def log_dir(path: str) -> str:
    return f"{path.rstrip('/')}/{LOG_DIR}"


def file_name(version: int) -> str:
    return f"{version:020d}.json"


def log_versions(spark: SparkSession, path: str) -> DataFrame:
    """(version, log_ts, bytes) of every log file, from the listing alone."""
    listed = storage.reader(spark, path).format("binaryFile").option("pathGlobFilter", "[0-9]*.json").load(storage.glob_safe(log_dir(path)))
    name = F.substring_index(F.substring_index("path", "/", -1), ".", 1)
    return listed.select(name.cast("bigint").alias("version"), F.unix_millis("modificationTime").alias("log_ts"),
                         F.col("length").alias("bytes"))


# Log files never change, so the largest one up to a version is looked up once: (application, path) -> (version, bytes).
_largest: dict[tuple[str, str], tuple[int, int]] = {}


def table_exists(spark: SparkSession, path: str) -> bool:
    return storage.exists(spark, log_dir(path))


def version_bounds(spark: SparkSession, path: str) -> tuple[int, int]:
    """(first, latest) version; raises LogError without a log."""
    if not table_exists(spark, path):
        raise LogError(f"no table log under {path}")
    first, last, largest, n = log_versions(spark, path).agg(
        F.min("version"), F.max("version"), F.max("bytes"), F.count_distinct("version")
    ).first()
    if first is None:
        raise LogError(f"empty table log under {path}")
    if n != last - first + 1:
        raise LogError(f"log of {path} has {n} of the versions {first} to {last}")
    _largest[spark.sparkContext.applicationId, path.rstrip("/")] = (last, largest)
    return first, last


def latest_version(spark: SparkSession, path: str) -> int:
    """Latest version, -1 for a table that does not exist yet."""
    return version_bounds(spark, path)[1] if table_exists(spark, path) else -1


def _has_long_commits(spark: SparkSession, path: str, to_version: int | None) -> bool:
    key = (spark.sparkContext.applicationId, path.rstrip("/"))
    if to_version is None or key not in _largest or _largest[key][0] < to_version:
        version_bounds(spark, path)
    return _largest[key][1] > WHOLE_FILE_BYTES


def log_lines(spark: SparkSession, path: str, from_version: int = 0, to_version: int | None = None) -> DataFrame:
    """(version, log_ts, idx, line) of a version range; the file name filter prunes the listing."""
    # both ways of reading cut lines at "\n" only, so that an action has the same number in either
    reader = storage.reader(spark, path).option("pathGlobFilter", "[0-9]*.json").option("lineSep", "\n")
    long = _has_long_commits(spark, path, to_version)
    raw = reader.text(storage.glob_safe(log_dir(path)), wholetext=not long)
    name = F.col("_metadata.file_name")
    if from_version > 0:
        raw = raw.where(name >= file_name(from_version))
    if to_version is not None:
        raw = raw.where(name <= file_name(to_version))
    version = F.substring_index(name, ".", 1).cast("bigint").alias("version")
    log_ts = F.unix_millis(F.col("_metadata.file_modification_time")).alias("log_ts")
    if long:
        # a split is a bounded stretch of a file: number lines inside it and add the lines of earlier splits
        lines = raw.select(version, log_ts, F.col("value").alias("line"), F.monotonically_increasing_id().alias("at"),
                           F.col("_metadata.file_block_start").alias(ordered.BUCKET))
        lines = ordered.add_rank(lines, "at", by=["version"], name="idx").drop("at", ordered.BUCKET)
    else:
        lines = raw.select("value", version, log_ts).select(
            "version", "log_ts", F.posexplode(F.split("value", "\n")).alias("idx", "line")
        )
    return lines.where(F.trim("line") != "").select("version", "log_ts", F.col("idx").cast("bigint").alias("idx"), "line")


def parse_log(lines: DataFrame, containing: str | None = None) -> DataFrame:
    """The parsed action of each log line. ``containing`` drops lines without that text before parsing."""
    if containing:
        lines = lines.where(F.col("line").contains(containing))
    return lines.select("version", "idx", "log_ts", F.from_json("line", ACTION_SCHEMA).alias("a")).select(
        "version", "idx", "log_ts", "a.*"
    )


def actions(spark: SparkSession, path: str, from_version: int = 0, to_version: int | None = None) -> DataFrame:
    return parse_log(log_lines(spark, path, from_version, to_version))


def file_actions(parsed: DataFrame, include_rewrites: bool = True, stats: bool = False) -> DataFrame:
    """Add and remove actions in one shape, with the text of their statistics if asked for; commit info and unknown lines fall away.

    Rewrites (``dataChange = false``) count as changes unless ``include_rewrites`` is off.
    """
    is_add = F.col("add").isNotNull()

    def either(name: str) -> Column:
        return F.when(is_add, F.col(f"add.{name}")).otherwise(F.col(f"remove.{name}"))

    out = parsed.where(is_add | F.col("remove").isNotNull()).select(
        "version",
        "idx",
        F.when(is_add, "c").otherwise("r").alias("op"),
        either("path").alias("path"),
        either("partitionValues").alias("pv"),
        either("size").alias("size"),
        F.when(is_add, F.col("add.modificationTime")).otherwise(F.col("remove.deletionTimestamp")).alias("ts"),
        F.coalesce(either("dataChange"), F.lit(True)).alias("data_change"),
        F.get_json_object(either("stats"), "$.numRecords").cast("bigint").alias("num_records"),
        F.try_element_at(either("tags"), F.lit(FOLDER_FILES)).cast("bigint").alias("folder_files"),
        *([either("stats").alias("stats")] if stats else []),
    )
    return out if include_rewrites else out.where("data_change")


def live_files(parsed: DataFrame, stats: bool = False) -> DataFrame:
    """Files whose last action is an add. ``max_by`` combines on the map side before the one shuffle on path."""
    acts = file_actions(parsed, stats=stats)
    last = acts.groupBy("path").agg(F.max_by(F.struct(*[c for c in acts.columns if c != "path"]),
                                             F.struct("version", "idx")).alias("last"))
    return last.where("last.op = 'c'").select("path", "last.*")


# ---- schema history --------------------------------------------------------------------------------------------


@dataclass(frozen=True)
class Epoch:
    """A stretch of versions with one table schema, starting at ``version``."""

    number: int
    version: int
    schema: T.StructType
    partition_columns: tuple[str, ...]


def epochs(spark: SparkSession, path: str, to_version: int | None = None, from_version: int = 0) -> list[Epoch]:
    """Schema history up to a version. There is one entry per schema change, so it is read to the driver.

    A log that asks for a newer reader is an error, since its other actions may mean more than is read here.
    """
    lines = log_lines(spark, path, from_version, to_version)
    rows = (
        parse_log(lines.where(F.col("line").contains('"metaData"') | F.col("line").contains('"protocol"')))
        .where("metaData is not null or protocol is not null")
        .select("version", "idx", "metaData.schemaString", "metaData.partitionColumns", "protocol.minReaderVersion")
        .orderBy("version", "idx")
        .collect()
    )
    newer = [r["minReaderVersion"] for r in rows if (r["minReaderVersion"] or 0) > READER_VERSION]
    if newer:
        raise LogError(f"{path} needs reader version {max(newer)}, this is {READER_VERSION}")
    rows = [r for r in rows if r["schemaString"] is not None]
    last = {r["version"]: r for r in rows}  # the last one of a version counts
    return [
        Epoch(n, v, T.StructType.fromJson(json.loads(r["schemaString"])), tuple(r["partitionColumns"] or ()))
        for n, (v, r) in enumerate(sorted(last.items()))
    ]


@dataclass
class TableState:
    """What a single writer or reader knows about a table, so that it need not read the whole log for each batch."""

    version: int
    history: list[Epoch]
    row_bytes: float | None = None  # of a row in the table's files

    def learn(self, version: int, schema: T.StructType, partition_columns: Sequence[str]) -> None:
        self.history.append(Epoch(len(self.history), version, schema, tuple(partition_columns)))

    def catch_up(self, spark: SparkSession, path: str, to_version: int) -> None:
        """Read the schema changes of versions that are new."""
        if to_version > self.version:
            for e in epochs(spark, path, to_version, self.version + 1):
                self.learn(e.version, e.schema, e.partition_columns)
            self.version = to_version


def table_state(spark: SparkSession, path: str) -> TableState:
    version = latest_version(spark, path)
    if version < 0:
        return TableState(version, [])
    return TableState(version, epochs(spark, path, version), row_bytes(spark, path, version))


#: How many versions back the size of rows is measured.
RECENT_VERSIONS = 20


def row_bytes(spark: SparkSession, path: str, version: int) -> float | None:
    """Bytes of a row in the files that recent versions added; None without any."""
    recent = parse_log(log_lines(spark, path, max(0, version - RECENT_VERSIONS), version), containing='"add"')
    size, rows = file_actions(recent).where("op = 'c' and num_records > 0").agg(F.sum("size"), F.sum("num_records")).first()
    return size / rows if rows else None


def epoch_column(version: Column, history: Sequence[Epoch]) -> Column:
    """Number of the epoch in force at a version (versions before the first one belong to the first)."""
    starts = F.array(*[F.lit(e.version) for e in history])
    return F.greatest(F.size(F.filter(starts, lambda s: s <= version)) - 1, F.lit(0))


def schema_at(history: Sequence[Epoch], version: int) -> Epoch:
    known = [e for e in history if e.version <= version]
    if not known:
        raise LogError(f"no schema at version {version}")
    return known[-1]


# ---- versions by number and time -------------------------------------------------------------------------------


def commit_times(spark: SparkSession, path: str) -> DataFrame:
    """(version, commit_ts): the commit's own timestamp, else its log file's."""
    return (
        parse_log(log_lines(spark, path), containing='"commitInfo"')
        .groupBy("version")
        .agg(F.max("commitInfo.timestamp").alias("own"))
        .join(log_versions(spark, path), "version", "right")
        .select("version", F.coalesce("own", "log_ts").alias("commit_ts"))
    )


@dataclass(frozen=True)
class Resolved:
    version: int
    out_of_range: bool


def resolve_version(spark: SparkSession, path: str, version: int | None, bounds: tuple[int, int] | None = None) -> Resolved:
    """A usable version: the given one if it exists, the first for EARLIEST, else the latest. ``bounds`` saves a listing.

    Without any readable log the answer is version 0, marked out of range.
    """
    try:
        first, last = bounds or version_bounds(spark, path)
    except LogError:
        return Resolved(0, True)
    if version == EARLIEST:
        return Resolved(first, False)
    if version is None or version == LATEST or not first <= version <= last:
        return Resolved(last, False)
    return Resolved(version, False)


def to_millis(ts: dt.datetime | int) -> int:
    """A timestamp, or an int in seconds, as epoch milliseconds. Naive times count as UTC."""
    if isinstance(ts, dt.datetime):
        return int((ts if ts.tzinfo else ts.replace(tzinfo=dt.timezone.utc)).timestamp() * 1000)
    return int(ts) * 1000


def resolve_timestamp(spark: SparkSession, path: str, ts: dt.datetime | int, bounds: tuple[int, int] | None = None) -> Resolved:
    """The last version committed at or before ``ts``; the latest version when there is none."""
    if not table_exists(spark, path):
        return Resolved(0, True)
    found = commit_times(spark, path).where(F.col("commit_ts") <= to_millis(ts)).agg(F.max("version")).first()[0]
    return resolve_version(spark, path, LATEST, bounds) if found is None else Resolved(found, False)


# ---- publishing ------------------------------------------------------------------------------------------------


@dataclass
class Commit:
    """One version to publish. ``token`` ties it to its file lines; ``schema`` makes it a schema change."""

    token: str
    operation: str = "WRITE"
    schema: T.StructType | None = None
    partition_columns: Sequence[str] = ()
    txn: tuple | None = None  # app id, batch id, part of the batch, least and greatest message id, messages
    timestamp: int | None = None
    version: int | None = None  # set when published

    def header(self, first: bool, now: int) -> list[str]:
        at = self.timestamp if self.timestamp is not None else now
        lines: list[dict] = [{"commitInfo": {"timestamp": at, "operation": self.operation}}]
        if first:
            lines.append({"protocol": {"minReaderVersion": 1, "minWriterVersion": 2}})
        if self.txn:
            names = ("appId", "version", "part", "low", "high", "messages")
            lines.append({"txn": {**dict(zip(names, self.txn, strict=False)), "lastUpdated": at}})
        if self.schema is not None:
            lines.append({
                "metaData": {
                    "id": str(uuid.uuid4()),
                    "format": {"provider": "parquet", "options": {}},
                    "schemaString": json.dumps(self.schema.jsonValue()),
                    "partitionColumns": list(self.partition_columns),
                    "configuration": {},
                    "createdTime": at,
                }
            })
        return [json.dumps(x) for x in lines]


def _tags() -> Column:
    return F.create_map(F.lit(FOLDER_FILES), F.col("folder_files").cast("string")).alias("tags")


def add_lines(files: DataFrame, stamps: Column, data_change: bool = True) -> DataFrame:
    """Log lines adding files; ``files`` has ``token, path, pv, size, num_records, folder_files`` and may have ``stats``."""
    stats = F.col("stats") if "stats" in files.columns else F.to_json(F.struct(F.col("num_records").alias("numRecords")))
    add = F.struct(
        "path",
        F.col("pv").alias("partitionValues"),
        "size",
        stamps.alias("modificationTime"),
        F.lit(data_change).alias("dataChange"),
        stats.alias("stats"),
        _tags(),
    )
    return files.select("token", F.lit(2).alias("ord"), "path", F.to_json(F.struct(add.alias("add"))).alias("value"))


def remove_lines(files: DataFrame, token: str, deleted_ms: int, data_change: bool = True) -> DataFrame:
    """Log lines removing files; ``files`` are rows of ``live_files``."""
    rm = F.struct(
        "path",
        F.lit(deleted_ms).cast("bigint").alias("deletionTimestamp"),
        F.lit(data_change).alias("dataChange"),
        F.col("pv").alias("partitionValues"),
        "size",
        F.to_json(F.struct(F.col("num_records").alias("numRecords"))).alias("stats"),
        F.when(F.col("folder_files").isNotNull(), _tags()).alias("tags"),
    )
    return files.select(F.lit(token).alias("token"), F.lit(1).alias("ord"), "path",
                        F.to_json(F.struct(rm.alias("remove"))).alias("value"))


def publish(
    spark: SparkSession, path: str, commits: Sequence[Commit], lines: DataFrame | None = None, after: int | None = None
) -> list[int]:
    """Make prepared files visible: one new version per commit, in order.

    One Spark job writes the log files of all commits to a staging folder; each is then moved in place by a rename
    that never overwrites. A reader sees a commit's files all at once or not at all.
    """
    if not commits:
        return []
    last = latest_version(spark, path) if after is None else after
    now = int(time.time() * 1000)
    head = [
        (c.token, 0, f"{n:06d}", text)
        for i, c in enumerate(commits)
        for n, text in enumerate(c.header(first=(last < 0 and i == 0), now=now))
    ]
    rows = spark.createDataFrame(head, "token string, ord int, path string, value string")
    if lines is not None:
        rows = rows.unionByName(lines)
    base = path.rstrip("/")
    stage = f"{base}/{STAGE_DIR}/{uuid.uuid4().hex}"
    # so many tasks as there are files for: sized by bytes, all files of a long batch would be one task's
    tasks = min(MAX_LOG_WRITERS, -(-len(commits) // LOGS_PER_WRITER))
    (
        rows.repartition(tasks, "token")
        .sortWithinPartitions("token", "ord", "path")
        .select("token", "value")
        .write.options(**storage.options_of(spark, base)).partitionBy("token")
        .text(stage)
    )
    storage.mkdirs(spark, log_dir(path))
    staged: dict[str, list[str]] = {}
    for r in storage.part_files(spark, stage, "token").collect():  # one per commit
        staged.setdefault(r["value"], []).append(r["name"])
    out = []
    for i, c in enumerate(commits):
        folder = f"{stage}/token={c.token}"
        parts = staged.get(c.token, [])
        if len(parts) != 1:
            raise LogError(f"expected one staged log file in {folder}, found {len(parts)}")
        storage.move_new(spark, f"{folder}/{parts[0]}", f"{log_dir(path)}/{file_name(last + 1)}", now + i)
        last += 1
        c.version = last
        out.append(last)
    return out


def _txns(spark: SparkSession, path: str, app_id: str) -> DataFrame:
    return parse_log(log_lines(spark, path), containing='"txn"').where(F.col("txn.appId") == app_id).select("txn.*")


def committed_parts(spark: SparkSession, path: str, app_id: str, batch_id: int) -> dict[int, tuple[int, int, int] | None]:
    """Parts of a batch that are in the log already, with the batch's message ids and number where the log has them."""
    if not table_exists(spark, path):
        return {}
    rows = _txns(spark, path, app_id).where(F.col("version") == batch_id).select("part", "low", "high", "messages").distinct()
    return {r[0]: None if r[3] is None else (r[1], r[2], r[3]) for r in rows.collect()}


def last_batch(spark: SparkSession, path: str, app_id: str) -> int:
    """The greatest batch id of an application in the log, -1 without any."""
    if not table_exists(spark, path):
        return -1
    last = _txns(spark, path, app_id).agg(F.max("version")).first()[0]
    return -1 if last is None else last


def storage_options(spark: SparkSession, path: str, options: Mapping[str, str]) -> None:
    """Use file-system settings given as ``hadoop.*`` options for one table; the session and other tables keep theirs."""
    storage.configure(spark, path, options)
