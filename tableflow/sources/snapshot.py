"""The table as of a version or a time."""

from __future__ import annotations

import datetime as dt
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tableflow.functions import conditions as Q
from tableflow.functions import partitions
from tableflow.functions import schema as S
from tableflow.session import pinned
from tableflow.sources import files as FS
from tableflow.sources import log as L


def pick_version(
    spark: SparkSession, path: str, version: int | None = None, timestamp: dt.datetime | int | None = None,
    bounds: tuple[int, int] | None = None,
) -> int:
    if timestamp is not None:
        found = L.resolve_timestamp(spark, path, timestamp, bounds)
    else:
        found = L.resolve_version(spark, path, version, bounds)
    if found.out_of_range:
        raise L.LogError(f"no table log under {path}")
    return found.version


def live(spark: SparkSession, path: str, version: int, stats: bool = False, bounds: tuple[int, int] | None = None) -> DataFrame:
    """Live files at a version; they can only be told from a log that is whole from its first version on.

    ``bounds`` are the log's versions, where the caller has listed it already.
    """
    if (bounds or L.version_bounds(spark, path))[0] != 0:
        raise L.LogError(f"log of {path} does not start at version 0")
    return L.live_files(L.actions(spark, path, 0, version), stats)


def written_epochs(spark: SparkSession, path: str, acts: DataFrame, history: Sequence[L.Epoch], to_version: int) -> DataFrame:
    """Add the epoch each file was written in; only needed when a column changed its type."""
    added = (
        L.file_actions(L.actions(spark, path, 0, to_version)).where("op = 'c'")
        .groupBy("path").agg(F.min("version").alias("written"))
        .select("path", L.epoch_column(F.col("written"), history).alias("written_epoch"))
    )
    return acts.join(added, "path", "left").withColumn("written_epoch", F.coalesce("written_epoch", F.lit(0)))


def snapshot(
    spark: SparkSession,
    path: str,
    version: int | None = None,
    timestamp: dt.datetime | int | None = None,
    where: Column | None = None,
    conditions: Sequence[Q.Condition] = (),
) -> DataFrame:
    """Rows of the table as of a version or time, the latest by default.

    Tables this library wrote keep partition values in folder names, so Spark prunes partitions and pushes filters
    into the scan by itself. ``where`` filters the result and is only a shorthand. ``conditions``, as in
    ``functions.conditions``, filter rows too, and files whose statistics in the log rule them out are not opened.
    """
    path = path.rstrip("/")
    bounds = L.version_bounds(spark, path)
    v = pick_version(spark, path, version, timestamp, bounds)
    history = L.epochs(spark, path, v)
    now = L.schema_at(history, v)
    acts = live(spark, path, v, bool(conditions), bounds)
    if conditions:
        acts = acts.where(_wanted(conditions, history, now)).drop("stats")
    out = _folder_scan(spark, path, acts, history, now)
    if out is None:
        columns = T.StructType([T.StructField(f.name, f.dataType, True) for f in now.schema.fields])
        if FS.read_schema(history) is None:
            acts = written_epochs(spark, path, acts, history, v)
        # every live row is seen through the schema at this version
        acts = acts.withColumn("version", F.lit(v).cast("bigint"))
        acts = pinned(FS.with_locations(spark, acts, path), "live")
        out = FS.expand(spark, path, acts, history, columns, []).drop(FS.ROW)
    out = out.where(Q.row_filter(conditions)) if conditions else out
    return out if where is None else out.where(where)


def _wanted(conditions: Sequence[Q.Condition], history: Sequence[L.Epoch], now: L.Epoch) -> Column:
    """The filter on live files that some conditions come to. Statistics count only for columns that never changed type."""
    names = now.schema.fieldNames()
    for c in conditions:
        if c[0] not in names:
            raise Q.BadCondition(f"the table has no column {c[0]!r}")
    kinds: dict[str, set[str]] = {}
    for e in history:
        for f in e.schema.fields:
            kinds.setdefault(S.physical_name(f), set()).add(S.plain_type(f.dataType).json())
    split = {c for e in history for c in e.partition_columns}
    fields, partitions_ = {}, {}
    for f in now.schema.fields:
        kind = S.plain_type(f.dataType)
        if len(kinds[S.physical_name(f)]) > 1 or not Q.has_bounds(kind):
            continue
        if f.name in now.partition_columns and all(f.name in e.partition_columns for e in history):
            partitions_[f.name] = kind
        elif f.name not in split:
            fields[f.name] = (S.physical_name(f), kind)
    return Q.may_match(conditions, fields, partitions_)


def _folder_scan(
    spark: SparkSession, path: str, acts: DataFrame, history: Sequence[L.Epoch], now: L.Epoch
) -> DataFrame | None:
    """A plain partitioned Parquet scan, for tables laid out as ``_commit=.../k=v/`` throughout; else None."""
    if any(e.partition_columns != now.partition_columns for e in history):
        return None
    if FS.read_schema(history) is None:
        return None
    physical = {f.name: S.physical_name(f) for f in now.schema.fields}
    if any(c not in physical for c in now.partition_columns):
        return None
    levels = [f"{physical[c]}=" for c in now.partition_columns]
    segments = F.split("path", "/")
    regular = (F.size(segments) == len(levels) + 2) & segments[0].startswith(f"{L.DATA_COMMIT}=")
    for i, name in enumerate(levels):
        regular = regular & segments[i + 1].startswith(name)
    located = FS.with_locations(spark, acts, path).withColumn("regular", regular)
    todo = FS.scan_list(located, path)
    paths = [p for chunk in todo.chunks for p in chunk]
    if not todo.regular or not paths:
        return None
    covering = FS.read_schema(history)
    inner = [physical[c] for c in now.partition_columns]
    names = [n for n in physical.values() if n not in inner] + inner
    wanted = T.StructType([T.StructField(n, covering[n].dataType) for n in names])
    scan = FS.parquet_scan(spark, paths, wanted, path)
    cols = []
    for f in now.schema.fields:
        value = F.col(f"`{S.physical_name(f)}`").cast(S.plain_type(f.dataType))
        if f.name in now.partition_columns and isinstance(f.dataType, T.StringType):
            value = partitions.from_folder(value)
        cols.append(value.alias(f.name))
    return scan.select(*cols)
