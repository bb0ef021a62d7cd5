"""Reading the data files that log actions name."""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tableflow import storage
from tableflow.functions import schema as S
from tableflow.sources.log import DATA_COMMIT, Epoch, epoch_column

# One scan joins its rows to the actions of its files by broadcast. This bounds the bytes of that side; a longer
# file list is split by path hash into several scans, each with its own bounded broadcast.
BROADCAST_BYTES = 64 << 20
ACTION_OVERHEAD = 200

ROW, URI = "__row_num", "__uri"


def action_column(name: str) -> str:
    """Name of an action's column next to table columns, which may be called anything."""
    return f"__action_{name}"


def read_schema(history: Sequence[Epoch], partition_columns: Sequence[str] = ()) -> T.StructType | None:
    """One file schema that covers all epochs by physical column name; None when a column's types do not fit."""
    fields: dict[str, T.DataType] = {}
    for e in reversed(history):
        for f in e.schema.fields:
            name = S.physical_name(f)
            if name not in fields:
                fields[name] = S.plain_type(f.dataType)
            elif not S.reads_as(f.dataType, fields[name]):
                return None
    return T.StructType([T.StructField(n, t, True) for n, t in fields.items()])


def parquet_scan(
    spark: SparkSession, paths: Sequence[str], schema: T.StructType, root: str | None = None
) -> DataFrame:
    """Rows of files, or of whole commit folders below ``root``; folder names then give the partition columns."""
    reader = storage.reader(spark, root or (paths[0] if paths else ""))
    if root is not None:
        schema = T.StructType([*schema.fields, T.StructField(DATA_COMMIT, T.StringType())])
        reader = reader.option("basePath", root)
    return reader.schema(schema).parquet(*[storage.glob_safe(p) for p in paths])


def row_scan(spark: SparkSession, paths: Sequence[str], schema: T.StructType, root: str | None = None) -> DataFrame:
    """Rows with their file and their position in it."""
    return parquet_scan(spark, paths, schema, root).select(
        *[F.col(f"`{n}`") for n in schema.fieldNames()],
        F.col("_metadata.file_path").alias(URI), F.col("_metadata.row_index").alias(ROW),
    )


def row_counts(spark: SparkSession, paths: Sequence[str]) -> DataFrame:
    """(uri, n_rows) per file; with an empty read schema only footers are touched."""
    scan = storage.reader(spark, paths[0]).schema(T.StructType([])).parquet(*[storage.glob_safe(p) for p in paths])
    return scan.select(F.col("_metadata.file_path").alias("uri")).groupBy("uri").agg(F.count(F.lit(1)).alias("n_rows"))


def with_locations(spark: SparkSession, acts: DataFrame, path: str) -> DataFrame:
    """Add ``uri``, as ``_metadata.file_path`` shows it, ``location``, as a reader takes it, and a path hash."""
    root = storage.root_uri(spark, path)
    absolute = "path rlike '^([A-Za-z][A-Za-z0-9+.-]*:)?/'"
    uri = storage.quoted_path("disk")
    out = acts.withColumn("disk", F.expr(storage.disk_path("path"))).withColumn("absolute", F.expr(absolute))
    return out.withColumns({
        "uri": F.when(F.col("absolute"), F.expr(f"regexp_replace({uri}, '^(file:)?/+', 'file:/')"))
        .otherwise(F.concat(F.lit(root + "/"), F.expr(uri))),
        "location": F.when(F.col("absolute"), F.col("disk"))
        .otherwise(F.concat(F.lit(path.rstrip("/") + "/"), F.col("disk"))),
        "hash": F.xxhash64("path"),
        "folder": F.regexp_extract("disk", f"^{DATA_COMMIT}=[^/]+", 0),
    }).withColumn("folder_hash", F.xxhash64("folder")).drop("disk", "absolute")


@dataclass(frozen=True)
class ScanList:
    """What to read: paths of each scan, and how actions are told apart between scans."""

    chunks: list[list[str]]
    key: str = "hash"
    in_folders: bool = False
    regular: bool = False


def scan_list(acts: DataFrame, root: str) -> ScanList:
    """The paths that cover the files of some actions.

    A commit folder all of whose published files are wanted is named as one path, so the list follows the number of
    commits and not of files. Files of other folders are named one by one. Only this list comes to the driver; it
    also tells how many bytes of actions each scan will broadcast, and more than BROADCAST_BYTES make several scans.
    An optional column ``regular`` is reported back when it holds for all actions.
    """
    weight = F.length("uri") + 2 * F.length(F.coalesce(F.to_json("pv"), F.lit(""))) + ACTION_OVERHEAD
    regular = F.col("regular") if "regular" in acts.columns else F.lit(False)
    files = acts.groupBy("location", "folder").agg(
        F.first("hash").alias("hash"), F.first("folder_hash").alias("folder_hash"),
        F.max("folder_files").alias("expected"), F.sum(weight).alias("bytes"), F.bool_and(regular).alias("regular"),
    )
    # files without a commit folder may be most of them: they need no count
    found = files.where("folder <> ''").groupBy("folder").agg(F.count(F.lit(1)).alias("found"))
    files = files.join(found, "folder", "left")
    whole = (F.col("folder") != "") & (F.col("found") == F.coalesce("expected", F.lit(-1)))
    name = F.when(whole, F.concat(F.lit(f"{root}/"), F.col("folder"))).otherwise(F.col("location"))
    named = files.select(name.alias("path"), "folder", "folder_hash", "bytes", "regular").groupBy("path").agg(
        F.first("folder").alias("folder"), F.first("folder_hash").alias("h"), F.sum("bytes").alias("bytes"),
        F.bool_and("regular").alias("regular"),
    ).collect()
    if not named:
        return ScanList([])
    in_folders = all(r["folder"] for r in named)
    n = max(1, -(-sum(r["bytes"] for r in named) // BROADCAST_BYTES))
    loads = [0] * n
    for r in named:
        loads[r["h"] % n] += r["bytes"]
    key, paths = "folder_hash", [(r["h"], r["path"]) for r in named]
    # one folder may hold most files; then its files, not folders, are spread over the scans
    if n > 1 and (not in_folders or max(loads) > 2 * BROADCAST_BYTES):
        key, paths = "hash", [(r["hash"], r["location"]) for r in files.select("hash", "location").collect()]
    chunks: list[list[str]] = [[] for _ in range(n)]
    for h, p in paths:
        chunks[h % n].append(p)
    return ScanList(chunks, key, in_folders, all(r["regular"] for r in named))


def partition_value(name: str, data_type: T.DataType, from_file: Column | None) -> Column:
    """A partition column: the log's value where it has one, else what the file holds."""
    values = action_column("pv")
    logged = F.try_element_at(values, F.lit(name)).try_cast(data_type)
    if from_file is None:
        return logged
    return F.when(F.map_contains_key(values, name), logged).otherwise(from_file.cast(data_type))


def expand(
    spark: SparkSession, path: str, acts: DataFrame, history: Sequence[Epoch], columns: T.StructType, keep: Sequence[str]
) -> DataFrame:
    """One row per table row of every file action.

    ``acts`` needs ``path, pv, version`` and may carry ``min_row`` (first wanted row). The ``keep`` columns come along
    under their ``action_column`` names.
    A value shows only if the schema in force at the action's version has its column. Rows are not shuffled: each
    scan joins to its own actions by a broadcast of bounded size.
    """
    if "uri" not in acts.columns:
        acts = with_locations(spark, acts, path)
    skips = ["min_row"] if "min_row" in acts.columns else []
    acts = acts.withColumn("epoch", epoch_column(F.col("version"), history))
    whole = read_schema(history)
    if whole is not None:
        parts = [(acts, whole, None)]
    else:  # some column changed its type: read the files of each epoch with the schema they were written under
        parts = [
            (acts.where(F.col("written_epoch") == e.number), read_schema([e]), e) for e in history
        ]
    out = None
    for part, file_schema, written in parts:
        todo = scan_list(part, path)
        n = len(todo.chunks)
        for i, paths in enumerate(todo.chunks):
            if not paths:
                continue
            chunk = part if n == 1 else part.where(F.pmod(todo.key, F.lit(n)) == i)
            side = chunk.select(
                F.col("uri").alias(URI), *[F.col(c).alias(action_column(c)) for c in ("pv", "epoch", *skips, *keep)]
            )
            scan = row_scan(spark, paths, file_schema, path if todo.in_folders else None)
            rows = scan.join(F.broadcast(side), URI)
            if skips:
                rows = rows.where(F.col(ROW) >= F.col(action_column("min_row")))
            picked = rows.select(
                *[_value(f, history, file_schema, written is not None) for f in columns.fields],
                *[action_column(c) for c in keep], ROW,
            )
            out = picked if out is None else out.unionByName(picked)
    if out is None:
        kept = [T.StructField(action_column(k), acts.schema[k].dataType) for k in keep]
        empty = T.StructType([*columns.fields, *kept, T.StructField(ROW, T.LongType())])
        return spark.createDataFrame([], T.StructType([T.StructField(f.name, f.dataType, True) for f in empty.fields]))
    return out


def _value(field: T.StructField, history: Sequence[Epoch], file_schema: T.StructType, try_types: bool) -> Column:
    """One output column: picked per epoch, since a name may be absent, re-added or a partition column there."""
    wanted = S.plain_type(field.dataType)
    by_source: dict[tuple[str, bool], list[int]] = {}
    for e in history:
        for f in e.schema.fields:
            if f.name == field.name:
                by_source.setdefault((S.physical_name(f), f.name in e.partition_columns), []).append(e.number)
    out = None
    for (physical, partitioned), numbers in by_source.items():
        raw = F.col(f"`{physical}`") if physical in file_schema.fieldNames() else None
        if partitioned:
            value = partition_value(field.name, wanted, raw)
        elif raw is None:
            continue
        else:
            value = raw
            if file_schema[physical].dataType != wanted:
                value = raw.try_cast(wanted) if try_types else raw.cast(wanted)
        if len(numbers) < len(history):
            value = F.when(F.col(action_column("epoch")).isin(numbers), value)
            out = value if out is None else F.coalesce(out, value)
        else:
            out = value
    return (F.lit(None).cast(wanted) if out is None else out).alias(field.name)
