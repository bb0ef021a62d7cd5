"""Writing rows as data files and committing them."""

from __future__ import annotations

import time
import uuid
from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tableflow import storage
from tableflow.functions import conditions as Q
from tableflow.functions import partitions
from tableflow.functions import schema as S
from tableflow.sources import log as L


def new_token() -> str:
    return uuid.uuid4().hex


def to_physical(df: DataFrame, schema: T.StructType, extra: Sequence[str] = ()) -> DataFrame:
    """Columns in table order, table type and file name; columns the rows lack become null."""
    have = set(df.columns)
    cols = [
        (F.col(f"`{f.name}`").cast(S.plain_type(f.dataType)) if f.name in have else F.lit(None).cast(f.dataType))
        .alias(S.physical_name(f))
        for f in schema.fields
    ]
    return df.select(*cols, *extra)


#: What a file should have.
TARGET_FILE_BYTES = 128 << 20
#: Spark sorts what a task writes by the folders, so its memory follows its rows, which may be small once they are encoded.
ROWS_PER_TASK = 2_000_000
#: Plans that know nothing of their size say so by a huge number.
_UNKNOWN_BYTES = 1 << 60
_WIDTH = {T.LongType: 8, T.DoubleType: 8, T.TimestampType: 8, T.TimestampNTZType: 8, T.IntegerType: 4, T.FloatType: 4, T.DateType: 4}


def _plan_bytes(stats) -> int:
    return int(str(stats.sizeInBytes()))


def _expected_files(
    df: DataFrame, schema: T.StructType, n_rows: int | None, row_bytes: float | None, target_bytes: int
) -> int | None:
    """How many tasks write some rows, as files of the target size; None if nothing tells how many bytes there are.

    What the plan's sources hold counts too: a task should not read more than it may write, whatever the rows come to,
    and texts may be far longer than a guess from their type.
    """
    plan = df._jdf.queryExecution().optimizedPlan()
    leaves = plan.collectLeaves()
    read = sum(_plan_bytes(leaves.apply(i).stats()) for i in range(leaves.size()))
    if n_rows is not None:
        size = n_rows * (row_bytes or sum(_WIDTH.get(type(f.dataType), 20) for f in schema.fields))
        size = size if read >= _UNKNOWN_BYTES else max(size, read)
    else:
        size = max(_plan_bytes(plan.stats()), read)
    return None if size >= _UNKNOWN_BYTES else max(1, -(-int(size) // target_bytes), -(-(n_rows or 0) // ROWS_PER_TASK))


def write_files(
    df: DataFrame,
    path: str,
    schema: T.StructType,
    partition_columns: Sequence[str] = (),
    compression: str = "snappy",
    sort_by: Sequence[str] = (),
    multi_commit: bool = False,
    rows_per_file: int = 0,
    n_rows: int | None = None,
    row_bytes: float | None = None,
    target_bytes: int = TARGET_FILE_BYTES,
) -> None:
    """Write rows under ``path``; nothing is visible to readers until the files are published.

    ``df`` carries the column ``_commit``, the token of the commit each row belongs to. Partitioned writes are
    rebalanced on the partition columns: small values end in one file each, while AQE splits a value that holds much
    of the data over many tasks. Unpartitioned writes need no shuffle: so many tasks write as files of ``target_bytes`` are
    expected, or as many as read if that is fewer, and a task that gets more starts a new file at that size. The size is
    expected from ``n_rows``, or the plan's own estimate, and the bytes of a row in the table so far; and it is what the
    plan's sources hold if that is more.
    ``rows_per_file`` starts a new file after that many rows.
    """
    physical = {f.name: S.physical_name(f) for f in schema.fields}
    if L.DATA_COMMIT in (n.lower() for n in physical.values()):
        raise S.UnsupportedSchema(f"the column name {L.DATA_COMMIT} is taken by the folders of commits")
    keys = [L.DATA_COMMIT, *[physical[c] for c in partition_columns]]
    out = to_physical(df, schema, [L.DATA_COMMIT])
    for f in schema.fields:
        if f.name in partition_columns and isinstance(f.dataType, T.StringType):
            out = out.withColumn(physical[f.name], partitions.folder_text(F.col(f"`{physical[f.name]}`")))
    if partition_columns or multi_commit:
        out = out.hint("rebalance", *keys)
    elif (files := _expected_files(out, schema, n_rows, row_bytes, target_bytes)) is not None:
        out = out.coalesce(files)
    if rows_per_file <= 0 and row_bytes:
        rows_per_file = max(1, int(target_bytes / row_bytes))
    if sort_by:
        out = out.sortWithinPartitions(*keys, *sort_by)
    own = storage.options_of(df.sparkSession, path)
    writer = out.write.options(**own).mode("append").partitionBy(*keys).option("compression", compression)
    if rows_per_file > 0:
        writer = writer.option("maxRecordsPerFile", rows_per_file)
    writer.parquet(path)


def written_files(
    spark: SparkSession, path: str, tokens: Sequence[str], schema: T.StructType, partition_columns: Sequence[str] = (),
    stats_columns: Sequence[str] = (),
) -> DataFrame:
    """The files of some commits as ``token, path, pv, size, num_records, folder_files, stats``.

    Only the columns to keep statistics of are read; without any, the scan touches nothing but Parquet footers. Sums per file
    are made before the shuffle, which carries a row per file.
    """
    root = storage.root_uri(spark, path)
    types = {f.name: f for f in schema.fields}
    part_fields = [T.StructField(S.physical_name(types[c]), T.StringType()) for c in partition_columns]
    dirs = [storage.glob_safe(f"{path.rstrip('/')}/{L.DATA_COMMIT}={t}") for t in tokens]
    measured = {
        S.physical_name(types[c]): S.plain_type(types[c].dataType)
        for c in stats_columns if c in types and c not in partition_columns and Q.has_bounds(S.plain_type(types[c].dataType))
    }
    read = [T.StructField(n, t) for n, t in measured.items()]
    scan = (
        storage.reader(spark, path).schema(T.StructType([*read, T.StructField(L.DATA_COMMIT, T.StringType()), *part_fields]))
        .option("basePath", path)
        .parquet(*dirs)
    )
    per_file = scan.select(
        F.col(L.DATA_COMMIT).alias("token"),
        F.col("_metadata.file_path").alias("uri"),
        F.col("_metadata.file_size").alias("size"),
        *[
            (partitions.from_folder(F.col(f.name)) if isinstance(types[c].dataType, T.StringType) else F.col(f.name)).alias(f"p{i}")
            for i, (c, f) in enumerate(zip(partition_columns, part_fields))
        ],
        *[F.col(f"`{n}`").alias(f"v{i}") for i, n in enumerate(measured)],
    )
    keys = ["token", "uri", "size", *[f"p{i}" for i in range(len(part_fields))]]
    pairs = [x for i, c in enumerate(partition_columns) for x in (F.lit(c), F.col(f"p{i}"))]
    pv = F.create_map(*pairs) if pairs else F.create_map()
    sums, kept = [], {}
    for i, (n, t) in enumerate(measured.items()):
        low, high = Q.bounds(F.col(f"v{i}"), t)
        sums += [low.alias(f"lo{i}"), high.alias(f"hi{i}"), F.count(f"v{i}").alias(f"n{i}")]
        kept[n] = (F.col(f"lo{i}"), F.col(f"hi{i}"), F.col("num_records") - F.col(f"n{i}"))
    return per_file.groupBy(*keys).agg(F.count(F.lit(1)).alias("num_records"), *sums).select(
        "token",
        F.expr(f"substr(uri, {len(root) + 2})").alias("path"),
        pv.cast("map<string,string>").alias("pv"),
        "size",
        "num_records",
        F.count(F.lit(1)).over(Window.partitionBy("token")).alias("folder_files"),
        Q.stats_json(F.col("num_records"), kept).alias("stats"),
    )


def create_table(
    spark: SparkSession,
    path: str,
    schema: T.StructType,
    partition_columns: Sequence[str] = (),
    timestamp: int | None = None,
    txn: tuple[str, int, int] | None = None,
) -> bool:
    """Publish version 0 with the schema; False when the table exists."""
    if L.table_exists(spark, path):
        return False
    L.publish(
        spark, path,
        [L.Commit(new_token(), "CREATE TABLE", schema, tuple(partition_columns), txn, timestamp)], after=-1,
    )
    return True


def change_schema(spark: SparkSession, path: str, schema: T.StructType, timestamp: int | None = None) -> int:
    """Publish a schema change; returns its version."""
    now = L.epochs(spark, path)[-1]
    return L.publish(
        spark, path, [L.Commit(new_token(), "UPGRADE SCHEMA", schema, now.partition_columns, None, timestamp)]
    )[0]


def append(
    spark: SparkSession,
    path: str,
    df: DataFrame,
    partition_columns: Sequence[str] = (),
    commit_by: str | None = None,
    compression: str = "snappy",
    sort_by: Sequence[str] = (),
    timestamps: dict | None = None,
    stats_columns: Sequence[str] = (),
    n_rows: int | None = None,
    target_bytes: int = TARGET_FILE_BYTES,
) -> list[int]:
    """Append rows, creating the table when needed. Returns the new versions.

    ``commit_by`` names a column whose values, in order, become one commit each: all data is written in one job and
    published version by version. The column itself is not stored. ``timestamps`` fixes commit times per value.
    ``stats_columns`` get their least and greatest values and null counts per file into the log; ``n_rows`` and ``target_bytes``
    are as in ``write_files``.
    """
    data = df.drop(commit_by) if commit_by else df
    start: list[L.Commit] = []
    if L.table_exists(spark, path):
        now = L.epochs(spark, path)[-1]
        schema, partition_columns = now.schema, now.partition_columns
        unknown = [c for c in data.columns if c not in schema.fieldNames()]
        if unknown:
            raise S.UnsupportedSchema(f"the table has no columns {unknown}")
    else:
        schema = S.plain_type(data.schema)
        stamp = min(timestamps.values()) if timestamps else None
        start.append(L.Commit(new_token(), "CREATE TABLE", schema, tuple(partition_columns), None, stamp))
    groups = [None] if commit_by is None else [r[0] for r in df.select(commit_by).distinct().orderBy(commit_by).collect()]
    tokens = {g: new_token() for g in groups}
    if commit_by is None:
        tagged = data.withColumn(L.DATA_COMMIT, F.lit(tokens[None]))
    else:
        kind = T.StructField("__group", df.schema[commit_by].dataType)
        names = spark.createDataFrame(list(tokens.items()), T.StructType([kind, T.StructField(L.DATA_COMMIT, T.StringType())]))
        same = F.col(commit_by).eqNullSafe(F.col("__group"))
        tagged = df.join(F.broadcast(names), same).drop(commit_by, "__group")  # one row per commit
    row_bytes = None if start or partition_columns or commit_by is not None else L.row_bytes(spark, path, L.latest_version(spark, path))
    write_files(tagged, path, schema, partition_columns, compression, sort_by, multi_commit=commit_by is not None,
                n_rows=n_rows, row_bytes=row_bytes, target_bytes=target_bytes)
    stamps = {tokens[g]: (timestamps or {}).get(g) for g in groups}
    commits = start + [L.Commit(t, "WRITE", timestamp=stamps[t]) for t in tokens.values()]
    done = publish_written(spark, path, schema, partition_columns, commits, -1 if start else None, stats_columns)
    return done[len(start):]


def publish_written(
    spark: SparkSession,
    path: str,
    schema: T.StructType,
    partition_columns: Sequence[str],
    commits: Sequence[L.Commit],
    after: int | None = None,
    stats_columns: Sequence[str] = (),
) -> list[int]:
    """Publish commits whose files were written with their tokens."""
    base = f"{path.rstrip('/')}/{L.DATA_COMMIT}="
    there = storage.among(spark, [base + c.token for c in commits if c.schema is None])
    written = [c for c in commits if base + c.token in there]
    tokens = {c.token for c in written}
    # without rows there are no files, and no version unless the schema changes
    commits = [c for c in commits if c.schema is not None or c.token in tokens]
    if not commits:
        return []
    if not tokens:
        return L.publish(spark, path, commits, None, after)
    files = written_files(spark, path, [c.token for c in written], schema, partition_columns, stats_columns)
    fixed = {c.token: c.timestamp for c in commits if c.timestamp is not None}
    now = F.unix_millis(F.current_timestamp())
    stamps = now
    if fixed:
        known = F.create_map(*[x for k, v in fixed.items() for x in (F.lit(k), F.lit(v).cast("bigint"))])
        stamps = F.coalesce(F.try_element_at(known, F.col("token")), now)
    return L.publish(spark, path, commits, L.add_lines(files, stamps), after)


def remove(
    spark: SparkSession, path: str, files: DataFrame, timestamp: int | None = None, data_change: bool = True
) -> int:
    """Publish the removal of live files (rows of ``live_files``). The files stay on disk for the change feed."""
    at = timestamp if timestamp is not None else int(time.time() * 1000)
    token = new_token()
    lines = L.remove_lines(files, token, at, data_change)
    return L.publish(spark, path, [L.Commit(token, "DELETE", timestamp=at)], lines)[0]
