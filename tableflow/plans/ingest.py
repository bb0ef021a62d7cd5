"""Ingest a batch of messages into a table: decode, follow schema changes, split into commits, write, publish.

A message has ``msg_id bigint, schema_type string, schema string, payload string|binary`` and optionally a decoded
``record`` struct. ``msg_id`` is unique and gives the order.
"""

from __future__ import annotations

import logging
import warnings
from collections.abc import Callable
from dataclasses import dataclass, field

from py4j.protocol import Py4JJavaError
from pyspark.errors import AnalysisException, PySparkException
from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tableflow.functions import records
from tableflow.functions import schema as S
from tableflow.operators import decode as D
from tableflow.operators import keyed, ordered
from tableflow.operators import write as W
from tableflow.options import IngestOptions
from tableflow.session import pinned
from tableflow.sources import log as L
from tableflow.storage import VersionConflict

_log = logging.getLogger(__name__)

RejectSink = Callable[[DataFrame, int], None]
PARTITION_PATH = "_partition_path"
SCHEMA_TEXT_BROADCAST = 32 << 20

_EVOLVE = {"append": S.evolve_replace, "keyed": S.evolve_merge}


#: What a write or a publish may fail with. Only these count against the budget; any other error is raised at once.
FLUSH_ERRORS = (Py4JJavaError, PySparkException, L.LogError, VersionConflict, OSError)


class CommitFailed(RuntimeError):
    """The failure budget of a batch is used up."""


class ReplayMismatch(RuntimeError):
    """A batch id that the log knows came with other messages."""


@dataclass
class IngestResult:
    """What one batch did."""

    versions: list[int] = field(default_factory=list)
    accepted: int = 0
    rejected: int = 0
    replayed: int = 0


@dataclass
class _Kind:
    """A distinct incoming schema: how to decode and what it yields."""

    number: int
    kind: str
    schema: T.StructType
    count: int
    first: int
    last: int


@dataclass
class _Part:
    """One commit of the batch."""

    number: int
    run: int
    group: int
    kind: _Kind
    rows: int
    target: T.StructType | None = None
    changes_schema: bool = False
    unit: int = 0
    token: str = ""


def table_schema(kind: _Kind, options: IngestOptions) -> T.StructType:
    """What a message schema asks of the table."""
    if options.layout == "keyed" and options.partition_path:
        return T.StructType([*kind.schema.fields, T.StructField(PARTITION_PATH, T.StringType(), True)])
    return kind.schema


def _kinds(messages: DataFrame, options: IngestOptions) -> tuple[list[_Kind], list[tuple], dict[str, int]]:
    """Distinct schemas of the batch, the (type, text, number) dictionary, and counts by reject reason.

    One pass over the schema columns; only distinct schema texts come to the driver, where each is parsed once.
    """
    kind = F.upper("schema_type")
    text = F.when(kind.isin(*D.PRIMITIVES), F.lit("")).otherwise(F.coalesce("schema", F.lit("")))
    text = F.when(F.col(D.REASON).isNull(), text)  # texts of rejected messages are not needed
    stats = (
        messages.groupBy(D.REASON, F.when(F.col(D.REASON).isNull(), kind).alias("t"), text.alias("s"))
        .agg(F.count(F.lit(1)).alias("n"), F.min("msg_id").alias("lo"), F.max("msg_id").alias("hi"))
        .collect()
    )
    rejects: dict[str, int] = {}
    by_signature: dict[tuple[str, str], _Kind] = {}
    dictionary: list[tuple] = []
    for r in stats:
        if r[D.REASON] is not None:
            rejects[r[D.REASON]] = rejects.get(r[D.REASON], 0) + r["n"]
            continue
        try:
            if r["t"] in D.PRIMITIVES:
                schema = D.primitive_schema(r["t"], options.field_name)
            else:
                schema = S.avro_to_struct(r["s"], options.bytes_as_string)
                if r["t"] == "JSON" and (problems := S.json_problems(S.parse_avro(r["s"]))):
                    raise S.UnsupportedSchema("; ".join(problems))
        except (S.UnsupportedSchema, KeyError, TypeError) as e:
            if options.fail_fast:
                raise D.RejectedMessage(f"{D.BAD_SCHEMA}: {e}") from e
            rejects[D.BAD_SCHEMA] = rejects.get(D.BAD_SCHEMA, 0) + r["n"]
            dictionary.append((r["t"], r["s"], -1))
            continue
        sig = (r["t"], S.signature(schema))
        k = by_signature.get(sig)
        if k is None:
            k = by_signature[sig] = _Kind(len(by_signature), r["t"], schema, 0, r["lo"], r["hi"])
        k.count += r["n"]
        k.first, k.last = min(k.first, r["lo"]), max(k.last, r["hi"])
        dictionary.append((r["t"], r["s"], k.number))
    return list(by_signature.values()), dictionary, rejects


def _with_kind(spark: SparkSession, messages: DataFrame, dictionary: list[tuple]) -> DataFrame:
    """Add ``_kind``, the number of each usable message's schema."""
    usable = messages.where(F.col(D.REASON).isNull())
    if len(dictionary) == 1:
        return usable.withColumn("_kind", F.lit(dictionary[0][2]))
    names = spark.createDataFrame(dictionary, "__t string, __s string, _kind int")
    if sum(len(d[1]) for d in dictionary) <= SCHEMA_TEXT_BROADCAST:
        names = F.broadcast(names)
    kind = F.upper("schema_type")
    text = F.when(kind.isin(*D.PRIMITIVES), F.lit("")).otherwise(F.coalesce("schema", F.lit("")))
    return (
        usable.withColumn("__t", kind).withColumn("__s", text).join(names, ["__t", "__s"]).drop("__t", "__s")
    )


def _parts(rows: DataFrame, kinds: list[_Kind], options: IngestOptions) -> tuple[DataFrame, list[_Part]]:
    """Number the commits of the batch and tag each row with ``_run`` and ``_group``.

    The common cases cost nothing: one schema, or schemas whose id ranges do not overlap, need no pass over the rows,
    and neither does a batch within the record limit.
    """
    by_start = sorted(kinds, key=lambda k: k.first)
    total = sum(k.count for k in kinds)
    if all(a.last < b.first for a, b in zip(by_start, by_start[1:])):
        run_of = {k.number: i for i, k in enumerate(by_start)}
        run = F.lit(0)
        if len(kinds) > 1:
            run = F.element_at(F.create_map(*[x for k, i in run_of.items() for x in (F.lit(k), F.lit(i))]), F.col("_kind"))
        rows = rows.withColumn("_run", run.cast("bigint"))
        sizes = [(i, k, k.count) for i, k in enumerate(by_start)]
    else:
        rows = ordered.schema_runs(rows, "msg_id", "_kind", n_rows=total)
        known = {k.number: k for k in kinds}
        found = rows.groupBy("_run").agg(F.first("_kind").alias("k"), F.count(F.lit(1)).alias("n")).collect()
        sizes = [(r["_run"], known[r["k"]], r["n"]) for r in sorted(found, key=lambda r: r["_run"])]
    limit = options.records_per_commit
    if all(n <= limit for _, _, n in sizes):
        rows = rows.withColumn("_group", F.lit(0).cast("bigint"))
    else:
        rows = ordered.commit_groups(rows, "msg_id", limit, by=["_run"], n_rows=total)
    parts = []
    for run_no, k, n in sizes:
        for g in range(-(-n // limit)):
            parts.append(_Part(len(parts), run_no, g, k, min(limit, n - g * limit)))
    return rows, parts


def _plan_schemas(
    parts: list[_Part], options: IngestOptions, current: T.StructType | None, used: set[str]
) -> T.StructType:
    """Set each part's table schema, walking through the commits in order; returns the schema to create with."""
    first = current
    units: dict[tuple[int, str], int] = {}
    for p in parts:
        wanted = table_schema(p.kind, options)
        if current is None:
            first = current = S.plain_type(wanted)
            target = current
        elif options.layout == "evolving":
            target = S.evolve_by_name(current, wanted, used)
        else:
            target = _EVOLVE[options.layout](current, S.plain_type(wanted))
        p.changes_schema = target is not current and target.jsonValue() != current.jsonValue()
        p.target = current = target
        used |= {S.physical_name(f) for f in target.fields}
        missing = [c for c in options.partition_columns if c not in target.fieldNames()]
        if missing:
            raise S.UnsupportedSchema(f"partition columns {missing} are not in the message schema")
        key = (p.kind.number, str(target.jsonValue()))
        p.unit = units.setdefault(key, len(units))
    return first


def _decode(rows: DataFrame, kind: _Kind, options: IngestOptions) -> DataFrame:
    if kind.kind == "JSON":
        return D.decode_json(rows, kind.schema)
    if kind.kind == "AVRO":
        return D.decode_typed(rows, kind.schema)
    return D.decode_primitive(rows, kind.kind, options.field_name)


def _keyed_only(decoded: DataFrame, options: IngestOptions) -> DataFrame:
    """Rows without a record key are rejected: under one key they would replace each other."""
    fields = [f"_row.{p.strip()}" for p in options.record_key.split(",")]
    given = F.lit(False)
    for f in fields:
        given = given | (F.trim(F.coalesce(F.col(f).cast("string"), F.lit(""))) != "")
    return decoded.withColumn(D.REASON, F.coalesce(F.col(D.REASON), F.when(~given, D.NO_KEY)))


def _unit_rows(decoded: DataFrame, kind: _Kind, options: IngestOptions) -> DataFrame:
    """Table rows of accepted messages, with their commit token."""
    good = decoded.where(F.col(D.REASON).isNull())
    columns = [F.col(f"_row.`{f.name}`").alias(f.name) for f in kind.schema.fields]
    if options.layout != "keyed":
        return good.select(*columns, L.DATA_COMMIT)
    rows = good.select(*columns, F.col("msg_id").alias("__msg_id"), L.DATA_COMMIT)
    if options.partition_path:
        rows = rows.withColumn(PARTITION_PATH, records.record_key(options.partition_path))
    rows = rows.withColumn("__key", records.record_key(options.record_key))
    return keyed.last_per_key(rows, "__key", "__msg_id", [L.DATA_COMMIT]).drop("__key", "__msg_id")


def _tag(spark: SparkSession, rows: DataFrame, parts: list[_Part]) -> DataFrame:
    """Rows of the given parts with their commit token in ``_commit``."""
    if len(parts) == 1:
        p = parts[0]
        return rows.where((F.col("_run") == p.run) & (F.col("_group") == p.group)).withColumn(
            L.DATA_COMMIT, F.lit(p.token)
        )
    names = spark.createDataFrame(
        [(p.run, p.group, p.token) for p in parts], f"_run bigint, _group bigint, {L.DATA_COMMIT} string"
    )
    return rows.join(F.broadcast(names), ["_run", "_group"])  # one row per commit


def ingest_batch(
    messages: DataFrame,
    options: IngestOptions,
    batch_id: int | None = None,
    reject_sink: RejectSink | None = None,
    check_replay: bool = True,
    timestamp: int | None = None,
    state: L.TableState | None = None,
    reached: Callable[[str], None] | None = None,
) -> IngestResult:
    """Ingest one batch, under the next batch id of the application if none is given.

    A repeated call with the same batch id and messages adds only what is missing. The log keeps the least and greatest
    message id and the number of messages of each batch, and a batch that differs from them is an error.

    Unusable messages go to ``reject_sink`` with a reason, or stop the batch with ``fail_fast``. A failing write or
    publish is tried again until the failure budget is used up. ``state`` is what the caller, as the only writer,
    knows from the batch before; it is brought up to date. ``reached`` is told of each try's steps, ``written`` before its
    commits are published and ``published`` after; what it raises comes up as if the process had ended there.
    """
    spark = messages.sparkSession
    path = options.table_path.rstrip("/")
    L.storage_options(spark, path, options.storage)
    if batch_id is None:
        batch_id, check_replay = L.last_batch(spark, path, options.app_id) + 1, False
    judged = D.classify(messages)
    kinds, dictionary, rejects = _kinds(judged, options)
    if rejects and options.fail_fast:
        raise D.RejectedMessage(f"unusable messages: {rejects}")
    result = IngestResult(rejected=sum(rejects.values()))
    rejected = [judged.where(F.col(D.REASON).isNotNull()).withColumnRenamed(D.REASON, "reason")]
    if kinds:
        rows = _with_kind(spark, judged, dictionary)
        if any(d[2] < 0 for d in dictionary):
            rejected.append(rows.where("_kind < 0").withColumn("reason", F.lit(D.BAD_SCHEMA)))
            rows = rows.where("_kind >= 0")
        rows, parts = _parts(rows, kinds, options)
        if len(parts) > len(kinds) and len(kinds) > 1:
            rows = pinned(rows, "ranked")  # ranks and runs are used by one write job per schema
        failures, published = 0, []
        while True:
            try:
                if state is None or failures:
                    fresh = L.table_state(spark, path)
                    state = state or fresh
                    state.version, state.history, state.row_bytes = fresh.version, fresh.history, fresh.row_bytes
                done = _write_parts(spark, path, rows, parts, options, batch_id, result, rejected,
                                    check_replay or failures > 0, timestamp, state, reached or (lambda step: None))
                published += done
                break
            except (D.RejectedMessage, S.UnsupportedSchema, ReplayMismatch, AnalysisException):
                raise  # another try would end the same way
            except FLUSH_ERRORS as e:
                if options.fail_fast and "USER_RAISED_EXCEPTION" in str(e):
                    raise D.RejectedMessage(str(e)) from e
                failures += 1
                if failures > options.commit_failures:
                    raise CommitFailed(f"batch {batch_id} failed {failures} times") from e
                _log.warning("batch %s failed %s times: %s", batch_id, failures, e)
        result.versions = published
    elif any(d[2] < 0 for d in dictionary):
        rejected.append(_with_kind(spark, judged, dictionary).withColumn("reason", F.lit(D.BAD_SCHEMA)))
    if result.rejected:
        _deliver_rejects(rejected, reject_sink, batch_id, result.rejected)
    return result


def _span(parts: list[_Part]) -> tuple[int, int, int]:
    """Least and greatest message id and number of the usable messages."""
    kinds = {p.kind.number: p.kind for p in parts}.values()
    return min(k.first for k in kinds), max(k.last for k in kinds), sum(k.count for k in kinds)


def _write_parts(
    spark: SparkSession, path: str, rows: DataFrame, parts: list[_Part], options: IngestOptions, batch_id: int,
    result: IngestResult, rejected: list[DataFrame], check_replay: bool, timestamp: int | None,
    state: L.TableState, reached: Callable[[str], None],
) -> list[int]:
    done = L.committed_parts(spark, path, options.app_id, batch_id) if check_replay else {}
    span = _span(parts)
    if any(seen != span for seen in done.values() if seen is not None):
        raise ReplayMismatch(f"batch {batch_id} of {options.app_id} was {sorted(set(done.values()))}, now {span}")
    todo = [p for p in parts if p.number not in done]
    result.replayed = len(parts) - len(todo)
    if not todo:
        return []
    history = state.history
    used = {S.physical_name(f) for e in history for f in e.schema.fields}
    partition_columns = list(history[-1].partition_columns) if history else list(options.partition_columns)
    if not history and options.layout == "keyed" and options.partition_path:
        partition_columns = [PARTITION_PATH]
    first = _plan_schemas(todo, options, history[-1].schema if history else None, used)
    for p in todo:
        p.token = W.new_token()
    result.accepted, bad = 0, 0
    decode_rejects = []
    for unit in sorted({p.unit for p in todo}):  # one write job per distinct schema
        mine = [p for p in todo if p.unit == unit]
        kind, target = mine[0].kind, mine[0].target
        decoded = _decode(_tag(spark, rows, mine), kind, options)
        if options.layout == "keyed":
            decoded = _keyed_only(decoded, options)
        if options.fail_fast:
            reason = F.col(D.REASON)
            decoded = decoded.withColumn(D.REASON, F.when(reason.isNotNull(), F.raise_error(reason)))
        seen = Observation()
        watched = decoded.observe(seen, F.count(F.lit(1)).alias("total"), F.count(D.REASON).alias("errors"))
        W.write_files(
            _unit_rows(watched, kind, options), path, target, partition_columns, options.compression,
            multi_commit=len(mine) > 1, rows_per_file=options.records_per_file, n_rows=sum(p.rows for p in mine),
            row_bytes=state.row_bytes, target_bytes=options.target_file_bytes,
        )
        counts = seen.get
        result.accepted += counts["total"] - counts["errors"]
        bad += counts["errors"]
        if counts["errors"]:
            decode_rejects.append(decoded.where(F.col(D.REASON).isNotNull()).withColumnRenamed(D.REASON, "reason"))
    commits = []
    if not history:
        commits.append(L.Commit(W.new_token(), "CREATE TABLE", first, partition_columns, None, timestamp))
    for p in todo:
        if p.changes_schema:
            commits.append(L.Commit(W.new_token(), "UPGRADE SCHEMA", p.target, partition_columns, None, timestamp))
        commits.append(L.Commit(p.token, "WRITE", txn=(options.app_id, batch_id, p.number, *span), timestamp=timestamp))
    reached("written")
    out = W.publish_written(spark, path, todo[-1].target, partition_columns, commits, state.version, options.stats_columns)
    reached("published")
    for c in commits:
        if c.schema is not None and c.version is not None:
            state.learn(c.version, c.schema, partition_columns)
    state.version = out[-1] if out else state.version
    if state.row_bytes is None and out:
        state.row_bytes = L.row_bytes(spark, path, state.version)
    rejected += decode_rejects
    result.rejected += bad
    return [v for v in out if v > 0]  # version 0 only creates the table


def _deliver_rejects(rejected: list[DataFrame], sink: RejectSink | None, batch_id: int, count: int) -> None:
    if sink is None:
        warnings.warn(f"batch {batch_id}: {count} unusable messages and no reject sink", stacklevel=3)
        return
    columns = ["msg_id", "schema_type", "schema", "payload", "reason"]
    out = None
    for df in rejected:
        part = df.select(*columns)
        out = part if out is None else out.unionByName(part)
    sink(out, batch_id)


def reject_folder(path: str) -> RejectSink:
    """A reject sink writing one folder per batch; a replayed batch replaces its own folder."""

    def write(df: DataFrame, batch_id: int) -> None:
        df.write.mode("overwrite").parquet(f"{path.rstrip('/')}/batch={batch_id}")

    return write
