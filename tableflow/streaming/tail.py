"""Tail a table's log as a stream and hand change records to a writer, round by round.

The stream only announces log files. Each micro-batch works on a version range that starts where the previous batch
ended, so the order in which the file source lists files does not matter and no version is skipped. A range is read
in one round, or in several where the options limit rounds; a round may end inside a version. The range, the limits and the
per-slot sequence numbers are written before records are handed on, and each round's end after its records are written:
a replayed batch finds them, goes on behind the last finished round, and repeats exactly the same records.

Cursors of finished rounds are told from file actions and row counts; no row is read for them. They are exported when the
interval has passed and when the query ends, and kept with the rounds until then, so a restart exports what a crash held up.
"""

from __future__ import annotations

import json
import threading
import time
from collections.abc import Callable, Mapping
from dataclasses import dataclass, replace

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from tableflow import storage
from tableflow.functions import cursor as C
from tableflow.operators import changes as CH
from tableflow.options import FeedOptions
from tableflow.plans import start as ST
from tableflow.session import pinned
from tableflow.sources import log as L

Writer = Callable[[DataFrame, int], None]
CursorSink = Callable[[DataFrame, int], None]

_LISTING = "path string, modificationTime timestamp, length bigint, content binary"
_STATE = (
    "batch bigint, start bigint, end bigint, is_full boolean, started boolean, first_id bigint, max_rows bigint, max_bytes bigint, "
    "slot int, next_seq bigint"
)
_BEGIN = "mode string, version bigint, resumed boolean, slot int, cursor string"
_ROUND = (
    "id bigint, state string, version bigint, index bigint, rows bigint, bytes bigint, last_of_batch boolean, exported boolean, "
    "exported_at double, slot int, cursor string"
)
_CURSOR = "slot int, state_key string, cursor string"


class FeedClosing(RuntimeError):
    """A batch came while the feed was being drained; it is left to the next run."""


@dataclass(frozen=True)
class _Range:
    """Versions of one batch, and how they are read. Until the start version is there, ranges are empty and ``started`` is off."""

    start: int
    end: int
    full: bool
    seq: dict[int, int]
    started: bool
    first_id: int
    max_rows: int | None = None
    max_bytes: int | None = None

    @property
    def empty(self) -> bool:
        return self.end < self.start


@dataclass
class _Done:
    """A finished round: where it ended, and the furthest cursor of every slot so far."""

    id: int
    end: CH.RoundEnd | None
    last_of_batch: bool
    cursors: dict[int, str]
    exported: bool
    exported_at: float


class _State:
    """Where the feed began, ranges by batch and finished rounds: a small folder each, at most one row per slot."""

    def __init__(self, spark: SparkSession, folder: str):
        self.spark, self.folder = spark, folder

    def _read(self, name: str, schema: str) -> list:
        path = f"{self.folder}/{name}"
        if not storage.exists(self.spark, f"{path}/_SUCCESS"):
            return []
        return self.spark.read.schema(schema).json(path).collect()

    def _write(self, name: str, rows: list[tuple], schema: str) -> None:
        self.spark.createDataFrame(rows, schema).coalesce(1).write.mode("overwrite").json(f"{self.folder}/{name}")

    def begin(self, resolve: Callable[[], ST.Start]) -> ST.Start:
        """The start of the first run; ``resolve`` is only asked when none is stored."""
        rows = self._read("begin", _BEGIN)
        if not rows:
            first = resolve()
            self._write("begin", [(first.mode, first.version, first.resumed, s, c.to_json()) for s, c in first.checkpoints.items()], _BEGIN)
            rows = self._read("begin", _BEGIN)
        head = rows[0]
        known = {r["slot"]: C.Cursor.from_json(r["cursor"]) for r in rows}
        return ST.Start(head["mode"], head["version"], known, head["resumed"])

    def batch(self, number: int) -> _Range | None:
        rows = self._read(f"batch={number}", _STATE) if number >= 0 else []
        if not rows:
            return None
        head = rows[0]
        seq = {r["slot"]: r["next_seq"] for r in rows if r["slot"] is not None}
        first = number if head["first_id"] is None else head["first_id"]
        return _Range(head["start"], head["end"], head["is_full"], seq, head["started"], first, head["max_rows"], head["max_bytes"])

    def keep_batch(self, number: int, r: _Range) -> None:
        head = (number, r.start, r.end, r.full, r.started, r.first_id, r.max_rows, r.max_bytes)
        self._write(f"batch={number}", [(*head, s, n) for s, n in r.seq.items()] or [(*head, None, None)], _STATE)

    def round(self, number: int) -> _Done | None:
        rows = self._read(f"rounds/id={number}", _ROUND)
        if not rows:
            return None
        h = rows[0]
        end = None if h["version"] is None else CH.RoundEnd(h["state"], h["version"], h["index"], h["rows"], h["bytes"])
        cursors = {r["slot"]: r["cursor"] for r in rows if r["slot"] is not None}
        return _Done(number, end, h["last_of_batch"], cursors, h["exported"], h["exported_at"])

    def keep_round(self, d: _Done) -> None:
        e = (d.end.state, d.end.version, d.end.index, d.end.rows, d.end.bytes) if d.end else (None,) * 5
        head = (d.id, *e, d.last_of_batch, d.exported, d.exported_at)
        self._write(f"rounds/id={d.id}", [(*head, s, c) for s, c in d.cursors.items()] or [(*head, None, None)], _ROUND)

    def last_round(self) -> _Done | None:
        """The last finished round; a folder without its mark of success is one that a crash cut off."""
        ids = sorted(int(n[3:]) for n in storage.folders(self.spark, f"{self.folder}/rounds") if n.startswith("id="))
        for number in reversed(ids[-2:]):
            if (found := self.round(number)) is not None:
                return found
        return None


class _Export:
    """The furthest cursors and the clock of their export."""

    def __init__(self, spark: SparkSession, sink: CursorSink | None, interval: float, clock: Callable[[], float], last: _Done | None):
        self.spark, self.sink, self.interval, self.clock = spark, sink if interval > 0 else None, interval, clock
        self.cursors = dict(last.cursors) if last else {}
        self.pending_id = last.id if last and not last.exported and last.cursors else None
        self.at = last.exported_at if last else clock()

    def add(self, cursors: dict[int, str], number: int) -> bool:
        """Take a round's cursors; whether all cursors are exported now."""
        for slot, text in cursors.items():
            known = self.cursors.get(slot)
            if known is None or C.Cursor.from_json(known) < C.Cursor.from_json(text):
                self.cursors[slot] = text
        if cursors:
            self.pending_id = number
        if self.clock() - self.at >= self.interval:
            self.flush()
        return self.pending_id is None

    def flush(self) -> int | None:
        """Hand over what is pending; the id of its last round."""
        number = self.pending_id
        if self.sink is None or number is None:
            return None
        rows = [(s, C.state_key(s), c) for s, c in sorted(self.cursors.items())]
        self.sink(self.spark.createDataFrame(rows, _CURSOR), number)
        self.pending_id, self.at = None, self.clock()
        return number


class FeedQuery(StreamingQuery):
    """A running tail: a streaming query whose end exports the cursors that are still held back.

    ``rounds`` has a dict per finished round of this run: id, files, rows, bytes, and the milliseconds for reading the log,
    planning the round, and reading, parsing and writing its rows.
    """

    def __init__(self, query: StreamingQuery, finish: Callable[[], None], closing: threading.Event, busy: threading.Lock, rounds: list[dict]):
        super().__init__(query._jsq)
        self._finish, self._closing, self._busy, self.rounds = finish, closing, busy, rounds

    def awaitTermination(self, timeout: int | None = None) -> bool | None:
        try:
            return super().awaitTermination(timeout)
        finally:
            if not self.isActive:
                self._finish()

    def stop(self) -> None:
        super().stop()
        self._finish()

    def drain(self) -> None:
        """Stop after the batch that is being worked on: its records are written, its end is stored, its cursors exported."""
        self._closing.set()
        with self._busy:
            pass
        self.stop()

    def exception(self):
        found = super().exception()
        return None if found is not None and self._closing.is_set() and FeedClosing.__name__ in str(found) else found


def _check_versions(acts_versions: list[int], start: int, end: int, path: str) -> None:
    if end >= start and len(acts_versions) != end - start + 1:
        gone = sorted(set(range(start, end + 1)) - set(acts_versions))
        raise L.LogError(f"log of {path} lacks versions {gone[:10]}")


def tail_changes(
    spark: SparkSession,
    options: FeedOptions,
    writer: Writer,
    checkpoint: str,
    saved: Mapping[str, str] | None = None,
    versions_per_trigger: int | None = None,
    trigger: Mapping[str, object] | None = None,
    positions: bool = True,
    capture_ts: int | None = None,
    cursor_sink: CursorSink | None = None,
    query_name: str | None = None,
    clock: Callable[[], float] = time.time,
) -> FeedQuery:
    """Start the change feed as a streaming query that calls ``writer(records, id)`` for each round.

    The first run starts as ``options`` and ``saved`` say and stores what that came to; later runs continue from
    ``checkpoint`` and do not look at them again. Ids grow; without limits they are those of the micro-batches. Delivery is
    at-least-once by record and exactly-once for writers that replace a round by its id: only a round whose end could not be
    stored comes again. ``cursor_sink`` receives the furthest cursor per slot (slot, state_key, cursor) and the id of the
    last round they cover, when the checkpoint interval has passed, at the end, and first of all what an earlier run left.
    An exception in the writer ends the query.
    """
    path = options.table_path.rstrip("/")
    L.storage_options(spark, path, options.storage)
    state = _State(spark, f"{checkpoint.rstrip('/')}/feed_state")
    begin = state.begin(lambda: ST.restore(spark, options, saved or {}))
    resume = begin.checkpoints if begin.resumed else None
    limits = (options.max_read_rows, options.max_read_bytes) if options.limit_rounds else (None, None)
    counted = positions or options.limit_rounds or (cursor_sink is not None and options.periodic_checkpoint)
    latest = state.last_round()
    export = _Export(spark, cursor_sink, options.checkpoint_interval_s, clock, latest)
    busy, closing, rounds = threading.Lock(), threading.Event(), []

    def finish() -> None:
        with busy:
            if (number := export.flush()) is not None and (end := state.round(number)) is not None:
                state.keep_round(replace(end, cursors=dict(export.cursors), exported=True, exported_at=export.at))

    finish()

    # log files are only listed here, their content is read batch by batch
    log = spark.readStream.options(**storage.options_of(spark, path)).format("binaryFile").schema(_LISTING).option("pathGlobFilter", "[0-9]*.json")
    if versions_per_trigger:
        log = log.option("maxFilesPerTrigger", versions_per_trigger)
    name = F.substring_index(F.substring_index("path", "/", -1), ".", 1)
    names = log.load(storage.glob_safe(L.log_dir(path))).select(name.cast("bigint").alias("version"))
    known = L.TableState(-1, [])

    done: dict[int, _Range] = {}  # the last batch of this run; earlier ones are in the state folder
    next_id = [latest.id + 1 if latest else 0]

    def next_range(batch: DataFrame, prev: _Range | None, batch_id: int) -> _Range:
        top = batch.agg(F.max("version")).first()[0]
        started = prev is not None and prev.started
        first = prev.end + 1 if started else begin.version
        last = first - 1 if top is None else max(top, first - 1)
        seq = dict(prev.seq) if prev else {}
        full = begin.mode == C.FULL and not started and last >= first
        return _Range(first, last, full, seq, started or last >= first, max(batch_id, next_id[0]), *limits)

    def file_actions(r: _Range) -> DataFrame:
        acts = CH.feed_actions(
            spark, path, r.start, r.end, full=r.full, n_slots=options.n_slots, checkpoints=resume, include_rewrites=options.include_rewrites
        )
        if not counted:
            return acts
        if "min_row" not in acts.columns:
            acts = acts.withColumn("min_row", F.lit(0).cast("bigint"))
        acts = CH.with_row_counts(spark, path, acts)
        if positions:
            acts = CH.sequence_offsets(acts)
        return pinned(CH.laid_out(acts) if r.max_rows is not None else acts, "counted")

    def summary(acts: DataFrame) -> list:
        """Per slot: files, bytes, rows to hand on and the furthest cursor."""
        return C.furthest(acts, totals=True).collect()

    def parts(acts: DataFrame, r: _Range, after: CH.RoundEnd | None):
        """(actions, end, whether it is the last) of each round; the end of an unlimited one is not looked for."""
        if r.max_rows is None:
            yield acts, None, True
            return
        ends = CH.round_ends(acts, after, r.max_rows, r.max_bytes)
        end = next(ends, None)
        while end is not None:
            further = next(ends, None)
            yield CH.round_actions(acts, after, end), end, further is None
            after, end = end, further

    def hand_on(
        acts: DataFrame, r: _Range, offsets: dict[int, int], number: int, end: CH.RoundEnd | None, last: bool, log_ms: int, slots: list | None
    ) -> None:
        began = time.time()
        records = CH.change_records(
            spark, path, acts, r.end, capture_ts, positions, seq_start=offsets, from_version=r.start, history=list(known.history)
        )
        planned = time.time()
        writer(records, number)
        wrote = time.time()
        slots = summary(acts) if slots is None and counted else slots or []
        cursors = {}
        for row in slots if export.sink is not None else []:
            if row.cursor is not None:
                c = C.Cursor.from_json(row.cursor)
                cursors[row.slot] = replace(c, seq=c.seq + offsets.get(row.slot, 0)).to_json() if positions else row.cursor
        exported = export.add(cursors, number)
        state.keep_round(_Done(number, end, last, dict(export.cursors), exported, export.at))
        next_id[0] = number + 1
        rounds.append({
            "id": number, "first_version": r.start, "last_version": r.end, "files": sum(x.files for x in slots),
            "rows": sum(x.rows for x in slots), "bytes": sum(x.bytes for x in slots), "log_ms": log_ms,
            "plan_ms": int((planned - began) * 1000), "read_and_write_ms": int((wrote - planned) * 1000),
        })

    def handle(batch: DataFrame, batch_id: int) -> None:
        with busy:
            if closing.is_set():
                raise FeedClosing(f"batch {batch_id} is left to the next run")
            work(batch, batch_id)

    def work(batch: DataFrame, batch_id: int) -> None:
        prev = done.get(batch_id - 1) or state.batch(batch_id - 1)
        replayed = None if done else state.batch(batch_id)  # only the first batch of a run can be a replay
        r = replayed or next_range(batch, prev, batch_id)
        if r.empty:
            state.keep_batch(batch_id, r)
            done.clear()
            done[batch_id] = r
            return
        began = time.time()
        seen = L.log_versions(spark, path).where(F.col("version").between(r.start, r.end)).select("version").collect()
        _check_versions([x[0] for x in seen], r.start, r.end, path)
        acts = file_actions(r)
        offsets = prev.seq if prev else {}
        slots = summary(acts) if counted and (positions and replayed is None or r.max_rows is None) else None
        if replayed is None:
            after = dict(offsets)
            if positions:
                for row in slots:
                    after[row.slot] = after.get(row.slot, 0) + row.rows
            r = replace(r, seq=after, started=True)
            state.keep_batch(batch_id, r)
        number, end, over = r.first_id, None, False
        while replayed is not None and (finished := state.round(number)) is not None:
            number, end, over = number + 1, finished.end, finished.last_of_batch
        if not over:
            known.catch_up(spark, path, r.end)
            log_ms = int((time.time() - began) * 1000)
            for part, end, last in parts(acts, r, end):
                hand_on(part, r, offsets, number, end, last, log_ms, slots if r.max_rows is None else None)
                number += 1
        next_id[0] = max(next_id[0], number)
        done.clear()
        done[batch_id] = r

    w = names.writeStream.foreachBatch(handle).option("checkpointLocation", checkpoint)
    if query_name:
        w = w.queryName(query_name)
    return FeedQuery(w.trigger(**(trigger or {"processingTime": "10 seconds"})).start(), finish, closing, busy, rounds)


def cursor_file(path: str) -> CursorSink:
    """A cursor sink that keeps each export as one JSON object of state keys, the form ``saved`` takes, in a folder of its own."""

    def write(df: DataFrame, number: int) -> None:
        text = json.dumps({r.state_key: r.cursor for r in df.collect()}, sort_keys=True)  # a row per slot
        df.sparkSession.createDataFrame([(text,)], "value string").coalesce(1).write.mode("overwrite").text(f"{path.rstrip('/')}/id={number}")

    return write


def saved_cursors(spark: SparkSession, path: str) -> dict[str, str]:
    """The last export of a ``cursor_file``."""
    ids = [int(n[3:]) for n in storage.folders(spark, path) if n.startswith("id=") and storage.exists(spark, f"{path}/{n}/_SUCCESS")]
    if not ids:
        return {}
    return json.loads(spark.read.text(f"{path.rstrip('/')}/id={max(ids)}").first()[0])


def slot_folder(path: str) -> Writer:
    """A writer that keeps records in ``batch=<id>/_slot=<n>`` folders; replays replace their round."""

    def write(df: DataFrame, number: int) -> None:
        df.write.mode("overwrite").partitionBy("_slot").parquet(f"{path.rstrip('/')}/batch={number}")

    return write
