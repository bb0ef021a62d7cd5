"""Where a feed starts: fresh, or resumed from saved checkpoints."""

from __future__ import annotations

import time
from collections.abc import Iterator, Mapping, Sequence
from dataclasses import dataclass, field
from functools import cached_property

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tableflow.functions import cursor as C
from tableflow.operators import changes as CH
from tableflow.options import LATEST, FeedOptions
from tableflow.session import pinned
from tableflow.sources import log as L


class ResumeError(RuntimeError):
    """A saved checkpoint points to a version the table no longer has."""


@dataclass(frozen=True)
class Start:
    """Start mode and version, with the checkpoint of every owned slot."""

    mode: str
    version: int
    checkpoints: dict[int, C.Cursor] = field(default_factory=dict)
    resumed: bool = False


def slots_of(n_slots: int, instance: int = 0, instances: int = 1) -> list[int]:
    return [s for s in range(n_slots) if s % instances == instance]


def resolve_start(spark: SparkSession, options: FeedOptions) -> C.Cursor:
    """Start without saved state: by version, else by time, else the latest. The start version is included.

    A full copy needs history to be asked for and a version that could be resolved.
    """
    path = options.table_path
    if options.start_version is not None:
        found = L.resolve_version(spark, path, options.start_version)
    elif options.start_timestamp is not None:
        found = L.resolve_timestamp(spark, path, options.start_timestamp)
    else:
        found = L.resolve_version(spark, path, LATEST)
    full = options.fetch_history and not found.out_of_range
    return C.Cursor(C.FULL if full else C.INCREMENTAL, found.version)


def restore(
    spark: SparkSession,
    options: FeedOptions,
    saved: Mapping[str, str],
    instance: int = 0,
    instances: int = 1,
) -> Start | None:
    """Start position from a state store of ``checkpoint<slot>`` JSON texts; None when no slot is owned.

    With saved state the least checkpoint leads and slots without one take it over. A table whose oldest usable
    version lies beyond it is an error, since changes in between would be lost.
    """
    slots = slots_of(max(options.n_slots, 1), instance, instances)
    if not slots:
        return None
    known = {s: C.Cursor.from_json(saved[C.state_key(s)]) for s in slots if C.state_key(s) in saved}
    if not known:
        first = resolve_start(spark, options)
        return Start(first.state, first.version, dict.fromkeys(slots, first))
    least = C.minimum(known)
    usable = L.resolve_version(spark, options.table_path, least.version).version
    if usable > least.version:
        raise ResumeError(f"checkpoint version {least.version} does not exist, the table is at {usable}")
    return Start(least.state, least.version, {s: known.get(s, least) for s in slots}, resumed=True)


def feed(
    spark: SparkSession,
    options: FeedOptions,
    saved: Mapping[str, str] | None = None,
    end: int | None = None,
    capture_ts: int | None = None,
    positions: bool = False,
    instance: int = 0,
    instances: int = 1,
) -> DataFrame | None:
    """The change feed as options and saved checkpoints describe it."""
    L.storage_options(spark, options.table_path, options.storage)
    start = restore(spark, options, saved or {}, instance, instances)
    if start is None:
        return None
    return CH.changes(
        spark,
        options.table_path,
        start.version,
        end,
        full=start.mode == C.FULL,
        n_slots=options.n_slots,
        checkpoints=start.checkpoints if start.resumed else None,
        include_rewrites=options.include_rewrites,
        owner=(instance, instances) if instances > 1 else None,
        capture_ts=capture_ts,
        positions=positions,
    )


@dataclass(frozen=True)
class _Laid:
    """A feed that is laid out for rounds: its file actions, and what their records are made with."""

    spark: SparkSession
    path: str
    acts: DataFrame
    last: int
    capture_ts: int | None
    first_version: int
    history: list[L.Epoch]

    def records(self, acts: DataFrame) -> DataFrame:
        return CH.change_records(
            self.spark, self.path, acts, self.last, self.capture_ts, True, from_version=self.first_version, history=self.history
        )


@dataclass(frozen=True)
class Round:
    """A part of a feed: its change records, the cursor per slot once they are handled, and where it ends.

    Records and cursors are planned when they are asked for, so that a long list of rounds costs nothing.
    """

    number: int
    end: CH.RoundEnd
    last_version: int
    after: CH.RoundEnd | None
    laid: _Laid = field(repr=False)

    @cached_property
    def actions(self) -> DataFrame:
        return CH.round_actions(self.laid.acts, self.after, self.end)

    @cached_property
    def records(self) -> DataFrame:
        return self.laid.records(self.actions)

    @cached_property
    def cursors(self) -> DataFrame:
        return C.furthest(self.actions)


def all_records(rounds: Sequence[Round]) -> DataFrame:
    """The change records of rounds that follow each other, with ``_round``, read by one scan and not by one a round."""
    first, laid = rounds[0], rounds[0].laid
    acts = CH.round_actions(laid.acts, first.after, rounds[-1].end)
    return laid.records(pinned(CH.numbered_rounds(acts, [r.end for r in rounds], first.number), "numbered_rounds"))


def feed_rounds(
    spark: SparkSession,
    options: FeedOptions,
    saved: Mapping[str, str] | None = None,
    end: int | None = None,
    capture_ts: int | None = None,
    after: Round | None = None,
    instance: int = 0,
    instances: int = 1,
) -> Iterator[Round]:
    """The feed in rounds of at most ``max_read_rows`` rows and ``max_read_bytes`` bytes of files.

    A round ends at a file, also inside a version, so a version of any size is read in several rounds. Their records with
    positions are together the whole feed. ``after`` is the last round that was handled: another process goes on
    behind it, with the same other arguments; the feed then ends where the first one's did.
    """
    L.storage_options(spark, options.table_path, options.storage)
    start = restore(spark, options, saved or {}, instance, instances)
    if start is None:
        return
    path = options.table_path.rstrip("/")
    if after is not None:
        last = after.last_version
    else:
        last = L.latest_version(spark, path) if end is None else end
    acts = CH.feed_actions(
        spark, path, start.version, last, full=start.mode == C.FULL, n_slots=options.n_slots,
        checkpoints=start.checkpoints if start.resumed else None, include_rewrites=options.include_rewrites,
        owner=(instance, instances) if instances > 1 else None,
    )
    if "min_row" not in acts.columns:
        acts = acts.withColumn("min_row", F.lit(0).cast("bigint"))
    acts = CH.sequence_offsets(CH.with_row_counts(spark, path, acts))
    acts = pinned(CH.laid_out(acts), "rounds")
    # one time of capture for all rounds, as they are one feed
    capture = capture_ts if capture_ts is not None else int(time.time() * 1000)
    laid = _Laid(spark, path, acts, last, capture, start.version, L.epochs(spark, path, last))
    number, at = (after.number + 1, after.end) if after is not None else (0, None)
    for end_of_round in CH.round_ends(acts, at, options.max_read_rows, options.max_read_bytes):
        yield Round(number, end_of_round, last, at, laid)
        number, at = number + 1, end_of_round
