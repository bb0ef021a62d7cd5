"""Read cursors: ordering, resume filter and JSON form.

A cursor is ``(state, version, index, row)``. Full-copy positions sort before incremental ones whatever their
versions, then version, index and row decide; the sequence count never does.
"""

from __future__ import annotations

import json
from collections.abc import Mapping
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

FULL, INCREMENTAL = "FULL_COPY", "INCREMENTAL_COPY"
_RANK = {FULL: 0, INCREMENTAL: 1}

JSON_SCHEMA = "state string, snapShotVersion bigint, metadataChangeFileIndex bigint, rowNum bigint, seqCount bigint"


@dataclass(frozen=True)
class Cursor:
    state: str
    version: int
    index: int = 0
    row: int = 0
    seq: int = 0

    def __post_init__(self):
        if self.state not in _RANK:
            raise ValueError(f"unknown cursor state: {self.state!r}")

    @property
    def action_position(self) -> tuple[int, int, int]:
        return (_RANK[self.state], self.version, self.index)

    @property
    def position(self) -> tuple[int, int, int, int]:
        return (*self.action_position, self.row)

    def __lt__(self, other: Cursor) -> bool:
        return self.position < other.position

    def compare(self, other: Cursor) -> int:
        return (self.position > other.position) - (self.position < other.position)

    def to_json(self) -> str:
        return json.dumps(
            {"state": self.state, "snapShotVersion": self.version, "metadataChangeFileIndex": self.index,
             "rowNum": self.row, "seqCount": self.seq}
        )

    @staticmethod
    def from_json(text: str) -> Cursor:
        """Unknown fields are ignored; text that is no cursor raises ValueError."""
        try:
            d = json.loads(text)
            return Cursor(
                d["state"], int(d["snapShotVersion"]), int(d.get("metadataChangeFileIndex") or 0),
                int(d.get("rowNum") or 0), int(d.get("seqCount") or 0),
            )
        except (json.JSONDecodeError, KeyError, TypeError) as e:
            raise ValueError(f"not a cursor: {text!r}") from e


def state_key(slot: int) -> str:
    return f"checkpoint{slot}"


def state_key_column(slot: Column) -> Column:
    return F.format_string("checkpoint%d", slot)


def state_rank(is_full: Column) -> Column:
    return F.when(is_full, 0).otherwise(1)


def position(is_full: Column, version: Column, index: Column, row: Column | None = None) -> Column:
    """Cursor columns as one struct; struct order is cursor order."""
    parts = [state_rank(is_full).alias("state"), version.cast("bigint").alias("version"),
             index.cast("bigint").alias("index")]
    if row is not None:
        parts.append(row.cast("bigint").alias("row"))
    return F.struct(*parts)


def cursor_json(is_full: Column, version: Column, index: Column, row: Column, seq: Column) -> Column:
    """Cursor columns as the stored JSON text."""
    return F.to_json(
        F.struct(
            F.when(is_full, FULL).otherwise(INCREMENTAL).alias("state"),
            version.cast("bigint").alias("snapShotVersion"),
            index.cast("bigint").alias("metadataChangeFileIndex"),
            row.cast("bigint").alias("rowNum"),
            seq.cast("bigint").alias("seqCount"),
        )
    )


def parse_cursor_json(text: Column) -> Column:
    """Stored JSON text as a struct; text that does not parse fails the job."""
    return F.from_json(text, JSON_SCHEMA, {"mode": "FAILFAST"})


def checkpoints_frame(spark: SparkSession, checkpoints: Mapping[int, Cursor]) -> DataFrame:
    """Checkpoints as rows. There is one per slot, so the slot count bounds the frame."""
    rows = [(s, *c.position) for s, c in checkpoints.items()]
    return spark.createDataFrame(rows, "slot int, c_state int, c_version bigint, c_index bigint, c_row bigint")


def resume_filter(actions: DataFrame, checkpoints: DataFrame, inclusive: bool = True) -> DataFrame:
    """Drop actions before their slot's checkpoint and set ``min_row``, the first row still wanted.

    ``actions`` has ``slot, is_full, version, idx``. A slot without checkpoint keeps everything. With
    ``inclusive`` the checkpointed row itself is read again (at-least-once).
    """
    at = F.struct(F.col("c_state").alias("state"), F.col("c_version").alias("version"), F.col("c_index").alias("index"))
    here = position(F.col("is_full"), F.col("version"), F.col("idx"))
    first = F.greatest(F.col("c_row") + (0 if inclusive else 1), F.lit(0))
    joined = actions.join(F.broadcast(checkpoints), "slot", "left")
    return (
        joined.where(F.col("c_state").isNull() | (here >= at))
        .withColumn("min_row", F.when(F.col("c_state").isNotNull() & (here == at), first).otherwise(F.lit(0)))
        .drop("c_state", "c_version", "c_index", "c_row")
    )


def acknowledged(records: DataFrame) -> DataFrame:
    """The furthest cursor per slot among handled change records, in stored form (one row per slot)."""
    seq = F.col("_seq") if "_seq" in records.columns else F.lit(0)
    # rows are reduced by a hash aggregate over plain numbers first; the struct is compared per file only
    files = records.groupBy("_slot", "_is_full", "_version", "_action_idx").agg(
        F.max("_row_num").alias("_row_num"), F.max(seq.cast("bigint")).alias("seq")
    )
    pos = position(F.col("_is_full"), F.col("_version"), F.col("_action_idx"), F.col("_row_num"))
    best = files.groupBy("_slot").agg(F.max(F.struct(pos.alias("p"), F.col("seq"))).alias("m"))
    return best.select(
        F.col("_slot").alias("slot"),
        state_key_column(F.col("_slot")).alias("state_key"),
        cursor_json(F.col("m.p.state") == 0, F.col("m.p.version"), F.col("m.p.index"), F.col("m.p.row"),
                    F.col("m.seq")).alias("cursor"),
    )


def furthest(acts: DataFrame, totals: bool = False) -> DataFrame:
    """The cursor per slot that ``acknowledged`` finds, told from file actions alone: the last row of the last file with rows.

    ``acts`` has ``slot, is_full, version, idx, n_rows, min_row`` and, for sequence counts, ``seq_before``; no row is read.
    ``totals`` adds files, bytes and rows to hand on, and keeps slots without rows, whose cursor is null.
    """
    seq = F.col("seq_before") + F.col("n_rows") - 1 - F.col("min_row") if "seq_before" in acts.columns else F.lit(0)
    pos = position(F.col("is_full"), F.col("version"), F.col("idx"), F.col("n_rows") - 1)
    some = F.col("n_rows") > F.col("min_row")
    last = acts.groupBy("slot").agg(
        F.max(F.when(some, F.struct(pos.alias("p"), seq.alias("seq")))).alias("m"), F.count(F.lit(1)).alias("files"),
        F.sum(F.coalesce("size", F.lit(0))).alias("bytes"), F.sum(F.when(some, F.col("n_rows") - F.col("min_row")).otherwise(0)).alias("rows"),
    )
    cursor = cursor_json(F.col("m.p.state") == 0, F.col("m.p.version"), F.col("m.p.index"), F.col("m.p.row"), F.col("m.seq"))
    out = last.select("slot", state_key_column(F.col("slot")).alias("state_key"), F.when(F.col("m").isNotNull(), cursor).alias("cursor"),
                      "files", "bytes", "rows")
    return out if totals else out.where("cursor is not null").drop("files", "bytes", "rows")


def minimum(checkpoints: Mapping[int, Cursor]) -> Cursor | None:
    return min(checkpoints.values(), key=lambda c: c.position, default=None)
