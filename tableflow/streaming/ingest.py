"""Ingest a message stream into a table: one or more commits per micro-batch, each at most once."""

from __future__ import annotations

import json
from collections.abc import Mapping
from dataclasses import replace

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.streaming import StreamingQuery

from tableflow.options import IngestOptions
from tableflow.plans.ingest import IngestResult, RejectSink, ingest_batch
from tableflow.sources import log as L


def _query_id(spark: SparkSession, checkpoint: str) -> str:
    """The id that a streaming query keeps over restarts."""
    text = spark.read.text(f"{checkpoint.rstrip('/')}/metadata").first()[0]
    return json.loads(text)["id"]


def ingest_stream(
    messages: DataFrame,
    options: IngestOptions,
    checkpoint: str,
    reject_sink: RejectSink | None = None,
    trigger: Mapping[str, object] | None = None,
    results: list[IngestResult] | None = None,
    query_name: str | None = None,
) -> StreamingQuery:
    """Start ingestion. The commit interval is the trigger interval; the record limit splits a batch further.

    Progress moves on only after a batch is committed. A batch that is run again after a crash finds its commits in
    the log by application and batch id and adds only the missing ones. The application id includes the query id that
    Spark keeps in the checkpoint, so another stream, or the same one from a new checkpoint, counts batches of its own.
    ``results`` collects one entry per batch.
    """
    state: L.TableState | None = None
    own: IngestOptions | None = None

    def handle(batch: DataFrame, batch_id: int) -> None:
        nonlocal state, own
        own = own or replace(options, app_id=f"{options.app_id}-{_query_id(batch.sparkSession, checkpoint)}")
        # a failed batch ends the query, so only the first batch of a run can be a replay
        replay = state is None
        L.storage_options(batch.sparkSession, options.table_path, options.storage)
        state = state or L.table_state(batch.sparkSession, options.table_path)
        done = ingest_batch(batch, own, batch_id, reject_sink, check_replay=replay, state=state)
        if results is not None:
            results.append(done)

    w = messages.writeStream.foreachBatch(handle).option("checkpointLocation", checkpoint)
    if query_name:
        w = w.queryName(query_name)
    return w.trigger(**(trigger or {"processingTime": f"{options.commit_interval_s} seconds"})).start()
