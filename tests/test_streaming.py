import json
import os

import pytest
from pyspark.sql import functions as F

from helpers import add, info, log, meta, parquet, protocol
from test_ingest import PERSON, WITH_GRADE, messages, person, versions
from tableflow.functions import cursor as C
from tableflow.operators import changes as CH
from tableflow.operators import write as W
from tableflow.options import FeedOptions, IngestOptions
from tableflow.sources import log as L
from tableflow.sources import snapshot as SN
from tableflow.streaming import ingest as SI
from tableflow.streaming import metrics as M
from tableflow.streaming import tail

NOW = {"availableNow": True}


def drain(q):
    q.awaitTermination()
    assert q.exception() is None


def history(spark, path, start, n):
    for v in range(start, start + n):
        W.append(spark, path, spark.range(v * 10, v * 10 + 4).selectExpr("id", "id % 2 as k"), ["k"])


def test_tail_with_restart(spark, table_path, tmp_path):
    out, ck = str(tmp_path / "out"), str(tmp_path / "ck")
    history(spark, table_path, 0, 3)
    o = FeedOptions(table_path, start_version=1, n_slots=3)
    drain(tail.tail_changes(spark, o, tail.slot_folder(out), ck, versions_per_trigger=2, trigger=NOW, capture_ts=1))
    history(spark, table_path, 3, 2)
    W.remove(spark, table_path, SN.live(spark, table_path, 5).where("version = 1"), timestamp=5)
    drain(tail.tail_changes(spark, o, tail.slot_folder(out), ck, versions_per_trigger=2, trigger=NOW, capture_ts=1))
    got = spark.read.parquet(out).drop("batch")
    want = CH.changes(spark, table_path, 1, n_slots=3, positions=True, capture_ts=1).select(*got.columns)
    assert got.count() == 24 and got.exceptAll(want).count() == 0


def test_tail_with_history(spark, table_path, tmp_path):
    out, ck = str(tmp_path / "out"), str(tmp_path / "ck")
    history(spark, table_path, 0, 3)
    o = FeedOptions(table_path, start_version=2, fetch_history=True)
    cursors = []
    drain(tail.tail_changes(spark, o, tail.slot_folder(out), ck, trigger=NOW, capture_ts=1, versions_per_trigger=1,
                            cursor_sink=lambda df, b: cursors.append(df.collect())))
    got = spark.read.parquet(out)
    assert sorted((r["_is_full"], r["id"]) for r in got.collect()) == sorted(
        [(True, i) for v in (0, 1) for i in range(v * 10, v * 10 + 4)] + [(False, i) for i in range(20, 24)])
    last = C.Cursor.from_json(cursors[-1][0]["cursor"])
    assert (last.state, last.version) == (C.INCREMENTAL, 3)


def test_replayed_batch_is_the_same(spark, table_path, tmp_path):
    """The writer fails after the range was chosen; new versions arrive; the replay still hands on the old range."""
    ck, seen = str(tmp_path / "ck"), []
    history(spark, table_path, 0, 2)
    o = FeedOptions(table_path, start_version=0)

    def broken(df, batch):
        raise RuntimeError("sink is down")

    with pytest.raises(Exception, match="sink is down"):
        drain(tail.tail_changes(spark, o, broken, ck, trigger=NOW))
    history(spark, table_path, 2, 1)
    drain(tail.tail_changes(spark, o, lambda df, b: seen.append((b, df.count(), df.agg(F.max("_seq")).first()[0])), ck, trigger=NOW))
    assert seen == [(0, 8, 7), (1, 4, 11)]


def test_log_order_does_not_matter(spark, table_path, tmp_path):
    """Log files with reversed modification times, one per trigger."""
    log(table_path, 0, info(1), protocol(), meta([("a", "long")]))
    for v in (1, 2, 3):
        parquet(table_path, f"f{v}.parquet", {"a": [v]})
        log(table_path, v, info(v), add(f"f{v}.parquet"))
    for v in range(4):
        os.utime(os.path.join(table_path, "_delta_log", L.file_name(v)), (2000 - v, 2000 - v))
    seen = []
    drain(tail.tail_changes(spark, FeedOptions(table_path, start_version=0), lambda df, b: seen.extend(
        r["a"] for r in CH.in_order(df).collect()), str(tmp_path / "ck"), versions_per_trigger=1, trigger=NOW))
    assert seen == [1, 2, 3]


def test_gap_in_the_log_stops(spark, table_path, tmp_path):
    log(table_path, 0, info(1), protocol(), meta([("a", "long")]))
    log(table_path, 2, info(2), meta([("a", "long")]))
    with pytest.raises(Exception, match="lacks versions"):
        drain(tail.tail_changes(spark, FeedOptions(table_path, start_version=0), lambda df, b: None, str(tmp_path / "ck"), trigger=NOW))


SOURCE = "msg_id bigint, schema_type string, schema string, payload string"


def test_ingest_stream(spark, table_path, tmp_path):
    src, ck = str(tmp_path / "src"), str(tmp_path / "ck")
    all_rows = messages(spark, (PERSON, [person(i) for i in range(40)]), (WITH_GRADE, [person(i, grade=1) for i in range(20)]))
    results = []

    def run():
        stream = spark.readStream.schema(SOURCE).option("maxFilesPerTrigger", 1).parquet(src)
        drain(SI.ingest_stream(stream, IngestOptions(table_path=table_path), ck, trigger=NOW, results=results))

    all_rows.where("msg_id < 30").coalesce(1).write.parquet(src)
    run()
    all_rows.where("msg_id >= 30").coalesce(1).write.mode("append").parquet(src)
    run()
    assert [r.versions for r in results] == [[1], [2, 3, 4]]
    assert versions(spark, table_path) == [(0, 0, 1), (1, 1, 0), (2, 1, 0), (3, 0, 1), (4, 1, 0)]
    assert SN.snapshot(spark, table_path).where("grade is not null").count() == 20


def test_ingest_stream_replays_once(spark, table_path, tmp_path):
    """The stream loses its own progress after the commit: the batch runs again and adds nothing."""
    src = str(tmp_path / "src")
    messages(spark, (PERSON, [person(i) for i in range(10)])).coalesce(1).write.parquet(src)
    for n in range(2):
        stream = spark.readStream.schema(SOURCE).parquet(src)
        drain(SI.ingest_stream(stream, IngestOptions(table_path=table_path), str(tmp_path / "ck"), trigger=NOW))
        for f in (tmp_path / "ck" / "commits").iterdir():
            f.unlink()
    assert SN.snapshot(spark, table_path).count() == 10


def test_failing_ingest_stops_the_stream(spark, table_path, tmp_path):
    src = str(tmp_path / "src")
    messages(spark, (PERSON, ["{bad"])).write.parquet(src)
    stream = spark.readStream.schema(SOURCE).parquet(src)
    with pytest.raises(Exception, match="malformed|RejectedMessage"):
        drain(SI.ingest_stream(stream, IngestOptions(table_path=table_path, fail_fast=True), str(tmp_path / "ck"), trigger=NOW))


def test_round_trip_sink_to_feed(spark, table_path, tmp_path):
    """c1 0..199 in two appends, ingested, tailed, and ingested again into a second table."""
    rows = [{"c1": i, "c2": i % 5, "c3": f"foo-{i % 2}"} for i in range(200)]
    schema = json.dumps({"type": "record", "name": "demo", "fields": [
        {"name": "c1", "type": "long"}, {"name": "c2", "type": "long"}, {"name": "c3", "type": "string"}]})
    src = IngestOptions(table_path=table_path, records_per_commit=100)
    from tableflow.plans.ingest import ingest_batch

    ingest_batch(messages(spark, (schema, rows)), src)
    second = str(tmp_path / "second")

    def forward(df, batch):
        value = F.to_json(F.struct("c1", "c2", "c3"))
        m = df.select(F.col("_seq").alias("msg_id"), F.lit("JSON").alias("schema_type"), F.lit(schema).alias("schema"),
                      value.alias("payload"))
        ingest_batch(m, IngestOptions(table_path=second), batch)

    drain(tail.tail_changes(spark, FeedOptions(table_path, start_version=0), forward, str(tmp_path / "ck"), trigger=NOW,
                            versions_per_trigger=1))
    a, b = SN.snapshot(spark, table_path), SN.snapshot(spark, second)
    assert b.count() == 200 and a.exceptAll(b).count() == 0


def test_metrics(spark, table_path, tmp_path):
    history(spark, table_path, 0, 2)
    got = [tuple(r) for r in M.feed_metrics(spark, table_path, 0).select(
        "version", "actions_prepared", "files_prepared", "rows_prepared", "schema_changes").orderBy("version").collect()]
    assert got == [(0, 1, 0, 0, 1), (1, 2, 2, 4, 0), (2, 2, 2, 4, 0)]
    listener = M.ProgressLog()
    spark.streams.addListener(listener)
    try:
        q = tail.tail_changes(spark, FeedOptions(table_path, start_version=0), lambda df, b: None, str(tmp_path / "ck"), trigger=NOW)
        drain(q)
        p = M.progress(q)
        assert p["batch"] == 0 and p["input_rows"] == 3 and p["total_ms"] > 0
    finally:
        spark.streams.removeListener(listener)
