"""Restarts, repeated writes, null keys and unreadable logs: no row is lost without an error."""

import glob
import os
import os

import pytest
from pyspark.sql import functions as F

from helpers import add, info, log, meta, parquet, protocol
from test_ingest import PERSON, messages, person
from test_streaming import NOW, SOURCE, drain, history
from tableflow.functions import schema as S
from tableflow.operators import changes as CH
from tableflow.operators import ordered
from tableflow.operators import write as W
from tableflow.options import FeedOptions, IngestOptions
from tableflow.plans.ingest import ReplayMismatch, ingest_batch
from tableflow.sources import log as L
from tableflow.sources import snapshot as SN
from tableflow.streaming import ingest as SI
from tableflow.streaming import tail


@pytest.mark.parametrize("fetch_history", [False, True])
def test_tail_that_started_at_latest_goes_on_where_it_stopped(spark, table_path, tmp_path, fetch_history):
    out, ck = str(tmp_path / "out"), str(tmp_path / "ck")
    o = FeedOptions(table_path, fetch_history=fetch_history)
    history(spark, table_path, 0, 3)
    drain(tail.tail_changes(spark, o, tail.slot_folder(out), ck, trigger=NOW))
    history(spark, table_path, 3, 4)
    drain(tail.tail_changes(spark, o, tail.slot_folder(out), ck, trigger=NOW))
    got = [(r["_is_full"], r["id"] // 10) for r in spark.read.parquet(out).collect()]
    first = [(True, v) for v in range(3)] if fetch_history else [(False, 2)]
    assert sorted(got) == sorted(4 * [*first, *[(False, v) for v in range(3, 7)]])


def test_tail_waits_for_its_start(spark, table_path, tmp_path):
    """Batches before the start version is there do not count as the start."""
    out, ck = str(tmp_path / "out"), str(tmp_path / "ck")
    history(spark, table_path, 0, 1)
    o = FeedOptions(table_path)
    drain(tail.tail_changes(spark, o, tail.slot_folder(out), ck, trigger=NOW))
    for n in range(2):
        history(spark, table_path, 1 + n, 1)
        drain(tail.tail_changes(spark, o, tail.slot_folder(out), ck, trigger=NOW))
    assert sorted({r["id"] // 10 for r in spark.read.parquet(out).collect()}) == [0, 1, 2]


def test_two_batches_with_default_arguments(spark, table_path):
    o = IngestOptions(table_path=table_path)
    first = messages(spark, (PERSON, [person(i) for i in range(10)]))
    ingest_batch(first, o)
    assert ingest_batch(messages(spark, (PERSON, [person(i) for i in range(10, 20)])), o).replayed == 0
    assert SN.snapshot(spark, table_path).count() == 20
    assert ingest_batch(first, o, batch_id=0).replayed == 1
    assert SN.snapshot(spark, table_path).count() == 20
    with pytest.raises(ReplayMismatch):
        ingest_batch(messages(spark, (PERSON, [person(i) for i in range(11)])), o, batch_id=0)


def test_two_streams_into_one_table(spark, table_path, tmp_path):
    src = str(tmp_path / "src")
    messages(spark, (PERSON, [person(i) for i in range(10)])).coalesce(1).write.parquet(src)
    for checkpoint in ("one", "two"):
        stream = spark.readStream.schema(SOURCE).parquet(src)
        drain(SI.ingest_stream(stream, IngestOptions(table_path=table_path), str(tmp_path / checkpoint), trigger=NOW))
    assert SN.snapshot(spark, table_path).count() == 20


def test_null_keys_are_rejected(spark, table_path):
    o = IngestOptions("keyed", table_path, record_key="id")
    rejected = []
    payloads = ['{"id": %s, "name": "n%d"}' % (f'"k{i}"' if i % 2 else ["null", '""'][i % 4 // 2], i) for i in range(20)]
    schema = '{"type":"record","name":"r","fields":[{"name":"id","type":["null","string"]},{"name":"name","type":"string"}]}'
    done = ingest_batch(messages(spark, (schema, payloads)), o, reject_sink=lambda df, b: rejected.extend(df.collect()))
    assert SN.snapshot(spark, table_path).count() == 10
    assert (done.accepted, done.rejected) == (10, 10) and len(rejected) == 10


@pytest.mark.parametrize("per_bucket", [50, 100, 1000, 10**6])
def test_null_order_values_stay_at_any_size(spark, per_bucket):
    df = spark.range(1000).select(F.when(F.col("id") % 100 != 7, F.col("id")).alias("id"), (F.col("id") % 3).alias("key"))
    got = ordered.commit_groups(df, "id", 300, rows_per_bucket=per_bucket)
    assert sorted((r["_group"], r["count"]) for r in got.groupBy("_group").count().collect()) == [(0, 300), (1, 300), (2, 300), (3, 100)]
    assert {r["_group"] for r in got.where("id is null").collect()} == {0}
    assert ordered.schema_runs(df, "id", "key", rows_per_bucket=per_bucket).count() == 1000


def test_files_follow_bytes_not_tasks(spark, table_path):
    """A small write is one file however many tasks read; a large one keeps its tasks and starts files near the target."""
    pattern = f"{table_path}/_commit=*/*.parquet"
    wide = spark.range(0, 40_000, 1, 4).select("id", F.sha2(F.col("id").cast("string"), 256).alias("pad"))
    W.append(spark, table_path, wide.where("id < 10"), n_rows=10)
    assert len(glob.glob(pattern)) == 1
    W.append(spark, table_path, wide, target_bytes=100_000)
    sizes = sorted(map(os.path.getsize, glob.glob(pattern)))[1:]
    assert len(sizes) >= 4 and max(sizes) < 400_000
    W.append(spark, table_path, wide, n_rows=40_000, target_bytes=100_000)  # bytes per row are known now
    sizes = sorted(map(os.path.getsize, set(glob.glob(pattern))))
    assert len(sizes) > 20 and sizes[-1] < 400_000
    path = table_path + "2"
    schema = '{"type":"record","name":"r","fields":[{"name":"id","type":"string"}]}'
    for n, target in ((0, 1 << 20), (1, 1000)):
        m = messages(spark, (schema, ['{"id": "%d"}' % i for i in range(400)])).repartition(16)
        ingest_batch(m, IngestOptions(table_path=path, target_file_bytes=target), n)
    files = dict(L.file_actions(L.actions(spark, path)).groupBy("version").count().collect())
    assert files[1] == 1 and 2 <= files[2] <= 30 and SN.snapshot(spark, path).count() == 800


def test_long_texts_are_not_read_by_one_task(spark, table_path, tmp_path):
    """A first batch, of which no file tells the bytes of a row: tasks follow what is read, not a guess per column."""
    long = F.array_join(F.transform(F.sequence(F.lit(1), F.lit(40)), lambda i: F.sha2(F.concat(F.col("id").cast("string"), i.cast("string")), 256)), "")
    spark.range(0, 4000, 1, 16).select("id", long.alias("text")).write.parquet(str(tmp_path / "texts"))
    spark.conf.set("spark.sql.files.maxPartitionBytes", 1 << 20)
    try:
        m = spark.read.parquet(str(tmp_path / "texts")).select(F.col("id").alias("msg_id"), F.lit("STRING").alias("schema_type"),
                                                               F.lit("").alias("schema"), F.col("text").alias("payload"))
        ingest_batch(m, IngestOptions(table_path=table_path, target_file_bytes=2 << 20))
    finally:
        spark.conf.unset("spark.sql.files.maxPartitionBytes")
    files = L.file_actions(L.actions(spark, table_path)).where("op = 'c'")
    got = files.agg(F.count(F.lit(1)), F.max("num_records"), F.sum("num_records")).first()
    assert got[0] >= 3 and got[1] <= 2000 and got[2] == 4000


def test_small_rows_do_not_all_go_to_one_task(spark, table_path, monkeypatch):
    """Rows that take next to no bytes in a file still take memory in the task that sorts them."""
    monkeypatch.setattr(W, "ROWS_PER_TASK", 1000)
    same = spark.range(0, 4000, 1, 16).select(F.lit("the same in every row").alias("text"))
    for _ in range(2):  # bytes per row are known from the first
        W.append(spark, table_path, same, n_rows=4000)
    files = L.file_actions(L.actions(spark, table_path)).where("op = 'c'").groupBy("version")
    assert [tuple(r) for r in files.agg(F.count(F.lit(1)), F.max("num_records")).select(F.col("count(1)"), F.col("max(num_records)")).collect()] == [(4, 1000)] * 2


def small_log(spark, table, versions, reader=1):
    size = parquet(table, "a.parquet", {"id": list(range(10))})
    for v in versions:
        first = [{"protocol": {"minReaderVersion": reader, "minWriterVersion": 2}}, meta([("id", "long")])] if v == versions[0] else []
        log(table, v, info(1000 + v), *first, add("a.parquet", size=size, rows=10))


@pytest.mark.parametrize("versions", [[0, 1, 3], [1, 2]])
def test_a_log_with_holes_is_refused(spark, table_path, versions):
    small_log(spark, table_path, versions)
    with pytest.raises(L.LogError):
        SN.snapshot(spark, table_path)
    if versions[0] == 0:
        with pytest.raises(L.LogError):
            CH.changes(spark, table_path, 0)
    else:
        assert CH.changes(spark, table_path, 1).count() == 20  # all its changes are there


def test_a_newer_protocol_is_refused(spark, table_path):
    small_log(spark, table_path, [0])
    assert SN.snapshot(spark, table_path).count() == 10
    log(table_path, 1, info(2000), {"protocol": {"minReaderVersion": 3, "minWriterVersion": 7, "readerFeatures": ["deletionVectors"]}})
    for read in (lambda: SN.snapshot(spark, table_path), lambda: CH.changes(spark, table_path, 0)):
        with pytest.raises(L.LogError, match="reader version 3"):
            read()
    assert SN.snapshot(spark, table_path, version=0).count() == 10


def test_actions_have_one_number_however_the_log_is_read(spark, table_path, monkeypatch):
    folder = os.path.join(table_path, "_delta_log")
    os.makedirs(folder)
    for v, text in enumerate(["a\n\nb\r\nc\n", "\nd\re\n" + "".join(f"l{i}\n" for i in range(3000)), "\n \nz"]):
        with open(f"{folder}/{v:020d}.json", "w", newline="") as f:
            f.write(text)
    whole = sorted(map(tuple, L.log_lines(spark, table_path).select("version", "idx", "line").collect()))
    monkeypatch.setattr(L, "WHOLE_FILE_BYTES", 10)
    spark.conf.set("spark.sql.files.maxPartitionBytes", "1000")
    try:
        split = sorted(map(tuple, L.log_lines(spark, table_path).select("version", "idx", "line").collect()))
    finally:
        spark.conf.unset("spark.sql.files.maxPartitionBytes")
    assert whole == split and len(whole) == 3005


def test_a_name_in_other_case_is_a_new_column(spark, table_path):
    o = IngestOptions("evolving", table_path)
    schema = '{"type":"record","name":"r","fields":[{"name":"x","type":"long"},{"name":"%s","type":"long"}]}'
    ingest_batch(messages(spark, (schema % "id", ['{"x": %d, "id": %d}' % (i, i) for i in range(5)])), o)
    ingest_batch(messages(spark, (schema % "ID", ['{"x": %d, "ID": %d}' % (i, i) for i in range(5, 8)])), o)
    got = SN.snapshot(spark, table_path)
    assert got.columns == ["x", "ID"]
    assert sorted((r.x, r.ID) for r in got.collect()) == [(i, i if i >= 5 else None) for i in range(8)]


def test_empty_null_and_other_partition_texts(spark, table_path):
    texts = ["", None, "a", "__EMPTY_TEXT__", "__EMPTY_TEXT___", "__HIVE_DEFAULT_PARTITION", " ", "a=b/c"]
    W.append(spark, table_path, spark.createDataFrame(list(enumerate(texts)), "id int, k string"), ["k"])
    want = sorted((i, repr(t)) for i, t in enumerate(texts))
    for df in (SN.snapshot(spark, table_path), CH.changes(spark, table_path, 0)):
        assert sorted((r.id, repr(r.k)) for r in df.select("id", "k").collect()) == want
    assert [r.id for r in SN.snapshot(spark, table_path).where("k = ''").collect()] == [0]


def test_a_column_named_like_the_commit_folder_is_refused(spark, table_path):
    with pytest.raises(S.UnsupportedSchema, match="_commit"):
        W.append(spark, table_path, spark.range(3).selectExpr("id", "id as _commit"))
