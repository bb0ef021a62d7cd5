import datetime as dt
import os

import pytest
from pyspark.sql import functions as F

from helpers import add, info, log, meta, parquet, protocol, remove, READINGS, readings
from tableflow import storage
from tableflow.functions import schema as S
from tableflow.operators import write as W
from tableflow.sources import files as FS
from tableflow.sources import log as L
from tableflow.sources import snapshot as SN


def test_log_of_one_file(spark, table_path):
    rows = readings(table_path)
    acts = L.actions(spark, table_path)
    found = {r["idx"]: r for r in acts.collect()}
    assert found[2]["metaData"] is not None and found[3]["add"] is not None and len(found) == 4
    assert L.version_bounds(spark, table_path) == (0, 0)
    got = SN.snapshot(spark, table_path).select("tick", "level", "probe").collect()
    assert [tuple(r) for r in got] == rows
    assert [f.name for f in L.epochs(spark, table_path)[0].schema] == ["tick", "level", "probe"]


def test_row_index_and_counts(spark, table_path):
    rows = readings(table_path)
    path = os.path.join(table_path, "part-0.parquet")
    scan = FS.row_scan(spark, [path], L.epochs(spark, table_path)[0].schema)
    got = scan.orderBy(FS.ROW).select("tick", "level", "probe", FS.ROW).collect()
    assert [tuple(r) for r in got] == [(*r, i) for i, r in enumerate(rows)]
    assert FS.row_counts(spark, [path]).first()["n_rows"] == READINGS


@pytest.fixture
def versions(table_path):
    """v0 schema, v1..v3 one file each, v4 removes the first, v5 adds it again."""
    log(table_path, 0, info(1_000_000), protocol(), meta([("a", "long")]))
    for v in (1, 2, 3):
        parquet(table_path, f"f{v}.parquet", {"a": [v * 10, v * 10 + 1]})
        log(table_path, v, info((v + 1) * 1_000_000), add(f"f{v}.parquet"))
    log(table_path, 4, info(5_000_000), remove("f1.parquet"))
    log(table_path, 5, info(6_000_000), add("f1.parquet"))
    return table_path


def values(df):
    return sorted(r["a"] for r in df.collect())


def test_time_travel(spark, versions):
    assert values(SN.snapshot(spark, versions, version=2)) == [10, 11, 20, 21]
    assert values(SN.snapshot(spark, versions, version=4)) == [20, 21, 30, 31]
    assert values(SN.snapshot(spark, versions)) == [10, 11, 20, 21, 30, 31]
    assert SN.snapshot(spark, versions, version=0).count() == 0
    assert values(SN.snapshot(spark, versions, timestamp=4_500)) == [10, 11, 20, 21, 30, 31]
    assert values(SN.snapshot(spark, versions, timestamp=dt.datetime.fromtimestamp(3_000, dt.timezone.utc))) == [10, 11, 20, 21]


def test_version_resolution(spark, versions, tmp_path):
    pick = lambda v: L.resolve_version(spark, versions, v)
    assert pick(3) == L.Resolved(3, False)
    for v in (-1, None, 99):
        assert pick(v) == L.Resolved(5, False)
    assert pick(-2) == L.Resolved(0, False)
    assert L.resolve_timestamp(spark, versions, 1) == L.Resolved(5, False)  # before the first commit
    assert L.resolve_timestamp(spark, versions, 99_999) == L.Resolved(5, False)
    assert L.resolve_version(spark, str(tmp_path / "none"), 1) == L.Resolved(0, True)
    with pytest.raises(L.LogError):
        SN.snapshot(spark, str(tmp_path / "none"))


def test_names_that_need_quoting(spark, table_path):
    """Folder names with spaces, percent signs and brackets; the log stores them URI-quoted."""
    names = {"k=a b": "k=a%20b", "k=x%3Dy": "k=x%253Dy", "k=p+q": "k=p+q", "k=[z]": "k=%5Bz%5D"}
    entries = []
    for i, (disk, logged) in enumerate(names.items()):
        parquet(table_path, f"{disk}/f.parquet", {"a": [i]})
        entries.append(add(f"{logged}/f.parquet", values={"k": disk[2:]}))
    log(table_path, 0, info(1), protocol(), meta([("a", "long"), ("k", "string")], ["k"]), *entries)
    got = {(r["a"], r["k"]) for r in SN.snapshot(spark, table_path).collect()}
    assert got == {(0, "a b"), (1, "x%3Dy"), (2, "p+q"), (3, "[z]")}


def test_partition_column_only_in_file(spark, table_path):
    """A writer that keeps the columns in the file and logs a null value."""
    parquet(table_path, "f.parquet", {"a": [1], "k": ["in-file"]})
    parquet(table_path, "g.parquet", {"a": [2]})
    log(table_path, 0, info(1), protocol(), meta([("a", "long"), ("k", "string")], ["k"]), add("f.parquet"),
        add("g.parquet", values={"k": None}))
    got = {(r["a"], r["k"]) for r in SN.snapshot(spark, table_path).collect()}
    assert got == {(1, "in-file"), (2, None)}


def test_missing_file_fails(spark, table_path):
    log(table_path, 0, info(1), protocol(), meta([("a", "long")]), add("gone.parquet"))
    with pytest.raises(Exception, match="PATH_NOT_FOUND"):
        SN.snapshot(spark, table_path).count()


def test_publish_never_overwrites(spark, table_path):
    W.create_table(spark, table_path, S.avro_to_struct({"type": "record", "name": "r", "fields": [{"name": "a", "type": "int"}]}))
    before = open(os.path.join(table_path, "_delta_log", L.file_name(0))).read()
    with pytest.raises(storage.VersionConflict):
        L.publish(spark, table_path, [L.Commit(W.new_token())], after=-1)
    assert open(os.path.join(table_path, "_delta_log", L.file_name(0))).read() == before


def test_publishing_many_commits_asks_the_file_system_little(spark, table_path, monkeypatch):
    """A commit more costs a few calls to the JVM, and the log files of a long batch are not all written by one task."""
    schema = S.avro_to_struct({"type": "record", "name": "r", "fields": [{"name": "a", "type": "int"}]})
    client = spark._jvm._gateway_client
    real, calls = client.send_command, []

    def counted(*a, **k):
        calls.append(1)
        return real(*a, **k)

    def cost(n):
        spark.sparkContext.setJobGroup(f"publish-{n}", "")
        monkeypatch.setattr(client, "send_command", counted)
        calls.clear()
        versions = L.publish(spark, f"{table_path}-{n}", [L.Commit(W.new_token(), schema=schema) for _ in range(n)], after=-1)
        monkeypatch.undo()
        spark.sparkContext.setJobGroup("", "")
        assert versions == list(range(n)) and L.latest_version(spark, f"{table_path}-{n}") == n - 1
        status = spark.sparkContext.statusTracker()
        stages = [s for j in status.getJobIdsForGroup(f"publish-{n}") for s in status.getJobInfo(j).stageIds]
        return len(calls), [x.numTasks for s in stages if (x := status.getStageInfo(s))]

    few, many = cost(5), cost(105)
    assert many[0] - few[0] < 100 * 20
    assert 6 in many[1] and max(few[1]) <= 8  # 105 log files, 20 a task


def test_round_trip_values(spark, table_path):
    """Nulls, odd texts and typed partition values come back as they were."""
    df = spark.createDataFrame(
        [(1, "a b", 1.5, None), (2, "x=y/z%20", -0.0, "q"), (3, None, None, "ü"), (4, "a b", 2.0, "null")],
        "id int, p string, d double, v string",
    )
    W.append(spark, table_path, df, ["p"])
    got = SN.snapshot(spark, table_path)
    assert sorted(map(tuple, got.collect()), key=lambda r: r[0]) == [tuple(r) for r in df.collect()]
    logged = L.file_actions(L.actions(spark, table_path)).select("pv").collect()
    assert {r["pv"]["p"] for r in logged} == {"a b", "x=y/z%20", None}


def test_reads_prune_and_push_down(spark, table_path):
    df = spark.range(1000).selectExpr("id", "id % 4 as p", "cast(id as string) as t")
    W.append(spark, table_path, df, ["p"])
    q = SN.snapshot(spark, table_path).where("p = 1 and id > 500").select("id")
    plan = q._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull(p" in plan and "GreaterThan(id,500)" in plan
    assert "ReadSchema: struct<id:bigint>" in plan and "Exchange" not in plan
    assert q.count() == 125


def test_skewed_partition_is_split(spark, table_path):
    """One value holds nearly all rows: it is written by several tasks, small values stay in one file."""
    df = spark.range(400_000).select(F.when(F.col("id") % 100 == 0, "rare").otherwise("hot").alias("p"), "id",
                                     F.sha2(F.col("id").cast("string"), 256).alias("pad"))
    old = spark.conf.get("spark.sql.adaptive.advisoryPartitionSizeInBytes")
    spark.conf.set("spark.sql.adaptive.advisoryPartitionSizeInBytes", "2m")
    try:
        W.append(spark, table_path, df.repartition(8), ["p"])
    finally:
        spark.conf.set("spark.sql.adaptive.advisoryPartitionSizeInBytes", old)
    files = dict(L.file_actions(L.actions(spark, table_path)).groupBy(F.col("pv")["p"]).count().collect())
    assert files["hot"] >= 4 and SN.snapshot(spark, table_path).count() == 400_000


def test_long_commits_are_read_by_split(spark, table_path, monkeypatch):
    """Line numbers agree whether a log file is read whole or in splits of a few lines."""
    for v in range(3):
        log(table_path, v, info(v), meta([("a", "long")]), *[add(f"f{v}-{i}.parquet", i) for i in range(200 + v)])
    cols = ["version", "idx", "add.path", "add.size"]
    whole = {tuple(r) for r in L.actions(spark, table_path).select(*cols).collect()}
    old = spark.conf.get("spark.sql.files.maxPartitionBytes")
    monkeypatch.setattr(L, "WHOLE_FILE_BYTES", 0)
    spark.conf.set("spark.sql.files.maxPartitionBytes", "3000b")
    try:
        lines = L.actions(spark, table_path)
        assert "wholetext" not in lines._jdf.queryExecution().toString()
        split = {tuple(r) for r in lines.select(*cols).collect()}
        some = L.actions(spark, table_path, 1, 1).count()
    finally:
        spark.conf.set("spark.sql.files.maxPartitionBytes", old)
    assert split == whole and len(whole) == 609 and some == 203


def test_typed_partition_values(spark, table_path):
    df = spark.sql("""select * from values
        (1, date'2020-01-02', timestamp'2020-01-02 03:04:05.678', true, 1.50bd, 7l, '007'),
        (2, cast(null as date), cast(null as timestamp), cast(null as boolean), cast(null as decimal(3,2)), cast(null as bigint), '1e3')
        as t(id, d, ts, b, n, l, s)""")
    W.append(spark, table_path, df, ["d", "ts", "b", "n", "l", "s"])
    want = sorted(map(tuple, df.collect()))
    assert sorted(map(tuple, SN.snapshot(spark, table_path).collect())) == want
    from tableflow.operators import changes as CH

    feed = CH.changes(spark, table_path, 0)
    assert sorted(map(tuple, feed.select(*df.columns).collect())) == want


def test_append_refuses_unknown_columns(spark, table_path):
    W.append(spark, table_path, spark.range(3))
    with pytest.raises(S.UnsupportedSchema):
        W.append(spark, table_path, spark.range(3).withColumn("x", F.lit(1)))


def test_rows_per_file(spark, table_path):
    W.create_table(spark, table_path, spark.range(1).schema)
    now = L.epochs(spark, table_path)[-1]
    W.write_files(spark.range(100).coalesce(1).withColumn(L.DATA_COMMIT, F.lit("t")), table_path, now.schema, rows_per_file=30)
    assert W.written_files(spark, table_path, ["t"], now.schema).count() == 4


def test_storage_options(spark, tmp_path):
    """Two tables with different settings in one session, which keeps its own."""
    from tableflow.options import FeedOptions, IngestOptions
    from tableflow.plans import start as ST

    name = "fs.tableflow.test"
    paths = [str(tmp_path / n) for n in ("one", "two")]
    for n, path in enumerate(paths):
        W.append(spark, path, spark.range(n + 3))
        o = FeedOptions.load({"type": "delta", "tablePath": path, "startSnapshotVersion": 0, f"hadoop.{name}": f"v{n}"})
        assert o.storage == {name: f"v{n}"} and ST.feed(spark, o).count() == n + 3
    for n, path in enumerate(paths):
        assert storage._conf(spark, path + "/_delta_log").get(name) == f"v{n}"
        assert storage.options_of(spark, f"{path}/_commit=x/part") == {name: f"v{n}"}
        W.append(spark, path, spark.range(2))
        plan = SN.snapshot(spark, path)
        assert plan.count() == n + 5
        seen = L.log_lines(spark, path)._jdf.queryExecution().analyzed().toString()
        assert seen and storage._system(spark, path).getConf().get(name) == f"v{n}"
    assert storage._conf(spark).get(name) is None and spark.conf.get(name, None) is None
    assert IngestOptions.load({"type": "delta", "tablePath": "/t", f"hadoop.{name}": "x"}).storage == {name: "x"}


def test_commit_by_keeps_null_groups(spark, table_path):
    df = spark.createDataFrame([(1, "a"), (2, None), (3, "b"), (4, None)], "id int, g string")
    assert W.append(spark, table_path, df, commit_by="g") == [1, 2, 3]
    assert sorted(r["id"] for r in SN.snapshot(spark, table_path).collect()) == [1, 2, 3, 4]
    assert [r["id"] for r in SN.snapshot(spark, table_path, version=1).orderBy("id").collect()] == [2, 4]


def test_odd_table_path(spark, tmp_path):
    from tableflow.operators import changes as CH

    path = str(tmp_path / "a b [1] 100%25 {x}")
    W.append(spark, path, spark.range(10).selectExpr("id", "cast(id % 2 as string) p"), ["p"])
    assert SN.snapshot(spark, path).where("p = '1'").count() == 5
    W.remove(spark, path, SN.live(spark, path, 1).where("pv['p'] = '0'"), timestamp=1)
    assert SN.snapshot(spark, path).count() == 5
    assert CH.changes(spark, path, 0, positions=True).count() == 15
