import json

import pytest
from pyspark.sql import functions as F

from tableflow.operators import changes as CH
from tableflow.operators import decode as D
from tableflow.operators import write as W
from tableflow.options import IngestOptions
from tableflow.plans import ingest as I
from tableflow.sources import log as L
from tableflow.sources import snapshot as SN


def avro(*fields):
    return json.dumps({"type": "record", "name": "person", "fields": [
        {"name": n, "type": ["null", t], "default": None} for n, t in fields]})


BASE = [("name", "string"), ("age", "int"), ("phone", "string"), ("address", "string"), ("score", "double")]
PERSON, WITH_GRADE, WITH_BA = avro(*BASE), avro(*BASE, ("grade", "int")), avro(*BASE[:3], ("ba", "int"), *BASE[3:])


def person(i, age=None, **more):
    return {"name": "hang", "age": i if age is None else age, "phone": str(30 + i % 5), "address": "GuangZhou, China",
            "score": 59.9 + i, **more}


def messages(spark, *groups):
    """Groups of (schema text, records, type) in message order."""
    rows = []
    for schema, records, *kind in groups:
        for r in records:
            payload = r if isinstance(r, str) else json.dumps(r)
            rows.append((len(rows), kind[0] if kind else "JSON", schema, payload))
    return spark.createDataFrame(rows, "msg_id bigint, schema_type string, schema string, payload string")


def versions(spark, path):
    acts = L.actions(spark, path).groupBy("version").agg(F.count("add").alias("files"), F.count("metaData").alias("schemas"))
    return [tuple(r) for r in acts.orderBy("version").collect()]


def test_append(spark, table_path):
    m = messages(spark, (PERSON, [person(i) for i in range(1500)]))
    r = I.ingest_batch(m, IngestOptions(table_path=table_path))
    assert (r.versions, r.accepted, r.rejected) == ([1], 1500, 0)
    assert versions(spark, table_path) == [(0, 0, 1), (1, 1, 0)]
    got = SN.snapshot(spark, table_path).orderBy("age").collect()
    assert [x["score"] for x in got] == [59.9 + i for i in range(1500)] and got[7]["phone"] == "32"


def test_partitioned(spark, table_path):
    o = IngestOptions(table_path=table_path, partition_columns=["name", "age"])
    I.ingest_batch(messages(spark, (PERSON, [person(i, age=18 + i % 10) for i in range(100)])), o)
    I.ingest_batch(messages(spark, (PERSON, [person(i, age=18 + i % 20) for i in range(200)])), o, batch_id=1)
    assert versions(spark, table_path) == [(0, 0, 1), (1, 10, 0), (2, 20, 0)]
    assert SN.snapshot(spark, table_path).where("age = 18").count() == 20
    pv = L.file_actions(L.actions(spark, table_path)).select("pv").first()["pv"]
    assert set(pv) == {"name", "age"} and pv["name"] == "hang"


def test_evolve_on_append(spark, table_path):
    o = IngestOptions(table_path=table_path)
    I.ingest_batch(messages(spark, (PERSON, [])), o)
    assert not L.table_exists(spark, table_path)
    I.ingest_batch(messages(spark, (PERSON, [person(1)]), (WITH_GRADE, [person(2, grade=5)])), o)
    assert versions(spark, table_path) == [(0, 0, 1), (1, 1, 0), (2, 0, 1), (3, 1, 0)]
    got = sorted((r["age"], r["grade"]) for r in SN.snapshot(spark, table_path).collect())
    assert got == [(1, None), (2, 5)]


def test_evolve_by_name_and_read_back(spark, table_path):
    m = messages(spark, (PERSON, [person(i) for i in range(1400)]), (WITH_BA, [person(i, ba=i) for i in range(100)]))
    I.ingest_batch(m, IngestOptions("evolving", table_path))
    df = SN.snapshot(spark, table_path)
    assert df.columns == ["name", "age", "phone", "ba", "address", "score"]
    hit = df.where("age > 10 and age < 20 and score > 75 and score < 80").select("age", "ba").collect()
    assert sorted(r["age"] for r in hit if r["ba"] is None) == [16, 17, 18, 19]
    assert sorted(r["age"] for r in hit if r["ba"] is not None) == [16, 17, 18, 19]


def test_interleaved_schemas(spark, table_path):
    """Every schema change is a barrier, also when two producers alternate."""
    groups = [(PERSON if i % 2 == 0 else WITH_GRADE, [person(j) if i % 2 == 0 else person(j, grade=i) for j in range(5)])
              for i in range(6)]
    I.ingest_batch(messages(spark, *groups), IngestOptions(table_path=table_path))
    assert [s for _, _, s in versions(spark, table_path)].count(1) == 6
    feed = CH.changes(spark, table_path, 0)
    by_version = feed.groupBy("_version").agg(F.count("*").alias("n"), F.max("grade").alias("g")).orderBy("_version").collect()
    assert [(r["n"], r["g"]) for r in by_version] == [(5, None if i % 2 == 0 else i) for i in range(6)]


def test_equal_schemas_in_other_words(spark, table_path):
    """Schema texts that only differ in layout or docs are no schema change."""
    other = json.dumps({**json.loads(PERSON), "doc": "same"}, indent=1)
    m = messages(spark, (PERSON, [person(1)]), (other, [person(2)]), (PERSON, [person(3)]))
    assert I.ingest_batch(m, IngestOptions(table_path=table_path)).versions == [1]


def test_records_per_commit(spark, table_path):
    m = messages(spark, (PERSON, [person(i) for i in range(250)]), (WITH_GRADE, [person(i, grade=1) for i in range(120)]))
    r = I.ingest_batch(m, IngestOptions(table_path=table_path, records_per_commit=100))
    counts = CH.changes(spark, table_path, 0).groupBy("_version").count().orderBy("_version").collect()
    assert [c["count"] for c in counts] == [100, 100, 50, 100, 20] and len(r.versions) == 6


def test_keyed(spark, table_path):
    v1, v2 = avro(("id", "int"), ("name", "string")), avro(("id", "int"), ("name", "string"), ("aDouble", "double"))
    m = messages(
        spark, (v1, [{"id": i % 3, "name": f"n{i}"} for i in range(9)]),
        (v2, [{"id": i % 3, "name": f"m{i}", "aDouble": i / 2} for i in range(6)]),
    )
    I.ingest_batch(m, IngestOptions("keyed", table_path, record_key="id", partition_path="id"))
    got = sorted((r["id"], r["name"], r["aDouble"], r["_partition_path"]) for r in SN.snapshot(spark, table_path).collect())
    assert got == sorted([(0, "n6", None, "0"), (1, "n7", None, "1"), (2, "n8", None, "2"),
                          (0, "m3", 1.5, "0"), (1, "m4", 2.0, "1"), (2, "m5", 2.5, "2")], key=lambda r: (r[0], r[1]))


def test_primitives(spark, table_path):
    texts = [f"message-{i}" for i in range(10)]
    I.ingest_batch(messages(spark, ("", texts, "STRING")), IngestOptions(table_path=table_path, field_name="body"))
    got = SN.snapshot(spark, table_path)
    assert got.columns == ["body", "uuid"] and sorted(r["body"] for r in got.collect()) == texts
    blob = table_path + "-bytes"
    I.ingest_batch(messages(spark, ("", texts, "BYTES")), IngestOptions(table_path=blob))
    assert sorted(bytes(r["message"]) for r in SN.snapshot(spark, blob).collect()) == [t.encode() for t in texts]


def test_typed_records(spark, table_path):
    m = messages(spark, (PERSON, [person(i) for i in range(20)], "AVRO"))
    struct = "struct<name:string,age:int,phone:string,address:string,score:double>"
    m = m.withColumn("record", F.from_json("payload", struct)).withColumn("payload", F.lit(None).cast("string"))
    assert I.ingest_batch(m, IngestOptions(table_path=table_path)).accepted == 20
    assert SN.snapshot(spark, table_path).agg(F.sum("age")).first()[0] == 190


NUMBERS = json.dumps({"type": "record", "name": "n", "fields": [{"name": "a", "type": "int"},
                                                              {"name": "l", "type": {"type": "array", "items": "long"}},
                                                              {"name": "b", "type": ["null", "bytes"]}]})


def test_decode_json(spark):
    good = {"a": 1, "l": [1, 2], "b": "éx"}
    bad = ['{"a":', "[1]", '"text"', json.dumps({**good, "a": "x"}), json.dumps({**good, "a": 2**40})]
    part = [json.dumps({"a": 1, "l": [1]}), json.dumps({**good, "l": [1, None]}), json.dumps({**good, "b": None})]
    m = messages(spark, (NUMBERS, [good, *bad, *part]))
    from tableflow.functions.schema import avro_to_struct

    out = D.decode_json(m, avro_to_struct(NUMBERS)).orderBy("msg_id").collect()
    assert [r["_reject"] for r in out] == [None] + [D.MALFORMED] * 5 + [D.INCOMPLETE] * 3
    assert bytes(out[0]["_row"]["b"]) == b"\xe9x" and out[0]["_row"]["l"] == [1, 2]
    loose = D.decode_json(m, avro_to_struct(NUMBERS), strict=False).orderBy("msg_id").collect()
    assert [r["_reject"] for r in loose[6:]] == [None] * 3


def test_rejects(spark, table_path):
    m = messages(
        spark, (PERSON, [person(1), "{bad", {"name": "x"}]), ("  ", [person(2)]), (PERSON, ["x"], "PROTOBUF"),
        ("nonsense", [person(3)]), (PERSON, [person(4)]),
    )
    seen = []
    r = I.ingest_batch(m, IngestOptions(table_path=table_path), reject_sink=lambda df, b: seen.extend(df.collect()))
    assert (r.accepted, r.rejected) == (2, 5)
    assert {(x["msg_id"], x["reason"]) for x in seen} == {
        (1, D.MALFORMED), (2, D.INCOMPLETE), (3, D.NO_SCHEMA), (4, D.BAD_TYPE), (5, D.BAD_SCHEMA)}
    with pytest.warns(UserWarning, match="5 unusable"):
        I.ingest_batch(m, IngestOptions(table_path=table_path), batch_id=1)


def test_fail_fast(spark, table_path):
    for group in ((PERSON, ["{bad"]), (" ", [person(1)]), ("nonsense", [person(1)]), (PERSON, [{"name": "x"}])):
        with pytest.raises(D.RejectedMessage):
            I.ingest_batch(messages(spark, group), IngestOptions(table_path=table_path, fail_fast=True))
    assert not L.table_exists(spark, table_path)


def test_replay_adds_nothing(spark, table_path):
    m = messages(spark, (PERSON, [person(i) for i in range(50)]))
    o = IngestOptions(table_path=table_path, records_per_commit=20)
    assert len(I.ingest_batch(m, o, batch_id=3).versions) == 3
    again = I.ingest_batch(m, o, batch_id=3)
    assert (again.versions, again.replayed) == ([], 3)
    assert SN.snapshot(spark, table_path).count() == 50


def test_crash_between_commits(spark, table_path, monkeypatch):
    """The second of three commits fails once: the retry publishes only what is missing."""
    m = messages(spark, (PERSON, [person(i) for i in range(50)]))
    real, calls = L.storage.move_new, []

    def flaky(spark, src, dst, mtime):
        calls.append(dst)
        if len(calls) == 3:
            raise OSError("lost")
        real(spark, src, dst, mtime)

    monkeypatch.setattr(L.storage, "move_new", flaky)
    r = I.ingest_batch(m, IngestOptions(table_path=table_path, records_per_commit=20))
    assert r.replayed == 1 and SN.snapshot(spark, table_path).count() == 50
    feed = CH.changes(spark, table_path, 0)
    assert feed.select("age").distinct().count() == feed.count() == 50


def test_failure_budget(spark, table_path, monkeypatch):
    tries = []

    def broken(*a, **k):
        tries.append(1)
        raise OSError("no")

    monkeypatch.setattr(I.W, "write_files", broken)
    m = messages(spark, (PERSON, [person(1)]))
    with pytest.raises(I.CommitFailed):
        I.ingest_batch(m, IngestOptions(table_path=table_path, commit_failures=2))
    assert len(tries) == 3 and not L.table_exists(spark, table_path)


def test_unpublished_files_are_invisible(spark, table_path):
    df = spark.range(10)
    W.append(spark, table_path, df)
    now = L.epochs(spark, table_path)[-1]
    W.write_files(df.withColumn(L.DATA_COMMIT, F.lit("orphan")), table_path, now.schema)
    assert SN.snapshot(spark, table_path).count() == 10


@pytest.mark.parametrize("codec", ["snappy", "gzip", "zstd", "uncompressed"])
def test_compression(spark, tmp_path, codec):
    path = str(tmp_path / codec)
    I.ingest_batch(messages(spark, (PERSON, [person(i) for i in range(5)])), IngestOptions(table_path=path, compression=codec))
    name = L.file_actions(L.actions(spark, path)).first()["path"]
    assert codec == "uncompressed" or {"gzip": "gz"}.get(codec, codec) in name
    assert SN.snapshot(spark, path).count() == 5


def test_field_names_like_internal_ones(spark, table_path):
    names = ["msg_id", "ts", "op", "path", "pv", "version", "idx", "slot", "schema", "payload", "epoch", "min_row"]
    schema = json.dumps({"type": "record", "name": "r", "fields": [{"name": n, "type": "int"} for n in names]})
    rows = [{n: 100 * i + j for j, n in enumerate(names)} for i in range(3)]
    m = messages(spark, (schema, rows))
    for layout, extra in (("append", {"partition_columns": ["op"]}), ("keyed", {"record_key": "msg_id"})):
        path = f"{table_path}-{layout}"
        I.ingest_batch(m, IngestOptions(layout, path, **extra))
        want = sorted(tuple(r[n] for n in names) for r in rows)
        assert sorted(map(tuple, SN.snapshot(spark, path).select(*names).collect())) == want
        feed = CH.changes(spark, path, 0, n_slots=2, positions=True)
        assert sorted(map(tuple, feed.select(*names).collect())) == want
