"""Reading in rounds, cursor export, draining, file skipping and recovery."""

import datetime as dt
import itertools
import threading

import pytest
from pyspark.sql import functions as F

from test_ingest import PERSON, WITH_GRADE, messages, person
from test_streaming import NOW, drain, history
from tableflow.functions import conditions as Q
from tableflow.functions import cursor as C
from tableflow.operators import changes as CH
from tableflow.operators import ordered
from tableflow.operators import write as W
from tableflow.options import FeedOptions, IngestOptions
from tableflow.plans import ingest as I
from tableflow.plans import recovery as R
from tableflow.plans import start as ST
from tableflow.sources import log as L
from tableflow.sources import snapshot as SN
from tableflow.streaming import tail


@pytest.mark.parametrize("per_bucket", [1, 3, 10_000])
def test_running_totals(spark, per_bucket):
    rows = [(g, v, i, (i * 7 + v) % 5) for g in "ab" for v in range(3) for i in range(0, 20 - 6 * v, 1 + v)] + [("c", 0, 5, None)]
    df = spark.createDataFrame(rows, "g string, v int, i long, n long")
    got = ordered.running_totals(df, {"before": F.col("n"), "place": F.lit(1)}, ["v"], "i", by=["g"], per_bucket=per_bucket)
    want = {(g, v, i): (sum(x[3] or 0 for x in rows if x[0] == g and x[1:3] < (v, i)), sum(x[0] == g and x[1:3] < (v, i) for x in rows))
            for g, v, i, _ in rows}
    assert got.columns == ["g", "v", "i", "n", "before", "place"]
    assert {tuple(r)[:3]: tuple(r)[4:] for r in got.collect()} == want


def test_no_task_sees_all_files_of_one_version(spark):
    acts = spark.range(30_000).select(F.lit(False).alias("is_full"), F.lit(3).cast("long").alias("version"), F.col("id").alias("idx"),
                                      F.lit(1).alias("n_rows"), F.lit(10).alias("size"))
    laid = CH.laid_out(acts)
    plan = laid._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("Window") == 2 and "__bucket" in plan
    assert laid.agg(F.max("rows_before"), F.sum("bytes_before")).first() == (29_999, 10 * 30_000 * 29_999 // 2)


@pytest.fixture
def big_version(spark, table_path):
    """A version of one file, one of eight files, one that removes some, and one of one file."""
    W.append(spark, table_path, spark.range(5).selectExpr("id", "0 as k"), ["k"])
    W.append(spark, table_path, spark.range(100, 180).selectExpr("id", "id % 8 as k"), ["k"])
    W.remove(spark, table_path, SN.live(spark, table_path, 2).where("pv['k'] in ('1', '2')"), timestamp=9)
    W.append(spark, table_path, spark.range(200, 203).selectExpr("id", "5 as k"), ["k"])
    return table_path


def records(df):
    return sorted(tuple(r) for r in df.select("id", "_op", "_version", "_slot", "_seq").collect())


@pytest.mark.parametrize("rows, full", [(1, False), (15, False), (25, True), (10_000, False)])
def test_rounds_are_the_whole_feed(spark, big_version, rows, full):
    o = FeedOptions(big_version, start_version=2 if full else 0, fetch_history=full, n_slots=3, max_read_rows=rows, max_read_bytes=1 << 40, limit_rounds=True)
    want = records(ST.feed(spark, o, positions=True))
    rounds = list(ST.feed_rounds(spark, o))
    parts = [records(r.records) for r in rounds]
    assert sorted(itertools.chain(*parts)) == want
    files = 9 if full else 12
    assert len(rounds) == {1: files, 10_000: 1}.get(rows, len(rounds)) and all(parts)
    # Another process goes on behind any round; the one it was may have seen a shorter table.
    cut = len(rounds) // 2
    again = [records(r.records) for r in ST.feed_rounds(spark, o, after=rounds[cut])]
    assert again == parts[cut + 1 :]
    # The cursors of all rounds come to what the rows say.
    last = {}
    for r in rounds:
        last |= {x.slot: x.cursor for x in r.cursors.collect()}
    assert last == {x.slot: x.cursor for x in C.acknowledged(ST.feed(spark, o, positions=True)).collect()}


def test_many_rounds_are_found_and_read_by_few_jobs(spark, big_version):
    """Jobs do not follow the number of rounds; all rounds are read by one scan, with the records each has on its own."""
    def jobs(group, todo):
        spark.sparkContext.setJobGroup(group, group)
        out = todo()
        spark.sparkContext.setJobGroup("", "")
        return out, len(spark.sparkContext.statusTracker().getJobIdsForGroup(group))

    o = [FeedOptions(big_version, start_version=0, n_slots=3, max_read_rows=n, max_read_bytes=1 << 40) for n in (1, 10_000)]
    (many, a), (one, b) = (jobs(f"rounds-{n}", lambda x=x: list(ST.feed_rounds(spark, x, capture_ts=1))) for n, x in enumerate(o))
    assert (len(many), len(one)) == (12, 1) and a <= b + 1
    together = ST.all_records(many[2:]).cache()
    assert {r["_round"] for r in together.select("_round").distinct().collect()} == set(range(2, 12))
    for r in (many[2], many[11]):
        assert records(together.where(F.col("_round") == r.number)) == records(r.records)
    ends = [r.end for r in many]
    for window in (1, 5, 12, 13):
        assert list(CH.round_ends(many[0].laid.acts, None, 1, 1 << 40, window)) == ends
        assert list(CH.round_ends(many[0].laid.acts, ends[3], 1, 1 << 40, window)) == ends[4:]


def test_byte_limit(spark, big_version):
    size = L.file_actions(L.actions(spark, big_version)).agg(F.max("size")).first()[0]
    o = FeedOptions(big_version, start_version=0, max_read_bytes=3 * size, max_read_rows=30)
    assert o.limit_rounds and not FeedOptions(big_version).limit_rounds
    assert FeedOptions.load({"type": "delta", "tablePath": "/t", "maxReadRowCountOneRound": 100_000}).limit_rounds
    rounds = list(ST.feed_rounds(spark, o))
    assert sum(r.records.count() for r in rounds) == 108 and 3 < len(rounds) < 12


def test_tail_in_rounds_restarts_inside_a_version(spark, big_version, tmp_path):
    """The writer dies in the middle of a version, once before and once after it has written; a round's id replaces it."""
    ck, seen, fails = str(tmp_path / "ck"), {}, {3: False, 5: True}
    o = FeedOptions(big_version, start_version=0, n_slots=2, max_read_rows=15)

    def writer(df, number):
        if number in fails and not fails.pop(number):
            raise RuntimeError("sink is down")
        rows = records(df)
        assert seen.setdefault(number, rows) == rows
        if number == 5 and len(seen) == 6 and not fails:
            fails[-1] = True
            raise RuntimeError("sink is down")

    for _ in range(2):
        with pytest.raises(Exception, match="sink is down"):
            drain(tail.tail_changes(spark, o, writer, ck, trigger=NOW, capture_ts=1))
    W.append(spark, big_version, spark.range(300, 320).selectExpr("id", "id % 4 as k"), ["k"])
    q = tail.tail_changes(spark, o, writer, ck, trigger=NOW, capture_ts=1)
    drain(q)
    assert sorted(seen) == list(range(len(seen))) and len(seen) > 7
    assert sorted(itertools.chain(*seen.values())) == records(CH.changes(spark, big_version, 0, n_slots=2, positions=True))
    assert q.rounds and all(r["files"] > 0 and r["rows"] > 0 and r["bytes"] > 0 and r["log_ms"] >= 0 for r in q.rounds)
    assert sum(r["rows"] for r in q.rounds) <= 128


def test_cursors_are_exported_by_the_clock(spark, table_path, tmp_path):
    ck, now, out, written = str(tmp_path / "ck"), [100.0], [], []
    history(spark, table_path, 0, 6)
    o = FeedOptions(table_path, start_version=1, n_slots=2, checkpoint_interval_s=30)

    def sink(df, number):
        out.append((number, now[0], {r.slot: C.Cursor.from_json(r.cursor) for r in df.collect()}))

    def run(writer):
        drain(tail.tail_changes(spark, o, writer, ck, versions_per_trigger=1, trigger=NOW, cursor_sink=sink, clock=lambda: now[0]))

    def writer(df, number):
        now[0] += 20
        written.append(number)
        if len(written) == 4:
            raise RuntimeError("sink is down")

    with pytest.raises(Exception, match="sink is down"):
        run(writer)
    # After 40 of 30 seconds, and, for the round that was finished before the writer died, at the end.
    assert [(n, t) for n, t, _ in out] == [(written[1], 140.0), (written[2], 180.0)]
    run(lambda df, number: None)
    final = out[-1][2]
    want = {r.slot: C.Cursor.from_json(r.cursor) for r in C.acknowledged(CH.changes(spark, table_path, 1, n_slots=2, positions=True)).collect()}
    assert final == want and len(out) < 8


def test_pending_cursors_survive_a_crash(spark, table_path, tmp_path, monkeypatch):
    """A process that ends without its last export leaves it to the next one, which exports before it reads anything."""
    ck, out = str(tmp_path / "ck"), []
    history(spark, table_path, 0, 2)
    o = FeedOptions(table_path, start_version=1, checkpoint_interval_s=1000)
    with monkeypatch.context() as m:
        m.setattr(tail.FeedQuery, "awaitTermination", lambda self, timeout=None: super(tail.FeedQuery, self).awaitTermination(timeout))
        drain(tail.tail_changes(spark, o, lambda df, n: None, ck, trigger=NOW, cursor_sink=lambda df, n: out.append(n)))
    assert out == []
    drain(tail.tail_changes(spark, o, lambda df, n: out.append("write"), ck, trigger=NOW, cursor_sink=lambda df, n: out.append(n)))
    assert out == [0]


def test_drain_finishes_the_running_batch(spark, table_path, tmp_path):
    ck, seen, exported, busy = str(tmp_path / "ck"), [], [], threading.Event()
    history(spark, table_path, 0, 5)
    o = FeedOptions(table_path, start_version=1)

    def writer(df, number):
        busy.set()
        seen.extend(r["id"] for r in df.collect())

    def start():
        return tail.tail_changes(spark, o, writer, ck, versions_per_trigger=2, trigger=NOW, cursor_sink=lambda df, n: exported.append(n))

    q = start()
    assert busy.wait(120)
    q.drain()
    assert not q.isActive and q.exception() is None and len(exported) == 1
    assert seen and len(seen) % 4 == 0
    drain(start())
    assert sorted(seen) == [v * 10 + i for v in range(5) for i in range(4)]


# ---- conditions and file skipping ----------------------------------------------------------------------------------


def test_files_are_skipped_by_statistics(spark, table_path):
    long = "x" * 40
    rows = [(v, v * 10 + i, None if i == 0 else float(v * 10 + i), f"{long}{v}{i}", dt.date(2020, 1 + v, 1 + i),
             dt.datetime(2020, 1 + v, 1, 0, 0, i, 123456), None if v < 2 else i) for v in range(4) for i in range(5)]
    rows += [(4, 99, float("nan"), "\U0010ffff" * 50, None, None, None)]
    df = spark.createDataFrame(rows, "v int, id long, x double, t string, d date, at timestamp, late int").withColumn("plain", F.col("id"))
    W.append(spark, table_path, df, commit_by="v", stats_columns=["id", "x", "t", "d", "at", "late", "nothing"])
    every = len(SN.snapshot(spark, table_path).inputFiles())
    assert every == 5
    day = dt.date(2020, 2, 3)
    cases = {
        (("id", ">=", 30),): 2, (("id", "=", 12),): 1, (("id", "in", (3, 41)),): 1, (("id", "<", 0),): 0, (("id", "in", ()),): 0,
        (("x", ">", 35.5),): 1, (("x", "<", 5.0),): 2, (("x", "is null", None),): 4, (("x", "=", float("nan")),): 5,
        (("t", "=", long + "12"),): 4, (("t", ">", long + "z"),): 5, (("t", ">", "y"),): 1, (("t", "<=", "w"),): 0, (("t", ">=", "\U0010ffff" * 40),): 1,
        (("d", "=", day),): 1, (("d", "is null", None),): 1, (("d", "is not null", None),): 4, (("at", "<=", dt.datetime(2020, 1, 1, 0, 0, 2)),): 1,
        (("at", ">=", dt.datetime(2020, 4, 1, 0, 0, 4, 123456)),): 1, (("late", "is not null", None),): 2, (("late", "=", 1),): 2,
        (("plain", "=", 3),): 5, (("id", ">", 10), ("id", "<=", 20)): 2, (("id", "=", None),): 0,
    }
    for conditions, files in cases.items():
        got = SN.snapshot(spark, table_path, conditions=conditions)
        want = SN.snapshot(spark, table_path).where(Q.row_filter(conditions))
        opened = got.inputFiles() if files else []
        assert len(opened) <= files, (conditions, len(opened))
        assert sorted(map(str, got.collect())) == sorted(map(str, want.collect())), conditions
    with pytest.raises(Q.BadCondition):
        SN.snapshot(spark, table_path, conditions=[("id", "like", "x")])
    with pytest.raises(Q.BadCondition):
        SN.snapshot(spark, table_path, conditions=[("absent", "=", 1)])


def test_statistics_of_another_type_do_not_count(spark, table_path):
    W.append(spark, table_path, spark.range(5, 15), stats_columns=["id"])
    W.change_schema(spark, table_path, spark.range(1).select(F.col("id").cast("string")).schema)
    W.append(spark, table_path, spark.range(3, 4).select(F.col("id").cast("string")), stats_columns=["id"])
    got = SN.snapshot(spark, table_path, conditions=[("id", ">", "5")])
    assert sorted(r.id for r in got.collect()) == ["6", "7", "8", "9"]


def test_partition_values_skip_files(spark, table_path):
    df = spark.createDataFrame([(1, "a"), (2, None), (3, "b"), (4, "")], "id int, p string")
    W.append(spark, table_path, df, ["p"], stats_columns=["id"])
    for conditions, ids in ((("p", "=", "a"),), [1]), ((("p", "is null"),), [2]), ((("p", ">=", ""), ("id", ">", 1)), [3, 4]):
        assert sorted(r.id for r in SN.snapshot(spark, table_path, conditions=conditions).collect()) == ids


# ---- recovery --------------------------------------------------------------------------------------------------------


class Died(Exception):
    pass


@pytest.mark.parametrize("step", ["written", "published"])
def test_a_crash_at_each_point(spark, table_path, step):
    m = messages(spark, (PERSON, [person(i) for i in range(30)]), (WITH_GRADE, [person(i, grade=1) for i in range(30, 50)]))
    o = IngestOptions(table_path=table_path, records_per_commit=20)

    def reached(at):
        if at == step:
            raise Died

    with pytest.raises(Died):
        I.ingest_batch(m, o, 3, reached=reached)
    I.ingest_batch(m, o, 3)
    got = [r.age for r in SN.snapshot(spark, table_path).collect()]
    assert sorted(got) == list(range(50))
    left = R.orphans(spark, table_path, older_than_s=-60).collect()
    assert len(left) == (3 if step == "written" else 0)
    assert R.orphans(spark, table_path).isEmpty()  # too young: a writer may be at work
    assert len(R.remove_orphans(spark, table_path, older_than_s=-60)) == len(left)
    assert SN.snapshot(spark, table_path).count() == 50 and CH.changes(spark, table_path, 0).count() == 50
    assert R.orphans(spark, table_path + "-absent").isEmpty()


def test_only_flush_errors_count(spark, table_path, monkeypatch):
    tries = []

    def broken(*a, **k):
        tries.append(1)
        raise KeyError("a mistake in the code")

    monkeypatch.setattr(I.W, "write_files", broken)
    with pytest.raises(KeyError):
        I.ingest_batch(messages(spark, (PERSON, [person(1)])), IngestOptions(table_path=table_path))
    assert len(tries) == 1
