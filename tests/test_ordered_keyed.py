import random

import pytest
from pyspark.sql import functions as F

from tableflow.operators import keyed, ordered

random.seed(5)


def ids(kind, n=5000):
    if kind == "dense":
        return list(range(n))
    if kind == "clustered":  # a third of all ids lie in one tiny range, the rest are far apart
        return sorted({*range(10**12, 10**12 + n // 3), *(random.randrange(10**15) for _ in range(n * 2 // 3))})
    return sorted(random.sample(range(-(10**9), 10**9), n))


@pytest.mark.parametrize("kind", ["dense", "clustered", "random"])
def test_commit_groups(spark, kind):
    order = ids(kind)
    df = spark.createDataFrame([(i,) for i in order], "msg_id bigint").repartition(7)
    got = {r[0]: r[1] for r in ordered.commit_groups(df, "msg_id", 700, rows_per_bucket=400).collect()}
    assert got == {m: i // 700 for i, m in enumerate(order)}


def test_groups_restart_per_run(spark):
    rows = [(i, i // 1300) for i in range(4000)]
    df = spark.createDataFrame(rows, "msg_id bigint, run bigint")
    got = ordered.commit_groups(df, "msg_id", 500, by=["run"], rows_per_bucket=300).collect()
    assert {r["msg_id"]: r["_group"] for r in got} == {m: (m % 1300) // 500 for m, _ in rows}


@pytest.mark.parametrize("kind", ["dense", "clustered"])
def test_schema_runs(spark, kind):
    order = ids(kind)
    keys, k = [], 0
    for _ in order:
        k = k if random.random() < 0.99 else random.randrange(3)
        keys.append(k)
    want, run = {}, 0
    for i, m in enumerate(order):
        run += i > 0 and keys[i] != keys[i - 1]
        want[m] = run
    df = spark.createDataFrame(list(zip(order, keys)), "msg_id bigint, k int").repartition(5)
    got = {r["msg_id"]: r["_run"] for r in ordered.schema_runs(df, "msg_id", "k", rows_per_bucket=333).collect()}
    assert got == want


def test_runs_over_empty_and_single(spark):
    assert ordered.schema_runs(spark.createDataFrame([], "msg_id bigint, k int"), "msg_id", "k").count() == 0
    one = spark.createDataFrame([(4, None)], "msg_id bigint, k int")
    assert ordered.schema_runs(one, "msg_id", "k").first()["_run"] == 0


def test_buckets_are_bounded(spark):
    """No bucket takes much more than its share, even for clustered ids."""
    df = spark.createDataFrame([(i,) for i in ids("clustered", 30000)], "msg_id bigint")
    sizes = ordered.with_buckets(df, "msg_id", 1000).groupBy(ordered.BUCKET).count()
    top, n = sizes.agg(F.max("count"), F.count("*")).first()
    assert top <= 1500 and n >= 20


def test_last_per_key(spark):
    rows = [(i % 7 if i % 3 else 0, i, None if i % 5 == 0 else i * 1.0) for i in range(1000)]
    df = spark.createDataFrame(rows, "k int, msg_id bigint, v double")
    want = {}
    for r in rows:
        want[r[0]] = r
    assert {r[0]: tuple(r) for r in keyed.last_per_key(df, "k", "msg_id").collect()} == want
    plan = keyed.last_per_key(df, "k", "msg_id")._jdf.queryExecution().executedPlan().toString()
    assert "partial_max_by" in plan  # a hot key is combined before the shuffle


def test_commit_check(spark):
    df = spark.createDataFrame([(1, None), (2, "x"), (3, "y")], "id int, why string")
    assert tuple(keyed.commit_check(df, "why").first()) == (3, 2)
    assert keyed.write_errors(df, "why", 1).count() == 1
