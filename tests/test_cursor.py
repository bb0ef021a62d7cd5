import itertools

import pytest
from pyspark.sql import functions as F

from tableflow.functions import cursor as C

FULL, INCR = C.FULL, C.INCREMENTAL


@pytest.mark.parametrize("a, b, want", [
    ((FULL, 1, 0, 0), (FULL, 1, 0, 0), 0),
    ((FULL, 9, 9, 9), (INCR, 0, 0, 0), -1),
    ((INCR, 0, 0, 0), (FULL, 9, 9, 9), 1),
    ((INCR, 2, 0, 0), (INCR, 1, 9, 9), 1),
    ((INCR, 1, 2, 0), (INCR, 1, 3, 0), -1),
    ((INCR, 1, 2, 5), (INCR, 1, 2, 4), 1),
    ((INCR, 1, 2, 4), (INCR, 1, 2, 4), 0),
])
def test_compare(a, b, want):
    assert C.Cursor(*a, seq=1).compare(C.Cursor(*b, seq=7)) == want


def test_column_order_matches(spark):
    cs = [C.Cursor(s, v, i, r) for s, v, i, r in itertools.product((FULL, INCR), (0, 2), (0, 1), (0, 3))]
    rows = [(c.state == FULL, c.version, c.index, c.row) for c in reversed(cs)]
    df = spark.createDataFrame(rows, "f boolean, v bigint, i bigint, r bigint")
    got = df.orderBy(C.position(F.col("f"), F.col("v"), F.col("i"), F.col("r"))).collect()
    assert [tuple(r) for r in got] == [(c.state == FULL, c.version, c.index, c.row) for c in sorted(cs)]


def test_json_and_key(spark):
    c = C.Cursor(INCR, 4, 2, 10, 7)
    assert C.Cursor.from_json(c.to_json()) == c
    assert C.Cursor.from_json('{"state":"FULL_COPY","snapShotVersion":3,"other":1}') == C.Cursor(FULL, 3)
    for bad in ("{", "{}", '{"state":"X","snapShotVersion":1}', "null"):
        with pytest.raises(ValueError):
            C.Cursor.from_json(bad)
    assert C.state_key(3) == "checkpoint3"
    row = spark.range(1).select(C.state_key_column(F.lit(3)), C.cursor_json(
        F.lit(False), F.lit(4), F.lit(2), F.lit(10), F.lit(7))).first()
    assert row[0] == "checkpoint3" and C.Cursor.from_json(row[1]) == c
    assert spark.range(1).select(C.parse_cursor_json(F.lit(row[1])).alias("c")).first()["c"]["rowNum"] == 10
    with pytest.raises(Exception):
        spark.range(1).select(C.parse_cursor_json(F.lit("{bad")).alias("c")).collect()


def kept(spark, saved, actions, inclusive=True):
    acts = spark.createDataFrame(actions, "slot int, is_full boolean, version bigint, idx bigint")
    out = C.resume_filter(acts, C.checkpoints_frame(spark, saved), inclusive)
    return {(r["slot"], r["is_full"], r["version"], r["idx"]): r["min_row"] for r in out.collect()}


def test_resume_filter(spark):
    saved = {0: C.Cursor(FULL, 4, 4, 200), 1: C.Cursor(INCR, 3, 10, 300)}
    got = kept(spark, saved, [
        (0, True, 4, 3), (0, True, 4, 4), (0, True, 4, 5), (0, False, 0, 0),
        (1, True, 9, 0), (1, False, 3, 9), (1, False, 3, 10), (1, False, 4, 0),
        (2, False, 0, 0),
    ])
    assert got == {
        (0, True, 4, 4): 200, (0, True, 4, 5): 0, (0, False, 0, 0): 0,
        (1, False, 3, 10): 300, (1, False, 4, 0): 0, (2, False, 0, 0): 0,
    }
    assert kept(spark, saved, [(1, False, 3, 10)], inclusive=False) == {(1, False, 3, 10): 301}


def test_minimum():
    assert C.minimum({}) is None
    assert C.minimum({0: C.Cursor(INCR, 1), 1: C.Cursor(FULL, 8)}) == C.Cursor(FULL, 8)
