"""Every registered query against its SQL, on the smallest data folder."""

import glob
import os

import duckdb
import pytest

import __spark_entry__ as entry
from tableflow import oracles, workload

SF = os.environ.get("TEST_SF_DIR", "/root/testdata/sf0.001")


@pytest.fixture(scope="module")
def sql():
    con = duckdb.connect()
    for f in glob.glob(f"{SF}/*.parquet"):
        con.execute(f"CREATE VIEW {os.path.basename(f)[:-8]} AS SELECT * FROM '{f}'")
    return con


def text(x):
    if x is None:
        return "null"
    if isinstance(x, (int, float)) and not isinstance(x, bool):
        return repr(round(float(x), 6))
    return str(x)


def bag(rows, names):
    at = [i for i, _ in sorted(enumerate(names), key=lambda p: p[1])]
    return sorted(tuple(text(r[i]) for i in at) for r in rows)


def test_every_query_has_sql():
    assert set(workload.QUERIES) == set(oracles.ORACLES)
    assert set(entry.oracle_sql()) <= set(entry.queries())


@pytest.mark.parametrize("name", sorted(entry.oracle_sql()))
def test_query(spark, sql, name):
    got = entry.queries()[name](spark, SF)
    want = sql.execute(entry.oracle_sql()[name])
    columns = [c[0] for c in want.description]
    assert sorted(got.columns) == sorted(columns)
    assert bag(got.collect(), got.columns) == bag(want.fetchall(), columns)


def test_entry(spark):
    df = entry.entry(spark)
    assert df.count() > 0 and "_op" in df.columns
