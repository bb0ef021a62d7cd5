import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tableflow.functions import partitions as P
from tableflow.functions import records as R


def one(df, col):
    return df.select(col.alias("x")).first()[0]


def test_partition_string(spark):
    df = spark.range(1)
    m = F.create_map(*[F.lit(x) for x in ("year", "2021", "month", "3", "day", "23")])
    assert one(df, P.partition_string(m)) == "day=23,month=3,year=2021"
    assert one(df, P.partition_string(F.create_map().cast("map<string,string>"))) == ""
    assert one(df, P.partition_string(F.lit(None).cast("map<string,string>"))) == ""
    assert one(df, P.partition_string(F.create_map(F.lit("a"), F.lit(None).cast("string")))) == "a=null"


def test_partition_path_and_values(spark):
    df = spark.createDataFrame([("hang", 18, None)], "name string, age int, phone string")
    assert one(df, P.partition_path(df, ["name", "age"])) == "name=hang/age=18"
    assert one(df, P.partition_path(df, ["age", "name"])) == "age=18/name=hang"
    assert one(df, P.partition_path(df, ["name", "missing"])) == ""
    assert one(df, P.partition_path(df, [])) == ""
    assert one(df, P.partition_path(df, ["phone"])) == "phone=null"
    assert one(df, P.partition_values(df, ["name", "missing", "phone"])) == {"name": "hang", "phone": "null"}
    assert one(df, P.partition_values(df, [])) == {}


def test_wrap_and_unwrap(spark):
    df = spark.createDataFrame([(i, f"message-{i}") for i in range(10)], "id int, p string")
    w = R.wrap_primitive(df, "p", "STRING")
    assert w.columns == ["message", "uuid"] and w.select("uuid").distinct().count() == 10
    b = R.wrap_primitive(df, "p", "bytes", field="body", stable_id="id")
    assert b.schema["body"].dataType == T.BinaryType()
    assert b.collect() == R.wrap_primitive(df, "p", "bytes", field="body", stable_id="id").collect()
    assert R.unwrap_primitive(b, "body").columns == ["body", "uuid"]
    with pytest.raises(ValueError):
        R.wrap_primitive(df, "p", "INT64")
    with pytest.raises(ValueError):
        R.unwrap_primitive(df, "body")


def test_keys_time_destination(spark):
    df = spark.createDataFrame([((7, ("x",)), "12", "bad")], "a struct<b:int,c:struct<d:string>>, t string, u string")
    assert one(df, R.record_key("a.c.d")) == "x"
    assert one(df, R.record_key("a.b, t")) == "a.b:7,t:12"
    assert (one(df, R.event_time(F.col("t"))), one(df, R.event_time(F.col("u")))) == (12, 0)
    assert one(df, R.destination("topic", F.lit(3))) == "topic-3"


def test_bridge(spark):
    df = spark.sql("select cast(1.50 as decimal(5,2)) d, array(1,2) a, map('k', 1) m, named_struct('x', 1) s, "
                   "date'2020-01-02' dt, timestamp'2020-01-02 03:04:05' ts, cast(null as void) n")
    r = R.bridge_row(df).first()
    assert (r["d"], r["a"], r["m"], r["s"], r["n"]) == (1.5, "[1,2]", '{"k":1}', '{"x":1}', None)
    assert str(r["dt"]) == "2020-01-02" and str(r["ts"]) == "2020-01-02 03:04:05"
