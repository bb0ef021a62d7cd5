import json

import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tableflow.functions import schema as S

PERSON = {"type": "record", "name": "person", "fields": [
    {"name": "name", "type": ["null", "string"], "default": None},
    {"name": "age", "type": ["null", "int"], "default": None},
    {"name": "score", "type": ["null", "double"], "default": None},
    {"name": "id", "type": "long"},
]}


def test_flat_record():
    got = S.avro_to_struct(json.dumps(PERSON))
    assert got == T.StructType([
        T.StructField("name", T.StringType(), True), T.StructField("age", T.IntegerType(), True),
        T.StructField("score", T.DoubleType(), True), T.StructField("id", T.LongType(), False),
    ])


def test_nested_types():
    schema = {"type": "record", "name": "r", "fields": [
        {"name": "a", "type": {"type": "array", "items": ["null", "float"]}},
        {"name": "m", "type": ["null", {"type": "map", "values": "boolean"}]},
        {"name": "b", "type": "bytes"},
        {"name": "p", "type": {"type": "record", "name": "point", "fields": [{"name": "x", "type": "int"}]}},
        {"name": "q", "type": ["null", "point"]},
    ]}
    got = S.avro_to_struct(schema)
    assert got["a"].dataType == T.ArrayType(T.FloatType(), True)
    assert got["m"].dataType == T.MapType(T.StringType(), T.BooleanType(), False) and got["m"].nullable
    assert got["b"].dataType == T.BinaryType()
    assert S.avro_to_struct(schema, bytes_as_string=True)["b"].dataType == T.StringType()
    assert got["p"].dataType == got["q"].dataType and got.fieldNames() == ["a", "m", "b", "p", "q"]


@pytest.mark.parametrize("kind", [{"type": "fixed", "name": "f", "size": 4}, {"type": "enum", "name": "e", "symbols": ["A"]}])
def test_unsupported_types(kind):
    with pytest.raises(S.UnsupportedSchema):
        S.avro_to_struct({"type": "record", "name": "r", "fields": [{"name": "x", "type": kind}]})


def test_bad_texts():
    for text in ("no json", '"string"'):
        with pytest.raises(S.UnsupportedSchema):
            S.avro_to_struct(text)


def test_json_problems():
    assert S.json_problems(PERSON) == []
    field = lambda kind: {"type": "record", "name": "r", "fields": [{"name": "f", "type": kind}]}
    assert S.json_problems(field({"type": "array", "items": ["null", "int"]})) == []
    assert S.json_problems(field({"type": "map", "values": ["string", "null"]})) == []
    assert len(S.json_problems(["null", "int", "string"])) == 1
    assert len(S.json_problems(field({"type": "array", "items": ["null", "int", "long"]}))) == 1
    kv = {"type": "record", "name": "e", "fields": [{"name": "key", "type": "string"}, {"name": "value", "type": ["int", "long"]}]}
    assert len(S.json_problems(field({"type": "array", "items": kv}))) == 2
    assert len(S.json_problems(["null"])) == 1


def test_required_filled(spark):
    df = spark.sql("""select named_struct('a', array(1, 2), 'm', map('k', 'v')) ok,
                             named_struct('a', array(1, null), 'm', map('k', 'v')) hole,
                             named_struct('a', array(1), 'm', map('k', cast(null as string))) gap""")
    assert [df.select(S.required_filled(F.col(c), df.schema[c].dataType)).first()[0] for c in df.columns] == [True, False, False]


def test_message_schema():
    table = T.StructType([
        T.StructField("s", T.StringType(), False), T.StructField("d", T.DecimalType(10, 2), True),
        T.StructField("a", T.ArrayType(T.IntegerType()), True), T.StructField("b", T.ByteType(), False),
    ])
    got = json.loads(S.struct_to_avro(table))
    assert [f["name"] for f in got["fields"]] == ["s", "d", "a", "b"]
    assert [f["type"] for f in got["fields"]] == ["string", ["null", "double"], ["null", "string"], "int"]
    with pytest.raises(S.UnsupportedSchema):
        S.struct_to_avro(T.StructType([]))


def st(*names):
    return T.StructType([T.StructField(n, T.IntegerType()) for n in names])


def test_difference_and_comparison():
    assert S.schema_difference(st("a", "b"), st("b", "c")) == (["c"], ["a"])
    assert S.same_schema(st("a"), st("a")) and not S.same_schema(st("a", "b"), st("b", "a"))


def test_evolve_by_name_positions():
    got = S.evolve_by_name(st("a", "b", "c"), st("n", "a", "m", "c", "z"))
    assert got.fieldNames() == ["n", "a", "m", "c", "z"]
    same = st("a", "b")
    retyped = T.StructType([T.StructField("a", T.StringType()), T.StructField("b", T.IntegerType())])
    assert S.evolve_by_name(same, retyped) is same  # type changes are not followed


def test_evolve_by_name_hides_old_values():
    dropped = S.evolve_by_name(st("a", "b"), st("a"))
    back = S.evolve_by_name(dropped, st("a", "b"), used_names={"a", "b"})
    assert back.fieldNames() == ["a", "b"] and S.physical_name(back["b"]) == "b__2"
    again = S.evolve_by_name(S.evolve_by_name(back, st("a")), st("a", "b"), used_names={"a", "b", "b__2"})
    assert S.physical_name(again["b"]) == "b__3"


def test_evolve_merge():
    wide = T.StructType([T.StructField("a", T.LongType()), T.StructField("c", T.StringType())])
    got = S.evolve_merge(st("a", "b"), wide)
    assert got.fieldNames() == ["a", "b", "c"] and got["a"].dataType == T.LongType()
    with pytest.raises(S.UnsupportedSchema):
        S.evolve_merge(st("a"), T.StructType([T.StructField("a", T.StringType())]))
