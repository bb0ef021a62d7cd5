import pytest

from test_ingest import PERSON, WITH_GRADE, messages, person
from tableflow.operators import write as W
from tableflow.options import IngestOptions
from tableflow.plans import catalog as CT


def test_a_table_by_name(spark, tmp_path):
    raw = {"type": "iceberg", "tableNamespace": "people", "tableName": "hang", "catalogProperties": {"warehouse": str(tmp_path)}}
    name, o = CT.create(spark, raw)
    assert name == "people.hang" and o.layout == "evolving" and CT.resolve(spark, name) == str(tmp_path / "people" / "hang") == o.table_path
    CT.ingest(messages(spark, (PERSON, [person(i) for i in range(5)])), name, o, 0)
    assert spark.table(name).columns == ["name", "age", "phone", "address", "score"]
    CT.ingest(messages(spark, (WITH_GRADE, [person(i, grade=i) for i in range(3)])), name, IngestOptions("evolving", "elsewhere"), 1)
    assert CT.read(spark, name).count() == 8 and CT.read(spark, name, conditions=[("grade", ">", 0)]).count() == 2
    assert "grade" in spark.table(name).columns and spark.table(name).count() == 0  # rows are read by their log only
    assert CT.create(spark, raw)[0] == name  # a second time changes nothing


def test_names_that_cannot_be_used(spark, tmp_path):
    W.append(spark, str(tmp_path / "a"), spark.range(3))
    CT.register(spark, "of_a", str(tmp_path / "a"))
    assert CT.read(spark, "of_a").count() == 3
    with pytest.raises(ValueError, match="is registered at"):
        CT.register(spark, "of_a", str(tmp_path / "b"))
    with pytest.raises(CT.UnknownTable):
        CT.resolve(spark, "absent.table")
    spark.range(2).write.mode("overwrite").option("path", str(tmp_path / "plain")).saveAsTable("plain_table")
    with pytest.raises(CT.UnknownTable, match="another kind"):
        CT.resolve(spark, "plain_table")
    with pytest.raises(ValueError, match="one level"):
        CT.create(spark, {"type": "iceberg", "tableNamespace": "a.b", "tableName": "t", "catalogProperties": {"warehouse": str(tmp_path)}})
