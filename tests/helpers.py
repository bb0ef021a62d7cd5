"""Small tables in the public log layout, written without the library."""

import json
import os

import pyarrow as pa
import pyarrow.parquet as pq


def add(path, size=1, values=None, ts=1000, data_change=True, rows=None):
    a = {"path": path, "partitionValues": values or {}, "size": size, "modificationTime": ts, "dataChange": data_change}
    if rows is not None:
        a["stats"] = json.dumps({"numRecords": rows})
    return {"add": a}


def remove(path, values=None, ts=2000):
    return {"remove": {"path": path, "partitionValues": values or {}, "deletionTimestamp": ts, "dataChange": True}}


def meta(fields, partition_columns=()):
    schema = {"type": "struct", "fields": [{"name": n, "type": t, "nullable": True, "metadata": {}} for n, t in fields]}
    return {"metaData": {"id": "x", "format": {"provider": "parquet", "options": {}}, "schemaString": json.dumps(schema),
                         "partitionColumns": list(partition_columns), "configuration": {}, "createdTime": 1}}


def info(ts):
    return {"commitInfo": {"timestamp": ts, "operation": "WRITE"}}


def protocol():
    return {"protocol": {"minReaderVersion": 1, "minWriterVersion": 2}}


def log(table, version, *entries):
    folder = os.path.join(table, "_delta_log")
    os.makedirs(folder, exist_ok=True)
    with open(os.path.join(folder, f"{version:020d}.json"), "w") as f:
        f.write("\n".join(json.dumps(e) for e in entries) + "\n")


def parquet(table, name, columns, row_group_size=None):
    path = os.path.join(table, name)
    os.makedirs(os.path.dirname(path), exist_ok=True)
    pq.write_table(pa.table(columns), path, row_group_size=row_group_size)
    return os.path.getsize(path)


READINGS = 4321


def readings(table):
    """One file of sensor readings in small row groups, after commit info, protocol and schema; returns its rows."""
    rows = [(i, i * 37 % 101, f"probe {i % 7}") for i in range(READINGS)]
    tick, level, probe = map(list, zip(*rows))
    size = parquet(table, "part-0.parquet", {"tick": tick, "level": level, "probe": probe}, row_group_size=600)
    log(table, 0, info(5000), protocol(), meta([("tick", "long"), ("level", "long"), ("probe", "string")]),
        add("part-0.parquet", size))
    return rows
