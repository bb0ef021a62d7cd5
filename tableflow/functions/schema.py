"""Schema bridge: Avro schema JSON <-> StructType, null stripping, differences and evolution.

All of this runs on the driver, once per distinct schema.
"""

from __future__ import annotations

import json
from collections.abc import Collection
from typing import Any

from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql import types as T

AvroSchema = Any

_PRIMITIVES: dict[str, T.DataType] = {
    "string": T.StringType(),
    "bytes": T.BinaryType(),
    "int": T.IntegerType(),
    "long": T.LongType(),
    "float": T.FloatType(),
    "double": T.DoubleType(),
    "boolean": T.BooleanType(),
    "null": T.NullType(),
}


class UnsupportedSchema(ValueError):
    """A schema that has no table counterpart."""


def parse_avro(text: str) -> AvroSchema:
    try:
        return json.loads(text)
    except json.JSONDecodeError as e:
        raise UnsupportedSchema(f"not Avro schema JSON: {e}") from e


def _kind(schema: AvroSchema) -> str:
    if isinstance(schema, list):
        return "union"
    if isinstance(schema, dict):
        return _kind(schema["type"]) if isinstance(schema["type"], (dict, list)) else schema["type"]
    return schema


def _unwrapped(schema: AvroSchema) -> AvroSchema:
    while isinstance(schema, dict) and isinstance(schema["type"], (dict, list)):
        schema = schema["type"]
    return schema


def _is_null(schema: AvroSchema) -> bool:
    return _kind(schema) == "null"


class _AvroReader:
    """Avro schema to Spark types; remembers named records so that later fields can refer to them."""

    def __init__(self, bytes_as_string: bool):
        self.bytes_as_string = bytes_as_string
        self.named: dict[str, T.DataType] = {}

    def convert(self, schema: AvroSchema) -> tuple[T.DataType, bool]:
        """(type, nullable)"""
        schema = _unwrapped(schema)
        kind = _kind(schema)
        if kind == "union":
            branches = [s for s in schema if not _is_null(s)]
            if not branches:
                return T.NullType(), True
            return self.convert(branches[0])[0], len(branches) < len(schema)
        if kind == "bytes":
            return (T.StringType() if self.bytes_as_string else T.BinaryType()), False
        if kind in _PRIMITIVES:
            return _PRIMITIVES[kind], kind == "null"
        if kind == "record":
            return self.record(schema), True
        if kind == "array":
            return T.ArrayType(self.convert(schema["items"])[0], True), True
        if kind == "map":
            item, nullable = self.convert(schema["values"])
            return T.MapType(T.StringType(), item, nullable), True
        if kind in self.named:
            return self.named[kind], True
        raise UnsupportedSchema(f"Avro type {kind!r} has no table type")

    def record(self, schema: AvroSchema) -> T.StructType:
        out = T.StructType()
        for f in schema["fields"]:
            data_type, nullable = self.convert(f["type"])
            out.add(T.StructField(f["name"], data_type, nullable))
        if "name" in schema:
            self.named[schema["name"]] = out
            if schema.get("namespace"):
                self.named[f"{schema['namespace']}.{schema['name']}"] = out
        return out


def avro_to_struct(text: str | AvroSchema, bytes_as_string: bool = False) -> T.StructType:
    """Table schema of an Avro record schema."""
    schema = parse_avro(text) if isinstance(text, str) else text
    if _kind(schema) != "record":
        raise UnsupportedSchema("the message schema must be a record")
    return _AvroReader(bytes_as_string).record(_unwrapped(schema))


def json_problems(schema: AvroSchema) -> list[str]:
    """What keeps JSON payloads of a message schema from being decoded; empty if nothing does.

    A value must have one type besides null, and a map must not be spelled as an array of key and value records.
    """
    found: list[str] = []
    open_parts = [schema]
    while open_parts:
        part = _unwrapped(open_parts.pop())
        kind = _kind(part)
        if kind == "union":
            typed = [s for s in part if not _is_null(s)]
            if len(typed) != 1:
                found.append(f"a union of {len(typed)} types besides null: {part}")
            open_parts += typed
        elif kind == "record":
            open_parts += [f["type"] for f in part["fields"]]
        elif kind == "map":
            open_parts.append(part["values"])
        elif kind == "array":
            items = _unwrapped(part["items"])
            if _kind(items) == "record" and {f["name"] for f in items["fields"]} >= {"key", "value"}:
                found.append("an array of key and value records in place of a map")
            open_parts.append(items)
    return found


def required_filled(value: Column, data_type: T.DataType) -> Column:
    """True when no field inside ``value`` is null: the condition under which a null-stripped schema decodes."""
    ok = value.isNotNull()
    if isinstance(data_type, T.StructType):
        for f in data_type.fields:
            ok = ok & required_filled(value.getField(f.name), f.dataType)
    elif isinstance(data_type, T.ArrayType):
        ok = ok & F.forall(value, lambda x: required_filled(x, data_type.elementType))
    elif isinstance(data_type, T.MapType):
        ok = ok & F.forall(F.map_values(value), lambda x: required_filled(x, data_type.valueType))
    return F.coalesce(ok, F.lit(False))


_MESSAGE_TYPES: list[tuple[type, Any]] = [
    (T.StringType, "string"),
    (T.BooleanType, "boolean"),
    (T.BinaryType, "bytes"),
    (T.DoubleType, "double"),
    (T.FloatType, "float"),
    (T.IntegerType, "int"),
    (T.LongType, "long"),
    (T.ShortType, "int"),
    (T.ByteType, "int"),
    (T.NullType, "null"),
    (T.DateType, {"type": "int", "logicalType": "date"}),
    (T.TimestampType, {"type": "long", "logicalType": "timestamp-micros"}),
    (T.TimestampNTZType, {"type": "long", "logicalType": "local-timestamp-micros"}),
    (T.DecimalType, "double"),
]


def message_type(data_type: T.DataType) -> Any:
    """Avro type of one table type; nested and unknown types travel as JSON text."""
    for cls, avro in _MESSAGE_TYPES:
        if isinstance(data_type, cls):
            return avro
    return "string"


def struct_to_avro(schema: T.StructType, name: str = "struct") -> str:
    """Message schema (Avro record JSON) of a table schema."""
    if not schema.fields:
        raise UnsupportedSchema("a message schema needs at least one field")
    fields = []
    for f in schema.fields:
        kind = message_type(f.dataType)
        if f.nullable and kind != "null":
            fields.append({"name": f.name, "type": ["null", kind], "default": None})
        else:
            fields.append({"name": f.name, "type": kind})
    return json.dumps({"type": "record", "name": name, "fields": fields})


# ---- comparison and evolution ----------------------------------------------------------------------------------

PHYSICAL = "physicalName"


def physical_name(field: T.StructField) -> str:
    """Column name inside the data files; differs from the field name only for a name that was used before."""
    return (field.metadata or {}).get(PHYSICAL, field.name)


def plain_type(data_type: T.DataType) -> T.DataType:
    """The type with every level nullable and no metadata, as Parquet files are read with."""
    if isinstance(data_type, T.StructType):
        return T.StructType([T.StructField(f.name, plain_type(f.dataType), True) for f in data_type.fields])
    if isinstance(data_type, T.ArrayType):
        return T.ArrayType(plain_type(data_type.elementType), True)
    if isinstance(data_type, T.MapType):
        return T.MapType(plain_type(data_type.keyType), plain_type(data_type.valueType), True)
    return data_type


def signature(schema: T.StructType) -> str:
    """Text that is equal exactly for structurally equal schemas (names, order, types, nullability)."""
    return json.dumps([[f.name, f.dataType.jsonValue(), f.nullable] for f in schema.fields], sort_keys=True)


def same_schema(a: T.StructType, b: T.StructType) -> bool:
    return signature(a) == signature(b)


def schema_difference(table: T.StructType, incoming: T.StructType) -> tuple[list[str], list[str]]:
    """(names to add, names to remove), by name."""
    have, want = set(table.fieldNames()), set(incoming.fieldNames())
    return [n for n in incoming.fieldNames() if n not in have], [n for n in table.fieldNames() if n not in want]


def evolve_replace(table: T.StructType, incoming: T.StructType) -> T.StructType:
    """The incoming schema becomes the table schema as it is."""
    return table if same_schema(table, incoming) else incoming


def evolve_by_name(
    table: T.StructType, incoming: T.StructType, used_names: Collection[str] = ()
) -> T.StructType:
    """Drop columns no longer sent and put each new one after its left neighbour; kept columns keep their type.

    ``used_names`` are the physical names of all earlier schemas. A new column whose name was used before, in any
    case, gets a fresh physical name, so that values from the dropped column stay hidden.
    """
    added, removed = schema_difference(table, incoming)
    if not added and not removed:
        return table
    fields = [f for f in table.fields if f.name not in set(removed)]
    taken = {n.lower() for n in [*used_names, *map(physical_name, table.fields)]}
    left = None
    for new in incoming.fields:
        if new.name in set(added):
            physical, n = new.name, 1
            while physical.lower() in taken:
                n += 1
                physical = f"{new.name}__{n}"
            taken.add(physical.lower())
            meta = {PHYSICAL: physical} if physical != new.name else {}
            at = 0 if left is None else [f.name for f in fields].index(left) + 1
            fields.insert(at, T.StructField(new.name, new.dataType, True, meta))
        left = new.name
    return T.StructType(fields)


def evolve_merge(table: T.StructType, incoming: T.StructType) -> T.StructType:
    """Columns of both: table columns first, new ones at the end. A type may only widen."""
    fields = {f.name: f for f in table.fields}
    for new in incoming.fields:
        old = fields.get(new.name)
        if old is None:
            fields[new.name] = T.StructField(new.name, new.dataType, True)
        elif reads_as(old.dataType, new.dataType):
            fields[new.name] = T.StructField(new.name, new.dataType, True, old.metadata)
        elif not reads_as(new.dataType, old.dataType):
            raise UnsupportedSchema(f"column {new.name!r} cannot change from {old.dataType} to {new.dataType}")
    merged = T.StructType([fields[n] for n in fields])
    return table if same_schema(T.StructType([T.StructField(f.name, f.dataType, f.nullable) for f in merged]),
                                T.StructType([T.StructField(f.name, f.dataType, f.nullable) for f in table])) else merged


_WIDER: dict[type, tuple[type, ...]] = {
    T.ByteType: (T.ShortType, T.IntegerType, T.LongType),
    T.ShortType: (T.IntegerType, T.LongType),
    T.IntegerType: (T.LongType,),
    T.FloatType: (T.DoubleType,),
}


def reads_as(file_type: T.DataType, wanted: T.DataType) -> bool:
    """Whether the Parquet reader can deliver a column written as ``file_type`` as ``wanted``."""
    return plain_type(file_type) == plain_type(wanted) or type(wanted) in _WIDER.get(type(file_type), ())
