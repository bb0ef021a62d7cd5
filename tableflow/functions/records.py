"""Record-level expressions: primitive wrapping, record keys, event time, type bridge, destination."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

PRIMITIVE_TYPES = {"STRING": "string", "BYTES": "binary"}
DEFAULT_FIELD = "message"


def wrap_primitive(
    df: DataFrame, payload: str, schema_type: str, field: str = "", stable_id: str | None = None
) -> DataFrame:
    """``{message, uuid}`` rows from STRING or BYTES payloads.

    ``field`` renames ``message``. ``stable_id`` names a column whose hash replaces the random uuid, which keeps
    replays of a batch identical.
    """
    kind = schema_type.upper()
    if kind not in PRIMITIVE_TYPES:
        raise ValueError(f"not a supported primitive type: {schema_type}")
    ident = F.sha2(F.col(stable_id).cast("string"), 256) if stable_id else F.uuid()
    return df.select(
        F.col(payload).cast(PRIMITIVE_TYPES[kind]).alias(field or DEFAULT_FIELD), ident.alias("uuid")
    )


def unwrap_primitive(df: DataFrame, field: str = "") -> DataFrame:
    """The wrapped value and its id; raises when the rows are not wrapped primitives."""
    name = field or DEFAULT_FIELD
    if name not in df.columns and "uuid" not in df.columns:
        raise ValueError(f"rows have neither {name!r} nor 'uuid'")
    return df.select(name, "uuid")


def record_key(path: str) -> Column:
    """Record key text from a configured field; dots go into structs, commas join several fields."""
    parts = [F.col(p.strip()).cast("string") for p in path.split(",")]
    if len(parts) == 1:
        return parts[0]
    names = [p.strip() for p in path.split(",")]
    shown = [F.concat(F.lit(f"{n}:"), F.coalesce(c, F.lit("__null__"))) for n, c in zip(names, parts)]
    return F.concat_ws(",", *shown)


def event_time(ts_text: Column) -> Column:
    """Milliseconds from the ``ts`` property; unreadable text gives 0."""
    return F.coalesce(ts_text.try_cast("bigint"), F.lit(0).cast("bigint"))


def destination(topic: str, slot_col: Column) -> Column:
    return F.concat(F.lit(f"{topic}-"), slot_col.cast("string"))


_SAME = (
    T.StringType, T.BooleanType, T.BinaryType, T.DoubleType, T.FloatType, T.IntegerType, T.LongType,
    T.ShortType, T.ByteType, T.DateType, T.TimestampType, T.TimestampNTZType,
)


def bridge_value(col: Column, data_type: T.DataType) -> Column:
    """A table value in its message type: decimals become doubles, nested values JSON text."""
    if isinstance(data_type, _SAME):
        return col
    if isinstance(data_type, T.DecimalType):
        return col.cast("double")
    if isinstance(data_type, T.NullType):
        return F.lit(None).cast("string")
    if isinstance(data_type, (T.ArrayType, T.MapType, T.StructType)):
        return F.to_json(col)
    return col.cast("string")


def bridge_row(df: DataFrame, columns: list[str] | None = None) -> DataFrame:
    """All (or the given) columns in their message types."""
    picked = set(columns if columns is not None else df.columns)
    return df.select(
        *[bridge_value(F.col(f.name), f.dataType).alias(f.name) if f.name in picked else F.col(f.name)
          for f in df.schema.fields]
    )
