"""Messages to rows: which are usable, JSON payloads, wrapped primitives, and a reason for each that is not."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tableflow.functions import records
from tableflow.functions import schema as S

REASON = "_reject"
RECORD_TYPES = ("AVRO", "JSON")
PRIMITIVES = tuple(records.PRIMITIVE_TYPES)

# Reject reasons.
NO_SCHEMA = "no schema text"
BAD_SCHEMA = "schema not readable"
BAD_TYPE = "unsupported schema type"
NO_PAYLOAD = "no payload"
MALFORMED = "malformed payload"
INCOMPLETE = "missing or null field"
NO_KEY = "no record key"

_CORRUPT = "__corrupt"


class RejectedMessage(RuntimeError):
    """A message could not be used and the caller asked to stop at the first one."""


def classify(messages: DataFrame, primitives_need_schema: bool = False) -> DataFrame:
    """Add ``_reject``: why a message cannot be used, judged by its schema fields; null when it can."""
    kind = F.upper(F.col("schema_type"))
    blank = F.trim(F.coalesce(F.col("schema"), F.lit(""))) == ""
    needs_text = F.lit(True) if primitives_need_schema else ~kind.isin(*PRIMITIVES)
    return messages.withColumn(
        REASON,
        F.when(blank & F.coalesce(needs_text, F.lit(True)), NO_SCHEMA)
        .when(~F.coalesce(kind.isin(*RECORD_TYPES, *PRIMITIVES), F.lit(False)), BAD_TYPE),
    )


def _json_type(data_type: T.DataType) -> T.DataType:
    """The type JSON text is parsed with: bytes arrive as text with one character per byte."""
    if isinstance(data_type, T.BinaryType):
        return T.StringType()
    if isinstance(data_type, T.StructType):
        return T.StructType([T.StructField(f.name, _json_type(f.dataType), True) for f in data_type.fields])
    if isinstance(data_type, T.ArrayType):
        return T.ArrayType(_json_type(data_type.elementType), True)
    if isinstance(data_type, T.MapType):
        return T.MapType(T.StringType(), _json_type(data_type.valueType), True)
    return data_type


def _from_json_type(value: Column, data_type: T.DataType) -> Column:
    """The parsed value in its table type."""
    if _json_type(data_type) == S.plain_type(data_type):
        return value
    if isinstance(data_type, T.BinaryType):
        return F.encode(value, "ISO-8859-1")
    if isinstance(data_type, T.StructType):
        inner = F.struct(*[_from_json_type(value.getField(f.name), f.dataType).alias(f.name) for f in data_type.fields])
        return F.when(value.isNotNull(), inner)
    if isinstance(data_type, T.ArrayType):
        return F.transform(value, lambda x: _from_json_type(x, data_type.elementType))
    if isinstance(data_type, T.MapType):
        return F.transform_values(value, lambda _, x: _from_json_type(x, data_type.valueType))
    return value


def decode_json(
    messages: DataFrame, schema: T.StructType, payload: str = "payload", strict: bool = True, into: str = "_row"
) -> DataFrame:
    """Add the decoded row and set ``_reject`` where the payload does not fit.

    ``strict`` wants every field present and not null, as decoding under a null-stripped schema does.
    """
    parse_as = T.StructType([*_json_type(schema).fields, T.StructField(_CORRUPT, T.StringType())])
    options = {"mode": "PERMISSIVE", "columnNameOfCorruptRecord": _CORRUPT}
    text = F.col(payload).cast("string")
    out = messages.withColumn("__parsed", F.from_json(text, parse_as, options))
    parsed = F.col("__parsed")
    bad = F.when(F.col(payload).isNull(), NO_PAYLOAD).when(
        parsed.isNull() | parsed.getField(_CORRUPT).isNotNull() | ~text.rlike(r"^\s*\{"), MALFORMED
    )
    if strict:
        filled = F.lit(True)
        for f in schema.fields:
            filled = filled & S.required_filled(parsed.getField(f.name), f.dataType)
        bad = bad.when(~filled, INCOMPLETE)
    known = F.col(REASON) if REASON in messages.columns else F.lit(None).cast("string")
    row = F.struct(*[_from_json_type(parsed.getField(f.name), f.dataType).alias(f.name) for f in schema.fields])
    return out.withColumn(into, row).withColumn(REASON, F.coalesce(known, bad)).drop("__parsed")


def decode_primitive(
    messages: DataFrame, kind: str, field: str = "", payload: str = "payload", into: str = "_row"
) -> DataFrame:
    """Add the wrapped primitive; the id is derived from the message id, so replays of a batch agree."""
    data_type = records.PRIMITIVE_TYPES[kind.upper()]
    known = F.col(REASON) if REASON in messages.columns else F.lit(None).cast("string")
    row = F.struct(
        F.col(payload).cast(data_type).alias(field or records.DEFAULT_FIELD),
        F.sha2(F.col("msg_id").cast("string"), 256).alias("uuid"),
    )
    bad = F.when(F.col(payload).isNull(), NO_PAYLOAD)
    return messages.withColumn(into, row).withColumn(REASON, F.coalesce(known, bad))


def primitive_schema(kind: str, field: str = "") -> T.StructType:
    value = T.BinaryType() if kind.upper() == "BYTES" else T.StringType()
    return T.StructType([
        T.StructField(field or records.DEFAULT_FIELD, value, False), T.StructField("uuid", T.StringType(), False)
    ])


def decode_typed(messages: DataFrame, schema: T.StructType, record: str = "record", into: str = "_row") -> DataFrame:
    """Messages whose value is decoded already, as a struct column: pick the schema's fields by name."""
    known = F.col(REASON) if REASON in messages.columns else F.lit(None).cast("string")
    if record not in messages.columns:
        row = F.struct(*[F.lit(None).cast(f.dataType).alias(f.name) for f in schema.fields])
        return messages.withColumn(into, row).withColumn(REASON, F.coalesce(known, F.lit(NO_PAYLOAD)))
    have = {f.name for f in messages.schema[record].dataType.fields}
    row = F.struct(*[
        (F.col(record).getField(f.name).cast(S.plain_type(f.dataType)) if f.name in have
         else F.lit(None).cast(f.dataType)).alias(f.name)
        for f in schema.fields
    ])
    return messages.withColumn(into, row).withColumn(
        REASON, F.coalesce(known, F.when(F.col(record).isNull(), NO_PAYLOAD))
    )
