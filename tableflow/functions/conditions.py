"""Conditions on columns, as a filter on rows and as a filter on files by the statistics that the log keeps of them.

A condition is ``(column, op, value)`` with op ``=``, ``<``, ``<=``, ``>``, ``>=``, ``in``, ``is null`` or ``is not null``; all
conditions of a list must hold. A file is left out only if its statistics show that no row can match: statistics that are
absent, cannot be read or belong to another type keep it.
"""

from __future__ import annotations

import datetime as dt
import decimal
import math
from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql import types as T

Condition = tuple

#: Characters of a text bound; a cut upper bound ends in the last code point, so that it stays above what it stands for.
TEXT_BOUND = 32
_LAST = "\U0010ffff"
_TIMES = {"timestampFormat": "yyyy-MM-dd'T'HH:mm:ss.SSSSSSXXX", "timestampNTZFormat": "yyyy-MM-dd'T'HH:mm:ss.SSSSSS"}

_COMPARE = {
    "=": lambda c, v: c == v, "<": lambda c, v: c < v, "<=": lambda c, v: c <= v, ">": lambda c, v: c > v, ">=": lambda c, v: c >= v,
    "in": lambda c, v: c.isin(list(v)),
}


class BadCondition(ValueError):
    """A condition with an unknown operator or column."""


def _parts(condition: Condition) -> tuple[str, str, object]:
    column, op, value = (*condition, None)[:3]
    op = " ".join(str(op).lower().split())
    if op not in _COMPARE and op not in ("is null", "is not null"):
        raise BadCondition(f"unknown operator in {condition!r}")
    return column, op, value


def row_filter(conditions: Sequence[Condition]) -> Column:
    """The conditions as a filter on rows."""
    out = F.lit(True)
    for condition in conditions:
        column, op, value = _parts(condition)
        c = F.col(f"`{column}`")
        out = out & (c.isNull() if op == "is null" else c.isNotNull() if op == "is not null" else _COMPARE[op](c, value))
    return out


# ---- statistics ----------------------------------------------------------------------------------------------------


def has_bounds(data_type: T.DataType) -> bool:
    return isinstance(data_type, (T.NumericType, T.StringType, T.DateType, T.TimestampType, T.TimestampNTZType))


def bounds(column: Column, data_type: T.DataType) -> tuple[Column, Column]:
    """Aggregates for the least and greatest value; null where there is no bound that can be kept."""
    if isinstance(data_type, T.StringType):
        top = F.max(F.left(column, F.lit(TEXT_BOUND + 1)))
        cut = F.when(F.substr(top, F.lit(TEXT_BOUND + 1)) < _LAST, F.concat(F.left(top, F.lit(TEXT_BOUND)), F.lit(_LAST)))
        return F.min(F.left(column, F.lit(TEXT_BOUND))), F.when(F.char_length(top) <= TEXT_BOUND, top).otherwise(cut)
    low, high = F.min(column), F.max(column)
    if isinstance(data_type, (T.FloatType, T.DoubleType)):  # NaN is above all numbers and has no JSON form
        def number(x: Column) -> Column:
            return F.when(~F.isnan(x) & (F.abs(x) < float("inf")), x)

        return number(low), number(high)
    return low, high


def stats_json(num_records: Column, columns: dict[str, tuple[Column, Column, Column]]) -> Column:
    """The log's statistics text from (least, greatest, nulls) by file column."""
    def struct(i: int) -> Column:
        return F.struct(*[v[i].alias(n) for n, v in columns.items()])

    parts = [num_records.alias("numRecords")]
    if columns:
        parts += [struct(0).alias("minValues"), struct(1).alias("maxValues"), struct(2).alias("nullCount")]
    return F.to_json(F.struct(*parts), _TIMES)


def _comparable(data_type: T.DataType, value: object) -> bool:
    """Whether bounds of a type and a value compare as rows do; a text against a number, say, would not."""
    if isinstance(value, bool) or value is None:
        return False
    if isinstance(data_type, T.NumericType):
        return isinstance(value, (int, decimal.Decimal)) or isinstance(value, float) and math.isfinite(value)
    if isinstance(data_type, T.StringType):
        return isinstance(value, str)
    if isinstance(data_type, T.DateType):
        return isinstance(value, dt.date) and not isinstance(value, dt.datetime)
    return isinstance(value, dt.datetime)


def may_match(conditions: Sequence[Condition], fields: dict[str, tuple[str, T.DataType]], partitions: dict[str, T.DataType]) -> Column:
    """A filter on file actions (``stats``, ``pv``): whether a file may hold matching rows.

    ``fields`` gives file column and type of the columns whose statistics can be trusted, ``partitions`` the types of
    the partition columns. Conditions on other columns say nothing.
    """
    known = [c for c in {_parts(x)[0] for x in conditions} if c in fields]
    texts = T.StructType([T.StructField(fields[c][0], T.StringType()) for c in known])
    counts = T.StructType([T.StructField(fields[c][0], T.LongType()) for c in known])
    schema = T.StructType([
        T.StructField("numRecords", T.LongType()), T.StructField("minValues", texts), T.StructField("maxValues", texts),
        T.StructField("nullCount", counts),
    ])
    stats = F.from_json("stats", schema)
    tests = []
    for condition in conditions:
        column, op, value = _parts(condition)
        if column in partitions:
            logged = F.try_element_at("pv", F.lit(column))
            low = high = logged.try_cast(partitions[column])
            has = F.map_contains_key("pv", F.lit(column))
            nulls, rows = F.when(has, F.when(logged.isNull(), 1).otherwise(0)), F.lit(1)
            data_type = partitions[column]
        elif column in fields:
            name, data_type = fields[column]
            low = stats["minValues"][name].try_cast(data_type)
            high = stats["maxValues"][name].try_cast(data_type)
            if isinstance(data_type, (T.TimestampType, T.TimestampNTZType)):  # other writers cut bounds to milliseconds
                high = high + F.expr("interval 1 millisecond")
            nulls, rows = stats["nullCount"][name], stats["numRecords"]
        else:
            continue
        if op == "is null":
            tests.append(F.coalesce(nulls > 0, F.lit(True)))
            continue
        some = F.coalesce(nulls < rows, F.lit(True))  # a value that is not null
        if op == "is not null":
            tests.append(some)
            continue
        values = list(value) if op == "in" else [value]
        if any(v is None for v in values):
            values = [v for v in values if v is not None]  # no row equals null
            if not values:
                tests.append(F.lit(False))
                continue
        if not all(_comparable(data_type, v) for v in values):
            tests.append(some)
            continue
        if op in ("=", "in"):
            hit = reduce(lambda a, b: a | b, [F.coalesce(low <= F.lit(v), F.lit(True)) & F.coalesce(high >= F.lit(v), F.lit(True)) for v in values], F.lit(False))
        else:
            hit = F.coalesce(_COMPARE[op](low if op in ("<", "<=") else high, F.lit(value)), F.lit(True))
        tests.append(some & hit)
    return reduce(lambda a, b: a & b, tests, F.lit(True))
