"""Partition strings, paths and value maps."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def partition_string(values: Column) -> Column:
    """``a=1,b=2`` with keys in name order; ``''`` for an empty or null map; a null value prints ``null``."""
    parts = F.transform(
        F.array_sort(F.map_entries(values)),
        lambda e: F.concat(e["key"], F.lit("="), F.coalesce(e["value"], F.lit("null"))),
    )
    return F.coalesce(F.array_join(parts, ","), F.lit(""))


def _text(name: str) -> Column:
    return F.coalesce(F.col(name).cast("string"), F.lit("null"))


def partition_path(df: DataFrame, columns: Sequence[str]) -> Column:
    """``a=1/b=2`` in the given order; ``''`` without columns or when the frame lacks one of them."""
    if not columns or any(c not in df.columns for c in columns):
        return F.lit("")
    return F.concat_ws("/", *[F.concat(F.lit(f"{c}="), _text(c)) for c in columns])


def partition_values(df: DataFrame, columns: Sequence[str]) -> Column:
    """Map of column name to value text; columns the frame lacks are left out."""
    present = [c for c in columns if c in df.columns]
    if not present:
        return F.create_map().cast("map<string,string>")
    return F.create_map(*[x for c in present for x in (F.lit(c), _text(c))])


# Fixed value: the folder text of an empty text. Folder names have one text for null and none for the empty one.
EMPTY_TEXT = "__EMPTY_TEXT__"


def folder_text(value: Column) -> Column:
    """A text as a partition folder holds it, so that empty, null and any other text stay apart."""
    return F.when(value == "", EMPTY_TEXT).when(value.startswith(EMPTY_TEXT), F.concat(value, F.lit("_"))).otherwise(value)


def from_folder(text: Column) -> Column:
    """The value of a folder text; reads still prune folders by it."""
    longer = text.startswith(EMPTY_TEXT)
    return F.when(text == EMPTY_TEXT, "").when(longer, F.left(text, F.length(text) - 1)).otherwise(text)
