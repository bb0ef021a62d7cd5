"""Tables by name: the session catalog keeps a name, the columns and where the table is.

An entry is an external table over an empty folder beside the log, with the real location as a property: Spark's own
readers would take every file on disk for a row source, published or not, so rows are read through ``read``. Only the
session catalog is used; what it is made of, and how long it lives, is the session's affair.
"""

from __future__ import annotations

from collections.abc import Mapping
from dataclasses import replace

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T

from tableflow.functions import schema as S
from tableflow.options import CatalogTable, IngestOptions
from tableflow.plans.ingest import IngestResult, ingest_batch
from tableflow.sources import log as L
from tableflow.sources import snapshot as SN

LOCATION = "tableflow.location"
NAMES_DIR = "_catalog_entry"


class UnknownTable(RuntimeError):
    """No table of this name is registered."""


def _quoted(name: str) -> str:
    return ".".join(f"`{p.replace('`', '``')}`" for p in name.split("."))


def _text(value: str) -> str:
    return "'" + value.replace("\\", "\\\\").replace("'", "\\'") + "'"


def resolve(spark: SparkSession, name: str) -> str:
    """The path of a registered table."""
    try:
        rows = spark.sql(f"SHOW TBLPROPERTIES {_quoted(name)} ({_text(LOCATION)})").collect()
    except AnalysisException as e:
        raise UnknownTable(name) from e
    found = [r.value for r in rows if r.key == LOCATION and "does not have property" not in r.value]
    if not found:
        raise UnknownTable(f"{name} is a table of another kind")
    return found[0]


def register(spark: SparkSession, name: str, path: str) -> None:
    """Register a table under ``namespace.name`` (or a name in the current namespace), or bring its columns up to date."""
    path = path.rstrip("/")
    schema = S.plain_type(L.epochs(spark, path)[-1].schema) if L.table_exists(spark, path) else T.StructType([])
    try:
        if resolve(spark, name) != path:
            raise ValueError(f"{name} is registered at {resolve(spark, name)}")
        spark.sql(f"DROP TABLE {_quoted(name)}")  # the entry; an external table's files stay
    except UnknownTable as e:
        if spark.catalog.tableExists(name):
            raise ValueError(str(e)) from e
    namespace = name.rpartition(".")[0]
    if namespace:
        spark.sql(f"CREATE NAMESPACE IF NOT EXISTS {_quoted(namespace)} LOCATION {_text(f'{path}/{NAMES_DIR}')}")
    columns = ", ".join(f"{_quoted_column(f.name)} {f.dataType.simpleString()}" for f in schema.fields)
    spark.sql(
        f"CREATE TABLE {_quoted(name)} {f'({columns})' if columns else ''} USING {'parquet' if columns else 'text'} "
        f"LOCATION {_text(f'{path}/{NAMES_DIR}/entry')} TBLPROPERTIES ({_text(LOCATION)} = {_text(path)})"
    )


def _quoted_column(name: str) -> str:
    return f"`{name.replace('`', '``')}`"


def read(spark: SparkSession, name: str, **kw) -> DataFrame:
    """A registered table as ``snapshot`` gives it."""
    return SN.snapshot(spark, resolve(spark, name), **kw)


def ingest(messages: DataFrame, name: str, options: IngestOptions | None = None, batch_id: int | None = None, **kw) -> IngestResult:
    """Ingest into a registered table; its entry follows schema changes. ``options`` say all but the path."""
    spark = messages.sparkSession
    path = resolve(spark, name)
    options = replace(options, table_path=path) if options else IngestOptions(table_path=path)
    before = L.table_state(spark, path).history[-1:]
    done = ingest_batch(messages, options, batch_id, **kw)
    if L.table_state(spark, path).history[-1:] != before:
        register(spark, name, path)
    return done


def create(spark: SparkSession, raw: Mapping[str, object]) -> tuple[str, IngestOptions]:
    """Register the table that catalog options name, at the place their warehouse gives it; (name, ingest options)."""
    table, options = CatalogTable.load(raw), IngestOptions.load(raw)
    if "." in table.namespace:
        raise ValueError("the session catalog has one level of namespaces")
    name = f"{table.namespace}.{table.name}"
    register(spark, name, options.table_path)
    return name, options
