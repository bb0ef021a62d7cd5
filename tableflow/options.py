"""Options of the change feed and of ingestion, with their defaults and checks."""

from __future__ import annotations

import datetime as dt
import warnings
from collections.abc import Mapping
from dataclasses import dataclass, field, fields

LATEST, EARLIEST = -1, -2

# Option defaults.
CHECKPOINT_INTERVAL_S = 30
MAX_READ_ROWS = 100_000
MAX_READ_BYTES = 1 << 30
COMMIT_INTERVAL_S = 120
RECORDS_PER_COMMIT = 10_000_000
COMMIT_FAILURES = 5
TARGET_FILE_BYTES = 128 << 20
CODECS = ("uncompressed", "snappy", "gzip", "lzo", "brotli", "lz4", "zstd")
LAYOUTS = {"delta": "append", "iceberg": "evolving", "hudi": "keyed"}
CATALOGS = ("hadoopCatalog", "hiveCatalog")


class OptionError(ValueError):
    """An option is missing, unknown or contradicts another."""


def _positive(obj, name: str, default: int) -> None:
    if getattr(obj, name) <= 0:
        warnings.warn(f"{name} should be > 0, using {default}", stacklevel=4)
        setattr(obj, name, default)


def _hadoop_options(options: Mapping[str, object]) -> dict[str, str]:
    return {k[len("hadoop."):]: str(v) for k, v in options.items() if k.startswith("hadoop.")}


def _known(cls, raw: Mapping[str, object], names: Mapping[str, str]) -> dict[str, object]:
    return {names[k]: v for k, v in raw.items() if k in names and names[k] in {f.name for f in fields(cls)}}


@dataclass
class FeedOptions:
    """What to read from a table's history, and from where."""

    table_path: str = ""
    checkpoint_interval_s: int = CHECKPOINT_INTERVAL_S
    fetch_history: bool = False
    start_version: int | None = None
    start_timestamp: dt.datetime | int | None = None
    max_read_bytes: int = MAX_READ_BYTES
    max_read_rows: int = MAX_READ_ROWS
    #: Whether a read round is held to the two limits. They are meant for readers that hold a round in memory; Spark
    #: splits and spills what it reads, so the limits count only where they were asked for: by name, or by another value.
    limit_rounds: bool | None = None
    n_slots: int = 0
    include_rewrites: bool = True
    storage: dict[str, str] = field(default_factory=dict)

    NAMES = {
        "tablePath": "table_path",
        "checkpointInterval": "checkpoint_interval_s",
        "fetchHistoryData": "fetch_history",
        "startSnapshotVersion": "start_version",
        "startTimestamp": "start_timestamp",
        "maxReadBytesSizeOneRound": "max_read_bytes",
        "maxReadRowCountOneRound": "max_read_rows",
    }

    def __post_init__(self):
        if self.start_version is not None and self.start_timestamp is not None:
            raise OptionError("give a start version or a start timestamp, not both")
        if self.start_version is None and self.start_timestamp is None:
            self.start_version = LATEST
        if not self.table_path.strip():
            raise OptionError("table_path must be set")
        _positive(self, "max_read_bytes", MAX_READ_BYTES)
        _positive(self, "max_read_rows", MAX_READ_ROWS)
        if self.limit_rounds is None:
            self.limit_rounds = (self.max_read_bytes, self.max_read_rows) != (MAX_READ_BYTES, MAX_READ_ROWS)

    @property
    def periodic_checkpoint(self) -> bool:
        return self.checkpoint_interval_s > 0

    @staticmethod
    def load(raw: Mapping[str, object]) -> FeedOptions:
        """Options from a name/value map; ``type`` must be ``delta``, ``hadoop.*`` goes to the file system."""
        kind = raw.get("type")
        if not str(kind or "").strip():
            raise OptionError("type must be set")
        if kind != "delta":
            raise OptionError(f"only 'delta' tables have a change feed, not {kind!r}")
        given = _known(FeedOptions, raw, FeedOptions.NAMES)
        limited = True if {"max_read_bytes", "max_read_rows"} & set(given) else None
        return FeedOptions(**given, limit_rounds=limited, storage=_hadoop_options(raw))


@dataclass
class IngestOptions:
    """How messages become table rows."""

    layout: str = "append"
    table_path: str = ""
    partition_columns: list[str] = field(default_factory=list)
    commit_interval_s: int = COMMIT_INTERVAL_S
    records_per_commit: int = RECORDS_PER_COMMIT
    commit_failures: int = COMMIT_FAILURES
    field_name: str = ""
    compression: str = "snappy"
    records_per_file: int = 0
    target_file_bytes: int = TARGET_FILE_BYTES
    stats_columns: list[str] = field(default_factory=list)
    app_id: str = "tableflow-ingest"
    record_key: str = ""
    partition_path: str = ""
    fail_fast: bool = False
    bytes_as_string: bool = False
    storage: dict[str, str] = field(default_factory=dict)

    NAMES = {
        "tablePath": "table_path",
        "partitionColumns": "partition_columns",
        "maxCommitInterval": "commit_interval_s",
        "maxRecordsPerCommit": "records_per_commit",
        "maxCommitFailedTimes": "commit_failures",
        "overrideFieldName": "field_name",
        "compression": "compression",
        "appId": "app_id",
        "hoodie.base.path": "table_path",
        "hoodie.datasource.write.recordkey.field": "record_key",
        "hoodie.datasource.write.partitionpath.field": "partition_path",
    }

    def __post_init__(self):
        if self.layout not in set(LAYOUTS.values()):
            raise OptionError(f"layout must be one of {sorted(LAYOUTS.values())}, not {self.layout!r}")
        if not self.table_path.strip():
            raise OptionError("table_path must be set")
        if self.layout == "keyed":
            if not self.record_key.strip():
                raise OptionError("the keyed layout needs record_key")
            self.partition_columns = []
        _positive(self, "commit_interval_s", COMMIT_INTERVAL_S)
        _positive(self, "records_per_commit", RECORDS_PER_COMMIT)
        _positive(self, "target_file_bytes", TARGET_FILE_BYTES)
        if self.compression.lower() not in CODECS:
            warnings.warn(f"unknown compression {self.compression!r}, using snappy", stacklevel=3)
            self.compression = "snappy"
        self.compression = self.compression.lower()

    @staticmethod
    def load(raw: Mapping[str, object]) -> IngestOptions:
        """Options from a name/value map; ``type`` picks the layout."""
        kind = str(raw.get("type") or "").strip().lower()
        if not kind:
            raise OptionError("type must be set")
        if kind not in LAYOUTS:
            raise OptionError(f"type must be one of {sorted(LAYOUTS)}, not {kind!r}")
        given = _known(IngestOptions, raw, IngestOptions.NAMES)
        if kind == "iceberg":
            given["table_path"] = CatalogTable.load(raw).location
        return IngestOptions(layout=LAYOUTS[kind], storage=_hadoop_options(raw), **given)


@dataclass
class CatalogTable:
    """A table named by catalog, namespace and name instead of by path."""

    namespace: str
    name: str
    warehouse: str
    catalog: str = "hadoopCatalog"
    properties: dict[str, str] = field(default_factory=dict)

    def __post_init__(self):
        if not (self.namespace or "").strip() or not (self.name or "").strip():
            raise OptionError("tableNamespace and tableName must be set")
        if not (self.warehouse or "").strip():
            raise OptionError("warehouse must be set")
        if self.catalog not in CATALOGS:
            raise OptionError(f"catalog must be one of {CATALOGS}, not {self.catalog!r}")
        if self.properties.get("write.format.default", "parquet").lower() != "parquet":
            raise OptionError("only Parquet tables are written")

    @property
    def location(self) -> str:
        base = self.warehouse.rstrip("/")
        if self.catalog == "hiveCatalog":
            return f"{base}/{self.namespace}.db/{self.name}"
        return f"{base}/{self.namespace.replace('.', '/')}/{self.name}"

    @staticmethod
    def load(raw: Mapping[str, object]) -> CatalogTable:
        catalog = raw.get("catalogProperties")
        if not isinstance(catalog, Mapping):
            raise OptionError("catalogProperties must be set")
        return CatalogTable(
            str(raw.get("tableNamespace") or ""), str(raw.get("tableName") or ""), str(catalog.get("warehouse") or ""),
            str(catalog.get("catalog-impl") or "hadoopCatalog"), dict(raw.get("tableProperties") or {}),
        )
