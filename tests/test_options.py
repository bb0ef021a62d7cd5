import warnings

import pytest

from tableflow import options as O


def test_feed_defaults_and_checks():
    o = O.FeedOptions("/t")
    assert (o.checkpoint_interval_s, o.fetch_history, o.start_version, o.max_read_rows) == (30, False, O.LATEST, 100_000)
    with pytest.raises(O.OptionError):
        O.FeedOptions("/t", start_version=1, start_timestamp=5)
    for blank in ("", "  "):
        with pytest.raises(O.OptionError):
            O.FeedOptions(blank)
    with pytest.warns(UserWarning):
        assert O.FeedOptions("/t", max_read_rows=0, max_read_bytes=-1).max_read_rows == 100_000
    assert not O.FeedOptions("/t", checkpoint_interval_s=0).periodic_checkpoint
    assert O.FeedOptions("/t", start_timestamp=5).start_version is None


def test_feed_load():
    o = O.FeedOptions.load({"type": "delta", "tablePath": "/t", "fetchHistoryData": True, "startSnapshotVersion": 3,
                            "queueSize": 5, "hadoop.fs.x": "1"})
    assert (o.table_path, o.fetch_history, o.start_version, o.storage) == ("/t", True, 3, {"fs.x": "1"})
    for bad in ({}, {"type": " "}, {"type": "hudi", "tablePath": "/t"}):
        with pytest.raises(O.OptionError):
            O.FeedOptions.load(bad)


def test_ingest_defaults_and_checks():
    o = O.IngestOptions(table_path="/t")
    assert (o.commit_interval_s, o.records_per_commit, o.commit_failures) == (120, 10_000_000, 5)
    assert (o.partition_columns, o.field_name, o.compression) == ([], "", "snappy")
    with pytest.warns(UserWarning):
        o = O.IngestOptions(table_path="/t", commit_interval_s=0, records_per_commit=-1, compression="odd")
    assert (o.commit_interval_s, o.records_per_commit, o.compression) == (120, 10_000_000, "snappy")
    with warnings.catch_warnings():
        warnings.simplefilter("error")
        assert O.IngestOptions(table_path="/t", compression="GZIP").compression == "gzip"
    for bad in (dict(layout="x", table_path="/t"), dict(), dict(layout="keyed", table_path="/t")):
        with pytest.raises(O.OptionError):
            O.IngestOptions(**bad)


def test_ingest_load():
    o = O.IngestOptions.load({"type": "DELTA", "tablePath": "/t", "partitionColumns": ["a"], "maxRecordsPerCommit": 7})
    assert (o.layout, o.table_path, o.partition_columns, o.records_per_commit) == ("append", "/t", ["a"], 7)
    k = O.IngestOptions.load({"type": "hudi", "hoodie.base.path": "/h", "partitionColumns": ["a"],
                              "hoodie.datasource.write.recordkey.field": "id",
                              "hoodie.datasource.write.partitionpath.field": "id"})
    assert (k.layout, k.record_key, k.partition_path, k.partition_columns) == ("keyed", "id", "id", [])
    for bad in ({}, {"type": "orc", "tablePath": "/t"}):
        with pytest.raises(O.OptionError):
            O.IngestOptions.load(bad)


def test_catalog_table():
    raw = {"type": "iceberg", "tableNamespace": "a.b", "tableName": "t", "catalogProperties": {"warehouse": "/w/"}}
    assert O.IngestOptions.load(raw).table_path == "/w/a/b/t"
    hive = O.CatalogTable("ns", "t", "/w", "hiveCatalog")
    assert hive.location == "/w/ns.db/t"
    for change in ({"tableName": " "}, {"tableNamespace": None}, {"catalogProperties": None}, {"catalogProperties": {}},
                   {"catalogProperties": {"warehouse": "/w", "catalog-impl": "x"}}):
        with pytest.raises(O.OptionError):
            O.IngestOptions.load({**raw, **change})
