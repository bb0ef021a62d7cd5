"""The few file-system calls the table log needs, through Hadoop's file API so that any scheme works."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import DataFrame, DataFrameReader, SparkSession
from pyspark.sql import functions as F


class VersionConflict(RuntimeError):
    """The version file to publish exists already."""


#: File-system options by table: (application, path) -> options. The session's own settings are never changed.
_options: dict[tuple[str, str], dict[str, str]] = {}
_systems: dict[tuple, object] = {}
#: Java classes by JVM and name. Finding one by its full name takes a call to the JVM per part of the name.
_classes: dict[tuple, object] = {}


def configure(spark: SparkSession, path: str, options: Mapping[str, str]) -> None:
    """Use file-system options for everything under a path, in this application. Empty options change nothing."""
    if options:
        _movers.clear()
        _options[spark.sparkContext.applicationId, path.rstrip("/")] = dict(options)


def options_of(spark: SparkSession, path: str) -> dict[str, str]:
    """The options of the nearest configured folder."""
    app, at = spark.sparkContext.applicationId, path.rstrip("/")
    while at:
        if (app, at) in _options:
            return _options[app, at]
        at = at.rpartition("/")[0]
    return {}


def reader(spark: SparkSession, path: str) -> DataFrameReader:
    """A reader whose scans open files with the options of a path."""
    return spark.read.options(**options_of(spark, path))


def _hadoop(spark: SparkSession, name: str):
    key = (spark._jvm, name)
    if key not in _classes:
        _classes[key] = getattr(spark._jvm.org.apache.hadoop.fs, name)
    return _classes[key]


def _conf(spark: SparkSession, path: str = ""):
    conf = spark._jsparkSession.sessionState().newHadoopConf()
    for k, v in options_of(spark, path).items():
        conf.set(k, v)
    return conf


def _system(spark: SparkSession, path: str):
    """The file system of a path. Hadoop keeps one per scheme and host whatever the settings, so a path with options of its
    own gets one of its own."""
    p, own = _path(spark, path), options_of(spark, path)
    if not own:
        return p.getFileSystem(_conf(spark))
    uri = p.toUri()
    key = (spark.sparkContext.applicationId, uri.getScheme(), uri.getAuthority(), tuple(sorted(own.items())))
    if key not in _systems:
        conf = _conf(spark, path)
        files = _hadoop(spark, "FileSystem")
        _systems[key] = files.newInstance(uri if uri.getScheme() else files.getDefaultUri(conf), conf)
    return _systems[key]


def _path(spark: SparkSession, path: str):
    return _hadoop(spark, "Path")(path)


def root_uri(spark: SparkSession, path: str) -> str:
    """The table root as the ``_metadata.file_path`` column spells it."""
    p = _path(spark, path)
    uri = _system(spark, path).makeQualified(p).toUri().toString().rstrip("/")
    return "file:/" + uri[len("file:"):].lstrip("/") if uri.startswith("file:") else uri


def exists(spark: SparkSession, path: str) -> bool:
    return _system(spark, path).exists(_path(spark, path))


def mkdirs(spark: SparkSession, path: str) -> None:
    _system(spark, path).mkdirs(_path(spark, path))


def delete(spark: SparkSession, path: str) -> None:
    """Delete a folder with all it holds."""
    _system(spark, path).delete(_path(spark, path), True)


def folders(spark: SparkSession, path: str) -> list[str]:
    """Names of the folders below one folder; none where there is no such folder."""
    p, fs = _path(spark, path), _system(spark, path)
    return sorted(s.getPath().getName() for s in fs.listStatus(p) if s.isDirectory()) if fs.exists(p) else []


def among(spark: SparkSession, paths: Sequence[str]) -> set[str]:
    """Which of some paths of one file system exist."""
    if not paths:
        return set()
    fs, new_path = _system(spark, paths[0]), _hadoop(spark, "Path")
    return {p for p in paths if fs.exists(new_path(p))}


def any_like(spark: SparkSession, path: str, start: str) -> bool:
    """Whether a folder holds something whose name starts so; one call, however much it holds."""
    return bool(len(_system(spark, path).globStatus(_path(spark, f"{glob_safe(path.rstrip('/'))}/{start}*")) or ()))


def part_files(spark: SparkSession, path: str, column: str) -> DataFrame:
    """(value, name) of the part files Spark wrote below ``path`` into folders ``column=value``, from the listing alone."""
    listed = reader(spark, path).format("binaryFile").option("recursiveFileLookup", "true").option("pathGlobFilter", "part-*")
    parts = F.split("path", "/")
    return listed.load(glob_safe(path)).select(
        F.substring_index(F.element_at(parts, -2), f"{column}=", -1).alias("value"), F.element_at(parts, -1).alias("name")
    )


class _Mover:
    """Moves files into one folder, to new names only. The file system and its settings are looked up once.

    On the local file system Hadoop's rename without overwriting is a look and a rename, with some processes started on the
    way; here it is the same two steps without them. Other file systems rename in one step of their own.
    """

    def __init__(self, spark: SparkSession, folder: str):
        self.new_path = _hadoop(spark, "Path")
        self.fs = _system(spark, folder)
        to = self.fs.makeQualified(self.new_path(folder))
        self.folder = to.toString()
        self.local = to.toUri().getScheme() == "file"
        self.context = _hadoop(spark, "FileContext").getFileContext(to.toUri(), _conf(spark, folder))
        self.no_options = spark.sparkContext._gateway.new_array(spark._jvm.org.apache.hadoop.fs.Options.Rename, 0)

    def move(self, src: str, name: str, mtime_ms: int) -> None:
        s, d = self.new_path(src), self.new_path(f"{self.folder}/{name}")
        self.fs.setTimes(s, mtime_ms, -1)
        if self.local:
            if self.fs.exists(d):
                raise VersionConflict(f"version file exists: {self.folder}/{name}")
            if not self.fs.rename(s, d):
                raise OSError(f"cannot move {src} to {self.folder}/{name}")
            return
        try:
            self.context.rename(self.fs.makeQualified(s), d, self.no_options)
        except Exception as e:
            if self.fs.exists(d) and self.fs.exists(s):
                raise VersionConflict(f"version file exists: {self.folder}/{name}") from e
            raise


#: The mover of the folder last published to.
_movers: dict[tuple, _Mover] = {}


def move_new(spark: SparkSession, src: str, dst: str, mtime_ms: int) -> None:
    """Move ``src`` to ``dst``; raise VersionConflict when ``dst`` exists.

    The modification time is set first, so that files published in one go keep their order for readers that
    list by time.
    """
    folder, _, name = dst.rpartition("/")
    key = (spark.sparkContext, folder)
    if key not in _movers:
        _movers.clear()
        _movers[key] = _Mover(spark, folder)
    _movers[key].move(src, name, mtime_ms)


# ASCII characters java.net.URI quotes inside a path, besides '%' itself and control characters.
URI_QUOTED = ' "<>#?[\\]^`{|}'


def disk_path(log_path: str) -> str:
    """SQL for the name on disk of a path as the log stores it (URI-quoted)."""
    return f"coalesce(try_url_decode(replace({log_path}, '+', '%2B')), {log_path})"


def quoted_path(path: str) -> str:
    """SQL for a name on disk, quoted the way ``_metadata.file_path`` shows it."""
    out = f"replace({path}, '%', '%25')"
    for ch in URI_QUOTED:
        shown = {"\\": "\\\\"}.get(ch, ch)
        out = f"replace({out}, '{shown}', '%{ord(ch):02X}')"
    return out


def glob_safe(path: str) -> str:
    """Backslash-escape what a Spark reader would take for a file pattern."""
    return "".join("\\" + c if c in "\\{}[]*?" else c for c in path)
