"""Texts of an Arrow batch as one byte array, with words, their hashes and word n-grams found by NumPy.

A batch is worked through in chunks of whole texts of about ``CHUNK`` bytes, so memory follows the chunk (or one
very long text), not the batch. Hashes are 64 bits wide.
"""

from __future__ import annotations

import tempfile
import zipfile
from collections.abc import Callable, Iterator
from pathlib import Path

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

CHUNK = 3 << 18
ROWS_PER_BATCH = 1000

_BASE = np.uint64(0x9E3779B97F4A7C15)
_STEP = np.uint64(0xD1342543DE82EF95)
_pow = np.ones(1, np.uint64)
_inv = np.ones(1, np.uint64)


def _powers(n: int) -> tuple[np.ndarray, np.ndarray]:
    """Powers of the hash base and of its inverse modulo 2**64, at least ``n`` of each."""
    global _pow, _inv
    if len(_pow) < n:
        inverse = np.uint64(pow(int(_BASE), -1, 1 << 64))
        size = max(n, 1 << 16)
        _pow = np.cumprod(np.concatenate([np.ones(1, np.uint64), np.full(size, _BASE)]))
        _inv = np.cumprod(np.concatenate([np.ones(1, np.uint64), np.full(size, inverse)]))
    return _pow, _inv


def mix(x: np.ndarray) -> np.ndarray:
    """A bijection of 64-bit values that spreads every bit."""
    x = x ^ (x >> np.uint64(30))
    x = x * np.uint64(0xBF58476D1CE4E5B9)
    x = x ^ (x >> np.uint64(27))
    x = x * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def prefix_hash(data: np.ndarray) -> np.ndarray:
    """``p`` such that ``range_hash`` gives the hash of any slice of ``data``."""
    power, _ = _powers(len(data) + 1)
    p = np.empty(len(data) + 1, np.uint64)
    p[0] = 0
    np.cumsum((data.astype(np.uint64) + np.uint64(1)) * power[: len(data)], out=p[1:])
    return p


def range_hash(p: np.ndarray, start: np.ndarray, end: np.ndarray) -> np.ndarray:
    _, inv = _powers(len(p))
    return (p[end] - p[start]) * inv[start]


def of_array(texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """All UTF-8 bytes and the n + 1 offsets of a string array; null is empty."""
    if texts.null_count:
        texts = texts.fill_null("")
    texts = texts.cast(pa.large_string())
    n = len(texts)
    if n == 0:
        return np.zeros(0, np.uint8), np.zeros(1, np.int64)
    _, offsets, data = texts.buffers()
    at = np.frombuffer(offsets, np.int64)[texts.offset : texts.offset + n + 1]
    raw = np.frombuffer(data, np.uint8)[at[0] : at[-1]] if data is not None and at[-1] > at[0] else np.zeros(0, np.uint8)
    return raw, at - at[0]


class Chunk:
    """Some whole texts: ``data`` has each text followed by one ``gap`` byte; text i is data[start[i]:end[i]]."""

    def __init__(self, raw: np.ndarray, at: np.ndarray, gap: int = 0x20):
        n = len(at) - 1
        self.n = n
        self.start = at[:-1] - at[0] + np.arange(n)
        self.end = at[1:] - at[0] + np.arange(n)
        self.data = np.full(int(at[-1] - at[0]) + n, gap, np.uint8)
        inside = np.ones(len(self.data), bool)
        inside[self.end] = False
        self.data[inside] = raw[at[0] : at[-1]]

    def lower(self) -> None:
        """A-Z become a-z in place."""
        d = self.data
        d[(d >= 65) & (d <= 90)] += 32

    def words(self, is_word: np.ndarray) -> None:
        """Find words by a 256-entry table of word bytes; sets ``ws``, ``we``, ``doc`` and ``first`` (n + 1 offsets)."""
        m = is_word[self.data].view(np.int8)
        edge = np.flatnonzero(np.diff(m, prepend=np.int8(0), append=np.int8(0)))
        self.ws, self.we = edge[0::2], edge[1::2]
        self.first = np.append(np.searchsorted(self.ws, self.start), len(self.ws))
        self.doc = np.repeat(np.arange(self.n), np.diff(self.first))

    def word_hashes(self) -> np.ndarray:
        self.wh = mix(range_hash(prefix_hash(self.data), self.ws, self.we))
        return self.wh

    def ngrams(self, m: int) -> tuple[np.ndarray, np.ndarray]:
        """First word and hash of every run of ``m`` words inside one text, in order."""
        k = len(self.wh) - m + 1
        if k <= 0:
            return np.zeros(0, np.int64), np.zeros(0, np.uint64)
        ok = np.flatnonzero(self.doc[m - 1 :] == self.doc[:k])
        h = np.full(len(ok), np.uint64(m), np.uint64)
        for j in range(m):
            h = h * _STEP + self.wh[ok + j]
        return ok, mix(h)

    def text(self, i: int) -> bytes:
        return self.data[self.start[i] : self.end[i]].tobytes()


def table(excluded: Callable[[int], bool]) -> np.ndarray:
    return np.array([not excluded(b) for b in range(256)])


#: Bytes of words that are split at ASCII white space.
SPACED = table(lambda b: b == 0x20 or 0x09 <= b <= 0x0D)
#: Bytes of words of letters and digits; every byte of a character beyond ASCII counts.
ALNUM = table(lambda b: b <= 0x2F or 0x3A <= b <= 0x60 or 0x7B <= b <= 0x7F)


def chunks(texts: pa.Array, gap: int = 0x20) -> Iterator[tuple[int, int, Chunk]]:
    """(first row, end row, chunk) of whole texts, cut at about CHUNK bytes."""
    raw, at = of_array(texts)
    i, n = 0, len(at) - 1
    while i < n:
        j = max(i + 1, int(np.searchsorted(at, at[i] + CHUNK, "right")) - 1)
        yield i, j, Chunk(raw, at[i : j + 1], gap)
        i = j


def per_text(
    df: DataFrame,
    text: str,
    carry: list[str],
    fields: list[T.StructField],
    results: Callable[[pa.Array], Iterator[list[pa.Array]]],
) -> DataFrame:
    """``carry`` columns as struct ``doc`` beside a struct ``out`` of ``fields``, one row per input row.

    ``results`` gets the texts of a batch and gives the fields' arrays for its chunks, in order. The structs keep
    column names of ``df`` and of ``fields`` apart.
    """
    src = df.select(F.struct(*[F.col(f"`{c}`") for c in carry]).alias("doc"), F.col(f"`{text}`").alias("text"))
    names = [f.name for f in fields]
    out_type = T.StructType(fields)
    schema = T.StructType([src.schema["doc"], T.StructField("out", out_type, False)])

    def run(batches):
        for batch in batches:
            texts = batch.column(1)
            at = 0
            for arrays in results(texts):
                rows = len(arrays[0])
                out = pa.StructArray.from_arrays(arrays, names=names)
                yield pa.RecordBatch.from_arrays([batch.column(0).slice(at, rows), out], names=["doc", "out"])
                at += rows

    return small_batches(src).mapInArrow(run, schema)


def small_batches(df: DataFrame) -> DataFrame:
    """Set how many rows go to Python at once (texts are long, so fewer than Spark's default) and ship this package."""
    spark = df.sparkSession
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", str(ROWS_PER_BATCH))
    ship(spark)
    return df


def ship(spark: SparkSession) -> None:
    """Send this package to the executors once per application, as ``--py-files`` would."""
    sc = spark.sparkContext
    if sc.applicationId in _shipped:
        return
    root = Path(__file__).resolve().parents[1]
    archive = Path(tempfile.mkdtemp()) / f"{root.name}.zip"
    with zipfile.ZipFile(archive, "w") as z:
        for f in sorted(root.rglob("*.py")):
            z.write(f, f.relative_to(root.parent))
    sc.addPyFile(str(archive))
    _shipped.add(sc.applicationId)


_shipped: set[str] = set()
