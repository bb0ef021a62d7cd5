"""Removal of repeated byte strings by a distributed, common-prefix-aware merge sort of suffixes.

A byte goes if a string of ``LENGTH`` bytes that covers it starts anywhere else too. Sorting the suffixes at all positions
is not needed: every such string has an anchor, the least hash of ``GRAM`` bytes in its first ``REACH`` bytes, so equal
strings have equal anchors at equal places. An anchor stands for the strings that chose it (neighbours, since the choice
moves forward only), and its context is the text from the first of them to the end of the last.

1. Every anchor has fingerprints: of the ``PREFIX`` bytes after it, which equal strings share, and of its context. A prefix
   that occurs once cannot be in a repeated string, and goes no further. Equal contexts are one suffix with a count,
   so a passage in a third of all texts is sorted once.
2. A suffix is the text after the anchor, then the context before it backwards. Tasks sort their suffixes, cut the runs at
   splitters (a sample's quantiles) and send each piece front-coded: a string is its common prefix with the string before
   it, as a length, and the rest.
3. Each range merges its runs with a loser tree. Nodes hold the common prefix with the last winner, so strings
   are compared from there on, and mostly not at all. The merge gives each string's common prefix with its neighbour.
4. Neighbours that share ``PREFIX`` bytes are a group. All strings of a group's contexts are compared by 64-bit
   rolling hashes, whole group at once; those that occur twice, or once in a context that counts twice, are repeated.
   A group that a splitter may have cut sends its strings' hashes on, to be counted across ranges.
5. Repeated strings go back to the texts that have their contexts, and their bytes are removed.

Nothing is capped: a group of any size is split by splitters, and its parts meet as sums.

Edge cases: null is empty text; texts under ``LENGTH`` bytes lose nothing; repeated rows lose all bytes if long enough;
an empty table gives an empty result; extra columns stay in a struct.
"""

from __future__ import annotations

import hashlib
from bisect import bisect_left
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import zstandard
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tableflow.llm import texts as X
from tableflow.session import pinned

LENGTH = 400
GRAM = 16
REACH = 320
#: Every string has at least so many bytes from its anchor on.
PREFIX = LENGTH - (REACH - GRAM)
SAMPLE = 20_000
RANGE_BYTES = 24 << 20
RUN_BYTES = 32 << 20
_TILE = 1 << 22
_POSITION = np.uint64((1 << 24) - 1)

ANCHOR_FIELDS = [
    T.StructField(n, T.ArrayType(t))
    for n, t in (
        ("prefix", T.LongType()), ("f1", T.LongType()), ("f2", T.LongType()), ("lo", T.LongType()), ("back", T.IntegerType()),
        ("more", T.IntegerType()), ("sample", T.BinaryType()),
    )
]


def _least(key: np.ndarray, width: int) -> np.ndarray:
    """Least of every ``width`` neighbours."""
    done, m = 1, key
    while done * 2 <= width:
        m = np.minimum(m[:-done], m[done:])
        done *= 2
    rest = width - done
    return np.minimum(m[: len(m) - rest], m[rest:]) if rest else m


def anchors(c: X.Chunk, p: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Text number, anchor, and the first and last start of the strings that chose it, in order."""
    n = len(c.data)
    room = c.end - c.start - LENGTH + 1
    long = np.flatnonzero(room > 0)
    if not len(long):
        none = np.zeros(0, np.int64)
        return none, none, none, none
    edge = np.zeros(n + 1, np.int8)
    edge[c.start[long]] += 1
    edge[c.start[long] + room[long]] -= 1
    valid = np.cumsum(edge[:n], dtype=np.int8) > 0
    _, inv = X._powers(n + 1)
    chosen = []
    for t in range(0, n - LENGTH + 1, _TILE):
        end = min(t + _TILE, n - LENGTH + 1)
        at = np.arange(t, end + REACH - GRAM)
        gram = X.mix((p[at + GRAM] - p[at]) * inv[at])
        low = _least((gram & ~_POSITION) | (at - t).astype(np.uint64), REACH - GRAM + 1)
        chosen.append((low & _POSITION).astype(np.int64) + t)
    starts = np.flatnonzero(valid)
    a = np.concatenate(chosen)[starts]
    new = np.append(True, (a[1:] != a[:-1]) | (starts[1:] != starts[:-1] + 1))
    first = np.flatnonzero(new)
    last = np.append(first[1:], len(a)) - 1
    lo = starts[first]
    return np.searchsorted(c.start, lo, "right") - 1, a[first], lo, starts[last]


_SECOND = np.random.default_rng(11).integers(0, 1 << 63, 256, dtype=np.uint64)


def _prefix_hash2(data: np.ndarray) -> np.ndarray:
    """As ``texts.prefix_hash`` with other byte values, for a second fingerprint."""
    power, _ = X._powers(len(data) + 1)
    return np.append(np.uint64(0), np.cumsum(_SECOND[data] * power[: len(data)]))


def suffix(data: np.ndarray, a: int, lo: int, end: int) -> bytes:
    """The text after an anchor, then what is before it backwards."""
    return data[a:end].tobytes() + data[lo:a][::-1].tobytes()


def _split(values: np.ndarray, doc: np.ndarray, n: int, kind) -> pa.Array:
    return pa.ListArray.from_arrays(np.searchsorted(doc, np.arange(n + 1)).astype(np.int32), pa.array(values, kind))


def anchored(docs: DataFrame, one_in: int) -> DataFrame:
    """cls and its anchors, as one row per anchor; ``sample`` is the suffix of one in so many contexts."""

    def results(column: pa.Array):
        for _, _, c in X.chunks(column):
            p = X.prefix_hash(c.data)
            doc, a, lo, hi = anchors(c, p)
            end = hi + LENGTH
            shape = X.mix(((a - lo) * 4096 + (end - lo)).astype(np.uint64))
            f1 = X.mix(X.range_hash(p, lo, end) + shape)
            f2 = X.mix(X.range_hash(_prefix_hash2(c.data), lo, end) + shape)
            head = X.mix(X.range_hash(p, a, a + PREFIX))
            picked = f1 % np.uint64(one_in) == 0
            sample = [suffix(c.data, *v) if k else None for k, *v in zip(
                picked.tolist(), a.tolist(), lo.tolist(), end.tolist(), strict=True)]
            long, small = pa.int64(), pa.int32()
            yield [
                _split(head.view(np.int64), doc, c.n, long), _split(f1.view(np.int64), doc, c.n, long),
                _split(f2.view(np.int64), doc, c.n, long), _split(lo - c.start[doc], doc, c.n, long),
                _split((a - lo).astype(np.int32), doc, c.n, small), _split((hi - lo).astype(np.int32), doc, c.n, small),
                _split(sample, doc, c.n, pa.binary()),
            ]

    found = X.per_text(docs, "text", ["cls"], ANCHOR_FIELDS, results)
    names = [f.name for f in ANCHOR_FIELDS]
    rows = found.select("doc.cls", F.explode(F.arrays_zip(*[F.col(f"out.{n}").alias(n) for n in names])).alias("x"))
    return rows.select("cls", *[F.col(f"x.{n}").alias(n) for n in names])


def common(a: bytes, b: bytes, at: int) -> int:
    """Length of the common prefix of two strings that share their first ``at`` bytes."""
    n = min(len(a), len(b))
    step = 16
    while at < n:
        if a[at : at + step] == b[at : at + step]:
            at = min(at + step, n)
            step *= 2
        elif step == 1:
            return at
        else:
            step = max(1, step // 4)
    return n


def front_coded(items: list[tuple[bytes, bytes]]) -> bytes:
    """A sorted run: per item the length shared with the item before, the rest, and a fixed tail of 32 bytes."""
    out, last = [], b""
    for s, tail in items:
        h = common(last, s, 0)
        out += [h.to_bytes(2, "little"), (len(s) - h).to_bytes(2, "little"), s[h:], tail]
        last = s
    return zstandard.ZstdCompressor(level=1).compress(b"".join(out))


TAIL = 32


def run_items(blob: bytes) -> Iterator[tuple[int, bytes, bytes]]:
    """(shared length, string, tail) of a front-coded run."""
    raw = zstandard.ZstdDecompressor().decompress(blob)
    at, last = 0, b""
    while at < len(raw):
        h, n = int.from_bytes(raw[at : at + 2], "little"), int.from_bytes(raw[at + 2 : at + 4], "little")
        last = last[:h] + raw[at + 4 : at + 4 + n]
        at += 4 + n + TAIL
        yield h, last, raw[at - TAIL : at]


def merged(runs: list[Iterator[tuple[int, bytes, bytes]]]) -> Iterator[tuple[int, bytes, bytes]]:
    """All items of sorted runs in order, with the length that each shares with the one before it.

    A loser tree. A run's front has ``h``, what it shares with the last item given out. Of two fronts the one that shares
    more comes first, and then the loser's ``h`` towards the winner is its own. Only fronts that share equally much are
    compared, from there on.
    """
    k = 1
    while k < len(runs):
        k *= 2
    fronts: list[tuple[bytes, bytes] | None] = [None] * k
    shared = [0] * k

    def pull(i: int) -> None:
        item = next(runs[i], None) if i < len(runs) else None
        if item is None:
            fronts[i], shared[i] = None, -1
        else:
            shared[i], fronts[i] = item[0], item[1:]

    def play(i: int, j: int) -> tuple[int, int]:
        """(winner, loser); sets what the loser shares with the winner."""
        if shared[i] != shared[j]:
            return (i, j) if shared[i] > shared[j] else (j, i)
        if shared[i] < 0:
            return i, j
        x, y = fronts[i][0], fronts[j][0]
        h = common(x, y, shared[i])
        first = len(x) == h if len(x) == h or len(y) == h else x[h] < y[h]
        if not first:
            i, j = j, i
        shared[j] = h
        return i, j

    for i in range(k):
        pull(i)
        if fronts[i] is not None:
            shared[i] = 0
    loser = [0] * k
    level = list(range(k))
    node = k
    while len(level) > 1:
        node //= 2
        up = []
        for q in range(0, len(level), 2):
            w, lost = play(level[q], level[q + 1])
            loser[node + q // 2] = lost
            up.append(w)
        level = up
    w = level[0]
    while fronts[w] is not None:
        yield (shared[w], *fronts[w])
        pull(w)
        node = (w + k) // 2
        while node:
            w, loser[node] = play(w, loser[node])
            node //= 2


def _runs(reps: DataFrame, splitters: list[bytes]) -> DataFrame:
    """(range, blob): sorted, front-coded pieces of the suffixes that ``reps`` (cls, text, marks) lists."""

    def run(batches):
        items, size = [], 0

        def flush():
            items.sort()
            cuts = [0, *[_first_not_below(items, s) for s in splitters], len(items)]
            got = [(r, front_coded(items[a:b])) for r, (a, b) in enumerate(zip(cuts, cuts[1:], strict=False)) if a < b]
            return pa.RecordBatch.from_arrays(
                [pa.array([r for r, _ in got], pa.int32()), pa.array([b for _, b in got], pa.binary())], names=["range", "blob"]
            )

        for batch in batches:
            for text, marks in zip(batch.column(0), batch.column(1).to_pylist(), strict=True):
                data = np.frombuffer(text.as_buffer(), np.uint8)
                for m in marks:
                    lo, back, more = m["lo"], m["back"], m["more"]
                    s = suffix(data, lo + back, lo, lo + more + LENGTH)
                    tail = np.array([m["f1"], m["f2"], back | more << 16, min(m["n"], 2)], "<i8").tobytes()
                    items.append((s, tail))
                    size += len(s) + 150
                if size > RUN_BYTES:
                    yield flush()
                    items, size = [], 0
        if items:
            yield flush()

    return X.small_batches(reps.select("text", "marks")).mapInArrow(run, "range int, blob binary")


def _first_not_below(items: list[tuple[bytes, bytes]], s: bytes) -> int:
    return bisect_left(items, s, key=lambda item: item[0])


class _Out:
    """Rows of resolved string starts (s to e within a context) and of hashes to be counted across ranges."""

    def __init__(self):
        self.rows: list[tuple] = []

    def take(self) -> pa.RecordBatch:
        cols = list(zip(*self.rows, strict=True)) if self.rows else [[]] * 6
        self.rows = []
        kinds = [pa.int64(), pa.int64(), pa.int32(), pa.int32(), pa.int64(), pa.int32()]
        return pa.RecordBatch.from_arrays([pa.array(v, k) for v, k in zip(cols, kinds, strict=True)], names=_MERGED)


_MERGED = ["f1", "f2", "s", "e", "hash", "n"]


def _resolve(groups: list[tuple[bool, list[tuple[bytes, bytes]]]], out: _Out) -> None:
    """Repeated strings of some whole groups. A group is (whether a splitter may cut it, its suffixes)."""
    parts, meta = [], []
    for cut, members in groups:
        for s, tail in members:
            f1, f2, shape, n = np.frombuffer(tail, "<i8").tolist()
            back, more = shape & 0xFFFF, shape >> 16
            fore = len(s) - back
            parts.append(s[fore:][::-1] + s[:fore])
            meta.append((f1, f2, more + 1, n, cut))
    data = np.frombuffer(b"".join(parts), np.uint8)
    begin = np.cumsum([0, *map(len, parts)])[:-1]
    strings = np.array([m[2] for m in meta])
    total = np.cumsum(strings)
    at = np.arange(int(total[-1])) - np.repeat(total - strings, strings)
    start = np.repeat(begin, strings) + at
    h = X.mix(X.range_hash(X.prefix_hash(data), start, start + LENGTH))
    owner = np.repeat(np.arange(len(meta)), strings)
    weight = np.array([m[3] for m in meta])[owner]
    value, first, which = np.unique(h, return_index=True, return_inverse=True)
    n = np.bincount(which, weights=weight, minlength=len(value)).astype(np.int64)
    again = n[which] > 1
    edge = np.flatnonzero(np.diff(again.astype(np.int8), prepend=0) | np.diff(owner, prepend=-1).astype(bool))
    for a, b in zip(edge.tolist(), [*edge[1:].tolist(), len(h)], strict=True):
        if again[a]:
            f1, f2, *_ = meta[owner[a]]
            out.rows.append((f1, f2, int(at[a]), int(at[b - 1]), None, None))
    loose = np.array([m[4] for m in meta])[owner]
    once = np.flatnonzero(loose & ~again)
    for i in once.tolist():
        f1, f2, *_ = meta[owner[i]]
        out.rows.append((f1, f2, int(at[i]), int(at[i]), int(h[i].view(np.int64)), 1))
    known = first[(n > 1) & loose[first]]
    out.rows += [(None, None, None, None, int(v), 2) for v in h[known].view(np.int64).tolist()]


def _merger(splitters: list[bytes]):
    def run(blobs: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        got, number = [], None
        for b in blobs:
            number = b.column("range")[0].as_py() if len(b) else number
            got += b.column("blob").to_pylist()
        fences = [s[:PREFIX] for s in (splitters[number - 1 : number] if number else [])] + [
            s[:PREFIX] for s in splitters[number : number + 1]]
        out, groups, size = _Out(), [], 0
        members: list[tuple[bytes, bytes]] = []
        for h, s, tail in merged([run_items(b) for b in got]):
            if h < PREFIX and members:
                groups.append((members[0][0][:PREFIX] in fences, members))
                members = []
                if size > 1 << 21:
                    _resolve(groups, out)
                    groups, size = [], 0
                    yield out.take()
            members.append((s, tail))
            size += len(s)
        if members:
            groups.append((members[0][0][:PREFIX] in fences, members))
        if groups:
            _resolve(groups, out)
        yield out.take()

    return run


def one_text(docs: DataFrame) -> DataFrame:
    """cls and text of each class. Copies meet in the task that reads them, before the shuffle, so a class with many sends few rows.

    ``min``, not ``first``: Spark moves a semi join with few classes below it, so that only their texts travel.
    """
    return docs.groupBy("cls").agg(F.min("text").alias("text"))


def repeated(docs: DataFrame) -> DataFrame:
    """cls, s, e: starts (first to last) of the repeated strings of each text. ``docs`` has cls and text."""
    n_bytes = docs.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    one_in = max(1, n_bytes * 2 // REACH // SAMPLE)
    every = pinned(anchored(docs, one_in), "suffix_anchors")
    heads = every.groupBy("prefix").agg(F.count(F.lit(1)).alias("m")).where("m > 1").select("prefix")
    heads = pinned(heads, "suffix_heads")  # a written side, so that a common prefix in the join can be split
    kept = pinned(every.join(heads, "prefix").drop("prefix"), "suffix_kept")
    reps = kept.groupBy("f1", "f2").agg(
        F.count(F.lit(1)).alias("n"), F.min(F.struct("cls", "lo", "back", "more")).alias("x"), F.first("sample", True).alias("sample")
    )
    reps = pinned(reps.select("f1", "f2", "n", "x.*", "sample"), "suffix_contexts")
    n_ranges = max(1, reps.count() * (LENGTH + REACH // 2) // RANGE_BYTES)
    sample = sorted(bytes(r.sample) for r in reps.where("sample is not null").select("sample").collect())  # about SAMPLE
    splitters = sorted({sample[len(sample) * i // n_ranges] for i in range(1, n_ranges)}) if sample else []
    marks = reps.groupBy("cls").agg(F.collect_list(F.struct("f1", "f2", "lo", "back", "more", "n")).alias("marks"))
    texts = one_text(docs).join(marks.select("cls"), "cls", "left_semi")
    sent = _runs(texts.join(marks, "cls"), splitters)
    got = pinned(
        sent.groupBy("range").applyInArrow(_merger(splitters), "f1 long, f2 long, s int, e int, hash long, n int"), "suffix_merged"
    )
    across = got.where("hash is not null").groupBy("hash").agg(F.sum("n").alias("m")).where("m > 1").select("hash")
    late = got.where("hash is not null and f1 is not null").join(across, "hash").select("f1", "f2", "s", "e")
    starts = got.where("hash is null").select("f1", "f2", "s", "e").unionByName(late)
    owners = kept.select("f1", "f2", "cls", "lo").distinct()
    return owners.join(starts, ["f1", "f2"]).select("cls", (F.col("lo") + F.col("s")).alias("s"), (F.col("lo") + F.col("e")).alias("e"))


def removed_runs(s: np.ndarray, e: np.ndarray) -> list[tuple[int, int]]:
    """Maximal removed byte ranges from ranges of string starts."""
    out: list[tuple[int, int]] = []
    for i in np.argsort(s, kind="stable").tolist():
        a, b = int(s[i]), int(e[i]) + LENGTH
        if out and a <= out[-1][1]:
            out[-1] = (out[-1][0], max(b, out[-1][1]))
        else:
            out.append((a, b))
    return out


def cleaned(docs: DataFrame, carry: list[str], text: str = "text") -> DataFrame:
    """``doc`` (the carried columns), n_bytes, n_removed, n_spans and kept_sha256; ``removed`` holds the byte ranges."""
    body = F.coalesce(F.col(f"`{text}`"), F.lit(""))
    src = X.small_batches(docs.select(F.xxhash64(body).alias("cls"), body.alias("text")))
    runs = repeated(src.where(F.octet_length("text") >= LENGTH)).groupBy("cls").agg(
        F.collect_set(F.struct("s", "e")).alias("starts")
    )
    runs = pinned(runs, "suffix_starts")

    def run(batches):
        for batch in batches:
            texts = batch.column(1)
            rows = []
            for t, starts in zip(texts, batch.column(2).to_pylist(), strict=True):
                raw = t.as_buffer().to_pybytes()
                spans = removed_runs(np.array([x["s"] for x in starts]), np.array([x["e"] for x in starts]))
                kept, at = hashlib.sha256(), 0
                for a, b in spans:
                    kept.update(raw[at:a])
                    at = b
                kept.update(raw[at:])
                rows.append((spans, kept.hexdigest()))
            spans = pa.array([[{"s": a, "e": b} for a, b in r[0]] for r in rows], pa.list_(pa.struct([("s", pa.int64()), ("e", pa.int64())])))
            yield pa.RecordBatch.from_arrays([batch.column(0), spans, pa.array([r[1] for r in rows])], names=["cls", "removed", "sha"])

    texts = one_text(src).join(runs.select("cls"), "cls", "left_semi")
    cut = texts.join(runs, "cls").mapInArrow(run, "cls long, removed array<struct<s:long,e:long>>, sha string")
    rows = docs.select(
        F.struct(*[F.col(f"`{c}`") for c in carry]).alias("doc"), F.xxhash64(body).alias("cls"),
        F.octet_length(body).cast("long").alias("n_bytes"), F.sha2(body.cast("binary"), 256).alias("whole"),
    )
    none = F.array().cast("array<struct<s:bigint,e:bigint>>")
    out = rows.join(cut, "cls", "left").withColumn("removed", F.coalesce("removed", none))
    return out.select(
        "doc", "n_bytes", F.aggregate("removed", F.lit(0).cast("long"), lambda a, x: a + x["e"] - x["s"]).alias("n_removed"),
        F.size("removed").cast("long").alias("n_spans"), F.coalesce("sha", "whole").alias("kept_sha256"), "removed",
    )


def digest(docs: DataFrame) -> DataFrame:
    return cleaned(docs, ["doc_id"]).select(F.col("doc.doc_id").alias("doc_id"), "n_bytes", "n_removed", "n_spans", "kept_sha256")
