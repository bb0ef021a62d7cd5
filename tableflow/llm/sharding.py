"""Minimum-cost-flow resharding.

A table's files are its old shards. Given the capacities of the new shards, a flow decides how many bytes go from each
old shard to each new one: staying (old shard i is new shard i) costs nothing, moving costs one per byte, so the
cheapest flow moves the fewest bytes. The flow is cut into blocks, byte ranges of an old shard's rows in file order. What
comes of it is a list of spans: rows first to last of a file go to one shard, from one slot on. ``rewrite`` applies it to
the texts with one shuffle and writes the shards that change; the others keep their file.

A block ends between two rows; a row that an end cuts through is placed by itself after the flow, as are a ``LOOSE``th of
the rows larger than 1/``GRAIN`` of a mean shard, picked by hash, so that the last rows can level what the blocks leave
uneven. Rows larger than 1/``HUGE`` of a shard are placed before the flow. Rows placed by themselves stay where they fit.
They number at most GRAIN times the new shards plus a row per block end, whatever the input.

Rows are known by file and row number, never by id. Files, blocks and rows placed by themselves are what the driver sees:
a list that grows with the files, not with the rows. It is broadcast up to ``MOST_BROADCAST`` spans; beyond that, the
rows are joined with it by a shuffle on file and bucket of rows.

Edge cases: null text has no bytes and still takes a slot; repeated rows and null ids are rows of their own; an empty
table gives an empty result; columns of any name are carried in one struct.
"""

from __future__ import annotations

import heapq
from bisect import bisect_left, insort
from collections import defaultdict

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from tableflow.session import fresh_path, pinned

SHARDS = 40
GRAIN = 256
HUGE = 4
LOOSE = 10
#: Shards within this share of a mean shard of each other are near enough.
NEAR = 0.005
BLOCK_ROWS = 1024
#: Text bytes that a task of the rewrite sorts and writes.
TASK_BYTES = 128 << 20
MOST_BROADCAST = 500_000
#: Bytes a row takes besides its text.
OVERHEAD = 16

Flow = dict[tuple[int, int], int]
Row = tuple[int, int, int]
Places = dict[tuple[int, int], int]


def cheapest_flow(supply: list[int], demand: list[int]) -> Flow:
    """Bytes (old, new) of a flow from all of ``supply`` into ``demand`` (same totals) that moves the fewest bytes.

    Successive shortest paths. Every augmenting path costs nothing (old i to new i) or one (over a hub that joins all
    old shards to all new ones), and a path that undoes a stay never costs less, so one sweep per length is exact.
    """
    if sum(supply) != sum(demand):
        raise ValueError("supply and demand differ")
    left, room = list(supply), list(demand)
    flow: Flow = defaultdict(int)
    for i in range(min(len(left), len(room))):
        stay = min(left[i], room[i])
        if stay:
            flow[i, i] = stay
            left[i] -= stay
            room[i] -= stay
    j = 0
    for i, rest in enumerate(left):
        while rest:
            while not room[j]:
                j += 1
            part = min(rest, room[j])
            flow[i, j] += part
            rest -= part
            room[j] -= part
    return dict(flow)


def blocks(flow: Flow) -> list[tuple[int, int, int, int]]:
    """(old, first byte, end byte, new) of each transfer; what stays comes first in its old shard."""
    out, at = [], defaultdict(int)
    for (old, new), n in sorted(flow.items(), key=lambda f: (f[0][0], f[0][0] != f[0][1], f[0][1])):
        out.append((old, at[old], at[old] + n, new))
        at[old] += n
    return out


def place_rows(rows: list[Row], load: list[int], capacity: float) -> tuple[Places, list[Row]]:
    """The rows (old, row, size) that stay, largest first, where they fit beside ``load`` (changed), and the others."""
    where: Places = {}
    rest = []
    for old, row, size in sorted(rows, key=lambda r: (-r[2], r[0], r[1])):
        if old < len(load) and load[old] + size <= capacity:
            load[old] += size
            where[old, row] = old
        else:
            rest.append((old, row, size))
    return where, rest


def fill(rows: list[Row], load: list[int]) -> Places:
    """Rows, largest first, to the least loaded shard; ``load`` is changed."""
    heap = [(n, j) for j, n in enumerate(load)]
    heapq.heapify(heap)
    where: Places = {}
    for old, row, size in sorted(rows, key=lambda r: (-r[2], r[0], r[1])):
        n, j = heap[0]
        where[old, row] = j
        load[j] = n + size
        heapq.heapreplace(heap, (n + size, j))
    return where


def settle(rows: list[Row], where: Places, load: list[int], slack: float) -> None:
    """Hand single rows from the fullest to the emptiest shard while they are further apart than ``slack`` and a row helps."""
    held: list[list[tuple[int, int, int]]] = [[] for _ in load]
    for old, row, size in rows:
        held[where[old, row]].append((size, old, row))
    for h in held:
        h.sort()
    while True:
        top = max(range(len(load)), key=lambda j: load[j])
        low = min(range(len(load)), key=lambda j: load[j])
        gap = load[top] - load[low]
        at = bisect_left(held[top], (gap // 2 + 1, -1, -1))
        near = [i for i in (at - 1, at) if 0 <= i < len(held[top]) and held[top][i][0] < gap]
        if gap <= slack or not near:
            return
        size, old, row = held[top].pop(min(near, key=lambda i: abs(2 * held[top][i][0] - gap)))
        insort(held[low], (size, old, row))
        where[old, row] = low
        load[top] -= size
        load[low] += size


def levelled(load: list[int], total: int) -> list[int]:
    """How ``total`` more bytes fill loaded shards up to one level."""
    order = sorted(range(len(load)), key=lambda j: load[j])
    level, used = 0, 0
    for n, j in enumerate(order, 1):
        used += load[j]
        level = (used + total) // n
        if n == len(order) or level <= load[order[n]]:
            break
    take = [max(0, level - x) for x in load]
    for j in order[: total - sum(take)]:
        take[j] += 1
    return take


def rows_of(spark: SparkSession, path: str, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """old (file), row, doc_id, size and text_crc32 of every row of a Parquet table, written once."""
    body = F.coalesce(F.col(f"`{text}`"), F.lit(""))
    df = spark.read.parquet(path).select(*_place(), F.col(f"`{doc_id}`").alias("doc_id"), *_measures(body))
    return pinned(df, "shard_rows")


def sizes_of(spark: SparkSession, path: str, text: str = "text") -> DataFrame:
    """file, row and size of every row, written once: all that a plan needs."""
    body = F.coalesce(F.col(f"`{text}`"), F.lit(""))
    return pinned(spark.read.parquet(path).select(*_place(), _measures(body)[0]), "shard_sizes")


def _place() -> list[Column]:
    return [F.col("_metadata.file_path").alias("file"), F.col("_metadata.row_index").alias("row")]


def _measures(body: Column) -> list[Column]:
    return [(F.octet_length(body) + OVERHEAD).cast("long").alias("size"), F.crc32(body.cast("binary")).alias("text_crc32")]


def _small(df: DataFrame, n: int) -> DataFrame:
    return F.broadcast(df) if n <= MOST_BROADCAST else df


SPAN = "file string, old int, bucket long, first long, last long, shard int, slot long"


def spans(rows: DataFrame, n_new: int = SHARDS) -> tuple[DataFrame, int, int]:
    """Where the rows go: spans of rows of a file with their shard and first slot; how many, and rows per bucket."""
    spark = rows.sparkSession
    files = sorted(rows.groupBy("file").agg(F.sum("size").alias("n"), F.count(F.lit(1)).alias("rows")).collect(), key=lambda r: r.file)
    total = sum(r.n for r in files)
    old_of = spark.createDataFrame([(r.file, i) for i, r in enumerate(files)], "file string, old int")
    picked = (F.col("size") > max(1, total // (n_new * GRAIN))) & (F.pmod(F.xxhash64("old", "row"), F.lit(LOOSE)) == 0)
    rows = rows.join(_small(old_of, len(files)), "file").select(
        "old", "row", "size", F.floor(F.col("row") / BLOCK_ROWS).alias("block"),
        (picked | (F.col("size") > total // (n_new * HUGE))).alias("apart"),
    )
    apart = [tuple(r) for r in rows.where("apart").select("old", "row", "size").collect()]  # at most GRAIN * n_new

    load = [0] * n_new
    huge = [r for r in apart if r[2] > total // (n_new * HUGE)]
    loose = [r for r in apart if r[2] <= total // (n_new * HUGE)]
    where, rest = place_rows(huge, load, total / n_new)
    where |= fill(rest, load)
    stay, rest = place_rows(loose, load, total / n_new)
    where |= stay
    supply = [r.n for r in files]
    for old, _, size in apart:
        supply[old] -= size
    cuts: dict[int, list[tuple[int, int]]] = defaultdict(list)
    for old, _, hi, to in blocks(cheapest_flow(supply, levelled(load, sum(supply)))):
        cuts[old].append((hi, to))

    met = _rows_at(rows, [(old, hi) for old, ends in cuts.items() for hi, _ in ends[:-1]])
    through = {}
    pieces = []
    singles: dict[int, list[int]] = defaultdict(list)
    for old, row, _ in apart:
        insort(singles[old], row)
    for old, ends in cuts.items():
        at = 0
        for hi, to in ends:
            row, size, end = met.get((old, hi), (files[old].rows, 0, hi))
            upto = row + 1 if end == hi and size else row
            for one in singles[old][bisect_left(singles[old], at):bisect_left(singles[old], upto)]:
                pieces.append((to, old, at, one))
                at = one + 1
            pieces.append((to, old, at, upto))
            at = max(at, upto)
            if end != hi:
                through[old, row] = size
                at = max(at, row + 1)
    load = [0] * n_new
    sizes = {(old, row): size for old, row, size in apart} | through
    for (old, row), to in where.items():
        load[to] += sizes[old, row]
    for old, lo, hi, to in _flowed(cuts, met):
        load[to] += hi - lo
    rest += [(old, row, size) for (old, row), size in through.items()]
    where |= fill(rest, load)
    settle([(*k, n) for k, n in sizes.items() if n <= total // (n_new * HUGE)], where, load, NEAR * total / n_new)

    pieces += [(to, old, row, row + 1) for (old, row), to in where.items()]
    bucket = max(BLOCK_ROWS, sum(r.rows for r in files) // (len(files) + GRAIN * n_new)) if files else BLOCK_ROWS
    out = [(files[old].file, old, *rest_) for old, *rest_ in _numbered(pieces, bucket)]
    return pinned(spark.createDataFrame(out, SPAN), "shard_spans"), len(out), bucket


def _rows_at(rows: DataFrame, cuts: list[tuple[int, int]]) -> dict[tuple[int, int], tuple[int, int, int]]:
    """(old, cut): the row whose flowing bytes hold the last byte before the cut, its size and its end; a row per cut."""
    cut = _small(rows.sparkSession.createDataFrame(sorted(set(cuts)), "old int, hi long"), len(cuts))
    flowing = F.when(F.col("apart"), 0).otherwise(F.col("size"))
    before = Window.partitionBy("old").orderBy("block").rowsBetween(Window.unboundedPreceding, -1)
    per_block = rows.groupBy("old", "block").agg(F.sum(flowing).alias("n")).withColumn(
        "base", F.coalesce(F.sum("n").over(before), F.lit(0))
    )
    met = per_block.join(cut, "old").where("base < hi and hi <= base + n").groupBy("old", "block", "base").agg(
        F.collect_list("hi").alias("his")
    )
    inside = Window.partitionBy("old", "block").orderBy("row").rowsBetween(Window.unboundedPreceding, 0)
    ends = rows.where("not apart").join(_small(met, len(cuts)), ["old", "block"]).withColumn("end", F.col("base") + F.sum("size").over(inside))
    found = ends.select("old", "row", "size", "end", F.explode(F.filter(
        "his", lambda h: (h > F.col("end") - F.col("size")) & (h <= F.col("end")))).alias("hi"))
    return {(r.old, r.hi): (r.row, r["size"], r.end) for r in found.collect()}


def _flowed(cuts: dict[int, list[tuple[int, int]]], met: dict[tuple[int, int], tuple[int, int, int]]) -> list[tuple[int, int, int, int]]:
    """The blocks without the rows that their ends cut through."""
    out = []
    for old, ends in cuts.items():
        at = 0
        for hi, to in ends:
            _, size, end = met.get((old, hi), (0, 0, hi))
            upto = end if end == hi else end - size
            if upto > at:
                out.append((old, at, upto, to))
            at = max(at, end)
    return out


def _numbered(pieces: list[tuple[int, int, int, int]], bucket: int) -> list[tuple[int, int, int, int, int, int]]:
    """(old, bucket, first, last, shard, slot) of pieces (shard, old, row, end row), in order of old shard and row."""
    out, slot = [], defaultdict(int)
    for shard, old, lo, hi in sorted(pieces):
        while lo < hi:
            end = min(hi, (lo // bucket + 1) * bucket)
            out.append((old, lo // bucket, lo, end - 1, shard, slot[shard]))
            slot[shard] += end - lo
            lo = end
    return out


def placed(rows: DataFrame, spans: DataFrame, n_spans: int, bucket: int) -> DataFrame:
    """``rows`` (file, row and more) with old, shard and slot."""
    s = _small(spans.withColumnRenamed("file", "_file").withColumnRenamed("slot", "_slot"), n_spans)
    hit = rows.join(s, (F.col("file") == F.col("_file")) & (F.floor(F.col("row") / bucket) == F.col("bucket"))
                    & F.col("row").between(F.col("first"), F.col("last")))
    return hit.withColumn("slot", F.col("_slot") + F.col("row") - F.col("first")).drop("_file", "_slot", "first", "last", "bucket")


def reshard(rows: DataFrame, n_new: int = SHARDS) -> DataFrame:
    """``rows`` with old (number of the file in name order), shard, slot and moved."""
    return placed(rows, *spans(rows, n_new)).withColumn("moved", F.col("shard") != F.col("old"))


def rewrite(spark: SparkSession, path: str, places: DataFrame, out: str) -> DataFrame:
    """Write the shards that change under ``out`` and give a table of shard, path: the new folder or the old file.

    ``places`` holds file, row, size, old, shard and slot, slots of a shard in order of old and row, as ``reshard`` gives
    them. A shard is kept as it is if every row of its file stays and no other comes. Rows are written in slot order by as
    many tasks per shard as its bytes ask for: columns ``_doc`` (all of the row), slot and old.
    """
    bucket = BLOCK_ROWS
    by_span = places.groupBy("file", "old", F.floor(F.col("row") / bucket).alias("bucket"), "shard", (F.col("slot") - F.col("row")).alias("shift")).agg(
        F.min("row").alias("first"), F.max("row").alias("last"), F.sum("size").alias("size"))
    by_span = pinned(by_span.withColumn("slot", F.col("first") + F.col("shift")).drop("shift"), "shard_spans")
    kept, folder = _write(spark, path, by_span, by_span.count(), bucket, out)
    written = by_span.join(kept.select("shard"), "shard", "left_anti").select("shard").distinct()
    return kept.unionByName(written.select("shard", F.concat(F.lit(f"{folder}/shard="), "shard").alias("path")))


def _write(spark: SparkSession, path: str, spans: DataFrame, n_spans: int, bucket: int, out: str) -> tuple[DataFrame, str]:
    """The shards that are kept (shard, path: at most one per new shard), and the folder of the written ones."""
    stays = spans.groupBy(F.col("file").alias("path"), "old").agg(F.max(F.col("shard") != F.col("old")).alias("loses")).where("not loses")
    gains = spans.where("shard != old").select(F.col("shard").alias("old")).distinct()
    same = [tuple(r) for r in stays.join(gains, "old", "left_anti").select("old", "path").collect()]  # at most a file per shard
    kept = spark.createDataFrame(same, "shard int, path string")
    ways = spans.groupBy("shard").agg(
        F.ceil(F.sum("size") / TASK_BYTES).alias("tasks"), F.sum(F.col("last") - F.col("first") + 1).alias("n"))
    src = spark.read.parquet(path)
    body = src.select(*_place(), F.struct(*[F.col(f"`{c}`") for c in src.columns]).alias("_doc"))
    if same:
        body = body.where(~F.col("file").isin([p for _, p in same]))
    hit = placed(body, spans.drop("size").join(F.broadcast(ways), "shard"), n_spans, bucket)
    hit = hit.withColumn("task", F.floor(F.col("slot") * F.col("tasks") / F.col("n")))
    folder = f"{out}/{fresh_path(spark, 'shards').rsplit('/', 1)[-1]}"
    hit.repartition("shard", "task").sortWithinPartitions("shard", "slot").select(
        "shard", "slot", "old", "_doc"
    ).write.partitionBy("shard").parquet(folder)
    return kept, folder


def digest(spark: SparkSession, path: str, n_new: int = SHARDS) -> DataFrame:
    """Reshard into files under the work root; ids, sizes, check sums and slots are read from the written and the kept files."""
    rows = sizes_of(spark, path)
    found, n, bucket = spans(rows, n_new)
    weights = placed(rows, found, n, bucket).groupBy("shard").agg(F.sum("size").alias("size"))
    # The bytes of a shard, told once per shard, are enough to choose its tasks.
    weighed = found.join(F.broadcast(weights), "shard").withColumn("size", F.when(F.col("slot") == 0, F.col("size")).otherwise(0))
    kept, folder = _write(spark, path, weighed, n, bucket, fresh_path(spark, "reshard"))
    src = spark.read.parquet(path)
    inner = ", ".join(f"{c}: {src.schema[c].dataType.simpleString()}" for c in ("doc_id", "text"))
    new = spark.read.schema(f"slot long, old int, _doc struct<{inner}>, shard int").parquet(folder).select(
        F.col("_doc.doc_id").alias("doc_id"), F.col("_doc.text").alias("text"), "shard", "slot", "old")
    whole = src.select(*_place(), "doc_id", "text").join(F.broadcast(kept), F.col("file") == F.col("path")).select(
        "doc_id", "text", "shard", F.col("row").alias("slot"), F.col("shard").alias("old"))
    both = new.unionByName(whole)
    return both.select(
        "doc_id", *_measures(F.coalesce("text", F.lit(""))), F.lit("bytes").alias("law"), "shard", "slot",
        F.lit(None).cast("int").alias("grown_shard"), "old", (F.col("shard") != F.col("old")).alias("moved"),
    )
