"""Near-duplicate embeddings by collision counting over sorted one-dimensional projections.

Two vectors of one label are linked if their cosine reaches ``LEAST``. Equal vectors are one class with a count.

1. Each of m tables projects all vectors on one random line and sorts them there, after the cell that K random planes put
   them in; K follows the size of the largest label, so that a cell holds about ``CELL`` vectors by chance. A vector collides
   with those of its cell within a window centred on its own projection. A pair is a candidate if it collides in ``COUNT``
   tables. m is calibrated: for a pair at exactly ``LEAST`` a table's collision has a known chance, and m is the least number of
   tables for which ``COUNT`` of them come together with probability ``RECALL``; pairs that are more alike do so more often.
   Candidates are verified by their cosine.
2. Dense groups would collide in all pairs, so they are taken out first as balls. Cells of ``DENSE`` vectors and more get their
   centre (partial sums per task); centres of one cell follow the heaviest; vectors within half of the greatest angle of a
   centre are its ball. They are all linked with each other, by the triangle inequality, and are counted, not paired.
3. A ball meets other vectors and balls by its centre. If the angles decide it (all linked, or none), that is one row; only
   where the greatest angle cuts through a ball its vectors are compared one by one. Few centres are sent to all
   tasks; more than ``MOST_SENT`` bytes of them meet the vectors by the tables of step 1, calibrated for the wider angle.

Pairs are never listed for equal vectors or inside a ball. Two overlapping clouds that are wider than a ball do cost a row per
pair that may be linked.

Edge cases: vectors that are null, empty, zero, or have null or non-finite entries, and rows without a label, link with nothing
and are alone; vectors of different lengths are not compared; repeated rows are linked; a null id is not the least of its
component while there is another, and is kept if alone; an empty table gives an empty result; other columns are not read.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tableflow.llm import texts as X
from tableflow.llm.components import components
from tableflow.session import pinned

LEAST = 0.93
RECALL = 0.9995
COUNT = 3
CELL = 12
#: Half a window in standard deviations of the projected difference of a pair at the least cosine.
WINDOW = 2.0
DENSE = 32
BALL_TABLES = 4
MOST_SENT = 8 << 20
_PAIRS = 500_000
_SAFE = 1e-9
_SEED = 20


def calibrated(angle: float, group: int, recall: float = RECALL) -> tuple[int, int, float]:
    """(planes of a cell, tables, half window) for pairs at an angle among ``group`` vectors."""
    planes = max(0, math.ceil(math.log2(max(1, group) / CELL)))
    chance = (1 - angle / math.pi) ** planes * math.erf(WINDOW / math.sqrt(2))
    tables = COUNT
    while sum(math.comb(tables, i) * chance**i * (1 - chance) ** (tables - i) for i in range(COUNT)) > 1 - recall:
        tables += 1
    return planes, tables, WINDOW * 2 * math.sin(angle / 2)


def unit_rows(column: pa.Array) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """(row numbers, unit vectors) of a column of usable vectors, one item for each length of vector."""
    sizes = column.value_lengths().to_numpy()
    flat = column.flatten().to_numpy(zero_copy_only=False).astype(np.float64)
    start = np.cumsum(sizes) - sizes
    for size in np.unique(sizes).tolist():
        at = np.flatnonzero(sizes == size)
        v = flat[start[at][:, None] + np.arange(size)]
        v = v / np.abs(v).max(1, keepdims=True)  # squares stay finite
        yield at, v / np.sqrt((v * v).sum(1, keepdims=True))


def classes_of(df: DataFrame, doc_id: str, vector: str, label: str) -> tuple[DataFrame, DataFrame]:
    """Rows (uid, id, h1, h2; hashes null where nothing can be linked) and classes (cls, h1, h2, grp, vec, mult, least id)."""
    v, lab = F.col(f"`{vector}`"), F.col(f"`{label}`")
    whole = F.forall(v, lambda c: F.coalesce(F.abs(c.cast("double")) < F.lit(float("inf")), F.lit(False)))
    usable = F.coalesce(whole & F.exists(v, lambda c: c != 0), F.lit(False)) & lab.isNotNull()
    rows = df.select(
        F.col(f"`{doc_id}`").alias("id"), F.when(usable, F.xxhash64(lab, v)).alias("h1"),
        F.when(usable, F.xxhash64(v, lab, F.lit(_SEED))).alias("h2"), F.xxhash64(lab, F.size(v)).alias("grp"), v.alias("vec"),
    ).withColumn("uid", F.monotonically_increasing_id())
    classes = rows.where("h1 is not null").groupBy("h1", "h2").agg(
        F.min("uid").alias("cls"), F.count(F.lit(1)).alias("mult"), F.min("id").alias("least"), F.first("grp").alias("grp"), F.first("vec").alias("vec")
    )
    return pinned(rows.drop("vec", "grp"), "vector_rows"), pinned(classes, "vector_classes")


def _codes(units: np.ndarray, planes: int, tables: int) -> tuple[np.ndarray, np.ndarray]:
    """Cell number and projection of each vector in each table."""
    lines = np.random.default_rng([_SEED, units.shape[1]]).standard_normal((tables, planes + 1, units.shape[1]))
    on = (units @ lines.reshape(-1, units.shape[1]).T).reshape(len(units), tables, planes + 1)
    bits = (on[:, :, 1:] > 0) @ (np.uint64(1) << np.arange(planes, dtype=np.uint64)) if planes else np.zeros(on.shape[:2], np.uint64)
    return bits.astype(np.uint64), on[:, :, 0]


def posts(items: DataFrame, planes: int, tables: int) -> DataFrame:
    """(key, proj, item, ball) of each item (item, grp, vec, ball) in each table."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            item, grp, ball = (b.column(c).to_numpy(zero_copy_only=False) for c in (0, 1, 3))
            for at, units in unit_rows(b.column(2)):
                cell, proj = _codes(units, planes, tables)
                table = np.arange(tables, dtype=np.uint64)[None, :]
                key = X.mix(X.mix(grp[at].view(np.uint64)[:, None] + table) ^ cell)
                yield pa.RecordBatch.from_arrays(
                    [pa.array(key.ravel().view(np.int64)), pa.array(proj.ravel()), pa.array(np.repeat(item[at], tables)), pa.array(np.repeat(ball[at], tables))],
                    names=["key", "proj", "item", "ball"],
                )

    return X.small_batches(items.select("item", "grp", "vec", "ball")).mapInArrow(run, "key long, proj double, item long, ball boolean")


def collisions(posted: DataFrame, window: float, balls: bool) -> DataFrame:
    """(a, b, hits) of pairs that share windows in ``COUNT`` tables; with ``balls``, of pairs that hold a ball."""

    def pairs(key, proj, item, ball, first: int, end: int) -> Iterator[pa.RecordBatch]:
        """Pairs led by the rows from ``first`` to ``end``; rows are sorted, one key's projections after another's."""
        lead = np.arange(first, end)
        if balls:
            lead = lead[ball[first:end]]
        if not len(lead):
            return
        span = 2 * float(np.abs(proj).max()) + 4 * window
        line = np.cumsum(np.append(0, key[1:] != key[:-1])) * span + proj
        stop = np.searchsorted(line, line[lead] + window, "right")
        start = np.searchsorted(line, line[lead] - window, "left") if balls else lead + 1
        n = stop - start
        cuts = np.searchsorted(np.cumsum(n), np.arange(_PAIRS, int(n.sum()) + _PAIRS, _PAIRS), "left") + 1
        at = 0
        for cut in cuts.tolist():
            m, s, who = n[at:cut], start[at:cut], lead[at:cut]
            at = cut
            total = int(m.sum())
            left = np.repeat(who, m)
            right = np.arange(total) - np.repeat(np.cumsum(m) - m, m) + np.repeat(s, m)
            keep = left != right
            if balls:  # two balls meet from either side
                keep &= ~ball[right] | (left < right)
            a, b = item[left[keep]], item[right[keep]]
            yield pa.RecordBatch.from_arrays([pa.array(np.minimum(a, b)), pa.array(np.maximum(a, b))], names=["a", "b"])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, done = None, 0
        for b in batches:
            new = [b.column(c).to_numpy(zero_copy_only=False) for c in range(4)]
            if not len(new[0]):
                continue
            held = new if held is None else [np.concatenate(x) for x in zip(held, new, strict=True)]
            key, proj = held[0], held[1]
            open_ = np.flatnonzero((key == key[-1]) & (proj + window >= proj[-1]))  # their windows may go on
            end = max(done, int(open_[0]))
            yield from pairs(*held, done, end)
            back = np.flatnonzero((key == key[end]) & (proj >= proj[end] - window))
            held, done = [x[back[0] :] for x in held], end - int(back[0])
        if held is not None:
            yield from pairs(*held, done, len(held[0]))

    met = posted.repartition("key").sortWithinPartitions("key", "proj").mapInArrow(run, "a long, b long")
    return met.groupBy("a", "b").agg(F.count(F.lit(1)).alias("hits")).where(F.col("hits") >= COUNT)


def angles(pairs: DataFrame, left: DataFrame, right: DataFrame) -> DataFrame:
    """``cosine`` and ``angle`` for pairs (a, b) of vectors (item, grp, vec) of one group."""
    x = pairs.join(left.select(F.col("item").alias("a"), F.col("grp").alias("g"), F.col("vec").alias("x")), "a")
    xy = x.join(right.select(F.col("item").alias("b"), F.col("grp").alias("g2"), F.col("vec").alias("y")), "b").where("g = g2")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            cosine, angle = np.zeros(len(b)), np.zeros(len(b))
            for (at, u), (_, v) in zip(unit_rows(b.column(2)), unit_rows(b.column(3)), strict=True):
                cosine[at] = (u * v).sum(1)
                angle[at] = 2 * np.arcsin(np.minimum(1.0, np.sqrt(((u - v) ** 2).sum(1)) / 2))
            yield pa.RecordBatch.from_arrays([b.column(0), b.column(1), pa.array(cosine), pa.array(angle)], names=["a", "b", "cosine", "angle"])

    return X.small_batches(xy.select("a", "b", F.col("x").cast("array<double>"), F.col("y").cast("array<double>"))).mapInArrow(
        run, "a long, b long, cosine double, angle double")


def _centres(members: DataFrame) -> DataFrame:
    """key, grp, weight and centre ``vec`` of the unit vectors (key, grp, vec) of each key; tasks send sums."""
    fields = "key long, grp long, weight long, vec array<double>"

    def sums(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            key, grp = b.column(0).to_numpy(), b.column(1).to_numpy()
            for at, units in unit_rows(b.column(2)):
                order = at[np.argsort(key[at], kind="stable")]
                rank = np.empty(len(b), np.int64)
                rank[at] = np.arange(len(at))
                first = np.flatnonzero(np.append(True, key[order][1:] != key[order][:-1]))
                total = np.add.reduceat(units[rank[order]], first, axis=0)
                yield pa.RecordBatch.from_arrays([
                    pa.array(key[order][first]), pa.array(grp[order][first]), pa.array(np.diff(np.append(first, len(order)))),
                    pa.array(list(total), pa.list_(pa.float64())),
                ], names=["key", "grp", "weight", "vec"])

    def add(table: pa.Table) -> pa.Table:
        v = table.column("vec").combine_chunks()
        total = v.flatten().to_numpy().reshape(len(v), -1).sum(0)
        size = float(np.sqrt(total @ total))
        rows = [] if size == 0 else [(table["key"][0].as_py(), table["grp"][0].as_py(), int(np.sum(table["weight"].to_numpy())), (total / size).tolist())]
        return pa.Table.from_pylist([dict(zip(["key", "grp", "weight", "vec"], r, strict=True)) for r in rows], schema=pa.schema(
            [("key", pa.int64()), ("grp", pa.int64()), ("weight", pa.int64()), ("vec", pa.list_(pa.float64()))]))

    return X.small_batches(members.select("key", "grp", "vec")).mapInArrow(sums, fields).groupBy("key").applyInArrow(add, fields)


def balls(classes: DataFrame, angle: float, planes: int, dense: int = DENSE) -> DataFrame:
    """(item, ball, off) of the classes (item, grp, vec) that lie in a ball, ``off`` being the angle from its centre; and each
    ball's grp, ``centre``, ``members`` and ``radius``."""
    posted = pinned(posts(classes.withColumn("ball", F.lit(False)), planes, BALL_TABLES).select("key", "item"), "ball_posts")
    heavy = posted.groupBy("key").agg(F.count(F.lit(1)).alias("m")).where(F.col("m") >= dense).select("key")
    held = pinned(posted.join(heavy, "key"), "ball_cells")
    centres = pinned(_centres(held.join(classes, "item").select("key", "grp", F.col("vec").cast("array<double>").alias("vec"))), "ball_centres")
    # The centres that one cloud has in several tables are close; those of one cell follow the heaviest.
    cells = posts(centres.select(F.col("key").alias("item"), "grp", "vec", F.lit(False).alias("ball")), planes, 1)
    cells = cells.select(F.col("item").alias("key"), F.col("key").alias("cell")).join(centres.select("key", "weight"), "key")
    lead = cells.groupBy("cell").agg(F.max(F.struct("weight", "key")).alias("lead"))
    leads = pinned(cells.join(lead, "cell").select("key", F.col("lead.key").alias("ball"), F.col("lead.weight").alias("weight")), "ball_leads")
    near = held.join(leads, "key").select(F.col("item").alias("a"), F.col("ball").alias("b"), "weight").distinct()
    off = angles(near, classes, centres.withColumnRenamed("key", "item")).where(F.col("angle") <= angle / 2 - _SAFE)
    off = off.join(leads.select(F.col("ball").alias("b"), "weight").distinct(), "b")
    mine = off.groupBy(F.col("a").alias("item")).agg(F.max(F.struct("weight", F.col("b").alias("ball"), F.col("angle").alias("off"))).alias("x"))
    mine = pinned(mine.select("item", "x.ball", "x.off"), "ball_members")
    stats = mine.groupBy("ball").agg(F.count(F.lit(1)).alias("members"), F.max("off").alias("radius")).where(F.col("members") >= dense)
    stats = pinned(stats.join(centres.select(F.col("key").alias("ball"), "grp", F.col("vec").alias("centre")), "ball"), "balls")
    return mine.join(stats.select("ball"), "ball"), stats


def _met_sent(items: DataFrame, centres: DataFrame, reach: float) -> DataFrame:
    """(a, b, angle) of items (item, grp, vec) within ``reach`` plus both radii of a centre, all centres being sent along."""
    sent = [(r.item, r.grp, r.radius, np.array(r.vec)) for r in centres.collect()]
    by: dict[tuple[int, int], tuple[np.ndarray, np.ndarray, np.ndarray]] = {}
    for g in {(grp, len(v)) for _, grp, _, v in sent}:
        some = [s for s in sent if (s[1], len(s[3])) == g]
        by[g] = (np.array([s[0] for s in some]), np.array([s[2] for s in some]), np.array([s[3] for s in some]))
    carried = items.sparkSession.sparkContext.broadcast(by)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            item, grp, radius = (b.column(c).to_numpy() for c in (0, 1, 3))
            for at, units in unit_rows(b.column(2)):
                for g in np.unique(grp[at]).tolist():
                    if (g, units.shape[1]) not in carried.value:
                        continue
                    rows = np.flatnonzero(grp[at] == g)
                    name, far, centre = carried.value[g, units.shape[1]]
                    for block in range(0, len(name), 1024):
                        cut = slice(block, block + 1024)
                        cosine = units[rows] @ centre[cut].T
                        limit = np.minimum(math.pi, reach + far[cut][None, :] + radius[at][rows][:, None])
                        r, c = np.nonzero(cosine >= np.cos(limit) - _SAFE)
                        u, v = units[rows[r]], centre[cut][c]
                        angle = 2 * np.arcsin(np.minimum(1.0, np.sqrt(((u - v) ** 2).sum(1)) / 2))
                        yield pa.RecordBatch.from_arrays([pa.array(item[at][rows[r]]), pa.array(name[cut][c]), pa.array(angle)], names=["a", "b", "angle"])

    return X.small_batches(items.select("item", "grp", "vec", "radius")).mapInArrow(run, "a long, b long, angle double")


def met(items: DataFrame, centres: DataFrame, reach: float, most_sent: int = MOST_SENT) -> DataFrame:
    """(a, b, angle): items and balls whose members may be within ``reach``. Two balls meet once, the lesser as a."""
    size = centres.agg(F.sum(F.size("vec")), F.count(F.lit(1))).first()
    if (size[0] or 0) * 8 <= most_sent:
        pairs = _met_sent(items.withColumn("radius", F.lit(0.0)), centres, reach)
        return pairs.unionByName(_met_sent(centres, centres, reach).where("a < b"))
    # A ball's radius is at most half of the reach.
    both = items.select("item", "grp", F.col("vec").cast("array<double>").alias("vec"), F.lit(False).alias("ball")).unionByName(
        centres.select("item", "grp", "vec", F.lit(True).alias("ball")))
    largest = centres.groupBy("grp").count().agg(F.max("count")).first()[0]
    planes, tables, window = calibrated(2 * reach, largest)
    found = collisions(posts(both, planes, tables), window, True).select("a", "b")
    whose = centres.select(F.col("item").alias("b"), F.lit(True).alias("is_ball"))
    found = found.join(whose, "b", "left").select(
        F.when(F.col("is_ball"), F.col("a")).otherwise(F.col("b")).alias("a"), F.when(F.col("is_ball"), F.col("b")).otherwise(F.col("a")).alias("b"))
    return angles(found, both, both).select("a", "b", "angle")


def linked(classes: DataFrame, least: float = LEAST, dense: int = DENSE, most_sent: int = MOST_SENT) -> tuple[DataFrame, DataFrame]:
    """(item, links) and (node, root) of the classes (item, grp, vec, mult): how many rows of other classes each is linked
    with, and the component of every linked class."""
    angle = math.acos(least)
    largest = classes.groupBy("grp").count().agg(F.max("count")).first()[0] or 0
    planes, tables, window = calibrated(angle, largest)
    inside, stats = balls(classes, angle, planes, dense)
    # Balls are named apart from classes: below zero.
    name = -F.col("ball_no") - 1
    mult = classes.select("item", "mult")
    total = inside.join(mult, "item").groupBy("ball").agg(F.sum("mult").alias("total"), F.min("item").alias("rep"))
    ball = pinned(stats.join(total, "ball").withColumn("ball_no", F.monotonically_increasing_id()).select(
        name.alias("item"), "ball", "grp", F.col("centre").alias("vec"), "radius", "total", "rep"), "ball_table")
    inside = pinned(inside.join(ball.select("ball", F.col("item").alias("of"), "total", "rep"), "ball").select("item", "of", "total", "rep"), "ball_inside")
    single = classes.join(inside.select("item"), "item", "left_anti")
    near = collisions(posts(single.withColumn("ball", F.lit(False)), planes, tables), window, False).select("a", "b")
    one = angles(near, single, single).where(F.col("cosine") >= least).select("a", "b")
    # Where a ball's angles decide, its members are not looked at.
    pairs = met(single.select("item", "grp", "vec"), ball.select("item", "grp", "vec", "radius"), angle, most_sent)
    r = ball.select("item", "radius")
    pairs = pairs.join(r.select(F.col("item").alias("a"), F.col("radius").alias("r1")), "a", "left").join(
        r.select(F.col("item").alias("b"), F.col("radius").alias("r2")), "b")
    wide = F.coalesce("r1", F.lit(0.0)) + F.col("r2")
    pairs = pinned(pairs.select("a", "b", (F.col("angle") + wide <= angle - _SAFE).alias("all"), (F.col("angle") - wide > angle + _SAFE).alias("none")), "ball_pairs")
    whole, split = pairs.where("all").select("a", "b"), pairs.where("not all and not none").select("a", "b")
    member = inside.select("item", "of")
    split = split.join(member.select(F.col("of").alias("a"), F.col("item").alias("x")), "a", "left").select(F.coalesce("x", "a").alias("a"), "b")
    split = split.join(member.select(F.col("of").alias("b"), F.col("item").alias("y")), "b").select("a", F.col("y").alias("b"))
    some = angles(split, classes, classes).where(F.col("cosine") >= least).select("a", "b")
    one = pinned(one.unionByName(some), "vector_links")
    # Counts: rows of linked classes, of the own ball, and of what is linked with the whole ball.
    weight = mult.unionByName(ball.select("item", F.col("total").alias("mult")))
    direct = one.unionByName(whole)
    direct = direct.unionByName(direct.select(F.col("b").alias("a"), F.col("a").alias("b")))
    direct = pinned(direct.join(weight.select(F.col("item").alias("b"), "mult"), "b").groupBy(F.col("a").alias("item")).agg(F.sum("mult").alias("links")), "vector_counts")
    own = inside.join(mult, "item").join(direct.select(F.col("item").alias("of"), F.col("links").alias("of_ball")), "of", "left").select(
        "item", (F.col("total") - F.col("mult") + F.coalesce("of_ball", F.lit(0))).alias("links"))
    counts = direct.where("item >= 0").unionByName(own).groupBy("item").agg(F.sum("links").alias("links"))
    rep = ball.select("item", "rep")
    through = whole.join(rep.select(F.col("item").alias("a"), F.col("rep").alias("x")), "a", "left").join(
        rep.select(F.col("item").alias("b"), F.col("rep").alias("y")), "b").select(F.coalesce("x", "a").alias("a"), F.col("y").alias("b"))
    edges = one.unionByName(through).unionByName(inside.select(F.col("item").alias("a"), F.col("rep").alias("b")))
    return counts, components(edges)


def grouped(df: DataFrame, doc_id: str = "vec_id", vector: str = "embedding", label: str = "label", least: float = LEAST, **kw) -> DataFrame:
    """id, n_links, component_id and ``kept`` of every row."""
    rows, classes = classes_of(df, doc_id, vector, label)
    items = classes.select(F.col("cls").alias("item"), "grp", "vec", "mult")
    counts, root = linked(items, least, **kw)
    c = classes.select("h1", "h2", "cls", "mult", "least").join(counts, F.col("cls") == F.col("item"), "left").join(root, F.col("cls") == F.col("node"), "left")
    c = pinned(c.select("h1", "h2", F.coalesce("root", "cls").alias("root"), "least", (F.col("mult") - 1 + F.coalesce("links", F.lit(0))).alias("n_links")), "vector_counted")
    ids = c.groupBy("root").agg(F.min("least").alias("component_id"))
    c = pinned(c.join(ids, "root").select("h1", "h2", "n_links", "component_id", F.lit(True).alias("found")), "vector_components")
    out = rows.join(c, ["h1", "h2"], "left")
    component = F.when(F.col("found"), F.col("component_id")).otherwise(F.col("id"))
    return out.select("id", F.coalesce("n_links", F.lit(0)).cast("long").alias("n_links"), component.alias("component_id"), F.col("id").eqNullSafe(component).alias("kept"))


def digest(embeddings: DataFrame) -> DataFrame:
    return grouped(embeddings).select(F.col("id").alias("vec_id"), "n_links", "component_id", "kept")
