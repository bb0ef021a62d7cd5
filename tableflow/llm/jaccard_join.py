"""Jaccard join of documents on word shingles, with token-combination prefixes, and its components.

A document is the set of its distinct shingles, the tokens. Texts that are alike to the letter are one class.

1. Token frequencies over all classes: each task sorts its tokens and sends them by hash range as coded
   differences; a range adds up. Tokens of more than ``RARE`` classes are frequent.
2. Tokens are ordered rare ones first, then by hash. A pair is looked for from its smaller set (equal sizes: of lesser class)
   to its larger one. Sets of similarity t have at least o = 2t/(1+t) n of n tokens in common with a larger one, and t m of
   m with a smaller one, so they share a token among the first n - o + 1 and m - t m + 1 (the prefixes), and k tokens when
   both prefixes are k - 1 longer. A rare token of a prefix is indexed alone. Where a prefix reaches into frequent tokens, it
   is extended and its frequent tokens are indexed in combinations of two: hashed into g cells, k = g + 1 common tokens
   must put two into one cell, so only pairs within a cell are needed, and their number stays in proportion to the set.
   g follows the larger set's size class; a smaller set that may have partners in the next class is indexed under both.
3. Some rounds join large groups of near copies in linear time. Classes that have one of their least tokens in common
   are paired with one of them, the round's pivot, unless they are in its component already. The pivot is a set whose
   tokens are nearly all frequent: what its copies were made from rather than one of them. Pairs that meet in several
   tokens are verified on the whole sets, and the links make components. These rounds may miss any link.
4. Then the pairs of one entry whose classes are still in different components are candidates. A pair with a rare token
   in common meets there, so one that meets in a combination need only be looked at if the frequent tokens of either set
   would do alone, less those that ``BITS`` marks of its frequent tokens show to be absent from the other: copies of one text
   with too many words of their own never meet. Of pairs that meet in rare tokens,
   their number, with all that either set has beyond its indexed ones, bounds what they have in common. Those that can
   reach the similarity are verified. No link between components is lost, and pairs inside one add nothing. The
   components of all links are the result.

The order of tokens only decides how much there is to do; any order gives the same links.

Edge cases: null, empty and word-free texts have no shingles and are alone; texts of fewer than ``SHINGLE`` words are one
shingle; repeated rows are linked; a null id takes part and its component's id is the least id that is not null;
an empty table gives an empty result; extra columns stay in a struct.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tableflow.llm import texts as X
from tableflow.llm.components import components
from tableflow.session import pinned

SHINGLE = 5
#: Least similarity in hundredths.
LEAST = 80
RARE = 12
#: The frequent tokens that tasks are told of: 16 MB. Of more, the commonest; a token beyond is as common as the last of these
#: at most, and is indexed alone.
MOST_FREQUENT = 2_000_000
TOKENS_PER_RANGE = 1_000_000
#: With more hash ranges than this, tokens are counted by a plain aggregate: pieces of runs would be too small.
MOST_RANGES = 2_000
CELL = 16
FIRST_KEYS = 8
#: Marks of the frequent tokens of a set, as 64-bit words. A mark that the other set lacks is a token that it lacks.
BITS = 256
_MARKS = [f"mark{i}" for i in range(BITS // 64)]
#: Of these, how many must meet for a pair with a pivot.
MEETINGS = 3
ROUNDS = 3
#: Classes whose texts are picked by sending their keys to all tasks; more are joined by a shuffle.
MOST_SENT = 1_000_000


def least_overlap(n):
    """What a set of n tokens must have in common with any smaller partner."""
    return -(-LEAST * n // 100)


def least_overlap_above(n):
    """What a set of n tokens must have in common with any larger partner."""
    return -(-2 * LEAST * n // (100 + LEAST))


def sets(c: X.Chunk) -> Iterator[np.ndarray]:
    """Sorted distinct shingle hashes of each text of the chunk."""
    c.lower()
    c.words(X.SPACED)
    c.word_hashes()
    at, h = c.ngrams(SHINGLE)
    n = np.diff(c.first)
    edge = np.searchsorted(at, c.first)
    for d in range(c.n):
        if n[d] >= SHINGLE:
            yield np.unique(h[edge[d] : edge[d + 1]])
        elif n[d]:
            own = np.full(1, np.uint64(n[d]))
            for w in c.wh[c.first[d] : c.first[d + 1]]:
                own = own * X._STEP + w
            yield X.mix(own)
        else:
            yield np.zeros(0, np.uint64)


def _fresh(batches, seen: set[int]) -> Iterator[tuple[int, np.ndarray]]:
    """(class, set) of texts whose class this task has not had yet. Batches hold class, text."""
    for batch in batches:
        keys = batch.column(0).to_pylist()
        new = [i for i, k in enumerate(keys) if not (k in seen or seen.add(k))]
        if not new:
            continue
        texts = batch.column(1).take(pa.array(new))
        for i, _, c in X.chunks(texts):
            for d, s in enumerate(sets(c)):
                if len(s):
                    yield keys[new[i + d]], s


def _packed(tokens: np.ndarray, counts: np.ndarray, ranges: int, bits: int = 64) -> Iterator[tuple[int, bytes]]:
    """Sorted tokens by hash range: how many, first token, differences in 1 to 8 bytes each, counts as a sparse list."""
    bound = np.searchsorted(tokens, (np.arange(1, ranges, dtype=np.float64) * (2.0**bits / ranges)).astype(np.uint64))
    for r, (a, b) in enumerate(zip([0, *bound.tolist()], [*bound.tolist(), len(tokens)], strict=True)):
        if a == b:
            continue
        gap = np.diff(tokens[a:b])
        width = 1
        while width < 8 and len(gap) and int(np.quantile(gap, 0.999)) >> (8 * width):
            width += 1
        top = np.uint64((1 << (8 * width)) - 1) if width < 8 else np.uint64(0xFFFFFFFFFFFFFFFF)
        wide = np.flatnonzero(gap >= top)  # written in full beside the others
        small = np.where(gap >= top, top, gap).astype("<u8").view(np.uint8).reshape(-1, 8)[:, :width]
        many = np.flatnonzero(counts[a:b] > 1)
        head = np.array([b - a, tokens[a], width, len(wide), len(many)], "<u8")
        yield r, b"".join((
            head.tobytes(), small.tobytes(), wide.astype("<u4").tobytes(), gap[wide].astype("<u8").tobytes(),
            many.astype("<u4").tobytes(), counts[a:b][many].astype("<u4").tobytes(),
        ))


def _unpacked(blob: bytes) -> tuple[np.ndarray, np.ndarray]:
    n, first, width, n_wide, n_many = (int(v) for v in np.frombuffer(blob, "<u8", 5))
    at = 40
    small = np.zeros((n - 1, 8), np.uint8)
    small[:, :width] = np.frombuffer(blob, np.uint8, (n - 1) * width, at).reshape(n - 1, width)
    at += (n - 1) * width
    gap = small.reshape(-1).view("<u8").astype(np.uint64)
    wide = np.frombuffer(blob, "<u4", n_wide, at)
    at += 4 * n_wide
    gap[wide] = np.frombuffer(blob, "<u8", n_wide, at)
    at += 8 * n_wide
    many = np.frombuffer(blob, "<u4", n_many, at)
    counts = np.ones(n, np.int64)
    counts[many] = np.frombuffer(blob, "<u4", n_many, at + 4 * n_many)
    return np.cumsum(np.concatenate([np.array([first], np.uint64), gap])), counts


def _summed(tokens: list[np.ndarray], counts: list[np.ndarray]) -> tuple[np.ndarray, np.ndarray]:
    t, c = np.concatenate(tokens), np.concatenate(counts)
    order = np.argsort(t, kind="stable")
    t, c = t[order], c[order]
    at = np.flatnonzero(np.append(True, t[1:] != t[:-1])) if len(t) else np.zeros(0, np.int64)
    return t[at], np.add.reduceat(c, at) if len(t) else c


class Common:
    """The frequent tokens, sorted, by their leading bits."""

    def __init__(self, tokens: np.ndarray, shift: int):
        self.tokens, self.shift = tokens, np.uint64(shift)

    def among(self, s: np.ndarray) -> np.ndarray:
        if not len(self.tokens):
            return np.zeros(len(s), bool)
        lead = s >> self.shift
        at = np.searchsorted(self.tokens, lead)
        at[at == len(self.tokens)] = 0
        return self.tokens[at] == lead


def frequent(classes: DataFrame, n_bytes: int, rare: int = RARE) -> Common:
    """Tokens of more than ``rare`` classes, the ``MOST_FREQUENT`` commonest if there are more.

    Tokens are counted by as many leading bits as keep nearly all of them apart, 40 at least; two that agree on these
    are frequent together, which costs a little work and changes no link.
    """
    ranges = max(1, n_bytes // 6 // TOKENS_PER_RANGE)
    bits = min(64, max(40, (n_bytes // 6).bit_length() + 12))
    shift = 64 - bits

    def send(batches):
        seen: set[int] = set()
        tokens, size = [], 0

        def flush():
            t, c = np.unique(np.concatenate(tokens), return_counts=True)
            got = list(_packed(t, c, ranges, bits))
            return pa.RecordBatch.from_pydict({
                "range": pa.array([r for r, _ in got], pa.int32()), "blob": pa.array([b for _, b in got], pa.binary())
            })

        for _, s in _fresh(batches, seen):
            tokens.append(s >> np.uint64(shift))
            size += len(s)
            if size > TOKENS_PER_RANGE:
                yield flush()
                tokens, size = [], 0
        if tokens:
            yield flush()

    def add(blobs):
        tokens, counts, size = [], [], 0
        for b in blobs:
            for blob in b.column("blob").to_pylist():
                t, c = _unpacked(blob)
                tokens.append(t)
                counts.append(c)
                size += len(t)
            if size > TOKENS_PER_RANGE:
                t, c = _summed(tokens, counts)
                tokens, counts, size = [t], [c], 0
        t, c = _summed(tokens, counts)
        some = c > rare
        yield pa.RecordBatch.from_arrays([pa.array(t[some].view(np.int64)), pa.array(c[some])], names=["token", "n"])

    def each(batches):
        for _, s in _fresh(batches, set()):
            yield pa.RecordBatch.from_arrays([pa.array((s >> np.uint64(shift)).view(np.int64))], names=["token"])

    if ranges <= MOST_RANGES:
        sent = classes.mapInArrow(send, "range int, blob binary")
        found = sent.groupBy("range").applyInArrow(_iterated(add), "token long, n long")
    else:
        found = classes.mapInArrow(each, "token long").groupBy("token").agg(F.count(F.lit(1)).alias("n")).where(F.col("n") > rare)
    found = pinned(found, "jaccard_frequent")
    if found.count() > MOST_FREQUENT:
        found = found.orderBy(F.desc("n"), "token").limit(MOST_FREQUENT)
    return Common(np.sort(found.select("token").toArrow().column(0).to_numpy().view(np.uint64)), shift)


def _iterated(f):
    def run(table: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        yield from f(table)

    return run


def _combinations(often: np.ndarray, prefix: int, size: int) -> list[np.ndarray]:
    """Combinations of two of the frequent tokens of a prefix, extended by one token for each cell of a size class."""
    cells = max(1, (1 << (size - 1)) // CELL)
    mine = often[: prefix + cells]
    cell = X.mix(mine ^ np.uint64(size)) % np.uint64(cells)
    order = np.argsort(cell, kind="stable")
    mine, cell = mine[order], cell[order]
    pairs = []
    for step in range(1, len(mine)):
        same = cell[step:] == cell[:-step]
        if not same.any():
            break
        a, b = mine[:-step][same], mine[step:][same]
        lo, hi = np.minimum(a, b), np.maximum(a, b)
        pairs.append(X.mix(lo * X._STEP + X.mix(hi + np.uint64(size))))
    return pairs


class Keys:
    """Index keys of a sorted set: ``rare`` tokens of its prefix as the larger set, the first ``small`` of them as the smaller
    one, ``below`` and ``above``, its combinations as the smaller and as the larger set; how many tokens are frequent, and their
    marks."""

    def __init__(self, s: np.ndarray, common: Common):
        n, is_often = len(s), common.among(s)
        rare, often = s[~is_often], s[is_often]
        self.often = len(often)
        bit = np.unique(X.mix(often + np.uint64(BITS)) % np.uint64(BITS))
        word = np.arange(BITS // 64)[:, None] == (bit >> np.uint64(6)).astype(np.int64)[None, :]
        self.marks = np.where(word, np.uint64(1) << (bit & np.uint64(63)), np.uint64(0)).sum(1, dtype=np.uint64)
        if n == 1:  # alike only to itself, and no combination can be made of it
            self.rare, self.small, self.below, self.above = s.copy(), 1, s[:0], s[:0]
            return
        smaller, larger = n - least_overlap_above(n) + 1, n - least_overlap(n) + 1
        self.rare, self.small = rare[:larger].copy(), min(smaller, len(rare))
        below, above = [], []
        if len(rare) < smaller:
            for size in sorted({n.bit_length(), (100 * n // LEAST).bit_length()}):
                below += _combinations(often, smaller - len(rare), size)
        if len(rare) < larger:
            above = _combinations(often, larger - len(rare), n.bit_length())
        self.below = np.unique(np.concatenate(below)) if below else s[:0]
        self.above = np.unique(np.concatenate(above)) if above else s[:0]


def indexed(classes: DataFrame, common: Common) -> DataFrame:
    """cls, n, the keys of each class, its least tokens, and how many of its tokens are frequent (``often``).

    A class may have several equal rows, one from each task that met it.
    """
    sent = classes.sparkSession.sparkContext.broadcast((common.tokens, int(common.shift)))
    names = ["cls", "n", "often", "small", "rare", "below", "above", "first", "marks"]

    def run(batches):
        known = Common(*sent.value)
        rows, size = [], 0

        def flush():
            cls, n, often, small, *lists = zip(*rows, strict=True)
            numbers = [pa.array(cls, pa.int64()), pa.array(n, pa.int32()), pa.array(often, pa.int32()), pa.array(small, pa.int32())]
            return pa.RecordBatch.from_arrays([*numbers, *[_lists(x) for x in lists]], names=names)

        for cls, s in _fresh(batches, set()):
            k = Keys(s, known)
            rows.append((cls, len(s), k.often, k.small, k.rare, k.below, k.above, s[:FIRST_KEYS].copy(), k.marks))  # a view would keep the whole set
            size += len(k.rare) + len(k.below) + len(k.above)
            if size > 250_000:
                yield flush()
                rows, size = [], 0
        if rows:
            yield flush()

    out = pinned(
        classes.mapInArrow(run, "cls long, n int, often int, small int, rare array<long>, below array<long>, above array<long>, first array<long>, "
                           "marks array<long>"),
        "jaccard_index",
    )
    sent.destroy()
    return out


def postings(index: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Rows of single tokens and of combinations that two classes or more have, written.

    Both have key, cls, n and ``role`` (0 as the smaller set, 1 as the larger); single tokens also ``rest``, how many tokens of
    the set are not among its single keys of that role, and combinations ``often`` and the marks.
    """
    at = index.select(F.posexplode("rare").alias("pos", "key"), "cls", "n", "small", F.size("rare").alias("m"))
    w = Window.partitionBy("key")  # rare tokens: about RARE rows
    at = at.withColumn("lo", F.min("cls").over(w)).withColumn("hi", F.max("cls").over(w)).where("lo < hi").drop("lo", "hi")
    one = at.select("key", "cls", "n", F.inline(F.expr(
        "if(pos < small, array(struct(0 as role, n - small as rest), struct(1 as role, n - m as rest)), array(struct(1 as role, n - m as rest)))")))
    two = index.where("size(below) > 0 or size(above) > 0").select("cls", "n", "often", *[
        F.col("marks")[i].alias(m) for i, m in enumerate(_MARKS)], F.inline(F.expr(
        "concat(transform(below, k -> struct(k as key, 0 as role)), transform(above, k -> struct(k as key, 1 as role)))")))
    many = two.groupBy("key").agg(
        F.min("cls").alias("lo"), F.max("cls").alias("hi"), F.min("role").alias("r0"), F.max("role").alias("r1")
    ).where("lo < hi and r0 < r1").select("key")
    many = pinned(many, "jaccard_keys")
    return pinned(one.distinct(), "jaccard_singles"), pinned(two.join(many, "key").distinct(), "jaccard_pairs")


def _lists(arrays: list[np.ndarray]) -> pa.Array:
    offsets = np.append(0, np.cumsum([len(a) for a in arrays])).astype(np.int32)
    flat = np.concatenate(arrays).view(np.int64) if arrays else np.zeros(0, np.int64)
    return pa.ListArray.from_arrays(offsets, flat)


def _fits():
    """Whether the sizes n and m allow the similarity."""
    return (F.col("n") * 100 >= F.col("m") * LEAST) & (F.col("m") * 100 >= F.col("n") * LEAST)


def pivot_pairs(posts: DataFrame, root: DataFrame | None, turn: int) -> DataFrame:
    """Classes that meet a pivot of another component in several of their least tokens.

    A token's pivot is the class with most of its tokens frequent and, of these, of greatest hash for this ``turn``, so one
    class is the pivot of most tokens of its group.
    """
    if root is None:
        p = posts.withColumn("root", F.col("cls"))
    else:
        p = posts.join(root, posts.cls == root.node, "left").select("key", "cls", "n", "share", F.coalesce("root", "cls").alias("root"))
    lead = F.max(F.struct("share", F.xxhash64("cls", F.lit(turn)).alias("h"), "cls", "n", "root")).alias("lead")
    ends = p.groupBy("key").agg(lead, F.min("root").alias("lo"), F.max("root").alias("hi")).where("lo < hi")
    ends = pinned(ends.select("key", F.col("lead.cls").alias("other"), F.col("lead.n").alias("m"), F.col("lead.root").alias("root2")), "jaccard_pivots")
    p = p.join(ends, "key").where(_fits() & (F.col("root") != F.col("root2")))
    p = p.groupBy(F.least("cls", "other").alias("a"), F.greatest("cls", "other").alias("b")).agg(
        F.count(F.lit(1)).alias("met"), F.max(F.least("n", "m")).alias("n")
    )
    return p.where(F.col("met") >= F.least(F.lit(MEETINGS), F.col("n"))).select("a", "b")


def cross_pairs(singles: DataFrame, pairs: DataFrame, root: DataFrame) -> DataFrame:
    """The pairs of one key in different components that can have enough in common, smaller set to larger one."""

    def mixed(posts: DataFrame, extra: str, marks: list[str]) -> tuple[DataFrame, DataFrame]:
        """Postings of keys with both roles in different components, as the smaller and as the larger side."""
        p = posts.join(root, posts.cls == root.node, "left").select("key", "cls", "n", "role", extra, *marks, F.coalesce("root", "cls").alias("root"))
        ends = p.groupBy("key").agg(
            F.min("root").alias("lo"), F.max("root").alias("hi"), F.min("role").alias("r0"), F.max("role").alias("r1"))
        keys = pinned(ends.where("lo < hi and r0 < r1").select("key"), "jaccard_keys")
        p = pinned(p.join(keys, "key"), "jaccard_mixed")
        larger = p.where("role = 1").select("key", F.col("cls").alias("other"), F.col("n").alias("m"), F.col(extra).alias("extra2"), *[
            F.col(m).alias(f"{m}b") for m in marks], F.col("root").alias("root2"))
        return p.where("role = 0").withColumnRenamed(extra, "extra"), larger

    def meet(p: DataFrame, q: DataFrame, more=F.lit(True)) -> DataFrame:
        order = F.struct(p.n, p.cls) < F.struct(q.m, q.other)
        return p.join(q, (p.key == q.key) & order & (p.root != q.root2) & (p.n * 100 >= q.m * LEAST) & more)

    both = (F.col("n") + F.col("m")) * LEAST
    p, q = mixed(singles, "rest", [])
    one = meet(p, q).groupBy(F.col("cls").alias("a"), F.col("other").alias("b")).agg(
        F.count(F.lit(1)).alias("c"), F.max("n").alias("n"), F.max("m").alias("m"), F.max(F.greatest("extra", "extra2")).alias("rest")
    )
    # All common tokens up to the end of the shorter reaching index are counted; beyond it there are ``rest`` at most.
    one = one.where((F.col("c") + F.col("rest")) * (100 + LEAST) >= both).select("a", "b")
    p, q = mixed(pairs, "often", _MARKS)
    # With no rare token in common, only frequent ones are left, less those whose mark the other set has not.
    lacks = [sum(F.bit_count(x.bitwiseAND(F.bitwise_not(y))) for x, y in sides) for sides in (
        [(p[m], q[f"{m}b"]) for m in _MARKS], [(q[f"{m}b"], p[m]) for m in _MARKS])]
    two = meet(p, q, F.least(p.extra - lacks[0], q.extra2 - lacks[1]) * (100 + LEAST) >= (p.n + q.m) * LEAST)
    return one.unionByName(two.select(F.col("cls").alias("a"), F.col("other").alias("b"))).distinct()


def links(pairs: DataFrame, classes: DataFrame) -> DataFrame:
    """The pairs whose sets are similar enough. Sets are made again from the texts of the classes in a pair."""
    pairs = pinned(pairs, "jaccard_candidates")
    wanted = pairs.select(F.col("a").alias("cls")).unionByName(pairs.select(F.col("b").alias("cls"))).distinct()

    def run(batches):
        for batch in batches:
            keys, out = batch.column(0), []
            for _, _, c in X.chunks(batch.column(1)):
                out.extend(sets(c))
                if sum(map(len, out)) > 250_000:
                    yield pa.RecordBatch.from_arrays([keys[: len(out)], _lists(out)], names=["cls", "tokens"])
                    keys, out = keys[len(out) :], []
            if out:
                yield pa.RecordBatch.from_arrays([keys, _lists(out)], names=["cls", "tokens"])

    wanted = pinned(wanted, "jaccard_wanted")
    if wanted.count() <= MOST_SENT:  # 8 MB
        wanted = F.broadcast(wanted)
    texts = classes.join(wanted, "cls").groupBy("cls").agg(F.first("text").alias("text"))
    whole = pinned(texts.mapInArrow(run, "cls long, tokens array<long>"), "jaccard_sets")
    x = pairs.join(whole.select(F.col("cls").alias("a"), F.col("tokens").alias("x")), "a")
    xy = x.join(whole.select(F.col("cls").alias("b"), F.col("tokens").alias("y")), "b")
    o = F.size(F.array_intersect("x", "y"))
    return xy.where(o * 100 >= (F.size("x") + F.size("y") - o) * LEAST).select("a", "b")


def linked(classes: DataFrame, index: DataFrame) -> DataFrame:
    """cls and root of every class that is linked with another."""
    posts = index.select(F.explode("first").alias("key"), "cls", "n", (F.col("often") / F.col("n")).alias("share")).distinct()
    found, root = None, None
    for turn in range(ROUNDS):
        new = pinned(links(pivot_pairs(posts, root, turn), classes), "jaccard_links")
        if found is not None and new.isEmpty():
            break
        found = new if found is None else found.unionByName(new)
        root = pinned(components(found), "jaccard_roots")
    last = links(cross_pairs(*postings(index), root), classes)
    return components(found.unionByName(last)).select(F.col("node").alias("cls"), "root")


def grouped(docs: DataFrame, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """id, cls (hash of the text), n_shingles, component_id and ``chosen`` (one row of each component) of every row."""
    body = F.col(f"`{text}`")
    rows = docs.select(F.col(f"`{doc_id}`").alias("id"), F.xxhash64(body).alias("cls"))
    rows = pinned(rows.withColumn("uid", F.monotonically_increasing_id()), "jaccard_rows")
    classes = X.small_batches(docs.where(body.isNotNull()).select(F.xxhash64(body).alias("cls"), body.alias("text")))
    n_bytes = docs.agg(F.sum(F.octet_length(body))).first()[0] or 0
    index = indexed(classes, frequent(classes, n_bytes))
    sizes = index.select("cls", "n").distinct()
    rows = rows.join(sizes, "cls", "left").join(linked(classes, index), "cls", "left")
    alone = F.col("n").isNull()  # without words
    rows = rows.withColumn("grp", F.struct(alone.alias("alone"), F.when(alone, F.col("uid")).otherwise(F.coalesce("root", "cls")).alias("of")))
    least = rows.groupBy("grp").agg(F.min("id").alias("component_id"), F.min(F.struct("id", "uid")).alias("first"))
    return rows.join(least, "grp").select(
        "id", "cls", F.coalesce("n", F.lit(0)).cast("long").alias("n_shingles"), "component_id", (F.col("uid") == F.col("first.uid")).alias("chosen"),
    )


def digest(docs: DataFrame) -> DataFrame:
    return grouped(docs).select(F.col("id").alias("doc_id"), "n_shingles", "component_id")


def one_of_each(docs: DataFrame, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """One document of each component (the least id; null before any), with its own columns.

    Rows without words stay, each of them. Of rows with equal id and text one stays.
    The rows that go are few and narrow, so documents are filtered where they are read; only beyond ``MOST_SENT`` of them,
    and for rows that repeat id and text, documents are shuffled.
    """
    rows = pinned(grouped(docs, doc_id, text).where("n_shingles > 0").select("id", "cls", "chosen"), "jaccard_chosen")
    each = rows.groupBy("id", "cls").agg(F.max("chosen").alias("stays"), F.count(F.lit(1)).alias("m"))
    other = pinned(each.where("not stays or m > 1").select("id", "cls", "stays"), "jaccard_other")
    if other.count() <= MOST_SENT:  # 17 MB
        other = F.broadcast(other)
    body = F.col(f"`{text}`")
    d = docs.select(
        F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("doc"), F.col(f"`{doc_id}`").alias("_id"), F.xxhash64(body).alias("_cls"),
        F.coalesce(body.rlike("[^\\x20\\x09-\\x0D]"), F.lit(False)).alias("_wordy"),
    )
    same = F.col("_wordy") & (F.col("_cls") == F.col("cls")) & F.col("_id").eqNullSafe(F.col("id"))
    single = d.join(other.select("id", "cls"), same, "left_anti").select("doc")
    repeated = d.join(other.where("stays").select("id", "cls"), same, "left_semi").dropDuplicates(["_cls", "_id"]).select("doc")
    return single.unionByName(repeated).select(*[F.col(f"doc.`{c}`") for c in docs.columns])
