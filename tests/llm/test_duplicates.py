import random

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from tableflow.llm import components, jaccard_join, queries, suffix_dedup
from tests.llm import brute

SF = "/root/testdata/sf0.01"
DOC = "doc_id long, text string, cls string, root string, s int, doc string"


def table(spark, rows):
    return spark.createDataFrame([(i, t, "c", "c", 0, "c") for i, t in rows], DOC)


def words(rng, n, many=5000):
    return [f"w{rng.randrange(many)}" for _ in range(n)]


def near_copies(seed=0):
    """Groups of near copies, chains, shared passages, and odd rows."""
    rng = random.Random(seed)
    passage = words(rng, 60)
    texts = [None, "", " \n", "a b c", "A b  c", "one", "one", "a b c d e", "a b c d e f", "x " * 3000, "x " * 4000]
    for _ in range(12):
        base = words(rng, rng.choice([7, 20, 80, 300, 900]))
        for _ in range(rng.choice([2, 5, 30])):
            w = list(base)
            for _ in range(rng.choice([0, 1, 1, 2, 3])):
                w[rng.randrange(len(w))] = "edit%d" % rng.randrange(10**6)
            texts.append(" ".join(w))
    base = words(rng, 200)
    for i in range(40):  # a chain: neighbours are alike, its ends are not
        base[i * 4] = f"step{i}"
        texts.append(" ".join(base))
    for _ in range(120):
        w = words(rng, rng.choice([3, 10, 100]), 10**6)
        at = rng.randrange(len(w))
        texts.append(" ".join(w[:at] + passage + w[at:]))
    rng.shuffle(texts)
    return [(i if i % 50 else None, t) for i, t in enumerate(texts)] + [(7, texts[7]), (8, "other text with the same id as one")]


def norm(rows):
    return sorted(map(str, map(tuple, rows)))


def test_components_match_brute_force(spark):
    docs = brute.rows(SF, "documents")
    want = brute.jaccard_components([(d["doc_id"], d["text"]) for d in docs])
    assert len({r[2] for r in want}) < len(want)
    assert norm(queries.op6_combination_prefixes(spark, SF).collect()) == norm(want)


@pytest.mark.parametrize("rare, turns", [(12, 3), (2, 1), (0, 2)])
def test_components_of_hard_groups(spark, monkeypatch, rare, turns):
    """Any number of frequent tokens and any first round give the same components."""
    monkeypatch.setattr(jaccard_join, "ROUNDS", turns)
    monkeypatch.setattr(jaccard_join, "MOST_SENT", rare * 10)
    monkeypatch.setattr(jaccard_join, "MOST_RANGES", turns - 1)
    real = jaccard_join.frequent
    monkeypatch.setattr(jaccard_join, "frequent", lambda c, n: real(c, n, rare))
    rows = near_copies(rare)
    assert norm(jaccard_join.digest(table(spark, rows)).collect()) == norm(brute.jaccard_components(rows))


def test_one_document_of_each_component(spark):
    rows = near_copies(3)
    df = table(spark, rows)
    got = jaccard_join.one_of_each(df)
    assert got.columns == df.columns
    comps = brute.jaccard_components(rows)
    # Rows without words, and components of null ids only, have no least id to count by.
    n = len({c for _, k, c in comps if k and c is not None}) + sum(not k for _, k, _ in comps)
    assert n <= got.count() <= n + sum(c is None for _, _, c in comps)
    assert jaccard_join.digest(table(spark, [])).count() == 0


@settings(max_examples=200, deadline=None)
@given(st.integers(5, 200), st.integers(0, 40), st.integers(0, 3), st.randoms())
def test_similar_sets_share_a_key(n, changed, common_part, rnd):
    x = {rnd.getrandbits(64) for _ in range(n)}
    y = set(x)
    for t in rnd.sample(sorted(x), min(changed, len(x))):
        y.discard(t)
        if rnd.random() < 0.5:
            y.add(rnd.getrandbits(64))
    if not y or 100 * len(x & y) < 80 * len(x | y):
        return
    pool = sorted(x | y)
    common = np.array(sorted(rnd.sample(pool, len(pool) * common_part // 3)), np.uint64)
    common = jaccard_join.Common(common, 0)
    sets = sorted((x, y), key=len)
    for small, large in (sets, sets[::-1]) if len(x) == len(y) else (sets,):
        a, b = (jaccard_join.Keys(np.array(sorted(s), np.uint64), common) for s in (small, large))
        assert set(a.rare[: a.small].tolist()) & set(b.rare.tolist()) or set(a.below.tolist()) & set(b.above.tolist())


@settings(max_examples=100, deadline=None)
@given(st.lists(st.integers(0, 2**64 - 1), min_size=1, max_size=50, unique=True), st.integers(1, 9))
def test_packed_tokens(values, ranges):
    t = np.array(sorted(values), np.uint64)
    c = (t % np.uint64(5) + np.uint64(1)).astype(np.int64)
    got = [jaccard_join._unpacked(b) for _, b in jaccard_join._packed(t, c, ranges)]
    assert np.concatenate([g[0] for g in got]).tolist() == t.tolist()
    assert np.concatenate([g[1] for g in got]).tolist() == c.tolist()


def test_connected_components(spark):
    rng = random.Random(4)
    edges = [(rng.randrange(300), rng.randrange(300)) for _ in range(220)] + [(i, i + 1) for i in range(400, 600)] + [(1, 1)]
    got = dict(map(tuple, components.components(spark.createDataFrame(edges, "a long, b long")).collect()))
    root = {}

    def find(i):
        while root.setdefault(i, i) != i:
            i = root[i]
        return i

    for a, b in edges:
        if a != b:
            x, y = sorted((find(a), find(b)))
            root[y] = x
    assert got == {i: find(i) for i in root}


def test_repeats_match_brute_force(spark):
    docs = brute.rows(SF, "documents")
    want = brute.without_repeats([d["text"] for d in docs])
    assert any(w[1] for w in want)
    got = queries.op4_suffix_merge_sort(spark, SF).collect()
    assert norm(got) == norm((d["doc_id"], *w) for d, w in zip(docs, want, strict=True))


def repeats(seed):
    rng = random.Random(seed)
    text = lambda n: " ".join(words(rng, n, 10**6))
    p, q = text(120), text(70)
    out = [None, "", "z" * 399, "z" * 400, "z" * 5000, "ab" * 1500, "é" * 900, p[:399], p[:400], p, p, p + q, q + p]
    for _ in range(60):  # a passage in different surroundings, cut at different places
        a, b = sorted((rng.randrange(len(p)), rng.randrange(len(p))))
        out.append(text(30) + p[a:b] + text(rng.randrange(1, 60)))
    base = text(600)
    for _ in range(25):  # near copies
        w = list(base)
        for _ in range(rng.randrange(4)):
            w[rng.randrange(len(w))] = "#"
        out.append("".join(w))
    out.append(text(40) + q + text(3) + q + text(100) + q[5:] + "é😀")
    return [(i if i % 9 else 1, t) for i, t in enumerate(out)]


@pytest.mark.parametrize("range_bytes", [24 << 20, 20_000])
def test_repeats_of_hard_texts(spark, monkeypatch, range_bytes):
    """One range, and so many that splitters cut groups."""
    monkeypatch.setattr(suffix_dedup, "RANGE_BYTES", range_bytes)
    rows = repeats(range_bytes)
    want = [(i, *w) for (i, _), w in zip(rows, brute.without_repeats([t for _, t in rows]), strict=True)]
    assert norm(suffix_dedup.digest(table(spark, rows)).collect()) == norm(want)
    assert suffix_dedup.digest(table(spark, [])).count() == 0


def sent_rows(df):
    """Rows that each shuffle of a query wrote, after it ran."""
    df.collect()
    todo, out = [df._jdf.queryExecution().executedPlan()], []
    while todo:
        node = todo.pop()
        kind = node.getClass().getSimpleName()
        if kind == "ShuffleExchangeExec":
            out.append(node.metrics().apply("shuffleRecordsWritten").value())
        if kind == "AdaptiveSparkPlanExec":
            todo.append(node.executedPlan())
        elif kind.endswith("QueryStageExec"):
            todo.append(node.plan())
        todo += [node.children().apply(i) for i in range(node.children().size())]
    return out


def test_copies_meet_before_texts_are_shuffled(spark, tmp_path, monkeypatch):
    """4,000 copies of one text in 4 tasks send 4 rows where texts travel, not 4,000 to one task."""
    p = "".join(random.Random(3).choices("abcdef ", k=900))
    rows = [(i, p) for i in range(4000)] + [(i, f"{i} " * 150 + p[:500]) for i in range(4000, 4020)]
    table(spark, rows).repartition(4).write.parquet(str(tmp_path / "docs"))
    docs = spark.read.parquet(str(tmp_path / "docs"))
    seen, real = [], suffix_dedup._runs

    def runs(reps, splitters):
        seen.append(reps)
        return real(reps, splitters)

    monkeypatch.setattr(suffix_dedup, "_runs", runs)
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")  # as for large tables
    try:
        got = {r.doc_id: r.n_removed for r in suffix_dedup.digest(docs).collect()}
        sent = sent_rows(seen[0])
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
    assert got == {i: len(p) if i < 4000 else 1250 for i in range(4020)}
    assert max(sent) < 200


@settings(max_examples=200, deadline=None)
@given(st.lists(st.lists(st.binary(max_size=6).map(lambda b: bytes(x % 3 for x in b)), max_size=8), max_size=6))
def test_loser_tree(runs):
    tail = bytes(suffix_dedup.TAIL)
    coded = [suffix_dedup.run_items(suffix_dedup.front_coded([(s, tail) for s in sorted(r)])) for r in runs]
    got = list(suffix_dedup.merged(coded))
    want = sorted(s for r in runs for s in r)
    assert [s for _, s, _ in got] == want
    for (_, a, _), (h, b, _) in zip(got, got[1:], strict=False):
        k = 0
        while k < min(len(a), len(b)) and a[k] == b[k]:
            k += 1
        assert h == k


def test_marks_never_deny_a_common_token():
    rng = np.random.default_rng(4)
    for n in (3, 40, 400, 4000):
        pool = np.unique(rng.integers(0, 1 << 63, n * 2, dtype=np.uint64))
        common = jaccard_join.Common(pool, 0)
        x, y = (np.sort(rng.choice(pool, n, replace=False)) for _ in range(2))
        a, b = (jaccard_join.Keys(s, common) for s in (x, y))
        absent = sum(int(v).bit_count() for v in a.marks & ~b.marks)
        assert a.often == n and len(np.intersect1d(x, y)) <= n - absent
