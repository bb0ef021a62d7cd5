import math

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from tableflow.llm import embedding_dedup, queries, spelling, whitening
from tests.llm import brute

SF = "/root/testdata/sf0.01"
VECTORS = "vec_id long, embedding array<float>, label int, item long, vec string, whitened string"


def vectors(spark, rows):
    return spark.createDataFrame([(i, v, label, 5, "clash", "clash") for i, v, label in rows], VECTORS)


# ---- whitening ---------------------------------------------------------------------------------------------------


def covariance(x):
    u = np.unique(x, axis=0)
    centred = u - u.mean(0)
    return u, centred.T @ centred / len(u)


@pytest.mark.parametrize("dim, n", [(1, 4), (3, 9), (9, 60), (40, 300)])
def test_rank_one_updates_and_combination(dim, n):
    rng = np.random.default_rng(dim)
    x = np.floor(rng.normal(size=(n, dim)) * 20)
    if dim == 9:  # equal, constant and repeated directions are deflated
        x[:, 3], x[:, 5] = 2, x[:, 4]
        x[20:40] = x[:20]
    want = (x - x.mean(0)).T @ (x - x.mean(0))
    parts = []
    for half in (x[: n // 3], x[n // 3 :], x):
        s = whitening.Spectrum(dim)
        for row in half:
            s.add(row)
        parts.append(s)
    parts[0].combine(parts[1].n, parts[1].mean, parts[1].values, parts[1].vectors)
    for s in (parts[0], parts[2]):
        assert np.allclose(s.vectors @ np.diag(s.values) @ s.vectors.T, want, rtol=0, atol=1e-10 * max(1, np.abs(want).max()))
        assert np.allclose(s.vectors.T @ s.vectors, np.eye(dim), atol=1e-11)
        assert np.allclose(s.mean, x.mean(0)) and s.n == n


@settings(max_examples=150, deadline=None)
@given(st.lists(st.floats(0, 100), min_size=1, max_size=6), st.lists(st.floats(-3, 3), min_size=6, max_size=6), st.floats(1e-6, 50))
def test_secular_equation(values, u, rho):
    values, u = np.sort(np.array(values)), np.array(u)[: len(values)]
    got, turned = whitening.rank_one(values, np.eye(len(values)), u, rho)
    want = np.linalg.eigvalsh(np.diag(values) + rho * np.outer(u, u))
    scale = max(1.0, np.abs(want).max())
    assert np.abs(got - want).max() <= 1e-11 * scale
    assert np.abs(turned @ np.diag(got) @ turned.T - np.diag(values) - rho * np.outer(u, u)).max() <= 1e-11 * scale


def test_whitening_whole_table(spark):
    rows = sorted((r["vec_id"], r["embedding"]) for r in brute.rows(SF, "embeddings"))
    x = np.floor(np.array([v for _, v in rows], np.float64) * 64).astype(np.int64) + 1_000_000
    u, v = covariance(x)
    n, sums = len(u), u.sum(0)
    values, components = np.linalg.eigh(v)
    values, components = values[::-1][:16], components[:, ::-1][:, :16]
    got = queries.op11_rank_one_whitening(spark, SF).toPandas().sort_values(["vec_id", "component"])
    assert got.vec_id.tolist() == [i for i, _ in rows for _ in range(16)] and got.component.tolist() == list(range(1, 17)) * len(rows)
    assert (got.n == n).all() and got.deviation.tolist() == np.repeat(((n * x - sums) ** 2).sum(1), 16).tolist()
    white = got.whitened.to_numpy().reshape(-1, 16)
    want = (x - sums / n) @ components / np.sqrt(values)
    sign = np.sign((white * want).sum(0))
    assert np.abs(white * sign - want).max() < 1e-9
    assert np.allclose(got.explained.to_numpy().reshape(-1, 16), values / np.trace(v), rtol=1e-10)
    assert got.identity_error.nunique() == 1 and got.identity_error.iloc[0] < 1e-10


def test_whitening_odd_rows(spark):
    nan, inf = float("nan"), float("inf")
    rows = [(1, None, 1), (2, [], 1), (3, [1.0, None], 1), (4, [nan, 1.0], 1), (5, [inf, 1.0], 1), (6, [1.0, 2.0, 3.0], 1),
            (7, [1.0, 5.0], 1), (7, [1.0, 5.0], 1), (None, [2.0, 5.0], None), (9, [4.0, 5.0], 1), (10, [-3.5, 5.0], 1)]
    got = whitening.digest(vectors(spark, rows)).collect()
    assert sorted(str(r.vec_id) for r in got) == sorted(str(i) for i in (7, 7, None, 9, 10) for _ in range(2))
    assert {r.n for r in got} == {4}
    first = [r for r in got if r.component == 1]
    assert abs(sum(r.whitened for r in {r.vec_id: r for r in first}.values())) < 1e-9
    assert all(r.whitened == 0 and r.explained == 0 for r in got if r.component == 2)  # the second entry never varies
    assert whitening.digest(vectors(spark, rows[:5])).count() == 0 and whitening.digest(vectors(spark, [])).count() == 0
    alone = whitening.digest(vectors(spark, [(1, [3.0], 0)])).collect()
    assert [(r.n, r.deviation, r.whitened) for r in alone] == [(1, 0, 0.0)]
    huge = whitening.digest(vectors(spark, [(1, [3e38], 0), (2, [0.0], 0)])).collect()
    assert all(r.deviation is None for r in huge) and sorted(round(r.whitened, 9) for r in huge) == [-1, 1]


# ---- near duplicates ---------------------------------------------------------------------------------------------


def bag(rows):
    return sorted(map(str, rows))


def test_near_vectors_whole_table(spark):
    rows = [(r["vec_id"], r["embedding"], r["label"]) for r in brute.rows(SF, "embeddings")]
    assert bag(map(tuple, queries.op12_collision_counting(spark, SF).collect())) == bag(brute.near_vectors(rows))


def clouds(seed):
    """Clouds of near vectors: tight, wide, overlapping, of equal vectors, and pairs at every cosine around the least."""
    rng = np.random.default_rng(seed)

    def unit(v):
        return v / np.linalg.norm(v)

    def around(c, off, n):
        return [unit(c + math.tan(off) * unit(rng.normal(size=24))) for _ in range(n)]

    a, b = unit(rng.normal(size=24)), unit(rng.normal(size=24))
    out = [(v, 1) for v in around(a, 0.08, 70) + around(b, 0.3, 50)]
    out += [(v, 2) for v in around(a, 0.1, 60) + around(unit(a + 0.3 * b), 0.1, 60) + around(unit(a + 0.25 * b), 0.02, 9)]
    out += [(v, 3) for v in around(a, 0.05, 40) for _ in range(2)]
    for i, c in enumerate(np.linspace(0.9, 0.96, 40)):
        x = unit(rng.normal(size=24))
        y = rng.normal(size=24)
        y = unit(y - (y @ x) * x)
        out += [(x, 4 + i % 2), (c * x + math.sqrt(1 - c * c) * y, 4 + i % 2)]
    out += [(unit(rng.normal(size=24)), int(rng.integers(1, 6))) for _ in range(300)]
    at = rng.permutation(len(out))
    return [(int(k), [float(e) for e in out[i][0] * rng.uniform(0.1, 9)], out[i][1]) for k, i in enumerate(at)]


@pytest.mark.parametrize("most_sent", [embedding_dedup.MOST_SENT, 0])
def test_clouds_and_balls(spark, most_sent):
    rows = clouds(3)
    df = vectors(spark, rows)
    stored = [(r.vec_id, r.embedding, r.label) for r in df.collect()]  # as 32-bit floats
    want = brute.near_vectors(stored)
    got = embedding_dedup.grouped(df, dense=16, most_sent=most_sent).collect()
    assert bag(map(tuple, got)) == bag(want)
    assert sum(r[1] > 0 for r in want) > 300


def test_recall_is_calibrated():
    for group in (10, 1_000, 10**6, 10**9):
        planes, tables, _ = embedding_dedup.calibrated(math.acos(0.93), group)
        p = (1 - math.acos(0.93) / math.pi) ** planes * math.erf(embedding_dedup.WINDOW / math.sqrt(2))
        hits = np.random.default_rng(1).binomial(tables, p, 200_000)
        assert (hits >= embedding_dedup.COUNT).mean() > 0.999
        assert group / 2**planes <= embedding_dedup.CELL


def test_near_vectors_odd_rows(spark):
    nan = float("nan")
    a = [1.0, 2.0, 3.0]
    rows = [(1, a, 1), (2, a, 1), (3, a, 2), (4, a, None), (5, None, 1), (6, [0.0, 0.0, 0.0], 1), (7, [nan, 1.0, 1.0], 1), (8, [None, 1.0, 1.0], 1),
            (9, [], 1), (10, [1.0, 2.0], 1), (None, a, 1), (None, a, 3), (2, a, 1), (12, [-1.0, -2.0, -3.0], 1), (13, [1e30, 2e30, 3e30], 1),
            (14, [1e-30, 2e-30, 3e-30], 1), (None, None, None), (15, [0.0, -0.0, 5.0], 7), (16, [-0.0, 0.0, 5.0], 7)]
    got = [tuple(r) for r in embedding_dedup.grouped(vectors(spark, rows)).collect()]
    want = [(i, n, c, kept if i is not None or c is not None else True) for i, n, c, kept in brute.near_vectors(rows)]
    assert bag(got) == bag(want)
    assert embedding_dedup.grouped(vectors(spark, [])).count() == 0


# ---- spelling ----------------------------------------------------------------------------------------------------


def test_spelling_whole_table(spark):
    docs = [(r["doc_id"], r["text"]) for r in brute.rows(SF, "documents")]
    want = brute.spelling(docs)
    assert bag(map(tuple, queries.op13_trie_node_pairs(spark, SF).collect())) == bag(want)
    assert sum(r[1] is not None for r in want) > 100


@pytest.mark.parametrize("per_part", [3, 50, 10**6])
def test_variants_over_many_ranges(spark, per_part):
    rng = np.random.default_rng(per_part)
    words = {"".join(rng.choice(list("abé"), rng.integers(7, 10))) for _ in range(250)} | {"a" * n for n in range(7, 14)} | {"x" * 3000, "x" * 2999, "x" * 1500 + "y" + "x" * 1499}
    n = {w: int(10 ** rng.uniform(0.4, 4)) for w in words}
    docs = [(None, " ".join([w] * n[w])) for w in sorted(n)]
    got = spelling.variants(spark.createDataFrame(list(n.items()), "word string, n long"), per_part)
    # By brute force over the words themselves: no letter goes astray here.
    near = {w: {v for v in words if one_edit(w, v)} for w in words}
    form = {}
    for w in words:
        best = min(near[w], key=lambda v: (-n[v], v), default=None)
        if best and n[best] >= 10 * n[w]:
            form[w] = best
    want = []
    for w in words:
        root = w
        while root in form:
            root = form[root]
        want.append((w, form.get(w), root, n[w], len(near[w]), n.get(form.get(w))))
    assert docs and bag(map(tuple, got.collect())) == bag(want)


def one_edit(a, b):
    if len(a) > len(b):
        a, b = b, a
    if len(b) - len(a) > 1 or a == b:
        return False
    i = spelling.shared(a, b)
    return a[i + 1 :] == b[i + 1 :] if len(a) == len(b) else a[i:] == b[i + 1 :]


@settings(max_examples=100, deadline=None)
@given(st.sets(st.text("abc", min_size=1, max_size=6), min_size=1, max_size=30), st.integers(1, 5))
def test_trie_numbers_name_beginnings(words, parts):
    words = sorted(words)
    cuts = [words[len(words) * i // parts : len(words) * (i + 1) // parts] for i in range(parts)]
    ranges = [(i, c) for i, c in enumerate(cuts) if c]
    known = spelling.homes([(i, c[0], c[-1]) for i, c in ranges])
    named, seen = {}, {}
    for i, c in ranges:
        for w, path in zip(c, spelling.path_numbers(c, i, known[i])):
            assert all(sum(v.startswith(w[: len(path)]) for v in words) == 1 for _ in [0]) or len(path) == len(w) + 1
            for depth, number in enumerate(path.tolist()):
                assert named.setdefault(number, w[:depth]) == w[:depth]
                assert seen.setdefault(w[:depth], number) == number


def test_spelling_odd_rows(spark):
    rows = [(1, None), (2, ""), (3, "short words only"), (None, "Calendar calendar CALENDAR"), (5, "calender calender " * 3), (5, "calender calender " * 3),
            (6, "ÀÉÎÕÜß÷× " * 5), (7, "q" * 50_000 + " " + "q" * 50_000), (8, "naïveté naïveté 日本語日本語日本語"), (9, "resuméresume re-started re-started")]
    df = spark.createDataFrame([(i, t, "clash", 1, 2) for i, t in rows], "doc_id long, text string, word string, n long, wid long")
    assert bag(map(tuple, spelling.digest(df).collect())) == bag(brute.spelling(rows))
    assert spelling.digest(df.limit(0)).count() == 0
