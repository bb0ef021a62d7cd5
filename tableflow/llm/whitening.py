"""Whitening of embeddings by an incremental eigendecomposition.

Entries become integers x, so the number of distinct vectors, their sums and every distance from the mean are exact. The
covariance of the distinct vectors is decomposed without ever being summed up as a matrix of all rows at once:

1. A task keeps count, mean, eigenvalues and eigenvectors of the scatter of its vectors. Each vector is centred on the mean so
   far and changes the scatter by one rank-one term, whose new eigenvalues are the roots of a secular equation. Directions
   that the term does not touch, and equal eigenvalues, are deflated.
2. Spectra of tasks are combined ``FANIN`` at a time, level by level: one rank-one term for the distance of the means and one for
   each eigenvector of the other.
3. Rounding of many updates is removed by a Rayleigh-Ritz step over all vectors: tasks sum the products of centred vectors in
   the basis found, a small symmetric matrix, and its eigenvectors turn the basis. The basis spans the whole space, so
   the result is exact to double precision whatever the updates lost.

The driver holds matrices of dimension x dimension; tasks hold these and a batch.

Edge cases: rows whose vector is null, empty, or has null or non-finite entries are dropped, and so are vectors of another length
than most have (of equally many, the longer); entries count as at most ``MOST`` / 64 in size. Repeated vectors count once in
the fit, repeated rows are all returned; a null id is kept. A component without variance is whitened to 0 and left out of the
identity's error. A deviation beyond 63 bits is null. An empty table gives an empty result. Other columns are not read.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tableflow.llm import texts as X
from tableflow.session import pinned

#: Fixed values of the contract.
SCALE, SHIFT, COMPONENTS = 64, 1_000_000, 16
MOST = 1e15
FANIN = 8
_EPS = np.finfo(np.float64).eps


def secular_roots(d: np.ndarray, z2: np.ndarray, rho: float) -> np.ndarray:
    """``gap[i, j] = d[i] - root[j]`` for the roots of 1 + rho * sum(z2 / (d - root)) = 0, one above each of the rising ``d``.

    A root is sought as its distance from the nearer pole, so small gaps keep all their digits. All roots step at once:
    the poles beside a root are kept in the model of the equation, and a step that leaves the root's bracket is replaced
    by a bisection.
    """
    k = len(d)
    right = np.append(d[1:], d[-1] + rho * z2.sum())
    width = right - d
    poles = d[:, None] - d[None, :]
    middle = 1 + rho * (z2[:, None] / (poles - width / 2)).sum(0)
    near_right = (middle < 0) & (np.arange(k) < k - 1)
    poles = poles - np.where(near_right, width, 0.0)  # d[i] - origin of root j
    lo = np.where(near_right, -width / 2, np.where(middle < 0, width / 2, 0.0))
    hi = np.where(near_right, 0.0, np.where(middle < 0, width, width / 2))
    mu = (lo + hi) / 2
    below = np.arange(k)[:, None] <= np.arange(k)[None, :]
    j = np.arange(k)
    after = np.minimum(j + 1, k - 1)
    for _ in range(80):
        gap = poles - mu
        terms = rho * z2[:, None] / gap
        slopes = terms / gap
        left, rest = np.where(below, terms, 0.0).sum(0), np.where(below, 0.0, terms).sum(0)
        f = 1 + left + rest
        lo, hi = np.where(f < 0, mu, lo), np.where(f < 0, hi, mu)
        done = (np.abs(f) <= 8 * k * _EPS * (1 + np.abs(left) + np.abs(rest))) | (hi - lo <= 2 * _EPS * np.maximum(np.abs(lo), np.abs(hi)))
        if done.all():
            break
        g0, g1 = gap[j, j], gap[after, j]
        s0, s1 = np.where(below, slopes, 0.0).sum(0), np.where(below, 0.0, slopes).sum(0)
        c = f - g0 * s0 - g1 * s1
        a = (g0 + g1) * f - g0 * g1 * (s0 + s1)
        b = g0 * g1 * f
        with np.errstate(all="ignore"):
            root = np.sqrt(np.maximum(a * a - 4 * b * c, 0.0))
            step = np.where(a <= 0, (a - root) / (2 * c), 2 * b / (a + root))
            step[-1] = g0[-1] + s0[-1] * g0[-1] ** 2 / c[-1]  # nothing lies above the last pole
        new = mu + step
        new = np.where(np.isfinite(new) & (new > lo) & (new < hi), new, (lo + hi) / 2)
        mu = np.where(done, mu, new)
    return poles - mu


def rank_one(values: np.ndarray, vectors: np.ndarray, u: np.ndarray, rho: float) -> tuple[np.ndarray, np.ndarray]:
    """Eigenvalues (rising) and eigenvectors of ``vectors diag(values) vectors' + rho u u'``."""
    z = vectors.T @ u
    size = float(np.sqrt(z @ z))
    if size == 0 or rho <= 0:
        return values, vectors
    z, rho = z / size, rho * size * size
    tol = 8 * _EPS * max(float(values[-1]), rho)
    live = rho * np.abs(z) > tol
    d, z = values.copy(), z.copy()
    # Of two eigenvalues that are as good as equal, one is turned out of the way of the term.
    last = -1
    for i in np.flatnonzero(live).tolist():
        if last >= 0:
            r = float(np.hypot(z[last], z[i]))
            c, s = z[i] / r, z[last] / r
            if abs((d[i] - d[last]) * c * s) <= tol:
                if vectors.base is not None or not vectors.flags.writeable:
                    vectors = vectors.copy()
                x, y = vectors[:, last].copy(), vectors[:, i].copy()
                vectors[:, last], vectors[:, i] = c * x - s * y, s * x + c * y
                d[last], d[i] = c * c * d[last] + s * s * d[i], s * s * d[last] + c * c * d[i]
                z[last], z[i], live[last] = 0.0, r, False
        last = i
    at = np.flatnonzero(live)
    at = at[np.argsort(d[at], kind="stable")]
    if not len(at):
        return d, vectors
    dk, zk = d[at], z[at]
    gap = secular_roots(dk, zk * zk, rho)  # dk[i] - root[j]
    # The term whose roots these are exactly; its vectors are orthogonal to working precision.
    k = len(at)
    shifted = np.where(np.arange(k)[None, :] < np.arange(k)[:, None], dk[None, :], np.append(dk[1:], 0.0)[None, :]) - dk[:, None]
    shifted[:, -1] = rho
    ratio = -gap / np.where(shifted == 0, 1.0, shifted)
    exact = np.sqrt(np.abs(np.prod(ratio, axis=1))) * np.sign(zk)
    turn = exact[:, None] / gap
    turn /= np.sqrt((turn * turn).sum(0))
    vectors = np.array(vectors)
    vectors[:, at] = vectors[:, at] @ turn
    d[at] = dk - np.diagonal(gap)
    order = np.argsort(d, kind="stable")
    return d[order], vectors[:, order]


class Spectrum:
    """Count, mean and eigendecomposition of the scatter of some vectors."""

    def __init__(self, dim: int):
        self.n, self.mean, self.values, self.vectors = 0, np.zeros(dim), np.zeros(dim), np.eye(dim)

    def add(self, x: np.ndarray) -> None:
        u = x - self.mean
        self.values, self.vectors = rank_one(self.values, self.vectors, u, self.n / (self.n + 1))
        self.n += 1
        self.mean = self.mean + u / self.n

    def combine(self, n: int, mean: np.ndarray, values: np.ndarray, vectors: np.ndarray) -> None:
        u, total = mean - self.mean, self.n + n
        for value, vector in zip(values, vectors.T, strict=True):
            if value > 0:
                self.values, self.vectors = rank_one(self.values, self.vectors, vector, float(value))
        self.values, self.vectors = rank_one(self.values, self.vectors, u, self.n * n / total)
        self.mean = self.mean + u * (n / total)
        self.n = total

    def batch(self) -> pa.RecordBatch:
        return pa.RecordBatch.from_pydict({
            "n": pa.array([self.n], pa.int64()), "mean": [self.mean], "values": [self.values], "vectors": [self.vectors.ravel()],
        })


_SPECTRUM = "n long, mean array<double>, values array<double>, vectors array<double>"


@dataclass
class Whitening:
    """The fit: ``n`` distinct vectors, their exact ``sums``, unit ``components`` as columns and their ``variances``."""

    n: int
    sums: list[int]
    components: np.ndarray
    variances: np.ndarray
    explained: np.ndarray
    identity_error: float

    @property
    def origin(self) -> np.ndarray:
        """Whole numbers next to the mean."""
        return np.array([round(s / self.n) if abs(s) < 1 << 52 else s // self.n for s in self.sums], np.int64)


def vectors(df: DataFrame, carry: list[str], vector: str = "embedding") -> DataFrame:
    """Struct ``row`` of the carried columns and the whole numbers ``x`` of each usable vector."""
    v = F.col(f"`{vector}`")
    whole = F.transform(v, lambda c: F.floor(F.least(F.greatest(c.cast("double") * SCALE, F.lit(-MOST)), F.lit(MOST))).cast("long") + SHIFT)
    # A comparison with null is null, which is not true.
    finite = F.forall(v, lambda c: F.coalesce(F.abs(c.cast("double")) < F.lit(float("inf")), F.lit(False)))
    out = df.where(v.isNotNull()).where(finite & (F.size(v) > 0))
    out = out.select(F.struct(*[F.col(f"`{c}`") for c in carry]).alias("row"), whole.alias("x"))
    most = out.groupBy(F.size("x").alias("dim")).count().orderBy(F.desc("count"), F.desc("dim")).first()
    return out.where(F.size("x") == (most.dim if most else 0))


def _matrix(column: pa.Array) -> np.ndarray:
    rows = len(column)
    return column.flatten().to_numpy(zero_copy_only=False).reshape(rows, -1)


def _centred(x: np.ndarray, origin: np.ndarray, rest: np.ndarray) -> np.ndarray:
    return (x - origin).astype(np.float64) - rest


def spectrum(fit: DataFrame, origin: np.ndarray) -> Spectrum:
    """The combined spectrum of all vectors ``x`` of ``fit``, moved by ``origin``."""
    dim = len(origin)

    def update(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        s = Spectrum(dim)
        for b in batches:
            for row in (_matrix(b.column(0)) - origin).astype(np.float64):
                s.add(row)
        if s.n:
            yield s.batch()

    def combine(table: pa.Table) -> pa.Table:
        s = Spectrum(dim)
        for r in sorted(table.select(["n", "mean", "values", "vectors"]).to_pylist(), key=lambda r: (r["n"], r["mean"])):
            other = (r["n"], np.array(r["mean"]), np.array(r["values"]), np.array(r["vectors"]).reshape(dim, dim))
            if s.n:
                s.combine(*other)
            else:
                s.n, s.mean, s.values, s.vectors = other
        return pa.Table.from_batches([s.batch()])

    level = pinned(X.small_batches(fit.select("x")).mapInArrow(update, _SPECTRUM), "spectra")
    while (left := level.count()) > 1:
        groups = -(-left // FANIN)
        dealt = level.withColumn("grp", F.pmod(F.xxhash64("n", "mean"), F.lit(groups)))
        level = pinned(dealt.groupBy("grp").applyInArrow(combine, _SPECTRUM), "spectra")
    r = level.first()
    s = Spectrum(dim)
    s.n, s.mean, s.values, s.vectors = r.n, np.array(r.mean), np.array(r["values"]), np.array(r.vectors).reshape(dim, dim)
    return s


def moments(fit: DataFrame, origin: np.ndarray, rest: np.ndarray, basis: np.ndarray) -> np.ndarray:
    """Sum over the vectors of the products of their centred coordinates in ``basis``."""
    k = basis.shape[1]
    upper = np.triu_indices(k)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros((k, k))
        for b in batches:
            y = _centred(_matrix(b.column(0)), origin, rest) @ basis
            total += y.T @ y
        yield pa.RecordBatch.from_arrays([pa.array(upper[0], pa.int32()), pa.array(upper[1], pa.int32()), pa.array(total[upper])], names=["i", "j", "v"])

    sums = X.small_batches(fit.select("x")).mapInArrow(run, "i int, j int, v double").groupBy("i", "j").agg(F.sum("v").alias("v")).toArrow()
    out = np.zeros((k, k))
    i, j, v = (sums.column(c).to_numpy() for c in ("i", "j", "v"))
    out[i, j], out[j, i] = v, v
    return out


def fitted(rows: DataFrame, components: int = COMPONENTS) -> Whitening | None:
    """The whitening of the distinct vectors among ``rows`` (x); None without rows."""
    fit = pinned(rows.select("x").distinct(), "whitening_fit")
    sums = fit.select(F.posexplode("x").alias("i", "v")).groupBy("i").agg(
        F.sum(F.col("v").cast("decimal(38,0)")).alias("s"), F.count(F.lit(1)).alias("n")
    ).orderBy("i").collect()
    if not sums:
        return None
    model = Whitening(sums[0].n, [int(r.s) for r in sums], np.zeros(0), np.zeros(0), np.zeros(0), 0.0)
    origin, n = model.origin, model.n
    rest = np.array([s - n * o for s, o in zip(model.sums, origin.tolist(), strict=True)], np.float64) / n
    basis, _ = np.linalg.qr(spectrum(fit, origin).vectors)
    values, turn = np.linalg.eigh(moments(fit, origin, rest, basis) / n)
    order = np.argsort(-values, kind="stable")
    values, basis = np.maximum(values[order], 0.0), basis @ turn[:, order]
    first = basis[np.abs(basis).argmax(0), np.arange(len(values))]
    basis = basis * np.where(first < 0, -1.0, 1.0)  # the largest entry of a component is positive
    total = values.sum()
    model.components, model.variances = basis[:, :components], values[:components]
    model.explained = model.variances / total if total > 0 else np.zeros(len(model.variances))
    varied = model.variances > len(values) * _EPS * values[0]
    if varied.any():
        white = model.components[:, varied] / np.sqrt(model.variances[varied])
        model.identity_error = float(np.abs(moments(fit, origin, rest, white) / n - np.eye(int(varied.sum()))).max())
    return model


def whitened(rows: DataFrame, model: Whitening) -> DataFrame:
    """``row``, deviation and the ``whitened`` coordinates of every row."""
    origin, n = model.origin, model.n
    over = [s - n * o for s, o in zip(model.sums, origin.tolist(), strict=True)]
    rest = np.array(over, np.float64) / n
    varied = model.variances > len(model.sums) * _EPS * model.variances.max(initial=0.0)
    scale = np.where(varied, 1 / np.sqrt(np.where(varied, model.variances, 1.0)), 0.0)
    white = model.components * scale

    def deviations(x: np.ndarray) -> list[int | None]:
        near = x - origin
        roughly = ((near.astype(np.float64) * n - np.array(over, np.float64)) ** 2).sum(1)
        out: list[int | None] = [None] * len(x)
        small = roughly < 2.0**62
        exact = near[small] * n - np.array(over if small.any() else [0] * len(over), np.int64)
        for i, v in zip(np.flatnonzero(small).tolist(), (exact * exact).sum(1).tolist(), strict=True):
            out[i] = v
        for i in np.flatnonzero(~small).tolist():
            v = sum((a * n - o) ** 2 for a, o in zip(near[i].tolist(), over, strict=True))
            out[i] = v if v < 1 << 63 else None
        return out

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            x = _matrix(b.column(1))
            y = _centred(x, origin, rest) @ white
            offsets = np.arange(0, y.size + 1, y.shape[1], dtype=np.int32)
            yield pa.RecordBatch.from_arrays(
                [b.column(0), pa.array(deviations(x), pa.int64()), pa.ListArray.from_arrays(offsets, y.ravel())], names=["row", "deviation", "whitened"]
            )

    schema = T.StructType([rows.schema["row"], T.StructField("deviation", T.LongType()), T.StructField("whitened", T.ArrayType(T.DoubleType()))])
    return X.small_batches(rows.select("row", "x")).mapInArrow(run, schema)


def digest(embeddings: DataFrame) -> DataFrame:
    rows = vectors(embeddings, ["vec_id"])
    model = fitted(rows)
    if model is None:
        none = "vec_id long, component int, n long, deviation long, whitened double, explained double, identity_error double"
        return embeddings.sparkSession.createDataFrame([], none)
    explained = F.array(*[F.lit(float(e)) for e in model.explained])
    each = whitened(rows, model).select("row.vec_id", "deviation", F.posexplode("whitened").alias("at", "whitened"))
    return each.select(
        "vec_id", (F.col("at") + 1).alias("component"), F.lit(model.n).cast("long").alias("n"), "deviation", "whitened",
        explained[F.col("at")].alias("explained"), F.lit(model.identity_error).alias("identity_error"),
    )
