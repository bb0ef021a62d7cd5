"""A quality classifier: random Fourier features, ridge regression and isotonic calibration.

Each whole text becomes a short vector of statistics (lengths, shares of kinds of characters, repetition, word shapes); no
label, language, source or id is among them. Random Fourier features of the scaled vector approximate a Gaussian
kernel. Every partition sums its own normal equations; the sums add up to one small system, whose ridge solution
is the score's weights. Labelled rows kept out of that fit calibrate the score: pool-adjacent-violators gives a monotone
map to probabilities, joined by straight lines so that scores stay ordered.

Texts are scanned once, and only the vectors are written and joined with labels. The fit uses about ``MOST_ROWS`` labelled
rows at most, picked by hash; the scale (mean and deviation) comes from the same rows.

Edge cases: null and empty texts have a vector of zeros and a score; labels that are null are not learned from, and of
several labels of an id the largest counts; without any label, or with one class only, every score is the share of
good labels (0.5 without any); an empty table gives an empty result; extra columns stay in a struct.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tableflow.llm import texts as X
from tableflow.llm.quality_rules import _dup_lines, _repeat_words, _sums
from tableflow.session import pinned

MOST_ROWS = 60_000
FEATURES = 256
RIDGE = 1e-3
SEED = 17
THRESHOLD = 0.7
PARTS = 8

_is = {
    "symbol": b"#*$%&|<>", "mark": b"!?", "point": b".,;:", "bracket": b"()[]{}", "quote": b"\"'`", "digit": b"0123456789",
    "upper": bytes(range(65, 91)), "lower": bytes(range(97, 123)), "line": b"\n", "dash": b"-_=+~^/\\", "pipe": b"|", "at": b"@",
}
_KINDS = {k: np.isin(np.arange(256), np.frombuffer(v, np.uint8)) for k, v in _is.items()}
_KINDS["beyond"] = np.arange(256) >= 128
NAMES = [
    "log_words", "log_bytes", "word_mean", "word_sd", "short", "long", "repeat", "dup_lines", "log_lines", "distinct",
    "again", "top", "entropy", "odd_end", "capital", "shout", *_KINDS,
]


def statistics(c: X.Chunk) -> np.ndarray:
    """One row of statistics per text of the chunk."""
    c.words(X.SPACED)
    c.word_hashes()
    n = np.diff(c.first)
    some = np.maximum(n, 1)
    size = (c.end - c.start).astype(float)
    one = np.maximum(size, 1)
    bounds = np.append(c.start, len(c.data))
    length = (c.we - c.ws).astype(float)
    mean = _sums(length, c.first) / some
    var = np.maximum(_sums(length * length, c.first) / some - mean**2, 0)
    out = [np.log1p(n), np.log1p(size), mean, np.sqrt(var), _sums(length <= 3, c.first) / some, _sums(length >= 12, c.first) / some]
    out.append(_repeat_words(c) / some)
    lines = _sums(c.data == 0x0A, bounds) + 1
    out += [_dup_lines(c) / lines, np.log1p(lines)]
    # Distinct words, the commonest word's share, and the entropy of bytes.
    key = X.mix(c.wh + X.mix(c.doc.astype(np.uint64)))
    value, at, count = np.unique(key, return_index=True, return_counts=True)
    distinct = np.bincount(c.doc[at], minlength=c.n)
    top = np.zeros(c.n, np.int64)
    np.maximum.at(top, c.doc[at], count)
    same = np.zeros(len(c.wh), bool)
    if len(c.wh):
        same[1:] = (c.wh[1:] == c.wh[:-1]) & (c.doc[1:] == c.doc[:-1])
    out += [distinct / some, _sums(same, c.first) / some, top / some]
    text = np.repeat(np.arange(c.n), (c.end - c.start + 1))
    table = np.bincount(text * 256 + c.data, minlength=c.n * 256).reshape(c.n, 256).astype(float)
    table[:, 0x20] -= 1  # the gap after each text
    share = table / one[:, None]
    out.append(-(share * np.log2(np.where(share > 0, share, 1))).sum(axis=1))
    last, head = c.data[c.we - 1], c.data[c.ws]
    odd = _KINDS["symbol"] | _KINDS["mark"]
    upper = _KINDS["upper"]
    second = np.minimum(c.ws + 1, c.we - 1)
    out += [_sums(odd[last], c.first) / some, _sums(upper[head], c.first) / some, _sums(upper[head] & upper[c.data[second]], c.first) / some]
    out += [table[:, k].sum(axis=1) / one for k in _KINDS.values()]
    return np.where(size[:, None] > 0, np.column_stack(out), 0.0)


def vectors(docs: DataFrame, carry: list[str], text: str = "text") -> DataFrame:
    """``doc`` (the carried columns) and ``out.x``, the text's statistics."""

    def results(column: pa.Array):
        for _, _, c in X.chunks(column):
            x = statistics(c)
            yield [pa.ListArray.from_arrays(np.arange(0, x.size + 1, x.shape[1], dtype=np.int32), x.ravel())]

    return X.per_text(docs, text, carry, [T.StructField("x", T.ArrayType(T.DoubleType()))], results)


class Fourier:
    """Scaled statistics to cosines whose products approximate a Gaussian kernel of width sqrt(number of them)."""

    def __init__(self, mean: np.ndarray, sd: np.ndarray, features: int = FEATURES, seed: int = SEED):
        rng = np.random.default_rng(seed)
        self.mean, self.sd = mean, np.where(sd > 1e-9, sd, 1.0)
        d = len(mean)
        self.w = rng.normal(size=(d, features)) / np.sqrt(d)
        self.b = rng.uniform(0, 2 * np.pi, features)

    def __call__(self, x: np.ndarray) -> np.ndarray:
        z = np.clip((x - self.mean) / self.sd, -6, 6)
        return np.column_stack([np.ones(len(z)), np.cos(z @ self.w + self.b) * np.sqrt(2 / self.w.shape[1])])


def _matrix(column: pa.Array) -> np.ndarray:
    column = column.combine_chunks() if isinstance(column, pa.ChunkedArray) else column
    return column.flatten().to_numpy(zero_copy_only=False).reshape(len(column), -1)


def normal_equations(rows: DataFrame, lift: Fourier) -> tuple[np.ndarray, np.ndarray]:
    """Z'Z and Z'y over rows (x, y): every partition sends one pair, and there are ``PARTS`` of them."""

    def run(batches):
        a = b = None
        for batch in batches:
            z = lift(_matrix(batch.column(0)))
            y = batch.column(1).to_numpy(zero_copy_only=False)
            if a is None:
                a, b = np.zeros((z.shape[1],) * 2), np.zeros(z.shape[1])
            a += z.T @ z
            b += z.T @ y
        if a is not None:
            yield pa.RecordBatch.from_pydict({"a": [a.ravel().tolist()], "b": [b.tolist()]})

    sums = rows.select("x", "y").repartition(PARTS).mapInArrow(run, "a array<double>, b array<double>").collect()
    b = np.sum([r.b for r in sums], axis=0)
    return np.sum([r.a for r in sums], axis=0).reshape(len(b), len(b)), b


def isotonic(score: np.ndarray, label: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Knots of the monotone map from score to probability, by pooling adjacent violators. Equal scores are one point with the
    mean of their labels, so the order of rows does not matter."""
    points, which = np.unique(score, return_inverse=True)
    n = np.bincount(which)
    mean = np.bincount(which, weights=label) / n
    means: list[float] = []
    weights: list[float] = []
    centres: list[float] = []
    for c, m, w in zip(points.tolist(), mean.tolist(), n.astype(float).tolist(), strict=True):
        while means and means[-1] >= m:
            pm, pw, pc = means.pop(), weights.pop(), centres.pop()
            m, c, w = (m * w + pm * pw) / (w + pw), (c * w + pc * pw) / (w + pw), w + pw
        means.append(m)
        weights.append(w)
        centres.append(c)
    w = np.array(weights)
    return np.array(centres), (np.array(means) * w + 0.5) / (w + 1)  # no block is quite sure


def remainder(doc_id: Column, by: int) -> Column:
    return F.pmod(F.crc32(doc_id.cast("string").cast("binary")), F.lit(by))


def training_labels(labels: DataFrame, name: str, by: int, held: int, most: int = MOST_ROWS) -> DataFrame:
    """doc_id, y, h of the labelled ids to learn from: all, or the part whose hash makes about ``most`` of them."""
    y = labels.where(F.col(name).isNotNull() & F.col("doc_id").isNotNull() & (remainder(F.col("doc_id"), by) != held))
    y = y.groupBy("doc_id").agg(F.max(name).cast("double").alias("y"))
    y = pinned(y.withColumn("h", F.xxhash64("doc_id", F.lit(SEED))), "labels_known")
    n, grains = y.count(), 1 << 20
    return y if n <= most else y.where(F.pmod(F.shiftright("h", 20), F.lit(grains)) < grains * most // n)


class Model:
    """Weights and calibration; ``lift`` is null if there was nothing to learn and ``share`` is the score."""

    lift: Fourier | None = None
    share = 0.5

    def scores(self, x: np.ndarray) -> np.ndarray:
        if self.lift is None:
            return np.full(len(x), self.share)
        raw = self.lift(x) @ self.weights
        p = np.interp(raw, *self.knots)
        # Beyond the outer knots the map is flat; a trace of the raw score keeps the order there.
        return np.clip(p * 0.998 + 0.002 / (1 + np.exp(-4 * (raw - 0.5))), 0.0, 1.0)


def fit(known: DataFrame) -> Model:
    """From rows (x, y, h): four of five, by hash, for the weights and the rest for the calibration."""
    model = Model()
    known = pinned(known, "quality_known")
    d = len(NAMES)
    row = known.agg(
        F.count(F.lit(1)).alias("n"), F.avg("y").alias("share"),
        *[F.avg(F.col("x")[i]).alias(f"m{i}") for i in range(d)], *[F.stddev_pop(F.col("x")[i]).alias(f"s{i}") for i in range(d)],
    ).first()
    if row.n:
        model.share = float(row.share)
    if not row.n or model.share in (0.0, 1.0):
        return model
    lift = Fourier(np.array([row[f"m{i}"] for i in range(d)]), np.array([row[f"s{i}"] for i in range(d)]))
    a, b = normal_equations(known.where("pmod(h, 5) <> 0"), lift)
    rest = known.where("pmod(h, 5) = 0").select("x", "y").toArrow()  # about a fifth of MOST_ROWS at most
    if not b.any() or not len(rest):
        return model
    n = a[0, 0]
    model.weights = np.linalg.solve(a + RIDGE * n / FEATURES * np.eye(len(b)), b)
    model.lift = lift
    model.knots = isotonic(lift(_matrix(rest.column("x"))) @ model.weights, rest.column("y").to_numpy())
    return model


def scored(docs: DataFrame, labels: DataFrame, carry: list[str], text: str = "text") -> DataFrame:
    """``doc`` and ``score`` of every text; learns from ``labels`` whose remainder by four is not two."""
    x = pinned(vectors(docs, carry, text), "quality_vectors")
    known = x.select(F.col("doc.doc_id").alias("doc_id"), F.col("out.x").alias("x")).join(
        training_labels(labels, "quality", 4, 2), "doc_id"
    )
    model = fit(known.select("x", "y", "h"))

    def run(batches):
        for batch in batches:
            x = batch.column(1)
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(model.scores(_matrix(x)))], names=["doc", "score"])

    schema = T.StructType([x.schema["doc"], T.StructField("score", T.DoubleType())])
    return x.select("doc", F.col("out.x").alias("x")).mapInArrow(run, schema)


def digest(docs: DataFrame, labels: DataFrame) -> DataFrame:
    s = scored(docs, labels, ["doc_id"])
    held = F.coalesce(remainder(F.col("doc.doc_id"), 4) == 2, F.lit(False))
    return s.select(
        F.col("doc.doc_id").alias("doc_id"), held.alias("held_out"), "score", (F.col("score") >= THRESHOLD).cast("int").alias("predicted"),
    )
