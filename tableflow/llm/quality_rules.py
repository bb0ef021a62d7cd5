"""Quality rules with tokeniser fertility.

Every word of every whole text is encoded with a public SentencePiece vocabulary that falls back to bytes. A text has
three measures: characters per token, share of byte-fallback tokens, and token entropy (in parts of the most
that so many tokens can have). Bands per language, or per script where no language is given, come from the quartiles
of all distinct texts, copies counted once: a measure further than ``FENCE`` interquartile ranges outside the quartiles
rejects the text. Texts are compared with texts of a similar number of tokens, since entropy depends on it.

The measures are rounded and counted per value, so quartiles are exact and the same on every run. Every band stands on
``LEAST`` texts: a size class with fewer takes in its neighbours of the same language. A language with n < ``LEAST``
texts in all has quartiles n/LEAST of the way from those of all languages to its own, so no verdict turns on one text.

Edge cases: null and empty texts have no words and fail the base rule; a null or missing language is the text's main
script; repeated rows are measured and judged each; an empty table gives an empty result; extra columns stay in a struct.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tableflow.llm import texts as X
from tableflow.llm import vocab as V
from tableflow.session import pinned

VOCABULARY = "piece_bpe_32k.model"
FENCE = 3.5
LEAST = 40
#: Smallest interquartile range taken, so that a band of nearly equal values is not a point.
LEAST_RANGE = {"chars_per_token": 0.03, "byte_share": 0.01, "entropy": 0.01}
MEASURES = tuple(LEAST_RANGE)

FIELDS = [
    *[T.StructField(n, T.LongType()) for n in ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words")],
    T.StructField("n_tokens", T.LongType()),
    *[T.StructField(n, T.DoubleType()) for n in MEASURES],
    T.StructField("script", T.StringType()),
    T.StructField("text_hash", T.LongType()),
]

_SYMBOL = np.isin(np.arange(256), np.frombuffer(b"#*$%&|<>", np.uint8))

#: First UTF-8 byte of a character -> script, for scripts that a first byte tells.
SCRIPTS = {
    "latin": [*range(0x41, 0x5B), *range(0x61, 0x7B), *range(0xC3, 0xCA)],
    "greek": [0xCE, 0xCF],
    "cyrillic": [*range(0xD0, 0xD5)],
    "hebrew": [0xD6, 0xD7],
    "arabic": [*range(0xD8, 0xDC)],
    "indic": [0xE0],
    "east_asian": [*range(0xE3, 0xEE)],
}
_NAMES = ["other", *SCRIPTS]
_SCRIPT = np.zeros(256, np.int64)
for _i, _bytes in enumerate(SCRIPTS.values(), 1):
    _SCRIPT[_bytes] = _i

_loaded: dict[str, tuple[V.Words, np.ndarray]] = {}


def _vocabulary(path: str) -> tuple[V.Words, np.ndarray]:
    """The word encoder and a mask of byte-fallback ids, loaded once per Python worker."""
    if path not in _loaded:
        import sentencepiece

        sp = sentencepiece.SentencePieceProcessor(model_file=path)
        is_byte = np.array([sp.is_byte(i) for i in range(sp.vocab_size())])
        words = V.Words(lambda many: sp.encode([w.decode("utf-8", "replace") for w in many], num_threads=1))
        _loaded[path] = (words, is_byte)
    return _loaded[path]


def _sums(values: np.ndarray, offsets: np.ndarray) -> np.ndarray:
    return np.diff(np.append(0, np.cumsum(values))[offsets])


def _dup_lines(c: X.Chunk) -> np.ndarray:
    """Lines with a word that equal an earlier line of their text."""
    breaks = np.flatnonzero(c.data == 0x0A)
    start = np.sort(np.concatenate([c.start, breaks + 1]))
    end = np.sort(np.concatenate([c.end, breaks]))
    worded = np.searchsorted(c.ws, end) > np.searchsorted(c.ws, start)
    start, end = start[worded], end[worded]
    doc = np.searchsorted(c.start, start, "right") - 1
    key = X.mix(X.range_hash(X.prefix_hash(c.data), start, end) + X.mix(doc.astype(np.uint64)))
    order = np.argsort(key, kind="stable")
    again = np.flatnonzero(key[order][1:] == key[order][:-1]) + 1
    return np.bincount(doc[order[again]], minlength=c.n)


def _repeat_words(c: X.Chunk) -> np.ndarray:
    """Words in windows of three that their text has twice or more."""
    at, h = c.ngrams(3)
    key = X.mix(h + X.mix(c.doc[at].astype(np.uint64)))
    order = np.argsort(key, kind="stable")
    same = key[order][1:] == key[order][:-1]
    twice = np.zeros(len(key), bool)
    twice[order[1:][same]] = True
    twice[order[:-1][same]] = True
    covered = np.zeros(len(c.ws), bool)
    for j in range(3):
        covered[at[twice] + j] = True
    return np.bincount(c.doc[covered], minlength=c.n)


def _entropy(ids: np.ndarray, offsets: np.ndarray) -> np.ndarray:
    """Entropy of each text's tokens over the logarithm of their number; 1 for fewer than two."""
    n = np.diff(offsets)
    doc = np.repeat(np.arange(len(n)), n)
    key, count = np.unique(doc * (1 << 20) + ids, return_counts=True)
    each = count * np.log2(count)
    of = np.bincount(key >> 20, weights=each, minlength=len(n))
    with np.errstate(divide="ignore", invalid="ignore"):
        bits = np.log2(n)
        return np.where(n > 1, (bits - of / n) / bits, 1.0)


def _measured(column: pa.Array, path: str):
    words, is_byte = _vocabulary(path)
    for _, _, c in X.chunks(column):
        c.words(X.SPACED)
        n_words = np.diff(c.first)
        lead = ((c.data & 0xC0) != 0x80) & X.SPACED[c.data]
        bounds = np.append(c.start, len(c.data))
        lead[c.end] = False
        chars = _sums(lead, bounds)
        ids, lengths = words.ids(c)
        at = V.per_doc(c, lengths)
        n_tokens = np.diff(at)
        some = np.maximum(n_tokens, 1)
        scripts = np.bincount(
            np.repeat(np.arange(c.n), c.end - c.start + 1) * len(_NAMES) + _SCRIPT[c.data], minlength=c.n * len(_NAMES)
        ).reshape(c.n, -1)
        scripts[:, 0] = 0
        script = scripts.argmax(axis=1)
        yield [
            *[pa.array(x.astype(np.int64)) for x in (
                n_words, chars, _sums(_SYMBOL[c.data], bounds), _dup_lines(c), _repeat_words(c), n_tokens,
            )],
            pa.array(np.round(chars / some, 3)), pa.array(np.round(_sums(is_byte[ids], at) / some, 4)),
            pa.array(np.round(_entropy(ids, at), 4)), pa.array([_NAMES[i] for i in script]),
            pa.array(X.mix(X.range_hash(X.prefix_hash(c.data), c.start, c.end)).view(np.int64)),
        ]


def measure(
    docs: DataFrame, carry: list[str], text: str = "text", vocabulary: str | None = None
) -> DataFrame:
    """``doc`` (the carried columns) and ``out`` (base counts, measures, main script) per text."""
    return X.per_text(docs, text, carry, FIELDS, lambda column: _measured(column, vocabulary or V.public_path(VOCABULARY)))


def base_failed() -> Column:
    return (F.col("out.n_words") < 50) | (100 * F.col("out.n_repeat_words") > 50 * F.col("out.n_words"))


def size_class() -> Column:
    """Texts whose numbers of tokens differ by less than the square root of two."""
    return F.floor(F.log2(F.greatest(F.col("out.n_tokens"), F.lit(1))) * 2)


def bands(measured: DataFrame) -> DataFrame:
    """Quartiles of the texts around each size class of each group, and by how much more they may differ; group null
    holds all texts.

    A class has a row if a text of it passes the base rule; only such texts count, and a text counts once in a group
    however many rows have it. ``n`` is the number of texts the quartiles are taken from: those of the class and of as
    many neighbouring classes, equally far on both sides, as it takes to have ``LEAST``, or of all classes if none do.
    A measure may change with size, so what its trend over the group makes of that reach is added to the room.
    """
    one = measured.where(~base_failed()).groupBy("out.text_hash").agg(
        F.first(size_class()).alias("cls"), F.collect_set("grp").alias("grps"),
        F.first(F.array(*[F.col(f"out.{m}") for m in MEASURES])).alias("x"),
    )
    every = F.concat(F.array(F.lit(None).cast("string")), "grps")
    values = one.select(F.explode(every).alias("grp"), "cls", F.posexplode("x").alias("measure", "x"))
    values = pinned(values.groupBy("grp", "cls", "measure", "x").agg(F.count(F.lit(1)).alias("n")), "quality_values")
    sizes = values.where("measure = 0").groupBy("grp", "cls").agg(F.sum("n").alias("n"))
    near = sizes.alias("a").join(sizes.alias("b"), F.expr("a.grp <=> b.grp")).groupBy(
        "a.grp", "a.cls", F.expr("abs(a.cls - b.cls)").alias("far")
    ).agg(F.sum("b.n").alias("n"))
    within = Window.partitionBy("grp", "cls").orderBy("far")
    near = near.withColumn("n", F.sum("n").over(within))
    reach = near.groupBy("grp", "cls").agg(F.coalesce(F.min(F.when(F.col("n") >= LEAST, F.col("far"))), F.max("far")).alias("reach"))
    inside = F.expr("v.grp <=> r.grp and v.cls between r.cls - r.reach and r.cls + r.reach")
    met = values.alias("v").join(F.broadcast(reach.alias("r")), inside)  # a row per group and class
    trend = values.groupBy(F.col("grp").alias("of"), F.col("measure").alias("by")).agg(F.coalesce(F.try_divide(
        F.expr("sum(n * cls * x) - sum(n * cls) * sum(n * x) / sum(n)"), F.expr("sum(n * cls * cls) - sum(n * cls) * sum(n * cls) / sum(n)")
    ), F.lit(0.0)).alias("slope"))
    each = met.groupBy("r.grp", "r.cls", "measure").agg(
        F.sum("v.n").alias("n"), F.expr("percentile(v.x, array(0.25, 0.75), v.n)").alias("q"), F.first("reach").alias("reach")
    ).join(F.broadcast(trend), F.expr("grp <=> of and measure = by")).withColumn(
        "q", F.concat("q", F.array(F.abs("slope") * F.col("reach")))
    )
    return each.groupBy("grp", "cls").agg(
        F.max("n").alias("n"), *[F.first(F.when(F.col("measure") == i, F.col("q")), True).alias(m) for i, m in enumerate(MEASURES)]
    )


def verdicts(measured: DataFrame) -> DataFrame:
    """``measured`` with ``kept``. Needs the columns doc, out and grp; the bands are joined by group and class."""
    b = pinned(bands(measured), "quality_bands")
    own = b.where("grp is not null").select("cls", "grp", F.struct("n", *MEASURES).alias("own"))
    wide = b.where("grp is null").select("cls", F.struct(*MEASURES).alias("wide"))
    m = measured.withColumn("cls", size_class()).join(wide, "cls", "left").join(own, ["cls", "grp"], "left")
    part = F.least(F.col("own.n") / LEAST, F.lit(1.0))
    outside = F.lit(False)
    for name in MEASURES:
        low, high, more = [part * F.col(f"own.{name}")[i] + (1 - part) * F.col(f"wide.{name}")[i] for i in range(3)]
        room = FENCE * F.greatest(high - low, F.lit(LEAST_RANGE[name])) + more
        x = F.col(f"out.{name}")
        outside = outside | F.coalesce((x < low - room) | (x > high + room), F.lit(False))
    return m.withColumn("kept", ~base_failed() & ~outside)


def judged(docs: DataFrame, carry: list[str], text: str = "text", language: str | None = "lang") -> DataFrame:
    """Columns doc, out, kept per text. The measured rows are written once: bands and verdicts both read them."""
    by = [language] if language and language in docs.columns else []
    extra = [c for c in by if c not in carry]
    m = measure(docs, [*carry, *extra], text)
    grp = F.coalesce(*[F.col(f"doc.`{c}`").cast("string") for c in by], F.col("out.script"))
    return verdicts(pinned(m.withColumn("grp", grp), "quality_rules"))


def digest(docs: DataFrame) -> DataFrame:
    v = judged(docs, ["doc_id"])
    return v.select(
        F.col("doc.doc_id").alias("doc_id"),
        *[F.col(f"out.{n}").alias(n) for n in ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words")],
        base_failed().alias("base_failed"), "kept", *[F.col(f"out.{m}").alias(m) for m in MEASURES],
    )


def good(docs: DataFrame) -> DataFrame:
    """The documents that pass, with their own columns."""
    return judged(docs, docs.columns).where("kept").select(*[F.col(f"doc.`{c}`") for c in docs.columns])
