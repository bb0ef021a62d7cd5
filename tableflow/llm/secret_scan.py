"""Secret scans with a battery of randomness tests.

Three known forms (assignments to a secret's name, access ids, long hexadecimal runs) are found by pattern. Other long
tokens are judged by how random they look. A token's encoding is inferred from its characters (decimal, one-case
letters, hexadecimal, base 32, base 64) and gives the alphabet for three tests of uniform random text: chi-squared of
the character counts, runs above and below the alphabet's middle, and serial correlation. Fisher's method joins their p
values; a token that this battery rejects is not random.

What is not rejected must also be unlike the corpus: the likelihood ratio of the uniform alphabet to the corpus's own
characters bounds the p value of "ordinary text" by its inverse. The corpus's model has the share of lower case, upper
case, digits and signs over all texts, and the frequencies of letters over all long tokens of letters. Tokens of one case
are compared by their letters alone, so that a shouted word is no secret. Benjamini-Hochberg then holds the false discovery rate over all tokens at ``RATE``, in each length band by
itself, since long tokens would otherwise lend their evidence to short ones.

SQL functions only; texts are scanned once, tokens are narrow rows, and frequencies and p values are counted before
they are gathered (per character, and per band and tenth of a power of ten).

Edge cases: null is empty text; empty texts have no spans; repeated rows are scanned each; an empty table gives an empty
result; extra columns never reach the scan.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tableflow.llm import native_spans as N
from tableflow.session import pinned

#: The known forms. Key letters in either case; the group after the sign is the secret.
ASSIGN = (
    "([Pp][Aa][Ss][Ss][Ww][Oo][Rr][Dd]|[Pp][Aa][Ss][Ss][Ww][Dd]|[Ss][Ee][Cc][Rr][Ee][Tt]|[Tt][Oo][Kk][Ee][Nn]"
    "|[Aa][Pp][Ii]_?[Kk][Ee][Yy])[\"']?\\x20*[:=]\\x20*[\"']?([A-Za-z0-9+/_.=-]+)"
)
PATTERNS = {
    "assign": ASSIGN,
    "access": "AKIA[A-Z0-9]{16,}+",
    "hex": "(?<![0-9a-f])[0-9a-f]{24,}+",
    "random": "(?<![A-Za-z0-9+/_-])[A-Za-z0-9+/_-]{20,}+",
}
KINDS = list(PATTERNS)
RATE = 0.01
#: Least joint p value of the three randomness tests.
REJECT = 0.001
_SHARPEST = 400

_BASE64 = "ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789+/-_"
_LOWER, _UPPER, _DIGITS, _SIGNS = _BASE64[26:52], _BASE64[:26], _BASE64[52:62], _BASE64[62:]
CLASSES = {"lower": _LOWER, "upper": _UPPER, "digit": _DIGITS, "sign": _SIGNS}
#: Encoding -> what it is made of, and its alphabet.
ENCODINGS = {
    "decimal": ("^[0-9]+$", _DIGITS),
    "lower": ("^[A-Z]?[a-z]+$", _LOWER),
    "upper": ("^[A-Z]+$", _UPPER),
    "hex": ("^([0-9a-f]+|[0-9A-F]+)$", _DIGITS + "abcdef"),
    "base32": ("^[A-Z2-7]+$", _UPPER + "234567"),
    "base64": ("", _BASE64),
}


def scan(docs: DataFrame, carry: list[str], text: str = "text") -> DataFrame:
    """uid, struct ``doc`` of the carried columns, and the matches of every pattern, written once."""
    src = docs.select(
        F.struct(*[F.col(f"`{c}`") for c in carry]).alias("doc"), F.coalesce(F.col(f"`{text}`"), F.lit("")).alias("text")
    )
    for name, chars in CLASSES.items():
        src = src.withColumn(f"n_{name}", F.char_length("text") - F.char_length(F.translate("text", chars, "")))
    return N.numbered(N.matched(src, "text", PATTERNS).drop("text"), "secret_matches")


def _p_upper(z: Column) -> Column:
    """Upper tail of the normal distribution (a logistic curve, good to 0.01)."""
    return 1 / (1 + F.exp(0.07056 * z * z * z + 1.5976 * z))


def _two_sided(z: Column) -> Column:
    return F.least(F.lit(1.0), 2 * _p_upper(F.abs(z)))


def tested(tokens: DataFrame) -> DataFrame:
    """Tokens (column ``value``) with encoding, length and the joint p value ``p_random`` of the battery."""
    enc = F.lit("base64")
    for name in reversed(list(ENCODINGS)[:-1]):
        enc = F.when(F.col("value").rlike(ENCODINGS[name][0]), name).otherwise(enc)
    alphabet = F.create_map(*[F.lit(x) for k, v in ENCODINGS.items() for x in (k, v[1])])[F.col("enc")]
    folded = F.when(F.col("enc").isin("lower", "hex"), F.lower("value")).otherwise(F.col("value"))
    t = tokens.withColumn("enc", enc).withColumn("s", folded).withColumn("abc", alphabet)
    t = t.withColumn("n", F.char_length("s").cast("double")).withColumn("k", F.char_length("abc").cast("double"))
    # Base 64 has two spellings of its last two digits; together they count as 64.
    t = t.withColumn("k", F.least("k", F.lit(64.0)))
    # Written, or the optimizer would put the encoding's patterns inside the loops over characters.
    t = pinned(t, "secret_encoded")
    t = t.withColumn("chars", F.filter(F.split("s", ""), lambda c: c != ""))
    t = t.withColumn("counts", F.expr(
        "transform(array_distinct(chars), c -> named_struct('c', c, 'o', cast(char_length(s) - char_length(replace(s, c, '')) as double)))"
    ))
    t = t.withColumn("at", F.expr("transform(chars, c -> cast(least(instr(abc, c), k) as double))"))
    chi = F.expr("aggregate(counts, 0D, (a, x) -> a + x.o * x.o) * k / n - n")
    t = t.withColumn("z_chi", (chi - (F.col("k") - 1)) / F.sqrt(2 * (F.col("k") - 1) * (1 - 1 / F.col("n"))))
    t = t.withColumn("n1", F.expr("cast(size(filter(at, v -> v > k / 2)) as double)")).withColumn("n2", F.expr("n - n1"))
    t = t.withColumn("runs", F.expr(
        "1 + aggregate(zip_with(slice(at, 1, size(at) - 1), slice(at, 2, size(at) - 1),"
        " (a, b) -> if((a > k / 2) <> (b > k / 2), 1, 0)), 0, (a, x) -> a + x)"
    ))
    mean = 1 + 2 * F.col("n1") * F.col("n2") / F.col("n")
    var = (mean - 1) * (mean - 2) / (F.col("n") - 1)
    # One side of the middle only: as unlikely as n equal coins.
    z_runs = F.when(var > 0, (F.col("runs") - mean) / F.sqrt(var)).otherwise(F.sqrt("n"))
    t = t.withColumn("z_runs", z_runs)
    t = t.withColumn("mu", F.expr("aggregate(at, 0D, (a, x) -> a + x) / n"))
    t = t.withColumn("ss", F.expr("aggregate(at, 0D, (a, x) -> a + (x - mu) * (x - mu))"))
    lag = F.expr(
        "aggregate(zip_with(slice(at, 1, size(at) - 1), slice(at, 2, size(at) - 1), (a, b) -> (a - mu) * (b - mu)), 0D, (a, x) -> a + x)"
    )
    z_serial = F.when(F.col("ss") > 0, (lag / F.col("ss") + 1 / F.col("n")) * F.sqrt("n")).otherwise(F.sqrt("n"))
    t = t.withColumn("z_serial", z_serial)
    floor = F.lit(1e-12)
    half = -(
        F.log(F.greatest(floor, _p_upper(F.col("z_chi")))) + F.log(F.greatest(floor, _two_sided(F.col("z_runs"))))
        + F.log(F.greatest(floor, _two_sided(F.col("z_serial"))))
    )
    t = t.withColumn("half", half)
    return t.withColumn("p_random", F.exp(-F.col("half")) * (1 + F.col("half") + F.col("half") * F.col("half") / 2)).select(
        *tokens.columns, "enc", "n", "k", "counts", "p_random",
    )


def _model(t: DataFrame, found: DataFrame) -> DataFrame:
    """One row: the log probability of each character in words (``letters``) and in any text (``any``)."""
    each = t.where(F.col("enc").isin("lower", "upper")).select(F.inline("counts")).groupBy(F.lower("c").alias("c")).agg(F.sum("o").alias("o"))
    # One row each of at most 26 letters, and of four sums.
    seen = each.agg(F.map_from_entries(F.collect_list(F.struct("c", "o"))).alias("seen"), F.sum("o").alias("all"))
    shares = found.agg(*[F.coalesce(F.sum(f"n_{c}"), F.lit(0)).alias(f"n_{c}") for c in CLASSES])
    total = sum((F.col(f"n_{c}") for c in CLASSES), F.lit(len(CLASSES)))

    def letter(c: str) -> Column:
        return F.log((F.coalesce(F.try_element_at("seen", F.lit(c.lower())), F.lit(0.0)) + 1) / (F.coalesce("all", F.lit(0.0)) + 26))

    def of(c: str, kind: str) -> Column:
        inside = letter(c) if c.isalpha() else F.lit(-math.log(len(CLASSES[kind])))
        return F.log((F.col(f"n_{kind}") + 1) / total) + inside

    words = F.create_map(*[x for c in _LOWER + _UPPER for x in (F.lit(c), letter(c))])
    every = F.create_map(*[x for kind, chars in CLASSES.items() for c in chars for x in (F.lit(c), of(c, kind))])
    return seen.crossJoin(shares).select(words.alias("letters"), every.alias("any"))


def _log_ratios(t: DataFrame, found: DataFrame) -> DataFrame:
    """Tokens with ``llr``: how much likelier (natural log) the uniform alphabet makes them than the corpus does."""
    logs = F.when(F.col("enc").isin("lower", "upper"), F.col("letters")).otherwise(F.col("any"))
    t = t.join(F.broadcast(_model(t, found)), F.lit(True)).withColumn("logs", logs)  # one row
    return t.withColumn("llr", F.expr("-n * ln(k) - aggregate(counts, 0D, (a, x) -> a + x.o * logs[x.c])")).drop(
        "logs", "counts", "letters", "any"
    )


def random_tokens(tokens: DataFrame, found: DataFrame, rate: float = RATE) -> DataFrame:
    """The tokens (column ``value`` and others) of the ``scan`` that are taken for secrets."""
    t = pinned(_log_ratios(pinned(tested(tokens), "secret_tests"), found), "secret_tokens")
    ten = math.log(10)
    grade = F.least(F.lit(_SHARPEST), F.floor(F.greatest(F.col("llr"), F.lit(0.0)) / ten * 10)).cast("int")
    t = t.withColumn("band", F.floor(F.log2("n"))).withColumn("grade", grade)
    per = t.groupBy("band", "grade").agg(F.count(F.lit(1)).alias("m"))
    above = Window.partitionBy("band").orderBy(F.desc("grade")).rowsBetween(Window.unboundedPreceding, 0)
    whole = Window.partitionBy("band")
    cut = per.select(
        "band", "grade", F.sum("m").over(above).alias("sharper"), F.sum("m").over(whole).alias("all")
    ).where(F.pow(F.lit(10.0), -F.col("grade") / 10) * F.col("all") <= F.lit(rate) * F.col("sharper"))
    cut = cut.groupBy("band").agg(F.min("grade").alias("cut"))  # one row per power of two of a token's length
    return t.join(F.broadcast(cut), "band").where((F.col("grade") >= F.col("cut")) & (F.col("p_random") >= REJECT))


def spans(found: DataFrame) -> DataFrame:
    """uid, kind number, start, end of all secrets in a ``scan``."""
    at = N.located(found, KINDS)
    secret = F.regexp_extract("value", "^" + ASSIGN, 2)
    base = at.where(F.col("kind").isin(1, 2) | ((F.col("kind") == 0) & (F.char_length(secret) >= 6)))
    random = random_tokens(at.where("kind = 3").select("uid", "kind", "value", "start", "end"), found)
    cols = ["uid", "kind", "start", "end"]
    return base.select(*cols).unionByName(random.select(*cols))


def secrets(docs: DataFrame, carry: list[str], text: str = "text") -> DataFrame:
    """``doc`` and ``spans`` (kind number, start, end; ordered by start, then kind) of every text."""
    found = scan(docs, carry, text)
    per = spans(found).groupBy("uid").agg(
        F.array_sort(F.collect_list(F.struct("start", "kind", "end"))).alias("spans")
    )
    none = F.array().cast("array<struct<start:bigint,kind:int,end:bigint>>")
    return found.select("uid", "doc").join(per, "uid", "left").select("doc", F.coalesce("spans", none).alias("spans"))


def digest(docs: DataFrame) -> DataFrame:
    s = secrets(docs, ["doc_id"])
    base = F.filter("spans", lambda x: x["kind"] < 3)

    def n(kind: int) -> Column:
        return F.size(F.filter("spans", lambda x: x["kind"] == kind)).cast("long")

    return s.select(
        F.col("doc.doc_id").alias("doc_id"), n(0).alias("n_assign"), n(1).alias("n_access"), n(2).alias("n_hex"),
        F.sha2(N.joined(base, KINDS), 256).alias("base_sha256"), N.joined(F.col("spans"), KINDS).alias("spans"),
    )
