"""Personal data: found by pattern, and what reveals it sanitised by information theory.

Mail addresses, IP addresses, card numbers and phone numbers are found by pattern. Each distinct value is an entity to
protect. The corpus tells how strongly a term reveals an entity. All counts are over distinct texts of the whole corpus: n texts,
n_e with the entity, n_t with the term, wherever it stands, and n_j with the term in a sentence of the entity. An entity's
information is IC = log2(n / n_e), what a term tells about it is the pointwise mutual information
PMI = log2(n n_j / (n_e n_t)). In the sentences of the entity a term is

* removed (kind ``term``) where PMI reaches ``DISCLOSE`` of IC: it all but names the entity;
* generalised (kind ``hint``) where PMI reaches ``NARROW`` of IC: it narrows the entity down.

Both need ``SUPPORT`` different sentences (by their terms) in common, so copies are no evidence of their own, and only an entity
of at least ``LEAST_IC`` bits is protected by its terms: what stands in a large part of all texts is no secret about anyone.
A term is a word of two or more letters or digits, one letter at least, with hyphens, apostrophes and ampersands inside it. A
sentence is read on either side of a match as far as the next match of the same kind, which has a sentence of its own.

The texts are read twice: for matches, and for n_t. A term that can reach a threshold at all has a greatest n_t, and
terms that occur beside entities more often are known to be above it, so only the few that are left are counted.

SQL functions only. Sentences become narrow rows, one per word, and counts are summed before they are shuffled, so a value that
a third of all rows hold is one sum per task.

Edge cases: null is empty text; empty texts have no spans; repeated rows are scanned each; an empty table gives an empty
result; extra columns stay in a struct and cannot clash.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tableflow.llm import native_spans as N
from tableflow.session import pinned

#: The base patterns, in loops that never backtrack.
PATTERNS = {
    "email": "(?:\\G|(?<![A-Za-z0-9._%+-]))[A-Za-z0-9._%+-]++@[A-Za-z0-9-]++(?:\\.[A-Za-z0-9-]++)++",
    "ip": "(?<![0-9])[0-9]++\\.[0-9]++\\.[0-9]++\\.[0-9]++",
    "card": "(?<![0-9])(?<![0-9][\\x20-])[0-9](?:[\\x20-]?[0-9]){15,18}+(?![\\x20-]?[0-9])",
    "phone": "\\+[0-9][\\x20().0-9-]+[0-9]",
}
KINDS = [*PATTERNS, "term", "hint"]
MASKS = ["<EMAIL>", "<IP>", "<CARD>", "<PHONE>", "", "<TERM>"]
TERM = "[\\p{L}\\p{N}]++(?:[-'’&][\\p{L}\\p{N}]++)*+"
SUPPORT = 3
LEAST_IC = 4.0
DISCLOSE = 0.95
NARROW = 0.8


def scan(docs: DataFrame, carry: list[str], text: str = "text") -> DataFrame:
    """uid, struct ``doc`` of the carried columns, ``h`` for the text, and the matches of every pattern, written once."""
    src = docs.select(
        F.struct(*[F.col(f"`{c}`") for c in carry]).alias("doc"), F.coalesce(F.col(f"`{text}`"), F.lit("")).alias("text")
    ).withColumn("h", F.xxhash64("text"))
    return N.numbered(N.matched(src, "text", PATTERNS, context=True).drop("text"), "pii_matches")


def _luhn(digits: Column) -> Column:
    """Whether a string of digits passes the Luhn check."""
    rev = F.reverse(digits)
    total = F.aggregate(
        F.sequence(F.lit(1), F.char_length(digits)), F.lit(0),
        lambda a, i: a + F.when(i % 2 == 1, F.substr(rev, i, F.lit(1)).cast("int")).otherwise(
            (F.substr(rev, i, F.lit(1)).cast("int") * 2) % 10 + F.floor(F.substr(rev, i, F.lit(1)).cast("int") / 5).cast("int")
        ),
    )
    return total % 10 == 0


def valid(at: DataFrame) -> DataFrame:
    """The located matches that are what their pattern looks for."""
    digits = F.regexp_replace("value", "[^0-9]", "")
    part = F.transform(F.split("value", "\\."), lambda p: F.regexp_replace(p, "^0+(?=[0-9])", ""))
    small = F.forall(part, lambda p: (F.char_length(p) <= 3) & (F.substr(p, F.lit(1), F.lit(3)).cast("int") <= 255))
    ok = (
        F.when(F.col("kind") == 0, True).when(F.col("kind") == 1, small)
        .when(F.col("kind") == 2, F.char_length(digits).between(16, 19) & _luhn(digits))
        .otherwise(F.char_length(digits).between(8, 15))
    )
    return at.where(ok)


def contexts(base: DataFrame) -> DataFrame:
    """uid, entity, t, start and end of every term in a sentence of a match, and ``sentence``, its number in the match's kind."""
    entity = F.xxhash64("kind", F.lower("value")).alias("entity")
    sides = F.array(
        F.struct(F.lit(0).alias("side"), (F.col("start") - F.char_length("before")).alias("at"), F.col("before").alias("text")),
        F.struct(F.lit(1).alias("side"), F.col("end").alias("at"), F.col("after").alias("text")),
    )
    seg = base.select("uid", entity, "kind", "pos", F.inline(sides)).where(F.col("text").rlike("\\p{L}"))
    found, gaps = F.regexp_extract_all("text", F.lit(TERM), F.lit(0)), F.split("text", TERM, -1)
    each = seg.select("uid", "entity", "kind", "pos", "side", "at", F.posexplode(F.arrays_zip(
        found.alias("v"), F.transform(F.slice(gaps, F.lit(1), F.size(found)), lambda g: F.char_length(g)).alias("gap"))).alias("i", "x"))
    sides_of = Window.partitionBy("uid", "kind", "pos", "side").orderBy("i").rowsBetween(Window.unboundedPreceding, 0)
    end = F.col("at") + F.sum(F.col("x.gap") + F.char_length("x.v")).over(sides_of)
    each = each.select("uid", "entity", F.struct("kind", "pos").alias("sentence"), F.lower("x.v").alias("t"), F.char_length("x.v").alias("len"), end.alias("end"))
    return each.where((F.col("len") >= 2) & F.col("t").rlike("\\p{L}")).select("uid", "entity", "sentence", "t", (F.col("end") - F.col("len")).alias("start"), "end")


def texts_with(docs: DataFrame, text: str, terms: DataFrame) -> DataFrame:
    """t and n_t: in how many distinct texts each of some terms (t) occurs."""
    body = F.col(f"`{text}`")
    each = docs.select(F.xxhash64(body).alias("h"), F.explode(F.array_distinct(F.regexp_extract_all(body, F.lit(TERM), F.lit(0)))).alias("v"))
    each = each.select("h", F.lower("v").alias("t")).join(terms, "t", "left_semi").distinct()
    return each.groupBy("t").agg(F.count(F.lit(1)).alias("n_t"))


def revealing(ctx: DataFrame, base: DataFrame, found: DataFrame, docs: DataFrame, text: str) -> DataFrame:
    """entity, t and ``kind`` (4 removed, 5 generalised) of the terms that reveal an entity too well."""
    h = found.select("uid", "h")
    total = found.agg(F.count_distinct("h").alias("n"))
    by_entity = base.select("uid", F.xxhash64("kind", F.lower("value")).alias("entity")).distinct().join(h, "uid")
    by_entity = by_entity.groupBy("entity").agg(F.count_distinct("h").alias("n_e"))
    alike = ctx.groupBy("uid", "entity", "sentence").agg(F.xxhash64(F.array_sort(F.collect_set("t"))).alias("words"))
    occ = ctx.select("uid", "entity", "sentence", "t").distinct().join(alike, ["uid", "entity", "sentence"]).join(h, "uid")
    occ = pinned(occ.select("entity", "t", "h", "words").distinct(), "pii_terms")
    joint = occ.groupBy("entity", "t").agg(F.count_distinct("h").alias("n_j"), F.count_distinct("words").alias("support"))
    beside = occ.groupBy("t").agg(F.count_distinct("h").alias("n_beside"))
    ic = F.log2(F.col("n") / F.col("n_e"))
    # PMI reaches NARROW of IC up to this many texts with the term.
    most = F.col("n") * F.col("n_j") / F.col("n_e") * F.pow(F.col("n_e") / F.col("n"), F.lit(NARROW))
    able = joint.where(F.col("support") >= SUPPORT).join(by_entity, "entity").join(F.broadcast(total), F.lit(True))  # one row
    able = able.where(ic >= LEAST_IC).join(beside, "t").where(F.col("n_beside") <= most)
    able = pinned(able.select("entity", "t", "n", "n_e", "n_j"), "pii_able")
    scored = able.join(texts_with(docs, text, able.select("t").distinct()), "t")
    pmi = F.log2(F.col("n") * F.col("n_j") / (F.col("n_e") * F.col("n_t")))
    kind = F.when(pmi >= DISCLOSE * ic, 4).when(pmi >= NARROW * ic, 5)
    return scored.select("entity", "t", kind.alias("kind")).where("kind is not null")


def spans(found: DataFrame, docs: DataFrame, text: str) -> DataFrame:
    """uid, kind number, start, end of all personal data and of the terms that reveal it."""
    base = pinned(valid(N.located(found, list(PATTERNS))), "pii_base")
    ctx = pinned(contexts(base), "pii_contexts")
    shown = ctx.join(revealing(ctx, base, found, docs, text), ["entity", "t"])
    shown = shown.groupBy("uid", "start").agg(F.min("kind").alias("kind"), F.max("end").alias("end"))
    cols = ["uid", "kind", "start", "end"]
    return base.select(*cols).unionByName(shown.select(*cols))


def personal_data(docs: DataFrame, carry: list[str], text: str = "text") -> DataFrame:
    """``doc`` and ``spans`` (kind number, start, end; ordered by kind, then start) of every text.

    Only texts with a match are joined to their spans; the others pass as they were written.
    """
    found = scan(docs, carry, text)
    per = spans(found, docs, text).groupBy("uid").agg(F.array_sort(F.collect_list(F.struct("kind", "start", "end"))).alias("spans"))
    none = F.array().cast("array<struct<kind:int,start:bigint,end:bigint>>")
    some = reduce(lambda a, b: a | b, [F.col(kind).isNotNull() for kind in PATTERNS])
    hit = found.where(some).select("uid", "doc").join(per, "uid", "left").select("doc", F.coalesce("spans", none).alias("spans"))
    return hit.unionByName(found.where(~some).select("doc", none.alias("spans")))


def digest(docs: DataFrame) -> DataFrame:
    s = personal_data(docs, ["doc_id"])

    def n(kind: int) -> Column:
        return F.size(F.filter("spans", lambda x: x["kind"] == kind)).cast("long")

    return s.select(
        F.col("doc.doc_id").alias("doc_id"), n(0).alias("n_email"), n(1).alias("n_ip"), n(2).alias("n_card"), n(3).alias("n_phone"),
        F.sha2(N.joined(F.filter("spans", lambda x: x["kind"] < 4), KINDS), 256).alias("base_sha256"),
        N.joined(F.col("spans"), KINDS).alias("spans"),
    )


def _disjoint(spans: Column) -> Column:
    """Spans by start, those that overlap an earlier one joined to it under its kind."""
    order = F.array_sort(F.transform(spans, lambda s: F.struct(s["start"].alias("s"), s["end"].alias("e"), s["kind"].alias("k"))))
    none = F.array().cast("array<struct<s:bigint,e:bigint,k:int>>")

    def add(acc, x):
        last = F.element_at(acc, -1)
        grown = F.concat(
            F.slice(acc, F.lit(1), F.size(acc) - 1),
            F.array(F.struct(last["s"].alias("s"), F.greatest(last["e"], x["e"]).alias("e"), last["k"].alias("k"))),
        )
        fresh = F.concat(acc, F.array(x))
        return F.when(F.size(acc) == 0, fresh).when(x["s"] < last["e"], grown).otherwise(fresh)

    return F.aggregate(order, none, add)


def sanitised(docs: DataFrame, text: str = "text") -> DataFrame:
    """The documents with each span replaced by its mask; ``n_chars``, where there is one, is counted anew."""
    s = personal_data(docs, docs.columns, text)
    body = F.col(f"doc.`{text}`")
    masks = F.array(*[F.lit(m) for m in MASKS])
    s = s.withColumn("cut", _disjoint(F.col("spans")))
    # What stands before each span with the span's mask, and the rest.
    parts = F.transform("cut", lambda x, i: F.concat(
        F.substr(body, _after(i) + 1, (x["s"] - _after(i)).cast("int")), masks[x["k"]]
    ))
    rest = F.substr(body, F.coalesce(F.element_at("cut", -1)["e"], F.lit(0)).cast("int") + 1, F.char_length(body))
    new = F.when(F.size("cut") == 0, body).otherwise(F.concat(F.array_join(parts, ""), rest))
    out = s.withColumn("new", new)
    return out.select(*[
        F.col("new").alias(c) if c == text
        else F.when(F.size("cut") == 0, F.col(f"doc.`{c}`")).otherwise(F.char_length("new").cast(docs.schema[c].dataType)).alias(c)
        if c == "n_chars" else F.col(f"doc.`{c}`")
        for c in docs.columns
    ])


def _after(i: Column) -> Column:
    """Where the span before number ``i`` ends."""
    return F.when(i == 0, F.lit(0)).otherwise(F.get(F.col("cut"), i - 1)["e"]).cast("int")
