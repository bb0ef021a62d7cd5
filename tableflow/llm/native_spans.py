"""Regular-expression matches with code-point positions, by SQL functions only.

``regexp_extract_all`` gives the matches and ``split`` by the same pattern what lies between them; the running sum of both
lengths is where each match stands. Matches become narrow rows, and the running sum is a window per text and kind, so
a text with very many matches takes linear time. Patterns use possessive loops and look-behind, so that no search
takes more than linear time or deep recursion on very long runs.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tableflow.session import pinned

#: Where a sentence ends: at white space after its last mark, or at a line's end.
SENTENCE = "(?<=[.!?。！？])\\s++|\\n++"


def matched(df: DataFrame, text: str, patterns: dict[str, str], context: bool = False) -> DataFrame:
    """``df`` with one array column per kind: structs of pos, gap, len, value (and the rest of its sentence before and after,
    up to the next match of its kind)."""
    kept = df.columns
    for kind, p in patterns.items():
        df = df.withColumn(f"m_{kind}", F.regexp_extract_all(F.col(text), F.lit(p), F.lit(0)))
    for kind, p in patterns.items():
        df = df.withColumn(f"p_{kind}", F.when(F.size(f"m_{kind}") > 0, F.split(F.col(text), p, -1)))
    return df.select(*kept, *[_zipped(kind, context) for kind in patterns])


def _zipped(kind: str, context: bool) -> Column:
    m, p = F.col(f"m_{kind}"), F.col(f"p_{kind}")
    parts = F.arrays_zip(m.alias("v"), F.slice(p, F.lit(1), F.size(m)).alias("a"), F.slice(p, F.lit(2), F.size(m)).alias("b"))

    def one(x: Column, i: Column) -> Column:
        around = [F.element_at(F.split(x["a"], SENTENCE, -1), -1).alias("before"), F.split(x["b"], SENTENCE, 2)[0].alias("after")]
        return F.struct(
            i.alias("pos"), F.char_length(x["a"]).alias("gap"), F.char_length(x["v"]).alias("len"), x["v"].alias("value"),
            *(around if context else []),
        )

    return F.when(F.size(m) > 0, F.transform(parts, one)).alias(kind)


def located(found: DataFrame, kinds: list[str], uid: str = "uid") -> DataFrame:
    """Rows (uid, kind number, value, start, end, ...) of all matches in ``found``'s array columns."""
    parts = None
    for i, kind in enumerate(kinds):
        rows = found.where(F.col(kind).isNotNull()).select(uid, F.lit(i).alias("kind"), F.inline(kind))
        parts = rows if parts is None else parts.unionByName(rows)
    w = Window.partitionBy(uid, "kind").orderBy("pos").rowsBetween(Window.unboundedPreceding, 0)
    end = F.sum(F.col("gap") + F.col("len")).over(w)
    return parts.withColumn("end", end).withColumn("start", F.col("end") - F.col("len")).drop("gap", "len")


def numbered(df: DataFrame, name: str) -> DataFrame:
    """``df`` written once, each row with a ``uid`` of its own, so that equal rows stay apart."""
    return pinned(df.withColumn("uid", F.monotonically_increasing_id()), name)


def joined(spans: Column, kinds: list[str]) -> Column:
    """``kind:start:end`` of an ordered array of spans, comma-joined."""
    names = F.array(*[F.lit(k) for k in kinds])
    return F.array_join(
        F.transform(spans, lambda s: F.concat_ws(":", names[s["kind"]], s["start"].cast("string"), s["end"].cast("string"))), ","
    )
