"""Spelling variants: words one edit apart, found by a dictionary of trie-node pairs.

Words are numbered once in a trie of their beginnings and once in a trie of their endings. A word skipped at position i is
the pair (node of what stands before, node of what stands after); a word split there without a skip is a pair too. Two
words differ by a replaced character if they have a skipped pair in common, and by an inserted or deleted one if a
skipped pair of the longer is a split pair of the shorter. Nodes are exact numbers, not hashes, so equal pairs are
neighbours without a check.

1. Occurrences are counted by SQL functions over whole texts.
2. Distinct words are dealt to ranges of about ``PER_PART`` words by splitters from a sample. A range sorts its words and
   numbers a node when a word leaves the path of the word before it. A node that reaches over the end of a range is
   numbered after the first range that has it; the least and greatest words of all ranges (a row each) tell which.
3. A node with one word below it cannot be in a common pair and is not written; most deep nodes go there.
4. Pairs meet in one shuffle. A skipped pair has at most one word for each character and a split pair is one word, so no
   group of pairs grows with the number of words or their counts.

Counts are summed before they are shuffled, so a word in a third of all texts is one row per task.

Edge cases: null and empty texts have no words; a null id counts as an empty one; repeated rows count each; an empty table
gives an empty result; very long words are kept whole; only the id and the text column are read, so others cannot clash.
"""

from __future__ import annotations

from bisect import bisect_right
from collections.abc import Sequence

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tableflow.llm import texts as X
from tableflow.session import pinned

#: Fixed values of the contract: letters, least length and count of a word, how often letters go astray.
LETTERS = "A-Za-zÀ-ÿ"
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
LEAST_LENGTH = 7
LEAST_COUNT = 2
ASTRAY = 31
#: How much more frequent a word's form must be.
TIMES = 10
PER_PART = 200_000
SAMPLE = 20_000
_PART = 40
_EDGE = 1 << 39


def counted(docs: DataFrame, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """word and n of every word of enough characters and occurrences."""
    # A run that is too short cannot become a word, and a match of the least length or more is a whole run.
    found = F.regexp_extract_all(F.col(f"`{text}`"), F.lit(f"[{LETTERS}]{{{LEAST_LENGTH},}}+"), F.lit(0))
    runs = docs.select(F.coalesce(F.col(f"`{doc_id}`").cast("string"), F.lit("")).alias("id"), F.explode(found).alias("run"))
    runs = runs.select("id", F.translate("run", UPPER, LOWER).alias("run"))
    runs = runs.select("run", F.crc32(F.concat("id", F.lit(":"), "run").cast("binary")).alias("h"))
    at = (F.col("h") % F.char_length("run")).cast("int")
    cut = F.concat(F.substr("run", F.lit(1), at), F.substr("run", at + 2))
    words = runs.select(F.when(F.col("h") % ASTRAY == 0, cut).otherwise(F.col("run")).alias("word"))
    words = words.where(F.char_length("word") >= LEAST_LENGTH)
    return words.groupBy("word").agg(F.count(F.lit(1)).alias("n")).where(F.col("n") >= LEAST_COUNT)


def shared(a: str, b: str) -> int:
    """Length of the common beginning."""
    if b.startswith(a):
        return len(a)
    n = min(len(a), len(b))
    lo = 0
    while lo < n and a[lo] == b[lo]:
        lo += 1
    return lo


def homes(ends: Sequence[tuple[int, str, str]]) -> dict[int, list[int]]:
    """For each range (number, least word, greatest word), in order: the first range of each beginning of its least word
    that an earlier range has too."""
    out: dict[int, list[int]] = {}
    before, of_before = "", []
    for part, first, last in ends:
        mine = of_before[: shared(before, first) + 1]
        out[part] = mine
        keep = min(shared(first, last) + 1, len(mine))
        of_before = mine[:keep] + [part] * (len(last) + 1 - keep)
        before = last
    return out


def path_numbers(words: list[str], part: int, earlier: list[int]) -> list[np.ndarray]:
    """Nodes of the beginnings of sorted distinct words of one range, from the empty one on, as far as others may share them.

    A beginning of the range's last word may reach into later ranges, so its number says range and length only.
    """
    base, last, count = part << _PART, words[-1], 0
    out, path = [], []
    common = [0, *[shared(a, b) for a, b in zip(words, words[1:], strict=False)], 0]
    for k, w in enumerate(words):
        edge = shared(w, last)
        keep = common[k] + 1 if k else 0
        path = path[:keep]
        for depth in range(keep, len(w) + 1):
            if k == 0 and depth < len(earlier):
                path.append(earlier[depth] << _PART | _EDGE | depth)
            elif depth <= edge:
                path.append(base | _EDGE | depth)
            else:
                path.append(base | count)
                count += 1
        reach = max(common[k], common[k + 1], edge, len(earlier) - 1 if k == 0 else 0)
        out.append(np.array(path[: reach + 1], np.int64))
    return out


def nodes(words: DataFrame, per_part: int = PER_PART) -> DataFrame:
    """wid and the ``path`` of node numbers of each distinct word (wid, word)."""
    n = words.count()
    parts = max(1, -(-n // per_part))
    splitters: list[str] = []
    if parts > 1:
        every = max(1, n // SAMPLE)
        sample = sorted(r.word for r in words.where(F.pmod(F.xxhash64("word"), F.lit(every)) == 0).select("word").collect())
        splitters = sorted({sample[len(sample) * i // parts] for i in range(1, parts)}) if sample else []

    def deal(batches):
        for b in batches:
            of = [bisect_right(splitters, w) for w in b.column(1).to_pylist()]
            yield pa.RecordBatch.from_arrays([pa.array(of, pa.int32()), *b.columns], names=["part", "wid", "word"])

    dealt = pinned(X.small_batches(words.select("wid", "word")).mapInArrow(deal, "part int, wid long, word string"), "spelling_ranges")
    ends = dealt.groupBy("part").agg(F.min("word").alias("lo"), F.max("word").alias("hi")).orderBy("part").collect()
    known = homes([(r.part, r.lo, r.hi) for r in ends])

    def number(table: pa.Table) -> pa.Table:
        part = table.column("part")[0].as_py()
        table = table.take(pa.compute.sort_indices(table, [("word", "ascending")]))
        paths = path_numbers(table.column("word").to_pylist(), part, known[part])
        offsets = np.append(0, np.cumsum([len(p) for p in paths]))
        flat = pa.array(np.concatenate(paths))
        return pa.table({"wid": table.column("wid"), "path": pa.LargeListArray.from_arrays(offsets, flat).cast(pa.list_(pa.int64()))})

    return dealt.groupBy("part").applyInArrow(number, "wid long, path array<long>")


def near_pairs(words: DataFrame, per_part: int = PER_PART) -> DataFrame:
    """(a, b) of all ordered pairs of words (wid, word) that differ by one character."""
    fore = nodes(words, per_part).withColumnRenamed("path", "f")
    back = nodes(words.select("wid", F.reverse("word").alias("word")), per_part).withColumnRenamed("path", "r")
    size = words.select("wid", F.char_length("word").alias("len"))
    paths = pinned(fore.join(back, "wid").join(size, "wid"), "spelling_paths")
    # Position i has f[i] before it; what follows a skip has len - i - 1 characters, what follows a split len - i.
    skips = "transform(sequence(greatest(0, len - size(r)), least(len - 1, size(f) - 1)), i -> struct(f[i] as p, r[len - i - 1] as s, true as skip))"
    splits = "transform(sequence(greatest(0, len - size(r) + 1), least(len, size(f) - 1)), i -> struct(f[i] as p, r[len - i] as s, false as skip))"
    skips = f"if(greatest(0, len - size(r)) <= least(len - 1, size(f) - 1), {skips}, array())"
    splits = f"if(greatest(0, len - size(r) + 1) <= least(len, size(f) - 1), {splits}, array())"
    keys = paths.select("wid", F.explode(F.expr(f"concat({skips}, {splits})")).alias("k")).select("wid", "k.*")
    met = keys.groupBy("p", "s").agg(
        F.collect_list(F.when(F.col("skip"), F.col("wid"))).alias("skipped"), F.max(F.when(~F.col("skip"), F.col("wid"))).alias("split")
    ).where("size(skipped) + if(split is null, 0, 1) > 1 and size(skipped) > 0")
    # A skipped pair has at most one word per character.
    alike = met.select(F.explode("skipped").alias("a"), "skipped").select("a", F.explode("skipped").alias("b")).where("a <> b")
    longer = met.where("split is not null").select("split", F.explode("skipped").alias("b"))
    longer = longer.select(F.inline(F.array(
        F.struct(F.col("split").alias("a"), "b"), F.struct(F.col("b").alias("a"), F.col("split").alias("b"))
    )))
    return alike.unionByName(longer.distinct())  # equal neighbouring characters give one edit at several places


def roots(forms: DataFrame) -> DataFrame:
    """word and root: the last word reached by following ``forms`` (word, form). Each step multiplies n, so there are few."""
    at = pinned(forms.select("word", F.col("form").alias("root")), "spelling_roots")
    while True:
        step = at.select(F.col("word").alias("root"), F.col("root").alias("further"))
        new = pinned(at.join(step, "root", "left").select("word", F.coalesce("further", "root").alias("root"), F.col("further").isNotNull().alias("moved")), "spelling_roots")
        at = new.select("word", "root")
        if new.where("moved").isEmpty():
            return at


def variants(words: DataFrame, per_part: int = PER_PART) -> DataFrame:
    """word, form, root, n, n_near, form_n of distinct words (word, n)."""
    words = pinned(words.select("word", "n", F.monotonically_increasing_id().alias("wid")), "spelling_words")
    other = words.select(F.col("wid").alias("b"), F.struct((-F.col("n")).alias("less"), "word").alias("other"))
    near = near_pairs(words, per_part).join(other, "b").groupBy(F.col("a").alias("wid")).agg(
        F.count(F.lit(1)).alias("n_near"), F.min("other").alias("best")
    )
    has = -F.col("best.less") >= TIMES * F.col("n")
    out = words.join(near, "wid", "left").select(
        "word", "n", F.coalesce("n_near", F.lit(0)).cast("long").alias("n_near"),
        F.when(has, F.col("best.word")).alias("form"), F.when(has, -F.col("best.less")).alias("form_n"),
    )
    out = pinned(out, "spelling_forms")
    ends = roots(out.where("form is not null"))
    return out.join(ends, "word", "left").select("word", "form", F.coalesce("root", "word").alias("root"), "n", "n_near", "form_n")


def digest(docs: DataFrame) -> DataFrame:
    return variants(counted(docs))
