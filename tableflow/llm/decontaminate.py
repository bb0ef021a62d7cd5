"""Benchmark decontamination by a prefix-filtered set join.

An item is a set of windows of ``WINDOW`` consecutive words (one shorter window if it has fewer words), a window a set
of word shingles. Shingles are ordered by rarity in the corpus. A window can only occur where all its shingles
do, so its prefix is one shingle, the rarest; only that one is joined with the texts. A match gives the only place
the window can have; length and position bounds drop it if the window would leave the text, and the words are
then compared one by one.

Texts are scanned twice, once for the shingles' document frequencies and once for the join; nothing about documents
is shuffled or collected. Benchmark items go to the tasks in blocks of bounded size (``BLOCK_BYTES`` of text), and more
blocks mean more steps in the same scan.

Edge cases: null, empty or word-free texts have no words and are never contaminated; items with a null id or no words
are skipped; rows with the same item id are one item with the windows of all; repeated documents each get their row;
empty tables give empty results; extra columns are kept apart from the results in a struct.
"""

from __future__ import annotations

import re

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tableflow.llm import texts as X

WINDOW = 13
SHINGLE = 5
BLOCK_BYTES = 8 << 20
#: A text is contaminated if this many times its hit words reach its words.
SHARE = 20

_WORD = re.compile(rb"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")

FIELDS = [
    T.StructField("n_words", T.LongType()),
    T.StructField("hit_starts", T.ArrayType(T.LongType())),
    T.StructField("hit_ends", T.ArrayType(T.LongType())),
    T.StructField("items", T.ArrayType(T.StringType())),
]


class Block:
    """Windows of some items and the shingles they are made of."""

    def __init__(self, items: list[tuple[str, str]], window: int, shingle: int):
        by_id: dict[str, set[tuple[bytes, ...]]] = {}
        for item, text in items:
            words = _WORD.findall((text or "").encode().lower())  # bytes.lower() changes A-Z only
            if item is None or not words:
                continue
            m = min(window, len(words))
            by_id.setdefault(item, set()).update(tuple(words[i : i + m]) for i in range(len(words) - m + 1))
        owners: dict[tuple[bytes, ...], list[str]] = {}
        for item in sorted(by_id):
            for w in by_id[item]:
                owners.setdefault(w, []).append(item)
        self.windows = sorted(owners)
        self.owners = [owners[w] for w in self.windows]
        lengths, hashes, spans = [], [], []  # of each window's shingles
        for w in self.windows:
            q = min(shingle, len(w))
            line = b" ".join(w)
            c = X.Chunk(np.frombuffer(line, np.uint8), np.array([0, len(line)]))
            c.words(X.ALNUM)
            c.word_hashes()
            _, h = c.ngrams(q)
            lengths.append(q)
            hashes.append(h)
            spans.append(len(h))
        self.q = np.array(lengths, np.int64)
        self.shingles = hashes
        self.tokens: dict[int, np.ndarray] = {}
        for q in sorted(set(lengths)):
            self.tokens[q] = np.unique(np.concatenate([h for h, k in zip(hashes, lengths, strict=True) if k == q]))

    def rarest(self, df: dict[tuple[int, int], int]) -> dict[int, tuple[np.ndarray, dict[int, list[tuple[int, int]]]]]:
        """By shingle length: prefix shingles sorted, and for each the (window, offset) pairs it stands for."""
        out: dict[int, dict[int, list[tuple[int, int]]]] = {}
        for w, h in enumerate(self.shingles):
            q = int(self.q[w])
            at = min(range(len(h)), key=lambda i: (df.get((q, int(h[i])), 0), int(h[i])))
            out.setdefault(q, {}).setdefault(int(h[at]), []).append((w, at))
        return {q: (np.array(sorted(d), np.uint64), d) for q, d in out.items()}


def _found(c: X.Chunk, q: int, tokens: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """First words and token numbers of the chunk's shingles of q words that are among ``tokens``."""
    at, h = c.ngrams(q)
    i = np.searchsorted(tokens, h)
    i[i == len(tokens)] = 0
    ok = tokens[i] == h
    return at[ok], i[ok]


def _chunk(c: X.Chunk) -> X.Chunk:
    c.lower()
    c.words(X.ALNUM)
    c.word_hashes()
    return c


def frequencies(docs: DataFrame, text: str, block: Block) -> dict[tuple[int, int], int]:
    """Number of texts in which each shingle of the block occurs: one sum per shingle reaches the driver."""
    tokens = block.tokens

    def run(batches):
        total = {q: np.zeros(len(t), np.int64) for q, t in tokens.items()}
        for batch in batches:
            for _, _, c in X.chunks(batch.column(0)):
                _chunk(c)
                for q, t in tokens.items():
                    at, i = _found(c, q, t)
                    once = np.unique(c.doc[at] * len(t) + i)
                    total[q] += np.bincount(once % len(t), minlength=len(t))
        for q, n in total.items():
            some = np.flatnonzero(n)
            yield pa.RecordBatch.from_arrays(
                [pa.array(np.full(len(some), q)), pa.array(tokens[q][some].view(np.int64)), pa.array(n[some])],
                names=["q", "token", "n"],
            )

    found = X.small_batches(docs.select(F.col(f"`{text}`").alias("text"))).mapInArrow(run, "q long, token long, n long")
    rows = found.groupBy("q", "token").agg(F.sum("n").alias("n")).collect()
    return {(r.q, r.token % (1 << 64)): r.n for r in rows}


def _matches(c: X.Chunk, block: Block, prefix) -> tuple[list[list[tuple[int, int]]], list[set[str]]]:
    """Per text of the chunk: word ranges of window occurrences, counted from its first word, and their items."""
    spans: list[list[tuple[int, int]]] = [[] for _ in range(c.n)]
    items: list[set[str]] = [set() for _ in range(c.n)]
    for q, (tokens, places) in prefix.items():
        at, i = _found(c, q, tokens)
        for pos, k in zip(at.tolist(), i.tolist(), strict=True):
            d = int(c.doc[pos])
            lo, hi = int(c.first[d]), int(c.first[d + 1])
            for w, off in places[int(tokens[k])]:
                s, words = pos - off, block.windows[w]
                if s < lo or s + len(words) > hi:
                    continue
                if all(c.data[c.ws[s + j] : c.we[s + j]].tobytes() == x for j, x in enumerate(words)):
                    spans[d].append((s - lo, s - lo + len(words)))
                    items[d].update(block.owners[w])
    return spans, items


def _merged(spans: list[tuple[int, int]]) -> list[tuple[int, int]]:
    out: list[tuple[int, int]] = []
    for s, e in sorted(spans):
        if out and s <= out[-1][1]:
            out[-1] = (out[-1][0], max(e, out[-1][1]))
        else:
            out.append((s, e))
    return out


def hits(
    docs: DataFrame, benchmark: DataFrame, carry: list[str], text: str = "text", item_id: str = "item_id",
    item_text: str = "text", window: int = WINDOW, shingle: int = SHINGLE, block_bytes: int = BLOCK_BYTES,
) -> DataFrame:
    """``doc`` (the carried columns) and ``out``: n_words, hit word ranges as two arrays, and sorted item ids."""
    items = benchmark.select(F.col(f"`{item_id}`").cast("string").alias("item"), F.col(f"`{item_text}`").alias("text"))
    size = items.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    n_blocks = max(1, -(-size // block_bytes))
    out = None
    for k in range(n_blocks):
        part = items.where(F.pmod(F.xxhash64("item"), F.lit(n_blocks)) == k)
        block = Block([(r.item, r.text) for r in part.toLocalIterator()], window, shingle)
        prefix = block.rarest(frequencies(docs, text, block))
        if out is None:
            out = _joined(docs, text, carry if n_blocks == 1 or text in carry else [*carry, text], block, prefix)
        else:
            out = _joined_more(out, text, block, prefix)
    return out


def _arrays(n_words, spans, items) -> list[pa.Array]:
    return [
        pa.array(n_words, pa.int64()),
        pa.array([[s for s, _ in x] for x in spans], pa.list_(pa.int64())),
        pa.array([[e for _, e in x] for x in spans], pa.list_(pa.int64())),
        pa.array([sorted(x) for x in items], pa.list_(pa.string())),
    ]


def _joined(docs, text, carry, block, prefix) -> DataFrame:
    def results(column):
        for _, _, c in X.chunks(column):
            spans, items = _matches(_chunk(c), block, prefix)
            yield _arrays(np.diff(c.first), [_merged(s) for s in spans], items)

    return X.per_text(docs, text, carry, FIELDS, results)


def _joined_more(before: DataFrame, text, block, prefix) -> DataFrame:
    """The next block's matches added to those of the blocks before, in the same scan."""
    src = before.select("doc", "out", F.col(f"doc.`{text}`").alias("text"))
    schema = T.StructType([src.schema["doc"], src.schema["out"]])

    def run(batches):
        for batch in batches:
            old = batch.column(1).to_pylist()
            for i, j, c in X.chunks(batch.column(2)):
                spans, items = _matches(_chunk(c), block, prefix)
                for d, was in enumerate(old[i:j]):
                    spans[d] = _merged([*spans[d], *zip(was["hit_starts"], was["hit_ends"], strict=True)])
                    items[d] |= set(was["items"])
                got = pa.StructArray.from_arrays(
                    _arrays(np.diff(c.first), spans, items), names=[f.name for f in FIELDS]
                )
                yield pa.RecordBatch.from_arrays([batch.column(0).slice(i, j - i), got], names=["doc", "out"])

    return src.mapInArrow(run, schema)


def n_hit():
    """Words inside any hit range; ranges are disjoint."""
    total = F.aggregate("out.hit_ends", F.lit(0).cast("long"), lambda a, x: a + x)
    return total - F.aggregate("out.hit_starts", F.lit(0).cast("long"), lambda a, x: a + x)


def contaminated():
    return (n_hit() > 0) & (n_hit() * SHARE >= F.col("out.n_words"))


def digest(found: DataFrame) -> DataFrame:
    """The contract's columns; item ids are sorted as strings by code point."""
    return found.select(
        F.col("doc.doc_id").alias("doc_id"), F.col("out.n_words").alias("n_words"), n_hit().alias("n_hit"),
        F.size("out.items").cast("long").alias("n_items"),
        F.sha2(F.concat_ws(",", "out.items"), 256).alias("items_sha256"), contaminated().alias("contaminated"),
    )


def clean(docs: DataFrame, benchmark: DataFrame) -> DataFrame:
    """The documents that are not contaminated, with their own columns."""
    found = hits(docs, benchmark, docs.columns)
    return found.where(~contaminated()).select(*[F.col(f"doc.`{c}`") for c in docs.columns])
