"""Toxicity by a learned lexicon, misspellings included, and the words around each hit.

Lexicon: whole words and word beginnings (for families of inflected words) that labelled toxic texts have and labelled
clean ones hardly. They form a trie. Levenshtein automata walk it: for all distinct words of a chunk at once, a state is
the band of edit distances that are still within reach, and words leave a branch as soon as none is. A word hits
at distance 0 or 1 (whole words of five or more letters may be one edit off).

Context: the ``WINDOW`` words before and after a hit tell quotation (quotation marks around it, words of saying)
from abuse (address to a person, exclamation). All hits, misspelled hits and both contexts, plain and per word, are the
features of a logistic regression, fitted on the labelled sample.

At most about ``MOST_ROWS`` labelled rows are learned from, picked by hash; their ids are sent to all tasks. The lexicon
has at most ``MOST_TERMS`` terms, and as many whole words that a stem covers, for their misspellings. Every text is
scanned whole, and no text is shuffled.

Edge cases: null and empty texts have no hits and get the score of a text without any; labels that are null are not
learned from; without labels, or with one class only, the score is the share of toxic labels (0.5 without any);
an empty table gives an empty result; extra columns stay in a struct.
"""

from __future__ import annotations

from collections import Counter

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tableflow.llm import texts as X
from tableflow.llm.quality_model import remainder, training_labels
from tableflow.session import pinned

MOST_ROWS = 16_000
MOST_TERMS = 1000
MOST_CANDIDATES = 100_000
STEMS = (4, 5, 6)
#: Share of toxic labels among a term's texts, at least, and the lower bound of its texts among all toxic ones.
PURITY = 0.9
SUPPORT = 0.004
LEAST_TEXTS = 4
FUZZY_LENGTH = 5
LONGEST = 32
WINDOW = 5
THRESHOLD = 0.5

#: Words of saying and of address that the context is looked through for.
SAYING = "said says say wrote writes called calls word term quote quoted says dit mot sagte wort dijo palabra".split()
ADDRESS = "you your you're youre u ur tu toi vous votre du dich dein ihr tú te usted".split()

#: Hits count exact and misspelled ones alike, so that a misspelling weighs as its word unless the labels tell otherwise.
FEATURES = ["hits", "fuzzy", "quoted", "addressed", "hits_share", "fuzzy_share", "hits_any", "fuzzy_any"]


def _letters() -> np.ndarray:
    """Bytes of words: letters, digits, apostrophes, the signs that stand for letters in disguise, and beyond ASCII."""
    ok = np.zeros(256, bool)
    ok[[*range(48, 58), *range(65, 91), *range(97, 123), *range(128, 256), *b"'@$*"]] = True
    return ok


_WORD = _letters()


def worded(c: X.Chunk) -> X.Chunk:
    c.lower()
    c.words(_WORD)
    c.word_hashes()
    return c


class Trie:
    """A lexicon of UTF-8 terms; ``stem`` terms accept any longer word."""

    def __init__(self, terms: list[tuple[bytes, bool]]):
        self.children: list[dict[int, int]] = [{}]
        self.word: list[bool] = [False]
        self.stem: list[bool] = [False]
        for term, stem in terms:
            at = 0
            for b in term:
                if b not in self.children[at]:
                    self.children[at][b] = len(self.children)
                    self.children.append({})
                    self.word.append(False)
                    self.stem.append(False)
                at = self.children[at][b]
            self.word[at] |= not stem
            self.stem[at] |= stem


def _padded(c: X.Chunk, at: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Bytes of some words as rows of a matrix, zero beyond their end, and their lengths."""
    length = np.minimum(c.we[at] - c.ws[at], LONGEST + 1)
    cell = np.arange(LONGEST + 2)
    m = c.data[np.minimum(c.ws[at][:, None] + cell, len(c.data) - 1)]
    return np.where(cell < length[:, None], m, 0), length


def distances(trie: Trie, words: np.ndarray, length: np.ndarray) -> np.ndarray:
    """For each word 0 (a term), 1 (one edit from a whole-word term of FUZZY_LENGTH bytes or more) or 2 (no hit).

    Depth first over the trie. At a node of depth d, the words that are still alive have three edit distances between
    the node's string and their first d - 1, d and d + 1 bytes; 2 means two or more.
    """
    best = np.full(len(words), 2, np.uint8)
    every = np.arange(len(words))
    start = np.tile(np.array([2, 0, 1], np.uint8), (len(words), 1))
    stack = [(0, 0, every, start)]
    while stack:
        node, depth, alive, band = stack.pop()
        if trie.stem[node]:
            best[alive[band[:, 1] == 0]] = 0
        if trie.word[node]:
            size = length[alive]
            best[alive[(band[:, 1] == 0) & (size == depth)]] = 0
            if depth >= FUZZY_LENGTH:
                for k in range(3):
                    near = alive[(band[:, k] <= 1) & (size == depth - 1 + k)]
                    best[near] = np.minimum(best[near], 1)
        for b, child in trie.children[node].items():
            # Cells for d, d + 1 and d + 2 bytes of the word at the child's depth d + 1.
            same = words[alive][:, [max(depth - 1, 0), depth, min(depth + 1, LONGEST + 1)]] == b
            new = np.empty_like(band)
            new[:, 0] = np.minimum(band[:, 0] + ~same[:, 0] if depth else 2, band[:, 1] + 1)
            new[:, 1] = np.minimum(np.minimum(band[:, 1] + ~same[:, 1], band[:, 2] + 1), new[:, 0] + 1)
            new[:, 2] = np.minimum(band[:, 2] + ~same[:, 2], new[:, 1] + 1)
            np.minimum(new, 2, out=new)
            keep = new.min(axis=1) <= 1
            if keep.any():
                stack.append((child, depth + 1, alive[keep], new[keep]))
    best[length > LONGEST] = np.where(best[length > LONGEST] == 0, 0, 2)
    return best


class Scanner:
    """Hits and their contexts; distinct words are judged once per chunk."""

    def __init__(self, terms: list[tuple[bytes, bool]]):
        self.trie = Trie(terms)
        self.saying = self._hashes(SAYING)
        self.address = self._hashes(ADDRESS)

    @staticmethod
    def _hashes(words: list[str]) -> np.ndarray:
        line = " ".join(words).encode()
        return np.unique(worded(X.Chunk(np.frombuffer(line, np.uint8), np.array([0, len(line)]))).wh)

    def features(self, c: X.Chunk) -> np.ndarray:
        worded(c)
        n = np.diff(c.first)
        if not len(c.wh):
            return np.zeros((c.n, len(FEATURES)))
        _, first, which = np.unique(c.wh, return_index=True, return_inverse=True)
        found = distances(self.trie, *_padded(c, first))[which]
        hit = np.flatnonzero(found < 2)
        doc, d = c.doc[hit], found[hit]
        quote = (c.data == 0x22) | (c.data == 0x60)
        quotes = np.append(0, np.cumsum(quote))
        shout = np.append(0, np.cumsum(c.data == 0x21))
        lo, hi = np.maximum(hit - WINDOW, c.first[doc]), np.minimum(hit + WINDOW, c.first[doc + 1] - 1)
        before, after = quotes[c.ws[hit]] - quotes[c.ws[lo]], quotes[c.we[hi]] - quotes[c.we[hit]]
        opening = quotes[c.ws[hit]] - quotes[np.maximum(c.ws[lo] - 1, c.start[doc])]
        closing = quotes[np.minimum(c.we[hi] + 1, c.end[doc])] - quotes[c.we[hit]]
        near = np.zeros(len(hit)), np.zeros(len(hit))
        for total, hashes in zip(near, (self.saying, self.address), strict=True):
            at = np.append(0, np.cumsum(np.isin(c.wh, hashes)))
            total += at[hi + 1] - at[lo]
        quoted = ((np.maximum(before, opening) > 0) & (np.maximum(after, closing) > 0)) | (near[0] > 0)
        addressed = (near[1] > 0) | (shout[c.we[hi]] - shout[c.we[hit]] > 0)

        def count(mask):
            return np.bincount(doc[mask], minlength=c.n)

        h, f = count(d < 2), count(d == 1)
        per = np.sqrt(np.maximum(n, 1))
        return np.column_stack([
            np.log1p(h), np.log1p(f), np.log1p(count(quoted)), np.log1p(count(addressed & ~quoted)), h / per, f / per, h > 0, f > 0,
        ]).astype(float)


def _forms(word: bytes) -> list[tuple[bytes, bool]]:
    """A word and its beginnings, as terms; a beginning ends at a whole character."""
    return [(word, False), *[(word[:k], True) for k in STEMS if len(word) > k and (word[k] & 0xC0) != 0x80]]


def _term_counts(known: DataFrame, wanted: dict[tuple[bytes, bool], int] | None) -> DataFrame:
    """term, stem, toxic and clean texts. ``wanted``: count these only, else the terms of toxic texts."""

    def run(batches):
        totals: dict[int, Counter] = {0: Counter(), 1: Counter()}
        for batch in batches:
            y = batch.column(1).to_pylist()
            for i, _, c in X.chunks(batch.column(0)):
                worded(c)
                for d in range(c.n):
                    a, b = int(c.first[d]), int(c.first[d + 1])
                    label = int(y[i + d])
                    if wanted is None and not label:
                        continue
                    _, at = np.unique(c.wh[a:b], return_index=True)
                    words = (c.data[c.ws[a + k] : c.we[a + k]].tobytes() for k in at.tolist())
                    terms = {t for w in words if 3 <= len(w) <= LONGEST for t in _forms(w)}
                    totals[label].update(terms if wanted is None else terms & wanted.keys())
        every = list(totals[0].keys() | totals[1].keys())
        yield pa.RecordBatch.from_arrays(
            [pa.array([t for t, _ in every], pa.binary()), pa.array([s for _, s in every], pa.bool_()),
             pa.array([totals[1][t] for t in every], pa.int64()), pa.array([totals[0][t] for t in every], pa.int64())],
            names=["term", "stem", "toxic", "clean"],
        )

    each = X.small_batches(known.select("text", "y")).mapInArrow(run, "term binary, stem boolean, toxic long, clean long")
    return each.groupBy("term", "stem").agg(F.sum("toxic").alias("toxic"), F.sum("clean").alias("clean"))


def lexicon(known: DataFrame, n_toxic: int, n_clean: int) -> list[tuple[bytes, bool]]:
    """The purest terms of toxic texts. A longer term is left out where a shorter stem has nearly all its texts, except
    that whole words stay for the search of misspellings, which stems take no part in."""
    least = max(LEAST_TEXTS, int(SUPPORT * n_toxic))
    found = _term_counts(known, None).where(F.col("toxic") >= least)
    rows = found.orderBy(F.desc("toxic"), "term", "stem").limit(MOST_CANDIDATES).collect()
    wanted = {(bytes(r.term), r.stem): r.toxic for r in rows}
    clean = {(bytes(r.term), r.stem): r.clean for r in _term_counts(known, wanted).collect()}
    pure = {}
    for t, toxic in wanted.items():
        a, b = toxic / max(n_toxic, 1), (clean.get(t, 0) + 0.5) / max(n_clean, 1)
        if a / (a + b) >= PURITY and toxic > 0.5 * (toxic + clean.get(t, 0)):
            pure[t] = toxic
    ranked = sorted(pure, key=lambda t: (-pure[t], t))
    covered = {t for t in ranked if any(
        (t[0][:k], True) in pure and (t[0][:k], True) != t for k in STEMS if k < len(t[0]) or (k == len(t[0]) and not t[1])
    )}
    fuzzy = [t for t in ranked if t in covered and not t[1] and len(t[0]) >= FUZZY_LENGTH]
    return [t for t in ranked if t not in covered][:MOST_TERMS] + fuzzy[:MOST_TERMS]


def logistic(x: np.ndarray, y: np.ndarray, ridge: float = 1.0, rounds: int = 30) -> np.ndarray:
    """Weights (the first is the constant) by Newton's method."""
    z = np.column_stack([np.ones(len(x)), x])
    w = np.zeros(z.shape[1])
    keep = ridge * np.eye(z.shape[1])
    keep[0, 0] = 1e-6
    for _ in range(rounds):
        p = 1 / (1 + np.exp(-np.clip(z @ w, -30, 30)))
        step = np.linalg.solve((z * (p * (1 - p))[:, None]).T @ z + keep, z.T @ (y - p) - keep @ w)
        w = w + step
        if np.abs(step).max() < 1e-8:
            break
    return w


def features(docs: DataFrame, carry: list[str], terms: list[tuple[bytes, bool]], text: str = "text") -> DataFrame:
    """``doc`` (the carried columns) and ``out.x``, the hit features."""

    def results(column: pa.Array):
        scanner = Scanner(terms)
        for _, _, c in X.chunks(column):
            x = scanner.features(c)
            yield [pa.ListArray.from_arrays(np.arange(0, x.size + 1, x.shape[1], dtype=np.int32), x.ravel())]

    return X.per_text(docs, text, carry, [T.StructField("x", T.ArrayType(T.DoubleType()))], results)


def scored(docs: DataFrame, labels: DataFrame, carry: list[str], text: str = "text") -> DataFrame:
    """``doc`` and ``score`` of every text; learns from ``labels`` whose remainder by five is not zero."""
    ids = training_labels(labels, "toxic", 5, 0, MOST_ROWS).select("doc_id", "y")
    slim = docs.select(F.col("doc_id"), F.col(f"`{text}`").alias("text"))
    known = pinned(slim.join(F.broadcast(ids), "doc_id").select("text", "y"), "toxic_known")  # about MOST_ROWS ids
    counts = {r.y: r.n for r in known.groupBy("y").agg(F.count(F.lit(1)).alias("n")).collect()}
    toxic, clean = counts.get(1.0, 0), counts.get(0.0, 0)
    share = toxic / (toxic + clean) if counts else 0.5
    terms, weights = [], None
    if toxic and clean:
        terms = lexicon(known, toxic, clean)
        sample = features(known, ["y"], terms).select("doc.y", "out.x").toArrow()  # about MOST_ROWS rows
        x = sample.column("x").combine_chunks().flatten().to_numpy().reshape(-1, len(FEATURES))
        weights = logistic(x, sample.column("y").to_numpy())
    if weights is None:
        score = F.lit(float(share))
    else:
        margin = F.lit(float(weights[0]))
        for i, w in enumerate(weights[1:]):
            margin = margin + F.lit(float(w)) * F.col("out.x")[i]
        score = 1 / (1 + F.exp(-margin))
    return features(docs, carry, terms, text).select("doc", score.alias("score"))


def digest(docs: DataFrame, labels: DataFrame) -> DataFrame:
    s = scored(docs, labels, ["doc_id"])
    held = F.coalesce(remainder(F.col("doc.doc_id"), 5) == 0, F.lit(False))
    return s.select(
        F.col("doc.doc_id").alias("doc_id"), held.alias("held_out"), "score", (F.col("score") >= THRESHOLD).cast("int").alias("predicted"),
    )
