"""Words of a chunk as token ids of a public vocabulary, each distinct word encoded once and remembered."""

from __future__ import annotations

import importlib
from collections.abc import Callable
from itertools import chain

import numpy as np

from tableflow.llm import texts as X

REMEMBERED = 500_000


def public_path(name: str) -> str:
    """Where the installed public vocabulary file is on this machine."""
    return importlib.import_module("public_tokenizers").path(name)


class Words:
    """Encodes distinct words with ``encode`` (bytes of many words -> their ids) and remembers them by hash.

    The memory is sorted arrays. It is dropped when it has REMEMBERED words, and when a worker that goes on to another stage
    uses another vocabulary: it saves time and never changes a result.
    """

    _in_use: Words | None = None

    def __init__(self, encode: Callable[[list[bytes]], list[list[int]]]):
        self.encode = encode
        self._forget()

    def _forget(self) -> None:
        self.known = np.zeros(0, np.uint64)
        self.at, self.n = np.zeros(0, np.int32), np.zeros(0, np.int32)
        self.flat, self.used = np.zeros(1 << 16, np.uint32), 0

    def _learn(self, hashes: np.ndarray, words: list[bytes]) -> None:
        lists = self.encode(words)
        n = np.fromiter(map(len, lists), np.int64, len(lists))
        total = int(n.sum())
        while self.used + total > len(self.flat):
            self.flat = np.concatenate([self.flat, np.zeros(len(self.flat), np.uint32)])
        self.flat[self.used : self.used + total] = np.fromiter(chain.from_iterable(lists), np.uint32, total)
        place = np.searchsorted(self.known, hashes)
        self.at = np.insert(self.at, place, (self.used + np.cumsum(n) - n).astype(np.int32))
        self.n = np.insert(self.n, place, n.astype(np.int32))
        self.known = np.insert(self.known, place, hashes)
        self.used += total

    def ids(self, c: X.Chunk) -> tuple[np.ndarray, np.ndarray]:
        """Ids of all words of the chunk in order, and how many each word has."""
        if Words._in_use is not self:
            if Words._in_use is not None:
                Words._in_use._forget()
            Words._in_use = self
        hashes = c.word_hashes()
        if not len(hashes):
            return np.zeros(0, np.uint32), np.zeros(0, np.int64)
        distinct, first, which = np.unique(hashes, return_index=True, return_inverse=True)
        if len(self.known) > REMEMBERED:
            self._forget()
        new = np.ones(len(distinct), bool)
        if len(self.known):
            near = np.minimum(np.searchsorted(self.known, distinct), len(self.known) - 1)
            new = self.known[near] != distinct
        if new.any():
            at = first[new]
            whole = c.data.tobytes()
            self._learn(distinct[new], [whole[s:e] for s, e in zip(c.ws[at].tolist(), c.we[at].tolist(), strict=True)])
        place = np.searchsorted(self.known, distinct)
        lengths = self.n[place].astype(np.int64)[which]
        ends = np.cumsum(lengths)
        step = np.arange(int(ends[-1])) - np.repeat(ends - lengths, lengths)
        return self.flat[np.repeat(self.at[place].astype(np.int64)[which], lengths) + step], lengths


def per_doc(c: X.Chunk, lengths: np.ndarray) -> np.ndarray:
    """n + 1 offsets of the texts' ids."""
    return np.append(0, np.cumsum(lengths))[c.first]
