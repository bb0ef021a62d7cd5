"""Best-fit packing with certified bin counts.

Every text becomes token ids and an end id; ids beyond the sequence length are cut into pieces. Pieces are dealt to
groups of bounded size, and each group packs its own by best-fit decreasing. Dual feasible functions give a lower bound
of the bins its pieces need. A group whose bin count is above the bound keeps its full bins and hands over the pieces of
the others; they are dealt anew to fewer groups and packed again, until one group holds all that is left or
``ROUNDS`` are over. The last round keeps every bin.

Pieces are narrow rows (no text, no ids), written once; a group has about ``PIECES`` of them whatever the table's
size, dealt by a row number, so equal or null document ids do not gather in one group.

Edge cases: null and empty texts are one piece, the end id alone; repeated rows are packed each; a null id is kept; an
empty table gives an empty result.
"""

from __future__ import annotations

import zlib

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tableflow.llm import texts as X
from tableflow.llm import vocab as V
from tableflow.session import pinned

VOCABULARY = "word_bpe_49k.json"
LENGTH = 4096
END_ID = 1
PIECES = 40_000
ROUNDS = 5

#: Bytes that no UTF-8 text has; it marks the end of a piece of text for the merges.
_MARK = b"\xff"
_loaded: dict[str, V.Words] = {}


def _vocabulary(path: str) -> V.Words:
    """Words to ids of a BPE with word ends.

    Runs of letters a-z, accented Latin letters included, are one piece for the merges and go to them directly, and so
    do such runs with marks after them; any other word, one with a special token in it too, goes through the whole tokenizer.
    """
    if path not in _loaded:
        import json
        import re

        import tiktoken
        from tokenizers import Tokenizer

        whole = Tokenizer.from_file(path)
        with open(path, encoding="utf-8") as f:
            vocab = json.load(f)["model"]["vocab"]
        ranks = _ranks(vocab)
        merges = tiktoken.Encoding("pieces", pat_str=r"\S+", mergeable_ranks=ranks, special_tokens={})
        bpe = merges._core_bpe.encode_single_piece
        plain = re.compile(r"[a-zß-öø-ÿ]+")
        marks = re.compile(r"([a-zß-öø-ÿ]+)([.,!?;:|#*$%&]+)")

        def encode(words: list[bytes]) -> list[list[int]]:
            out: list[list[int]] = []
            odd: list[tuple[int, str]] = []
            shown = b" ".join(words).decode("utf-8", "replace")
            for s, low in zip(shown.split(" "), shown.lower().split(" "), strict=True):
                if low.isascii() and low.isalpha() or plain.fullmatch(low):
                    out.append(bpe(low.encode() + _MARK))
                elif m := marks.fullmatch(low):
                    out.append(bpe(m[1].encode() + _MARK) + bpe(m[2].encode() + _MARK))
                else:
                    odd.append((len(out), s))
                    out.append([])
            for (i, _), e in zip(odd, whole.encode_batch_fast([s for _, s in odd], add_special_tokens=False), strict=True):
                out[i] = e.ids
            return out

        _loaded[path] = V.Words(encode)
    return _loaded[path]


def _ranks(vocab: dict[str, int]) -> dict[bytes, int]:
    """Token bytes, a word end being the mark, to id; an id is also the order of its merge."""
    shown = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]  # bytes that stand for themselves
    byte = {chr(b): b for b in shown}
    for i, b in enumerate(sorted(set(range(256)) - set(shown))):
        byte[chr(256 + i)] = b
    out = {}
    for token, i in vocab.items():
        end = token.endswith("</w>")
        out[bytes(byte[ch] for ch in (token[:-4] if end else token)) + (_MARK if end else b"")] = i
    return out


PIECE_FIELDS = [
    T.StructField("starts", T.ArrayType(T.LongType())),
    T.StructField("lengths", T.ArrayType(T.LongType())),
    T.StructField("crcs", T.ArrayType(T.LongType())),
]
ID_FIELD = T.StructField("ids", T.ArrayType(T.ArrayType(T.IntegerType())))


def _pieces_of(column: pa.Array, path: str | None, length: int, end_id: int, with_ids: bool):
    words = _vocabulary(path or V.public_path(VOCABULARY))
    for _, _, c in X.chunks(column):
        c.words(X.SPACED)
        ids, n = words.ids(c)
        at = V.per_doc(c, n).tolist()
        starts, lengths, crcs, pieces = [], [], [], []
        for d in range(c.n):
            mine = np.append(ids[at[d] : at[d + 1]], np.uint32(end_id)).astype("<u4")
            cuts = range(0, len(mine), length)
            starts.append(list(cuts))
            lengths.append([min(length, len(mine) - s) for s in cuts])
            crcs.append([zlib.crc32(mine[s : s + length].tobytes()) for s in cuts])
            if with_ids:
                pieces.append([mine[s : s + length].astype(np.int32) for s in cuts])
        out = [pa.array(x, pa.list_(pa.int64())) for x in (starts, lengths, crcs)]
        yield [*out, pa.array(pieces, pa.list_(pa.list_(pa.int32())))] if with_ids else out


def pieces(
    docs: DataFrame, doc_id: str = "doc_id", text: str = "text", vocabulary: str | None = None, length: int = LENGTH,
    end_id: int = END_ID, with_ids: bool = False,
) -> DataFrame:
    """doc_id, piece, start, length and ids_crc32 of every piece, and its ids. Words are encoded apart: no token spans
    white space. ``vocabulary`` is a path that every task can open; the installed public file by default."""
    fields = [*PIECE_FIELDS, ID_FIELD] if with_ids else PIECE_FIELDS
    found = X.per_text(docs, text, [doc_id], fields, lambda column: _pieces_of(column, vocabulary, length, end_id, with_ids))
    cut = F.posexplode(F.arrays_zip(*[F.col(f"out.{f.name}").alias(f.name) for f in fields])).alias("piece", "p")
    return found.select(F.col(f"doc.`{doc_id}`").alias("doc_id"), cut).select(
        "doc_id", "piece", F.col("p.starts").alias("start"), F.col("p.lengths").alias("length"),
        F.col("p.crcs").alias("ids_crc32"), *([F.col("p.ids").alias("ids")] if with_ids else []),
    )


def lower_bound(lengths: np.ndarray, capacity: int) -> int:
    """Bins that items of these lengths need at least."""
    return bound_of(np.bincount(lengths, minlength=capacity + 1).astype(np.int64), capacity)


def bound_of(count: np.ndarray, capacity: int) -> int:
    """The same from the number of items of each length, by dual feasible functions."""
    if not count.any():
        return 0
    x = np.arange(capacity + 1)
    best = -(-int(count @ x) // capacity)
    # Items above capacity - e count as a whole bin, those below e as nothing.
    large = np.cumsum(count[::-1])[::-1]
    weight = np.append(0, np.cumsum(count * x))
    e = np.arange(1, capacity // 2 + 1)
    whole = np.where(capacity - e + 1 <= capacity, large[np.minimum(capacity - e + 1, capacity)], 0)
    middle = weight[capacity - e + 1] - weight[e]
    best = max(best, int((whole + -(-middle // capacity)).max()))
    # Steps of 1 / k, except where (k + 1) x is whole.
    for k in range(1, 21):
        scaled = (k + 1) * x
        exact = scaled % capacity == 0
        total = int((count * np.where(exact, x * k, scaled // capacity * capacity)).sum())
        best = max(best, -(-total // (k * capacity)))
    return best


def best_fit(lengths: np.ndarray, capacity: int) -> tuple[np.ndarray, np.ndarray]:
    """Best-fit decreasing: bin and offset of every item."""
    order = np.argsort(-lengths, kind="stable")
    bins = np.empty(len(lengths), np.int64)
    offsets = np.empty(len(lengths), np.int64)
    room: list[list[int]] = [[] for _ in range(capacity + 1)]  # open bins by what is left in them
    open_ = 0  # bit r is set if a bin has r left
    n = 0
    for i, size in zip(order.tolist(), lengths[order].tolist(), strict=True):
        fits = open_ >> size
        if fits:
            left = size + ((fits & -fits).bit_length() - 1)
            b = room[left].pop()
            if not room[left]:
                open_ ^= 1 << left
        else:
            left, b, n = capacity, n, n + 1
        bins[i], offsets[i] = b, capacity - left
        left -= size
        if left:
            room[left].append(b)
            open_ |= 1 << left
    return bins, offsets


def _pack_group(pdf: pd.DataFrame, capacity: int, last: bool) -> pd.DataFrame:
    lengths = pdf["length"].to_numpy(np.int64)
    bins, offsets = best_fit(lengths, capacity)
    n, bound = int(bins.max()) + 1, lower_bound(lengths, capacity)
    fill = np.bincount(bins, weights=lengths, minlength=n)
    # Counted without rounding up: what the last bin lacks is a gap too when groups can share it.
    gap = n * capacity - int(lengths.sum())
    settled = (fill >= capacity) if (n > bound or gap) and not last else np.ones(n, bool)
    return pd.DataFrame({
        "uid": pdf["uid"].to_numpy(), "bin": bins, "offset": offsets, "settled": settled[bins],
        "grp": pdf["grp"].to_numpy(), "n_bins": n, "bound": bound,
    })


def _packer(capacity: int, last: bool):
    return lambda pdf: _pack_group(pdf, capacity, last)


_PACKED = "uid long, bin long, offset long, settled boolean, grp long, n_bins long, bound long"


def pack(items: DataFrame, capacity: int = LENGTH, per_group: int = PIECES, rounds: int = ROUNDS) -> DataFrame:
    """uid -> sequence_id, offset for items with unique ``uid`` and ``length`` from 1 to ``capacity``."""
    whole = items.where(F.col("length") >= capacity).select("uid", F.col("uid").alias("sequence_id"), F.lit(0).cast("long").alias("offset"))
    left = items.where(F.col("length") < capacity).select("uid", "length")
    out = whole
    for r in range(1, rounds + 1):
        n = left.count()
        if not n:
            break
        groups = -(-n // per_group)
        last = groups == 1 or r == rounds
        dealt = left.withColumn("grp", F.pmod(F.xxhash64("uid", F.lit(r)), F.lit(groups)))
        packed = pinned(dealt.groupBy("grp").applyInPandas(_packer(capacity, last), _PACKED), "packed")
        seq = F.lit(-(r << 58)) - F.col("grp") * (1 << 26) - F.col("bin") - 1  # below zero: apart from the whole ones
        out = out.unionByName(packed.where("settled").select("uid", seq.alias("sequence_id"), "offset"))
        if last:
            break
        left = left.join(packed.where("not settled").select("uid"), "uid")
    return out


def placed(items: DataFrame, capacity: int) -> DataFrame:
    """uid, sequence_id, offset, and the certificate: n_sequences used, and least_sequences that any packing needs."""
    count = np.zeros(capacity + 1, np.int64)
    for r in items.groupBy("length").count().collect():  # a row per length
        count[r.length] = r["count"]
    at = pinned(pack(items, capacity), "places")
    used = at.where(F.col("offset") == 0).count()
    return at.withColumns({"n_sequences": F.lit(used).cast("long"), "least_sequences": F.lit(bound_of(count, capacity)).cast("long")})


def packed(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", **kw) -> DataFrame:
    """One row per piece with its place, and the certificate."""
    items = pinned(pieces(docs, doc_id, text, **kw).withColumn("uid", F.monotonically_increasing_id()), "pieces")
    return items.join(placed(items.select("uid", "length"), kw.get("length", LENGTH)), "uid").select(
        "doc_id", F.col("piece").cast("int").alias("piece"), "start", "length", "ids_crc32", "sequence_id", "offset",
        "n_sequences", "least_sequences",
    )


def sequences(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", **kw) -> DataFrame:
    """The training sequences: sequence_id, its ``ids``, and ``parts`` (offset, doc_id, start) in order."""
    items = pinned(pieces(docs, doc_id, text, with_ids=True, **kw).withColumn("uid", F.monotonically_increasing_id()), "pieces")
    at = items.join(placed(items.select("uid", "length"), kw.get("length", LENGTH)), "uid")
    part = F.struct("offset", "doc_id", "start", "ids")
    whole = at.groupBy("sequence_id").agg(F.array_sort(F.collect_list(part)).alias("p"))  # at most ``length`` ids
    return whole.select(
        "sequence_id", F.flatten("p.ids").alias("ids"), F.transform("p", lambda x: F.struct(x["offset"], x["doc_id"], x["start"])).alias("parts"),
    )
