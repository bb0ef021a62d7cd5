"""Plain-Python versions of what the operators return, for small tables."""

from __future__ import annotations

import hashlib
import math
import re
import zlib
from collections import Counter

import numpy as np
import pyarrow.parquet as pq

WORD = re.compile(r"[^\x20\x09-\x0D]+")
ALNUM = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")


def rows(sf: str, name: str) -> list[dict]:
    return pq.read_table(f"{sf}/{name}.parquet").to_pylist()


def ascii_lower(s: str) -> str:
    return re.sub("[A-Z]+", lambda m: m[0].lower(), s)


def sha(s: str) -> str:
    return hashlib.sha256(s.encode()).hexdigest()


def rules(text: str | None) -> tuple:
    text = text or ""
    words = WORD.findall(text)
    seen, dup = set(), 0
    for line in text.split("\n"):
        if WORD.search(line):
            dup += line in seen
            seen.add(line)
    grams = [tuple(words[i : i + 3]) for i in range(len(words) - 2)]
    n = Counter(grams)
    covered = {i + j for i, g in enumerate(grams) if n[g] > 1 for j in range(3)}
    return (
        len(words), sum(map(len, words)), sum(text.count(c) for c in "#*$%&|<>"), dup, len(covered),
        len(words) < 50 or 100 * len(covered) > 50 * len(words),
    )


def contamination(docs: list[dict], items: list[dict]) -> dict:
    windows: dict[tuple, set[str]] = {}
    for r in items:
        w = ALNUM.findall(ascii_lower(r["text"] or ""))
        if w and r["item_id"] is not None:
            m = min(13, len(w))
            for i in range(len(w) - m + 1):
                windows.setdefault(tuple(w[i : i + m]), set()).add(str(r["item_id"]))
    sizes = {len(w) for w in windows}
    out = []
    for r in docs:
        words = ALNUM.findall(ascii_lower(r["text"] or ""))
        hit, found = set(), set()
        for m in sizes:
            for i in range(len(words) - m + 1):
                if got := windows.get(tuple(words[i : i + m])):
                    hit.update(range(i, i + m))
                    found |= got
        out.append((
            r["doc_id"], len(words), len(hit), len(found), sha(",".join(sorted(found))),
            bool(hit) and 20 * len(hit) >= len(words),
        ))
    return out


def pieces(texts: list[str | None], tokenizer, length: int = 4096) -> list[list[tuple]]:
    out = []
    for e in tokenizer.encode_batch([t or "" for t in texts], add_special_tokens=False):
        ids = [*e.ids, 1]
        out.append([
            (k, s, len(ids[s : s + length]), zlib.crc32(b"".join(i.to_bytes(4, "little") for i in ids[s : s + length])))
            for k, s in enumerate(range(0, len(ids), length))
        ])
    return out


ASSIGN = re.compile(
    r"(password|passwd|secret|token|api_?key)[\"']?\x20*[:=]\x20*[\"']?([A-Za-z0-9+/_.=-]+)", re.IGNORECASE | re.ASCII
)
SECRETS = [
    ("assign", ASSIGN, lambda m: len(m[2]) >= 6),
    ("access", re.compile("AKIA[A-Z0-9]+"), lambda m: len(m[0]) >= 20),
    ("hex", re.compile("[0-9a-f]+"), lambda m: len(m[0]) >= 24),
]


def luhn(value: str) -> bool:
    digits = [int(c) for c in value if c.isdigit()][::-1]
    return sum(d if i % 2 == 0 else sum(divmod(2 * d, 10)) for i, d in enumerate(digits)) % 10 == 0


def n_digits(s: str) -> int:
    return sum(c in "0123456789" for c in s)


PERSONAL = [
    ("email", re.compile(r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+"), lambda m: True),
    ("ip", re.compile(r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)"), lambda m: all(int(p) <= 255 for p in m[0].split("."))),
    ("card", re.compile(r"[0-9]([\x20-]?[0-9])+"), lambda m: 16 <= n_digits(m[0]) <= 19 and luhn(m[0])),
    ("phone", re.compile(r"\+[0-9][\x20().0-9-]+[0-9]"), lambda m: 8 <= n_digits(m[0]) <= 15),
]


def matches(text: str | None, forms) -> list[tuple[str, int, int]]:
    return [(k, m.start(), m.end()) for k, p, ok in forms for m in p.finditer(text or "") if ok(m)]


def base_spans(text: str | None, forms, by_start: bool) -> tuple:
    found = matches(text, forms)
    order = [k for k, _, _ in forms]
    found.sort(key=lambda s: (s[1], order.index(s[0])) if by_start else (order.index(s[0]), s[1]))
    counts = [sum(s[0] == k for s in found) for k in order]
    return (*counts, sha(",".join(f"{k}:{s}:{e}" for k, s, e in found)))


def without_repeats(texts: list[str | None], length: int = 400) -> list[tuple]:
    raw = [(t or "").encode() for t in texts]
    n = Counter(hash(b[i : i + length]) for b in raw for i in range(len(b) - length + 1))
    out = []
    for b in raw:
        gone = bytearray(len(b))
        end = 0
        for i in range(len(b) - length + 1):
            if n[hash(b[i : i + length])] > 1:
                a = max(i, end)
                gone[a : i + length] = b"\1" * (i + length - a)
                end = i + length
        spans = len(re.findall(b"\1+", bytes(gone)))
        kept = bytes(c for c, g in zip(b, gone, strict=True) if not g)
        out.append((len(b), sum(gone), spans, hashlib.sha256(kept).hexdigest()))
    return out


def shingles(text: str | None) -> set[tuple]:
    w = WORD.findall(ascii_lower(text or ""))
    return {tuple(w[i : i + 5]) for i in range(len(w) - 4)} if len(w) >= 5 else ({tuple(w)} if w else set())


def jaccard_components(docs: list[tuple]) -> list[tuple]:
    """(doc_id, n_shingles, component_id) per (doc_id, text), least ids leaving null out."""
    sets = [shingles(t) for _, t in docs]
    root = list(range(len(docs)))

    def find(i):
        while root[i] != i:
            i = root[i]
        return i

    by: dict[tuple, list[int]] = {}
    for i, s in enumerate(sets):
        seen = Counter(j for x in s for j in by.get(x, ()))
        for j, o in seen.items():
            if 100 * o >= 80 * (len(s) + len(sets[j]) - o):
                root[find(i)] = find(j)
        for x in s:
            by.setdefault(x, []).append(i)
    least: dict[int, int] = {}
    for i, (d, _) in enumerate(docs):
        if d is not None:
            r = find(i)
            least[r] = min(d, least.get(r, d))
    return [(d, len(sets[i]), least.get(find(i))) for i, (d, _) in enumerate(docs)]


def spelling(docs):
    """word, form, root, n, n_near, form_n of (doc_id, text) rows, by trying every edit."""
    count = Counter()
    for i, t in docs:
        for run in re.findall("[A-Za-z\u00c0-\u00ff]+", t or ""):
            w = "".join(chr(ord(ch) + 32) if "A" <= ch <= "Z" else ch for ch in run)
            h = zlib.crc32(f"{'' if i is None else i}:{w}".encode())
            if h % 31 == 0:
                w = w[: h % len(w)] + w[h % len(w) + 1 :]
            if len(w) >= 7:
                count[w] += 1
    n = {w: c for w, c in count.items() if c >= 2}
    near = {w: set() for w in n}
    patterns = {}
    for w in n:
        for i in range(len(w)):
            patterns.setdefault((w[:i], w[i + 1 :], len(w)), []).append(w)
            short = w[:i] + w[i + 1 :]
            if short in n:
                near[w].add(short)
                near[short].add(w)
    for words in patterns.values():
        for w in words:
            near[w].update(v for v in words if v != w)
    form = {}
    for w in n:
        best = min(near[w], key=lambda v: (-n[v], v), default=None)
        if best is not None and n[best] >= 10 * n[w]:
            form[w] = best
    out = []
    for w in n:
        root = w
        while root in form:
            root = form[root]
        out.append((w, form.get(w), root, n[w], len(near[w]), n[form[w]] if w in form else None))
    return out


def near_vectors(rows, least=0.93):
    """(id, n_links, component, kept) of (id, vector, label) rows by comparing all pairs."""
    size = len(rows)
    links, lead = [0] * size, list(range(size))

    def find(x):
        while lead[x] != x:
            x = lead[x]
        return x

    groups = {}
    for k, (_, v, label) in enumerate(rows):
        if v and label is not None and all(c is not None and math.isfinite(c) for c in v) and any(v):
            groups.setdefault((label, len(v)), []).append(k)
    for members in groups.values():
        m = np.array([rows[k][1] for k in members], np.float64)
        m /= np.abs(m).max(1, keepdims=True)
        m /= np.sqrt((m * m).sum(1, keepdims=True))
        at, to = np.nonzero(m @ m.T >= least)
        for x, y in zip(at.tolist(), to.tolist()):
            if x != y:
                links[members[x]] += 1
                a, b = find(members[x]), find(members[y])
                lead[max(a, b)] = min(a, b)
    least_id = {}
    for k, (i, _, _) in enumerate(rows):
        if i is not None:
            least_id[find(k)] = min(i, least_id.get(find(k), i))
    return [(i, links[k], least_id.get(find(k)), i == least_id.get(find(k))) for k, (i, _, _) in enumerate(rows)]
