"""Random table histories against a few lines of plain Python."""

import random

import pytest

from helpers import add, info, log, meta, parquet, protocol, remove
from test_hashing import reference
from tableflow.functions import cursor as C
from tableflow.operators import changes as CH
from tableflow.sources import files as FS
from tableflow.sources import snapshot as SN

SLOTS = 3


def build(table, seed):
    """Write a random log; returns per version the list of (index, op, file) and per file its partition and values."""
    rnd = random.Random(seed)
    log(table, 0, info(1), protocol(), meta([("a", "long"), ("k", "string")], ["k"]))
    files, live, history = {}, [], {0: []}
    for v in range(1, 9):
        entries, done = [info(v)], []
        for name in rnd.sample(live, k=min(len(live), rnd.choice([0, 0, 1, 2]))):
            live.remove(name)
            done.append((len(entries), "r", name))
            entries.append(remove(name, {"k": files[name][0]}))
        for i in range(rnd.randrange(4)):
            k = rnd.choice("xyz")
            name = f"k={k}/v{v}-{i}.parquet"
            values = [rnd.randrange(1000) for _ in range(rnd.randrange(1, 6))]
            parquet(table, name, {"a": values})
            files[name] = (k, values)
            live.append(name)
            done.append((len(entries), "c", name))
            entries.append(add(name, 10, {"k": k}, rows=len(values) if rnd.random() < 0.5 else None))
        log(table, v, *entries)
        history[v] = done
    return history, files


def expected(history, files, start, end):
    return [
        (v, i, op, files[f][0], r, a, reference(f"k={files[f][0]}".encode()) % SLOTS)
        for v in range(start, end + 1) for i, op, f in history[v] for r, a in enumerate(files[f][1])
    ]


def found(df):
    cols = ["_version", "_action_idx", "_op", "k", "_row_num", "a", "_slot"]
    return [tuple(r) for r in CH.in_order(df).select(*cols).collect()]


@pytest.mark.parametrize("seed", [1, 2, 3])
def test_history(spark, table_path, seed, monkeypatch):
    history, files = build(table_path, seed)
    rnd = random.Random(seed + 100)
    if seed == 2:
        monkeypatch.setattr(FS, "BROADCAST_BYTES", 900)  # several scans per feed

    # snapshots
    version = rnd.randrange(3, 9)
    live = {}
    for v in range(version + 1):
        for _, op, f in history[v]:
            if op == "c":
                live[f] = files[f]
            else:
                live.pop(f)
    rows = sorted((a, k) for k, values in live.values() for a in values)
    assert sorted(map(tuple, SN.snapshot(spark, table_path, version).select("a", "k").collect())) == rows

    # the feed, with sequences
    start = rnd.randrange(0, 4)
    want = expected(history, files, start, 8)
    df = CH.changes(spark, table_path, start, n_slots=SLOTS, positions=True)
    assert found(df) == want
    seqs, last = {}, {}
    for w in want:
        seqs[w[:2] + (w[4],)] = last[w[6]] = last.get(w[6], -1) + 1
    got = {(r["_version"], r["_action_idx"], r["_row_num"]): r["_seq"] for r in df.collect()}
    assert got == seqs

    # resume from the middle of it, per slot
    cut = {}
    for slot in {w[6] for w in want}:
        mine = [w for w in want if w[6] == slot]
        if rnd.random() < 0.7:
            w = rnd.choice(mine)
            cut[slot] = C.Cursor(C.INCREMENTAL, w[0], w[1], w[4])
    if cut:
        rest = [w for w in want if w[6] not in cut or (w[0], w[1], w[4]) >= (cut[w[6]].version, cut[w[6]].index, cut[w[6]].row)]
        assert found(CH.changes(spark, table_path, start, n_slots=SLOTS, checkpoints=cut)) == rest
