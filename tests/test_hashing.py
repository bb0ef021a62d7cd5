import struct

from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from tableflow.functions import hashing

KNOWN = {
    "": 0, "k=0": 1112617090, "k=1": 94440620, "k=2": 1374105508, "year=2020,month=1": 144264721,
    "day=23,month=3,year=2021": 1487001213, "xx": 714479792, "o_orderstatus=F": 1755496907,
    "o_orderstatus=O": 1617000208, "o_orderstatus=P": 332075658,
}


def reference(data: bytes) -> int:
    """MurmurHash3 x86_32 over bytes, straight from its published description."""
    m = 0xFFFFFFFF
    rot = lambda x, r: ((x << r) | (x >> (32 - r))) & m
    mix = lambda k: (rot((k * 0xCC9E2D51) & m, 15) * 0x1B873593) & m
    h, n = 0, len(data)
    for (k,) in struct.iter_unpack("<I", data[: n // 4 * 4]):
        h = (rot(h ^ mix(k), 13) * 5 + 0xE6546B64) & m
    rest = data[n // 4 * 4:]
    if rest:
        h ^= mix(int.from_bytes(rest, "little"))
    h ^= n
    for r, c in ((16, 0x85EBCA6B), (13, 0xC2B2AE35), (16, 1)):
        h ^= h >> r
        h = (h * c) & m
    return h & 0x7FFFFFFF


def test_known_values(spark):
    df = spark.createDataFrame(list(KNOWN.items()), "k string, v int")
    assert df.where(hashing.murmur3("k") != F.col("v")).count() == 0


@settings(max_examples=3, deadline=None)
@given(st.lists(st.text(max_size=40), min_size=30, max_size=60))
def test_any_text(spark, texts):
    texts = [t for t in texts if not any(0xD800 <= ord(c) <= 0xDFFF for c in t)] or ["é"]
    df = spark.createDataFrame([(t,) for t in texts], "k string")
    for k, h in df.select("k", hashing.murmur3("k")).collect():
        assert h == reference(k.encode())


def test_slot_rules(spark):
    df = spark.createDataFrame([("xx",), ("",), (None,)], "k string")
    assert [r[0] for r in df.select(hashing.slot("k", 5)).collect()] == [2, 0, 0]
    assert [r[0] for r in df.select(hashing.slot("k", 0)).collect()] == [0, 0, 0]


def test_owned(spark):
    df = spark.range(6).where(hashing.owned(F.col("id"), 1, 3))
    assert sorted(r[0] for r in df.collect()) == [1, 4]
