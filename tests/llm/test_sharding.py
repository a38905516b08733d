import random

import pytest
from pyspark.sql import types as T

from quire.llm import sharding
from quire.llm.sharding import shard_documents

SCHEMA = T.StructType([T.StructField("doc_id", T.LongType()), T.StructField("text", T.StringType()),
                       T.StructField("size", T.StringType()), T.StructField("shard", T.StringType())])


def docs(spark, rows):
    return spark.createDataFrame([(i, t, "x", "y") for i, t in rows], SCHEMA)


def smallest_capacity(sizes, shards):
    def fits(cap):
        used, n = 0, 1
        for s in sizes:
            if used + s > cap:
                used, n = 0, n + 1
            used += s
        return n <= shards
    lo, hi = max(sizes), sum(sizes)
    while lo < hi:
        mid = (lo + hi) // 2
        lo, hi = (lo, mid) if fits(mid) else (mid + 1, hi)
    return lo


def check(rows, out, shards):
    assert len(out) == len(rows)
    by_text = {}
    for i, t in rows:
        by_text.setdefault(t or "", []).append(i)
    size = {t: len(v) * (len(t.encode()) + 1) for t, v in by_text.items()}
    total = sum(size.values())
    key = {t: (size[t] * shards <= total, min(-1 if i is None else i for i in v), t) for t, v in by_text.items()}
    groups = sorted((key[t], size[t]) for t in by_text)
    loads = [sum(r["size"] for r in out if r["shard"] == k) for k in range(shards)]
    assert max(loads) <= smallest_capacity([s for _, s in groups], shards)
    for k in range(shards):
        assert sorted(r["slot"] for r in out if r["shard"] == k) == list(range(sum(r["shard"] == k for r in out)))
    shard_of = {}
    text_of = {}
    for i, t in rows:
        text_of.setdefault(i, t or "")
    for r in out:
        shard_of.setdefault(text_of[r["doc_id"]], set()).add(r["shard"])
    assert all(len(v) == 1 for v in shard_of.values())
    order = [shard_of[t] for t in sorted(by_text, key=key.get)]
    assert [min(s) for s in order] == sorted(min(s) for s in order)   # contiguous
    return loads


@pytest.mark.parametrize("segments,read", [(4096, 50_000), (3, 4)])
def test_smallest_capacity_as_by_brute_force(spark, monkeypatch, segments, read):
    monkeypatch.setattr(sharding, "SEGMENTS", segments)
    monkeypatch.setattr(sharding, "READ_ROWS", read)
    rng = random.Random(segments)
    rows = [(i, rng.choice("abcdé") * rng.randint(0, 60)) for i in range(150)]
    out = shard_documents(docs(spark, rows), 5).collect()
    loads = check(rows, out, 5)
    assert min(loads) > 0


def test_hot_group_takes_a_shard_and_the_rest_is_even(spark):
    rows = [(i, f"text {i}") for i in range(100)] + [(1000 + i, "same words again") for i in range(60)]
    loads = check(rows, shard_documents(docs(spark, rows), 4).collect(), 4)
    rest = sorted(loads)[:3]
    assert max(rest) - min(rest) <= 20


def test_nulls_ties_repeats_and_empty(spark):
    rows = [(1, None), (2, ""), (None, "x"), (3, "x"), (4, "long " * 5000)]
    out = shard_documents(docs(spark, rows), 8).collect()
    check(rows, out, 8)
    assert {r["size"] for r in out if r["doc_id"] in (1, 2)} == {1}
    twice = docs(spark, [(7, "a"), (7, "a"), (7, "b")])
    got = shard_documents(twice, 8)
    assert got.count() == 3 and got.columns == ["doc_id", "size", "text_crc32", "law", "shard", "slot", "grown_shard"]
    assert shard_documents(docs(spark, []), 8).count() == 0
