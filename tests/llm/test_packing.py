import random

import numpy as np
import public_tokenizers
from pyspark.sql import functions as F
from pyspark.sql import types as T
from tokenizers import Tokenizer

from quire.llm import packing
from quire.llm.packing import Shard, pack_documents

PATH = public_tokenizers.path("byte_bpe_50k.json")
SCHEMA = T.StructType([T.StructField("doc_id", T.LongType()), T.StructField("text", T.StringType()),
                       T.StructField("start", T.StringType()), T.StructField("near1", T.StringType())])


def check(spark, rows, window):
    df = spark.createDataFrame([(i, t, "", "") for i, t in rows], SCHEMA).repartition(3)
    out = pack_documents(df, PATH, window).withColumn("crc", F.crc32("ids")).collect()
    lib = Tokenizer.from_file(PATH)
    want = {i: lib.encode(t or "", add_special_tokens=False).ids + [1] for i, t in rows}
    got = {}
    for r in out:
        ids = np.frombuffer(r["ids"], "<u4").tolist()
        assert len(ids) == r["length"] > 0 and r["doc_tokens"] == len(want[r["doc_id"]])
        assert ids == want[r["doc_id"]][r["start"]:r["start"] + r["length"]]
        got.setdefault(r["doc_id"], []).append((r["start"], r["length"]))
    for i, ids in want.items():
        at = 0
        for start, length in sorted(got[i]):
            assert start == at
            at += length
        assert at == len(ids)
    sequences = {}
    for r in out:
        sequences.setdefault(r["sequence_id"], []).append((r["offset"], r["length"]))
    short = 0
    for parts in sequences.values():
        at = 0
        for offset, length in sorted(parts):
            assert offset == at
            at += length
        assert at <= window
        short += at < window
    return out, short


def corpus(n=120):
    rng = random.Random(2)
    topics = [[f"{t}{k}" for k in range(30)] for t in ("river", "engine", "music", "garden")]
    return [(i, " ".join(rng.choice(topics[i % 4]) for _ in range(rng.choice([0, 3, 40, 150, 900])))) for i in range(n)]


def test_every_id_once_in_full_windows(spark):
    out, short = check(spark, corpus() + [(500, None), (501, ""), (502, "long " * 9000)], 256)
    assert short <= 1       # one task: only its last window is short


def test_many_small_shards(spark, monkeypatch):
    monkeypatch.setattr(packing, "SHARD_TOKENS", 3000)
    check(spark, corpus(), 256)


def test_neighbours_are_those_of_brute_force_bm25():
    rng = np.random.default_rng(1)
    docs = [(k, rng.integers(0, 50, rng.integers(5, 60)).astype(np.uint16), 0) for k in range(40)]
    df = np.array([sum(t in d[1] for d in docs) for t in range(50)])
    idf, mean = np.log(1 + (40 - df + 0.5) / (df + 0.5)), float(np.mean([len(d[1]) for d in docs]))
    shard = Shard(docs, idf, mean)

    def weight(d, t):
        tf = int(np.count_nonzero(d == t))
        return idf[t] * tf * (packing.K1 + 1) / (tf + packing.K1 * (1 - packing.B + packing.B * len(d) / mean)) if tf else 0.0
    for seed in (0, 7, 23):
        own = sorted({int(t) for t in docs[seed][1]}, key=lambda t: -weight(docs[seed][1], t))[:packing.QUERY_TERMS]
        score = [sum(weight(d[1], t) for t in own) for d in docs]
        shard.used[:] = False
        shard.used[seed] = True
        got = []
        for k in shard.neighbours(seed):
            shard.used[k] = True
            got.append(k)
        assert sorted(got) == [k for k in range(40) if k != seed]
        assert all(score[a] >= score[b] - 1e-9 for a, b in zip(got, got[1:]))


def test_related_documents_meet(spark):
    out, _ = check(spark, [(i, t) for i, t in corpus(400) if len(t) > 200], 512)
    together = {}
    for r in out:
        together.setdefault(r["sequence_id"], set()).add(r["doc_id"] % 4)
    assert np.mean([len(v) for v in together.values()]) < 2


def test_empty_table_and_repeated_rows(spark):
    df = spark.createDataFrame([], SCHEMA)
    assert pack_documents(df, PATH).count() == 0
    twice = spark.createDataFrame([(1, "same words", "", ""), (1, "same words", "", ""), (None, "x", "", "")], SCHEMA)
    assert pack_documents(twice, PATH).count() == 3
