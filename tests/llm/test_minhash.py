import random

import numpy as np
import pytest
from pyspark.sql import types as T

from quire.llm import minhash
from quire.llm.jaccard_join import Rule
from quire.llm.minhash import band_keys, bit_planes, estimate, min_max, near_duplicates, overlap_bounds
from llm.test_jaccard_join import brute, corpus

SCHEMA = T.StructType([T.StructField(c, t) for c, t in (
    ("doc_id", T.LongType()), ("text", T.StringType()), ("sig", T.StringType()), ("n", T.StringType()), ("component", T.StringType()))])


def run(spark, rows, rule=minhash.SIMILAR):
    out = near_duplicates(spark.createDataFrame([(i, t, "x", "y", "z") for i, t in rows], SCHEMA), rule)
    assert out.columns == ["doc_id", "n_shingles", "component_id", "kept"]
    got = out.collect()
    assert all(r["kept"] == (r["doc_id"] == r["component_id"]) for r in got if r["doc_id"] is not None)
    return {r["doc_id"]: (r["n_shingles"], r["component_id"]) for r in got}


@pytest.mark.parametrize("seed,rule", [(11, minhash.SIMILAR), (13, Rule(2, 9, 10))])
def test_same_groups_as_brute_force(spark, seed, rule):
    rows = corpus(seed)
    assert run(spark, rows, rule) == brute(rows, rule)


@pytest.mark.parametrize("small,block", [(16, 40), (1 << 20, 1)])
def test_large_group_of_unlike_copies(spark, monkeypatch, small, block):
    """Copies of one text with other words changed: some link, some only through others."""
    monkeypatch.setattr(minhash, "SMALL", small)
    monkeypatch.setattr(minhash, "BLOCK", block)
    rng = random.Random(5)
    base = [f"w{k}" for k in range(60)]
    rows = [(0, " ".join(base))]
    for i in range(1, 150):
        w = list(base)
        for k in rng.sample(range(60), rng.choice([1, 1, 2, 3])):
            w[k] = f"v{rng.randrange(10_000)}"
        rows.append((i, " ".join(w)))
    rng.shuffle(rows)
    got = run(spark, rows)
    assert got == brute(rows, minhash.SIMILAR) and len({c for _, c in got.values()}) > 1


def test_edge_cases(spark):
    rows = [(1, None), (2, ""), (3, " \t\n"), (4, "One"), (5, "one "), (6, "ÉTÉ a"), (7, "été a"), (8, "a b c d"), (9, "A\x0bb\x0cC\rd"),
            (10, "x " * 20_000), (11, "x x x x"), (12, "a b c d")]
    assert run(spark, rows) == brute(rows, minhash.SIMILAR)
    assert run(spark, []) == {}
    df = spark.createDataFrame([(None, "p q r", "", "", ""), (5, "p q r", "", "", ""), (5, "p q r", "", "", ""), (None, "z", "", "", "")], SCHEMA)
    got = sorted((str(r["component_id"]), r["kept"]) for r in near_duplicates(df).collect())
    assert got == [("5", False), ("5", True), ("5", True), ("None", True)]


def test_planes_bound_overlaps_from_above():
    rng = np.random.default_rng(6)
    for size in (1, 50, 4000, 40_000):
        x = np.unique(rng.integers(0, 1 << 63, size, dtype=np.uint64) * np.uint64(2))
        y = np.unique(np.concatenate([x[: size * 3 // 4], rng.integers(0, 1 << 63, size // 4, dtype=np.uint64)]))
        a, b = (np.frombuffer(bit_planes(v), np.uint64) for v in (x, y))
        bound = int(overlap_bounds(a, b[None])[0])
        assert len(np.intersect1d(x, y)) <= bound <= min(len(x), len(y))
        assert size > 50 or bound <= len(np.intersect1d(x, y)) + 2


def test_both_ends_are_unbiased_and_vary_less():
    rng = np.random.default_rng(3)
    both, least = [], []
    for _ in range(60):
        x = rng.integers(0, 1 << 63, 60, dtype=np.uint64)
        a, b = min_max([x[:45], x[15:]], 128)
        both.append(float(estimate(a[:64], b[:64])))          # 64 evaluations, 128 slots
        least.append(float((a[:64, 0] == b[:64, 0]).mean()))   # 64 evaluations, 64 slots
    assert abs(np.mean(both) - 0.5) < 0.03 and np.std(both) < np.std(least)


def test_signature_is_the_ends_of_each_permutation():
    s = np.random.default_rng(4).integers(0, 1 << 63, 9, dtype=np.uint64)
    got = min_max([s, np.zeros(0, np.uint64)], 5)
    for p, (a, b) in enumerate(zip(*minhash.permutations(5))):
        values = [(int(x >> np.uint64(32)) * int(a) + int(b)) % (1 << 32) for x in s]
        assert got[0, p].tolist() == [min(values), max(values)]
    assert not got[1].any()
    assert (band_keys(got, 1)[0] == band_keys(min_max([s[::-1]], 5), 1)[0]).all()
