import hashlib

import numpy as np
import pytest

from quire.llm import ns_kmeans
from quire.llm.ns_kmeans import Bounds, cluster

COLUMNS = ["vec_id", "cluster", "distance", "cluster_inertia", "inertia", "centroid_sha256"]


def lloyd(rows, k, rounds, size):
    """Plain Lloyd rounds in Python integers."""
    kept = [(i, [int(np.floor(256 * float(c))) for c in v]) for i, v in rows
            if v is not None and len(v) == size and all(c is not None and np.isfinite(c) for c in v)]
    first = sorted(kept, key=lambda r: (hashlib.sha256(f"2:{r[0]}".encode()).hexdigest(), r[1]))[:k]
    centroids = [list(x) for _, x in first]

    def assign():
        return [min((sum((a - b) ** 2 for a, b in zip(x, c)), j) for j, c in enumerate(centroids)) for _, x in kept]
    for _ in range(rounds):
        at = assign()
        for j in range(len(centroids)):
            mine = [x for (_, x), (_, a) in zip(kept, at) if a == j]
            if mine:
                centroids[j] = [sum(col) // len(mine) for col in zip(*mine)]
    at = assign()
    total = sum(d for d, _ in at)
    return sorted((i, j, d, sum(e for e, a in at if a == j), total,
                   hashlib.sha256(",".join(map(str, centroids[j])).encode()).hexdigest()) for (i, _), (d, j) in zip(kept, at))


def run(spark, rows, **kw):
    df = spark.createDataFrame([(i, v, "x", 1) for i, v in rows], "vec_id long, embedding array<float>, at string, x int").repartition(3)
    got = cluster(df, **kw)
    assert got.columns == [*COLUMNS, "scanned"]
    out = got.collect()
    return sorted(tuple(r[c] for c in COLUMNS) for r in out), out


def blobs(seed, n, size, scale=1.0):
    rng = np.random.default_rng(seed)
    at = rng.normal(size=(6, size)) * scale
    return [(i, [float(np.float32(c)) for c in at[i % 6] + rng.normal(size=size) * 0.4 * scale]) for i in range(n)]


@pytest.mark.parametrize("seed,k,size,scale", [(1, 7, 8, 1.0), (2, 40, 4, 4e5)])
def test_same_as_plain_rounds(spark, seed, k, size, scale):
    rows = blobs(seed, 300, size, scale) + [(1000 + i, [0.0] * size) for i in range(150)]      # half the rows one vector
    got, raw = run(spark, rows, k=k, rounds=5, size=size)
    assert got == lloyd(rows, k, 5, size)
    # The bounds spare evaluations: a full scan takes 6 * k a vector.
    assert np.mean([r["scanned"] for r in raw]) < 6 * k * 0.6


def test_dropped_rows_ties_and_small_tables(spark):
    bad = [(1, None), (2, []), (3, [1.0, None]), (4, [1.0, float("nan")]), (5, [float("inf"), 0.0]), (6, [1.0, 2.0, 3.0])]
    assert run(spark, bad, k=3, size=2)[0] == [] and run(spark, [], k=3, size=2)[0] == []
    rows = bad + [(7, [0.0, 0.0]), (8, [0.0, 0.0]), (9, [-0.001, 0.5]), (9, [-0.001, 0.5])]       # fewer than k; equal centroids
    assert run(spark, rows, k=40, size=2)[0] == lloyd(rows, 40, 5, 2)
    got = run(spark, [(None, [1.0, 1.0])], k=2, size=2)[0]
    assert got == [(None, 0, 0, 0, 0, hashlib.sha256(b"256,256").hexdigest())]


def test_values_beyond_64_bits(spark):
    far = [(1, [3e38, 0.0]), (2, [-3e38, 0.0]), (3, [0.0, 0.0])]
    got = {r[0]: r for r in run(spark, far, k=1, rounds=1, size=2)[0]}
    assert len(got) == 3 and got[1][2] is None and got[1][4] is None


def test_loosened_bounds_hold_and_are_tighter_than_summed_drifts():
    rng = np.random.default_rng(4)
    x = rng.integers(-500, 500, (200, 5))
    history = [rng.integers(-500, 500, (6, 5))]
    b = Bounds.fresh(x, history[0])
    for t in range(1, 6):
        history.append(history[-1] + rng.integers(-40, 41, (6, 5)))
        h = np.array(history)
        b.advance(x, h)
        full = ((x[:, None] - h[-1][None]) ** 2).sum(axis=2)
        assert (b.at == full.argmin(axis=1)).all()
        total = np.array([ns_kmeans.norms(ns_kmeans.squared(h[-1], h[s])) for s in range(t + 1)])
        gap = total[b.seen, np.arange(6)]
        assert (b.near - gap <= np.sqrt(full) + 1e-6).all() and (b.near + gap >= np.sqrt(full) - 1e-6).all()
        drift = np.sqrt(((h[1:] - h[:-1]) ** 2).sum(axis=2))
        assert all((total[s] <= drift[s:].sum(axis=0) + 1e-6).all() for s in range(t + 1))
    assert b.scanned < 6 * 6 * 200
