from collections import defaultdict

import numpy as np
import pytest

from quire.llm import whitening
from quire.llm.whitening import bit_planes, block_scatter, cross_products, from_limbs, to_limbs, whiten

COLUMNS = ["vec_id", "component", "n", "deviation", "whitened", "explained", "identity_error"]


def run(spark, rows, **kw):
    df = spark.createDataFrame([(i, v, "p", 2) for i, v in rows], "vec_id long, embedding array<double>, x string, d int").repartition(3)
    got = whiten(df, **kw)
    assert got.columns == COLUMNS
    return got.collect()


def brute(rows):
    """Per length: kept rows, distinct integer vectors, plain covariance in Python integers."""
    kept = [(i, tuple(int(np.floor(256 * c)) for c in v)) for i, v in rows
            if v is not None and all(c is not None and np.isfinite(c) for c in v)]
    out = {}
    for d in {len(x) for _, x in kept if x}:
        fit = list({x for _, x in kept if len(x) == d})
        n, s = len(fit), [sum(c) for c in zip(*fit)]
        v = np.array([[sum((n * x[i] - s[i]) * (n * x[j] - s[j]) for x in fit) / n ** 3 for j in range(d)] for i in range(d)])
        e, q = np.linalg.eigh(v)
        out[d] = (n, s, e[::-1], q[:, ::-1].T, np.trace(v), [(i, x) for i, x in kept if len(x) == d])
    return out


def check(got, rows, most=4):
    want, found = brute(rows), defaultdict(list)
    for r in got:
        found[(r["vec_id"], r["component"])].append(r)
    assert len({r["identity_error"] for r in got}) <= 1 and all(r["identity_error"] < 1e-9 for r in got)
    total = 0
    for d, (n, s, e, q, trace, kept) in want.items():
        m = min(most, int((e > 1e-12 * d * max(e[0], 0)).sum()))
        total += m * len(kept)
        for k in range(m):
            sign = {}
            for i, x in kept:
                w = float(np.dot([(n * a - b) / n for a, b in zip(x, s)], q[k]) / np.sqrt(e[k]))
                dev = sum((n * a - b) ** 2 for a, b in zip(x, s))
                r = next(r for r in found[(i, k + 1)] if r["n"] == n and r["deviation"] == dev and abs(abs(r["whitened"]) - abs(w)) < 1e-6)
                assert abs(r["explained"] - e[k] / trace) < 1e-9
                if abs(w) > 1e-3:
                    sign[i] = np.sign(w) == np.sign(r["whitened"])
            assert len(set(sign.values())) <= 1
    assert len(got) == total


def test_same_as_plain_covariance(spark):
    rng = np.random.default_rng(1)
    mixing = rng.normal(size=(6, 6)) * [3, 2, 1.4, 1, .5, .2]
    rows = [(i, list(map(float, rng.normal(size=6) @ mixing + 5))) for i in range(200)]
    rows += [(1000 + i, rows[7][1]) for i in range(150)] + [(3, rows[3][1]), (None, rows[4][1])]       # a hot vector, repeated and null ids
    check(run(spark, rows), rows)


def test_dropped_rows_lengths_and_flat_dimensions(spark):
    rng = np.random.default_rng(2)
    rows = [(i, [float(a), 2 * float(a), 7.0]) for i, a in enumerate(rng.normal(size=40))]       # about one direction
    rows += [(100 + i, list(map(float, rng.normal(size=2)))) for i in range(30)]                # another length
    rows += [(200, None), (201, [1.0, None, 2.0]), (202, [float("nan"), 0.0]), (203, [float("inf"), 1.0]), (204, []), (205, [1.0, 1.0, 1.0, 1.0])]
    check(run(spark, rows), rows)
    assert run(spark, []) == [] and run(spark, rows[-6:]) == []


def test_lengths_beyond_one_broadcast(spark, monkeypatch):
    monkeypatch.setattr(whitening, "MODEL_NUMBERS", 12)
    rng = np.random.default_rng(3)
    rows = [(i, list(map(float, rng.normal(size=2 + i % 3)))) for i in range(90)]
    check(run(spark, rows), rows)


def test_deviation_beyond_64_bits_is_null(spark):
    got = run(spark, [(1, [1e30, 0.0]), (2, [-1e30, 1.0]), (3, [0.0, 2.0])])
    assert {r["vec_id"] for r in got} == {1, 2, 3} and all(r["deviation"] is None for r in got if r["vec_id"] != 3)


@pytest.mark.parametrize("rows,d,lo,hi", [(1, 3, -5, 5), (130, 5, -300, 300), (64, 2, -(1 << 63), (1 << 63) - 1), (77, 4, 9, 10)])
def test_bit_sliced_scatter_is_exact(rows, d, lo, hi):
    x = np.random.default_rng(rows).integers(lo, hi, (rows, d), dtype=np.int64, endpoint=True)
    n, sums, cross = block_scatter(x)
    plain = [[int(v) for v in r] for r in x]
    assert n == rows and list(sums) == [sum(c) for c in zip(*plain)]
    for i in range(d):
        for j in range(i, d):
            assert cross[i, j] == sum(r[i] * r[j] for r in plain)
            assert from_limbs(to_limbs(int(cross[i, j]))) == cross[i, j]


def test_planes_hold_the_bits():
    y = np.array([[5, 0], [2, 1]], dtype=np.uint64)
    planes, of, bit = bit_planes(y)
    assert of.tolist() == [0, 0, 0, 1] and bit.tolist() == [0, 1, 2, 0] and planes.shape == (4, 1)
    assert [int(np.bitwise_count(p[0])) for p in planes] == [1, 1, 1, 1]
    assert cross_products(y)[0, 1] == 2 and cross_products(y)[0, 0] == 29
