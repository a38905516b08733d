"""Embedding whitening: covariances by bit-sliced scatter.

Vectors are integers (floor(256 * c)). A block of rows is shifted by the least value of
each dimension, so that no number is negative, and turned into bit planes: word w of
plane p of a dimension holds bit p of 64 rows. The cross-product of two dimensions
over the block is then a sum of popcounts of ANDed planes, weighted by the powers of
two of the planes; the shift is taken out again. All of it is integer arithmetic
without rounding, as are the sums over blocks and tasks, which travel as limbs of 32
bits. The covariance is centred as integers (n * sum(x y) - sum(x) * sum(y)) and only then
becomes a double, divided by n squared, for the symmetric eigensolver.

Vectors of different lengths are different spaces: each length is fitted on its own.
"""

from __future__ import annotations

from collections.abc import Iterator
from decimal import Decimal

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from quire.llm.common import small_batches, staged

BLOCK = 8192             # rows sliced together
LIMBS = 6                # of 32 bits: products of 64-bit numbers over 2**64 rows, with sign
PLANE_WORDS = 1 << 16    # words ANDed at once
MODEL_NUMBERS = 1 << 21  # numbers of the models broadcast together (lengths beyond go in further passes)

SCATTER = "d int, i int, j int, " + ", ".join(f"l{k} long" for k in range(LIMBS))
MODEL = "d int, n long, sums array<decimal(38,0)>, eigen array<double>, explained array<double>, axes array<array<double>>"


def finite_vectors(rows: DataFrame, id_col: str, vec_col: str) -> DataFrame:
    """(id, x): vectors without null and non-finite components c, as floor(256 * c), c as
    double (values beyond 64 bits become the nearest 64-bit number)."""
    odd = F.exists(vec_col, lambda c: c.isNull() | F.isnan(c.cast("double")) | (F.abs(c.cast("double")) == F.lit(float("inf"))))
    return rows.filter(F.col(vec_col).isNotNull() & ~odd).select(
        F.col(id_col).alias("id"), F.transform(vec_col, lambda c: F.floor(c.cast("double") * 256)).alias("x"))


def bit_planes(y: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Bit planes of non-negative numbers (rows, d): words (planes, words), and of each
    plane its dimension and its bit; a dimension has as many as its greatest number."""
    rows, d = y.shape
    words = -(-rows // 64)
    bits = np.array([int(v).bit_length() for v in y.max(axis=0)], dtype=np.int64)
    of, bit = np.repeat(np.arange(d), bits), np.concatenate([np.arange(b) for b in bits] or [np.zeros(0, np.int64)])
    planes = np.zeros((len(of), words * 8), dtype=np.uint8)
    for p in range(int(bits.max(initial=0))):
        has = bits > p
        one = ((y[:, has] >> np.uint64(p)) & np.uint64(1)).astype(np.uint8)
        planes[bit == p, :-(-rows // 8)] = np.packbits(one.T, axis=1)
    return planes.view(np.uint64), of, bit


def cross_products(y: np.ndarray) -> np.ndarray:
    """Exact sums over rows of y[:, i] * y[:, j], for i <= j (Python integers)."""
    d = y.shape[1]
    planes, of, bit = bit_planes(y)
    out = np.zeros((d, d), dtype=object)
    step = max(1, PLANE_WORDS // max(1, planes.shape[1]))
    first = np.searchsorted(of, np.arange(d))
    weight = np.array([1 << int(b) for b in bit], dtype=object)
    for k in range(len(of)):
        i, start = of[k], first[of[k]]
        for a in range(start, len(of), step):
            b = min(a + step, len(of))
            count = np.bitwise_count(planes[a:b] & planes[k]).sum(axis=1, dtype=np.int64)
            if bit[a:b].max() + int(count.max()).bit_length() < 62:
                count = count << bit[a:b]
            else:
                count = count.astype(object) * weight[a:b]
            heads = np.flatnonzero(np.r_[True, of[a + 1:b] != of[a:b - 1]])
            out[i, of[a:b][heads]] += np.add.reduceat(count, heads).astype(object) * (1 << int(bit[k]))
    return out


def block_scatter(x: np.ndarray) -> tuple[int, np.ndarray, np.ndarray]:
    """Of a block of rows: its size, its sums (d) and its cross-products (d, d), i <= j, exactly."""
    n, d = x.shape
    least = x.min(axis=0)
    y = x.view(np.uint64) - least.view(np.uint64)        # modulo 2**64, so the difference is right
    low, high = (y & np.uint64(0xFFFFFFFF)).sum(axis=0, dtype=np.uint64), (y >> np.uint64(32)).sum(axis=0, dtype=np.uint64)
    sums = low.astype(object) + high.astype(object) * (1 << 32)
    m = least.astype(object)
    cross = cross_products(y) + np.outer(m, sums) + np.outer(sums, m) + n * np.outer(m, m)
    return n, sums + n * m, np.triu(cross)


def to_limbs(v: int) -> list[int]:
    out = [(v >> (32 * k)) & 0xFFFFFFFF for k in range(LIMBS - 1)]
    return [*out, v >> (32 * (LIMBS - 1))]


def from_limbs(limbs) -> int:
    return sum(int(v) << (32 * k) for k, v in enumerate(limbs))


def by_length(column: pa.Array) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """(row numbers, vectors as a matrix) of each length in a list column; without the empty ones."""
    lengths = column.value_lengths().to_numpy()
    for d in np.unique(lengths[lengths > 0]):
        rows = np.flatnonzero(lengths == d)
        yield rows, column.take(pa.array(rows)).flatten().to_numpy().reshape(len(rows), d)


def scatter(vectors: DataFrame) -> DataFrame:
    """(d, i, j, limbs) of the vectors x of each length d: cross-products for i <= j, sums
    for j = -1, the count for i = j = -1. Each task adds up its own rows."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: dict[int, list[np.ndarray]] = {}
        total: dict[int, list] = {}

        def add(d: int, x: np.ndarray) -> None:
            part = block_scatter(np.ascontiguousarray(x))
            total[d] = [a + b for a, b in zip(total[d], part)] if d in total else list(part)

        for batch in batches:
            for _, x in by_length(batch.column(0)):
                d = x.shape[1]
                held.setdefault(d, []).append(x)
                if sum(map(len, held[d])) >= BLOCK:
                    every = np.concatenate(held.pop(d))
                    cut = len(every) // BLOCK * BLOCK
                    for k in range(0, cut, BLOCK):
                        add(d, every[k:k + BLOCK])
                    held[d] = [every[cut:]]
        for d, parts in held.items():
            every = np.concatenate(parts)
            if len(every):
                add(d, every)
        for d, (n, sums, cross) in total.items():
            at = [(-1, -1), *((i, -1) for i in range(d)), *((i, j) for i in range(d) for j in range(i, d))]
            limbs = [to_limbs(int(v)) for v in (n, *sums, *(cross[i, j] for i in range(d) for j in range(i, d)))]
            yield pa.RecordBatch.from_arrays(
                [pa.array(np.full(len(at), d), pa.int32()), pa.array([i for i, _ in at], pa.int32()), pa.array([j for _, j in at], pa.int32()),
                 *(pa.array([v[k] for v in limbs], pa.int64()) for k in range(LIMBS))], ["d", "i", "j", *(f"l{k}" for k in range(LIMBS))])

    return vectors.select("x").mapInArrow(run, SCATTER).groupBy("d", "i", "j").agg(*(F.sum(f"l{k}").alias(f"l{k}") for k in range(LIMBS)))


def decompose(n: int, sums: list[int], cross: dict[tuple[int, int], int], most: int):
    """Eigenvalues (falling, positive ones, at most ``most``), their shares of the trace, and
    unit eigenvectors of the covariance, which is centred in integers."""
    d = len(sums)
    v = np.empty((d, d))
    for (i, j), s in cross.items():
        v[i, j] = v[j, i] = (n * s - sums[i] * sums[j]) / (n * n)       # true division of integers: one rounding
    trace = sum(n * cross[i, i] - sums[i] ** 2 for i in range(d)) / (n * n)
    value, vector = np.linalg.eigh(v)
    value, vector = value[::-1], vector[:, ::-1].T
    keep = np.flatnonzero(value > np.finfo(float).eps * d * max(value[0], 0))[:most]
    return value[keep], value[keep] / trace if trace else value[keep], vector[keep]


def models(fit: DataFrame, most: int = 4) -> DataFrame:
    """One row per vector length d with a component: its n, sums, eigenvalues, explained
    shares and axes. ``fit`` (x) holds each vector once. A length's d * (d + 1) / 2 cross-products
    meet in one task."""
    def run(part: pd.DataFrame) -> pd.DataFrame:
        values = {(i, j): from_limbs(v) for i, j, *v in part.drop(columns="d").itertuples(index=False)}
        d, n = int(part["d"].iloc[0]), values.pop((-1, -1))
        sums = [values.pop((i, -1)) for i in range(d)]
        eigen, explained, axes = decompose(n, sums, values, most)
        return pd.DataFrame({"d": [d], "n": [n], "sums": [[Decimal(s) for s in sums]], "eigen": [eigen], "explained": [explained],
                             "axes": [[list(a) for a in axes]]})

    return scatter(fit).groupBy("d").applyInPandas(run, MODEL)


def deviations(x: np.ndarray, n: int, sums: list[int]) -> list[int | None]:
    """Of each row the exact sum over dimensions of (n * x - sum)**2; null beyond 64 bits."""
    s = np.array([v % (1 << 64) for v in sums], dtype=np.uint64)
    y = x.view(np.uint64) * np.uint64(n % (1 << 64)) - s                # modulo 2**64, so is the result
    exact = (y * y).sum(axis=1, dtype=np.uint64)
    about = ((x.astype(np.float64) * n - np.array(sums, dtype=np.float64)) ** 2).sum(axis=1)
    out: list[int | None] = [int(v) for v in exact]
    for r in np.flatnonzero(about > 2.0 ** 63 * (1 - 1e-9)):            # near or beyond the range
        v = sum((n * int(a) - b) ** 2 for a, b in zip(x[r], sums))
        out[r] = v if v < 1 << 63 else None
    return out


def whitened(x: np.ndarray, n: int, sums: list[int], eigen: np.ndarray, axes: np.ndarray) -> np.ndarray:
    """(rows, components): x less its mean, projected, over the root of the eigenvalue."""
    whole = np.array([float(s // n) for s in sums])
    rest = np.array([(s % n) / n for s in sums])
    return ((x.astype(np.float64) - whole) - rest) @ (np.asarray(axes) / np.sqrt(eigen)[:, None]).T


def _held(rows: list) -> dict[int, tuple]:
    return {r["d"]: (r["n"], [int(s) for s in r["sums"]], np.array(r["eigen"]), np.array(r["explained"]), np.array(r["axes"])) for r in rows}


def _passes(spark, model: DataFrame) -> list[tuple[int, int, object]]:
    """Broadcast models of consecutive lengths, MODEL_NUMBERS at a time: (least length,
    greatest length, broadcast). Usually one."""
    sizes = model.select("d", (F.col("d") * (F.size("axes") + 1)).alias("m")).orderBy("d").collect()
    out, lo, total = [], None, 0
    for k, r in enumerate(sizes):
        lo, total = (r["d"], r["m"]) if lo is None else (lo, total + r["m"])
        if k + 1 == len(sizes) or total + sizes[k + 1]["m"] > MODEL_NUMBERS:
            held = model.filter(F.col("d").between(lo, r["d"])).collect()
            out.append((lo, r["d"], spark.sparkContext.broadcast(_held(held))))
            lo = None
    return out


def _spread_error(fit: DataFrame, held, lo: int, hi: int) -> float:
    """The largest absolute entry of the whitened fit list's covariance minus the identity."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total: dict[tuple[int, int, int], list[float]] = {}
        for batch in batches:
            for _, x in by_length(batch.column(0)):
                d = x.shape[1]
                if d not in held.value:
                    continue
                n, sums, eigen, _, axes = held.value[d]
                w = whitened(x, n, sums, eigen, axes)
                for i in range(len(eigen)):
                    for j in range(i, len(eigen)):
                        t = total.setdefault((d, i, j), [0.0, 0.0, 0.0])
                        t[0] += float(w[:, i] @ w[:, j])
                        t[1], t[2] = t[1] + float(w[:, i].sum()), t[2] + float(w[:, j].sum())
        rows = [(*k, *v) for k, v in total.items()]
        yield pa.RecordBatch.from_arrays([
            *(pa.array([r[k] for r in rows], pa.int32()) for k in range(3)),
            *(pa.array([r[k] for r in rows], pa.float64()) for k in range(3, 6))], ["d", "i", "j", "xy", "x", "y"])

    of = fit.filter(F.size("x").between(lo, hi)).select("x").mapInArrow(run, "d int, i int, j int, xy double, x double, y double")
    worst = 0.0
    for r in of.groupBy("d", "i", "j").agg(*(F.sum(c).alias(c) for c in ("xy", "x", "y"))).collect():
        n = held.value[r["d"]][0]
        worst = max(worst, abs(r["xy"] / n - r["x"] / n * r["y"] / n - (r["i"] == r["j"])))
    return worst


def whiten(rows: DataFrame, most: int = 4, id_col: str = "vec_id", vec_col: str = "embedding") -> DataFrame:
    """One row per vector and component: ``id_col``, component (from 1, by falling
    eigenvalue, at most ``most``), n (distinct vectors of the length), deviation (exact; null
    beyond 64 bits), whitened, explained and identity_error (one value).

    Null vectors and those with a null or non-finite component are dropped. Each distinct
    integer vector counts once in the fit, whatever its copies; every row gets its own
    result, also repeated ids and null ids. A length whose vectors are all equal, and the empty
    vector, have no component and give no rows; components whose eigenvalue is zero
    but for rounding are left out."""
    spark = rows.sparkSession
    vectors = staged(finite_vectors(small_batches(rows), id_col, vec_col), "white-vectors")
    kind = vectors.schema["id"].dataType.simpleString()
    fit = staged(vectors.select("x").distinct(), "white-fit")
    model = staged(models(fit, most).filter("size(axes) > 0"), "white-model")
    schema = f"id {kind}, component int, n long, deviation long, whitened double, explained double"

    def project(held):
        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for batch in batches:
                for at, x in by_length(batch.column(1)):
                    if x.shape[1] not in held.value:
                        continue
                    n, sums, eigen, explained, axes = held.value[x.shape[1]]
                    k = len(eigen)
                    each = np.repeat(at, k)
                    yield pa.RecordBatch.from_arrays([
                        batch.column(0).take(pa.array(each)), pa.array(np.tile(np.arange(1, k + 1), len(at)), pa.int32()),
                        pa.array(np.full(len(each), n), pa.int64()),
                        pa.array([v for v in deviations(np.ascontiguousarray(x), n, sums) for _ in range(k)], pa.int64()),
                        pa.array(whitened(x, n, sums, eigen, axes).ravel()), pa.array(np.tile(explained, len(at)))],
                        ["id", "component", "n", "deviation", "whitened", "explained"])
        return run

    passes = _passes(spark, model)
    worst = max((_spread_error(fit, held, lo, hi) for lo, hi, held in passes), default=0.0)
    out = spark.createDataFrame([], schema)
    for k, (lo, hi, held) in enumerate(passes):
        part = vectors.filter(F.size("x").between(lo, hi)).mapInArrow(project(held), schema)
        out = out.unionByName(part) if k else part
    return out.select(F.col("id").alias(id_col), "component", "n", "deviation", "whitened", "explained", F.lit(worst).alias("identity_error"))
