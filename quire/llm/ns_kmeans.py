"""Centroid clustering with ns-bounds: exact Lloyd rounds over integer vectors.

Every vector keeps, for each centroid, a bound of its distance and the round in which
that distance was last evaluated. All past centroids are kept (rounds x clusters
vectors). To use a bound of round s in round t, it is loosened by the norm of the
centroid's total displacement between the two rounds, |c_t - c_s|, which is never more
than the sum of its drifts round by round. A centroid whose lower bound stays above the
upper bound of the nearest one cannot be nearest; all others fail the test and are
evaluated again exactly, in integers. So the assignments are those of a full scan.

The bounds are double precision and widened by SLACK on use, far beyond their
rounding; they decide only what is evaluated, never who wins.
"""

from __future__ import annotations

from collections.abc import Iterator
from math import sqrt

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from quire.llm.common import dropped, small_batches, staged

SLACK = 1e-9
SAFE = 1 << 27      # differences below this square and add up in 64 bits (up to 2**8 components)
ROWS = 4096         # rows whose bounds are held at once


def integer_vectors(rows: DataFrame, size: int, id_col: str, vec_col: str) -> DataFrame:
    """(id, x): vectors of exactly ``size`` finite components c, as floor(256 * c), c as
    double (values beyond 64 bits become the nearest 64-bit number)."""
    finite = ~F.exists(vec_col, lambda c: c.isNull() | F.isnan(c.cast("double")) | (F.abs(c.cast("double")) == F.lit(float("inf"))))
    return rows.filter((F.size(vec_col) == size) & finite).select(
        F.col(id_col).alias("id"), F.transform(vec_col, lambda c: F.floor(c.cast("double") * 256)).alias("x"))


def squared(x: np.ndarray, c: np.ndarray) -> np.ndarray:
    """Exact squared distances of rows x to c (one vector, or one a row)."""
    if not len(x):
        return np.zeros(0, dtype=np.int64)
    if max(abs(int(x.max())), abs(int(x.min())), abs(int(c.max())), abs(int(c.min()))) < SAFE // 2 and x.shape[1] <= 256:
        d = x - c
        return np.einsum("ij,ij->i", d, d)
    d = x.astype(object) - c.astype(object)
    return (d * d).sum(axis=1)


def norms(values) -> np.ndarray:
    """Square roots of exact squares."""
    return np.sqrt(values) if getattr(values, "dtype", None) == np.int64 else np.array([sqrt(int(v)) for v in values])


class Bounds:
    """What a set of vectors knows: ``at`` (the nearest centroid), and for each centroid
    ``near`` (its distance when last evaluated) and ``seen`` (the round of that)."""

    def __init__(self, at: np.ndarray, near: np.ndarray, seen: np.ndarray):
        self.at, self.near, self.seen = at, near, seen
        self.scanned = 0

    @classmethod
    def fresh(cls, x: np.ndarray, centroids: np.ndarray) -> Bounds:
        """All distances evaluated in round 0."""
        k = len(centroids)
        square = np.empty((len(x), k), dtype=object)
        for j in range(k):
            square[:, j] = squared(x, centroids[j])
        out = cls(square.argmin(axis=1), norms(square.ravel()).reshape(len(x), k), np.zeros((len(x), k), dtype=np.int64))
        out.scanned = square.size
        return out

    def advance(self, x: np.ndarray, history: np.ndarray) -> None:
        """Move to the last round of ``history`` (rounds, k, size): ``at`` becomes the
        nearest of its centroids, the smaller number on ties."""
        t, k = len(history) - 1, history.shape[1]
        now = history[t]
        # moved[s, j]: how far centroid j is from where it was in round s.
        moved = np.array([norms(squared(now, history[s])) for s in range(t + 1)])
        every = np.arange(len(x))
        low = (self.near - moved[self.seen, np.arange(k)]) * (1 - SLACK)
        low[every, self.at] = np.inf
        high = (self.near[every, self.at] + moved[self.seen[every, self.at], self.at]) * (1 + SLACK)
        best = np.full(len(x), None, dtype=object)          # exact squares, where evaluated
        rows = np.flatnonzero((low <= high[:, None]).any(axis=1))
        # Bring the upper bounds of these up to date; only then look which centroids still fail.
        best[rows] = squared(x[rows], now[self.at[rows]])
        high[rows] = norms(best[rows])
        self.near[rows, self.at[rows]], self.seen[rows, self.at[rows]] = high[rows], t
        high[rows] *= 1 + SLACK
        self.scanned += len(rows)
        fail = np.zeros(low.shape, dtype=bool)
        fail[rows] = low[rows] <= high[rows, None]
        for j in range(k):
            r = np.flatnonzero(fail[:, j])
            if not len(r):
                continue
            d = squared(x[r], now[j])
            self.near[r, j], self.seen[r, j] = norms(d), t
            self.scanned += len(r)
            win = (d < best[r]) | ((d == best[r]) & (j < self.at[r]))
            self.at[r[win]] = j
            best[r[win]] = d[win]


def _vectors(column: pa.Array, size: int) -> np.ndarray:
    return column.flatten().to_numpy(zero_copy_only=False).reshape(len(column), size)


def _blocks(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for i in range(0, batch.num_rows, ROWS):
            yield batch.slice(i, ROWS)


def _packed(batch: pa.RecordBatch, b: Bounds) -> pa.RecordBatch:
    """A state row: id, x, its centroid, and its bounds as bytes."""
    near, seen = b.near.astype("<f8"), b.seen.astype(np.uint8)
    return pa.RecordBatch.from_arrays([
        batch.column(0), batch.column(1), pa.array(b.at, pa.int32()), pa.array([r.tobytes() for r in near], pa.binary()),
        pa.array([r.tobytes() for r in seen], pa.binary()), pa.array(np.full(len(b.at), b.scanned / max(len(b.at), 1)), pa.float64())],
        ["id", "x", "at", "near", "seen", "scanned"])


def _unpacked(batch: pa.RecordBatch, k: int) -> Bounds:
    return Bounds(batch.column(2).to_numpy().astype(np.int64),
                  np.frombuffer(b"".join(batch.column(3).to_pylist()), "<f8").reshape(-1, k).copy(),
                  np.frombuffer(b"".join(batch.column(4).to_pylist()), np.uint8).reshape(-1, k).astype(np.int64))


def _sums(state: DataFrame, k: int, size: int) -> dict[int, tuple[int, list[int]]]:
    """Per centroid, how many vectors it has and their exact sums. Each task adds up
    its own rows; k x size numbers reach the driver."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        count = np.zeros(k, dtype=np.int64)
        high, low = (np.zeros((k, size), dtype=np.int64) for _ in range(2))      # x = high * 2**32 + low
        for batch in _blocks(batches):
            at, x = batch.column(0).to_numpy(), _vectors(batch.column(1), size)
            count += np.bincount(at, minlength=k)
            np.add.at(high, at, x >> 32)
            np.add.at(low, at, x & 0xFFFFFFFF)
        used = np.flatnonzero(count)
        yield pa.RecordBatch.from_arrays([
            pa.array(used, pa.int32()), pa.array(count[used]), pa.array(list(high[used]), pa.list_(pa.int64())),
            pa.array(list(low[used]), pa.list_(pa.int64()))], ["at", "n", "high", "low"])

    part = state.select("at", "x").mapInArrow(run, "at int, n long, high array<long>, low array<long>")
    each = part.select("at", "n", F.posexplode(F.arrays_zip("high", "low")).alias("pos", "v"))
    rows = each.groupBy("at", "pos").agg(F.sum("n").alias("n"), F.sum("v.high").alias("high"), F.sum("v.low").alias("low")).collect()
    out: dict[int, tuple[int, list[int]]] = {}
    for r in rows:
        out.setdefault(r["at"], (r["n"], [0] * size))[1][r["pos"]] = (r["high"] << 32) + r["low"]
    return out


def start_centroids(vectors: DataFrame, k: int, salt: str) -> np.ndarray:
    """The k vectors with the smallest sha256 of ``salt`` and id, in that order (of rows
    with the same id, by their vectors; rows without an id last)."""
    digest = F.sha2(F.concat(F.lit(salt), F.col("id").cast("string")), 256)
    rows = vectors.select(digest.alias("h"), "x").orderBy(F.col("h").asc_nulls_last(), "x").limit(k).collect()
    return np.array([r["x"] for r in rows], dtype=np.int64)


def cluster(rows: DataFrame, k: int = 40, rounds: int = 5, size: int = 64, salt: str = "2:",
            id_col: str = "vec_id", vec_col: str = "embedding") -> DataFrame:
    """One row per vector of ``size`` finite components: ``id_col``, cluster (int),
    distance (squared, to its centroid), cluster_inertia and inertia (distances added over
    its cluster and over all; null beyond 64 bits), centroid_sha256 (of the centroid's
    components in decimal, joined by commas) and scanned (distances evaluated per vector).

    ``rounds`` times every vector goes to its nearest centroid (the smaller number on
    ties) and every centroid that has vectors moves to floor(sum / count) of each
    component; then vectors are assigned once more. Rows may repeat, also ids; a null
    id stays null. With fewer than k vectors there are as many centroids; without
    any the result is empty. A distance beyond 64 bits is null."""
    spark = rows.sparkSession
    vectors = integer_vectors(small_batches(rows), size, id_col, vec_col)
    kind = vectors.schema["id"].dataType.simpleString()
    schema = f"id {kind}, x array<long>, at int, near binary, seen binary, scanned double"
    history = start_centroids(vectors, k, salt)[None]
    k = history.shape[1] if history.size else 0
    if not k:
        return spark.createDataFrame([], f"{id_col} {kind}, cluster int, distance long, cluster_inertia long, inertia long, "
                                         "centroid_sha256 string, scanned double")

    def first(batches: Iterator[pa.RecordBatch], held) -> Iterator[pa.RecordBatch]:
        for batch in _blocks(batches):
            if batch.num_rows:
                yield _packed(batch, Bounds.fresh(_vectors(batch.column(1), size), held.value[0]))

    def next_round(batches: Iterator[pa.RecordBatch], held) -> Iterator[pa.RecordBatch]:
        for batch in _blocks(batches):
            if batch.num_rows:
                b = _unpacked(batch, k)
                b.advance(_vectors(batch.column(1), size), held.value)
                b.scanned += batch.column(5).to_numpy().sum()
                yield _packed(batch, b)

    def step(frame: DataFrame, run) -> DataFrame:
        held = spark.sparkContext.broadcast(history)       # rounds x k x size numbers
        out = staged(frame.mapInArrow(lambda b: run(b, held), schema), "ns-state")
        held.destroy()
        return out

    state = step(vectors, first)
    for _ in range(rounds):
        now = history[-1].copy()
        for j, (n, total) in _sums(state, k, size).items():
            now[j] = [v // n for v in total]
        history = np.concatenate([history, now[None]])
        before, state = state, step(state, next_round)
        dropped(before)

    final = spark.sparkContext.broadcast(history[-1])

    def measured(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in _blocks(batches):
            at = batch.column(1).to_numpy()
            d = squared(_vectors(batch.column(2), size), final.value[at])
            d = pa.array(d if d.dtype == np.int64 else [int(v) if v < 1 << 63 else None for v in d], pa.int64())
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), d, batch.column(3)], ["id", "at", "distance", "scanned"])

    found = staged(state.select("id", "at", "x", "scanned").mapInArrow(measured, f"id {kind}, at int, distance long, scanned double"), "ns-final")
    whole = F.sum(F.col("distance").cast("decimal(38,0)"))
    known = F.count(F.lit(1)) == F.count("distance")
    per = {r["at"]: r["s"] if r["known"] else None for r in found.groupBy("at").agg(whole.alias("s"), known.alias("known")).collect()}
    total = None if None in per.values() else sum(per.values())
    names = [(j, _long(per.get(j)), _long(total)) for j in range(k)]
    about = spark.createDataFrame(
        [(j, a, b, ",".join(map(str, history[-1][j].tolist()))) for j, a, b in names], "at int, cluster_inertia long, inertia long, c string")
    # At most k rows.
    return found.join(F.broadcast(about), "at").select(
        F.col("id").alias(id_col), F.col("at").alias("cluster"), "distance", "cluster_inertia", "inertia",
        F.sha2("c", 256).alias("centroid_sha256"), "scanned")


def _long(v) -> int | None:
    return int(v) if v is not None and v < 1 << 63 else None
