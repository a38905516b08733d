"""Document fingerprints from closed syncmers.

A k-mer of code points is a closed syncmer if the smallest hash among its inner
s-mers is that of its first or its last one. Whether a k-mer is chosen depends
on nothing around it, so equal passages choose equal anchors wherever they
stand. A fingerprint keeps the anchors with the smallest hashes (all of them in
a short text) with their positions; the likeness of two fingerprints is the
estimated share of anchors that both have in the same relative order.
"""

from __future__ import annotations

import hashlib
from bisect import bisect_left
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from quire.llm.common import mix, small_batches

K, S = 12, 5          # k-mers and their inner s-mers, in code points
ANCHORS = 128         # anchors of a fingerprint: those with the smallest hashes

_BASE = np.uint64(0x9E3779B97F4A7C15)


def _window_hash(points: np.ndarray, n: int) -> np.ndarray:
    """Hashes of all windows of n code points."""
    m = len(points) - n + 1
    h = np.zeros(m, dtype=np.uint64)
    for k in range(n):
        h = h * _BASE + points[k:k + m]
    return mix(h)


def closed_syncmers(points: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(positions, hashes) of the closed syncmers of a text given as code points.

    In a text shorter than K all s-mers are anchors, and one shorter than S is its
    own anchor; an empty text has none. Hashes have 32 bits."""
    points = points.astype(np.uint64) + np.uint64(1)
    if len(points) < K:
        h = _window_hash(points, min(S, len(points))) if len(points) else points
        return np.arange(len(h)), h >> np.uint64(32)
    inner = _window_hash(points, S)
    width = K - S + 1
    low, reach = inner, 1
    while reach < width:       # running minimum of `width` inner hashes, by doubling
        step = min(reach, width - reach)
        low = np.minimum(low[:-step], low[step:])
        reach += step
    chosen = np.flatnonzero((inner[:len(low)] == low) | (inner[width - 1:] == low))
    # A syncmer's hash comes from inner hashes that cover it: first, middle, last.
    h = inner[chosen] * _BASE + inner[chosen + (K - S) // 2 + 1] * np.uint64(0xC2B2AE3D27D4EB4F) + inner[chosen + K - S]
    return chosen, mix(h) >> np.uint64(32)


def code_points(text: str) -> np.ndarray:
    return np.frombuffer(text.encode("utf-32-le", "surrogatepass"), np.uint32)


class Fingerprint:
    """The distinct anchors with the smallest hashes, in hash order, each with its first position."""

    def __init__(self, points: np.ndarray):
        at, h = closed_syncmers(points)
        if len(h) > 4 * ANCHORS:           # the smallest few times as many hold the smallest distinct ones, or else all are looked at
            near = np.partition(h, 4 * ANCHORS)[4 * ANCHORS]
            few = h <= near
            if len(np.unique(h[few])) >= ANCHORS:
                at, h = at[few], h[few]
        kept, first = np.unique(h, return_index=True)
        self.hashes, self.at = kept[:ANCHORS], at[first[:ANCHORS]]

    def __str__(self) -> str:
        return ".".join(f"{h:08x}:{p:x}" for h, p in zip(self.hashes.tolist(), self.at.tolist()))


def parse(fingerprint: str) -> tuple[np.ndarray, np.ndarray]:
    """(hashes, positions) of a fingerprint string."""
    pairs = [x.split(":") for x in fingerprint.split(".")] if fingerprint else []
    return np.array([int(h, 16) for h, _ in pairs], np.uint64), np.array([int(p, 16) for _, p in pairs], np.int64)


def _in_order(a: np.ndarray) -> int:
    """Length of the longest increasing subsequence."""
    tails: list[int] = []
    for x in a.tolist():
        k = bisect_left(tails, x)
        tails[k:k + 1] = [x]
    return len(tails)


def likeness(a: tuple[np.ndarray, np.ndarray], b: tuple[np.ndarray, np.ndarray]) -> float:
    """Estimated share of anchors (twice the common ones over both counts) that
    stand in the same order in both texts; 1 for two texts without anchors."""
    (ha, pa_), (hb, pb) = a, b
    if not len(ha) or not len(hb):
        return float(len(ha) == len(hb))
    union = np.union1d(ha, hb)
    if len(ha) == ANCHORS or len(hb) == ANCHORS:   # only up to here are both lists complete
        union = union[:ANCHORS]
    common, ia, ib = np.intersect1d(ha, hb, assume_unique=True, return_indices=True)
    seen = common <= union[-1]
    ia, ib = ia[seen], ib[seen]
    if not len(ia):
        return 0.0
    order = np.argsort(pa_[ia], kind="stable")
    jaccard = _in_order(pb[ib][order]) / len(union)
    return float(2 * jaccard / (1 + jaccard))


def edited(points: np.ndarray, following: np.ndarray) -> np.ndarray:
    """The last half of a text replaced by as many first code points of the following one."""
    half = len(points) // 2
    return np.concatenate([points[:len(points) - half], following[:half]])


RESULT = ("n_chars long, edited_sha256 string, fingerprint string, edited_fingerprint string, "
          "near_edited double, near_next double")
RANGES = 4   # ranges of ids for each shuffle partition


def fingerprints(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Fingerprint of every whole text and of its edited text, whose last half is
    replaced by the start of the next document in ascending id (after the last:
    the first). Returns ``id_col`` and RESULT.

    The texts are shuffled once, into ranges of (numeric) ids. The first document
    of each range also goes to the end of the range before, so that every
    neighbour is at hand. Null texts are empty (no anchors, fingerprint ''). Rows
    with equal ids follow each other by text; null ids come first. A single
    document follows itself. An empty table gives an empty result."""
    spark = docs.sparkSession
    rows = small_batches(docs).select(F.col(id_col).alias("id"), F.coalesce(F.col(text_col), F.lit("")).alias("text"))
    kind = rows.schema["id"].dataType.simpleString()
    tasks = max(1, int(spark.conf.get("spark.sql.shuffle.partitions")))
    n = tasks * RANGES
    # Bounds of the ranges are quantiles of the ids, and each range has a least id: lists of at most n values.
    cuts = sorted(set(rows.agg(F.percentile_approx("id", [k / n for k in range(1, n)], 100 * n)).first()[0] or []))
    rows = rows.withColumn("part", _range_of(cuts))
    least = rows.groupBy("part").agg(F.min(F.struct(F.col("id").isNotNull().alias("has"), "id")).alias("least")).orderBy(
        "part").select("part", "least.id").collect()
    # A range's least row also ends the range before; the very first one ends the last range.
    heads = spark.createDataFrame([(r["part"], r["id"], least[k - 1]["part"]) for k, r in enumerate(least)],
                                  f"part int, head {kind}, before int")
    here = F.struct(F.col("part").alias("part"), F.lit(False).alias("end"))
    there = F.struct(F.col("before").alias("part"), F.lit(True).alias("end"))
    places = F.when(F.col("id").eqNullSafe(F.col("head")), F.array(here, there)).otherwise(F.array(here))
    dealt = rows.join(F.broadcast(heads), "part").select("id", "text", F.inline(places)).repartition(
        tasks, "part").sortWithinPartitions("part", "end", F.col("id").asc_nulls_first(), "text")
    id_type = dealt.select("id").limit(0).toArrow().schema.field(0).type

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        made: list[tuple] = []
        held = None            # (part, id, points, fingerprint) of the row that waits for the next one
        for batch in batches:
            for i, text, part, end in zip(*(batch.column(k).to_pylist() for k in range(4))):
                points = code_points(text)
                mark = Fingerprint(points)
                if held is not None and held[0] == part:
                    made.append(_result(*held[1:], points, mark))
                held = None if end else (part, i, points, mark)
                if len(made) >= 512:
                    yield _batch(made, id_type)
                    made = []
        if made:
            yield _batch(made, id_type)

    return dealt.select("id", "text", "part", "end").mapInArrow(run, f"id {kind}, {RESULT}").withColumnRenamed("id", id_col)


def _range_of(cuts: list) -> Column:
    """How many cuts are <= id (0 for a null id), as a balanced tree of comparisons."""
    def tree(lo: int, hi: int) -> Column:
        if lo == hi:
            return F.lit(lo)
        mid = (lo + hi) // 2
        return F.when(F.col("id") >= F.lit(cuts[mid]), tree(mid + 1, hi)).otherwise(tree(lo, mid))
    return tree(0, len(cuts))


def _result(i, points, mark, next_points, next_mark) -> tuple:
    new = edited(points, next_points)
    new_mark = Fingerprint(new)
    raw = new.astype("<u4").tobytes().decode("utf-32-le", "surrogatepass").encode("utf-8", "surrogatepass")
    a, b, c = ((m.hashes, m.at) for m in (mark, new_mark, next_mark))
    return (i, len(points), hashlib.sha256(raw).hexdigest(), str(mark), str(new_mark), likeness(a, b), likeness(a, c))


def _batch(rows: list[tuple], id_type: pa.DataType) -> pa.RecordBatch:
    kinds = [id_type, pa.int64(), pa.string(), pa.string(), pa.string(), pa.float64(), pa.float64()]
    names = ["id", "n_chars", "edited_sha256", "fingerprint", "edited_fingerprint", "near_edited", "near_next"]
    return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*rows), kinds)], names)
