"""MinHash near-duplicates by min-max hashing.

Of each permutation of the shingles both ends are kept: the least and the greatest
value of a set. Either agrees between two sets with the probability of their
Jaccard similarity, so half the hash evaluations fill a signature, the share of
equal slots is an unbiased estimate of the similarity, and its variance is lower
than with as many independent minima (the two ends of one permutation never pick
the same element of a larger set, so they vary against each other).

A band holds both ends of ROWS permutations. Documents that agree on a band are
candidates: each band's members meet one leader first, and another one in every
band, so that the members of a large group hang together after a number of
comparisons in proportion to its size. Only members that are still in different
components are then compared with each other: in small buckets as rows, in large ones
block by block inside a task, where bit planes of the sets bound each overlap
from above, and only pairs that can reach the similarity become rows. Every candidate is
confirmed on the whole sets; a bucket has no cap.

Two sets at exactly 0.8 share no band with a probability of (1 - 0.8**6)**64 = 3e-9 when
they are large, and of 2e-7 for four of five shingles; nearer sets far more rarely.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from quire.llm.common import mix, small_batches, staged
from quire.llm.components import components
from quire.llm.jaccard_join import Rule, _set_key, _sets, _verified, histogram

BANDS = 64
ROWS = 3           # permutations in a band, so 2 * ROWS slots
SMALL = 16         # members of a bucket whose pairs are formed as rows
BLOCK = 512        # members (on average) of a block of a larger bucket
CELLS = 1024       # cells of a set's bit planes
LEVELS = 3         # plane t tells which cells hold more than t elements
SIMILAR = Rule(words=4, num=4, den=5)


def permutations(n: int) -> tuple[np.ndarray, np.ndarray]:
    """n bijections x -> a * x + b of 32-bit numbers (a odd), always the same."""
    rng = np.random.default_rng(20240601)
    a = rng.integers(0, 1 << 32, n, dtype=np.uint32) | np.uint32(1)
    return a, rng.integers(0, 1 << 32, n, dtype=np.uint32)


def min_max(sets: list[np.ndarray], n: int) -> np.ndarray:
    """Signatures (sets, n, 2) of sets of 64-bit elements: the least and the greatest
    value of each under n permutations. Empty sets are 0."""
    out = np.zeros((len(sets), n, 2), dtype=np.uint32)
    full = np.flatnonzero([len(s) > 0 for s in sets])
    if not len(full):
        return out
    x = (np.concatenate([sets[k] for k in full]) >> np.uint64(32)).astype(np.uint32)
    starts = np.concatenate([[0], np.cumsum([len(sets[k]) for k in full])[:-1]])
    y = np.empty_like(x)
    for p, (a, b) in enumerate(zip(*permutations(n))):
        np.multiply(x, a, out=y)
        y += b
        out[full, p, 0] = np.minimum.reduceat(y, starts)
        out[full, p, 1] = np.maximum.reduceat(y, starts)
    return out


def estimate(x: np.ndarray, y: np.ndarray) -> np.ndarray:
    """Unbiased estimates of the Jaccard similarities of two stacks of signatures."""
    return (x == y).mean(axis=(-2, -1))


def band_keys(signatures: np.ndarray, bands: int) -> np.ndarray:
    """(sets, bands): 64-bit keys of the bands, different from band to band."""
    n, perms, _ = signatures.shape
    slots = signatures.reshape(n, bands, 2 * perms // bands).astype(np.uint64)
    key = np.broadcast_to(mix(np.arange(1, bands + 1, dtype=np.uint64)), (n, bands))
    for k in range(slots.shape[2]):
        key = mix(key ^ slots[:, :, k])
    return key


def bit_planes(s: np.ndarray) -> bytes:
    """LEVELS planes of CELLS bits of a set, and the number of elements beyond them."""
    count = np.bincount((s >> np.uint64(54)).astype(np.int64), minlength=CELLS)
    planes = np.packbits(count[None] > np.arange(LEVELS)[:, None], axis=1)
    return planes.tobytes() + np.maximum(count - LEVELS, 0).sum(keepdims=True).astype("<i8").tobytes()


def overlap_bounds(x: np.ndarray, y: np.ndarray) -> np.ndarray:
    """Upper bounds of the overlaps of one set with many, from their planes (words): in each
    cell no more elements can agree than the smaller count."""
    return np.bitwise_count(y[:, :-1] & x[:-1]).sum(axis=1, dtype=np.int64) + np.minimum(
        y[:, -1].view(np.int64), np.int64(x[-1]))


def signed(texts: DataFrame, kind: str, rule: Rule, bands: int, rows: int) -> DataFrame:
    """(id, n, k1, k2, cells, planes, bands) of every text (id, text): size, key, histogram
    and bit planes of its shingle set, and the keys of its signature's bands."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for i, sets in _sets(batch, rule):
                keys = [_set_key(s) for s in sets]
                sigs = band_keys(min_max(sets, bands * rows), bands).view(np.int64)
                offsets = np.concatenate([[0], np.cumsum([bands if len(s) else 0 for s in sets])])
                held = sigs[[len(s) > 0 for s in sets]].ravel()
                yield pa.RecordBatch.from_arrays([
                    batch.column(0).slice(i, len(sets)), pa.array([len(s) for s in sets], pa.int64()),
                    pa.array([k for k, _ in keys], pa.int64()), pa.array([k for _, k in keys], pa.int64()),
                    pa.array([histogram(s) for s in sets], pa.binary()), pa.array([bit_planes(s) for s in sets], pa.binary()),
                    pa.ListArray.from_arrays(pa.array(offsets, pa.int32()), pa.array(held, pa.int64()))],
                    ["id", "n", "k1", "k2", "cells", "planes", "bands"])

    return texts.mapInArrow(run, f"id {kind}, n long, k1 long, k2 long, cells binary, planes binary, bands array<long>")


def _led(lists: DataFrame) -> DataFrame:
    """(a, b): each member of a band's bucket with the bucket's leader."""
    return lists.filter("rep <> leader").select(F.col("rep").alias("a"), F.col("leader").alias("b")).distinct()


def _members(column: pa.ListScalar) -> tuple[np.ndarray, ...]:
    """Of a block: ids, set sizes, components, and planes as words."""
    v = column.values
    rep, n, component = (v.field(k).to_numpy(zero_copy_only=False) for k in ("rep", "n", "component"))
    return rep, n, component, np.frombuffer(b"".join(v.field("planes").to_pylist()), np.uint64).reshape(len(n), -1)


def _block_pairs(blocks: DataFrame, kind: str, rule: Rule) -> DataFrame:
    """(a, b): of rows (main, x, y), the pairs of a member of block x and one of block y that
    belong to different components and can be near enough."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for r in range(batch.num_rows):
                main = batch.column(0)[r].as_py()
                rep, n, component, planes = _members(batch.column(1)[r])
                reps, m, components_, others = _members(batch.column(2)[r])
                a, b = [], []
                for k in range(len(rep)):
                    fit = np.flatnonzero((components_ != component[k]) & ((components_ == main) | (reps > rep[k])) & (
                        np.minimum(m, n[k]) * rule.den >= np.maximum(m, n[k]) * rule.num))
                    most = overlap_bounds(planes[k], others[fit])
                    fit = fit[most * (rule.num + rule.den) >= (m[fit] + n[k]) * rule.num]
                    a += [rep[k]] * len(fit)
                    b.append(reps[fit])
                one = batch.schema.field("x").type.value_type.field("rep").type
                yield pa.RecordBatch.from_arrays([pa.array(a, one), pa.array(np.concatenate(b) if b else [], one)], ["a", "b"])

    return blocks.select("main", "x", "y").mapInArrow(run, f"a {kind}, b {kind}")


def _across(lists: DataFrame, joined: DataFrame, classes: DataFrame, kind: str, rule: Rule) -> DataFrame:
    """(a, b): pairs of a bucket whose members belong to different components.

    The bucket's largest component needs no comparing within; every other member
    (a stray) meets the members of all other components, near enough in size."""
    member = staged(lists.join(joined, F.col("rep") == F.col("id"), "left").select(
        "sig", "rep", "n", F.coalesce("component", "rep").alias("component")), "minhash-members")
    sizes = member.groupBy("sig", "component").agg(F.count(F.lit(1)).alias("size"))
    mixed = sizes.groupBy("sig").agg(F.max_by("component", "size").alias("main"), F.count(F.lit(1)).alias("parts"),
                                     F.sum("size").alias("size"), F.max("size").alias("most")).filter("parts > 1").drop("parts")
    held = staged(member.join(mixed, "sig"), "minhash-open")

    small = held.filter(F.col("size") <= SMALL)
    x, y = small.filter("component <> main").alias("x"), small.alias("y")
    once = (F.col("y.component") == F.col("y.main")) | (F.col("x.rep") < F.col("y.rep"))
    near = F.least("x.n", "y.n") * rule.den >= F.greatest("x.n", "y.n") * rule.num
    few = x.join(y, (F.col("x.sig") == F.col("y.sig")) & once & near & (F.col("x.component") != F.col("y.component"))).select(
        F.col("x.rep").alias("a"), F.col("y.rep").alias("b"))

    large = staged(held.filter(F.col("size") > SMALL).join(classes.select("rep", "planes"), "rep").select(
        "sig", "main", "component", F.ceil(F.col("size") / BLOCK).alias("blocks"),
        F.ceil((F.col("size") - F.col("most")) / BLOCK).alias("strays"), F.xxhash64("rep").alias("h"),
        F.struct("rep", "n", "component", "planes").alias("v")), "minhash-large")
    ys = large.groupBy("sig", F.pmod("h", "blocks").alias("at")).agg(F.collect_list("v").alias("y"))
    xs = large.filter("component <> main").groupBy("sig", "main", "blocks", F.pmod("h", "strays").alias("part")).agg(
        F.collect_list("v").alias("x")).withColumn("at", F.explode(F.sequence(F.lit(0).cast("long"), F.col("blocks") - 1)))
    return few.union(_block_pairs(xs.join(ys, ["sig", "at"]), kind, rule)).distinct()


def near_duplicates(docs: DataFrame, rule: Rule = SIMILAR, id_col: str = "doc_id", text_col: str = "text",
                    bands: int = BANDS, rows: int = ROWS) -> DataFrame:
    """One row per input row: ``id_col``, n_shingles (size of its set), component_id
    (the least id reachable by links, itself included) and kept (it is that id).

    Words are runs other than space and 0x09-0x0D, A-Z in lower case; a set holds the
    distinct shingles of ``rule.words`` words (fewer words: the whole sequence).
    Null texts and texts without words have empty sets and link with nothing. Equal
    sets are one class whatever their number. Ids are meant to be unique: of rows with the
    same id and different texts, those that stand for their texts count as one
    document. A row with a null id makes no links; it has the component of its equal
    texts and is not kept, or null and is kept if there are none."""
    texts = small_batches(docs).select(F.col(id_col).alias("id"), F.col(text_col).alias("text"))
    kind = texts.schema["id"].dataType.simpleString()
    every = staged(signed(texts, kind, rule, bands, rows), "minhash-signed")
    classes = staged(every.filter("n > 0 and id is not null").groupBy("k1", "k2", "n").agg(
        F.min("id").alias("rep"), *(F.first(c).alias(c) for c in ("cells", "planes", "bands"))), "minhash-classes")

    entries = classes.select("rep", "n", F.explode("bands").alias("sig"))
    # Another leader in each bucket: large groups hang together through many of their members.
    heads = entries.groupBy("sig").agg(F.count(F.lit(1)).alias("size"), F.min_by("rep", F.xxhash64("sig", "rep")).alias("leader"))
    lists = staged(entries.join(heads.filter("size > 1").drop("size"), "sig"), "minhash-lists")
    links = _verified(_led(lists), classes, texts, kind, rule)
    more = _verified(_across(lists, components(links), classes, kind, rule), classes, texts, kind, rule)

    named = staged(classes.select("k1", "k2", "n", "rep").join(components(links.union(more)), F.col("rep") == F.col("id"), "left").select(
        "k1", "k2", "n", F.coalesce("component", "rep").alias("component")), "minhash-named")
    component = F.when(F.col("n") == 0, F.col("id")).otherwise(F.col("component"))
    return every.select("id", "n", "k1", "k2").join(named, ["k1", "k2", "n"], "left").select(
        F.col("id").alias(id_col), F.col("n").alias("n_shingles"), component.alias("component_id"),
        F.coalesce(F.col("id") == component, component.isNull()).alias("kept"))
