"""N-gram Jaccard join: a size-aware heavy-light set join.

A document's set holds its distinct word shingles. Equal sets are one class.
Between classes, small (light) sets are joined by enumerating the subsets of
the sizes that an overlap must have, as signatures that linked sets share. Pairs
with a large (heavy) set are found by scanning inverted lists of the elements
that come first in a global order (frequent elements last): linked sets share
one of those. The boundary is the one with the least cost for the sizes at hand.

Candidates are verified on the whole sets. In each inverted list members are
first compared with one leader only; once the links so found have joined
documents into components, only pairs across components are left to compare.
No link between different components is lost, and no group of copies is ever
expanded into all its pairs.
"""

from __future__ import annotations

from collections.abc import Iterator
from math import comb
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from quire.llm.common import mix, small_batches, staged, text_slices, tidy, word_hashes
from quire.llm.components import components

COUNT_CHUNK = 1 << 22       # elements counted together when looking for frequent ones
HOT_LOCAL, HOT_MIN = 2, 8   # counts that make an element frequent in a chunk, and over all
HOT_MAX = 1 << 19           # frequent elements that the order knows (the order only affects speed)
LIGHT_MOST = 64             # largest boundary considered
LIST_COST = 3.0             # cost of scanning one inverted list, in enumerated signatures
CELLS = 64                  # cells of a set's histogram, which bounds overlaps from above
BUCKETS = 1 << 20           # bound of the (broadcast) table of id hashes that preselects texts to verify

_BASE = np.uint64(0x9E3779B97F4A7C15)


class Rule(NamedTuple):
    """What links two documents: a Jaccard similarity of at least num / den of
    their sets of distinct shingles of ``words`` words."""

    words: int = 5
    num: int = 4
    den: int = 5

    def overlap(self, n: int, m: int) -> int:
        """The least overlap of linked sets of n and m elements."""
        return -(-self.num * (n + m) // (self.num + self.den))

    def partner(self, n: int) -> int:
        """The least size of a set that can link with one of n elements."""
        return -(-self.num * n // self.den)

    def prefix(self, n: int) -> int:
        """So many first elements of a set meet the first elements of every linked set."""
        return n - self.partner(n) + 1


def shingle_set(words: np.ndarray, size: int) -> np.ndarray:
    """Sorted distinct shingles (64-bit hashes) of a text's word hashes; a text of
    fewer words has its whole sequence as its only one, one without words none."""
    n = len(words)
    if n == 0:
        return np.zeros(0, np.uint64)
    k = min(n, size)
    g = np.zeros(n - k + 1, dtype=np.uint64)
    for j in range(k):
        g = g * _BASE + words[j:n - k + 1 + j]
    return np.unique(mix(g + np.uint64(k)))


def _sets(batch: pa.RecordBatch, rule: Rule) -> Iterator[tuple[int, list[np.ndarray]]]:
    for i, _, buf, offsets in text_slices(batch):
        words, bounds = word_hashes(buf, offsets, lower=True)
        yield i, [shingle_set(words[a:b], rule.words) for a, b in zip(bounds[:-1], bounds[1:])]


def _set_key(s: np.ndarray) -> tuple[int, int]:
    """128 bits that tell sets apart."""
    one, two = mix(s), mix(s ^ np.uint64(0x5851F42D4C957F2D))
    return int(one.sum(dtype=np.uint64).view(np.int64)), int(two.sum(dtype=np.uint64).view(np.int64))


def histogram(s: np.ndarray) -> bytes:
    """How many elements fall into each of CELLS cells (16 bits each); empty if a
    count does not fit, which bounds nothing."""
    count = np.bincount((s >> np.uint64(58)).astype(np.int64), minlength=CELLS)
    return count.astype("<u2").tobytes() if len(s) and count.max() < 1 << 16 else b""


def most_overlap(x: list[bytes], y: list[bytes], sizes: np.ndarray) -> np.ndarray:
    """Upper bounds of the overlaps of pairs of sets: in each cell no more elements
    can agree than the smaller count. ``sizes``: what bounds pairs without histograms."""
    out = sizes.copy()
    both = np.array([bool(a) and bool(b) for a, b in zip(x, y)], dtype=bool)
    if both.any():
        one, two = (np.frombuffer(b"".join(v[k] for k in np.flatnonzero(both)), "<u2").reshape(-1, CELLS) for v in (x, y))
        out[both] = np.minimum(one, two).sum(axis=1, dtype=np.int64)
    return out


def frequent_elements(texts: DataFrame, rule: Rule) -> tuple[np.ndarray, np.ndarray]:
    """Elements that many sets hold and about how many, sorted by element.

    At most HOT_MAX of them reach the driver. A missing or inexact count cannot
    change the join's result, only the length of the lists that it scans."""
    @tidy
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held = np.empty(COUNT_CHUNK, np.uint64)      # filled, sorted in place, and filled again
        seen: set[tuple[int, int]] = set()
        size = 0

        def counted() -> pa.RecordBatch:
            part = held[:size]
            part.sort()
            heads = np.flatnonzero(np.concatenate([[True], part[1:] != part[:-1]]))
            often = np.diff(np.append(heads, size))
            heads, often = heads[often >= HOT_LOCAL], often[often >= HOT_LOCAL]
            return pa.RecordBatch.from_arrays([pa.array(part[heads].view(np.int64)), pa.array(often.astype(np.int64))], ["x", "n"])

        for batch in batches:
            for _, sets in _sets(batch, rule):
                for s in sets:
                    key = _set_key(s)
                    if key in seen or not len(s):
                        continue
                    seen.add(key)
                    while len(s):
                        if size == COUNT_CHUNK:
                            yield counted()
                            seen, size = set(), 0
                        part = s[:COUNT_CHUNK - size]
                        held[size:size + len(part)] = part
                        size, s = size + len(part), s[len(part):]
        if size:
            yield counted()

    counts = staged(texts.select("text").mapInArrow(run, "x long, n long").groupBy("x").agg(F.sum("n").alias("n")).filter(
        F.col("n") >= HOT_MIN), "jaccard-frequent")
    # The least power of two so that no more than HOT_MAX elements are as frequent (at most 64 rows decide).
    steps = counts.groupBy(F.floor(F.log2("n")).alias("step")).count().orderBy(F.desc("step")).collect()
    least, total = 1 << 62, 0
    for r in steps:
        total += r["count"]
        if total > HOT_MAX:
            break
        least = 1 << r["step"]
    found = counts.filter(F.col("n") >= least).toArrow()
    x, n = found["x"].to_numpy().view(np.uint64), found["n"].to_numpy()
    order = np.argsort(x)
    return x[order], n[order]


def light_overlaps(boundary: int, rule: Rule) -> dict[int, list[int]]:
    """For each light size, the sizes of the subsets that it enumerates."""
    out = {}
    for n in range(1, boundary + 1):
        out[n] = sorted({rule.overlap(n, m) for m in range(1, boundary + 1) if rule.overlap(n, m) <= min(n, m)})
    return out


def choose_boundary(sizes: dict[int, int], rule: Rule) -> int:
    """The light-heavy boundary of least cost: signatures that light sets
    enumerate, and inverted lists that heavy sets (and light ones just below) scan."""
    best, at = float("inf"), 0
    for boundary in range(0, LIGHT_MOST + 1):
        plan, edge = light_overlaps(boundary, rule), rule.partner(boundary + 1)
        cost = sum(c * sum(comb(n, t) for t in plan[n]) for n, c in sizes.items() if 0 < n <= boundary)
        cost += sum(c * LIST_COST * rule.prefix(n) for n, c in sizes.items() if n >= max(1, edge))
        if cost < best:
            best, at = cost, boundary
    return at


def _subset_signatures(s: np.ndarray, t: int) -> np.ndarray:
    """Signatures of all t-element subsets of a light set: sums of mixed elements,
    so that a subset is the whole less what it leaves out."""
    out = len(s) - t
    one = mix(s)
    left = np.array([one.sum(dtype=np.uint64)])
    last = np.array([-1])
    for _ in range(out):       # leave out one more element, in ascending position
        pick = [np.arange(k + 1, len(s)) for k in last.tolist()]
        left = np.concatenate([v - one[p] for v, p in zip(left, pick)]) if pick else left
        last = np.concatenate(pick) if pick else last
    return mix(left + np.uint64(t) * np.uint64(0xD6E8FEB86659FD93))


def _signed(texts: DataFrame, kind: str, hot, boundary: int, rule: Rule) -> DataFrame:
    """``hot``: the broadcast frequent elements. (id, n, k1, k2, cells, first, subsets) of every text: size, key and histogram
    of its set, its first elements in the global order if a heavy set may need
    them, and its subset signatures if it is light."""
    plan, edge = light_overlaps(boundary, rule), rule.partner(boundary + 1)

    @tidy
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        x, count = hot.value
        for batch in batches:
            for i, sets in _sets(batch, rule):
                keys = [_set_key(s) for s in sets]
                first, subsets = [], []
                for s in sets:
                    n = len(s)
                    light = [_subset_signatures(s, t) for t in plan.get(n, ())]
                    subsets.append(np.concatenate(light).view(np.int64) if light else np.zeros(0, np.int64))
                    if n < max(1, edge):
                        first.append(np.zeros(0, np.int64))
                        continue
                    take = rule.prefix(n)
                    if len(x):
                        at = np.searchsorted(x, s)
                        at[at == len(x)] = 0
                        often = np.where(x[at] == s, count[at], 0)
                        s = s[np.argsort(often, kind="stable")]   # s is sorted, so ties stay in element order
                    first.append(s[:take].view(np.int64))
                yield pa.RecordBatch.from_arrays([
                    batch.column(0).slice(i, len(sets)), pa.array([len(s) for s in sets], pa.int64()),
                    pa.array([k for k, _ in keys], pa.int64()), pa.array([k for _, k in keys], pa.int64()),
                    pa.array([histogram(s) for s in sets], pa.binary()), pa.array(first, pa.list_(pa.int64())), pa.array(subsets, pa.list_(pa.int64()))],
                    ["id", "n", "k1", "k2", "cells", "first", "subsets"])

    return texts.mapInArrow(run, f"id {kind}, n long, k1 long, k2 long, cells binary, first array<long>, subsets array<long>")


def _can_link(rule: Rule, n: Column, i: Column, m: Column, j: Column) -> Column:
    """Sets of n and m elements are near enough in size, and with their first common
    element at i and j can still overlap enough (subset signatures have no place: -1)."""
    most = F.lit(1) + F.least(n - i - 1, m - j - 1)
    sizes = F.least(n, m) * rule.den >= F.greatest(n, m) * rule.num
    return sizes & ((i < 0) | (most * (rule.num + rule.den) >= (n + m) * rule.num))


def _verified(pairs: DataFrame, classes: DataFrame, texts: DataFrame, kind: str, rule: Rule) -> DataFrame:
    """The pairs (a, b) whose whole sets are linked. Pairs that sizes and histograms
    rule out go first; only texts of the rest are read again."""
    @tidy
    def bound(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            n, m = (batch.column(k).to_numpy() for k in (2, 3))
            most = most_overlap(batch.column(4).to_pylist(), batch.column(5).to_pylist(), np.minimum(n, m))
            yield pa.RecordBatch.from_arrays(list(batch.columns[:2]), ["a", "b"]).filter(
                pa.array(most * (rule.num + rule.den) >= (n + m) * rule.num))

    left = classes.select(F.col("rep").alias("a"), F.col("n"), F.col("cells").alias("x"))
    right = classes.select(F.col("rep").alias("b"), F.col("n").alias("m"), F.col("cells").alias("y"))
    near = staged(pairs.join(left, "a").join(right, "b").select("a", "b", "n", "m", "x", "y").mapInArrow(
        bound, f"a {kind}, b {kind}").distinct(), "jaccard-near")

    ids = near.select(F.col("a").alias("id")).union(near.select("b")).distinct()
    bucket = F.pmod(F.xxhash64("id"), F.lit(BUCKETS))
    # At most BUCKETS hashes are broadcast; they keep most other texts from being read.
    some = texts.join(F.broadcast(ids.select(bucket.alias("bucket")).distinct()), bucket == F.col("bucket"), "left_semi")

    @tidy
    def to_sets(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for i, sets in _sets(batch, rule):
                yield pa.RecordBatch.from_arrays(
                    [batch.column(0).slice(i, len(sets)), pa.array([s.tobytes() for s in sets], pa.binary())], ["id", "s"])

    @tidy
    def compare(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            ok = []
            for x, y in zip(batch.column(2), batch.column(3)):
                x, y = np.frombuffer(x.as_buffer(), np.uint64), np.frombuffer(y.as_buffer(), np.uint64)
                o = len(x) + len(y) - len(np.union1d(x, y))
                ok.append(o * rule.den >= (len(x) + len(y) - o) * rule.num)
            yield pa.RecordBatch.from_arrays(list(batch.columns[:2]), ["a", "b"]).filter(pa.array(ok, pa.bool_()))

    sets = some.mapInArrow(to_sets, f"id {kind}, s binary")
    left = sets.select(F.col("id").alias("a"), F.col("s").alias("x"))
    right = sets.select(F.col("id").alias("b"), F.col("s").alias("y"))
    return staged(near.join(left, "a").join(right, "b").select("a", "b", "x", "y").mapInArrow(
        compare, f"a {kind}, b {kind}").distinct(), "jaccard-links")


def jaccard_groups(docs: DataFrame, rule: Rule = Rule(), id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per input row: ``id_col``, n_shingles (size of its set) and
    component_id (the least id reachable by links, itself included).

    Words are runs other than space and 0x09-0x0D, A-Z in lower case. Two
    documents link as ``rule`` says (by default five words, 0.8 or more). Null
    texts and texts without words have empty sets and link with nothing.
    Ids are meant to be unique: of rows with the same id and different texts, those
    that stand for their texts count as one document. A row with a null id makes no
    links and has the component of its equal texts, if any, else null."""
    return _grouped(docs, rule, id_col, text_col).select(
        F.col("id").alias(id_col), F.col("n").alias("n_shingles"), F.col("component").alias("component_id"))


def _grouped(docs: DataFrame, rule: Rule, id_col: str, text_col: str) -> DataFrame:
    """(id, n, k1, k2, component) of every row: its id, the size and key of its set, its component."""
    texts = small_batches(docs).select(F.col(id_col).alias("id"), F.col(text_col).alias("text"))
    kind = texts.schema["id"].dataType.simpleString()
    hot = docs.sparkSession.sparkContext.broadcast(frequent_elements(texts, rule))     # at most HOT_MAX elements
    boundary = choose_boundary(_small_sizes(texts, rule), rule)
    signed = staged(_signed(texts, kind, hot, boundary, rule), "jaccard-signed")
    hot.destroy()

    classes = staged(signed.filter("n > 0 and id is not null").groupBy("k1", "k2", "n").agg(
        F.min("id").alias("rep"), *(F.first(c).alias(c) for c in ("cells", "first", "subsets"))), "jaccard-classes")
    # An entry is a place in an inverted list; subset signatures have no position (-1).
    entries = classes.select("rep", "n", F.posexplode("first").alias("pos", "sig")).union(
        classes.select("rep", "n", F.lit(-1).alias("pos"), F.explode("subsets").alias("sig")))
    heads = staged(entries.groupBy("sig").agg(
        F.count(F.lit(1)).alias("size"), F.min("rep").alias("leader")).filter("size > 1").drop("size"), "jaccard-heads")
    lists = staged(entries.join(heads, "sig").select("sig", "rep", "n", "pos", "leader"), "jaccard-lists")

    leaders = lists.filter("rep = leader").select("sig", F.col("n").alias("m"), F.col("pos").alias("j"))
    led = lists.filter("rep <> leader").join(leaders, "sig").filter(
        _can_link(rule, F.col("n"), F.col("pos"), F.col("m"), F.col("j"))).select(
        F.col("rep").alias("a"), F.col("leader").alias("b")).distinct()
    links = _verified(led, classes, texts, kind, rule)

    # Whatever is one component already needs no more comparing.
    joined = components(links)
    member = staged(lists.join(joined, F.col("rep") == F.col("id"), "left").select(
        "sig", "rep", "n", "pos", F.coalesce("component", "rep").alias("component")), "jaccard-members")
    mixed = member.groupBy("sig").agg(F.min("component").alias("lo"), F.max("component").alias("hi")).filter(
        "lo <> hi").select("sig")
    # Sizes of linked sets differ by little: lists are cut by size steps, and a member meets its own step and the next.
    step = F.floor(F.log(F.col("n").cast("double")) / F.log(F.lit(rule.den / rule.num))).cast("int")
    open_lists = staged(member.join(mixed, "sig", "left_semi").withColumn("step", step), "jaccard-open")
    x = open_lists.withColumn("at", F.explode(F.array(F.col("step"), F.col("step") + 1))).alias("x")
    y = open_lists.withColumn("at", F.col("step")).alias("y")
    same = (F.col("x.sig") == F.col("y.sig")) & (F.col("x.at") == F.col("y.at"))
    once = (F.col("x.step") < F.col("y.step")) | (F.col("x.rep") < F.col("y.rep"))
    across = x.join(y, same & once & (F.col("x.component") != F.col("y.component")) & _can_link(
        rule, F.col("x.n"), F.col("x.pos"), F.col("y.n"), F.col("y.pos"))).select(
        F.col("x.rep").alias("a"), F.col("y.rep").alias("b")).distinct()
    more = _verified(across, classes, texts, kind, rule)

    final = components(links.union(more))
    named = staged(classes.select("k1", "k2", "n", "rep").join(final, F.col("rep") == F.col("id"), "left").select(
        "k1", "k2", "n", F.coalesce("component", "rep").alias("component")), "jaccard-named")
    return signed.select("id", "n", "k1", "k2").join(named, ["k1", "k2", "n"], "left").select(
        "id", "n", "k1", "k2", F.when(F.col("n") == 0, F.col("id")).otherwise(F.col("component")).alias("component"))


def keep_one(docs: DataFrame, rule: Rule = Rule(), id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``docs`` with one document of each group left: the one with the least id.

    A row is judged by its own text: of rows with the same id and the same shingle
    set one stays, if that set's group has this id as its least; rows with the id and other
    texts are judged by theirs. Rows with a null id all stay. Documents without words
    stay, once per id. Columns may have any names."""
    groups = staged(_grouped(docs, rule, id_col, text_col).filter("id is not null"), "jaccard-groups")
    often = groups.groupBy("id").count().filter("count > 1").select("id", F.lit(True).alias("often"))
    drop = groups.filter("id <> component").select("id", F.lit(False).alias("often"))
    touched = staged(often.union(drop).groupBy("id").agg(F.max("often").alias("often")), "jaccard-touched")
    # A (broadcast) table of at most BUCKETS id hashes lets most rows pass without a shuffle.
    bucket = F.pmod(F.xxhash64("id"), F.lit(BUCKETS))
    hashes = F.broadcast(touched.select(bucket.alias("bucket")).distinct())
    rows = docs.select(F.struct(*(F.col(f"`{c}`") for c in docs.columns)).alias("row"), F.col(f"`{id_col}`").alias("id"))
    passed = rows.join(hashes, bucket == F.col("bucket"), "left_anti").select("row.*")
    looked = rows.join(hashes, bucket == F.col("bucket"), "left_semi").join(touched, "id", "left")
    rest = looked.filter("often is null").select("row.*")
    return passed.unionByName(rest).unionByName(_one_of_each(looked.filter("often"), groups, docs, rule, text_col))


def _one_of_each(repeated: DataFrame, groups: DataFrame, docs: DataFrame, rule: Rule, text_col: str) -> DataFrame:
    """Of rows (id, row) whose ids come several times: one of each id and set that stays."""
    kind = repeated.schema["id"].dataType.simpleString()
    sent = repeated.select("id", F.col(f"row.`{text_col}`").alias("text"), "row")

    @tidy
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for i, sets in _sets(batch, rule):
                keys = [_set_key(s) for s in sets]
                yield pa.RecordBatch.from_arrays([
                    batch.column(0).slice(i, len(sets)), pa.array([len(s) for s in sets], pa.int64()),
                    pa.array([k for k, _ in keys], pa.int64()), pa.array([k for _, k in keys], pa.int64()),
                    batch.column(2).slice(i, len(sets))], ["id", "n", "k1", "k2", "row"])

    keyed = sent.mapInArrow(run, f"id {kind}, n long, k1 long, k2 long, row {sent.schema['row'].dataType.simpleString()}")
    stay = groups.filter("id = component").select("id", "n", "k1", "k2").distinct()
    return keyed.dropDuplicates(["id", "n", "k1", "k2"]).join(stay, ["id", "n", "k1", "k2"], "left_semi").select("row.*")


def _small_sizes(texts: DataFrame, rule: Rule) -> dict[int, int]:
    """How many texts have each small set size (a bounded list of numbers).

    Counted as shingles, which is a set's size unless they repeat."""
    words = F.size(F.split(F.trim(F.translate(F.col("text"), "\t\n\x0b\x0c\r", "     ")), " +"))
    size = F.greatest(F.lit(1), words - (rule.words - 1)).alias("n")
    small = texts.filter(F.octet_length("text").between(1, LIGHT_MOST * 64)).select(size).filter(
        F.col("n") <= LIGHT_MOST * rule.den // rule.num + 1)
    return {r["n"]: r["count"] for r in small.groupBy("n").count().collect()}
