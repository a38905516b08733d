"""Minimax contiguous partition of documents into shards (DataFrame functions only).

Equal texts form one atomic group. Groups stand in the order of their smallest
``doc_id``, after those (fewer than shards) that are larger than an equal share. The capacity of a shard is the smallest one for which the greedy
check (fill a shard until the next group would not fit) needs at most
``n_shards`` shards; it is found by binary search. The cuts are then laid within
that capacity, each as near as possible to an equal share of what is left.

No task and no driver step sees all groups. Running sums of the group sizes are
made in two levels (ranges, then inside a range). The driver holds a bounded
table of exact running sums at some cut points: at first about
``SEGMENTS`` of them, each segment between them holding unread cut points.
The greedy check is run on that table twice, pretending that unread segments
have no inner cut (an upper bound of the capacity) and that they can be cut
anywhere (a lower bound). Only segments in which a cut can fall are read, in
finer pieces, until no check touches an unread one: the result is exact.
"""

from __future__ import annotations

from bisect import bisect_right

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from quire.llm.common import staged

SEGMENTS = 4096       # pieces per refinement
READ_ROWS = 50_000    # segments holding at most this many groups together are read group by group


class _Cuts:
    """Known running sums (sorted) and, for each, whether the segment that ends
    there has inner cut points that are not known yet."""

    def __init__(self, points: list[tuple[int, int]]):
        # (running sum at the segment's last group, groups in the segment)
        self.ends = [0] + [e for e, _ in points]
        self.unread = [False] + [n > 1 for _, n in points]
        self.count = [0] + [n for _, n in points]

    def last_at(self, x: int) -> tuple[int, int | None]:
        """The largest known cut <= x, and the unread segment that holds x, if any."""
        i = bisect_right(self.ends, x) - 1
        j = i + 1 if i + 1 < len(self.ends) and self.unread[i + 1] and x > self.ends[i] else None
        return self.ends[i], j

    def refine(self, pieces: list[tuple[int, int]], which: set[int]) -> _Cuts:
        kept = [(e, n) for k, (e, n) in enumerate(zip(self.ends, self.count)) if k and k not in which]
        return _Cuts(sorted(kept + pieces))


def _feasible(cuts: _Cuts, capacity: int, shards: int, optimistic: bool) -> bool:
    at, total = 0, cuts.ends[-1]
    for _ in range(shards):
        x = at + capacity
        if x >= total:
            return True
        low, seg = cuts.last_at(x)
        at = x if optimistic and seg is not None else low
    return False


def _smallest(cuts: _Cuts, shards: int, least: int, optimistic: bool) -> int:
    lo, hi = least, cuts.ends[-1]
    while lo < hi:
        mid = (lo + hi) // 2
        if _feasible(cuts, mid, shards, optimistic):
            hi = mid
        else:
            lo = mid + 1
    return lo


def _windows(cuts: _Cuts, lo: int, hi: int, shards: int) -> set[int]:
    """Unread segments in which a cut of the greedy check can fall for any
    capacity from lo to hi."""
    a = b = 0
    touched: set[int] = set()
    total = cuts.ends[-1]
    for _ in range(shards):
        low, _ = cuts.last_at(a + lo)
        x = min(b + hi, total)
        top, seg = cuts.last_at(x)
        i, j = bisect_right(cuts.ends, a + lo) - 1, bisect_right(cuts.ends, x) - 1
        touched |= {k for k in range(i, min(j + 2, len(cuts.ends))) if cuts.unread[k] and cuts.ends[k - 1] < x}
        a, b = low, (x if seg is not None else top)
        if a >= total:
            break
    return touched


def _lay(cuts: _Cuts, capacity: int, shards: int) -> tuple[list[int], set[int]]:
    """Cut points within ``capacity``, each as near to an equal share of the rest
    as it can be while the rest still fits; and unread segments that mattered."""
    total, touched = cuts.ends[-1], set()

    def first_at(x: int) -> int:
        """The smallest known cut >= x."""
        i = bisect_right(cuts.ends, x) - 1
        if cuts.ends[i] >= x:
            return cuts.ends[i]
        if cuts.unread[i + 1]:
            touched.add(i + 1)
        return cuts.ends[i + 1]

    needed = [total]   # needed[k]: the earliest cut from which k shards hold the rest
    for _ in range(shards):
        needed.append(first_at(max(0, needed[-1] - capacity)))
    at, out = 0, []
    for k in range(shards - 1, 0, -1):
        share = at + (total - at) / (k + 1)
        most, seg = cuts.last_at(at + capacity)
        if seg is not None and share >= cuts.ends[seg - 1]:
            touched.add(seg)
        below, seg = cuts.last_at(int(share))
        if seg is not None:
            touched.add(seg)
        above = first_at(int(share) + 1) if share < total else total
        best = below if at < below and share - below <= above - share else above
        at = max(at, min(max(best, needed[k]), most))
        out.append(at)
    return out, touched


def shard_documents(docs: DataFrame, n_shards: int = 8, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Contiguous shards of near-equal bytes; equal texts stay together.

    Returns ``id_col``, size (UTF-8 bytes of the text plus 1), text_crc32, law
    (``bytes``), shard (0 to n_shards - 1), slot (gapless from 0 in its shard,
    by group, then id) and grown_shard (null: this law is not keyed).

    Null texts count as empty ones (size 1) and are one group with them. A null
    id sorts first. Repeated rows are rows of their own. An empty table gives an
    empty result; shards may stay empty if there are fewer groups than shards.
    A group larger than an equal share has a shard of its own, as far as that keeps the
    capacity smallest, and the others share the rest.
    """
    text = F.coalesce(F.col(text_col), F.lit(""))
    rows = staged(docs.select(
        F.col(id_col).alias("id"),
        (F.octet_length(text) + F.lit(1)).cast("long").alias("size"),
        F.crc32(text.cast("binary")).alias("crc"),
        F.unhex(F.md5(text.cast("binary"))).alias("grp")), "shard-rows")
    total = rows.agg(F.sum("size")).first()[0] or 0
    groups = rows.groupBy("grp").agg(
        F.min(F.struct(F.col("id").isNotNull().alias("has"), "id", "grp")).alias("first"),
        F.sum("size").alias("bytes")).withColumn("first", F.struct(
            (F.col("bytes") * n_shards <= F.lit(total)).alias("usual"), "first.has", "first.id", "first.grp"))
    # Ranges of groups in order, and their running sums: range totals first, then inside a range.
    ranged = staged(groups.repartitionByRange("first").withColumn("range", F.spark_partition_id()), "shard-groups")
    per_range = ranged.groupBy("range").agg(F.sum("bytes").alias("sum"))
    before = per_range.withColumn("base", F.sum("sum").over(
        Window.orderBy("range").rowsBetween(Window.unboundedPreceding, -1))).select(
        "range", F.coalesce("base", F.lit(0)).alias("base"))
    inside = Window.partitionBy("range").orderBy("first").rowsBetween(Window.unboundedPreceding, 0)
    sums = staged(ranged.join(F.broadcast(before), "range").select(
        "first", "bytes", (F.col("base") + F.sum("bytes").over(inside)).alias("upto")), "shard-sums")

    bounds = _bounds(sums, n_shards)
    shard = F.lit(0)
    for b in bounds:   # at most n_shards - 1 boundary groups
        last = F.struct(F.lit(b["usual"]).alias("usual"), F.lit(b["has"]).alias("has"),
                        F.lit(b["id"]).cast(rows.schema["id"].dataType).alias("id"), F.lit(b["grp"]).alias("grp"))
        shard = shard + F.when(F.col("first") > last, 1).otherwise(0)
    named = rows.join(sums.select("first.grp", "first"), "grp").select(
        "id", "size", "crc", "first", shard.cast("int").alias("shard"))
    return _slots(named).select(
        F.col("id").alias(id_col), "size", F.col("crc").alias("text_crc32"), F.lit("bytes").alias("law"),
        "shard", "slot", F.lit(None).cast("int").alias("grown_shard"))


def _bounds(sums: DataFrame, n_shards: int) -> list:
    """The last group of each shard but the last (rows of at most n_shards - 1 groups)."""
    whole = sums.agg(F.max("upto").alias("total"), F.max("bytes").alias("largest")).first()
    total = whole["total"]
    if not total:
        return []

    def pieces(stretches: list[tuple[int, int]], width: int) -> list[tuple[int, int]]:
        """(last running sum, groups) of pieces of about ``width`` bytes inside the stretches."""
        inside, stretch = F.lit(False), F.lit(0)
        for a, b in stretches:
            inside = inside | ((F.col("upto") > a) & (F.col("upto") <= b))
            stretch = stretch + (F.col("upto") > a).cast("int")
        found = sums.filter(inside).groupBy(
            stretch.alias("stretch"), F.floor((F.col("upto") - 1) / F.lit(width)).alias("piece")).agg(
            F.max("upto").alias("end"), F.count(F.lit(1)).alias("n"))
        return [(r["end"], r["n"]) for r in found.select("end", "n").collect()]

    cuts = _Cuts(sorted(pieces([(0, total)], max(1, -(-total // SEGMENTS)))))
    least = max(whole["largest"], -(-total // n_shards))
    while True:
        lo = _smallest(cuts, n_shards, least, True)
        hi = _smallest(cuts, n_shards, least, False)
        which = _windows(cuts, lo, hi, n_shards) if lo < hi else set()
        if not which:
            marks, which = _lay(cuts, hi, n_shards)
            if not which:
                break
        stretches: list[tuple[int, int]] = []
        for k in sorted(which):
            a, b = cuts.ends[k - 1], cuts.ends[k]
            if stretches and stretches[-1][1] == a:
                stretches[-1] = (stretches[-1][0], b)
            else:
                stretches.append((a, b))
        few = sum(cuts.count[k] for k in which) <= READ_ROWS
        reach, least_span = sum(b - a for a, b in stretches), min(cuts.ends[k] - cuts.ends[k - 1] for k in which)
        width = 1 if few else max(1, min(reach // SEGMENTS, least_span // 2))   # each read segment gets finer
        cuts = cuts.refine(pieces(stretches, width), which)
    marks = sorted({m for m in marks if 0 < m < total})
    found = sums.filter(F.col("upto").isin(marks)).select("upto", "first.*").collect() if marks else []
    return sorted(found, key=lambda r: r["upto"])


def _slots(named: DataFrame) -> DataFrame:
    """Gapless numbers from 0 in each shard, by (first, id): counts per range of
    rows, their running sums, then a number inside the range."""
    order = [F.col("first"), F.col("id").asc_nulls_first()]
    ranged = staged(named.repartitionByRange("first", F.col("id").asc_nulls_first())
                    .withColumn("range", F.spark_partition_id()), "shard-slots")
    per = ranged.groupBy("shard", "range").agg(F.count(F.lit(1)).alias("n"))
    base = per.withColumn("base", F.sum("n").over(
        Window.partitionBy("shard").orderBy("range").rowsBetween(Window.unboundedPreceding, -1))).select(
        "shard", "range", F.coalesce("base", F.lit(0)).alias("base"))
    number = F.row_number().over(Window.partitionBy("range", "shard").orderBy(*order)) - F.lit(1)
    return ranged.withColumn("nth", number).join(F.broadcast(base), ["shard", "range"]).withColumn(
        "slot", (F.col("base") + F.col("nth")).cast("long"))
