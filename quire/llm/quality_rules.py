"""Quality rules with an isolation forest over rule statistics.

Word, symbol and repetition counts of whole texts feed fixed base rules. What
passes them is judged by an isolation forest: random splits over ratios of the
statistics; documents that few splits set apart have short paths and are
anomalous. The score above which a document goes is calibrated on labelled rows.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from quire.llm.common import small_batches, staged, text_slices, word_hashes

# Fixed values of the base rules.
MIN_WORDS, MAX_REPEAT_PERCENT, WINDOW = 20, 30, 8
SYMBOLS = b"#*$%&|<>"

STATS = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "n_lines", "n_upper", "n_marks")
TREES, DEPTH = 100, 8
SCORE_STEPS = 1 << 16                   # scores have so many steps, so that all labelled rows' scores can be counted
CLEAN_LOSS = 0.01                       # most clean labelled rows that calibration may give up

_IS_SYMBOL = np.zeros(256, dtype=bool)
_IS_SYMBOL[list(SYMBOLS)] = True
_IS_UPPER = np.zeros(256, dtype=bool)
_IS_UPPER[65:91] = True
_IS_MARK = np.zeros(256, dtype=bool)    # ASCII punctuation that is no symbol
_IS_MARK[[c for c in range(33, 127) if not chr(c).isalnum() and c not in SYMBOLS]] = True
_MIX = np.array([pow(0x9E3779B97F4A7C15, k, 1 << 64) for k in range(WINDOW)], dtype=np.uint64)


def repeated_words(hashes: np.ndarray) -> int:
    """Words that lie in an 8-word window found twice or more (the first included)."""
    n = len(hashes) - WINDOW + 1
    if n < 2:
        return 0
    g = np.zeros(n, dtype=np.uint64)
    for k in range(WINDOW):
        g += hashes[k:k + n] * _MIX[k]
    s = np.sort(g)
    twice = s[1:][s[1:] == s[:-1]]
    if not len(twice):
        return 0
    at = np.searchsorted(twice, g)
    at[at == len(twice)] = 0
    edge = np.zeros(len(hashes) + 1, dtype=np.int64)
    found = np.flatnonzero(twice[at] == g)
    np.add.at(edge, found, 1)
    np.add.at(edge, found + WINDOW, -1)
    return int(np.count_nonzero(np.cumsum(edge)[:-1]))


def _count(mask: np.ndarray, offsets: np.ndarray) -> np.ndarray:
    total = np.zeros(len(mask) + 1, dtype=np.int64)
    np.cumsum(mask, out=total[1:])
    return total[offsets[1:]] - total[offsets[:-1]]


def _space_free(buf: np.ndarray) -> np.ndarray:
    return (buf != 0x20) & ((buf < 0x09) | (buf > 0x0D))


def slice_stats(buf: np.ndarray, offsets: np.ndarray) -> dict[str, np.ndarray]:
    """The statistics of all texts of one slice."""
    words, bounds = word_hashes(buf, offsets)
    lines, dups, repeats = [], [], []
    for k in range(len(offsets) - 1):
        full = [x for x in buf[offsets[k]:offsets[k + 1]].tobytes().split(b"\n") if x.strip(b" \t\n\r\x0b\x0c")]
        lines.append(len(full))
        dups.append(len(full) - len(set(full)))
        repeats.append(repeated_words(words[bounds[k]:bounds[k + 1]]))
    return {
        "n_words": np.diff(bounds).astype(np.int64),
        "word_chars": _count(_space_free(buf) & ((buf & 0xC0) != 0x80), offsets),
        "n_symbols": _count(_IS_SYMBOL[buf], offsets), "n_dup_lines": np.array(dups, np.int64),
        "n_repeat_words": np.array(repeats, np.int64), "n_lines": np.array(lines, np.int64),
        "n_upper": _count(_IS_UPPER[buf], offsets), "n_marks": _count(_IS_MARK[buf], offsets),
    }


def rule_stats(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``id_col`` and STATS (long) of every whole text; a null text has none of anything."""
    kind = docs.schema[id_col].dataType

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for i, j, buf, offsets in text_slices(batch):
                stats = slice_stats(buf, offsets)
                yield pa.RecordBatch.from_arrays(
                    [batch.column(0).slice(i, j - i), *(pa.array(stats[s]) for s in STATS)], ["id", *STATS])

    made = small_batches(docs).select(F.col(id_col).alias("id"), F.col(text_col).alias("text")).mapInArrow(
        run, f"id {kind.simpleString()}, " + ", ".join(f"{s} long" for s in STATS))
    return made.withColumnRenamed("id", id_col)


def features(stats: pd.DataFrame) -> np.ndarray:
    """Logarithms of ratios that do not depend on a text's length."""
    chars, words = np.maximum(stats["word_chars"], 1), np.maximum(stats["n_words"], 1)
    return np.log1p(1000 * np.column_stack([
        stats["n_symbols"] / chars, stats["n_marks"] / chars, stats["n_upper"] / chars,
        stats["n_dup_lines"] / np.maximum(stats["n_lines"], 1), stats["n_repeat_words"] / words, chars / words,
    ]).astype(np.float64))


def _usual_path(n: float) -> float:
    """Mean path length of an unsuccessful search in a binary tree of n rows."""
    return 0.0 if n <= 1 else 1.0 if n == 2 else 2 * (np.log(n - 1) + 0.5772156649) - 2 * (n - 1) / n


def random_trees(low: np.ndarray, high: np.ndarray, seed: int = 0) -> dict[str, np.ndarray]:
    """TREES random trees over the box from ``low`` to ``high`` as heap-shaped arrays
    (children of node i at 2i+1 and 2i+2). Every cut is drawn at random from its
    node's own box; no row is looked at. A box without width is not cut."""
    rng, nodes = np.random.default_rng(seed), 2 ** (DEPTH + 1) - 1
    feature, cut = np.zeros((TREES, nodes), np.int8), np.full((TREES, nodes), np.inf)
    for t in range(TREES):
        boxes = {0: (low, high)}
        for node in range(2 ** DEPTH - 1):
            lo, hi = boxes.pop(node)
            wide = np.flatnonzero(hi > lo)
            left, right = hi, lo
            if len(wide):
                f = int(rng.choice(wide))
                c = rng.uniform(lo[f], hi[f])
                feature[t, node], cut[t, node] = f, c
                edge = np.arange(len(lo)) == f
                left, right = np.where(edge, c, hi), np.where(edge, c, lo)
            boxes[2 * node + 1], boxes[2 * node + 2] = (lo, left), (right, hi)
    return {"feature": feature, "cut": cut}


def _walk(trees: dict[str, np.ndarray], x: np.ndarray, t: int) -> Iterator[np.ndarray]:
    """The nodes of tree ``t`` that the rows of ``x`` pass, level by level from the root."""
    node, rows = np.zeros(len(x), dtype=np.int64), np.arange(len(x))
    yield node
    for _ in range(DEPTH):
        node = 2 * node + 1 + (x[rows, trees["feature"][t, node]] > trees["cut"][t, node])
        yield node


def node_counts(trees: dict[str, np.ndarray], x: np.ndarray) -> np.ndarray:
    """How many rows of ``x`` pass each node of each tree."""
    count = np.zeros(trees["cut"].shape, np.int64)
    for t in range(len(count)):
        for node in _walk(trees, x, t):
            count[t] += np.bincount(node, minlength=count.shape[1])
    return count


def grown(trees: dict[str, np.ndarray], count: np.ndarray) -> dict[str, np.ndarray] | None:
    """The forest of ``trees`` whose nodes ``count`` rows pass: a path ends at the first
    node with at most one row, or at the last level, where the rows left count as a tree
    of their own. None for fewer than two rows."""
    total = int(count[0, 0])
    if total < 2:
        return None
    length = np.zeros(count.shape)
    level = np.floor(np.log2(np.arange(1, count.shape[1] + 1)))
    usual = {int(n): _usual_path(int(n)) for n in np.unique(count)}
    for node in range(count.shape[1]):
        up = (node - 1) // 2
        own = level[node] + np.array([usual[int(n)] for n in count[:, node]])
        uncut = np.isinf(trees["cut"][:, node])
        # Below an end all answer as it does.
        over = (count[:, up] <= 1) | np.isinf(trees["cut"][:, up]) if node else np.zeros(len(count), bool)
        length[:, node] = np.where(over, length[:, up], np.where((count[:, node] <= 1) | uncut, own, np.nan))
    return {**trees, "length": length, "norm": np.array(max(_usual_path(total), 1e-9))}


def fit_forest(x: np.ndarray, reach: np.ndarray, seed: int = 0) -> dict[str, np.ndarray] | None:
    """A forest that counts all rows of ``x``.

    A cut is drawn at random from the node's whole box, which starts as the range
    of ``reach``: where ``x`` has no rows, a box is soon empty and its paths are short."""
    if len(x) < 2:
        return None
    trees = random_trees(reach.min(axis=0), reach.max(axis=0), seed)
    return grown(trees, node_counts(trees, x))


def anomaly(forest: dict[str, np.ndarray], x: np.ndarray) -> np.ndarray:
    """Scores between 0 and 1, in steps of 1 / SCORE_STEPS; shorter paths score higher."""
    total = np.zeros(len(x))
    for t in range(len(forest["cut"])):
        *_, leaf = _walk(forest, x, t)
        total += forest["length"][t, leaf]
    return np.round(SCORE_STEPS * 2.0 ** (-total / len(forest["cut"]) / forest["norm"])) / SCORE_STEPS


def calibrate(scores: np.ndarray, good: np.ndarray, count: np.ndarray | None = None) -> float:
    """The score from which a document is rejected: the largest gain of rejected
    bad rows over rejected good rows, giving up at most CLEAN_LOSS of the good.
    ``count``: how many rows have each score and kind (one, if not given)."""
    count = np.ones(len(scores), np.int64) if count is None else count
    steps, at = np.unique(scores, return_inverse=True)
    hit = [np.bincount(at[kind], count[kind], len(steps))[::-1].cumsum()[::-1] for kind in (good, ~good)]
    if not len(steps) or not hit[0][0] or not hit[1][0]:
        return np.inf
    good_hit, bad_hit = hit[0] / hit[0][0], hit[1] / hit[1][0]
    gain = np.where(good_hit <= CLEAN_LOSS, bad_hit - good_hit, 0.0)
    return float(steps[gain.argmax()]) if gain.max() > 0 else np.inf


def fit(labelled: DataFrame) -> tuple[dict[str, np.ndarray] | None, float]:
    """The forest and the score from which a document is rejected, from all rows
    ``__y`` and STATS. It grows on the clean rows (on all, if none is clean) within the
    range of all. Only ranges, counts of nodes and counts of scores reach the driver."""
    n = len(features(pd.DataFrame({s: np.zeros(1) for s in STATS}))[0])
    names = [f"f{k}" for k in range(n)]

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[np.ndarray, np.ndarray]]:
        for batch in batches:
            if batch.num_rows:
                part = batch.to_pandas()
                yield part["__y"].to_numpy() == 1, features(part)

    def ranges(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for good, x in read(batches):
            for kind in (True, False):
                if (good == kind).any():
                    rows = x[good == kind]
                    yield pa.RecordBatch.from_arrays(
                        [pa.array([kind]), pa.array([len(rows)]), *(pa.array([float(v)]) for v in (*rows.min(axis=0), *rows.max(axis=0)))],
                        ["good", "n", *(f"low_{c}" for c in names), *(f"high_{c}" for c in names)])

    bounds = labelled.mapInArrow(ranges, "good boolean, n long, " + ", ".join(
        f"{side}_{c} double" for side in ("low", "high") for c in names)).agg(
        F.coalesce(F.max("good"), F.lit(False)).alias("clean"), F.count(F.lit(1)).alias("n"),
        *(F.min(f"low_{c}").alias(f"low_{c}") for c in names), *(F.max(f"high_{c}").alias(f"high_{c}") for c in names)).first()
    if not bounds["n"]:
        return None, np.inf
    clean = bounds["clean"]
    trees = random_trees(*(np.array([bounds[f"{side}_{c}"] for c in names]) for side in ("low", "high")))

    def passed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(trees["cut"].size, np.int64)
        for good, x in read(batches):
            total += node_counts(trees, x[good] if clean else x).ravel()
        at = np.flatnonzero(total)
        yield pa.RecordBatch.from_arrays([pa.array(at), pa.array(total[at])], ["node", "n"])

    count = np.zeros(trees["cut"].size, np.int64)
    for r in labelled.mapInArrow(passed, "node long, n long").groupBy("node").agg(F.sum("n").alias("n")).collect():
        count[r["node"]] = r["n"]           # at most one row per node of the trees
    forest = grown(trees, count.reshape(trees["cut"].shape))
    if forest is None:
        return None, np.inf

    def scored(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for good, x in read(batches):
            yield pa.RecordBatch.from_arrays([pa.array(anomaly(forest, x)), pa.array(good)], ["score", "good"])

    found = labelled.mapInArrow(scored, "score double, good boolean").groupBy("score", "good").count().toPandas()
    return forest, calibrate(*(found[c].to_numpy() for c in ("score", "good", "count")))     # at most 2 * SCORE_STEPS rows


def quality_rules(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text",
                  label_col: str = "quality") -> DataFrame:
    """``id_col``, STATS, base_failed, anomaly (null without a forest) and kept.

    base_failed: fewer than 20 words, or over 30 % of the words in repeated
    8-word windows. kept: not base_failed, and the forest's score below the
    calibrated one. The forest counts all clean labelled rows within the range of
    all labelled ones, and the threshold comes from all of both kinds.
    Null or empty texts fail the base rules; without labelled rows of both kinds
    nothing more is rejected. Repeated rows are judged each.
    """
    stats = staged(rule_stats(docs, id_col, text_col), "rule-stats")
    failed = (F.col("n_words") < MIN_WORDS) | (100 * F.col("n_repeat_words") > MAX_REPEAT_PERCENT * F.col("n_words"))
    stats = stats.withColumn("base_failed", failed)
    known = labels.select(F.col(id_col).alias("__id"), F.col(label_col).alias("__y")).filter("__y is not null")
    forest, threshold = fit(staged(stats.filter(~F.col("base_failed")).join(known, F.col(id_col) == F.col("__id")).select(
        "__y", *STATS), "rule-labelled"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if not batch.num_rows:
                continue
            part = batch.to_pandas()
            score = anomaly(forest, features(part)) if forest else np.full(len(part), np.nan)
            ok = ~part["base_failed"].to_numpy(dtype=bool) & ~(score >= threshold)
            yield pa.RecordBatch.from_arrays(
                [*batch.columns, pa.array(score, from_pandas=True), pa.array(ok)], [*batch.schema.names, "anomaly", "kept"])

    return stats.mapInArrow(run, ", ".join(f"`{n}` {t}" for n, t in stats.dtypes) + ", anomaly double, kept boolean")
