import random
import re

import numpy as np
import pandas as pd
from pyspark.sql import types as T

from quire.llm.quality_rules import STATS, anomaly, calibrate, features, fit, fit_forest, node_counts, quality_rules

SCHEMA = T.StructType([T.StructField("doc_id", T.LongType()), T.StructField("text", T.StringType()),
                       T.StructField("n_words", T.StringType()), T.StructField("quality", T.StringType())])
SPACE = "\x20\t\n\x0b\x0c\r"


def brute(text):
    text = text or ""
    words = re.findall(r"[^\x20\x09-\x0D]+", text)
    lines = [x for x in text.split("\n") if x.strip(SPACE)]
    windows = {}
    for i in range(len(words) - 7):
        windows.setdefault(tuple(words[i:i + 8]), []).append(i)
    covered = {j for at in windows.values() if len(at) > 1 for i in at for j in range(i, i + 8)}
    failed = len(words) < 20 or 100 * len(covered) > 30 * len(words)
    return (len(words), sum(map(len, words)), len(re.findall(r"[#*$%&|<>]", text)), len(lines) - len(set(lines)), len(covered), failed)


def texts():
    rng = random.Random(4)
    vocabulary = ["river", "été", "x", "a|b", "#1", "日本", "go\x0bon", "nb sp"]
    out = [None, "", " \n\t", "one", "same line\nsame line\n \nsame line", "w " * 60_000, "é" * 40, "\x1cword\x85 x"]
    for _ in range(150):
        part = [rng.choice(vocabulary) for _ in range(rng.randint(1, 60))]
        if rng.random() < 0.4:
            part += part[:rng.randint(0, len(part))]
        out.append("".join(w + rng.choice([" ", " ", "\n", "\t", "\r\n"]) for w in part))
    return out


def test_counts_against_brute_force(spark):
    rows = list(enumerate(texts())) + [(None, "no id"), (3, "one"), (3, "one")]
    docs = spark.createDataFrame([(i, t, "", "") for i, t in rows], SCHEMA)
    labels = spark.createDataFrame([], "doc_id long, quality int")
    out = quality_rules(docs.select("doc_id", "text", "n_words"), labels).collect()
    names = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed")
    key = lambda r: str(r)
    assert sorted(((r["doc_id"], *(r[n] for n in names)) for r in out), key=key) == sorted(((i, *brute(t)) for i, t in rows), key=key)
    assert all(r["kept"] == (not r["base_failed"]) and r["anomaly"] is None for r in out)    # nothing to calibrate on
    assert quality_rules(docs.limit(0), labels).count() == 0


def test_forest_sets_junk_apart(spark):
    rng, rows, labels = random.Random(5), [], []
    for i in range(400):
        words = ["".join(rng.choice("abcdefgh") for _ in range(rng.randint(2, 8))) for _ in range(60)]
        if i % 10 == 0:
            words = [w + rng.choice(["###", "|", "$$$"]) for w in words]
        rows.append((i, " ".join(words) + ".", "", ""))
        if i % 4 == 0:
            labels.append((i, int(i % 10 != 0)))
    out = {r["doc_id"]: r["kept"] for r in quality_rules(
        spark.createDataFrame(rows, SCHEMA).select("doc_id", "text"), spark.createDataFrame(labels, "doc_id long, quality int")).collect()}
    junk = [i for i in out if i % 10 == 0]
    assert np.mean([not out[i] for i in junk]) > 0.9 and np.mean([out[i] for i in out if i % 10]) > 0.97


def test_paths_and_calibration():
    rng = np.random.default_rng(1)
    x = rng.normal(0, 1, (500, 3))
    forest = fit_forest(x, np.vstack([x, [[9, 9, 9]]]))
    assert anomaly(forest, np.array([[8.0, 8, 8]]))[0] > np.quantile(anomaly(forest, x), 0.99)
    assert fit_forest(x[:1], x) is None
    assert calibrate(np.array([0.1, 0.2, 0.9]), np.array([True, True, False])) == 0.9
    assert calibrate(np.array([0.1]), np.array([True])) == np.inf


def test_every_labelled_row_counts(spark):
    """The forest and the threshold are those of all labelled rows, however many tasks read them."""
    rng = np.random.default_rng(2)
    n = 25_000
    rows = np.column_stack([rng.integers(20, 90, n), rng.integers(100, 500, n), rng.integers(0, 3, n), rng.integers(0, 2, n),
                            rng.integers(0, 5, n), rng.integers(2, 9, n), rng.integers(0, 40, n), rng.integers(0, 9, n)])
    y = (rng.random(n) < 0.9).astype(int)
    rows[y == 0, 2] += 40
    part = pd.DataFrame(rows, columns=STATS)
    forest, threshold = fit(spark.createDataFrame(part.assign(__y=y)).repartition(3))
    x = features(part)
    whole = fit_forest(x[y == 1], x)
    assert all((forest[k] == whole[k]).all() for k in ("feature", "cut", "norm"))
    assert np.array_equal(forest["length"], whole["length"], equal_nan=True)
    assert threshold == calibrate(anomaly(whole, x), y == 1) < 1
    root = node_counts(whole, x[y == 1])[:, 0]
    assert (root == (y == 1).sum()).all()
