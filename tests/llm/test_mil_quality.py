import random

import numpy as np
from pyspark.sql import types as T

from quire.llm import mil_quality as M
from quire.llm.mil_quality import forward, passages, quality_scores

SCHEMA = T.StructType([T.StructField("doc_id", T.LongType()), T.StructField("text", T.StringType()),
                       T.StructField("quality", T.StringType()), T.StructField("score", T.StringType())])
LABELS = "doc_id long, quality int, toxic int"


def bag(text):
    raw = np.frombuffer(text.encode(), np.uint8)
    return passages(raw, np.array([0, len(raw)]))


def test_passages_of_a_slice_are_those_of_its_texts():
    texts = ["", "one two three one two three", "é" * 700, "x " * 900, "a\nb", ""]
    raw = [t.encode() for t in texts]
    x, bounds = passages(np.frombuffer(b"".join(raw), np.uint8), np.concatenate([[0], np.cumsum([len(r) for r in raw])]))
    for k, t in enumerate(texts):
        assert np.allclose(x[bounds[k]:bounds[k + 1]], bag(t)[0])
        assert bounds[k + 1] - bounds[k] == max(1, -(-len(raw[k]) // M.PASSAGE))


def test_gradient_by_differences():
    rng = np.random.default_rng(0)
    p = {"W": rng.normal(0, 0.3, (M.WIDTH, M.HIDDEN)), "V": rng.normal(0, 0.3, (M.HIDDEN, M.GATE)),
         "U": rng.normal(0, 0.3, (M.HIDDEN, M.GATE)), "w": rng.normal(0, 0.3, M.GATE), "c": rng.normal(0, 0.3, M.HIDDEN), "b": np.zeros(1)}
    x, bounds, y = rng.normal(0, 1, (7, M.WIDTH)), np.array([0, 3, 4, 7]), np.array([1.0, 0.0, 1.0])

    def loss():
        s = forward(p, x, bounds)["score"]
        return -np.mean(y * np.log(s) + (1 - y) * np.log(1 - s))
    grad = M._gradient(p, x, bounds, y)
    for name, at in (("W", (3, 2)), ("V", (1, 1)), ("U", (4, 0)), ("w", (5,)), ("c", (2,)), ("b", (0,))):
        h = 1e-5
        p[name][at] += h
        up = loss()
        p[name][at] -= 2 * h
        down = loss()
        p[name][at] += h
        assert abs(grad[name][at] - (up - down) / (2 * h)) < 1e-6


def corpus(n=400):
    rng, rows, labels = random.Random(7), [], []
    for i in range(n):
        words = ["".join(rng.choice("abcdefgh") for _ in range(rng.randint(2, 8))) for _ in range(rng.randint(30, 400))]
        good = i % 4 != 0
        if not good:      # junk in one part of the text only
            k = rng.randint(0, len(words) - 1)
            words[k:k + 60] = [w.upper() + "!!" for w in words[k:k + 60] or ["x"]] * 2
        rows.append((i, " ".join(words), "", ""))
        labels.append((i, int(good), 0))
    return rows, labels


def test_held_out_accuracy(spark):
    rows, labels = corpus()
    out = quality_scores(spark.createDataFrame(rows, SCHEMA), spark.createDataFrame(labels, LABELS)).collect()
    held = [r for r in out if r["held_out"]]
    assert len(out) == 400 and 90 < len(held) < 180
    assert np.mean([r["predicted"] == labels[r["doc_id"]][1] for r in held]) > 0.9
    assert all(r["predicted"] == int(r["score"] >= 0.5) and 0 <= r["score"] <= 1 for r in out)


def test_attention_weights_sum_to_one_and_edge_cases(spark):
    rows, labels = corpus(60)
    rows += [(1000, None, "", ""), (1001, "", "", ""), (None, "text", "", ""), (1, "again", "", ""), (1, "again", "", ""), (1002, "z" * 300_000, "", "")]
    labels += [(1000, None, 0), (5, 0, 0), (5, 1, 0)]
    docs, known = spark.createDataFrame(rows, SCHEMA), spark.createDataFrame(labels, LABELS)
    out = quality_scores(docs, known).collect()
    by = {r["doc_id"]: r for r in out}
    assert len(out) == len(rows) and by[1000]["score"] == by[1001]["score"] and by[None]["held_out"] is False
    model = M.fit(docs, known)
    x, bounds = bag(rows[0][1])
    assert abs(forward(model, x, bounds)["a"].sum() - 1) < 1e-5
    assert quality_scores(docs.limit(0), known).count() == 0
    assert {r["score"] for r in quality_scores(docs, known.limit(0)).collect()} == {0.5}
