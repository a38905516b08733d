import hashlib
import random

import numpy as np
from pyspark.sql import types as T

from quire.llm.syncmers import K, S, Fingerprint, closed_syncmers, code_points, fingerprints, likeness, parse

SCHEMA = T.StructType([T.StructField("doc_id", T.LongType()), T.StructField("text", T.StringType()),
                       T.StructField("part", T.StringType()), T.StructField("fingerprint", T.StringType())])


def frame(spark, rows, parts=4):
    return spark.createDataFrame([(i, t, "", "") for i, t in rows], SCHEMA).repartition(parts)


def words(rng, n):
    return " ".join("".join(rng.choice("abcdefghé") for _ in range(rng.randint(1, 8))) for _ in range(n))


def test_syncmers_by_definition():
    rng = random.Random(1)
    text = words(rng, 200)
    at, h = closed_syncmers(code_points(text))
    inner = {}
    for i in range(len(text) - S + 1):     # one hash for each distinct s-mer, read off a text that is just it
        inner[text[i:i + S]] = closed_syncmers(code_points(text[i:i + S]))
    from quire.llm import syncmers
    value = {s: int(syncmers._window_hash(code_points(s).astype(np.uint64) + np.uint64(1), S)[0]) for s in inner}
    want = []
    for i in range(len(text) - K + 1):
        v = [value[text[j:j + S]] for j in range(i, i + K - S + 1)]
        if min(v) in (v[0], v[-1]):
            want.append(i)
    assert at.tolist() == want
    again = {text[i:i + K]: int(x) for i, x in zip(at.tolist(), h)}     # equal k-mers, equal hashes, wherever
    for i, x in zip(*(a.tolist() for a in closed_syncmers(code_points("new start " + text)))):
        k = ("new start " + text)[i:i + K]
        assert again.get(k, x) == x


def test_rows_against_brute_force(spark):
    rng = random.Random(2)
    rows = [(i * 3, words(rng, rng.choice([0, 1, 3, 30, 300]))) for i in range(90)] + [(7, None), (8, ""), (1000, "ü" * 5000)]
    ordered = sorted(rows)
    got = {r["doc_id"]: r for r in fingerprints(frame(spark, rows)).collect()}
    assert len(got) == len(rows)
    for k, (i, t) in enumerate(ordered):
        t, nxt = t or "", ordered[(k + 1) % len(ordered)][1] or ""
        half = len(t) // 2
        new = t[:len(t) - half] + nxt[:half]
        r = got[i]
        assert r["n_chars"] == len(t) and r["edited_sha256"] == hashlib.sha256(new.encode()).hexdigest()
        mark, new_mark, next_mark = (Fingerprint(code_points(x)) for x in (t, new, nxt))
        assert r["fingerprint"] == str(mark) and r["edited_fingerprint"] == str(new_mark)
        a, b, c = (parse(str(m)) for m in (mark, new_mark, next_mark))
        assert r["near_edited"] == likeness(a, b) and r["near_next"] == likeness(a, c)
        if len(t) > 1000 and i != 1000:
            assert 0.3 < r["near_edited"] < 0.75 and (r["near_next"] < 0.2)


def test_equal_texts_ties_and_edges(spark):
    rows = [(1, "the same text here and there"), (2, "the same text here and there"), (2, "another"), (None, "no id"), (3, "z")]
    out = fingerprints(frame(spark, rows)).collect()
    assert len(out) == 5
    same = {r["fingerprint"] for r in out if r["n_chars"] == len(rows[0][1])}
    assert len(same) == 1
    alone = fingerprints(frame(spark, [(5, "only one document")])).collect()
    assert alone[0]["near_next"] == 1.0 and len(alone) == 1
    assert fingerprints(frame(spark, [])).count() == 0
    assert likeness(parse(""), parse("")) == 1.0
