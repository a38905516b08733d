import random
import re

import pytest
from pyspark.sql import types as T

from quire.llm import jaccard_join
from quire.llm.components import components
from quire.llm.jaccard_join import Rule, choose_boundary, jaccard_groups, light_overlaps

THREE = Rule(3, 9, 10)

SCHEMA = T.StructType([T.StructField("doc_id", T.LongType()), T.StructField("text", T.StringType()),
                       T.StructField("n", T.StringType()), T.StructField("sig", T.StringType())])
UPPER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def run(spark, rows, rule=THREE):
    df = spark.createDataFrame([(i, t, "x", "y") for i, t in rows], SCHEMA)
    out = jaccard_groups(df, rule)
    assert out.columns == ["doc_id", "n_shingles", "component_id"]
    return {r["doc_id"]: (r["n_shingles"], r["component_id"]) for r in out.collect()}


def shingles(text, size):
    w = re.findall(r"[^\x20\x09-\x0D]+", (text or "").translate(UPPER))
    if not w:
        return frozenset()
    return frozenset(tuple(w[i:i + size]) for i in range(len(w) - size + 1)) if len(w) >= size else frozenset([tuple(w)])


def brute(rows, rule=THREE):
    sets = {i: shingles(t, rule.words) for i, t in rows}
    up = {i: i for i in sets}

    def find(i):
        while up[i] != i:
            i = up[i]
        return i
    ids = sorted(sets)
    for k, i in enumerate(ids):
        for j in ids[:k]:
            a, b = sets[i], sets[j]
            if a and b and rule.den * len(a & b) >= rule.num * len(a | b):
                x, y = find(i), find(j)
                up[max(x, y)] = min(x, y)
    return {i: (len(sets[i]), find(i)) for i in ids}


def corpus(seed, n=220):
    rng = random.Random(seed)
    words = [f"w{k}" for k in range(400)]
    rows = []
    for i in range(n):
        if rows and rng.random() < 0.6:          # edited copies, so that links chain
            w = rng.choice(rows)[1].split()
            for _ in range(rng.choice([0, 1, 1, 2])):
                if w:
                    k = rng.randrange(len(w))
                    rng.choice([lambda: w.pop(k), lambda: w.insert(k, rng.choice(words)), lambda: w.append("tail")])()
            text = " ".join(w)
            rows.append((i, text.upper() if rng.random() < 0.2 else text))
        else:
            rows.append((i, " ".join(rng.choice(words) for _ in range(rng.choice([1, 2, 5, 12, 14, 22, 40, 90])))))
    return rows


@pytest.mark.parametrize("seed,boundary,rule", [(1, None, THREE), (2, 12, THREE), (3, 24, THREE), (4, 6, Rule())])
def test_same_groups_as_brute_force(spark, monkeypatch, seed, boundary, rule):
    if boundary is not None:     # both sides of the boundary, and pairs across it
        monkeypatch.setattr(jaccard_join, "choose_boundary", lambda sizes, rule: boundary)
    rows = corpus(seed)
    assert run(spark, rows, rule) == brute(rows, rule)


def test_edge_cases(spark):
    rows = [(1, None), (2, ""), (3, " \t\n"), (4, "One"), (5, "one "), (6, "ÉTÉ a"), (7, "été a"), (8, "a b c"), (9, "A\x0bb\x0cC"),
            (10, "x " * 20_000), (11, "x x x"), (12, "a b c")]
    assert run(spark, rows) == brute(rows)
    assert run(spark, []) == {}
    df = spark.createDataFrame([(None, "p q r", "", ""), (5, "p q r", "", ""), (5, "p q r", "", "")], SCHEMA)
    got = jaccard_groups(df, THREE).collect()
    assert len(got) == 3 and {r["component_id"] for r in got} == {5}


def test_overlaps_and_boundary():
    assert THREE.overlap(10, 10) == 10 and THREE.overlap(19, 19) == 18
    assert light_overlaps(12, THREE)[10] == [9, 10]
    assert choose_boundary({5: 100}, THREE) >= 5
    assert choose_boundary({500: 100}, THREE) < 500


def test_components_of_a_long_chain_and_a_star(spark):
    chain = [(i, i + 1) for i in range(100, 160)]
    star = [(7, k) for k in range(1000, 1100)]
    got = {r["id"]: r["component"] for r in components(spark.createDataFrame(chain + star, "a long, b long")).collect()}
    assert all(got[i] == 100 for i in range(100, 161)) and all(got[k] == 7 for k in range(1000, 1100)) and len(got) == 162
