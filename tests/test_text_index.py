"""The stored text index against a plain count."""

import random
import re
from collections import Counter

import pytest
from pyspark.sql import functions as F

from quire.functions.text import STOP_WORDS, WEIGHTS, stem_word
from quire.operators import text_index

FIELDS = {"title": "A", "body": "C"}


def plain(docs, queries, k, mode, stem):
    def lexemes(text):
        found = [w for w in re.findall(r"[^\W_]+", (text or "").lower()) if w not in STOP_WORDS]
        return [stem_word(w) for w in found] if stem else found
    out = {}
    for q, text in queries:
        terms, ranked = set(lexemes(text)), []
        for key, title, body in docs:
            s = Counter()
            for field, letter in ((title, "A"), (body, "C")):
                for w in lexemes(field):
                    s[w] += WEIGHTS[letter]
            hit = [s[t] for t in terms if t in s]
            if hit and (mode == "or" or len(hit) == len(terms)):
                ranked.append((-sum(hit), key))
        for rank, (score, key) in enumerate(sorted(ranked)[:k], 1):
            out[q, rank] = (key, -score / 10)
    return out


@pytest.fixture(scope="module")
def corpus():
    rng = random.Random(5)
    vocabulary = [f"w{i}" for i in range(60)] + ["running", "runs", "books", "the"]
    weights = [1 / (i + 1) for i in range(60)] + [0.05] * 4
    docs = [(i, " ".join(rng.choices(vocabulary, weights, k=rng.randint(0, 3))),
             " ".join(rng.choices(vocabulary, weights, k=int(rng.paretovariate(0.8)) % 400))) for i in range(700)]
    docs += [(700, None, None), (701, "", "The of"), (702, docs[5][1], docs[5][2])]
    queries = [(i, " ".join(rng.choices(vocabulary, k=rng.randint(1, 4)))) for i in range(25)]
    return docs, [*queries, (90, "run book"), (91, "the"), (92, "nothing w1"), (93, "")]


@pytest.mark.parametrize("stem", [False, True])
def test_search_equals_a_plain_count(spark, tmp_path, corpus, stem):
    docs, queries = corpus
    path = str(tmp_path / "index")
    rows = spark.createDataFrame(docs, "id long, title string, body string").repartition(5)
    text_index.write_text_index(rows, path, "id", FIELDS, stem=stem, block_docs=16, parts=8)
    terms = text_index.query_terms(spark.createDataFrame(queries, "query_id long, q string"), "q", stem=stem)
    for mode in ("or", "and"):
        got = text_index.search_text_index(spark, path, terms, k=5, mode=mode, key="id", first_blocks=1).collect()
        assert {(r.query_id, r["rank"]): (r.id, r.score) for r in got} == plain(docs, queries, 5, mode, stem)
        if mode == "or":
            spent = {r.query_id: (r.scored, r.blocks) for r in got}
            assert sum(s for s, _ in spent.values()) < 0.7 * sum(b for _, b in spent.values())


def test_an_empty_index_and_no_queries(spark, tmp_path, corpus):
    rows = spark.createDataFrame(corpus[0][:20], "id long, title string, body string")
    terms = spark.createDataFrame([(1, "w1")], "query_id long, lexeme string")
    path = str(tmp_path / "index")
    text_index.write_text_index(rows, path, "id", FIELDS)
    assert text_index.search_text_index(spark, path, terms.where(F.lit(False)), key="id").count() == 0
    text_index.write_text_index(rows.limit(0), path, "id", FIELDS)
    assert text_index.search_text_index(spark, path, terms, key="id").count() == 0
