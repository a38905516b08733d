import random

import public_tokenizers
import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

import corpus_pipeline as P
from quire.llm.jaccard_join import Rule, keep_one
from llm.test_jaccard_join import brute

DOCS = T.StructType([T.StructField("doc_id", T.LongType()), T.StructField("text", T.StringType()), T.StructField("lang", T.StringType()),
                     T.StructField("source", T.StringType()), T.StructField("n_chars", T.LongType())])
LABELS = "doc_id long, quality int, toxic int"


def prose(rng, words, n):
    return " ".join(rng.choice(words) for _ in range(n)).capitalize() + "."


@pytest.fixture(scope="module")
def tables(spark, tmp_path_factory):
    rng = random.Random(3)
    english, french = "the and with over river stone light green house walk".split(), "le des avec sur rivière pierre été maison vert où".split()
    rows, labels = [], []
    for i in range(160):
        lang = "en" if i % 2 else "fr"
        text, good = prose(rng, english if i % 2 else french, rng.randint(40, 90)), 1
        if i % 8 == 3:
            text, good = " ".join(w + rng.choice(["###", "$$$", "%%%"]) for w in text.split()), 0
        rows.append((i, text, lang, "s", len(text)))
        if i % 2 or i % 3:
            labels.append((i, good, 0))
    for i in range(160, 200):           # copies with one word more, and exact ones
        text = rows[(i - 160) * 2][1] + (" more" if i % 2 else "")
        rows.append((i, text, "en", "s", len(text)))
    rows += [(300, "1234 5678 90 " * 30, "en", "s", 390)]
    path = str(tmp_path_factory.mktemp("tables"))
    spark.createDataFrame(rows, DOCS).repartition(3).write.parquet(f"{path}/documents.parquet")
    spark.createDataFrame(labels, LABELS).write.parquet(f"{path}/labels.parquet")
    return path, rows


def test_stages_take_effect_and_hand_on_documents(spark, tables):
    path, rows = tables
    docs = spark.read.parquet(f"{path}/documents.parquet")
    bad = {r[0] for r in rows if r[0] < 160 and r[0] % 8 == 3}
    at = docs
    for name, stage in P.STAGES[:-1]:
        out = stage(spark, at, path)
        assert out.columns == docs.columns and out.schema == at.schema
        out = out.cache()
        before, after = ({r["doc_id"]: r["text"] for r in x.collect()} for x in (at, out))
        if name == "quality":
            assert not bad & set(after) and len(set(before) - bad - {300} - set(after)) == 0
        if name == "language":
            assert 300 not in after and set(before) - set(after) <= {300}
        if name == "near_duplicates":
            want = {i for i, (_, c) in brute(sorted(before.items()), Rule()).items() if i == c}
            assert set(after) == want and len(want) < len(before)
        at = out
    pieces = P.run(spark, path)
    tokens = pieces.groupBy("doc_id").agg(F.sum("length").alias("n"), F.max("doc_tokens").alias("of")).collect()
    assert {r["doc_id"] for r in tokens} == {r["doc_id"] for r in at.collect()} and all(r["n"] == r["of"] for r in tokens)


def test_clean_mixed_documents_stay_and_other_languages_go(spark):
    rng = random.Random(8)
    make = lambda letters: ["".join(rng.choice(letters) for _ in range(rng.randint(2, 7))) for _ in range(300)]
    english, french = make("etaoinshrdlu"), make("éàèçêvqjxzkwaeu")
    rows = [(i, prose(rng, (english, french)[i % 2], 80), ("en", "fr")[i % 2], "s", 0) for i in range(200)]
    mixed = [(300 + i, " ".join(prose(rng, (english, french)[k % 2], 12) for k in range(8)), None, "s", 0) for i in range(8)]
    mixed += [(310 + i, " ".join(rng.choice((english, french)[k % 2]) for k in range(100)), None, "s", 0) for i in range(8)]
    short = [(320, english[0], None, "s", 0), (321, english[1] + " 0a1b2c " + french[1], None, "s", 0)]
    strange = [(330 + i, prose(rng, make("бгджзиклмнптфцчшщыюя"), 200), None, "s", 0) for i in range(4)]
    docs = spark.createDataFrame(rows + mixed + short + strange, DOCS).cache()
    got = {r["doc_id"] for r in P.language(spark, docs, "").collect()}
    assert got == {r[0] for r in rows + mixed + short}


def test_one_stays_also_of_repeated_rows_and_null_ids(spark):
    text = "a b c d e f g h i j k l m n o p"
    rows = [(1, text), (1, text), (2, text), (3, None), (3, None), (None, text), (4, text + " q"), (5, "else")]
    df = spark.createDataFrame([(i, t, "x", "x") for i, t in rows], "doc_id long, text string, id string, drop string")
    got = keep_one(df)
    assert got.columns == df.columns
    assert sorted(map(str, (r["doc_id"] for r in got.collect()))) == ["1", "3", "5", "None"]


def test_one_id_with_two_texts_and_columns_of_any_name(spark, tables):
    one, two = "a b c d e f g h i j k l m n o p", "q r s t u v w x y z aa bb cc dd"
    rows = [(1, one), (5, one), (5, two), (5, two), (6, two + " more"), (7, "")]
    df = spark.createDataFrame([(i, t, 1, 2, 3, 4, 5) for i, t in rows],
                               "doc_id long, text string, __bucket int, __id int, __drop int, row int, often int")
    got = keep_one(df)
    assert got.columns == df.columns and sorted((r["doc_id"], r["text"]) for r in got.collect()) == [(1, one), (5, two), (7, "")]

    path, _ = tables
    docs = spark.read.parquet(f"{path}/documents.parquet").filter("doc_id < 120")
    more = docs.selectExpr("*", "1 as __score", "2 as score", "3 as __lang_pred", "4 as found_phrases", "5 as __phrases")
    for stage in (P.quality, P.language):
        assert stage(spark, more, path).select(docs.columns).collect() == stage(spark, docs, path).collect()


def test_empty_documents_table(spark, tables):
    path, _ = tables
    docs = spark.createDataFrame([], DOCS)
    for _, stage in P.STAGES:
        assert stage(spark, docs, path).count() == 0


def test_tokenizer_is_there():
    assert public_tokenizers.path(P.TOKENIZER)
