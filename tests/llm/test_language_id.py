import random
import zlib

import numpy as np
from pyspark.sql import types as T

from quire.llm import language_id as L
from quire.llm.language_id import Automata, learn, predict
from quire.llm.language_id import language_id as run

SCHEMA = T.StructType([T.StructField("doc_id", T.LongType()), T.StructField("text", T.StringType()),
                       T.StructField("lang", T.StringType()), T.StructField("score", T.StringType())])
WORDS = {"en": "the and with over river stone light green house walk this that".split(),
         "fr": "le des avec sur rivière pierre été maison vert où très forêt".split(),
         "de": "und der über stein licht grün straße haus wald nicht fluß".split()}


def prose(rng, lang, n):
    return " ".join(rng.choice(WORDS[lang]) for _ in range(n))


def table(n=240, seed=1):
    rng = random.Random(seed)
    return [(i, prose(rng, lang := sorted(WORDS)[i % 3], rng.randint(3, 60)), lang, "x") for i in range(n)]


def phrases_by_search(sample, text):
    """Greedy parse into longest matches, by plain substring search, in blocks."""
    count = 0
    for k in range(0, len(text), L.BLOCK):
        block, at = text[k:k + L.BLOCK], 0
        while at < len(block):
            end = at + 1
            while end < len(block) and block[at:end + 1] in sample:
                end += 1
            at, count = end, count + 1
    return count


def test_phrases_are_those_of_substring_search(monkeypatch):
    monkeypatch.setattr(L, "BLOCK", 50)
    rng = random.Random(2)
    samples = tuple((lang, prose(rng, lang, 80)) for lang in sorted(WORDS))
    model = Automata(samples)
    texts = [prose(rng, lang, n) for lang in WORDS for n in (1, 7, 40)] + ["Über!!! GRÜN, ça", "жжж", "a", "12 34"]
    raw = [t.encode() for t in texts]
    offsets = np.concatenate([[0], np.cumsum([len(r) for r in raw])])
    symbols, bounds, letters = model.slice_symbols(np.frombuffer(b"".join(raw), np.uint8), offsets)
    got = model.phrases(symbols, bounds)

    def show(text):
        return "".join(chr(65 + s) for s in model.symbols(text).tolist())
    for k, text in enumerate(texts):
        assert bounds[k + 1] - bounds[k] == len(show(text))
        assert got[k].tolist() == [phrases_by_search(show(sample), show(text)) for _, sample in samples]
    assert letters[-1] == 0 and letters[0] > 0


def test_held_out_accuracy_and_columns(spark):
    rows = table()
    out = run(spark.createDataFrame(rows, SCHEMA)).collect()
    lang = {i: x for i, _, x, _ in rows}
    held = [r for r in out if r["held_out"]]
    assert len(out) == len(rows) and len(held) > 30
    assert np.mean([r["lang_pred"] == lang[r["doc_id"]] for r in held]) > 0.95
    assert all(0 <= r["score"] <= 1 for r in out)


def test_labels_and_ids_decide_nothing(spark):
    rows = table(60)
    samples = learn(spark.createDataFrame(rows, SCHEMA))
    one = predict(spark.createDataFrame([(1, rows[0][1], "xx", "")], SCHEMA), samples, ["doc_id"]).first()
    two = predict(spark.createDataFrame([(999, rows[0][1], None, "")], SCHEMA), samples, ["doc_id"]).first()
    assert one["lang_pred"] == two["lang_pred"] and one["score"] == two["score"]


def test_edge_cases(spark):
    rows = table(90) + [(1000, None, "en", ""), (1001, "", "en", ""), (1002, "12 + 34", "fr", ""), (1003, "la " * 30_000, "fr", ""),
                        (None, "the river", None, ""), (5, "the green house", "en", ""), (5, "the green house", "en", "")]
    got = {}
    for r in run(spark.createDataFrame(rows, SCHEMA)).collect():
        got.setdefault(r["doc_id"], []).append(r)
    assert [got[i][0]["lang_pred"] for i in (1000, 1001, 1002)] == ["und"] * 3 and got[1000][0]["score"] == 0
    assert got[None][0]["lang_pred"] == "en" and got[None][0]["held_out"] is False and len(got[5]) == 3
    assert run(spark.createDataFrame([], SCHEMA)).count() == 0
    assert [r["lang_pred"] for r in run(spark.createDataFrame([(1, "no label", None, "")], SCHEMA)).collect()] == ["und"]


def test_large_alphabets_are_told_apart(spark):
    rng = random.Random(4)
    words = dict(WORDS)
    for name, first in (("zh", 0x4E00), ("ja", 0x6000), ("ko", 0xAC00)):      # 400 letters each, words of the same lengths
        words[name] = ["".join(chr(first + rng.randrange(400)) for _ in range(2 + k % 3)) for k in range(300)]
    rows = [(i, " ".join(rng.choice(words[lang]) for _ in range(40)), lang, "x")
            for i in range(600) for lang in [sorted(words)[i % len(words)]]]
    df = spark.createDataFrame(rows, SCHEMA)
    assert all(len(set(text)) > L.TABLE_LETTERS for name, text in learn(df) if name in ("zh", "ja", "ko"))
    held = [r for r in run(df).collect() if r["held_out"]]
    assert len(held) > 60 and all(r["lang_pred"] == rows[r["doc_id"]][2] for r in held)


def test_tables_and_lists_give_the_same_phrases(monkeypatch):
    rng = random.Random(5)
    samples = tuple((lang, prose(rng, lang, 200)) for lang in sorted(WORDS))
    texts = [prose(rng, lang, n) for lang in WORDS for n in (1, 9, 300)] + ["жжж ça ÜBER", ""]
    found = []
    for most in (64, 17, 0):        # all tables, some, none
        monkeypatch.setattr(L, "TABLE_LETTERS", most)
        model = Automata(samples)
        parsed = [model.symbols(t) for t in texts]
        found.append((len(model.lists), model.phrases(np.concatenate(parsed), np.cumsum([0, *map(len, parsed)]), mixed=True).tolist()))
    assert [n for n, _ in found][::2] == [0, 3] and 0 < found[1][0] < 3
    assert found[0][1] == found[1][1] == found[2][1]


def test_mixed_phrases_are_those_of_all_samples_together():
    rng = random.Random(6)
    samples = tuple((lang, prose(rng, lang, 80)) for lang in sorted(WORDS))
    model = Automata(samples)

    def show(text):
        return "".join(chr(65 + s) for s in model.symbols(text).tolist())
    together = "\0".join(show(sample) for _, sample in samples)
    texts = [prose(rng, "en", 20) + " " + prose(rng, "fr", 20), prose(rng, "de", 30), "xyz zyx жж", "a"]
    parsed = [model.symbols(t) for t in texts]
    got = model.phrases(np.concatenate(parsed), np.cumsum([0, *map(len, parsed)]), mixed=True)
    assert got[:, -1].tolist() == [phrases_by_search(together, show(t)) for t in texts]
    assert (got[:, -1] <= got[:, :-1].min(axis=1)).all() and got[0, -1] < got[0, :-1].min()


def test_all_labelled_texts_are_learned_from_whole(spark):
    # A word that each of 300 texts holds only behind its 3,000th character, and one that 200 of them lack.
    rows = [(i, "la " * 1000 + "fin" + " zut" * (i % 3 == 0), "fr", "x") for i in range(300)]
    rows += [(1000 + i, "the " * 40 + "end", "en", "x") for i in range(40)]
    got = dict(learn(spark.createDataFrame(rows, SCHEMA)))
    assert got == {"fr": "la fin zut", "en": "the end"}
    # Counts decide, not which texts come first.
    more = [(i, f"aa bb{'b' * (i % 7)} {'zz ' * (i > 100) * 2}", "xx", "x") for i in range(400)]
    assert dict(learn(spark.createDataFrame(more, SCHEMA)))["xx"].split()[:2] == ["zz", "aa"]


def test_scripts_without_spaces_are_learned_in_pieces(spark):
    rows = [(i, "".join(chr(0x4E00 + (i * 7 + k) % 90) for k in range(200)), "zh", "x") for i in range(40)]
    (_, text), = learn(spark.createDataFrame(rows, SCHEMA))
    assert max(map(len, text.split())) == 3 and len(set(text)) == 91


def test_limits_come_from_all_held_out_texts(spark):
    held = [i for i in range(2000) if zlib.crc32(str(i).encode()) % 4 == 2]
    rows = table(240) + [(i, "the river " * 500, "en", "x") for i in held[100:300]]
    df = spark.createDataFrame(rows, SCHEMA)
    samples = learn(df)
    rates, besides = L.limits(df, samples)
    assert sorted(rates) == sorted(WORDS) and besides == L.BESIDES
    # One token of 90 strange letters, behind the first 4,000 characters of a late text.
    odd = rows + [(held[301], "the river " * 500 + "жбщ" * 30, "en", "x")]
    _, more = L.limits(spark.createDataFrame(odd, SCHEMA), samples)
    assert 45 < more <= 90
    # Neither rows' order nor their partitions change them.
    assert L.limits(spark.createDataFrame(odd[::-1], SCHEMA).repartition(5), samples) == L.limits(
        spark.createDataFrame(odd, SCHEMA).coalesce(1), samples)


def test_passages_above_a_rate_are_those_of_the_parse(monkeypatch):
    monkeypatch.setattr(L, "BLOCK", 20)
    rng = random.Random(7)
    model = Automata(tuple((lang, prose(rng, lang, 80)) for lang in sorted(WORDS)))
    texts = [prose(rng, "en", 20) + " жжж ж " + prose(rng, "fr", 9), "", prose(rng, "de", 30), "a", "ж" * 50 + " the " * 9]
    parsed = [model.symbols(t) for t in texts]
    bounds = np.cumsum([0, *map(len, parsed)])
    rate = np.array([0.4, 0.3, 0.2, 0.5, 0.6])
    count, most = model.together(np.concatenate(parsed), bounds, rate)
    assert count.tolist() == model.phrases(np.concatenate(parsed), bounds, mixed=True)[:, -1].tolist()
    for k, p in enumerate(parsed):
        # Phrases begun up to each place: those of the beginning that ends there.
        ends = [0.0] + [model.phrases(p[:j], np.array([0, j]), mixed=True)[0, -1] for j in range(1, len(p) + 1)]
        want = max([0.0, *(ends[j] - ends[i] - rate[k] * (j - i) for j in range(len(p) + 1) for i in range(j))])
        assert abs(most[k] - want) < 1e-9
