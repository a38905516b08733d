import hashlib
import random

import numpy as np
import public_tokenizers
import pytest
from pyspark.sql import types as T
from tokenizers import Tokenizer

from quire.llm import bpe
from quire.llm.bpe import bpe_decode, bpe_encode, bpe_round_trip, codec

PATH = public_tokenizers.path("byte_bpe_50k.json")
SCHEMA = T.StructType([T.StructField("doc_id", T.LongType()), T.StructField("text", T.StringType()), T.StructField("ids", T.StringType())])


@pytest.fixture(scope="module")
def library():
    return Tokenizer.from_file(PATH)


def texts():
    rng = random.Random(5)
    odd = ["", "a", "aaaa aaaaa  aaa", " x   y\n\n z \t\t w", "don't DON'T we'll", "<|endoftext|>hi <|endoftext|><|endoftext|>", "   ",
           "\n \n", "日本語 テスト 😀😀", "½ ² ⅷ a1b2", "a\x1cb \x85 c", "é" * 500, "a" * 3000, "ab" * 2000, "tab\t x", " lead", "trail ",
           "a  b   c    d", "z　 z", "﻿x", "long " * 20_000]
    return odd + ["".join(rng.choice(" \n\tabcdé'st1!<|>") for _ in range(rng.randint(1, 80))) for _ in range(1500)]


def test_same_ids_and_decoding_as_the_library(library):
    c = codec(PATH)
    for text in texts():
        ids = library.encode(text, add_special_tokens=False).ids
        assert c.encode(text).tolist() == ids
        assert c.decode(ids) == library.decode(ids, skip_special_tokens=False)


def test_decoding_of_any_ids(library):
    rng, c = random.Random(6), codec(PATH)
    for _ in range(300):
        ids = [rng.randrange(50_257) for _ in range(rng.randint(0, 12))]
        assert c.decode(ids) == library.decode(ids, skip_special_tokens=False)


def test_forgetting_chunks_changes_nothing(monkeypatch, library):
    monkeypatch.setattr(bpe, "CACHE_CHUNKS", 5)
    c = bpe.Codec(PATH)
    for text in ["one two three four five six seven", "two three eight nine ten eleven", "one eleven twelve two"] * 3:
        assert c.encode(text).tolist() == library.encode(text, add_special_tokens=False).ids


def test_round_trip_rows(spark, library):
    rows = [(k, t) for k, t in enumerate(texts()[:40])] + [(3, "again"), (3, "again"), (None, "no id"), (99, None)]
    df = spark.createDataFrame([(i, t, "clash") for i, t in rows], SCHEMA)
    got = sorted(map(tuple, bpe_round_trip(df, PATH).collect()), key=str)
    want = []
    for i, t in rows:
        ids = library.encode(t or "", add_special_tokens=False).ids
        back = library.decode(ids, skip_special_tokens=False)
        want.append((i, len(ids), hashlib.sha256(",".join(map(str, ids)).encode()).hexdigest(),
                     hashlib.sha256(back.encode()).hexdigest()))
    assert got == sorted(want, key=str)
    back = {r["doc_id"]: r["text"] for r in bpe_decode(bpe_encode(df.filter("doc_id < 40"), PATH), PATH).collect()}
    assert back[8] == texts()[8]
    assert bpe_round_trip(df.limit(0), PATH).count() == 0


def test_texts_in_one_array_and_words_of_all_lengths(monkeypatch, library):
    rng = random.Random(7)
    signs = [" ", "\n", "\t", "a", "é", "'", "s", "t", "r", "e", "v", "l", "d", "m", "1", "!", "　", "\x85", "日", "😀", "½", "ſ", "\0", "<|endoftext|>"]
    rows = ["".join(rng.choice(signs) for _ in range(rng.randint(0, 40))) for _ in range(2000)] + [" x" + "ab" * k for k in range(40)] * 2
    rows += ["<|endof", "text|> split by a text's end", "it'", "s", "'", "ll", "'l", "l"]
    raw = [t.encode() for t in rows]
    offsets = np.concatenate([[0], np.cumsum([len(r) for r in raw])])
    want = [library.encode(t, add_special_tokens=False).ids for t in rows]
    for kept in (bpe.CACHE_CHUNKS, 3000, 0):
        monkeypatch.setattr(bpe, "CACHE_CHUNKS", kept)
        c = bpe.Codec(PATH)
        for _ in range(3):
            ids, bounds = c.encode_flat(np.frombuffer(b"".join(raw), np.uint8), offsets)
            assert [ids[a:b].tolist() for a, b in zip(bounds, bounds[1:])] == want


def test_words_that_share_a_key_keep_their_own_ids(monkeypatch, library):
    monkeypatch.setattr(bpe, "mix", lambda x: x & np.uint64(7))
    c = bpe.Codec(PATH)
    for _ in range(2):
        for text in ["one two three four five six seven", "eight nine two ten eleven twelve", "a b c d e f g h i j k l m"]:
            assert c.encode(text).tolist() == library.encode(text, add_special_tokens=False).ids


def test_a_task_learns_each_word_once(monkeypatch):
    c, learned = bpe.Codec(PATH), []
    merge = c.merge
    monkeypatch.setattr(c, "merge", lambda raw, size: learned.append(len(size)) or merge(raw, size))
    for k in range(5):
        c.encode_packed([" ".join(f"w{chr(97 + i % 26)}{chr(97 + i // 26)}x" for i in range(500))])
    assert sum(learned) <= 501
