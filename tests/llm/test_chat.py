import hashlib

import pytest
from pyspark.sql import functions as F

from quire.llm import chat
from quire.llm.chat import (LAYOUTS, canonical_turns, escape, fingerprint, format_turns, formatted_digests, layout_of,
                            mixed_turns, unescape)

SAID = "</s>[INST] ok [/INST]"
NASTY = ["", "plain", SAID, "<|im_end|>", "<\\|im_end|>", "<\\\\|im_start|> [\\INST] [INST", "<<SYS>> <</SYS>> <\\<SYS>>", "[[INST]]",
         "<<s>", "\\", "a\nb\\n", "<|im_sep|><|im_sep|>", "[\\\\/INST]", "é<s>é"]


def digest(s):
    return hashlib.sha256(s.encode()).hexdigest()


def test_escape_is_reversible_and_leaves_no_control_string(spark):
    df = spark.createDataFrame([(t,) for t in NASTY], "t string").select("t", escape(F.col("t")).alias("e"))
    for r in df.select("t", "e", unescape(F.col("e")).alias("u")).collect():
        assert r["u"] == r["t"] and not any(c in r["e"] for c in chat.CONTROL)


def test_formatted_conversations_read_back(spark):
    rows = [(1, k, "user" if k % 2 == 0 else "assistant", t) for k, t in enumerate(NASTY)]
    rows += [(2, 0, "system", "be brief"), (2, 1, None, None), (2, 1, "assistant", "x"), (2, 1, "assistant", "x"), (None, None, "user", "q"),
             (3, 0, "assistant", "long " * 30_000)]
    df = spark.createDataFrame(rows, "conv_id long, turn long, role string, text string")
    got = {r["conv_id"]: r for r in formatted_digests(format_turns(canonical_turns(df))).collect()}
    for conv in (1, 2, 3, None):
        turns = sorted(((t if t is not None else -1, r or "", x or "") for c, t, r, x in rows if c == conv))
        said = "".join(x for _, r, x in turns if r == "assistant")
        g = got[conv]
        assert g["n_turns"] == len(turns) and g["turns_sha256"] == digest("".join(f"{r}\n{x}\n" for _, r, x in turns))
        assert g["loss_chars"] == len(said) and g["loss_sha256"] == digest(said)
    assert formatted_digests(format_turns(canonical_turns(df.limit(0)))).count() == 0


def test_layouts_by_fingerprint(spark):
    turns = spark.sql("SELECT 5L conv_id, array(named_struct('role','user','content','hi'), named_struct('role','assistant','content','yo')) messages, 1 extra")
    assert layout_of(turns.schema).name == "messages"
    assert [(r["role"], r["text"]) for r in canonical_turns(turns).orderBy("turn").collect()] == [("user", "hi"), ("assistant", "yo")]
    pair = spark.sql("SELECT 6L conv_id, 'p' prompt, 'r' response, 'src' source")
    assert [(r["role"], r["text"]) for r in canonical_turns(pair).orderBy("sub").collect()] == [("user", "p"), ("assistant", "r")]
    with pytest.raises(ValueError):
        layout_of(spark.sql("SELECT 1 a, 2 b").schema)
    # columns that clash with another mapping's names
    both = spark.sql("SELECT 1L conv_id, 0L turn, 'user' role, 't' text, 'p' prompt")
    assert layout_of(both.schema).name == "turn_rows"
    assert len({fingerprint(x.paths()) for x in LAYOUTS}) == len(LAYOUTS)


def test_mixed_json_layouts(spark):
    rows = ['{"conv_id":1,"messages":[{"role":"user","content":"a"},{"content":"b","role":"assistant"}]}',
            '{"conv_id":2,"conversations":[{"from":"human","value":"c"},{"from":"gpt","value":"d"}],"note":3}',
            '{"conv_id":3,"instruction":"e","input":"","output":"f"}', '{"conv_id":4,"instruction":"e","input":"g","output":"f"}',
            '{"conv_id":5,"prompt":"h","completion":"i"}', '{"conv_id":6,"what":"?"}', "no json", None]
    out = mixed_turns(spark.createDataFrame([(r,) for r in rows], "j string"), "j").collect()
    got = {}
    for r in out:
        got.setdefault(r["conv_id"], []).append((r["layout"], r["turn"], r["sub"], r["role"], r["text"]))
    said = {c: [(x[3], x[4]) for x in sorted(v, key=lambda x: (x[1] or 0, x[2] or 0))] for c, v in got.items()}
    assert said[1] == [("user", "a"), ("assistant", "b")] and said[2] == [("user", "c"), ("assistant", "d")]
    assert said[3] == [("user", "e"), ("assistant", "f")] and said[4][0] == ("user", "e\n\ng") and said[5] == [("user", "h"), ("assistant", "i")]
    assert [x[0] for x in got[None]] == [None] * 2 and got[6] == [(None,) * 5] and got[4][0][0] == "instruction_input"


def test_no_conversation_is_lost_for_its_layout(spark):
    rows = ['{"conv_id":1,"turn":0,"role":"user","text":"a","prompt":"p"}',                     # one more known key
            '{"conv_id":2,"prompt":"h","response":"i","input":"x"}',
            '{"conv_id":3,"messages":[]}', '{"conv_id":4,"messages":null}', '{"conv_id":5,"messages":"text"}',
            '{"conv_id":6,"messages":[{"role":"user"},{"role":"assistant","content":"b"}]}',     # the first without content
            '{"conv_id":7,"conversations":[{"from":"human"}]}',                                  # none with a value
            '{"conv_id":8,"messages":["x",{"role":"user","content":"c"},null]}',                 # elements that are no objects
            '{"conv_id":9,"what":1}']
    out = mixed_turns(spark.createDataFrame([(r,) for r in rows], "j string"), "j").collect()
    said = {}
    for r in sorted(out, key=lambda r: (r["conv_id"], r["turn"] or 0, r["sub"] or 0)):
        said.setdefault((r["conv_id"], r["layout"]), []).append((r["role"], r["text"]))
    assert said == {(1, "turn_rows"): [("user", "a")], (2, "prompt_response"): [("user", "h"), ("assistant", "i")],
                    (3, "messages"): [(None, None)], (4, "messages"): [(None, None)], (5, "messages"): [(None, None)],
                    (6, "messages"): [("user", ""), ("assistant", "b")], (7, "from_value"): [("user", "")],
                    (8, "messages"): [("", ""), ("user", "c"), ("", "")], (9, None): [(None, None)]}


def test_typed_layouts_mixed_in_one_frame(spark):
    rows = [(1, k, "user" if k % 2 == 0 else "assistant", t) for k, t in enumerate(NASTY)] + [(2, 0, None, None), (2, None, "user", "q")]
    turns = spark.createDataFrame(rows, "conv_id long, turn int, role string, text string").withColumn("v", F.lit(1)).withColumn("paths", F.lit(2))
    pair = spark.sql("SELECT 6L conv_id, 'p' prompt, string(null) response, map(1, 2) extra")
    lists = spark.sql("SELECT 7L conv_id, array(named_struct('role', 'user', 'content', 'hi'), null) messages")
    records = chat.as_records(turns).unionByName(chat.as_records(pair)).unionByName(chat.as_records(lists))
    got = mixed_turns(records, "record").drop("layout")
    want = canonical_turns(turns).unionByName(canonical_turns(pair)).unionByName(canonical_turns(lists))
    order = lambda df: sorted(map(str, df.collect()))
    assert order(got) == order(want)
    assert mixed_turns(records.limit(0), "record").count() == 0
