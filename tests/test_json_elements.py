"""Objects of large JSON documents, cut at element borders."""

import json
import random

from quire.sources import feeds as src


def element(rng, i):
    texts = ["plain", "}", "{", '"', "\\", "a}b{c", '"excerpts":[{', "},{", "line\nbreak", "é}", "", '\\"}', "],"]
    out = {"isbn13": str(9780000000000 + i), "title": " ".join(rng.choice(texts) for _ in range(rng.randint(0, 5)))}
    if rng.random() < 0.3:
        out["more"] = {"a": {"b": [{"c": rng.choice(texts)}, {}]}, "excerpts": [{"isbn13": "no"}]}
    return out


def test_elements_equal_the_whole_document_parse(spark, tmp_path):
    rng, want = random.Random(8), {}
    spark.conf.set("spark.sql.files.maxPartitionBytes", "150")
    spark.conf.set("spark.sql.files.openCostInBytes", "1")
    try:
        for n in range(14):
            doc = {"note": "{[\"excerpts\":", "response_header": {"status": "}"}, "excerpts": [element(rng, i) for i in range(rng.randint(0, 60))],
                   "errors": [{"isbn13": "wrong"}], "count": 3}
            if n == 0:
                doc = {"response_header": {"status": "ok"}}
            keys = list(doc)
            rng.shuffle(keys)
            doc = {k: doc[k] for k in keys}
            name = f"d{n:02d}.json"
            text = json.dumps(doc, indent=rng.choice([None, 2]), ensure_ascii=n % 2 == 0) + rng.choice(["", "\n"])
            (tmp_path / name).write_text(text, encoding="utf-8")
            want |= {(name, i): e for i, e in enumerate(doc.get("excerpts", []))}
        (tmp_path / "cut.json").write_text('{"excerpts":[{"isbn13":"1"},{"isbn13":"2"}')
        (tmp_path / "open.json").write_text('{"excerpts":[{"isbn13":"1"},{"isbn13":"2}]}')
        (tmp_path / "none.json").write_text("")
        found = src.json_elements(spark, str(tmp_path), "excerpts")
        rows = found.collect()
        assert {(r.source_file.rsplit("/", 1)[1], r.pos): json.loads(r.value) for r in rows} == want and len(rows) == len(want)
        read = src.read_excerpts(spark, str(tmp_path)).collect()
        assert {(r.source_file.rsplit("/", 1)[1], r.pos): (r.isbn13, r.title) for r in read} == {k: (e["isbn13"], e["title"]) for k, e in want.items()}
        # one document is read by many tasks
        assert spark.read.option("lineSep", "}").text(str(tmp_path / "d01.json")).rdd.getNumPartitions() > 5
    finally:
        spark.conf.unset("spark.sql.files.maxPartitionBytes")
        spark.conf.unset("spark.sql.files.openCostInBytes")
