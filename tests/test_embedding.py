"""Embedding text rule (the source system's 8 cases) and the batched write-back."""

from pyspark.sql import functions as F

from quire.operators import embedding as emb

SCHEMA = ("title string, subtitle string, short_description string, long_description string, "
          "contributors array<struct<sequence_number:int, role:string, person_name:string, "
          "person_name_inverted:string>>, subjects array<struct<scheme_identifier:string, scheme_version:string, "
          "subject_code:string, subject_heading_text:string, is_main_subject:boolean>>")


def text(spark, **kw):
    row = dict(title="T", subtitle=None, short_description=None, long_description=None, contributors=[], subjects=[])
    row.update(kw)
    df = spark.createDataFrame([row], SCHEMA)
    return df.select(emb.embedding_text_nested(df).alias("t")).first().t


def test_title(spark):
    assert text(spark) == "T"


def test_subtitle(spark):
    assert text(spark, subtitle="S") == "T. S"


def test_authors(spark):
    c = [(1, "A01", "Ann", None), (2, "A01", "Bob", None)]
    assert text(spark, contributors=c) == "T. By Ann, Bob"


def test_non_authors_excluded(spark):
    assert text(spark, contributors=[(1, "B01", "Ed", None)]) == "T"


def test_subjects(spark):
    s = [("93", None, "F", "Fiction", True), ("93", None, "X", "Crime", False)]
    assert text(spark, subjects=s) == "T. Fiction, Crime"


def test_short_description(spark):
    assert text(spark, short_description="Short.", long_description="Long") == "T. Short."


def test_long_description_cut_at_500(spark):
    out = text(spark, long_description="x" * 1000)
    assert out == "T. " + "x" * 500


def test_minimal_book_not_empty(spark):
    assert text(spark, title="Only") == "Only"


def test_embed_and_write_back(spark):
    books = spark.createDataFrame([("a", "hello world", None), ("b", "", None)],
                                  "record_reference string, text string, embedded_at timestamp")
    books = books.withColumn("embedding", F.lit(None).cast("array<float>"))
    vec = emb.embed(books.select("record_reference", "text"), emb.hashing_provider(8), dim=8, batch=1)
    out = {r.record_reference: r for r in emb.write_vectors(books, vec, 8, "2024-06-01").collect()}
    assert len(out["a"].embedding) == 8 and out["a"].embedded_at is not None
    assert out["b"].embedding is None and out["b"].embedded_at is None  # empty text fails, left as is


def test_retrying_provider_backoff_and_hint():
    waits, calls = [], {"n": 0}

    class Busy(Exception):
        def __init__(self, retry_after=None):
            self.retry_after = retry_after

    def flaky(texts):
        calls["n"] += 1
        if calls["n"] == 1:
            raise Busy()
        if calls["n"] == 2:
            raise Busy(retry_after=10)
        return [[1.0] for _ in texts]

    p = emb.RetryingProvider(flaky, sleep=waits.append, pause=0.5)
    assert p(["a", "b"]) == [[1.0], [1.0]] and waits == [1, 12]
    p(["c"])
    assert waits[-1] == 0.5                       # pause before the next batch
    dead = emb.RetryingProvider(lambda t: (_ for _ in ()).throw(Busy()), sleep=waits.append)
    assert dead(["x"]) == [None]                  # five failures: batch left unembedded


def test_a_hanging_call_is_given_up(spark):
    import time

    def hangs(texts):
        if any("hang" in t for t in texts):
            time.sleep(30)
        return [[1.0, float(len(t))] for t in texts]

    rows = [("a", "hang on"), ("b", "fine"), ("c", "also")]
    texts = spark.createDataFrame(rows, "record_reference string, text string").coalesce(1)
    provider = emb.RetryingProvider(hangs, tries=2, backoff=(0,), deadline=0.3)
    began = time.time()
    vectors = emb.embed(texts, provider, 2, batch=1)
    books = texts.select("record_reference", F.lit(None).cast("array<float>").alias("embedding"), F.lit(None).cast("timestamp").alias("embedded_at"))
    got = {r.record_reference: r for r in emb.write_vectors(books, vectors, 2, "2024-06-01").collect()}
    assert time.time() - began < 25
    assert got["a"].embedding is None and got["a"].embedded_at is None
    assert got["b"].embedding == [1.0, 4.0] and got["c"].embedded_at is not None


def test_errors_and_slow_calls_are_tried_again():
    import pytest
    seen, slept = [], []

    def call(texts):
        seen.append(texts)
        if len(seen) == 1:
            raise ValueError("no")
        if len(seen) == 2:
            __import__("time").sleep(5)
        return [[0.0]] * len(texts)

    assert emb.RetryingProvider(call, sleep=slept.append, deadline=0.2)(["x"]) == [[0.0]]
    assert slept == [1, 2] and len(seen) == 3
    with pytest.raises(ValueError):
        emb.call_within(lambda t: (_ for _ in ()).throw(ValueError("no")), ["x"], 1)


def test_the_rate_is_shared_out_over_tasks(spark):
    import time
    texts = spark.range(12).select(F.col("id").cast("string").alias("record_reference"), F.lit("t").alias("text"))

    def stamped(batch):
        return [[time.time()]] * len(batch)

    rows = emb.embed(texts, stamped, 1, batch=1, calls_per_minute=240, tasks=2).withColumn("task", F.spark_partition_id()).collect()
    per_task = {}
    for r in rows:
        per_task.setdefault(r.task, []).append(r.embedding[0])
    assert len(rows) == 12 and len(per_task) == 2
    # each of two tasks at most two calls a second (times are kept as floats of 32 bits: counted by the run's length)
    began = time.time()
    emb.embed(texts, stamped, 1, batch=1, calls_per_minute=240, tasks=2).count()
    assert time.time() - began >= (max(map(len, per_task.values())) - 1) * 0.5 * 0.9
