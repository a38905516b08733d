"""Bookkeeping: claims, stale claims, job progress, exactly-once completion, resume/retention."""

import datetime as dt

from quire.operators import ledger

AS_OF = dt.datetime(2024, 6, 1, 12)
LEDGER = ("feed string, remote_path string, remote_filename string, remote_modified_at timestamp, remote_size long, "
          "landing_key string, status string, total_chunks long, processed_chunks long, row_count long, "
          "error_message string, started_at timestamp, completed_at timestamp")


def led(spark, rows):
    full = [(f, p, p, None, 1, None, st, tot, done, None, None, start, None) for f, p, st, tot, done, start in rows]
    return spark.createDataFrame(full, LEDGER)


def test_unclaimed_and_claim(spark):
    lg = led(spark, [("inv", "/a", "completed", 1, 1, AS_OF - dt.timedelta(days=1)),
                     ("inv", "/b", "processing", 1, 0, AS_OF - dt.timedelta(hours=1)),   # live claim
                     ("inv", "/c", "processing", 1, 0, AS_OF - dt.timedelta(hours=4)),   # stale
                     ("inv", "/d", "failed", 1, 0, AS_OF - dt.timedelta(minutes=5))])    # failed: retry
    man = spark.createDataFrame([("inv", p, p, None, 1) for p in ("/a", "/b", "/c", "/d", "/e")],
                                "feed string, path string, filename string, modified_at timestamp, size long")
    free = ledger.unclaimed(man, lg, AS_OF, path_only=True)
    assert sorted(r.path for r in free.collect()) == ["/c", "/d", "/e"]
    claimed = {r.remote_path: r for r in ledger.claim(lg, free, AS_OF).collect()}
    assert claimed["/d"].status == "downloading" and claimed["/d"].processed_chunks == 0
    assert claimed["/d"].total_chunks is None and claimed["/e"].started_at == AS_OF
    assert claimed["/a"].status == "completed"


def test_advance_completes_exactly_once(spark):
    lg = led(spark, [("x", "/f1", "processing", 2, 1, AS_OF), ("x", "/f2", "downloading", None, 0, AS_OF),
                     ("x", "/f3", "completed", 1, 1, AS_OF), ("x", "/f4", "downloading", None, 0, AS_OF)])
    res = spark.createDataFrame([("x", "/f1", 1, None, None, None), ("x", "/f2", None, 0, 0, None),
                                 ("x", "/f3", 1, None, None, None), ("x", "/f4", None, None, None, "boom")],
                                "feed string, remote_path string, chunks_done long, total_chunks long, "
                                "row_count long, error string")
    new, just = ledger.advance(lg, res, AS_OF)
    st = {r.remote_path: r.status for r in new.collect()}
    assert st == {"/f1": "completed", "/f2": "completed", "/f3": "completed", "/f4": "failed"}
    assert sorted(r.remote_path for r in just.collect()) == ["/f1", "/f2"]  # /f3 replay: not again
    # applying the same results again completes nothing new
    _, again = ledger.advance(new, res.where("remote_path = '/f1'"), AS_OF)
    assert again.count() == 0


def test_job_progress_and_chunk_outcome(spark):
    recs = spark.createDataFrame([(1, 0, False), (1, 0, True), (1, 1, True), (2, 0, False)],
                                 "job_id long, chunk_index int, failed boolean")
    ch = {(r.job_id, r.chunk_index): r for r in ledger.chunk_outcome(recs).collect()}
    assert ch[(1, 0)].status == "completed" and ch[(1, 1)].status == "failed"
    jobs = spark.createDataFrame([(1, "k1", "processing", 2, None), (2, "k2", "processing", 3, None)],
                                 "id long, file_key string, status string, total_chunks long, completed_at timestamp")
    out = {r.id: r for r in ledger.job_progress(jobs, ledger.chunk_outcome(recs), AS_OF).collect()}
    assert out[1].status == "completed" and out[1].failed_chunks == 2 and out[1].processed_books == 1
    assert out[2].status == "processing"


def test_resume_and_retention(spark):
    ch = spark.createDataFrame([(1, 0, "completed", None, AS_OF), (1, 1, "failed", "k", AS_OF - dt.timedelta(days=40)),
                                (1, 2, "processing", None, AS_OF)],
                               "job_id long, chunk_index int, status string, data_key string, updated_at timestamp")
    plan = ledger.resume_plan(ch).first()
    assert (plan.requeued, plan.resent, plan.already_completed) == (2, 1, 1)
    assert [r.chunk_index for r in ledger.retention_plan(ch, AS_OF).collect()] == [1]


def test_republished_fixed_name_file_is_picked_up_again(spark):
    """Default ledger key (feed, path, mtime, size): a completed fixed-name file
    published again with a new time is offered again; path-only keeps it blocked."""
    old = AS_OF - dt.timedelta(days=7)
    lg = spark.createDataFrame([("promotions", "/p/GARDPROM13.CSV", "GARDPROM13.CSV", old, 10, None, "completed",
                                 1, 1, 1, None, old, old)], LEDGER)
    man = spark.createDataFrame([("promotions", "/p/GARDPROM13.CSV", "GARDPROM13.CSV", AS_OF, 12)],
                                "feed string, path string, filename string, modified_at timestamp, size long")
    assert ledger.unclaimed(man, lg, AS_OF).count() == 1
    assert ledger.unclaimed(man, lg, AS_OF, path_only=True).count() == 0


def test_status_enum_rule(spark):
    from quire.operators import quality
    rows = spark.createDataFrame([(1, "completed"), (2, "done"), (3, None)], "id long, status string")
    good, bad = quality.quarantine(rows, quality.ledger_rules("job"))
    assert sorted(r.id for r in good.collect()) == [1, 3]
    assert [(r.id, r.reasons) for r in bad.collect()] == [(2, ["bad_status"])]
