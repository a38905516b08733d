"""Ledger, job, excerpt and cover queries (Q07, Q08, Q18, Q19, Q22, Q24-Q27, Q29, Q34, Q35)."""

from __future__ import annotations

import io
import zipfile

import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from quire.functions import scalars as sc
from quire.operators import enrich, ledger
from quire.operators.embedding import ordered_join
from quire.operators.merge import last_wins
from quire.plans.common import as_of, days_before, isbn_of, load, ref_of, ts_str
from quire.session import arrow_fs, stage_path
from quire.sources import feeds as src

STATUS = {"F": "completed", "O": "processing", "P": "failed"}


def _status(c="o_orderstatus", mapping=STATUS):
    e = None
    for k, v in mapping.items():
        e = (F.when(F.col(c) == k, F.lit(v)) if e is None else e.when(F.col(c) == k, F.lit(v)))
    return e


def _hours_before(n) -> F.Column:
    return as_of() - F.make_interval(F.lit(0), F.lit(0), F.lit(0), F.lit(0), n.cast("int"))


# --- file ledger (Q18) -------------------------------------------------------------------

def file_ledger(orders: DataFrame, customer: DataFrame) -> DataFrame:
    """One ledger row per (feed, path): the last order of each customer."""
    j = orders.join(customer.select("c_custkey", "c_mktsegment"), orders.o_custkey == customer.c_custkey)
    st = _status()
    rows = j.select(
        F.lower("c_mktsegment").alias("feed"),
        F.concat(F.lit("/feeds/"), F.col("o_custkey").cast("string"), F.lit(".csv")).alias("remote_path"),
        F.concat(F.col("o_custkey").cast("string"), F.lit(".csv")).alias("remote_filename"),
        F.col("o_orderdate").alias("remote_modified_at"),
        F.col("o_totalprice").cast("long").alias("remote_size"),
        F.when(st == "completed", F.concat(F.lit("landed/"), F.col("o_orderkey").cast("string"), F.lit(".csv")))
        .alias("landing_key"),
        st.alias("status"),
        F.lit(4).cast("long").alias("total_chunks"),
        F.when(st == "completed", F.lit(4)).otherwise(F.col("o_orderkey") % 4).cast("long").alias("processed_chunks"),
        F.when(st == "completed", F.lit(4000)).cast("long").alias("row_count"),
        F.when(st == "failed", F.lit("boom")).alias("error_message"),
        _hours_before(F.col("o_orderkey") % 6).alias("started_at"),
        F.when(st == "completed", _hours_before(F.col("o_orderkey") % 6)).alias("completed_at"),
        F.col("o_orderkey"))
    return last_wins(rows, ["feed", "remote_path"], "o_orderkey").drop("o_orderkey")


def feed_manifest(customer: DataFrame) -> DataFrame:
    return customer.select(
        F.lower("c_mktsegment").alias("feed"),
        F.concat(F.lit("/feeds/"), F.col("c_custkey").cast("string"), F.lit(".csv")).alias("path"),
        F.concat(F.col("c_custkey").cast("string"), F.lit(".csv")).alias("filename"),
        days_before(1).alias("modified_at"), F.col("c_custkey").alias("size"))


def q_unclaimed_files(spark: SparkSession, sf: str) -> DataFrame:
    """Q18 (O-41, O-101): listed files minus completed or live claims (by path, as the source does)."""
    cu = load(spark, sf, "customer")
    led = file_ledger(load(spark, sf, "orders"), cu)
    return ledger.unclaimed(feed_manifest(cu), led, as_of(), path_only=True).select("path", "feed")


def q_ledger_claim(spark: SparkSession, sf: str) -> DataFrame:
    """Q18b (O-73): unclaimed files claimed — counters, error and times reset."""
    cu = load(spark, sf, "customer")
    led = file_ledger(load(spark, sf, "orders"), cu)
    files = ledger.unclaimed(feed_manifest(cu), led, as_of(), path_only=True)
    out = ledger.claim(led, files, as_of())
    return out.select("feed", "remote_path", "status", "processed_chunks", "total_chunks", "error_message",
                      ts_str("started_at").alias("started_at"), ts_str("completed_at").alias("completed_at"))


# --- jobs (Q19, Q24, Q29, Q34) -------------------------------------------------------------

def jobs_from_orders(orders: DataFrame) -> DataFrame:
    return orders.select(F.col("o_orderkey").alias("id"),
                         F.concat(F.lit("onix/"), F.col("o_custkey").cast("string"), F.lit(".xml")).alias("file_key"),
                         _status().alias("status"), F.col("o_orderdate").alias("created_at"))


def onix_manifest(customer: DataFrame) -> DataFrame:
    return customer.select(F.concat(F.lit("onix/"), F.col("c_custkey").cast("string"), F.lit(".xml")).alias("file_key"))


def q_unprocessed_files(spark: SparkSession, sf: str) -> DataFrame:
    """Q19 (O-42): ONIX files without a live or finished job."""
    jobs = jobs_from_orders(load(spark, sf, "orders"))
    return ledger.unprocessed(onix_manifest(load(spark, sf, "customer")), jobs)


def q_trigger_guard(spark: SparkSession, sf: str) -> DataFrame:
    """Q19b (O-43): trigger requests split into accepted and rejected duplicates."""
    jobs = jobs_from_orders(load(spark, sf, "orders"))
    req = onix_manifest(load(spark, sf, "customer"))
    ok, dup = ledger.reject_duplicates(req, jobs)
    return ok.withColumn("decision", F.lit("accepted")).unionByName(dup.withColumn("decision", F.lit("rejected")))


def chunks_from_lineitem(lineitem: DataFrame) -> DataFrame:
    recs = lineitem.select(F.col("l_orderkey").alias("job_id"), F.col("l_linenumber").alias("chunk_index"),
                           (F.col("l_returnflag") == "R").alias("failed"))
    return ledger.chunk_outcome(recs)


def jobs_with_totals(orders: DataFrame, lineitem: DataFrame) -> DataFrame:
    n = lineitem.groupBy("l_orderkey").agg(F.countDistinct("l_linenumber").alias("n"))
    j = orders.join(n, orders.o_orderkey == n.l_orderkey, "left")
    return j.select(F.col("o_orderkey").alias("id"),
                    F.concat(F.lit("onix/"), F.col("o_orderkey").cast("string"), F.lit(".xml")).alias("file_key"),
                    F.lit("processing").alias("status"),
                    (F.coalesce(F.col("n"), F.lit(0)) + F.when(F.col("o_orderstatus") == "P", 1).otherwise(0))
                    .cast("long").alias("total_chunks"),
                    F.lit(None).cast("timestamp").alias("completed_at"))


def q_job_progress(spark: SparkSession, sf: str) -> DataFrame:
    """Q24 (O-50, O-51): chunk outcomes rolled up into job counters and status."""
    li, o = load(spark, sf, "lineitem"), load(spark, sf, "orders")
    out = ledger.job_progress(jobs_with_totals(o, li), chunks_from_lineitem(li), as_of())
    return out.select("id", "file_key", "status", "total_chunks", "processed_chunks", "failed_chunks",
                      "processed_books", ts_str("completed_at").alias("completed_at"))


def q_job_detail(spark: SparkSession, sf: str) -> DataFrame:
    """Q24b (O-48): each job with its chunks in order."""
    li, o = load(spark, sf, "lineitem"), load(spark, sf, "orders")
    d = ledger.job_detail(jobs_with_totals(o, li), chunks_from_lineitem(li))
    return d.select("id", F.array_join(F.transform("chunks", lambda x: F.concat(
        x["chunk_index"].cast("string"), F.lit(":"), x["status"])), ",").alias("chunk_list"))


def q_job_page(spark: SparkSession, sf: str) -> DataFrame:
    """Q29 (O-59): third page of 20, newest first (a top-k report)."""
    page = ledger.job_page(jobs_from_orders(load(spark, sf, "orders")), limit=20, offset=40)
    return page.select("id", "file_key", ts_str("created_at").alias("created_at"))


def q_latest_full_file(spark: SparkSession, sf: str) -> DataFrame:
    """Q29b (O-60): newest landed full ONIX file."""
    o = load(spark, sf, "orders")
    st = _status()
    led = o.select(
        F.when(F.col("o_orderpriority") == "3-MEDIUM", F.lit("biblio_full")).otherwise(F.lit("biblio_delta")).alias("feed"),
        F.concat(F.lit("/onix/"), F.col("o_orderkey").cast("string")).alias("remote_path"),
        st.alias("status"),
        F.when((st == "completed") & (F.col("o_orderkey") % 4 != 0),
               sc.landing_key(F.concat(F.lit("X_wk"), ((F.col("o_orderkey") % 52) + 1).cast("string"), F.lit("_Full.zip")),
                              "onix/", True)).alias("landing_key"),
        F.col("o_orderdate").alias("completed_at"))
    return ledger.latest(led)


def chunk_table(lineitem: DataFrame) -> DataFrame:
    ch = chunks_from_lineitem(lineitem)
    c = F.col
    status = F.when(c("job_id") % 5 == 0, F.lit("processing")).otherwise(c("status"))
    return ch.select("job_id", "chunk_index", status.alias("status"),
                     F.when((status != "completed") & (c("chunk_index") % 2 == 1),
                            F.concat(F.lit("chunks/"), c("job_id").cast("string"), F.lit("/"),
                                     c("chunk_index").cast("string"), F.lit(".json"))).alias("data_key"),
                     F.lit("err").alias("error_message"),
                     (as_of() - F.make_interval(F.lit(0), F.lit(0), F.lit(0), (c("job_id") % 60).cast("int")))
                     .alias("updated_at"))


def q_resume_plan(spark: SparkSession, sf: str) -> DataFrame:
    """Q34 (O-76): per job, chunks to requeue/resend and already completed."""
    return ledger.resume_plan(chunk_table(load(spark, sf, "lineitem")))


def q_retention_plan(spark: SparkSession, sf: str) -> DataFrame:
    """Q34b (O-77): failed chunk payloads past the retention window."""
    return ledger.retention_plan(chunk_table(load(spark, sf, "lineitem")), as_of()).select("job_id", "chunk_index")


# --- file ledger transitions (Q26) -----------------------------------------------------

def q_ledger_transitions(spark: SparkSession, sf: str) -> DataFrame:
    """Q26 (O-52, O-75, O-78): chunk results advance the ledger; completion is
    reported once, replays after completion are not."""
    o, li = load(spark, sf, "orders"), load(spark, sf, "lineitem")
    n = li.groupBy("l_orderkey").agg(F.count("*").alias("n"), F.count_if(F.col("l_linestatus") == "F").alias("nf"))
    j = o.join(n, o.o_orderkey == n.l_orderkey, "left").select(
        "o_orderkey", "o_orderstatus", "o_orderpriority",
        F.coalesce(F.col("n"), F.lit(0)).alias("n"), F.coalesce(F.col("nf"), F.lit(0)).alias("nf"))
    c = F.col
    st = _status(mapping={"F": "completed", "O": "processing", "P": "downloading"})
    path = F.concat(F.lit("f/"), c("o_orderkey").cast("string"))
    led = j.select(F.lit("onix").alias("feed"), path.alias("remote_path"), st.alias("status"),
                   F.when(c("o_orderstatus").isin("F", "O"), c("n")).cast("long").alias("total_chunks"),
                   F.when(c("o_orderstatus") == "F", c("n")).otherwise(F.lit(0)).cast("long").alias("processed_chunks"),
                   F.lit(None).cast("long").alias("row_count"), F.lit(None).cast("string").alias("error_message"),
                   F.when(c("o_orderstatus") == "F", days_before(1)).alias("completed_at"))
    res = j.select(F.lit("onix").alias("feed"), path.alias("remote_path"),
                   F.when(c("o_orderstatus").isin("O", "P"), c("nf"))
                   .when((c("o_orderstatus") == "F") & (c("o_orderpriority") == "2-HIGH"), F.lit(1))
                   .cast("long").alias("chunks_done"),
                   F.when(c("o_orderstatus") == "P", c("n")).cast("long").alias("total_chunks"),
                   F.when(c("o_orderstatus") == "P", c("n") * 100).cast("long").alias("row_count"),
                   F.when((c("o_orderstatus") == "P") & (c("o_orderpriority") == "1-URGENT"), F.lit("unreachable"))
                   .alias("error"))
    new, just = ledger.advance(led, res, as_of())
    flag = just.select("remote_path", F.lit(True).alias("__j"))
    out = new.join(flag, "remote_path", "left")
    return out.select("remote_path", "status", "processed_chunks", "total_chunks",
                      ts_str("completed_at").alias("completed_at"),
                      F.coalesce(F.col("__j"), F.lit(False)).alias("just_completed"))


# --- excerpts (Q07, Q25) -----------------------------------------------------------------

def write_excerpt_feed(spark: SparkSession, documents: DataFrame, rows_per_file: int = 50_000) -> str:
    """Excerpt feed documents, one JSON document per file, ``rows_per_file`` at most."""
    n_files = max(1, -(-documents.count() // rows_per_file))
    c = F.col
    ex = documents.select(
        F.pmod(F.xxhash64("doc_id"), F.lit(n_files)).cast("int").alias("file_no"),
        F.struct(
            isbn_of("978", "doc_id").alias("isbn13"),
            F.concat(F.lit("Doc "), c("doc_id").cast("string")).alias("title"),
            F.concat(F.lit("https://excerpts.example/"), c("doc_id").cast("string")).alias("url"),
            F.when(c("n_chars") % 3 == 0, F.lit(False)).when(c("n_chars") % 3 == 1, F.lit(None))
            .otherwise(F.lit(True)).cast("boolean").alias("available"),
            F.when(c("lang") == "de", F.lit("withdrawn")).otherwise(F.lit("added")).alias("update_reason"),
            F.concat(F.lit("2024-05-"), F.lpad(((c("doc_id") % 28) + 1).cast("string"), 2, "0"),
                     F.lit("T10:00:00Z")).alias("updated_at")).alias("e"))
    docs = ex.groupBy("file_no").agg(F.to_json(F.struct(
        F.create_map(F.lit("status"), F.lit("ok")).alias("response_header"),
        F.collect_list("e").alias("excerpts"))).alias("value"))
    path = stage_path(spark, "excerpts")
    docs.select("file_no", "value").repartition(n_files, "file_no").write.partitionBy("file_no").text(path)
    return path


def _excerpt_merge(spark: SparkSession, sf: str):
    docs, labels = load(spark, sf, "documents"), load(spark, sf, "labels")
    feed = src.read_excerpts(spark, write_excerpt_feed(spark, docs))
    books = labels.where(F.col("quality") == 1).select(isbn_of("978", "doc_id").alias("isbn13"))
    cur = labels.where(F.col("toxic") == 1).select(
        isbn_of("978", "doc_id").alias("isbn13"), F.lit("old").alias("title"), F.lit(None).cast("string").alias("url"),
        F.lit(True).alias("available"), F.lit(None).cast("timestamp").alias("jb_updated_at"),
        days_before(20).alias("fetched_at"), days_before(60).alias("created_at"))
    return enrich.merge_excerpts(cur, feed, books, as_of())


def q_excerpt_upsert(spark: SparkSession, sf: str) -> DataFrame:
    """Q07 (O-09, O-40, O-57, O-72): excerpt feed merged for our own ISBNs only."""
    table, _ = _excerpt_merge(spark, sf)
    return table.select("isbn13", "title", "url", "available", ts_str("jb_updated_at").alias("jb_updated_at"),
                        ts_str("fetched_at").alias("fetched_at"), ts_str("created_at").alias("created_at"))


def q_excerpt_counts(spark: SparkSession, sf: str) -> DataFrame:
    """Q07b (O-53): upserted / withdrawn / skipped counters of the run."""
    _, counts = _excerpt_merge(spark, sf)
    return counts


def q_excerpt_watermark(spark: SparkSession, sf: str) -> DataFrame:
    """Q25 (O-49, O-102): per event type, the delta feed's ``since`` with a 14-day floor."""
    e = load(spark, sf, "events")
    run_clock = F.lit("2024-01-20 00:00:00").cast("timestamp")
    wm = enrich.watermark(e, "ts", run_clock, by=["event_type"])
    return wm.select("event_type", ts_str("since").alias("since"), "full_load")


# --- covers (Q22, Q27, Q35, Q08) ----------------------------------------------------------

def contributors(lineitem: DataFrame, supplier: DataFrame) -> DataFrame:
    pairs = lineitem.select("l_partkey", "l_suppkey").distinct()
    j = pairs.join(supplier.select("s_suppkey", "s_name"), pairs.l_suppkey == supplier.s_suppkey)
    return j.select(ref_of("REF", "l_partkey").alias("record_reference"),
                    F.col("l_suppkey").cast("int").alias("sequence_number"),
                    F.when(F.col("l_suppkey") % 2 == 0, F.lit("A01")).otherwise(F.lit("B01")).alias("role"),
                    F.col("s_name").alias("person_name"))


def cover_books(part: DataFrame) -> DataFrame:
    c = F.col
    return part.select(
        ref_of("REF", "p_partkey").alias("record_reference"),
        F.when(c("p_size") % 7 == 0, F.lit(None)).otherwise(isbn_of("978", "p_partkey")).alias("isbn13"),
        F.concat_ws(" ", c("p_name"), c("p_partkey").cast("string")).alias("title"),
        F.when(c("p_size") % 5 == 0, F.concat(F.lit("https://cdn.example/old/"), c("p_partkey").cast("string"),
                                              F.lit(".jpg"))).alias("cover_url"),
        F.when(c("p_size") % 3 == 0, F.lit(None)).when(c("p_size") % 3 == 1, days_before(40))
        .otherwise(days_before(10)).alias("cover_checked_at"),
        F.when(c("p_partkey") % 4 == 0, F.lit(None)).when(c("p_partkey") % 4 == 1, days_before(45))
        .otherwise(days_before(5)).alias("cover_fetched_at"))


def q_authors_lookup_text(spark: SparkSession, sf: str) -> DataFrame:
    """Q22 (O-46, O-84): authors (A01, by sequence) of candidate books and the lookup query."""
    part, li, s = load(spark, sf, "part"), load(spark, sf, "lineitem"), load(spark, sf, "supplier")
    books = cover_books(part)
    cand = enrich.fallback_candidates(books, as_of())
    contrib = contributors(li, s).join(cand.select("record_reference"), "record_reference", "left_semi")
    authors = ordered_join(contrib, "record_reference", "person_name", ["sequence_number", "person_name"],
                           where=F.col("role") == "A01", alias="authors")
    first = (contrib.where(F.col("role") == "A01").groupBy("record_reference")
             .agg(F.min_by("person_name", F.struct("sequence_number", "person_name")).alias("first_author")))
    j = cand.join(authors, "record_reference", "left").join(first, "record_reference", "left")
    return j.select("record_reference", "authors",
                    sc.lookup_query(F.col("isbn13"), F.col("title"), F.col("first_author")).alias("query"))


def _cover_pass(spark: SparkSession, sf: str):
    part = load(spark, sf, "part")
    books = cover_books(part)
    k = F.regexp_extract("record_reference", "([0-9]+)$", 1).cast("long")
    w = enrich.wholesaler_candidates(books, as_of())
    w_out = w.select("record_reference", F.when(k % 3 == 0, F.lit("fetched")).when(k % 3 == 1, F.lit("notFound"))
                     .otherwise(F.lit("error")).alias("outcome"))
    after_w = enrich.apply_wholesaler_outcomes(books, w_out, as_of(), "https://cdn.example/")
    f = enrich.fallback_candidates(after_w, as_of())
    f_out = f.select("record_reference",
                     F.when(k % 4 == 0, F.lit("fetched")).when(k % 4 == 1, F.lit("notFound"))
                     .otherwise(F.lit("error")).alias("outcome"),
                     F.when(k % 4 == 0, F.concat(F.lit("https://cdn.example/covers/"),
                                                 F.coalesce(F.col("isbn13"), F.concat(F.lit("vol"), k.cast("string"))),
                                                 F.lit(".jpg"))).alias("url"))
    final = enrich.apply_fallback_outcomes(after_w, f_out, as_of())
    outcomes = (w_out.withColumn("source", F.lit("wholesaler")).select("source", "outcome")
                .unionByName(f_out.withColumn("source", F.lit("fallback")).select("source", "outcome")))
    return final, outcomes


def q_cover_candidates(spark: SparkSession, sf: str) -> DataFrame:
    """Q27 (O-86 … O-88, O-103): wholesaler pass, then fallback on what it missed."""
    final, _ = _cover_pass(spark, sf)
    return final.select("record_reference", "cover_url", ts_str("cover_checked_at").alias("cover_checked_at"),
                        ts_str("cover_fetched_at").alias("cover_fetched_at"))


def q_cover_outcome_counts(spark: SparkSession, sf: str) -> DataFrame:
    """Q27b (O-53): run counters per pass and outcome."""
    _, outcomes = _cover_pass(spark, sf)
    return outcomes.groupBy("source", "outcome").count()


def q_keys_and_urls(spark: SparkSession, sf: str) -> DataFrame:
    """Q35 (O-80 … O-83): cover URL rewrite, volume id, safe file names, keys."""
    p = load(spark, sf, "pages")
    isbn = isbn_of("978", "page_id")
    fname = F.regexp_extract("url", "^[a-z]+://[^/]+(/[^?#]*)", 1)
    return p.select(
        "page_id",
        sc.high_res_cover_url("url").alias("cover_url"),
        sc.volume_id(F.concat(F.col("url"), F.lit("&id=v"), F.col("page_id").cast("string"))).alias("volume_id"),
        sc.safe_filename(fname, F.col("page_id")).alias("safe_name"),
        sc.feed_week(F.concat(F.lit("X_wk"), (F.col("page_id") % 53).cast("string"), F.lit("_Delta.zip"))).alias("week"),
        sc.public_url("https://cdn.example/", sc.cover_key(isbn)).alias("public_url"),
        sc.remote_cover_path(isbn).alias("remote_path"),
        sc.image_ext(F.when(F.col("url").contains(".html"), F.lit("image/png"))
                     .when(F.col("url").contains("#"), F.lit("image/jpeg"))).alias("image_ext"),
    )


def _write_cover_zips(spark: SparkSession, part: DataFrame, per_archive: int = 20_000) -> str:
    """Cover archives of at most ``per_archive`` images each (one group per archive)."""
    n_files = max(4, -(-part.count() // per_archive))
    path = stage_path(spark, "covers")
    fs, root = arrow_fs(path)
    fs.create_dir(root, recursive=True)
    rows = part.select(F.pmod(F.col("p_partkey"), F.lit(n_files)).cast("int").alias("file_no"),
                       isbn_of("978", "p_partkey").alias("isbn13"), F.col("p_size").alias("size"))
    target = path

    def write(pdf: pd.DataFrame) -> pd.DataFrame:
        k = int(pdf["file_no"].iloc[0])
        name = f"{target}/BookImages_wk{k + 1}.zip"
        buf = io.BytesIO()
        with zipfile.ZipFile(buf, "w") as z:
            z.writestr("readme.txt", b"covers")
            for isbn, size in zip(pdf["isbn13"], pdf["size"]):
                z.writestr(f"images/{isbn}.jpg", b"\xff" * int(size))
            z.writestr(f"images/bad{k}.jpg", b"\xff")
        f2, p2 = arrow_fs(name)
        with f2.open_output_stream(p2) as out:
            out.write(buf.getvalue())
        return pd.DataFrame({"file_no": [k], "entries": [len(pdf)]})

    rows.groupBy("file_no").applyInPandas(write, "file_no int, entries long").collect()
    return path


def q_cover_archive_index(spark: SparkSession, sf: str) -> DataFrame:
    """Q08 (O-03, O-10, O-38): zip directories listed without reading images."""
    path = _write_cover_zips(spark, load(spark, sf, "part"))
    manifest = src.list_files(spark, path, suffix=".zip")
    ok, _ = src.split_oversize(manifest)
    idx = enrich.index_archives(ok)
    return idx.select("isbn13", F.regexp_extract("archive", "([^/]*)$", 1).alias("archive"), "size")


def q_replay_guard(spark: SparkSession, sf: str) -> DataFrame:
    """O-78: chunk batches of a run minus those the ledger already applied
    (a retried chunk is not counted twice)."""
    li, o = load(spark, sf, "lineitem"), load(spark, sf, "orders")
    batches = li.select((F.col("l_orderkey") * 10 + F.col("l_linenumber")).alias("batch_id")).distinct()
    applied = (li.join(o.where(F.col("o_orderstatus") == "F").select("o_orderkey"),
                       F.col("l_orderkey") == F.col("o_orderkey"), "left_semi")
               .select((F.col("l_orderkey") * 10 + F.col("l_linenumber")).alias("batch_id")))
    return ledger.not_yet_applied(batches, applied)


def q_resume_chunks(spark: SparkSession, sf: str) -> DataFrame:
    """O-76: chunk rows after a resume — resendable chunks back to pending."""
    out = ledger.resume_chunks(chunk_table(load(spark, sf, "lineitem")))
    return out.select("job_id", "chunk_index", "status", "error_message")
