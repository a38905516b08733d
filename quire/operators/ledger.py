"""Ingestion bookkeeping as set operations (O-41 … O-43, O-48 … O-52, O-59, O-60,
O-73, O-75 … O-78, O-101).

Ledgers are small tables (one row per file, job or chunk); every rule is an
anti/semi join or a grouped count, so a run decides for all files at once.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from quire.operators.merge import upsert

# Fixed values of the bookkeeping rules.
STALE_CLAIM_HOURS = 3
RETENTION_DAYS = 30


def _ts(x) -> Column:
    return x if isinstance(x, Column) else F.lit(x).cast("timestamp")


def blocking_claims(ledger: DataFrame, as_of, stale_hours: int = STALE_CLAIM_HOURS) -> DataFrame:
    """O-101: ledger rows that block a re-claim — completed, or live (not failed and
    started less than ``stale_hours`` ago)."""
    threshold = _ts(as_of) - F.make_interval(F.lit(0), F.lit(0), F.lit(0), F.lit(0), F.lit(stale_hours))
    live = (F.col("status") != "failed") & (F.col("started_at") > threshold)
    return ledger.where((F.col("status") == "completed") | F.coalesce(live, F.lit(False)))


def unclaimed(manifest: DataFrame, ledger: DataFrame, as_of, stale_hours: int = STALE_CLAIM_HOURS,
              path_only: bool = False) -> DataFrame:
    """O-41: manifest files not blocked by the ledger.

    The ledger key is (feed, path, mtime, size) so a re-published fixed-name file
    is picked up again; ``path_only=True`` keys on (feed, path) alone.
    """
    block = blocking_claims(ledger, as_of, stale_hours)
    m = manifest.select("*")
    if path_only:
        on = [m["feed"] == block["feed"], m["path"] == block["remote_path"]]
    else:
        on = [m["feed"] == block["feed"], m["path"] == block["remote_path"],
              m["modified_at"].eqNullSafe(block["remote_modified_at"]), m["size"] == block["remote_size"]]
    return m.join(block, on, "left_anti")


LEDGER_RESET = {
    "landing_key": None, "total_chunks": None, "row_count": None, "error_message": None, "completed_at": None,
}


def claim(ledger: DataFrame, files: DataFrame, as_of) -> DataFrame:
    """O-73: claim files — upsert on (feed, path) resetting counters, error and times."""
    ts = _ts(as_of)
    new = files.select(
        "feed", F.col("path").alias("remote_path"), F.col("filename").alias("remote_filename"),
        F.col("modified_at").alias("remote_modified_at"), F.col("size").alias("remote_size"),
        F.lit("downloading").alias("status"),
        *[F.lit(None).cast(ledger.schema[c].dataType).alias(c) for c in LEDGER_RESET],
        F.lit(0).cast(ledger.schema["processed_chunks"].dataType).alias("processed_chunks"),
        ts.alias("started_at"))
    keep = [c for c in ledger.columns if c not in new.columns]
    return upsert(ledger, new, ["feed", "remote_path"], keep=keep) if keep else \
        upsert(ledger, new, ["feed", "remote_path"])


def unprocessed(manifest: DataFrame, jobs: DataFrame, key: str = "file_key") -> DataFrame:
    """O-42: files with no job, or only failed jobs."""
    active = jobs.where(F.col("status") != "failed").select(key)
    return manifest.join(active, key, "left_anti")


def reject_duplicates(requests: DataFrame, jobs: DataFrame, key: str = "file_key") -> tuple[DataFrame, DataFrame]:
    """O-43: ``(accepted, rejected)`` trigger requests — rejected when a non-failed job exists."""
    active = jobs.where(F.col("status") != "failed").select(key).distinct()
    return requests.join(active, key, "left_anti"), requests.join(active, key, "left_semi")


def chunk_outcome(records: DataFrame, keys=("job_id", "chunk_index"), failed: str = "failed") -> DataFrame:
    """O-51: a chunk fails only when every record failed (an empty chunk counts as failed)."""
    return records.groupBy(*keys).agg(
        F.count("*").alias("book_count"),
        F.count_if(F.col(failed)).alias("failed_books"),
    ).select(*keys, "book_count", (F.col("book_count") - F.col("failed_books")).alias("processed_books"),
             "failed_books",
             F.when(F.col("failed_books") == F.col("book_count"), F.lit("failed"))
             .otherwise(F.lit("completed")).alias("status"))


def job_progress(jobs: DataFrame, chunks: DataFrame, as_of, key: str = "job_id") -> DataFrame:
    """O-50: counters of each job from its processed chunks; a job completes when
    every chunk is processed, even with failed chunks."""
    ts = _ts(as_of)
    done = chunks.where(F.col("status").isin("completed", "failed"))
    agg = done.groupBy(key).agg(
        F.count("*").alias("__pc"),
        F.sum("processed_books").alias("__pb"),
        F.count_if(F.col("failed_books") > 0).alias("__fc"))
    j = jobs.join(agg, jobs["id"] == agg[key], "left")
    pc = F.coalesce(F.col("__pc"), F.lit(0))
    complete = F.coalesce(pc == F.col("total_chunks"), F.lit(False))
    return j.select(
        "id", "file_key",
        F.when(complete, F.lit("completed")).otherwise(F.col("status")).alias("status"),
        "total_chunks", pc.alias("processed_chunks"),
        F.coalesce(F.col("__fc"), F.lit(0)).alias("failed_chunks"),
        F.coalesce(F.col("__pb"), F.lit(0)).alias("processed_books"),
        F.when(complete, ts).otherwise(F.col("completed_at")).alias("completed_at"))


def job_detail(jobs: DataFrame, chunks: DataFrame, key: str = "job_id") -> DataFrame:
    """O-48: each job with its chunks in chunk order (a job has a bounded number of chunks)."""
    c = chunks.groupBy(key).agg(F.array_sort(F.collect_list(F.struct("chunk_index", "status"))).alias("chunks"))
    return jobs.join(c, jobs["id"] == c[key], "left").drop(key)


def job_page(jobs: DataFrame, limit: int = 20, offset: int = 0) -> DataFrame:
    """O-59: newest first (id breaks ties); limit 1..100."""
    limit = max(1, min(100, int(limit)))
    return jobs.orderBy(F.col("created_at").desc(), F.col("id").desc()).offset(int(offset)).limit(limit)


def latest(ledger: DataFrame, feed: str = "biblio_full", by: str = "completed_at") -> DataFrame:
    """O-60: newest completed landed file of a feed (B9: newest by time, not by name)."""
    done = ledger.where((F.col("feed") == feed) & (F.col("status") == "completed") & F.col("landing_key").isNotNull())
    return done.agg(F.max_by("landing_key", F.struct(F.col(by), F.col("remote_path"))).alias("landing_key"))


def advance(ledger: DataFrame, results: DataFrame, as_of) -> tuple[DataFrame, DataFrame]:
    """O-52 / O-75: apply one run's results to the file ledger.

    ``results`` (per feed, remote_path): ``chunks_done`` processed this run,
    ``total_chunks``/``row_count`` when chunking finished this run, ``error``.
    A failure marks the file failed; a file reaching ``processed = total`` (or
    chunked into zero chunks) completes. Returns the new ledger and the files
    that completed in this run (exactly once: completed now, not before).
    """
    ts = _ts(as_of)
    r = results.select("feed", "remote_path", F.col("chunks_done").alias("__done"),
                       F.col("total_chunks").alias("__total"), F.col("row_count").alias("__rows"),
                       F.col("error").alias("__err"))
    j = ledger.join(r, ["feed", "remote_path"], "left")
    total = F.coalesce(F.col("__total"), F.col("total_chunks"))
    processed = F.col("processed_chunks") + F.coalesce(F.col("__done"), F.lit(0))
    touched = F.col("__done").isNotNull() | F.col("__total").isNotNull() | F.col("__err").isNotNull()
    reaches = total.isNotNull() & ((total == 0) | (processed == total))
    new_status = (F.when(~touched, F.col("status"))
                  .when(F.col("__err").isNotNull(), F.lit("failed"))
                  .when(F.col("status") == "completed", F.lit("completed"))
                  .when(reaches, F.lit("completed"))
                  .when(F.col("__total").isNotNull(), F.lit("processing"))
                  .otherwise(F.col("status")))
    out_cols = []
    for c in ledger.columns:
        if c == "status":
            out_cols.append(new_status.alias(c))
        elif c == "processed_chunks":
            out_cols.append(processed.cast(ledger.schema[c].dataType).alias(c))
        elif c == "total_chunks":
            out_cols.append(total.cast(ledger.schema[c].dataType).alias(c))
        elif c == "row_count":
            out_cols.append(F.coalesce(F.col("__rows"), F.col(c)).cast(ledger.schema[c].dataType).alias(c))
        elif c == "error_message":
            out_cols.append(F.coalesce(F.col("__err"), F.col(c)).alias(c))
        elif c == "completed_at":
            out_cols.append(F.when((F.col("status") != "completed") & (new_status == "completed"), ts)
                            .otherwise(F.col(c)).alias(c))
        else:
            out_cols.append(F.col(c))
    new = j.select(*out_cols, F.col("status").alias("__prev"))
    just = new.where((F.col("__prev") != "completed") & (F.col("status") == "completed")).drop("__prev")
    return new.drop("__prev"), just


def not_yet_applied(batches: DataFrame, applied: DataFrame, key: str = "batch_id") -> DataFrame:
    """O-78: replayed batches (already in the applied ledger) are skipped."""
    return batches.join(applied.select(key).distinct(), key, "left_anti")


def resume_plan(chunks: DataFrame, key: str = "job_id") -> DataFrame:
    """O-76: per job, chunks to requeue (not completed; those without payload are
    counted but cannot be re-sent) and chunks already completed."""
    inc = F.col("status") != "completed"
    return chunks.groupBy(key).agg(
        F.count_if(inc).alias("requeued"),
        F.count_if(inc & F.col("data_key").isNotNull()).alias("resent"),
        F.count_if(~inc).alias("already_completed"))


def resume_chunks(chunks: DataFrame) -> DataFrame:
    """O-76: the chunk rows after a resume — resent chunks go back to pending, error cleared."""
    resend = (F.col("status") != "completed") & F.col("data_key").isNotNull()
    return chunks.withColumns({
        "status": F.when(resend, F.lit("pending")).otherwise(F.col("status")),
        "error_message": F.when(resend, F.lit(None)).otherwise(F.col("error_message")),
    })


def retention_plan(chunks: DataFrame, as_of, days: int = RETENTION_DAYS) -> DataFrame:
    """O-77: failed chunks still holding a payload, last updated before the cutoff."""
    cutoff = _ts(as_of) - F.make_interval(F.lit(0), F.lit(0), F.lit(0), F.lit(days))
    return chunks.where((F.col("status") == "failed") & F.col("data_key").isNotNull()
                        & (F.col("updated_at") < cutoff))
