"""Excerpt links and covers (O-10, O-40, O-49, O-53, O-72, O-86 … O-88, O-103)."""

from __future__ import annotations

import zipfile
from collections.abc import Iterator

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from quire.functions.scalars import cover_key, public_url, valid_isbn13
from quire.operators.merge import upsert
from quire.session import arrow_fs

# Fixed values of the enrichment rules.
WATERMARK_LOOKBACK_DAYS = 14
COVER_RETRY_DAYS = 30


def _ts(x) -> Column:
    return x if isinstance(x, Column) else F.lit(x).cast("timestamp")


def _days(n: int) -> Column:
    return F.make_interval(F.lit(0), F.lit(0), F.lit(0), F.lit(n))


# --- excerpts ---------------------------------------------------------------------------

def owned(rows: DataFrame, owners: DataFrame, on: str = "isbn13") -> tuple[DataFrame, DataFrame]:
    """O-40: ``(kept, skipped)`` — rows whose key is held by ``owners``."""
    keys = owners.select(on).where(F.col(on).isNotNull()).distinct()
    return rows.join(keys, on, "left_semi"), rows.join(keys, on, "left_anti")


def excerpt_rows(feed: DataFrame, as_of) -> DataFrame:
    """O-72 row rule: withdrawn -> unavailable, else the given flag, else available."""
    available = F.when(F.col("update_reason") == "withdrawn", F.lit(False)).otherwise(
        F.coalesce(F.col("available"), F.lit(True)))
    return feed.select(
        "isbn13", "title", "url", available.alias("available"),
        F.trim("updated_at").try_cast("timestamp").alias("jb_updated_at"),   # any ISO form
        _ts(as_of).alias("fetched_at"),
        F.struct(F.col("file_mtime"), F.col("source_file"), F.col("pos")).alias("arrival"))


def merge_excerpts(current: DataFrame, feed: DataFrame, books: DataFrame, as_of) -> tuple[DataFrame, DataFrame]:
    """O-40 + O-72: keep excerpts of our own ISBNs, upsert by ISBN (last in feed
    order wins). Returns ``(table, counts)``; counts (O-53) = upserted, withdrawn,
    skipped."""
    rows = excerpt_rows(feed, as_of)
    kept, skipped = owned(rows, books)
    table = upsert(current, kept, "isbn13", order="arrival", keep=["created_at"],
                   on_insert={"created_at": _ts(as_of)}).drop("arrival")
    counts = (kept.select(F.when(F.col("available"), F.lit("upserted")).otherwise(F.lit("withdrawn")).alias("outcome"))
              .unionByName(skipped.select(F.lit("skipped").alias("outcome")))
              .groupBy("outcome").count())
    return table, counts


def watermark(table: DataFrame, ts: str, as_of, lookback_days: int = WATERMARK_LOOKBACK_DAYS,
              by: list[str] | None = None) -> DataFrame:
    """O-49 / O-102: ``since`` = latest ``ts`` but never older than ``as_of - lookback``;
    an empty table means a full load (``since`` null, ``full_load`` true)."""
    floor = _ts(as_of) - _days(lookback_days)
    agg = table.groupBy(*(by or [])).agg(F.max(ts).alias("__m"))
    return agg.select(*(by or []), F.when(F.col("__m").isNull(), F.lit(None))
                      .otherwise(F.greatest(F.col("__m"), floor)).alias("since"),
                      F.col("__m").isNull().alias("full_load"))


def merge_excerpt_delta(current: DataFrame, feed: DataFrame, books: DataFrame, as_of) -> tuple[DataFrame, DataFrame]:
    """O-102: a delta run. Feed rows updated since the watermark (the latest
    ``fetched_at``, at most 14 days back) are merged; rows without a time count as
    new. An empty table takes the whole feed. Returns what ``merge_excerpts`` does."""
    since = watermark(current, "fetched_at", as_of).select("since")      # one row
    at = F.trim("updated_at").try_cast("timestamp")
    fresh = feed.join(F.broadcast(since), F.col("since").isNull() | at.isNull() | (at >= F.col("since"))).drop("since")
    return merge_excerpts(current, fresh, books, as_of)


# --- covers -----------------------------------------------------------------------------

def wholesaler_candidates(books: DataFrame, as_of, retry_days: int = COVER_RETRY_DAYS) -> DataFrame:
    """O-86: ISBN known and never checked, or still without cover and checked
    more than ``retry_days`` ago."""
    old = _ts(as_of) - _days(retry_days)
    c = F.col
    return books.where(c("isbn13").isNotNull() & (
        c("cover_checked_at").isNull() | (c("cover_url").isNull() & (c("cover_checked_at") < old))))


def fallback_candidates(books: DataFrame, as_of, retry_days: int = COVER_RETRY_DAYS) -> DataFrame:
    """O-87: no cover; no ISBN or the wholesaler already looked; never tried or
    tried more than ``retry_days`` ago."""
    old = _ts(as_of) - _days(retry_days)
    c = F.col
    return books.where(c("cover_url").isNull()
                       & (c("isbn13").isNull() | c("cover_checked_at").isNotNull())
                       & (c("cover_fetched_at").isNull() | (c("cover_fetched_at") < old)))


def apply_wholesaler_outcomes(books: DataFrame, outcomes: DataFrame, as_of, base_url: str,
                              key: str = "record_reference") -> DataFrame:
    """O-88: found covers get the public URL of ``covers/<isbn>.jpg``; every probed
    book (found, missing or failed) gets its check stamp."""
    o = outcomes.select(key, F.col("outcome").alias("__o"))
    j = books.join(o, key, "left")
    probed = F.col("__o").isNotNull()
    cols = []
    for c in books.columns:
        if c == "cover_url":
            cols.append(F.when(F.col("__o") == "fetched", public_url(base_url, cover_key(F.col("isbn13"))))
                        .otherwise(F.col(c)).alias(c))
        elif c == "cover_checked_at":
            cols.append(F.when(probed, _ts(as_of)).otherwise(F.col(c)).alias(c))
        else:
            cols.append(F.col(c))
    return j.select(*cols)


def apply_fallback_outcomes(books: DataFrame, outcomes: DataFrame, as_of, key: str = "record_reference") -> DataFrame:
    """O-88 (fallback): the URL found (possibly none) replaces ``cover_url``; errors
    leave it; every try, failed or not, is stamped in ``cover_fetched_at``."""
    o = outcomes.select(key, F.col("outcome").alias("__o"), F.col("url").alias("__u"))
    j = books.join(o, key, "left")
    done = F.col("__o").isin("fetched", "notFound")
    cols = []
    for c in books.columns:
        if c == "cover_url":
            cols.append(F.when(done, F.col("__u")).otherwise(F.col(c)).alias(c))
        elif c == "cover_fetched_at":
            cols.append(F.when(F.col("__o").isNotNull(), _ts(as_of)).otherwise(F.col(c)).alias(c))
        else:
            cols.append(F.col(c))
    return j.select(*cols)


def index_archives(paths: DataFrame, path_col: str = "path") -> DataFrame:
    """O-10: directory of each cover zip -> ``archive, isbn13, size`` (non-ISBN
    entries skipped). Reads only the zip directory (a seekable Arrow file on any
    Hadoop/S3/local URI), never the images, so a multi-GB archive costs a few
    seeks; archives spread over tasks like any rows."""
    schema = T.StructType([T.StructField("archive", T.StringType()), T.StructField("isbn13", T.StringType()),
                           T.StructField("size", T.LongType())])

    def run(it: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in it:
            rows = []
            for p in pdf[path_col]:
                fs, inner = arrow_fs(p)
                with fs.open_input_file(inner) as fh, zipfile.ZipFile(fh) as z:
                    for info in z.infolist():
                        if info.is_dir():
                            continue
                        base = info.filename.rsplit("/", 1)[-1]
                        stem = base[:-5] if base.lower().endswith(".jpeg") else (
                            base[:-4] if base.lower().endswith(".jpg") else base)
                        rows.append((p, stem, info.file_size))
            yield pd.DataFrame(rows, columns=["archive", "isbn13", "size"])

    out = paths.select(path_col).mapInPandas(run, schema)
    return out.where(valid_isbn13("isbn13"))
