"""Streaming and bootstrap queries (S01-S03): files written from the test
tables, picked up by ``availableNow`` streams, tables read back."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from quire.plans import adapters
from quire.plans.books import book_rows, onix_file_count
from quire.plans.catalog import stock_current, stock_view
from quire.plans.common import AS_OF, isbn_of, load
from quire.plans.feeds import _csv, avail_file_count, write_feed, write_named
from quire.session import hadoop_fs, spread, stage_path
from quire.sources.store import read_table, rename_single_parts, write_framed_text, write_table
from quire.streaming import jobs


BATCHES = 4     # micro-batches that take in what waits: each rewrites the buckets it touches, so their number must not grow


def _files_a_batch(n_files: int) -> int:
    return max(1, -(-n_files // BATCHES))


def _move_into(spark: SparkSession, files: list[str], target: str, start_ms: int | None = None) -> None:
    """Move ``files`` into the watched folder; with ``start_ms`` their times rise in this order."""
    fs, t = hadoop_fs(spark, target)
    fs.mkdirs(t)
    jvm = spark.sparkContext._jvm
    for i, f in enumerate(files):
        src = jvm.org.apache.hadoop.fs.Path(f)
        dst = jvm.org.apache.hadoop.fs.Path(f"{target}/{src.getName()}")
        if start_ms is not None:
            fs.setTimes(src, start_ms + i * 1000, -1)
        fs.rename(src, dst)


def q_onix_ingest(spark: SparkSession, sf: str) -> DataFrame:
    """Flagship (O-01 … O-24, O-62 … O-65): ONIX feed files scanned, typed and merged."""
    from quire.plans.books import onix_ingest
    return onix_ingest(spark, sf)


def q_stream_onix_merge(spark: SparkSession, sf: str) -> DataFrame:
    """S01 (O-98): each new ONIX file merged once by an ``availableNow`` stream."""
    part = load(spark, sf, "part")
    store = stage_path(spark, "store-onix")
    write_table(adapters.books_from_part(part), f"{store}/books", bucket_col="record_reference", buckets=8)
    staged = stage_path(spark, "onix-stream-files")
    n_files = onix_file_count(part)
    write_framed_text(adapters.product_fragments(part, n_files=n_files), staged, n_files, adapters.ONIX_HEAD, adapters.ONIX_TAIL)
    files = rename_single_parts(spark, staged, {str(k): f"onix-{k}.xml" for k in range(n_files)})
    watched = stage_path(spark, "onix-in")
    _move_into(spark, files, watched)
    q = jobs.stream_onix(spark, watched, store, stage_path(spark, "ckpt-onix"), AS_OF, max_files_per_trigger=_files_a_batch(n_files))
    q.awaitTermination()
    return book_rows(read_table(spark, f"{store}/books")).drop("removed_at")


def avail_lines(events: DataFrame, n: int, nf: int) -> DataFrame:
    c = F.col
    isbn = F.when(c("event_type") == "error", F.concat(F.lit("SKU"), c("event_id").cast("string"))) \
        .otherwise(isbn_of("979", "user_id"))
    qty = F.when(c("event_type") == "view", F.lit("")).otherwise(F.get_json_object("props", "$.k"))
    return events.select(F.floor(c("event_id") * nf / F.lit(n)).cast("int").alias("k"), c("event_id").alias("seq"),
                         _csv(isbn, qty).alias("line"))


def q_stream_stock_merge(spark: SparkSession, sf: str) -> DataFrame:
    """S02 (O-99, O-100): hourly stock files, oldest first, merged under the gate."""
    ev = load(spark, sf, "events")
    store = stage_path(spark, "store-stock")
    write_table(stock_current(load(spark, sf, "customer")), f"{store}/stock", bucket_col="isbn13", buckets=8)
    n = ev.count()
    nf = avail_file_count(ev)
    lines = avail_lines(ev, n, nf)
    k = F.col("k")
    names = {i: f"AV_20240101.{i:03d}" for i in range(nf)}
    heads = {i: ["START,20240101" if i == 0 else "UPDATE,20240101"] for i in range(nf)}
    path = write_named(spark, lines.where((k >= 0) & (k < nf)).select(k.alias("file_no"), "seq", "line"), "avail", names, heads)
    watched = stage_path(spark, "avail-in")
    _move_into(spark, [f"{path}/{names[i]}" for i in range(nf)], watched, start_ms=1_700_000_000_000)

    def stamp(file_name):
        seq = F.regexp_extract(file_name, r"\.([0-9]{3})$", 1).cast("int")
        return F.lit("2024-02-01 06:00:00").cast("timestamp") + F.make_interval(
            F.lit(0), F.lit(0), F.lit(0), F.lit(0), seq)

    q = jobs.stream_stock(spark, watched, store, stage_path(spark, "ckpt-stock"), ts=stamp, max_files_per_trigger=_files_a_batch(nf))
    q.awaitTermination()
    return stock_view(read_table(spark, f"{store}/stock"))


def q_bootstrap_status(spark: SparkSession, sf: str) -> DataFrame:
    """S03 (O-104): books first, then each feed on its own; a missing feed fails
    alone."""
    part, nation = spread(load(spark, sf, "part")), load(spark, sf, "nation")
    store = stage_path(spark, "store-boot")
    write_table(adapters.books_from_part(part), f"{store}/books")
    onix = stage_path(spark, "boot-onix")
    n_files = onix_file_count(part)
    write_framed_text(adapters.product_fragments(part, n_files=n_files), onix, n_files, adapters.ONIX_HEAD, adapters.ONIX_TAIL)
    regions = nation.select(F.col("n_nationkey").cast("long").alias("seq"),
                            _csv(F.concat(F.lit("R"), F.col("n_regionkey").cast("string")), F.col("n_name")).alias("line"))
    reg_path = write_feed(spark, regions, "REGIONS.CSV")
    feeds = {"regions": reg_path, "firm_sale": f"{store}/missing/FIRMSALE13.CSV"}
    return jobs.bootstrap(spark, onix, feeds, store, AS_OF).select("feed", "status", "rows")
