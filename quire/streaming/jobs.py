"""Incremental jobs on Structured Streaming (O-98 … O-104).

Each new file is picked up once by the file source (its checkpoint records
what was read); ``foreachBatch`` runs the same batch operators and rewrites the
hash buckets that the file touches of each table it feeds. A replayed batch id is skipped (O-78), and
the merges are idempotent, so a job that dies between two tables, or before the
batch ledger, repeats safely.
"""

from __future__ import annotations

from collections.abc import Callable, Mapping

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from quire.operators import feeds as fm
from quire.operators import merge, quality
from quire.operators.products import project_products
from quire.schemas import BOOK_FIELDS
from quire.session import bounded_broadcast, cut_lineage, hadoop_fs
from quire.sources import feeds as src
from quire.sources import lookups
from quire.sources import store as tables
from quire.sources.onix import file_columns, parse_onix_once, scan_onix_once, with_arrival
from quire.sources.store import read_table


def _applied(spark: SparkSession, store: str, job: str, batch_id: int) -> bool:
    """O-78: was this batch id already applied? (a filtered lookup, nothing collected)"""
    fs, path = hadoop_fs(spark, f"{store}/_batches_{job}")
    return fs.exists(path) and read_batches(spark, store, job).where(F.col("batch_id") == batch_id).limit(1).count() > 0


def read_batches(spark: SparkSession, store: str, job: str) -> DataFrame:
    """The batch ids that a job has applied."""
    return spark.read.schema("batch_id long").parquet(f"{store}/_batches_{job}")


def _record_batch(spark: SparkSession, store: str, job: str, batch_id: int) -> None:
    """Append the batch id to the job's batch ledger."""
    spark.range(batch_id, batch_id + 1, 1, 1).toDF("batch_id").write.mode("append").parquet(f"{store}/_batches_{job}")


CHILDREN = {"contributors": "book_contributors", "subjects": "book_subjects", "prices": "book_prices"}

# Columns of a book that no product carries.
_BOOK_STATE = {"embedded_at": "timestamp", "embedding": "array<float>", "cover_url": "string",
               "cover_fetched_at": "timestamp", "cover_checked_at": "timestamp", "is_removed": "boolean",
               "removed_at": "timestamp", "created_at": "timestamp", "updated_at": "timestamp"}


def _stored(spark: SparkSession, root: str, like: DataFrame) -> DataFrame:
    """The table at ``root``, or an empty one with the columns of ``like``."""
    found = read_table(spark, root)
    return like.limit(0) if found is None else found


def _update(spark: SparkSession, root: str, key: str, touched: DataFrame | None, like: DataFrame,
            merged: Callable[[DataFrame], DataFrame], bloom: tuple[str, ...] = ()) -> None:
    """Merge a run into the table at ``root``: only the buckets of the ``touched`` keys are
    read and written (all of them for None). Lookups by other columns (``sources.lookups``) are kept up."""
    n = tables.open_buckets(spark, root, key, like, bloom)
    only = list(range(n)) if touched is None else tables.touched_buckets(touched, key, n)
    if only:
        held = tables.read_buckets(spark, root, only)
        current = like.limit(0) if held is None else held
        after = merged(current)
        by = lookups.columns(spark, root)
        if by:          # the old rows' files go when the buckets are replaced
            current, after = cut_lineage(current.select(key, *by)), cut_lineage(after)
        for column in by:
            lookups.add_entries(current, after, root, column, key)
        tables.replace_buckets(after, root, key, only, n, bloom)
        for column in by:
            lookups.drop_entries(current, after, root, column, key)


def _count(spark: SparkSession, root: str) -> int:
    found = read_table(spark, root)
    return 0 if found is None else found.count()


def _keep_run(df: DataFrame, root: str, run: str) -> None:
    """Rows of one run in a folder of its own: a repeated run replaces its rows."""
    df.write.mode("overwrite").parquet(f"{root}/run={run}")


def ingest_products(spark: SparkSession, records: DataFrame, store: str, as_of, run: str) -> None:
    """One run of ONIX records, good and broken ones (``onix.parse_onix_once``), into every
    table they feed (O-62 ... O-69, O-74).

    Good products are merged into ``books``; the last notice of each book
    replaces its rows in ``book_contributors``, ``book_subjects`` and ``book_prices``, and
    in ``book_genres`` if it has scheme-93 subjects; new genres are added. Broken fragments and files and
    rejected products go to ``rejects`` with their reasons, counts per file to
    ``summaries`` (each a folder per run). Tables that are missing are started.
    Delete notices are not held to the catalogue's constraints."""
    found = cut_lineage(project_products(records, reason="reason"))      # parsed once, read by every step below
    products = found.where(F.col("reason").isNull()).drop("reason", "fragment")
    corrupt = found.where(F.col("reason").isNotNull()).select("source_file", "reason", "fragment")
    state = {c: F.lit(None).cast(t).alias(c) for c, t in _BOOK_STATE.items()}
    books = _stored(spark, f"{store}/books", products.select(*BOOK_FIELDS, *state.values()))

    is_delete = F.col("notification_type") == "05"
    news = products.where(~is_delete)
    held = news.where(F.col("isbn13").isNotNull())
    held = held.join(quality.isbn_holders(held, books), "isbn13", "left").select(*products.columns, "__holder")
    plain = news.where(F.col("isbn13").isNull()).withColumn("__holder", F.lit(None).cast("string"))
    rules = quality.book_rules(raw_page=None, raw_date=None)
    judged = cut_lineage(quality.judged(held.unionByName(plain), rules).drop("__holder"))
    good, bad = judged.where(F.size("reasons") == 0).drop("reasons"), judged.where(F.size("reasons") > 0)
    notices = good.unionByName(products.where(is_delete))

    rejects = bad.select("source_file", "record_reference", F.array_join("reasons", ",").alias("reason"),
                         F.lit(None).cast("string").alias("fragment")).unionByName(
        corrupt.select("source_file", F.lit(None).cast("string").alias("record_reference"), "reason", "fragment"))
    _keep_run(rejects, f"{store}/rejects", run)
    rejects = spark.read.parquet(f"{store}/rejects/run={run}")
    counts = notices.select("source_file", F.lit("accepted").alias("kind")).unionByName(rejects.select(
        "source_file", F.when(F.col("fragment").isNull() & F.col("record_reference").isNotNull(),
                              F.lit("rejected")).otherwise(F.lit("corrupt")).alias("kind")))
    _keep_run(counts.groupBy("source_file").agg(*(F.count_if(F.col("kind") == k).alias(k) for k in (
        "accepted", "rejected", "corrupt"))), f"{store}/summaries", run)

    last = cut_lineage(merge.last_wins(good.select("record_reference", "arrival", *CHILDREN), "record_reference", "arrival"))
    touched = last.select("record_reference")
    for field, table in CHILDREN.items():
        rows = last.select("record_reference", F.posexplode(field).alias("pos", "x")).select("record_reference", "pos", "x.*")
        _update(spark, f"{store}/{table}", "record_reference", touched, rows,
                lambda current, rows=rows: merge.replace_children(current, touched, rows, "record_reference"))
    subjects = last.select("record_reference", "arrival", F.posexplode("subjects").alias("pos", "x")).select(
        "record_reference", F.struct("arrival", "pos").alias("pos"), "x.*")
    genres, pairs = map(cut_lineage, merge.derive_genres(subjects))
    _update(spark, f"{store}/genres", "slug", genres, genres, lambda current: merge.insert_absent(current, genres, "slug"))
    # Only books with usable subjects in this run; others keep their genres.
    named = pairs.select("record_reference").distinct()
    _update(spark, f"{store}/book_genres", "record_reference", named, pairs,
            lambda current: merge.replace_children(current, named, pairs, "record_reference"))
    # Books that the run names, or whose ISBN a delete names: two columns of the others are looked through.
    gone = bounded_broadcast(notices.where(is_delete & F.col("isbn13").isNotNull()).select("isbn13").distinct())
    found = books.join(gone, "isbn13", "left_semi").select("record_reference")
    _update(spark, f"{store}/books", "record_reference", notices.select("record_reference").unionByName(found), books,
            lambda current: merge.apply_notices(current, notices, as_of), bloom=("isbn13",))


def stream_onix(spark: SparkSession, path: str, store: str, checkpoint: str, as_of,
                max_files_per_trigger: int = 1, available_now: bool = True) -> StreamingQuery:
    """O-98: every new ONIX file under ``path`` is parsed and ingested (see
    ``ingest_products``) in file order; the store may be empty at first. ``as_of``: the
    run clock, or a function called once per batch (for a stream that keeps running)."""
    text = (spark.readStream.option("lineSep", "</Product>").option("maxFilesPerTrigger", max_files_per_trigger)
            .text(path))
    raw = file_columns(text)

    def apply(batch: DataFrame, batch_id: int) -> None:
        s = batch.sparkSession
        if _applied(s, store, "onix", batch_id):
            return
        records = parse_onix_once(with_arrival(batch).select("value", "source_file", "arrival"), n_files=max_files_per_trigger)
        ingest_products(s, records, store, as_of() if callable(as_of) else as_of, f"onix-{batch_id}")
        _record_batch(s, store, "onix", batch_id)

    w = raw.writeStream.foreachBatch(apply).option("checkpointLocation", checkpoint)
    w = w.trigger(availableNow=True) if available_now else w.trigger(processingTime="1 minute")
    return w.start()


def stream_stock(spark: SparkSession, path: str, store: str, checkpoint: str,
                 ts: Callable[[Column], Column] | None = None, max_files_per_trigger: int = 1,
                 available_now: bool = True, feed: str = "avail13") -> StreamingQuery:
    """O-99 / O-100: stock files merged into ``<store>/stock`` under the
    freshness gate, oldest file first — hourly files (``feed="avail13"``) or
    daily framed inventory files (``feed="inventory"``). ``ts`` maps the file
    name to the rows' time (default: the file's modification time)."""
    spec = fm.FEEDS[feed]
    text = spark.readStream.option("maxFilesPerTrigger", max_files_per_trigger).text(path)
    lines = src.raw_lines(text)

    def apply(batch: DataFrame, batch_id: int) -> None:
        s = batch.sparkSession
        if _applied(s, store, f"stock_{feed}", batch_id):
            return
        stamp = ts(F.col("file_name")) if ts is not None else None
        ordered = src.lines_with_arrival(batch)
        raw = src.framed(ordered, spec.aliases) if spec.framed else src.positional(ordered, spec.columns)
        mapped = cut_lineage(spec.mapper(raw, file_key=F.col("file_name"), ts=stamp))
        rows = merge.arrival_ordinal(fm.accepted(mapped), "arrival")
        _keep_run(fm.scan_summary(mapped), f"{store}/feed_summaries", f"{feed}-{batch_id}")
        _update(s, f"{store}/stock", "isbn13", rows, rows.drop("arrival"),
                lambda current: merge.gated_merge(current, rows), bloom=("isbn13",))
        _record_batch(s, store, f"stock_{feed}", batch_id)

    w = lines.writeStream.foreachBatch(apply).option("checkpointLocation", checkpoint)
    w = w.trigger(availableNow=True) if available_now else w.trigger(processingTime="10 minutes")
    return w.start()


def bootstrap(spark: SparkSession, onix_paths, feeds: Mapping[str, object], store: str, as_of) -> DataFrame:
    """O-104: books and their children first, then every ISBN-keyed feed on its
    own; one failing feed does not stop the rest. Full-replace feeds are marked
    and swept with the same ``as_of``: what the file holds stays, the rest goes.
    A file's trailer mismatches and refused rows are kept in ``feed_summaries``.
    Returns ``feed, status, rows, error``."""
    ts = F.lit(as_of).cast("timestamp") if not isinstance(as_of, Column) else as_of
    status = []
    try:
        ingest_products(spark, scan_onix_once(spark, onix_paths), store, as_of, "bootstrap")
        status.append(("books", "completed", _count(spark, f"{store}/books"), None))
    except Exception as e:  # noqa: BLE001 - reported per feed
        status.append(("books", "failed", 0, str(e)[:500]))
    for name, paths in feeds.items():
        spec = fm.FEEDS[name]
        try:
            mapped = cut_lineage(fm.scan_feed(spark, spec, paths))
            _keep_run(fm.scan_summary(mapped), f"{store}/feed_summaries", f"bootstrap-{name}")
            rows, root = fm.accepted(mapped), f"{store}/{spec.table}"
            if spec.merge == "gated":
                rows = merge.arrival_ordinal(rows, "arrival")
                _update(spark, root, spec.keys[0], rows, rows.drop("arrival"), lambda cur, rows=rows: merge.gated_merge(cur, rows))
            else:
                rows = rows.withColumn("synced_at", ts)

                def merged(cur: DataFrame, rows=rows, spec=spec) -> DataFrame:
                    out = merge.upsert(cur, rows, list(spec.keys), order="arrival").drop("arrival")
                    return merge.sweep(out, "synced_at", ts) if spec.merge == "replace" else out
                # A full replace sweeps every bucket; other feeds touch their own.
                _update(spark, root, spec.keys[0], None if spec.merge == "replace" else rows, rows.drop("arrival"), merged)
            status.append((name, "completed", _count(spark, root), None))
        except Exception as e:  # noqa: BLE001 - reported per feed
            status.append((name, "failed", 0, str(e)[:500]))
    return spark.createDataFrame(status, "feed string, status string, rows long, error string")
