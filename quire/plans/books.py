"""Catalogue queries: ONIX scan, book merge, children, genres (Q01, Q02, Q09-Q11,
Q20, Q21, Q23, Q28, Q31, Q33 and the end-to-end ingest)."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from quire.operators import merge
from quire.operators.products import project_products
from quire.plans import adapters
from quire.plans.common import AS_OF, date_str, load, ts_str
from quire.session import stage_path
from quire.sources.onix import scan_onix
from quire.sources.store import write_framed_text

BOOK_OUT = ["record_reference", "isbn13", "title", "subtitle", "long_description", "publisher_name",
            "page_count", "publication_date", "is_removed", "embedded_at", "created_at", "updated_at"]


def book_rows(books: DataFrame) -> DataFrame:
    """Flat, oracle-comparable view of a books snapshot."""
    return books.select(
        "record_reference", "isbn13", "title", "subtitle", "long_description", "publisher_name",
        F.col("page_count").cast("long").alias("page_count"),
        date_str("publication_date").alias("publication_date"),
        "is_removed",
        ts_str("embedded_at").alias("embedded_at"),
        ts_str("created_at").alias("created_at"),
        ts_str("updated_at").alias("updated_at"),
        ts_str("removed_at").alias("removed_at"),
    )


def q_book_upsert(spark: SparkSession, sf: str) -> DataFrame:
    """Q21 (O-45, O-54, O-62, O-63): merge one run of notices into the catalogue."""
    part, li = load(spark, sf, "part"), load(spark, sf, "lineitem")
    books = adapters.books_from_part(part)
    notices = adapters.notices_from_lineitem(li, part)
    return book_rows(merge.upsert_books(books, notices, AS_OF)).drop("removed_at")


def q_soft_delete(spark: SparkSession, sf: str) -> DataFrame:
    """Q31 (O-64, O-65): delete notices by ISBN or reference; later notices reactivate."""
    part, li = load(spark, sf, "part"), load(spark, sf, "lineitem")
    books = adapters.books_from_part(part)
    notices = adapters.notices_from_lineitem(li, part, with_deletes=True)
    out = merge.apply_notices(books, notices, AS_OF)
    return book_rows(out).select("record_reference", "isbn13", "title", "is_removed", "removed_at",
                                 "updated_at")


def q_needs_embedding(spark: SparkSession, sf: str) -> DataFrame:
    """Q23 (O-47): touched books whose embedding was invalidated or never made."""
    part, li = load(spark, sf, "part"), load(spark, sf, "lineitem")
    books = adapters.books_from_part(part)
    notices = adapters.notices_from_lineitem(li, part)
    merged = merge.upsert_books(books, notices, AS_OF)
    from quire.operators.embedding import needs_embedding
    touched = notices.select("record_reference").distinct()
    return needs_embedding(merged, touched).select("record_reference", "title")


def onix_file_count(part: DataFrame, per_file: int = 50_000) -> int:
    """Feed files for a run: at least 4, at most ``per_file`` products each."""
    return max(4, -(-part.count() // per_file))


def write_onix(spark: SparkSession, part: DataFrame, name: str, broken_every: int | None = None,
               n_files: int | None = None) -> str:
    n_files = n_files or onix_file_count(part)
    path = stage_path(spark, name)
    frags = adapters.product_fragments(part, broken_every=broken_every, n_files=n_files)
    write_framed_text(frags, path, n_files, adapters.ONIX_HEAD, adapters.ONIX_TAIL)
    return path


PRODUCT_OUT = ["record_reference", "notification_type", "isbn13", "product_form", "product_composition",
               "edition_number", "page_count", "height_mm", "weight_gr", "title", "subtitle",
               "long_description", "publisher_name", "publishing_status", "publication_date",
               "availability_code"]


def product_rows(products: DataFrame) -> DataFrame:
    return products.select(
        "record_reference", "notification_type", "isbn13", "product_form", "product_composition",
        F.col("edition_number").cast("long").alias("edition_number"),
        F.col("page_count").cast("long").alias("page_count"),
        F.col("height_mm").cast("double").alias("height_mm"),
        F.col("weight_gr").cast("double").alias("weight_gr"),
        "title", "subtitle", "long_description", "publisher_name", "publishing_status",
        date_str("publication_date").alias("publication_date"), "availability_code",
        F.size("contributors").cast("long").alias("n_contributors"),
        F.col("subjects")[0]["subject_heading_text"].alias("first_subject"),
        F.col("subjects")[0]["is_main_subject"].alias("first_subject_main"),
        F.col("prices")[0]["price_amount"].cast("double").alias("price_amount"),
        F.col("prices")[0]["currency_code"].alias("currency_code"),
    )


def q_onix_scan_project(spark: SparkSession, sf: str) -> DataFrame:
    """Q01 (O-01, O-12…O-20, O-24): ONIX files written from ``part``, scanned and typed."""
    part = load(spark, sf, "part")
    path = write_onix(spark, part, "onix-q01")
    records, _ = scan_onix(spark, path)
    return product_rows(project_products(records))


def q_onix_corrupt_split(spark: SparkSession, sf: str) -> DataFrame:
    """Q02 (O-02): malformed fragments set aside, the rest parsed."""
    part = load(spark, sf, "part")
    path = write_onix(spark, part, "onix-q02", broken_every=17)
    records, corrupt = scan_onix(spark, path)
    good = records.select(F.col("product.RecordReference").alias("record_reference"),
                          F.lit("ok").alias("status"))
    bad = corrupt.select(F.regexp_extract("fragment", "<RecordReference>([^<]*)</RecordReference>", 1)
                         .alias("record_reference"), F.col("reason").alias("status"))
    return good.unionByName(bad)


def onix_ingest(spark: SparkSession, sf: str, n_files: int | None = None) -> DataFrame:
    """End-to-end ONIX run: write feed files, scan, type, merge into the catalogue."""
    part = load(spark, sf, "part")
    path = write_onix(spark, part, "onix-ingest", n_files=n_files)
    records, _ = scan_onix(spark, path)
    products = project_products(records)
    books = adapters.books_from_part(part)
    merged = merge.apply_notices(books, products, AS_OF)
    return book_rows(merged).drop("removed_at")


def q_onix_scan_summary(spark: SparkSession, sf: str) -> DataFrame:
    """O-02 / O-24 / O-26 for ONIX: per-file parsed, kept, corrupt and title-less
    counts (summed over the run's files)."""
    from quire.operators.products import onix_summary
    part = load(spark, sf, "part")
    path = write_onix(spark, part, "onix-summary", broken_every=17)
    records, corrupt = scan_onix(spark, path)
    s = onix_summary(records, project_products(records), corrupt)
    return s.agg(F.count("*").alias("files"), F.sum("parsed").alias("parsed"), F.sum("kept").alias("kept"),
                 F.sum("corrupt").alias("corrupt"), F.sum("dropped_no_title").alias("dropped_no_title"))


def q_book_id_lookup(spark: SparkSession, sf: str) -> DataFrame:
    """O-45: book ids of the references touched by a run (inner join on the key)."""
    part, li = load(spark, sf, "part"), load(spark, sf, "lineitem")
    books = adapters.books_from_part(part).withColumn("id", F.regexp_extract("record_reference", "([0-9]+)$", 1)
                                                      .cast("long") * 10)
    touched = adapters.notices_from_lineitem(li, part).select("record_reference").distinct()
    return merge.lookup_ids(touched, books)
