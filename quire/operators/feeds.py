"""Feed row mappers and scan summaries (O-25, O-26, O-28 … O-37).

A mapper turns scanned rows (all strings) into typed table rows plus an
``accepted`` flag; rows it refuses are counted, not stored. Trailer rows and
unparseable rows are neither.
"""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from quire.functions.scalars import avail_source, blank_to_null, dm2y_date, dmy_date, trim_ws, valid_isbn13

# Header names of the framed inventory feed (output column -> names to try)
# and the columns of the other feeds in their order.
INVENTORY_ALIASES = {
    "isbn13": ["ISBN13", "EAN"],
    "rrp": ["RRP_GBP", "RRP"],
    "discount": ["DISCOUNT"],
    "stock": ["STOCK", "QTY"],
    "report_code": ["REP_CODE", "REPORT"],
    "report_date": ["REP_DATE", "REPORT-DATE"],
}
AVAIL_COLUMNS = ["isbn13", "qty"]
PROMOTION_COLUMNS = ["isbn13", "title", "author", "price", "discount_percent", "returns_flag", "finish_date"]
FIRM_SALE_COLUMNS = ["isbn13", "report_code"]
ISBN_SLIP_COLUMNS = ["old_isbn13", "new_isbn13"]
RESTRICTION_COLUMNS = ["isbn13", "flag", "region_code"]
REGION_COLUMNS = ["code", "name"]


def _data_rows(raw: DataFrame) -> Column:
    return ~F.col("is_trailer") & ~F.col("parse_error")


def _t(c: str) -> Column:
    return trim_ws(F.col(c))


def _meta(file_key: Column | None, ts: Column | None, ts_name: str) -> list[Column]:
    key = file_key if file_key is not None else F.col("source_file")
    t = ts if ts is not None else F.col("file_mtime")
    return [key.alias("source_file_key"), t.alias(ts_name)]


def map_inventory(raw: DataFrame, file_key: Column | None = None, ts: Column | None = None) -> DataFrame:
    """O-30: framed inventory rows -> stock rows (price, discount, qty, report)."""
    qty = _t("stock")
    return raw.select(
        _t("isbn13").alias("isbn13"),
        blank_to_null(_t("rrp")).try_cast("decimal(10,2)").alias("rrp_gbp"),
        blank_to_null(_t("discount")).try_cast("decimal(5,2)").alias("discount_percent"),
        F.when(qty != "", qty.try_cast("int")).alias("stock_qty"),
        blank_to_null(_t("report_code")).alias("report_code"),
        dmy_date("report_date").alias("report_date"),
        F.lit("inventory").alias("source"),
        *_meta(file_key, ts, "stock_updated_at"),
        "arrival", "source_file", "is_trailer", "trailer_count", "parse_error",
        (valid_isbn13("isbn13") & _data_rows(raw)).alias("accepted"),
    )


def map_avail(raw: DataFrame, file_key: Column | None = None, ts: Column | None = None) -> DataFrame:
    """O-31 / O-32: hourly stock rows -> qty-only stock rows; blank qty refused;
    source from the file's sequence suffix."""
    qty = _t("qty")
    return raw.select(
        _t("isbn13").alias("isbn13"),
        F.lit(None).cast("decimal(10,2)").alias("rrp_gbp"),
        F.lit(None).cast("decimal(5,2)").alias("discount_percent"),
        qty.try_cast("int").alias("stock_qty"),
        F.lit(None).cast("string").alias("report_code"),
        F.lit(None).cast("date").alias("report_date"),
        avail_source("file_name").alias("source"),
        *_meta(file_key, ts, "stock_updated_at"),
        "arrival", "source_file", "is_trailer", "trailer_count", "parse_error",
        (valid_isbn13("isbn13") & (qty != "") & _data_rows(raw)).alias("accepted"),
    )


def map_promotions(raw: DataFrame, file_key: Column | None = None, ts: Column | None = None) -> DataFrame:
    """O-33: seven positional columns; blanks to null; ``DD/MM/YY`` finish date."""
    return raw.select(
        _t("isbn13").alias("isbn13"),
        blank_to_null(F.col("title")).alias("title"),
        blank_to_null(F.col("author")).alias("author"),
        blank_to_null(_t("price")).try_cast("decimal(10,2)").alias("price"),
        blank_to_null(_t("discount_percent")).try_cast("decimal(5,2)").alias("discount_percent"),
        blank_to_null(_t("returns_flag")).alias("returns_flag"),
        dm2y_date("finish_date").alias("finish_date"),
        *_meta(file_key, ts, "synced_at"),
        "arrival", "source_file", "is_trailer", "trailer_count", "parse_error",
        (valid_isbn13("isbn13") & _data_rows(raw)).alias("accepted"),
    )


def map_firm_sale(raw: DataFrame, file_key: Column | None = None, ts: Column | None = None) -> DataFrame:
    """O-34: ISBN + optional report code."""
    return raw.select(
        _t("isbn13").alias("isbn13"),
        blank_to_null(_t("report_code")).alias("report_code"),
        *_meta(file_key, ts, "synced_at"),
        "arrival", "source_file", "is_trailer", "trailer_count", "parse_error",
        (valid_isbn13("isbn13") & _data_rows(raw)).alias("accepted"),
    )


def map_isbn_slips(raw: DataFrame, file_key: Column | None = None, ts: Column | None = None) -> DataFrame:
    """O-35: old -> new ISBN, both must be valid."""
    return raw.select(
        _t("old_isbn13").alias("old_isbn13"),
        _t("new_isbn13").alias("new_isbn13"),
        *_meta(file_key, ts, "synced_at"),
        "arrival", "source_file", "is_trailer", "trailer_count", "parse_error",
        (valid_isbn13("old_isbn13") & valid_isbn13("new_isbn13") & _data_rows(raw)).alias("accepted"),
    )


def map_restrictions(raw: DataFrame, file_key: Column | None = None, ts: Column | None = None) -> DataFrame:
    """O-36: valid ISBN, flag Y or N, non-blank region."""
    flag, region = _t("flag"), _t("region_code")
    return raw.select(
        _t("isbn13").alias("isbn13"), flag.alias("flag"), region.alias("region_code"),
        *_meta(file_key, ts, "synced_at"),
        "arrival", "source_file", "is_trailer", "trailer_count", "parse_error",
        (valid_isbn13("isbn13") & flag.isin("Y", "N") & (region != "") & _data_rows(raw)).alias("accepted"),
    )


def map_regions(raw: DataFrame, file_key: Column | None = None, ts: Column | None = None) -> DataFrame:
    """O-37: code and name both non-blank."""
    code, name = _t("code"), _t("name")
    return raw.select(
        code.alias("code"), name.alias("name"),
        (ts if ts is not None else F.col("file_mtime")).alias("synced_at"),
        "arrival", "source_file", "is_trailer", "trailer_count", "parse_error",
        ((code != "") & (name != "") & _data_rows(raw)).alias("accepted"),
    )


META = ["arrival", "source_file", "is_trailer", "trailer_count", "parse_error", "accepted"]


def accepted(mapped: DataFrame) -> DataFrame:
    """Rows the mapper accepted, without the scan bookkeeping columns."""
    return mapped.where(F.col("accepted")).drop(*[c for c in META if c != "arrival"])


def scan_summary(mapped: DataFrame) -> DataFrame:
    """O-26: per file — accepted, skipped and unparseable rows, the trailer count,
    and whether the trailer disagrees with the rows seen."""
    data = ~F.col("is_trailer")
    s = mapped.groupBy("source_file").agg(
        F.count_if(F.col("accepted")).alias("total_rows"),
        F.count_if(data & ~F.col("parse_error") & ~F.col("accepted")).alias("skipped_rows"),
        F.count_if(data & F.col("parse_error")).alias("parse_error_rows"),
        F.max(F.when(F.col("is_trailer"), F.col("trailer_count"))).alias("trailer_count"),
    )
    seen = F.col("total_rows") + F.col("skipped_rows") + F.col("parse_error_rows")
    return s.withColumn("trailer_mismatch",
                        F.coalesce(F.col("trailer_count") != seen, F.lit(False)))


@dataclass(frozen=True)
class FeedSpec:
    """One wholesaler feed: how to scan it, map it and merge it."""
    name: str
    table: str
    mapper: Callable[..., DataFrame]
    keys: tuple[str, ...]
    columns: tuple[str, ...] = ()
    aliases: dict = field(default_factory=dict)
    framed: bool = False
    merge: str = "upsert"          # "gated" (stock), "upsert", "replace" (upsert + sweep)


FEEDS = {
    "inventory": FeedSpec("inventory", "stock", map_inventory, ("isbn13",), aliases=INVENTORY_ALIASES,
                          framed=True, merge="gated"),
    "avail13": FeedSpec("avail13", "stock", map_avail, ("isbn13",), tuple(AVAIL_COLUMNS), merge="gated"),
    "promotions": FeedSpec("promotions", "promotions", map_promotions, ("isbn13",), tuple(PROMOTION_COLUMNS),
                           merge="replace"),
    "firm_sale": FeedSpec("firm_sale", "firm_sale", map_firm_sale, ("isbn13",), tuple(FIRM_SALE_COLUMNS),
                          merge="replace"),
    "isbn_slips": FeedSpec("isbn_slips", "isbn_slips", map_isbn_slips, ("old_isbn13",),
                           tuple(ISBN_SLIP_COLUMNS), merge="replace"),
    "market_restrictions": FeedSpec("market_restrictions", "market_restrictions", map_restrictions,
                                    ("isbn13", "region_code"), tuple(RESTRICTION_COLUMNS), merge="replace"),
    "regions": FeedSpec("regions", "regions", map_regions, ("code",), tuple(REGION_COLUMNS)),
}


def scan_feed(spark, spec: FeedSpec, paths) -> DataFrame:
    """Scan + map one feed's files."""
    from quire.sources.feeds import scan_framed, scan_positional

    raw = scan_framed(spark, paths, spec.aliases) if spec.framed else scan_positional(spark, paths, spec.columns)
    return spec.mapper(raw)
