"""Adapters from the driver's test tables to the operators' inputs.

They live beside the queries, not in the operators: the operators only ever
see catalogue-shaped DataFrames.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from quire.plans.common import days_before, el, el_raw, isbn_of, ref_of, xml_escape
from quire.schemas import BOOK_FIELDS

BOOK_EXTRA = {
    "embedded_at": T.TimestampType(), "embedding": T.ArrayType(T.FloatType()),
    "cover_url": T.StringType(), "cover_fetched_at": T.TimestampType(),
    "cover_checked_at": T.TimestampType(), "is_removed": T.BooleanType(),
    "removed_at": T.TimestampType(), "created_at": T.TimestampType(),
    "updated_at": T.TimestampType(),
}

BOOK_TYPES = {
    "edition_number": T.IntegerType(), "page_count": T.IntegerType(),
    "height_mm": T.DecimalType(7, 2), "width_mm": T.DecimalType(7, 2),
    "thickness_mm": T.DecimalType(7, 2), "weight_gr": T.DecimalType(9, 2),
    "publication_date": T.DateType(), "order_time": T.IntegerType(),
}


def _typed(values: dict) -> list:
    cols = []
    for f in BOOK_FIELDS:
        t = BOOK_TYPES.get(f, T.StringType())
        v = values.get(f)
        cols.append((v if v is not None else F.lit(None)).cast(t).alias(f))
    return cols


def books_from_part(part: DataFrame) -> DataFrame:
    """The catalogue before a run: one book per part."""
    p = F.col
    vals = {
        "record_reference": ref_of("REF", "p_partkey"),
        "notification_type": F.lit("03"),
        "isbn13": isbn_of("978", "p_partkey"),
        "title": F.concat_ws(" ", p("p_name"), p("p_partkey").cast("string")),
        "subtitle": p("p_type"),
        "long_description": F.concat(p("p_name"), F.lit(" by "), p("p_brand")),
        "publisher_name": p("p_brand"),
        "page_count": p("p_size"),
    }
    extra = [
        F.when(p("p_size") % 2 == 0, days_before(10)).cast("timestamp").alias("embedded_at"),
        F.lit(None).cast(BOOK_EXTRA["embedding"]).alias("embedding"),
        F.lit(None).cast("string").alias("cover_url"),
        F.lit(None).cast("timestamp").alias("cover_fetched_at"),
        F.lit(None).cast("timestamp").alias("cover_checked_at"),
        F.lit(False).alias("is_removed"),
        F.lit(None).cast("timestamp").alias("removed_at"),
        days_before(30).alias("created_at"),
        days_before(30).alias("updated_at"),
    ]
    return part.select(*_typed(vals), *extra)


LINE_ORDER = ["l_shipdate", "l_orderkey", "l_linenumber", "l_partkey", "l_suppkey", "l_quantity",
              "l_extendedprice", "l_discount", "l_tax", "l_returnflag", "l_linestatus"]


def notices_from_lineitem(lineitem: DataFrame, part: DataFrame, with_deletes: bool = False) -> DataFrame:
    """ONIX notices of a run, one per line item (flat product rows + ``arrival``).

    Lines 1-5 update existing books, later lines announce new ones; returned
    lines retitle the book; open lines change its long description. With
    ``with_deletes``, returned lines are delete notices instead (without an ISBN
    when the line is still open, so the record reference is used).
    """
    p = part.select("p_partkey", "p_name", "p_type", "p_brand")
    j = lineitem.join(p, lineitem.l_partkey == p.p_partkey)
    c = F.col
    existing = c("l_linenumber") <= 5
    ntype = F.lit("03")
    isbn = F.when(existing, isbn_of("978", "l_partkey")).otherwise(isbn_of("979", "l_partkey"))
    if with_deletes:
        ntype = F.when(c("l_returnflag") == "R", F.lit("05")).otherwise(F.lit("03"))
        isbn = F.when((c("l_returnflag") == "R") & (c("l_linestatus") == "O"), F.lit(None)).otherwise(isbn)
    vals = {
        "record_reference": F.when(existing, ref_of("REF", "l_partkey")).otherwise(ref_of("NEW", "l_partkey")),
        "notification_type": ntype,
        "isbn13": isbn,
        "title": F.when(c("l_returnflag") == "R",
                        F.concat(c("p_name"), F.lit(" (revised "), c("l_linenumber").cast("string"), F.lit(")")))
                 .otherwise(F.concat_ws(" ", c("p_name"), c("l_partkey").cast("string"))),
        "subtitle": c("p_type"),
        "long_description": F.when(c("l_linestatus") == "O", F.concat(F.lit("Open edition of "), c("p_name")))
                            .otherwise(F.concat(c("p_name"), F.lit(" by "), c("p_brand"))),
        "publisher_name": c("p_brand"),
        "page_count": c("l_quantity").cast("int"),
        "publication_date": F.to_date(c("l_shipdate")),
    }
    return j.select(*_typed(vals), F.struct(*[c(x) for x in LINE_ORDER]).alias("arrival"))


def product_fragments(part: DataFrame, broken_every: int | None = None, n_files: int = 4) -> DataFrame:
    """ONIX ``<Product>`` fragments, one line per part (``file_no``, ``seq``, ``line``).

    Variety: parts of size 1 carry an empty title (dropped by the scan rules);
    the long description holds an entity; with ``broken_every`` = k, every
    part whose key is a multiple of k loses a closing tag (malformed).
    """
    c = F.col
    k = c("p_partkey")
    title = F.when(c("p_size") == 1, F.lit("")).otherwise(F.concat_ws(" ", c("p_name"), k.cast("string")))
    title_el = el_raw("TitleText", xml_escape(title))
    if broken_every:
        title_el = F.when(k % broken_every == 0, F.concat(F.lit("<TitleText>"), xml_escape(title))).otherwise(title_el)
    measure = lambda code, v: el_raw("Measure", el("MeasureType", F.lit(code)), el("Measurement", v),
                                     el("MeasureUnitCode", F.lit("mm")))
    line = F.concat(
        F.lit("<Product>"),
        el("RecordReference", ref_of("REF", k)),
        el("NotificationType", F.lit("03")),
        el_raw("ProductIdentifier", el("ProductIDType", F.lit("03")), el("IDValue", ref_of("GTIN", k))),
        el_raw("ProductIdentifier", el("ProductIDType", F.lit("15")), el("IDValue", isbn_of("978", k))),
        el_raw("DescriptiveDetail",
               el("ProductComposition", F.lit("00")),
               el("ProductForm", F.upper(F.substring(c("p_type"), 1, 2))),
               measure("01", (c("p_size") * 7).cast("string")),
               measure("08", c("p_retailprice").cast("string")),
               el_raw("TitleDetail", el("TitleType", F.lit("01")),
                      el_raw("TitleElement", el("TitleElementLevel", F.lit("01")), title_el,
                             el("Subtitle", xml_escape(c("p_type"))))),
               el("EditionNumber", (k % 3).cast("string")),
               el_raw("Extent", el("ExtentType", F.lit("00")), el("ExtentValue", (c("p_size") * 10).cast("string")),
                      el("ExtentUnit", F.lit("03"))),
               el_raw("Subject", F.lit("<MainSubject/>"), el("SubjectSchemeIdentifier", F.lit("93")),
                      el("SubjectCode", F.upper(F.substring(c("p_type"), 1, 3))),
                      el("SubjectHeadingText", xml_escape(c("p_type"))))),
        el_raw("CollateralDetail",
               el_raw("TextContent", el("TextType", F.lit("03")), el("ContentAudience", F.lit("00")),
                      el("Text", xml_escape(F.concat(c("p_name"), F.lit(" & "), c("p_brand")))))),
        el_raw("PublishingDetail",
               el_raw("Publisher", el("PublishingRole", F.lit("01")), el("PublisherName", xml_escape(c("p_brand")))),
               el("PublishingStatus", F.lit("04")),
               el_raw("PublishingDate", el("PublishingDateRole", F.lit("01")),
                      el("Date", F.concat(F.lit("2024"), F.lpad(((k % 12) + 1).cast("string"), 2, "0"),
                                          F.lpad(((k % 28) + 1).cast("string"), 2, "0"))))),
        el_raw("ProductSupply", el_raw("SupplyDetail", el("ProductAvailability", F.lit("21")),
                                       el_raw("Price", el("PriceType", F.lit("02")),
                                              el("PriceAmount", c("p_retailprice").cast("string")),
                                              el("CurrencyCode", F.lit("GBP"))))),
        F.lit("</Product>"),
    )
    return part.select(F.pmod(k, F.lit(n_files)).cast("int").alias("file_no"),
                       k.cast("long").alias("seq"), line.alias("line"))


ONIX_HEAD = ['<?xml version="1.0" encoding="UTF-8"?>', '<ONIXMessage release="3.0">',
             "<Header><Sender><SenderName>Feed</SenderName></Sender></Header>"]
ONIX_TAIL = ["</ONIXMessage>"]
