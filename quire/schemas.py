"""Declared schemas (no inference anywhere: codes such as ``05`` stay strings)."""

from __future__ import annotations

from pyspark.sql import types as T

S = T.StringType()


def _struct(*fields) -> T.StructType:
    out = []
    for f in fields:
        if isinstance(f, str):
            out.append(T.StructField(f, S, True))
        else:
            out.append(T.StructField(f[0], f[1], True))
    return T.StructType(out)


def _arr(*fields) -> T.ArrayType:
    return T.ArrayType(_struct(*fields))


CORRUPT = "_corrupt_record"

# One ONIX 3 <Product>, every leaf a string; repeated composites are arrays.
ONIX_PRODUCT = _struct(
    "RecordReference",
    "NotificationType",
    ("ProductIdentifier", _arr("ProductIDType", "IDValue")),
    ("DescriptiveDetail", _struct(
        "ProductComposition",
        "ProductForm",
        ("Measure", _arr("MeasureType", "Measurement", "MeasureUnitCode")),
        "CountryOfManufacture",
        ("ProductClassification", _arr("ProductClassificationType", "ProductClassificationCode")),
        ("TitleDetail", _arr("TitleType", ("TitleElement", _arr("TitleElementLevel", "TitleText", "Subtitle")))),
        ("Contributor", _arr("SequenceNumber", "ContributorRole", "PersonName", "PersonNameInverted")),
        "EditionNumber",
        ("Extent", _arr("ExtentType", "ExtentValue", "ExtentUnit")),
        ("Subject", _arr("MainSubject", "SubjectSchemeIdentifier", "SubjectSchemeVersion",
                         "SubjectCode", "SubjectHeadingText")),
    )),
    ("CollateralDetail", _struct(("TextContent", _arr("TextType", "ContentAudience", "Text")))),
    ("PublishingDetail", _struct(
        ("Imprint", _arr("ImprintName")),
        ("Publisher", _arr("PublishingRole", "PublisherName")),
        "CountryOfPublication",
        "PublishingStatus",
        ("PublishingDate", _arr("PublishingDateRole", "Date")),
    )),
    ("ProductSupply", _arr(("SupplyDetail", _arr(
        "ProductAvailability",
        ("ReturnsConditions", _arr("ReturnsCodeType", "ReturnsCode")),
        "OrderTime",
        ("Price", _arr("PriceType", "PriceAmount", ("Tax", _arr("TaxType", "TaxRateCode", "TaxRatePercent")),
                       "CurrencyCode")),
    )))),
    CORRUPT,
)

CONTRIBUTOR = T.StructType([
    T.StructField("sequence_number", T.IntegerType()),
    T.StructField("role", S),
    T.StructField("person_name", S),
    T.StructField("person_name_inverted", S),
])

SUBJECT = T.StructType([
    T.StructField("scheme_identifier", S),
    T.StructField("scheme_version", S),
    T.StructField("subject_code", S),
    T.StructField("subject_heading_text", S),
    T.StructField("is_main_subject", T.BooleanType()),
])

PRICE = T.StructType([
    T.StructField("price_type", S),
    T.StructField("price_amount", T.DecimalType(12, 2)),
    T.StructField("currency_code", S),
    T.StructField("tax_rate_code", S),
    T.StructField("tax_rate_percent", T.DecimalType(6, 2)),
])

# Scalar columns of a book, in the order of the source system's record.
BOOK_FIELDS = [
    "record_reference", "notification_type", "isbn13", "product_form", "product_composition",
    "edition_number", "page_count", "height_mm", "width_mm", "thickness_mm", "weight_gr",
    "country_of_manufacture", "product_classification_code", "title", "subtitle",
    "short_description", "long_description", "publisher_name", "imprint_name",
    "country_of_publication", "publishing_status", "publication_date", "availability_code",
    "returns_code", "order_time",
]

# Column length limits of the catalogue (a longer value is rejected, not cut).
BOOK_LENGTHS = {
    "record_reference": 100, "isbn13": 13, "notification_type": 2, "product_form": 10,
    "product_composition": 2, "country_of_manufacture": 2, "product_classification_code": 30,
    "title": 2000, "subtitle": 2000, "publisher_name": 500, "imprint_name": 500,
    "country_of_publication": 2, "publishing_status": 2, "availability_code": 2,
    "returns_code": 10,
}

# Allowed values of the enumerations.
JOB_STATUSES = ("pending", "processing", "enqueued", "completed", "failed")
CHUNK_STATUSES = ("pending", "processing", "completed", "failed")
FETCH_STATUSES = ("downloading", "processing", "completed", "failed")
FEED_NAMES = ("inventory", "biblio_delta", "biblio_full", "avail13", "promotions", "firm_sale", "isbn_slips",
              "market_restrictions", "regions", "covers_full", "covers_update", "covers_instock")

EXCERPT_FEED = T.StructType([
    T.StructField("response_header", T.MapType(S, S)),
    T.StructField("excerpts", T.ArrayType(T.StructType([
        T.StructField("isbn13", S),
        T.StructField("title", S),
        T.StructField("url", S),
        T.StructField("available", T.BooleanType()),
        T.StructField("update_reason", S),
        T.StructField("updated_at", S),
        T.StructField("created_at", S),
    ]))),
])
