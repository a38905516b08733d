"""O-12 … O-24: ONIX product struct → typed catalogue record.

Path-anchored: a field is read only from its place in the ONIX tree, so an
identifier inside a related product or a title inside a collection does not
overwrite the product's own. Repeated elements follow "last one present wins".
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from quire.functions.scalars import blank_to_null, leading_float, leading_int, onix_date, trim_ws


def _t(c: Column) -> Column:
    """O-12: element text, trimmed (entities are already decoded by ``from_xml``)."""
    return trim_ws(c)


def _last(arr: Column, field: str) -> Column:
    """Value of ``field`` in the last element of ``arr`` that carries it."""
    present = F.filter(arr, lambda x: x[field].isNotNull())
    return F.try_element_at(present, F.lit(-1))[field]


def _last_where(arr: Column, pred, field: str) -> Column:
    return F.try_element_at(F.filter(arr, pred), F.lit(-1))[field]


def _decimal(c: Column, p: int, s: int) -> Column:
    return c.try_cast(f"decimal({p},{s})")


def project_products(records: DataFrame, product: str = "product", reason: str | None = None) -> DataFrame:
    """Typed product rows with nested ``contributors``, ``subjects``, ``prices``.

    Keeps ``arrival`` and ``source_file`` when present. Rows whose title is empty
    are dropped (O-24) unless they are delete notices (type ``05``).
    Measures without a value give 0 and unparseable ones null (O-18). Rows that have a
    ``reason`` (``onix.parse_onix_once``) are no products: all stay, with their ``fragment``.
    """
    p = F.col(product)
    dd = p["DescriptiveDetail"]
    pd_ = p["PublishingDetail"]
    supply = F.flatten(F.transform(F.coalesce(p["ProductSupply"], F.array()),
                                   lambda s: F.coalesce(s["SupplyDetail"], F.array())))
    titles = F.flatten(F.transform(F.coalesce(dd["TitleDetail"], F.array()),
                                   lambda t: F.coalesce(t["TitleElement"], F.array())))
    texts = F.coalesce(p["CollateralDetail"]["TextContent"], F.array())
    measures = F.coalesce(dd["Measure"], F.array())

    isbn = _last_where(p["ProductIdentifier"], lambda x: _t(x["ProductIDType"]) == "15", "IDValue")

    def measure(code: str) -> Column:
        m = F.try_element_at(F.filter(measures, lambda x: _t(x["MeasureType"]) == code), F.lit(-1))
        v = F.when(m["Measurement"].isNull(), F.lit(0.0)).otherwise(leading_float(m["Measurement"]))
        return F.when(m.isNotNull(), v)

    def text(code: str) -> Column:
        t = _last_where(texts, lambda x: _t(x["TextType"]) == code, "Text")
        return blank_to_null(_t(t))   # markup was taken out by the scan

    extent = _last_where(dd["Extent"], lambda x: _t(x["ExtentType"]) == "00", "ExtentValue")
    pub_date = _last_where(pd_["PublishingDate"], lambda x: _t(x["PublishingDateRole"]) == "01", "Date")
    returns = F.flatten(F.transform(supply, lambda s: F.coalesce(s["ReturnsConditions"], F.array())))
    prices = F.flatten(F.transform(supply, lambda s: F.coalesce(s["Price"], F.array())))

    def price(x: Column) -> Column:
        tax = F.try_element_at(x["Tax"], F.lit(-1))
        amount = leading_float(x["PriceAmount"])
        return F.struct(
            _t(x["PriceType"]).alias("price_type"),
            _decimal(F.nullif(amount, F.lit(0.0)), 12, 2).alias("price_amount"),
            _t(x["CurrencyCode"]).alias("currency_code"),
            F.when(tax.isNotNull(), blank_to_null(_t(tax["TaxRateCode"]))).alias("tax_rate_code"),
            F.when(tax.isNotNull(), _decimal(F.coalesce(leading_float(tax["TaxRatePercent"]),
                                                        F.when(tax["TaxRatePercent"].isNull(), F.lit(0.0))),
                                             6, 2)).alias("tax_rate_percent"),
        )

    page = leading_float(extent)
    cols = [
        F.coalesce(_t(p["RecordReference"]), F.lit("")).alias("record_reference"),
        F.coalesce(_t(p["NotificationType"]), F.lit("")).alias("notification_type"),
        blank_to_null(_t(isbn)).alias("isbn13"),
        _t(dd["ProductForm"]).alias("product_form"),
        _t(dd["ProductComposition"]).alias("product_composition"),
        leading_int(dd["EditionNumber"]).alias("edition_number"),
        # a fractional page count is not an integer: null, not truncated
        F.when((page != 0) & (page == F.floor(page)), page.try_cast("int")).alias("page_count"),
        _decimal(measure("01"), 7, 2).alias("height_mm"),
        _decimal(measure("02"), 7, 2).alias("width_mm"),
        _decimal(measure("03"), 7, 2).alias("thickness_mm"),
        _decimal(measure("08"), 9, 2).alias("weight_gr"),
        _t(dd["CountryOfManufacture"]).alias("country_of_manufacture"),
        _t(_last(dd["ProductClassification"], "ProductClassificationCode")).alias("product_classification_code"),
        F.coalesce(_t(_last(titles, "TitleText")), F.lit("")).alias("title"),
        blank_to_null(_t(_last(titles, "Subtitle"))).alias("subtitle"),
        text("02").alias("short_description"),
        text("03").alias("long_description"),
        _t(_last(pd_["Publisher"], "PublisherName")).alias("publisher_name"),
        _t(_last(pd_["Imprint"], "ImprintName")).alias("imprint_name"),
        _t(pd_["CountryOfPublication"]).alias("country_of_publication"),
        _t(pd_["PublishingStatus"]).alias("publishing_status"),
        onix_date(_t(pub_date)).alias("publication_date"),
        _t(_last(supply, "ProductAvailability")).alias("availability_code"),
        _t(_last(returns, "ReturnsCode")).alias("returns_code"),
        leading_int(_last(supply, "OrderTime")).alias("order_time"),
        F.transform(F.coalesce(dd["Contributor"], F.array()), lambda c: F.struct(
            leading_int(c["SequenceNumber"]).alias("sequence_number"),
            _t(c["ContributorRole"]).alias("role"),
            _t(c["PersonName"]).alias("person_name"),
            _t(c["PersonNameInverted"]).alias("person_name_inverted"),
        )).alias("contributors"),
        F.transform(F.coalesce(dd["Subject"], F.array()), lambda s: F.struct(
            _t(s["SubjectSchemeIdentifier"]).alias("scheme_identifier"),
            _t(s["SubjectSchemeVersion"]).alias("scheme_version"),
            _t(s["SubjectCode"]).alias("subject_code"),
            _t(s["SubjectHeadingText"]).alias("subject_heading_text"),
            s["MainSubject"].isNotNull().alias("is_main_subject"),
        )).alias("subjects"),
        F.transform(prices, price).alias("prices"),
    ]
    keep = [c for c in ("arrival", "source_file") if c in records.columns] + ([] if reason is None else ["fragment", reason])
    out = records.select(*cols, *keep)
    named = (F.col("title") != "") | (F.col("notification_type") == "05")
    return out.where(named if reason is None else named | F.col(reason).isNotNull())


def onix_summary(records: DataFrame, products: DataFrame, corrupt: DataFrame) -> DataFrame:
    """Per-file counts: parsed, kept, dropped for an empty title, corrupt."""
    a = records.groupBy("source_file").agg(F.count("*").alias("parsed"))
    b = products.groupBy("source_file").agg(F.count("*").alias("kept"))
    c = corrupt.groupBy("source_file").agg(F.count("*").alias("corrupt"))
    return (a.join(b, "source_file", "full").join(c, "source_file", "full")
            .select("source_file",
                    *[F.coalesce(x, F.lit(0)).alias(x) for x in ("parsed", "kept", "corrupt")])
            .withColumn("dropped_no_title", F.col("parsed") - F.col("kept")))
