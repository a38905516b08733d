"""ONIX scan and projection on an own sample product."""

import pytest

from quire.operators.products import project_products
from quire.sources.onix import CorruptOnixError, scan_onix, scan_onix_once

HEAD = """<?xml version='1.0'?>
<ONIXMessage release="3.0"><Header><SentDateTime>20250107</SentDateTime></Header>
"""
TAIL = "</ONIXMessage>\n"


def tag(name, *inner):
    return f"<{name}>{''.join(map(str, inner))}</{name}>"


def measure(kind, value):
    return tag("Measure", tag("MeasureType", kind), tag("Measurement", value))


ATLAS = tag(
    "Product", tag("RecordReference", "org.quire.77-B"), tag("NotificationType", "04"),
    tag("ProductIdentifier", tag("ProductIDType", "01"), tag("IDValue", "Q77")),
    tag("ProductIdentifier", tag("ProductIDType", "15"), tag("IDValue", "9791032000014")),
    tag("DescriptiveDetail", tag("ProductComposition", "10"), tag("ProductForm", "BC"),
        measure("01", 181), measure("02", "112.5"), measure("08", "96.25"),
        tag("TitleDetail", tag("TitleElement", tag("TitleText", "Tidal Atlas"), tag("Subtitle", "Forty charts"))),
        *(tag("Contributor", tag("SequenceNumber", n), tag("ContributorRole", role), tag("PersonName", who))
          for n, role, who in ((1, "A12", "Ola Brandt"), (2, "B06", "Ines Quiroga"))),
        tag("EditionNumber", 7), tag("Extent", tag("ExtentType", "00"), tag("ExtentValue", 64)),
        tag("Subject", tag("SubjectSchemeIdentifier", "93"), tag("SubjectCode", "RBKF"), tag("SubjectHeadingText", "Tides")),
        tag("Subject", "<MainSubject/>", tag("SubjectSchemeIdentifier", "12"), tag("SubjectCode", "RB"))),
    tag("CollateralDetail",
        tag("TextContent", tag("TextType", "03"), tag("Text", "Charts of forty estuaries, hour by hour.")),
        tag("TextContent", tag("TextType", "02"), tag("Text", "Estuaries by the hour."))),
    tag("PublishingDetail", tag("Imprint", tag("ImprintName", "Low Water")), tag("Publisher", tag("PublisherName", "Quire House")),
        tag("PublishingStatus", "02"), tag("PublishingDate", tag("PublishingDateRole", "01"), tag("Date", "20251109"))),
    tag("ProductSupply", tag("SupplyDetail", tag("ProductAvailability", "10"), tag(
        "Price", tag("PriceType", "01"), tag("PriceAmount", "8.40"), tag("CurrencyCode", "EUR")), tag(
        "Price", tag("PriceType", "42"), tag("PriceAmount", "7.10"), tag("Tax", tag("TaxRateCode", "S"), tag("TaxRatePercent", "5.5")),
        tag("Tax", tag("TaxRateCode", "R")), tag("CurrencyCode", "CHF"))))) + "\n"


def parse(spark, write_text, body, name="f.xml", **kw):
    path = write_text(name, HEAD + body + TAIL)
    records, corrupt = scan_onix(spark, path, **kw)
    return project_products(records), corrupt


def test_one_product_every_field(spark, write_text):
    p, corrupt = parse(spark, write_text, ATLAS)
    assert corrupt.count() == 0
    (r,) = p.collect()
    want = {"record_reference": "org.quire.77-B", "notification_type": "04", "isbn13": "9791032000014",
            "product_composition": "10", "product_form": "BC", "title": "Tidal Atlas", "subtitle": "Forty charts",
            "edition_number": 7, "page_count": 64, "publisher_name": "Quire House", "imprint_name": "Low Water",
            "publishing_status": "02", "availability_code": "10", "short_description": "Estuaries by the hour.",
            "long_description": "Charts of forty estuaries, hour by hour."}
    assert {k: r[k] for k in want} == want
    assert (float(r.height_mm), float(r.width_mm), r.thickness_mm, float(r.weight_gr)) == (181.0, 112.5, None, 96.25)
    assert r.publication_date.isoformat() == "2025-11-09"


def test_nested_lists(spark, write_text):
    (r,) = parse(spark, write_text, ATLAS)[0].collect()
    assert [(c.sequence_number, c.role, c.person_name, c.person_name_inverted) for c in r.contributors] == [
        (1, "A12", "Ola Brandt", None), (2, "B06", "Ines Quiroga", None)]
    assert [(s.scheme_identifier, s.subject_code, s.subject_heading_text, s.is_main_subject) for s in r.subjects] == [
        ("93", "RBKF", "Tides", False), ("12", "RB", None, True)]
    prices = [(x.price_type, float(x.price_amount), x.currency_code, x.tax_rate_code) for x in r.prices]
    assert prices == [("01", 8.4, "EUR", None), ("42", 7.1, "CHF", "R")]
    # no tax at all: null; the last of several taxes counts, without a percent it is 0
    assert r.prices[0].tax_rate_percent is None and float(r.prices[1].tax_rate_percent) == 0.0


def test_delete_notices_kept_with_and_without_title(spark, write_text):
    gone = tag("Product", tag("RecordReference", "old/1"), tag("NotificationType", "05"))
    named = gone.replace("old/1", "old/2").replace(
        "</Product>", tag("DescriptiveDetail", tag("TitleDetail", tag("TitleElement", tag("TitleText", "Withdrawn")))) + "</Product>")
    rows = {r.record_reference: r for r in parse(spark, write_text, gone + named)[0].collect()}
    assert set(rows) == {"old/1", "old/2"} and rows["old/2"].title == "Withdrawn"


def test_text_markup_is_decided_before_decoding(spark, write_text):
    def described(inner):
        body = ATLAS.replace(tag("Text", "Estuaries by the hour."), tag("Text", inner))
        return parse(spark, write_text, body)[0].first().short_description
    assert described("if x &lt; 3 and y &gt; 2 then") == "if x < 3 and y > 2 then"
    assert described("<![CDATA[<p>Hello</p>]]>") == "<p>Hello</p>"
    assert described("<p>one</p><p>thr<i>ee</i></p>").split() == ["one", "three"]
    assert described("<b>bold</b> <![CDATA[a <b>c</b>]]> <br/>end").split() == ["bold", "a", "<b>c</b>", "end"]


def test_two_products_in_file_order(spark, write_text):
    body = "".join(
        f"<Product><RecordReference>R{i}</RecordReference><NotificationType>03</NotificationType>"
        f"<DescriptiveDetail><TitleDetail><TitleElement><TitleText>T{i}</TitleText></TitleElement></TitleDetail>"
        f"</DescriptiveDetail></Product>\n" for i in (1, 2))
    p = parse(spark, write_text, body)[0]
    rows = p.orderBy("arrival").collect()
    assert [r.record_reference for r in rows] == ["R1", "R2"]
    assert rows[0].isbn13 is None and rows[0].contributors == [] and rows[0].prices == []


def test_empty_title_skipped(spark, write_text):
    body = ("<Product><RecordReference>E</RecordReference><NotificationType>03</NotificationType>"
            "<DescriptiveDetail><TitleDetail><TitleElement><TitleText></TitleText></TitleElement></TitleDetail>"
            "</DescriptiveDetail></Product>\n")
    assert parse(spark, write_text, body)[0].count() == 0


def test_malformed_rejected(spark, write_text):
    body = "<Product><RecordReference>BAD</RecordReference><NotificationType>03</Product>\n"
    p, corrupt = parse(spark, write_text, body)
    assert p.count() == 0 and corrupt.count() == 1
    with pytest.raises(CorruptOnixError):
        scan_onix(spark, write_text("bad2.xml", HEAD + body + TAIL), fail_fast=True)


def test_truncated_file_is_all_or_nothing(spark, write_text):
    path = write_text("cut.xml", HEAD + ATLAS)  # no closing root tag
    records, corrupt = scan_onix(spark, path)
    assert records.count() == 0
    assert [r.reason for r in corrupt.collect()] == ["file_truncated"]


def test_path_anchored_fields(spark, write_text):
    # an ISBN inside a related product is not the product's own
    other = tag("RelatedMaterial", tag("RelatedProduct", tag("ProductIdentifier", tag("ProductIDType", "15"), tag("IDValue", "9780000000002"))))
    (r,) = parse(spark, write_text, ATLAS.replace("</Product>", other + "</Product>"))[0].collect()
    assert r.isbn13 == "9791032000014"


def test_numbers_zero_and_nan(spark, write_text):
    body = ATLAS.replace(tag("EditionNumber", 7), tag("EditionNumber", 0)).replace("8.40", "tba").replace(
        tag("Measurement", 181), tag("Measurement"))
    (r,) = parse(spark, write_text, body)[0].collect()
    assert r.edition_number is None and r.prices[0].price_amount is None and r.height_mm is None


def test_split_invariance(spark, write_text):
    """Any split size gives the same records in the same order."""
    body = "".join(ATLAS.replace("77-B", f"{i:04d}") for i in range(300))
    path = write_text("big.xml", HEAD + body + TAIL)
    base = [r.record_reference for r in project_products(scan_onix(spark, path)[0]).orderBy("arrival").collect()]
    old = spark.conf.get("spark.sql.files.maxPartitionBytes")
    try:
        for size in ("4k", "17k", "64k"):
            spark.conf.set("spark.sql.files.maxPartitionBytes", size)
            recs, corrupt = scan_onix(spark, path)
            got = [r.record_reference for r in project_products(recs).orderBy("arrival").collect()]
            assert got == base and corrupt.count() == 0
    finally:
        spark.conf.set("spark.sql.files.maxPartitionBytes", old)
    assert len(base) == 300


def test_prefixed_namespace(spark, write_text):
    body = ('<p:Product xmlns:p="http://ns.editeur.org/onix/3.0/reference"><p:RecordReference>NS1</p:RecordReference>'
            "<p:NotificationType>03</p:NotificationType><p:DescriptiveDetail><p:TitleDetail><p:TitleElement>"
            "<p:TitleText>Namespaced</p:TitleText></p:TitleElement></p:TitleDetail></p:DescriptiveDetail></p:Product>\n")
    path = write_text("ns.xml", '<?xml version="1.0"?>\n<p:ONIXMessage xmlns:p="x">\n' + body + "</p:ONIXMessage>\n")
    records, corrupt = scan_onix(spark, path, tag="p:Product", end_tag="p:ONIXMessage")
    rows = project_products(records).collect()
    assert [(r.record_reference, r.title) for r in rows] == [("NS1", "Namespaced")] and corrupt.count() == 0
    # read without the prefix, its products are reported, not passed over
    records, corrupt = scan_onix(spark, path)
    assert records.count() == 0 and [r.reason for r in corrupt.collect()] == ["other_prefix"]


def test_one_frame_holds_the_rows_of_both(spark, write_text, tmp_path):
    broken = ATLAS.replace("</TitleText>", "").replace("77-B", "broken")
    untitled = ATLAS.replace("Tidal Atlas", "").replace("77-B", "untitled")
    tags = ATLAS.replace("Forty charts", "Forty <b>charts</b><br/>and one").replace("77-B", "tags")
    other = ATLAS.replace("Product>", "x:Product>").replace("77-B", "other")
    write_text("whole.xml", HEAD + ATLAS + broken + untitled + tags + ATLAS.replace("77-B", "last") + other + TAIL)
    path = write_text("cut.xml", HEAD + ATLAS.replace("77-B", "cut") + broken).rsplit("/", 1)[0]
    records, corrupt = scan_onix(spark, path)
    once = scan_onix_once(spark, path)
    rows = project_products(once, reason="reason")
    assert rows._jdf.queryExecution().executedPlan().toString().count("from_xml") == 1     # both kinds from one parse
    good = rows.where("reason IS NULL").drop("fragment", "reason")
    want = project_products(records)
    assert good.columns == want.columns
    assert sorted(map(str, good.collect())) == sorted(map(str, want.collect()))
    assert {r.subtitle for r in good.collect()} >= {"Forty charts and one"} and good.count() == 3
    assert sorted(map(str, rows.where("reason IS NOT NULL").select(corrupt.columns).collect())) == sorted(map(str, corrupt.collect()))
    assert {r.reason for r in corrupt.collect()} == {"malformed", "file_truncated", "other_prefix"}
