"""Structured Streaming jobs: files picked up once, in order, with a batch ledger."""

import datetime as dt

from pyspark.sql import functions as F

from quire.sources.store import read_table, write_table
from quire.streaming import jobs

HEAD = '<?xml version="1.0"?>\n<ONIXMessage>\n'
TAIL = "</ONIXMessage>\n"


def product(ref, title, ntype="03", isbn=None):
    ident = (f"<ProductIdentifier><ProductIDType>15</ProductIDType><IDValue>{isbn}</IDValue></ProductIdentifier>"
             if isbn else "")
    return (f"<Product><RecordReference>{ref}</RecordReference><NotificationType>{ntype}</NotificationType>{ident}"
            f"<DescriptiveDetail><TitleDetail><TitleElement><TitleText>{title}</TitleText></TitleElement>"
            f"</TitleDetail></DescriptiveDetail></Product>\n")


def seed(spark, store):
    t0 = dt.datetime(2024, 1, 1)
    books = spark.createDataFrame(
        [("A", "9780000000001", "Old A", None, t0, False, None, t0, t0)],
        "record_reference string, isbn13 string, title string, long_description string, embedded_at timestamp, "
        "is_removed boolean, removed_at timestamp, created_at timestamp, updated_at timestamp")
    from quire.schemas import BOOK_FIELDS
    cols = [F.col(c) if c in books.columns else F.lit(None).cast("string").alias(c) for c in BOOK_FIELDS]
    rest = [c for c in books.columns if c not in BOOK_FIELDS]
    write_table(books.select(*cols, *rest), f"{store}/books", bucket_col="record_reference", buckets=4)


def test_onix_stream_incremental(spark, tmp_path, write_text):
    store, ckpt, inbox = str(tmp_path / "store"), str(tmp_path / "ckpt"), tmp_path / "in"
    seed(spark, store)
    inbox.mkdir()
    (inbox / "f1.xml").write_text(HEAD + product("A", "New A", isbn="9780000000001") + product("B", "B one") + TAIL)
    jobs.stream_onix(spark, str(inbox), store, ckpt, "2024-06-01").awaitTermination()
    got = {r.record_reference: r for r in read_table(spark, f"{store}/books").collect()}
    assert got["A"].title == "New A" and got["B"].title == "B one"
    # a later file: only it is read; a delete by ISBN removes A
    (inbox / "f2.xml").write_text(HEAD + product("X", "", "05", "9780000000001") + TAIL)
    jobs.stream_onix(spark, str(inbox), store, ckpt, "2024-06-02").awaitTermination()
    got = {r.record_reference: r for r in read_table(spark, f"{store}/books").collect()}
    assert got["A"].is_removed and got["A"].removed_at == dt.datetime(2024, 6, 2)
    assert got["B"].updated_at == dt.datetime(2024, 6, 1)      # f1 not applied again
    assert sorted(r.batch_id for r in jobs.read_batches(spark, store, "onix").collect()) == [0, 1]


def test_stock_stream_inventory_then_hourly(spark, tmp_path):
    store, inbox = str(tmp_path / "store"), tmp_path / "inv"
    inbox.mkdir()
    cur = spark.createDataFrame([("9781234567890", 1, "inventory", "old", 5.0, 1.0, "OLD", None, dt.datetime(2024, 1, 1))],
                                "isbn13 string, stock_qty int, source string, source_file_key string, rrp_gbp double, "
                                "discount_percent double, report_code string, report_date date, "
                                "stock_updated_at timestamp")
    write_table(cur, f"{store}/stock", bucket_col="isbn13", buckets=4)
    (inbox / "IV01022024.TXT").write_text("HEADER,START\nISBN13,RRP_GBP,DISCOUNT,STOCK,REP_CODE,REP_DATE\n"
                                          "9781234567890,12.50,30,7,NYP,02/01/2024\nTRAILER,1\n")
    stamp = lambda name: F.lit("2024-01-02 00:00:00").cast("timestamp")
    jobs.stream_stock(spark, str(inbox), store, str(tmp_path / "c1"), ts=stamp, feed="inventory").awaitTermination()
    hourly = tmp_path / "av"
    hourly.mkdir()
    (hourly / "AV_20240103.001").write_text("UPDATE,20240103\n9781234567890,3\n")
    later = lambda name: F.lit("2024-01-03 00:00:00").cast("timestamp")
    jobs.stream_stock(spark, str(hourly), store, str(tmp_path / "c2"), ts=later).awaitTermination()
    r = read_table(spark, f"{store}/stock").first()
    assert (r.stock_qty, r.source, float(r.rrp_gbp), r.report_code) == (3, "avail13_delta", 12.5, "NYP")
    assert r.stock_updated_at == dt.datetime(2024, 1, 3)


def rich(ref, isbn, subjects=(), prices=(), people=()):
    inner = "".join(f"<Contributor><ContributorRole>A01</ContributorRole><PersonName>{p}</PersonName></Contributor>" for p in people)
    inner += "".join(f"<Subject><SubjectSchemeIdentifier>93</SubjectSchemeIdentifier><SubjectCode>{c}</SubjectCode>"
                     f"<SubjectHeadingText>{h}</SubjectHeadingText></Subject>" for c, h in subjects)
    costs = "".join(f"<Price><PriceAmount>{a}</PriceAmount><Tax><TaxRateCode>S</TaxRateCode><TaxRatePercent>{t}</TaxRatePercent></Tax>"
                    f"<CurrencyCode>GBP</CurrencyCode></Price>" for a, t in prices)
    return product(ref, f"Title {ref}", "03", isbn).replace("</DescriptiveDetail>", inner + "</DescriptiveDetail>").replace(
        "</Product>", f"<ProductSupply><SupplyDetail>{costs}</SupplyDetail></ProductSupply></Product>")


def test_ingest_from_an_empty_store_with_children_and_rejects(spark, tmp_path):
    store, inbox = str(tmp_path / "store"), tmp_path / "in"
    inbox.mkdir()
    (inbox / "f1.xml").write_text(HEAD + rich("A", "9780000000001", [("F1", "Tides"), ("F2", "Maps")], [("5.00", "20"), ("4.00", "0")], ["Ann"])
                                  + rich("B", "9780000000002", [("F1", "Tides")], [], ["Bo", "Cy"])
                                  + rich("C", "9780000000001") + rich("x" * 101, "9780000000003") + TAIL)
    jobs.stream_onix(spark, str(inbox), store, str(tmp_path / "ck"), "2024-06-01").awaitTermination()
    (inbox / "f2.xml").write_text(HEAD + rich("A", "9780000000001", [("F3", "Sails")], [("6.00", "5")]))      # cut short
    jobs.stream_onix(spark, str(inbox), store, str(tmp_path / "ck"), "2024-06-02").awaitTermination()

    def table(name):
        return read_table(spark, f"{store}/{name}").collect()
    assert {r.record_reference for r in table("books")} == {"A", "B"}
    assert sorted((r.record_reference, float(r.price_amount), float(r.tax_rate_percent)) for r in table("book_prices")) == [
        ("A", 4.0, 0.0), ("A", 5.0, 20.0)]
    assert sorted((r.record_reference, r.person_name) for r in table("book_contributors")) == [("A", "Ann"), ("B", "Bo"), ("B", "Cy")]
    assert sorted(r.slug for r in table("genres")) == ["maps", "tides"]
    assert sorted((r.record_reference, r.slug) for r in table("book_genres")) == [("A", "maps"), ("A", "tides"), ("B", "tides")]
    rejects = spark.read.parquet(f"{store}/rejects").collect()
    assert sorted((r.record_reference or "-", r.reason) for r in rejects) == [
        ("-", "file_truncated"), ("C", "isbn_taken"), ("x" * 101, "too_long_record_reference")]
    counts = {r.source_file.rsplit("/", 1)[1]: (r.accepted, r.rejected, r.corrupt) for r in spark.read.parquet(f"{store}/summaries").collect()}
    assert counts == {"f1.xml": (2, 2, 0), "f2.xml": (0, 0, 1)}


def test_bootstrap_keeps_what_full_replace_files_hold(spark, tmp_path, write_text):
    store = str(tmp_path / "store")
    onix = write_text("boot/a.xml", HEAD + product("A", "One", isbn="9780000000001") + TAIL)
    feeds = {
        "inventory": write_text("b1/IV01022024.TXT", "HEADER\nISBN13,RRP_GBP,DISCOUNT,STOCK,REP_CODE,REP_DATE\n9780000000001,5.00,1,3,NYP,01/02/2024\nTRAILER,1\n"),
        "promotions": write_text("b2/GARDPROM13.CSV", "9780000000001,T,A,1.00,2,F,01/02/25\n"),
        "firm_sale": write_text("b3/FIRMSALE13.CSV", "9780000000001,X\n9780000000002,\n"),
        "isbn_slips": write_text("b4/ISBNSL13.CSV", "9780000000001,9790000000001\n"),
        "market_restrictions": write_text("b5/RESTRICT.CSV", "9780000000001,Y,GB\n9780000000001,N,US\n"),
        "regions": write_text("b6/REGIONS.CSV", "GB,Britain\n"), "avail13": f"{store}/no/AV_20240101.000"}
    for as_of in ("2031-01-01", "2031-01-02"):       # later than any file
        status = {r.feed: (r.status, r.rows) for r in jobs.bootstrap(spark, onix, feeds, store, as_of).collect()}
        assert status == {"books": ("completed", 1), "inventory": ("completed", 1), "promotions": ("completed", 1),
                          "firm_sale": ("completed", 2), "isbn_slips": ("completed", 1), "market_restrictions": ("completed", 2),
                          "regions": ("completed", 1), "avail13": ("failed", 0)}
    write_text("b3/FIRMSALE13.CSV", "9780000000002,\n")
    jobs.bootstrap(spark, onix, {"firm_sale": feeds["firm_sale"]}, store, "2031-01-03")
    assert [r.isbn13 for r in read_table(spark, f"{store}/firm_sale").collect()] == ["9780000000002"]


def test_genres_stay_without_subjects_and_each_batch_has_its_time(spark, tmp_path):
    store, inbox = str(tmp_path / "store"), tmp_path / "in"
    inbox.mkdir()
    times = iter(["2024-06-01", "2024-06-02", "2024-06-03"])
    (inbox / "f1.xml").write_text(HEAD + rich("A", "9780000000001", [("F1", "Tides")]) + rich("B", "9780000000002", [("F2", "Maps")]) + TAIL)
    jobs.stream_onix(spark, str(inbox), store, str(tmp_path / "ck"), lambda: next(times)).awaitTermination()
    (inbox / "f2.xml").write_text(HEAD + rich("A", "9780000000001") + TAIL)
    jobs.stream_onix(spark, str(inbox), store, str(tmp_path / "ck"), lambda: next(times)).awaitTermination()
    pairs = read_table(spark, f"{store}/book_genres").collect()
    assert sorted((r.record_reference, r.slug) for r in pairs) == [("A", "tides"), ("B", "maps")]
    books = {r.record_reference: r.updated_at for r in read_table(spark, f"{store}/books").collect()}
    assert books == {"A": dt.datetime(2024, 6, 2), "B": dt.datetime(2024, 6, 1)}


def test_stock_files_of_a_long_run_come_in_few_batches(spark, tmp_path, monkeypatch):
    from quire.plans import streams
    n, files = 180, 9
    kinds = ["click", "view", "error"]
    spark.range(n).select(F.col("id").alias("event_id"), (F.col("id") % 7).alias("user_id"),
                          F.element_at(F.array(*map(F.lit, kinds)), (F.col("id") % 5 % 3 + 1).cast("int")).alias("event_type"),
                          F.format_string('{"k": %d}', F.col("id") % 13).alias("props")).write.parquet(str(tmp_path / "events.parquet"))
    spark.createDataFrame([(k, k, 1.5) for k in range(3)], "c_custkey long, c_nationkey int, c_acctbal double").write.parquet(
        str(tmp_path / "customer.parquet"))
    monkeypatch.setattr(streams, "avail_file_count", lambda events: files)
    seen = {}

    def recorded(s, path, store, *args, **kwargs):
        seen["store"] = store
        return start(s, path, store, *args, **kwargs)
    start = jobs.stream_stock
    monkeypatch.setattr(jobs, "stream_stock", recorded)
    got = {r.isbn13: r for r in streams.q_stream_stock_merge(spark, str(tmp_path)).collect()}
    last = {}
    for i in range(n):
        if kinds[i % 5 % 3] == "click":
            last[f"979{i % 7:010d}"] = (i % 13, f"AV_20240101.{i * files // n:03d}")
    assert {k: (got[k].stock_qty, got[k].source_file_key) for k in last} == last
    assert jobs.read_batches(spark, seen["store"], "stock_avail13").count() <= streams.BATCHES


def test_onix_files_of_a_long_run_come_in_few_batches(spark, tmp_path, monkeypatch):
    from quire.plans import streams
    parts = {f"REF{k}": (k, f"red ring {k % 3}", f"Brand#{k % 4}", "STEEL", k % 5 + 1, 2.5) for k in range(12)}
    spark.createDataFrame(list(parts.values()), "p_partkey long, p_name string, p_brand string, p_type string, p_size int, "
                          "p_retailprice double").write.parquet(str(tmp_path / "part.parquet"))
    monkeypatch.setattr(streams, "onix_file_count", lambda part: 8)
    seen = {}

    def recorded(s, path, store, *args, **kwargs):
        seen["store"] = store
        return start(s, path, store, *args, **kwargs)
    start = jobs.stream_onix
    monkeypatch.setattr(jobs, "stream_onix", recorded)
    got = {r.record_reference: r for r in streams.q_stream_onix_merge(spark, str(tmp_path)).collect()}
    for ref, (k, name, brand, _, size, _) in parts.items():
        if size != 1:
            assert got[ref].title == f"{name} {k}" and got[ref].long_description == f"{name} & {brand}"
    assert jobs.read_batches(spark, seen["store"], "onix").count() <= streams.BATCHES
