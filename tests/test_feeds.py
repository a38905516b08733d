"""Delimited feed scans, mappers, summaries, file rules."""

import datetime as dt

from pyspark.sql import functions as F

from quire.functions import scalars as sc
from quire.operators import feeds as fm
from quire.sources import feeds as src

FRAMED_A = ("HEADER,START\nISBN13,RRP_GBP,DISCOUNT,STOCK,REP_CODE,REP_DATE\n"
            "9781234567890,12.50,35,7,NYP,15/03/2024\n"
            "  9781234567891 ,,,,, \n"
            "SKU123,1,1,1,X,01/01/2024\n"
            "\"9781234567892,1,1,1,X,00/01/2024\n"
            "\n"
            "9781234567893,3.00,10,0,POS,00/01/2024\n"
            "TRAILER,6\n")
FRAMED_B = ("HEADER,START\nISBN,EAN,RRP,DISCOUNT,QTY,REPORT,REPORT-DATE\n"
            "X,9791234567890,9.99,5,3,O/P,31/12/2023\n"
            "TRAILER,1\n")


def test_framed_scan_two_layouts(spark, write_text):
    a = write_text("inv/a/IV03152024.TXT", FRAMED_A)
    b = write_text("inv/b/IV03162024.TXT", FRAMED_B)
    mapped = fm.map_inventory(src.scan_framed(spark, [a, b], fm.INVENTORY_ALIASES))
    rows = {r.isbn13: r for r in fm.accepted(mapped).collect()}
    assert set(rows) == {"9781234567890", "9781234567891", "9781234567893", "9791234567890"}
    r = rows["9781234567890"]
    assert float(r.rrp_gbp) == 12.5 and float(r.discount_percent) == 35 and r.stock_qty == 7
    assert r.report_code == "NYP" and r.report_date == dt.date(2024, 3, 15) and r.source == "inventory"
    assert rows["9781234567891"].stock_qty is None and rows["9781234567891"].report_code is None
    assert rows["9781234567893"].report_date is None          # day 00 = unknown
    assert rows["9791234567890"].report_code == "O/P"         # generic layout via aliases
    summ = {r.source_file.rsplit("/", 1)[-1]: r for r in fm.scan_summary(mapped).collect()}
    a_s = summ["IV03152024.TXT"]
    assert (a_s.total_rows, a_s.skipped_rows, a_s.parse_error_rows, a_s.trailer_count) == (3, 1, 1, 6)
    assert a_s.trailer_mismatch is True          # 3 + 1 + 1 != 6
    assert summ["IV03162024.TXT"].trailer_mismatch is False


def test_avail_positional_and_source(spark, write_text):
    full = write_text("av/AV_20240101.000", "START,20240101\n9781234567890,5\n9781234567891,\n9781234567892,0,extra\n")
    delta = write_text("av/AV_20240101.001", "UPDATE,20240101\n9781234567890\n9781234567893,2\n")
    rows = fm.accepted(fm.map_avail(src.scan_positional(spark, [full, delta], fm.AVAIL_COLUMNS))).collect()
    got = sorted((r.isbn13, r.stock_qty, r.source) for r in rows)
    assert got == [("9781234567890", 5, "avail13_full"), ("9781234567892", 0, "avail13_full"),
                   ("9781234567893", 2, "avail13_delta")]


def test_positional_feeds(spark, write_text):
    p = write_text("GARDPROM13.CSV", '"","(null)","","22.00","55.00","R","31/07/26"\n'
                                    '"9781234567890",""THE X"","Au","10.00","5","F","01/02/25"\n')
    rows = fm.accepted(fm.map_promotions(src.scan_positional(spark, p, fm.PROMOTION_COLUMNS))).collect()
    assert len(rows) == 1 and rows[0].finish_date == dt.date(2025, 2, 1) and rows[0].returns_flag == "F"
    r = write_text("RESTRICT.CSV", "9781234567890,Y,GB\n9781234567890,Q,GB\n9781234567890,N,\n")
    assert fm.accepted(fm.map_restrictions(src.scan_positional(spark, r, fm.RESTRICTION_COLUMNS))).count() == 1
    s = write_text("ISBNSL13.CSV", "9781234567890,9791234567890\n9781234567890,123\n")
    assert fm.accepted(fm.map_isbn_slips(src.scan_positional(spark, s, fm.ISBN_SLIP_COLUMNS))).count() == 1


def test_scalar_rules(spark):
    df = spark.createDataFrame([(" 9781234567890 ", "31/02/2024", "15/03/24", "  42abc", "My Book Title!.XML")],
                               "a string, b string, c string, d string, e string")
    r = df.select(sc.valid_isbn13("a").alias("v"), sc.dmy_date("b").alias("d1"), sc.dm2y_date("c").alias("d2"),
                  sc.leading_int("d").alias("i"), sc.slugify("e").alias("s"),
                  sc.safe_filename(F.col("e"), F.lit(7)).alias("f"),
                  sc.avail_source(F.lit("AV_20240101.000")).alias("src")).first()
    assert r.v is True and r.d1 is None and r.d2 == dt.date(2024, 3, 15) and r.i == 42
    assert r.s == "my_book_titlexml" and r.f == "my_book_title_7.XML" and r.src == "avail13_full"


def test_url_rules(spark):
    df = spark.createDataFrame([("http://books.example.com/books/content?id=AbC&edge=curl&zoom=1&x=2",)], "u string")
    r = df.select(sc.high_res_cover_url("u").alias("h"), sc.volume_id("u").alias("v"),
                  sc.lookup_query(F.lit(None), F.lit("A Title (2)"), F.lit("Ann O'Neil")).alias("q")).first()
    assert r.h == "https://books.example.com/books/content?id=AbC&zoom=5&x=2&fife=w800"
    assert r.v == "AbC"
    assert r.q == "intitle%3AA%20Title%20(2)%2Binauthor%3AAnn%20O'Neil"


def test_manifest_rules_and_done_gate(spark):
    m = spark.createDataFrame([("/x/IV03152024.TXT",), ("/x/IV03152024.TXT.DONE",), ("/x/IV03162024.TXT",),
                               ("/x/gardprom13.csv",), ("/x/notes.txt",)], "path string")
    m = m.withColumn("filename", F.regexp_extract("path", "([^/]*)$", 1)).withColumn("size", F.lit(1))
    tagged = {r.filename: r.feed for r in src.match_feed(m, src.feed_rules(spark, "")).collect()}
    assert tagged == {"IV03152024.TXT": "inventory", "IV03162024.TXT": "inventory", "gardprom13.csv": "promotions"}
    gated = [r.path for r in src.done_gate(src.match_feed(m, src.feed_rules(spark, "")), only_needing=True, listing=m).collect()]
    assert sorted(gated) == ["/x/IV03152024.TXT", "/x/gardprom13.csv"]


def test_list_files_reads_no_bodies(spark, write_text):
    a = write_text("ls/a.xml", "x" * 10)
    write_text("ls/b.txt", "y")
    m = src.list_files(spark, a.rsplit("/", 1)[0], suffix=".xml").collect()
    assert [(r.filename, r.size) for r in m] == [("a.xml", 10)]


def test_wide_header_and_quotes(spark, write_text):
    head = ",".join([f"C{i}" for i in range(38)] + ["ISBN13", "STOCK"])
    row = ",".join([f"v{i}" for i in range(38)] + ["9781234567890", "4"])
    path = write_text("inv/IV01022024.TXT", f"HEADER,START\n{head}\n{row}\nTRAILER,1\n")
    rows = fm.accepted(fm.map_inventory(src.scan_framed(spark, path, fm.INVENTORY_ALIASES))).collect()
    assert [(r.isbn13, r.stock_qty) for r in rows] == [("9781234567890", 4)]
    lines = ['9781234567891,7" Single,A', '9781234567892,"Say ""Hi"" now, please",B', '9781234567893,"never closed,C',
             '9781234567894,plain,"D"', '9781234567895,"two', 'lines",E']
    raw = src.scan_positional(spark, write_text("GARDPROM13.CSV", "\n".join(lines) + "\n"), ["isbn13", "title", "author"])
    got = {r.isbn13: (r.title, r.author, r.parse_error) for r in raw.collect()}
    assert got["9781234567891"] == ('7" Single', "A", False)
    assert got["9781234567892"] == ('Say "Hi" now, please', "B", False)
    assert got["9781234567894"] == ("plain", "D", False)
    assert got["9781234567893"][2] is True and got["9781234567895"] == ("two\nlines", "E", False)


def test_records_over_several_lines_and_splits(spark, write_text):
    """Random quoted titles with line breaks, split into small blocks, against a plain reader."""
    import csv
    import io
    import random

    from pyspark.sql import functions as F

    from quire.sources import feeds as src
    rng = random.Random(4)
    rows = [(f"{i}", "".join(rng.choice(["ab ", "c", ",", "\n", '"', "x\ny"]) for _ in range(rng.randint(0, 8))).strip(" ,") + "e", "z" * rng.randint(0, 30))
            for i in range(400)]
    out = io.StringIO()
    csv.writer(out, lineterminator="\n").writerows(rows)
    plain = [r for r in csv.reader(io.StringIO(out.getvalue()))]
    assert [tuple(r) for r in plain] == rows
    path = write_text("many/A.CSV", out.getvalue())
    before = spark.conf.get("spark.sql.files.maxPartitionBytes")
    spark.conf.set("spark.sql.files.maxPartitionBytes", "900b")
    try:
        raw = src.scan_positional(spark, path, ["id", "title", "tail"])
        got = raw.select("id", F.regexp_replace("title", "\n+", "\n").alias("title"), "tail", "parse_error").collect()
    finally:
        spark.conf.set("spark.sql.files.maxPartitionBytes", before)
    tidy = lambda t: __import__("re").sub("\n+", "\n", t)  # noqa: E731  (empty lines are passed over by the scan)
    assert not any(r.parse_error for r in got)
    assert sorted((r.id, r.title.strip(), r.tail) for r in got) == sorted((i, tidy(t).strip(), z) for i, t, z in rows)
