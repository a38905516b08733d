"""Plan properties that matter at scale, checked on small inputs."""

import re

from pyspark.sql import functions as F

from quire.operators import feeds as fm
from quire.operators import merge, search
from quire.operators.products import project_products
from quire.sources import feeds as src
from quire.sources.onix import scan_onix
from quire.sources.store import read_table, write_table


def plan(df) -> str:
    return df._jdf.queryExecution().executedPlan().toString()


def test_parsers_run_once_per_record(spark, write_text):
    xml = write_text("p.xml", "<ONIXMessage>\n<Product><RecordReference>R</RecordReference>"
                              "<NotificationType>03</NotificationType><DescriptiveDetail><TitleDetail><TitleElement>"
                              "<TitleText>T</TitleText></TitleElement></TitleDetail></DescriptiveDetail></Product>\n"
                              "</ONIXMessage>\n")
    p = plan(project_products(scan_onix(spark, xml)[0]))
    assert p.count("from_xml") == 1
    csv = write_text("c/IV01012024.TXT", "HEADER,START\nISBN13,RRP_GBP,DISCOUNT,STOCK,REP_CODE,REP_DATE\n"
                                         "9781234567890,1,2,3,X,01/01/2024\nTRAILER,1\n")
    m = fm.accepted(fm.map_inventory(src.scan_framed(spark, csv, fm.INVENTORY_ALIASES)))
    # one parser for the header lines, one for the body lines
    assert plan(m).count("from_csv") == 2


def test_no_single_partition_exchange_in_merges(spark):
    cur = spark.createDataFrame([("a", 1, "inventory", None, 1.0, 1.0, "X", None)],
                                "isbn13 string, stock_qty int, source string, source_file_key string, rrp_gbp double, "
                                "discount_percent double, report_code string, report_date date")
    cur = cur.withColumn("stock_updated_at", F.current_timestamp())
    inc = cur.withColumn("arrival", F.lit(1).cast("long"))
    p = plan(merge.gated_merge(cur, inc))
    assert "SinglePartition" not in p
    assert "Window" in p and re.search(r"hashpartitioning\(isbn13#\d+, __b", p) is not None


def test_partial_top_k(spark):
    docs = spark.createDataFrame([(1, "merge data"), (2, "merge")], "doc_id long, body string")
    q = spark.createDataFrame([(1, "merge")], "query_id long, lexeme string")
    p = plan(search.search_documents(docs, "doc_id", {"body": "C"}, q, k=1))
    assert p.count("WindowGroupLimit") >= 2      # partial before the shuffle, final after


def test_merge_does_not_shuffle_bucketed_catalogue(spark, tmp_path):
    root = str(tmp_path / "books")
    books = spark.range(1000).select(F.col("id").cast("string").alias("k"), F.col("id").alias("v"))
    write_table(books, root, bucket_col="k", buckets=8)
    cur = read_table(spark, root)
    inc = spark.range(0, 2000, 7).select(F.col("id").cast("string").alias("k"), F.lit(-1).alias("v"))
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        p = plan(merge.upsert(cur, inc, "k", keep=["v"]))
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
    scans = [line for line in p.splitlines() if "FileScan parquet" in line]
    assert scans and all("Bucketed: true" in s for s in scans)
    assert p.count("Exchange hashpartitioning") == 1          # only the incoming side
