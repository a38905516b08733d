"""Wholesaler-feed queries (Q03-Q06, Q09, Q12-Q17, Q32).

Each query derives its feed files from the test tables with Spark, writes them
to the shared folder, and runs the real scan -> map -> merge operators on them.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from quire.functions.scalars import dm2y_date, dmy_date, leading_int, onix_date, trim_ws, valid_isbn13
from quire.operators import feeds as fm
from quire.operators import merge
from quire.plans.common import as_of, date_str, days_before, isbn_of, load, ts_str
from quire.session import stage_path
from quire.sources import feeds as src
from quire.sources.store import rename_single_parts, write_framed_text, write_ordered_text


def _q(c) -> F.Column:
    """CSV-quote a cell."""
    return F.concat(F.lit('"'), c, F.lit('"'))


def _csv(*cells) -> F.Column:
    return F.concat_ws(",", *[F.coalesce(c, F.lit("")) for c in cells])


def write_named(spark: SparkSession, lines: DataFrame, name: str, files: dict[int, str],
                head_by_file: dict[int, list[str]] | None = None) -> str:
    """Write ``lines`` (file_no, seq, line) as files named ``files[file_no]``."""
    path = stage_path(spark, name)
    if head_by_file:
        h = spark.createDataFrame([(k, i, t) for k, v in head_by_file.items() for i, t in enumerate(v)],
                                  "file_no int, __h int, line string")
        seq_type = lines.schema["seq"].dataType
        lines = lines.select(F.col("file_no").cast("int"), F.lit(1).alias("__h0"), F.col("seq"), "line")
        h = h.select("file_no", F.lit(0).alias("__h0"), F.lit(None).cast(seq_type).alias("seq"), "line")
        lines = lines.unionByName(h).select("file_no", F.struct("__h0", "seq").alias("seq"), "line")
    write_framed_text(lines, path, max(files) + 1)
    rename_single_parts(spark, path, {str(k): v for k, v in files.items()})
    return path


def write_feed(spark: SparkSession, lines: DataFrame, name: str) -> str:
    """One logical feed file ``name`` (``seq``, ``line``), written in parallel as
    ordered parts under ``<stage>/<name>/``; the readers scan the folder."""
    path = f"{stage_path(spark, name.lower().replace('.', '-'))}/{name}"
    write_ordered_text(lines, path)
    return path


# --- Q03 / Q04: manifest, feed rules, DONE gate ------------------------------------------

def _feed_filename(o: DataFrame) -> F.Column:
    c = F.col
    d8 = F.date_format("o_orderdate", "MMddyyyy")
    fixed = F.array(*[F.lit(x) for x in ("GARDPROM13.CSV", "FIRMSALE13.CSV", "ISBNSL13.CSV",
                                          "RESTRICT.CSV", "REGIONS.CSV", "README.TXT")])
    return (F.when(c("o_orderpriority") == "1-URGENT", F.concat(F.lit("IV"), d8, F.lit(".TXT")))
            .when(c("o_orderpriority") == "2-HIGH",
                  F.concat(F.lit("AV_"), F.date_format("o_orderdate", "yyyyMMdd"), F.lit("."),
                           F.lpad((c("o_orderkey") % 1000).cast("string"), 3, "0")))
            .when(c("o_orderpriority") == "3-MEDIUM",
                  F.concat(F.lit("WholesaleONIX3_wk"), ((c("o_orderkey") % 52) + 1).cast("string"),
                           F.when(c("o_orderstatus") == "F", F.lit("_Full.zip")).otherwise(F.lit("_Delta.zip"))))
            .when(c("o_orderpriority") == "4-NOT SPECIFIED",
                  F.element_at(fixed, ((c("o_orderkey") % 6) + 1).cast("int")))
            .otherwise(F.when(c("o_orderstatus") == "P",
                              F.concat(F.lit("BookImages_wk"), (c("o_orderkey") % 9).cast("string"), F.lit(".zip")))
                       .otherwise(F.concat(F.lit("iv"), d8, F.lit(".txt.bak")))))


def manifest_from_orders(orders: DataFrame) -> DataFrame:
    fn = _feed_filename(orders)
    return orders.select(
        F.concat(F.lit("/feeds/"), F.col("o_custkey").cast("string"), F.lit("/"), F.col("o_orderkey").cast("string"),
                 F.lit("/"), fn).alias("path"),
        fn.alias("filename"),
        F.col("o_orderdate").alias("modified_at"),
        (F.col("o_totalprice") * 100000).cast("long").alias("size"))


def q_feed_manifest(spark: SparkSession, sf: str) -> DataFrame:
    """Q03 (O-04, O-38): files tagged with their feed; oversize cover zips flagged."""
    m = src.match_feed(manifest_from_orders(load(spark, sf, "orders")), src.feed_rules(spark, "Wholesale"))
    return m.select("path", "feed", "needs_done", src.oversize().alias("oversize"))


def q_done_gate(spark: SparkSession, sf: str) -> DataFrame:
    """Q04 (O-05): inventory files count only with a ``.DONE`` sibling."""
    o = load(spark, sf, "orders")
    data = o.select(F.concat(F.lit("/inv/"), F.col("o_orderkey").cast("string"), F.lit("/IV"),
                             F.date_format("o_orderdate", "MMddyyyy"), F.lit(".TXT")).alias("path"))
    done = o.where(F.col("o_orderstatus") == "F").select(F.concat(
        F.lit("/inv/"), F.col("o_orderkey").cast("string"), F.lit("/IV"),
        F.date_format("o_orderdate", "MMddyyyy"), F.lit(".TXT.DONE")).alias("path"))
    manifest = data.unionByName(done).withColumn("filename", F.regexp_extract("path", "([^/]*)$", 1))
    return src.done_gate(manifest).where(~F.col("path").endswith(".DONE")).select("path")


# --- Q05: framed inventory ------------------------------------------------------------------

def _inventory_cells(e: DataFrame):
    c = F.col
    isbn = F.when(c("event_type") == "error", F.concat(F.lit("SKU"), c("event_id").cast("string"))) \
        .otherwise(isbn_of("979", "user_id"))
    isbn = F.when((c("event_type") == "error") & (c("event_id") % 7 == 0), F.concat(F.lit('"'), isbn)).otherwise(isbn)
    d = F.date_format("ts", "dd/MM/yyyy")
    rep_date = F.when(c("event_id") % 13 == 0, F.concat(F.lit("00"), F.substring(d, 3, 8))).otherwise(d)
    stock = F.when(c("event_type") == "view", F.lit("")).otherwise(F.get_json_object("props", "$.k"))
    return [isbn, c("value").cast("string"), (c("event_id") % 40).cast("string"), stock,
            F.upper(F.substring("event_type", 1, 3)), rep_date]


def inventory_files_per_layout(events: DataFrame, per_file: int = 50_000) -> int:
    return max(2, -(-events.count() // (2 * per_file)))


def _write_inventory(spark: SparkSession, events: DataFrame) -> tuple[str, str]:
    """Framed inventory files: ``n`` per header layout, events spread by id; the
    second generic file's trailer is off by one (a mismatch to report)."""
    n = inventory_files_per_layout(events)
    e = events.withColumn("file_no", F.pmod(F.col("event_id"), F.lit(2 * n)).cast("int"))
    cells = _inventory_cells(e)
    bespoke = e.where(F.col("file_no") < n).select("file_no", F.col("event_id").alias("seq"), _csv(*cells).alias("line"))
    generic = e.where(F.col("file_no") >= n).select((F.col("file_no") - n).alias("file_no"),
                                                    F.col("event_id").alias("seq"),
                                                    _csv(F.lit("X"), *cells).alias("line"))
    paths = []
    for name, lines, header, bump in (
            ("inv-bespoke", bespoke, "ISBN13,RRP_GBP,DISCOUNT,STOCK,REP_CODE,REP_DATE", 0),
            ("inv-generic", generic, "ISBN,EAN,RRP,DISCOUNT,QTY,REPORT,REPORT-DATE", 1)):
        counts = lines.groupBy("file_no").count()
        trailer = counts.select("file_no", F.lit(1 << 62).cast("long").alias("seq"),
                                F.concat(F.lit("TRAILER,"),
                                         (F.col("count") + F.when(F.col("file_no") == 1, F.lit(bump))
                                          .otherwise(F.lit(0))).cast("string")).alias("line"))
        path = stage_path(spark, name)
        write_framed_text(lines.unionByName(trailer), path, n, ["HEADER,START", header])
        paths.append(path)
    return paths[0], paths[1]


def _inventory_mapped(spark: SparkSession, sf: str) -> DataFrame:
    a, b = _write_inventory(spark, load(spark, sf, "events"))
    raw = src.scan_framed(spark, [a, b], fm.INVENTORY_ALIASES)
    return fm.map_inventory(raw, ts=as_of())


def q_framed_csv_inventory(spark: SparkSession, sf: str) -> DataFrame:
    """Q05 (O-06, O-08, O-27, O-28, O-30): framed inventory files, two header layouts."""
    rows = fm.accepted(_inventory_mapped(spark, sf))
    return rows.select("isbn13", F.col("rrp_gbp").cast("double").alias("rrp_gbp"),
                       F.col("discount_percent").cast("double").alias("discount_percent"),
                       F.col("stock_qty").cast("long").alias("stock_qty"), "report_code",
                       date_str("report_date").alias("report_date"), "source")


def q_framed_csv_summary(spark: SparkSession, sf: str) -> DataFrame:
    """Q05b (O-26): per-layout totals of the per-file scan summaries."""
    s = fm.scan_summary(_inventory_mapped(spark, sf))
    layout = F.when(F.col("source_file").contains("inv-bespoke"), F.lit("bespoke")).otherwise(F.lit("generic"))
    return s.groupBy(layout.alias("layout")).agg(
        F.count("*").alias("files"), F.sum("total_rows").alias("total_rows"),
        F.sum("skipped_rows").alias("skipped_rows"), F.sum("parse_error_rows").alias("parse_error_rows"),
        F.sum("trailer_count").alias("trailer_total"),
        F.count_if("trailer_mismatch").alias("mismatched_files"))


# --- Q06: hourly stock files ------------------------------------------------------------------

def avail_file_count(events: DataFrame, per_file: int = 50_000) -> int:
    """Hourly stock files for a run: at least 4, at most ``per_file`` rows each."""
    return max(4, -(-events.count() // per_file))


def q_unframed_csv_avail(spark: SparkSession, sf: str) -> DataFrame:
    """Q06 (O-07, O-31, O-32): ``AV_*.000`` full + ``.001…`` deltas, marker line, qty-only rows."""
    e = load(spark, sf, "events")
    c = F.col
    isbn = F.when(c("event_type") == "error", F.concat(F.lit("SKU"), c("event_id").cast("string"))) \
        .otherwise(isbn_of("979", "user_id"))
    qty = F.when(c("event_type") == "view", F.lit("")).otherwise(F.get_json_object("props", "$.k"))
    nf = avail_file_count(e)
    lines = e.select(F.pmod(c("event_id"), F.lit(nf)).cast("int").alias("file_no"), c("event_id").alias("seq"),
                     _csv(isbn, qty).alias("line"))
    names = {k: f"AV_20240101.{k:03d}" for k in range(nf)}
    heads = {k: ["START,20240101 06:00" if k == 0 else f"UPDATE,20240101 {k:03d}"] for k in range(nf)}
    path = write_named(spark, lines, "avail", names, heads)
    raw = src.scan_positional(spark, path, fm.AVAIL_COLUMNS)
    rows = fm.accepted(fm.map_avail(raw, ts=as_of()))
    return rows.select("isbn13", F.col("stock_qty").cast("long").alias("stock_qty"), "source")


# --- Q09 / Q12 / Q13: scalar parsing rules -----------------------------------------------

def q_onix_parse_scalars(spark: SparkSession, sf: str) -> DataFrame:
    """Q09 (O-16, O-20): leading-integer parse and ONIX dates on strings from ``orders``."""
    o = load(spark, sf, "orders")
    c = F.col
    d = F.date_format("o_orderdate", "yyyyMMdd")
    raw_date = (F.when(c("o_orderkey") % 19 == 0, F.lit("20241399"))
                .when(c("o_orderkey") % 5 == 0, F.substring(d, 1, 6))
                .when(c("o_orderkey") % 3 == 0, F.concat(d, F.lit("T00")))
                .otherwise(d))
    small = F.concat(F.lit("  "), ((c("o_orderkey") % 7) - 3).cast("string"), F.lit("x"))
    return o.select(
        "o_orderkey",
        leading_int("o_orderpriority").cast("long").alias("priority_int"),
        leading_int(c("o_totalprice").cast("string")).cast("long").alias("price_int"),
        leading_int(small).cast("long").alias("small_int"),
        date_str(onix_date(raw_date)).alias("pub_date"),
    )


def isbn_candidates(customer: DataFrame) -> DataFrame:
    c = F.col
    k = c("c_custkey")
    v = k % 6
    raw = (F.when(v == 0, isbn_of("978", k))
           .when(v == 1, F.concat(F.lit(" "), isbn_of("979", k), F.lit(" ")))
           .when(v == 2, isbn_of("977", k))
           .when(v == 3, F.concat(F.lit("978"), F.lpad(k.cast("string"), 9, "0")))
           .when(v == 4, c("c_name"))
           .otherwise(F.concat(F.lit("9790"), F.lpad(k.cast("string"), 9, "0"), F.lit("X"))))
    return customer.select(k.alias("c_custkey"), raw.alias("raw"))


def q_isbn_filter(spark: SparkSession, sf: str) -> DataFrame:
    """Q12 (O-25): ISBN-13 validity after trimming, no check digit."""
    cand = isbn_candidates(load(spark, sf, "customer"))
    ok = valid_isbn13("raw")
    return cand.select("c_custkey", "raw", ok.alias("is_valid"), F.when(ok, trim_ws("raw")).alias("isbn13"))


def q_feed_dates(spark: SparkSession, sf: str) -> DataFrame:
    """Q13 (O-28, O-29): ``DD/MM/YYYY`` (day 00 = unknown) and ``DD/MM/YY`` dates."""
    o = load(spark, sf, "orders")
    c = F.col
    d = F.date_format("o_orderdate", "dd/MM/yyyy")
    raw1 = (F.when(c("o_orderkey") % 11 == 0, F.concat(F.lit("00"), F.substring(d, 3, 8)))
            .when(c("o_orderkey") % 13 == 0, F.concat(F.substring(d, 1, 3), F.lit("13"), F.substring(d, 6, 5)))
            .otherwise(d))
    d2 = F.date_format("o_orderdate", "dd/MM/yy")
    raw2 = F.when(c("o_orderkey") % 17 == 0, F.concat(F.lit("31/02/"), F.substring(d2, 7, 2))).otherwise(d2)
    return o.select("o_orderkey", raw1.alias("raw1"), date_str(dmy_date(raw1)).alias("date1"),
                    raw2.alias("raw2"), date_str(dm2y_date(raw2)).alias("date2"))


# --- Q14 / Q32: promotions, firm sale (upsert, mark and sweep) --------------------------------

def current_promotions(customer: DataFrame) -> DataFrame:
    return customer.select(
        isbn_of("978", "c_custkey").alias("isbn13"), F.col("c_name").alias("title"),
        F.col("c_mktsegment").alias("author"), F.col("c_acctbal").cast("decimal(10,2)").alias("price"),
        F.col("c_nationkey").cast("decimal(5,2)").alias("discount_percent"), F.lit("R").alias("returns_flag"),
        F.lit(None).cast("date").alias("finish_date"), F.lit("OLD.CSV").alias("source_file_key"),
        days_before(7).alias("synced_at"), days_before(30).alias("created_at"))


def _promotion_rows(spark: SparkSession, orders: DataFrame) -> DataFrame:
    c = F.col
    isbn = F.when(c("o_orderstatus") == "P", F.lit("")).otherwise(isbn_of("978", "o_custkey"))
    line = _csv(_q(isbn), _q(F.concat(F.lit("Order "), c("o_orderkey").cast("string"))), _q(c("o_orderpriority")),
                c("o_totalprice").cast("string"), (c("o_orderkey") % 50).cast("string"),
                F.when(c("o_orderstatus") == "F", F.lit("F")).otherwise(F.lit("R")),
                F.date_format("o_orderdate", "dd/MM/yy"))
    lines = orders.select(c("o_orderkey").alias("seq"), line.alias("line"))
    path = write_feed(spark, lines, "GARDPROM13.CSV")
    raw = src.scan_positional(spark, path, fm.PROMOTION_COLUMNS)
    return fm.accepted(fm.map_promotions(raw, file_key=F.lit("GARDPROM13.CSV"), ts=as_of()))


def _promotions_merged(spark: SparkSession, sf: str) -> DataFrame:
    cur = current_promotions(load(spark, sf, "customer"))
    inc = _promotion_rows(spark, load(spark, sf, "orders"))
    return merge.upsert(cur, inc, "isbn13", order="arrival", keep=["created_at"],
                        on_insert={"created_at": as_of()}).drop("arrival")


def promotion_view(df: DataFrame) -> DataFrame:
    return df.select("isbn13", "title", "author", F.col("price").cast("double").alias("price"),
                     F.col("discount_percent").cast("double").alias("discount_percent"), "returns_flag",
                     date_str("finish_date").alias("finish_date"), ts_str("synced_at").alias("synced_at"),
                     ts_str("created_at").alias("created_at"))


def q_multiline_csv(spark: SparkSession, sf: str) -> DataFrame:
    """O-08: promotions whose titles hold line breaks (one, or two with an empty quote between), read as one row each."""
    c, k = F.col, F.col("o_orderkey")
    title = F.concat(F.lit("Order "), k.cast("string"), F.when(k % 5 == 0, F.lit("\nsecond, line")).when(
        k % 7 == 0, F.lit('\nsays ""no""\n')).otherwise(F.lit("")))
    line = _csv(isbn_of("978", "o_orderkey"), _q(title), _q(c("o_orderpriority")), c("o_totalprice").cast("string"),
                (k % 50).cast("string"), F.lit("F"), F.lit("01/02/24"))
    lines = load(spark, sf, "orders").select(k.alias("seq"), line.alias("line"))
    raw = src.scan_positional(spark, write_feed(spark, lines, "GARDPROM13.CSV"), fm.PROMOTION_COLUMNS)
    rows = fm.accepted(fm.map_promotions(raw, file_key=F.lit("GARDPROM13.CSV"), ts=as_of()))
    return rows.select("isbn13", F.replace("title", F.lit("\n"), F.lit("/")).alias("title"), F.col("price").cast("double").alias("price"))


def q_promotions_upsert(spark: SparkSession, sf: str) -> DataFrame:
    """Q14 (O-33, O-70): promotions file merged into the table by ISBN, last row of a key wins."""
    return promotion_view(_promotions_merged(spark, sf))


def q_mark_and_sweep(spark: SparkSession, sf: str) -> DataFrame:
    """Q32 (O-71): full-replace feed — rows the file did not re-sync are swept."""
    return promotion_view(merge.sweep(_promotions_merged(spark, sf), "synced_at", as_of()))


def q_firm_sale_upsert(spark: SparkSession, sf: str) -> DataFrame:
    """Q14b (O-34, O-70): firm-sale file (one line per line item) merged by ISBN."""
    li = load(spark, sf, "lineitem")
    c = F.col
    code = F.when(c("l_linestatus") == "O", F.lit("")).otherwise(F.concat(c("l_returnflag"), c("l_linestatus")))
    from quire.plans.adapters import LINE_ORDER
    lines = li.select(F.struct(*[c(x) for x in LINE_ORDER]).alias("seq"),
                      _csv(isbn_of("978", "l_partkey"), code).alias("line"))
    path = write_feed(spark, lines, "FIRMSALE13.CSV")
    raw = src.scan_positional(spark, path, fm.FIRM_SALE_COLUMNS)
    inc = fm.accepted(fm.map_firm_sale(raw, file_key=F.lit("FIRMSALE13.CSV"), ts=as_of()))
    part = load(spark, sf, "part")
    cur = part.select(isbn_of("978", "p_partkey").alias("isbn13"), F.col("p_brand").alias("report_code"),
                      F.lit("OLD.CSV").alias("source_file_key"), days_before(7).alias("synced_at"),
                      days_before(30).alias("created_at"))
    out = merge.upsert(cur, inc, "isbn13", order="arrival", keep=["created_at"],
                       on_insert={"created_at": as_of()}).drop("arrival")
    return out.select("isbn13", "report_code", ts_str("synced_at").alias("synced_at"),
                      ts_str("created_at").alias("created_at"))


# --- Q15 / Q16: ISBN redirects, market restrictions, regions ----------------------------------

def q_isbn_slips(spark: SparkSession, sf: str) -> DataFrame:
    """Q15 (O-35, O-70): ISBN redirect file, both ISBNs valid, upsert by old ISBN."""
    s = load(spark, sf, "supplier")
    c = F.col
    new = F.when(c("s_acctbal") < 0, F.lit("0001")).otherwise(isbn_of("979", c("s_suppkey") * 7 + c("s_nationkey")))
    lines = s.select(c("s_suppkey").alias("seq"), _csv(_q(isbn_of("978", "s_suppkey")), _q(new)).alias("line"))
    path = write_feed(spark, lines, "ISBNSL13.CSV")
    raw = src.scan_positional(spark, path, fm.ISBN_SLIP_COLUMNS)
    inc = fm.accepted(fm.map_isbn_slips(raw, file_key=F.lit("ISBNSL13.CSV"), ts=as_of()))
    part = load(spark, sf, "part")
    cur = part.select(isbn_of("978", "p_partkey").alias("old_isbn13"), isbn_of("979", "p_partkey").alias("new_isbn13"),
                      F.lit("OLD.CSV").alias("source_file_key"), days_before(7).alias("synced_at"),
                      days_before(30).alias("created_at"))
    out = merge.upsert(cur, inc, "old_isbn13", order="arrival", keep=["created_at"],
                       on_insert={"created_at": as_of()}).drop("arrival")
    return out.select("old_isbn13", "new_isbn13", ts_str("synced_at").alias("synced_at"),
                      ts_str("created_at").alias("created_at"))


def q_restrictions_upsert(spark: SparkSession, sf: str) -> DataFrame:
    """Q16 (O-36, O-70): market restrictions, composite key (ISBN, region)."""
    o, cu, n = load(spark, sf, "orders"), load(spark, sf, "customer"), load(spark, sf, "nation")
    c = F.col
    j = o.join(cu.select("c_custkey", "c_nationkey"), o.o_custkey == cu.c_custkey).join(
        n.select("n_nationkey", "n_name"), c("c_nationkey") == c("n_nationkey"))
    flag = F.when(c("o_orderstatus") == "F", F.lit("Y")).when(c("o_orderstatus") == "O", F.lit("N")).otherwise(F.lit("X"))
    region = F.when(c("o_orderpriority") == "5-LOW", F.lit(" ")).otherwise(c("n_name"))
    lines = j.select(c("o_orderkey").alias("seq"), _csv(isbn_of("978", "o_custkey"), flag, region).alias("line"))
    path = write_feed(spark, lines, "RESTRICT.CSV")
    raw = src.scan_positional(spark, path, fm.RESTRICTION_COLUMNS)
    inc = fm.accepted(fm.map_restrictions(raw, file_key=F.lit("RESTRICT.CSV"), ts=as_of()))
    cur = cu.join(n, cu.c_nationkey == n.n_nationkey).select(
        isbn_of("978", "c_custkey").alias("isbn13"), F.lit("N").alias("flag"), c("n_name").alias("region_code"),
        F.lit("OLD.CSV").alias("source_file_key"), days_before(7).alias("synced_at"),
        days_before(30).alias("created_at"))
    out = merge.upsert(cur, inc, ["isbn13", "region_code"], order="arrival", keep=["created_at"],
                       on_insert={"created_at": as_of()}).drop("arrival")
    return out.select("isbn13", "region_code", "flag", ts_str("synced_at").alias("synced_at"),
                      ts_str("created_at").alias("created_at"))


def q_regions_upsert(spark: SparkSession, sf: str) -> DataFrame:
    """Q16b (O-37, O-70): region names, both fields required."""
    n, r = load(spark, sf, "nation"), load(spark, sf, "region")
    c = F.col
    lines = n.select(c("n_nationkey").cast("long").alias("seq"),
                     _csv(F.concat(F.lit("R"), c("n_regionkey").cast("string")),
                          F.when(c("n_nationkey") % 5 == 4, F.lit("")).otherwise(c("n_name"))).alias("line"))
    path = write_feed(spark, lines, "REGIONS.CSV")
    raw = src.scan_positional(spark, path, fm.REGION_COLUMNS)
    inc = fm.accepted(fm.map_regions(raw, ts=as_of()))
    cur = r.select(F.concat(F.lit("R"), c("r_regionkey").cast("string")).alias("code"), c("r_name").alias("name"),
                   days_before(7).alias("synced_at"))
    out = merge.upsert(cur, inc, "code", order="arrival").drop("arrival")
    return out.select("code", "name", ts_str("synced_at").alias("synced_at"))


# --- Q17: book id backfill ---------------------------------------------------------------

def q_book_id_backfill(spark: SparkSession, sf: str) -> DataFrame:
    """Q17 (O-39): unlinked stock rows get the id of the book with their ISBN,
    only for ISBNs touched by this run."""
    li, part = load(spark, sf, "lineitem"), load(spark, sf, "part")
    stock = li.groupBy("l_partkey").agg(F.max("l_linenumber").alias("m")).select(
        isbn_of("978", "l_partkey").alias("isbn13"),
        F.when(F.col("m") >= 7, F.lit(-1)).cast("long").alias("book_id"))
    books = part.select((F.col("p_partkey") * 10).alias("id"), isbn_of("978", "p_partkey").alias("isbn13"))
    touched = li.where(F.col("l_returnflag") == "R").select(isbn_of("978", "l_partkey").alias("isbn13"))
    return merge.link_ids(stock, books, touched=touched)
