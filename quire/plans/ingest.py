"""The whole ONIX ingest over three runs (O-23, O-62 ... O-69, O-74, O-98), and ISBNs
that move between books (O-64, O-65)."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from quire.operators import merge
from quire.plans import adapters
from quire.plans.books import onix_file_count
from quire.plans.common import AS_OF, el, el_raw, isbn_of, load, ref_of, ts_str, xml_escape
from quire.session import spread, stage_path
from quire.sources.onix import scan_onix_once
from quire.sources.store import read_table, write_framed_text
from quire.streaming.jobs import ingest_products

RUNS = ("2024-06-01 00:00:00", "2024-06-02 00:00:00", "2024-06-03 00:00:00")


def _subject(scheme: str, code: Column, heading: Column) -> Column:
    return el_raw("Subject", el("SubjectSchemeIdentifier", F.lit(scheme)), el("SubjectCode", code),
                  el("SubjectHeadingText", xml_escape(heading)))


def _price(amount: Column, tax: Column | None = None) -> Column:
    parts = [el("PriceType", F.lit("02")), el("PriceAmount", amount)]
    if tax is not None:
        parts.append(el_raw("Tax", el("TaxRateCode", F.lit("S")), el("TaxRatePercent", tax)))
    return el_raw("Price", *parts, el("CurrencyCode", F.lit("GBP")))


def _person(seq: int, role: str, name: Column) -> Column:
    return el_raw("Contributor", el("SequenceNumber", F.lit(str(seq))), el("ContributorRole", F.lit(role)),
                  el("PersonName", xml_escape(name)))


def _fragment(ref: Column, kind: str, isbn: Column, title: Column | None = None, people: Column | None = None,
              subjects: Column | None = None, prices: Column | None = None) -> Column:
    nothing = F.lit("")
    ident = F.when(isbn.isNull(), nothing).otherwise(
        el_raw("ProductIdentifier", el("ProductIDType", F.lit("15")), el("IDValue", F.coalesce(isbn, nothing))))
    detail = nothing if title is None else el_raw(
        "DescriptiveDetail", el_raw("TitleDetail", el_raw("TitleElement", el("TitleText", xml_escape(title)))),
        people if people is not None else nothing, subjects if subjects is not None else nothing)
    supply = nothing if prices is None else el_raw("ProductSupply", el_raw("SupplyDetail", prices))
    return F.concat(F.lit("<Product>"), el("RecordReference", ref), el("NotificationType", F.lit(kind)), ident, detail, supply,
                    F.lit("</Product>"))


def run_fragments(part: DataFrame) -> list[DataFrame]:
    """(seq, line) of three runs: all parts (some too long, some malformed); changed books,
    most without subjects and some under a new ISBN; deletes by old ISBN, new ISBN and reference."""
    c, k = F.col, F.col("p_partkey")
    none, ref = F.lit(""), ref_of("REF", k)
    title = F.concat_ws(" ", c("p_name"), k.cast("string"))
    first = _fragment(
        ref, "03", isbn_of("978", k), F.when(k % 50 == 7, F.repeat(F.lit("x"), 2001)).otherwise(title),
        _person(1, "A01", F.concat(F.lit("Author "), c("p_brand"))),
        F.concat(_subject("93", F.upper(F.substring("p_type", 1, 3)), c("p_type")),
                 F.when(k % 3 == 0, _subject("93", F.lit("N"), c("p_name"))).otherwise(none), _subject("10", F.lit("B"), c("p_brand"))),
        F.concat(_price(F.concat(c("p_size").cast("string"), F.lit(".50")), F.lit("20.0")),
                 F.when(k % 2 == 0, _price(c("p_size").cast("string"))).otherwise(none)))
    first = F.when(k % 40 == 11, F.regexp_replace(first, "</TitleText>", "")).otherwise(first)
    isbn = F.when(k % 6 == 0, isbn_of("979", k)).otherwise(isbn_of("978", k))
    second = _fragment(
        ref, "03", isbn, F.concat_ws(" ", c("p_name"), F.lit("2nd"), k.cast("string")),
        F.concat(_person(1, "A01", F.concat(F.lit("Second "), c("p_brand"))), _person(2, "B01", c("p_type"))),
        F.when(k % 3 == 1, _subject("93", F.lit("OG"), F.lit("Other genre"))).otherwise(none),
        _price(F.lit("9.99"), (c("p_size") % 10).cast("string")))
    seq = k.cast("long").alias("seq")
    one = part.select(seq, first.alias("line"))
    two = part.where((k % 3 == 0) | ((k % 3 == 1) & (k % 5 == 0))).select(seq, second.alias("line"))

    def deletes(rows: DataFrame, by: Column) -> DataFrame:
        return rows.select(seq, _fragment(F.concat(F.lit("DEL"), k.cast("string")), "05", by).alias("line"))
    no_isbn = part.where(k % 7 == 0).select(seq, _fragment(ref, "05", F.lit(None).cast("string")).alias("line"))
    three = deletes(part.where(k % 6 == 0), isbn_of("978", k)).unionByName(
        deletes(part.where(k % 12 == 0), isbn_of("979", k))).unionByName(no_isbn)
    return [one, two, three]


def q_ingest_tables(spark: SparkSession, sf: str) -> DataFrame:
    """Every table of the ONIX ingest after three runs, as (table, key, value)."""
    part = spread(load(spark, sf, "part"))
    store, n = stage_path(spark, "store-ingest"), onix_file_count(part)
    for run, (rows, as_of) in enumerate(zip(run_fragments(part), RUNS), 1):
        path = stage_path(spark, f"onix-run-{run}")
        files = rows.select(F.pmod("seq", F.lit(n)).cast("int").alias("file_no"), "seq", "line")
        write_framed_text(files, path, n, adapters.ONIX_HEAD, adapters.ONIX_TAIL)
        ingest_products(spark, scan_onix_once(spark, path), store, as_of, f"run{run}")

    def rows(name: str, frame: DataFrame, key: list, value: list) -> DataFrame:
        text = lambda cols: F.concat_ws("|", *(F.coalesce((F.col(c) if isinstance(c, str) else c).cast("string"), F.lit("-")) for c in cols))
        return frame.select(F.lit(name).alias("table_name"), text(key).alias("key"), text(value).alias("value"))

    t = {x: read_table(spark, f"{store}/{x}") for x in (
        "books", "book_contributors", "book_subjects", "book_prices", "genres", "book_genres")}
    ref = "record_reference"
    out = [
        rows("books", t["books"], [ref], ["isbn13", "title", "is_removed", ts_str("removed_at"), ts_str("created_at"), ts_str("updated_at")]),
        rows("book_contributors", t["book_contributors"], [ref, "pos"], ["sequence_number", "role", "person_name"]),
        rows("book_subjects", t["book_subjects"], [ref, "pos"], ["scheme_identifier", "subject_code", "subject_heading_text"]),
        rows("book_prices", t["book_prices"], [ref, "pos"], ["price_type", "price_amount", "currency_code", "tax_rate_code", "tax_rate_percent"]),
        rows("genres", t["genres"], ["slug"], ["name"]),
        rows("book_genres", t["book_genres"], [ref], ["slug"]),
        rows("rejects", spark.read.parquet(f"{store}/rejects").where(F.col(ref).isNotNull()), ["run", ref], ["reason"]),
        rows("summaries", spark.read.parquet(f"{store}/summaries").groupBy("run").agg(
            *(F.sum(c).alias(c) for c in ("accepted", "rejected", "corrupt"))), ["run"], ["accepted", "rejected", "corrupt"]),
    ]
    whole = out[0]
    for frame in out[1:]:
        whole = whole.unionByName(frame)
    return whole


def moving_notices(lineitem: DataFrame, part: DataFrame) -> DataFrame:
    """Notices whose ISBNs move: line 2 of a part gives its book the next part's ISBN, line 3
    gives it none; returned lines are deletes by ISBN (by reference on line 3)."""
    c = F.col
    notices = adapters.notices_from_lineitem(lineitem, part)
    number, line = c("arrival.l_partkey"), c("arrival.l_linenumber")
    gone = c("arrival.l_returnflag") == "R"
    isbn = F.when(line == 2, isbn_of("978", number + 1)).when(line != 3, isbn_of("978", number))
    return notices.withColumns({
        "record_reference": ref_of("REF", number), "isbn13": isbn,
        "notification_type": F.when(gone, F.lit("05")).otherwise(F.lit("03"))})


def q_isbn_moves(spark: SparkSession, sf: str) -> DataFrame:
    """O-64: deletes by ISBN remove the book that holds the ISBN at their place in the run."""
    part, li = load(spark, sf, "part"), load(spark, sf, "lineitem")
    out = merge.apply_notices(adapters.books_from_part(part), moving_notices(li, part), AS_OF)
    return out.select("record_reference", "isbn13", "is_removed", ts_str("removed_at").alias("removed_at"))
