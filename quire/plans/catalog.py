"""Remaining catalogue queries: measures, children, genres, embedding text,
stock merge, quarantine, search (Q10, Q11, Q20, Q28, Q30, Q33, Q36-Q40)."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from quire.functions.scalars import onix_date, slugify
from quire.operators import embedding as emb
from quire.operators import merge, quality, search, text_index
from quire.operators.products import project_products
from quire.plans import adapters
from quire.plans.bookkeeping import contributors
from quire.plans.books import onix_file_count
from quire.plans.common import AS_OF, days_before, el, el_raw, isbn_of, load, ref_of, ts_str, xml_escape
from quire.plans.feeds import current_promotions
from quire.session import stage_path
from quire.sources import lookups, store
from quire.sources.onix import scan_onix
from quire.sources.store import write_framed_text
from quire.streaming import jobs

# --- Q10 / Q11: measures and contributors through the ONIX scan ------------------------------


def measure_fragments(part: DataFrame, n_files: int = 4) -> DataFrame:
    c = F.col
    k = c("p_partkey")

    def m(code, value):
        return el_raw("Measure", el("MeasureType", F.lit(code)), value, el("MeasureUnitCode", F.lit("mm")))

    width = (F.when(k % 5 == 0, F.lit("")).when(k % 5 == 1, el("Measurement", F.lit("abc")))
             .otherwise(el("Measurement", (c("p_size") * 3).cast("string"))))
    title = F.when(c("p_size") == 1, F.lit("")).otherwise(F.concat_ws(" ", c("p_name"), k.cast("string")))
    line = F.concat(
        F.lit("<Product>"), el("RecordReference", ref_of("REF", k)), el("NotificationType", F.lit("03")),
        el_raw("DescriptiveDetail",
               m("01", el("Measurement", (c("p_size") * 7).cast("string"))),
               m("02", width),
               m("03", el("Measurement", c("p_size").cast("string"))),
               m("03", el("Measurement", F.concat(c("p_size").cast("string"), F.lit(".5")))),
               m("08", el("Measurement", c("p_retailprice").cast("string"))),
               el_raw("TitleDetail", el("TitleType", F.lit("01")),
                      el_raw("TitleElement", el("TitleElementLevel", F.lit("01")), el("TitleText", xml_escape(title)))),
               el_raw("Contributor", el("SequenceNumber", F.lit("1")), el("ContributorRole", F.lit("A01")),
                      el("PersonName", xml_escape(F.concat(F.lit("Author "), c("p_brand")))),
                      el("PersonNameInverted", xml_escape(F.concat(c("p_brand"), F.lit(", Author"))))),
               el_raw("Contributor", el("SequenceNumber", F.lit("2")), el("ContributorRole", F.lit("B01")),
                      el("PersonName", xml_escape(F.concat(F.lit("Editor "), c("p_type")))))),
        F.lit("</Product>"))
    return part.select(F.pmod(k, F.lit(n_files)).cast("int").alias("file_no"), k.alias("seq"), line.alias("line"))


def _measure_products(spark: SparkSession, sf: str) -> DataFrame:
    part = load(spark, sf, "part")
    path = stage_path(spark, "onix-measures")
    n_files = onix_file_count(part)
    write_framed_text(measure_fragments(part, n_files), path, n_files, adapters.ONIX_HEAD, adapters.ONIX_TAIL)
    records, _ = scan_onix(spark, path)
    return project_products(records)


def q_onix_measure_pivot(spark: SparkSession, sf: str) -> DataFrame:
    """Q10 (O-18): measure types pivoted; missing value 0, unparseable null, last wins."""
    p = _measure_products(spark, sf)
    return p.select("record_reference", *[F.col(c).cast("double").alias(c)
                                          for c in ("height_mm", "width_mm", "thickness_mm", "weight_gr")])


def q_child_replace(spark: SparkSession, sf: str) -> DataFrame:
    """Q11 (O-21, O-66): contributors of every parsed product replace the stored ones."""
    products = _measure_products(spark, sf)
    old = contributors(load(spark, sf, "lineitem"), load(spark, sf, "supplier")).withColumn(
        "person_name_inverted", F.lit(None).cast("string"))
    new = products.select("record_reference", F.explode("contributors").alias("c")).select("record_reference", "c.*")
    out = merge.replace_children(old, products.select("record_reference"), new, "record_reference")
    return out.select("record_reference", F.col("sequence_number").cast("long").alias("sequence_number"), "role",
                      "person_name", "person_name_inverted")


# --- Q20 / Q28: subjects, genres, embedding text -----------------------------------------

def subjects_from_part(part: DataFrame) -> DataFrame:
    c = F.col
    k = c("p_partkey")
    ref = ref_of("REF", k)
    s0 = part.select(ref.alias("record_reference"), (k * 10).alias("pos"),
                     F.when(c("p_size") <= 2, F.lit("10")).otherwise(F.lit("93")).alias("scheme_identifier"),
                     c("p_type").alias("subject_heading_text"), F.upper(F.substring("p_type", 1, 3)).alias("subject_code"))
    s1 = part.select(ref.alias("record_reference"), (k * 10 + 1).alias("pos"), F.lit("93").alias("scheme_identifier"),
                     F.when(c("p_size") % 4 == 0, F.lit("")).when(c("p_size") % 4 == 1, F.lit(None))
                     .otherwise(c("p_name")).alias("subject_heading_text"),
                     F.when(c("p_size") % 4 == 1, F.lit(None)).otherwise(F.concat(F.lit("N"), c("p_size").cast("string")))
                     .alias("subject_code"))
    s2 = part.select(ref.alias("record_reference"), (k * 10 + 2).alias("pos"), F.lit("10").alias("scheme_identifier"),
                     c("p_brand").alias("subject_heading_text"), F.lit("B").alias("subject_code"))
    return s0.unionByName(s1).unionByName(s2)


def _genres(spark: SparkSession, sf: str):
    part = load(spark, sf, "part")
    genres, pairs = merge.derive_genres(subjects_from_part(part))
    cur = part.select(slugify("p_type").alias("slug"), F.concat(F.lit("Old "), F.col("p_type")).alias("name"),
                      F.lit(None).cast("string").alias("subject_code"), F.lit("93").alias("scheme_identifier")).distinct()
    bridge = part.select(ref_of("REF", "p_partkey").alias("record_reference"), slugify("p_brand").alias("slug"))
    return part, cur, genres, pairs, bridge


def q_genres_upsert(spark: SparkSession, sf: str) -> DataFrame:
    """Q20 (O-55, O-67, O-68, O-79): new genres inserted if their slug is absent."""
    _, cur, genres, _, _ = _genres(spark, sf)
    return merge.insert_absent(cur, genres, "slug").select("slug", "name", "subject_code")


def q_book_genres_replace(spark: SparkSession, sf: str) -> DataFrame:
    """Q20b (O-44, O-56, O-69): bridge replaced only for books with usable genres."""
    _, _, _, pairs, bridge = _genres(spark, sf)
    return merge.replace_children(bridge, pairs.select("record_reference").distinct(), pairs, "record_reference")


def text_books(part: DataFrame) -> DataFrame:
    c = F.col
    return part.select(ref_of("REF", "p_partkey").alias("record_reference"),
                       F.concat_ws(" ", c("p_name"), c("p_partkey").cast("string")).alias("title"),
                       c("p_type").alias("subtitle"),
                       F.when(c("p_size") % 3 == 0, F.concat(F.lit("Short "), c("p_name"))).alias("short_description"),
                       F.repeat(F.concat(c("p_name"), F.lit(" ")), 60).alias("long_description"),
                       c("p_size"))


def q_embedding_text(spark: SparkSession, sf: str) -> DataFrame:
    """Q28 (O-58, O-89): model input text of each book (authors, subjects ordered)."""
    part = load(spark, sf, "part")
    con = contributors(load(spark, sf, "lineitem"), load(spark, sf, "supplier"))
    return emb.embedding_text(text_books(part), con, subjects_from_part(part))


def q_backfill_text(spark: SparkSession, sf: str) -> DataFrame:
    """Q28b (O-90): backfill text — books without a vector, subjects left out."""
    part = load(spark, sf, "part")
    con = contributors(load(spark, sf, "lineitem"), load(spark, sf, "supplier"))
    books = text_books(part).withColumn("embedding", F.lit(None).cast("array<float>"))
    return emb.embedding_text(emb.backfill_candidates(books), con)


def q_embed_writeback(spark: SparkSession, sf: str) -> DataFrame:
    """Q37 (O-47, O-91, O-92): batched offline model over books needing a vector;
    vectors of the right size stored with their stamp."""
    part = load(spark, sf, "part")
    con = contributors(load(spark, sf, "lineitem"), load(spark, sf, "supplier"))
    books = text_books(part).select(
        "*", F.when(F.col("p_size") % 2 == 0, days_before(10)).alias("embedded_at"),
        F.lit(None).cast("array<float>").alias("embedding"))
    todo = emb.needs_embedding(books, books.select("record_reference"))
    texts = emb.embedding_text(todo, con)
    vecs = emb.embed(texts, emb.RetryingProvider(emb.hashing_provider(64)), dim=64, batch=100)
    out = emb.write_vectors(books, vecs, 64, AS_OF)
    return out.select("record_reference", F.size("embedding").cast("long").alias("n_dims"),
                      ts_str("embedded_at").alias("embedded_at"))


# --- Q30: freshness-gated stock merge -------------------------------------------------------

def stock_incoming(events: DataFrame) -> DataFrame:
    c = F.col
    inv = c("event_type") == "purchase"
    hours = ((c("event_id") * 7919) % 72).cast("int")
    ts = c("ts") - F.make_interval(F.lit(0), F.lit(0), F.lit(0), F.lit(0), hours)
    return events.select(
        isbn_of("979", "user_id").alias("isbn13"), c("event_id").alias("arrival"), ts.alias("stock_updated_at"),
        F.get_json_object("props", "$.k").cast("int").alias("stock_qty"),
        F.when(inv, F.lit("inventory")).otherwise(F.lit("avail13_delta")).alias("source"),
        F.concat(F.lit("f"), (c("event_id") % 10).cast("string")).alias("source_file_key"),
        F.when(inv, c("value").cast("decimal(10,2)")).alias("rrp_gbp"),
        F.when(inv, (c("event_id") % 40).cast("decimal(5,2)")).alias("discount_percent"),
        F.when(inv, F.upper(F.substring("event_type", 1, 3))).alias("report_code"),
        F.when(inv, F.to_date("ts")).alias("report_date"))


def stock_current(customer: DataFrame) -> DataFrame:
    c = F.col
    ts = F.lit("2024-01-10 00:00:00").cast("timestamp") + F.make_interval(
        F.lit(0), F.lit(0), F.lit(0), F.lit(0), (c("c_custkey") % 48).cast("int"))
    return customer.select(
        isbn_of("979", "c_custkey").alias("isbn13"), ts.alias("stock_updated_at"),
        c("c_nationkey").cast("int").alias("stock_qty"), F.lit("inventory").alias("source"),
        F.lit("old").alias("source_file_key"), c("c_acctbal").cast("decimal(10,2)").alias("rrp_gbp"),
        c("c_nationkey").cast("decimal(5,2)").alias("discount_percent"), F.lit("OLD").alias("report_code"),
        F.lit(None).cast("date").alias("report_date"), days_before(30).alias("created_at"))


def stock_view(df: DataFrame) -> DataFrame:
    return df.select("isbn13", F.col("stock_qty").cast("long").alias("stock_qty"), "source", "source_file_key",
                     F.col("rrp_gbp").cast("double").alias("rrp_gbp"),
                     F.col("discount_percent").cast("double").alias("discount_percent"), "report_code",
                     F.date_format("report_date", "yyyy-MM-dd").alias("report_date"),
                     ts_str("stock_updated_at").alias("stock_updated_at"))


def q_stock_gated_merge(spark: SparkSession, sf: str, gate: str = "row") -> DataFrame:
    """Q30 (O-61, O-100): two feeds into one row per ISBN under the freshness gate."""
    cur = stock_current(load(spark, sf, "customer"))
    inc = stock_incoming(load(spark, sf, "events"))
    return stock_view(merge.gated_merge(cur, inc, gate=gate))


def q_stock_gated_merge_group(spark: SparkSession, sf: str) -> DataFrame:
    """Q30b (O-61, B11 option): prices follow the freshest inventory row."""
    return q_stock_gated_merge(spark, sf, gate="group")


# --- Q33: quarantine ----------------------------------------------------------------------

def quarantine_rows(part: DataFrame) -> DataFrame:
    c = F.col
    k = c("p_partkey")
    page_raw = F.when(k % 13 == 0, F.lit("n/a")).otherwise(c("p_size").cast("string"))
    date_raw = F.when(k % 17 == 0, F.lit("20241340")).otherwise(F.lit("20240101"))
    vals = {
        "record_reference": F.when(k % 50 == 0, F.lit("")).otherwise(ref_of("REF", k)),
        "notification_type": F.lit("03"),
        "isbn13": F.when(k % 9 == 0, F.lit("97800")).when(k % 11 == 0, isbn_of("978", k - 1)).otherwise(isbn_of("978", k)),
        "title": F.when(c("p_size") == 2, F.repeat(F.lit("x"), 2001)).otherwise(F.concat_ws(" ", c("p_name"), k.cast("string"))),
        "publisher_name": c("p_brand"),
        "page_count": page_raw.try_cast("int"),
        "publication_date": onix_date(date_raw),
    }
    return part.select(*adapters._typed(vals), page_raw.alias("page_raw"), date_raw.alias("date_raw"),
                       k.alias("arrival"))


def q_quarantine(spark: SparkSession, sf: str) -> DataFrame:
    """Q33 (O-74): every constraint checked at once; bad rows set aside with reasons."""
    part = load(spark, sf, "part")
    rows = quarantine_rows(part)
    holders = quality.isbn_holders(rows, adapters.books_from_part(part))
    rows = rows.join(holders, "isbn13", "left")
    good, bad = quality.quarantine(rows, quality.book_rules())
    return (good.select("record_reference", "isbn13", F.lit("good").alias("status"), F.lit("").alias("reasons"))
            .unionByName(bad.select("record_reference", "isbn13", F.lit("rejected").alias("status"),
                                    F.array_join("reasons", ",").alias("reasons"))))


# --- Q36 - Q40: search ----------------------------------------------------------------------

def q_cosine_topk(spark: SparkSession, sf: str) -> DataFrame:
    """Q36 (O-96): exact top-5 cosine neighbours of every 50th vector, among all vectors."""
    e = load(spark, sf, "embeddings")
    queries = e.where(F.col("vec_id") % 50 == 0).select(F.col("vec_id").alias("query_id"), "embedding")
    top = search.nearest(e, queries, k=5)
    return top.select("query_id", "vec_id", F.col("rank").cast("long").alias("rank"),
                      F.round("score", 6).alias("score"))


def q_cosine_cells(spark: SparkSession, sf: str) -> DataFrame:
    """Q36b (O-96): top 5 of every 50th vector through the stored index of cells: how many queries,
    whether nine tenths of the exact neighbours are found, and whether four fifths of the vectors at most
    are scored (these vectors are almost evenly spread; grouped ones need far fewer)."""
    e = load(spark, sf, "embeddings")
    queries = e.where(F.col("vec_id") % 50 == 0).select(F.col("vec_id").alias("query_id"), "embedding")
    path = stage_path(spark, "cells")
    centres = search.learn_cells(e)
    search.write_cells(e, path, centres)
    near = search.nearest_in_cells(spark.read.parquet(path), centres, queries, k=5, probes=search.probes_for(e, centres, k=5))
    exact = search.nearest(e, queries, k=5).select("query_id", "vec_id", F.lit(1).alias("hit"))
    both = exact.join(near.select("query_id", "vec_id", "scored"), ["query_id", "vec_id"], "left")
    return both.agg(F.countDistinct("query_id").alias("queries"), F.count(F.lit(1)).alias("neighbours"),
                    (F.count("scored") >= 0.9 * F.count(F.lit(1))).alias("recall_reached"),
                    (F.avg("scored") <= 0.8 * e.count()).alias("scores_few"))


def q_fts_rank(spark: SparkSession, sf: str) -> DataFrame:
    """Q38 (O-93, O-94): weighted text vector of documents, top 10 per benchmark query."""
    docs = load(spark, sf, "documents").select(
        "doc_id", F.concat(F.lit("doc "), F.col("doc_id").cast("string"), F.lit(" "), F.col("source")).alias("title"),
        F.col("lang").alias("subtitle"), F.col("text").alias("long_description"))
    from quire.functions.text import tokens
    q = load(spark, sf, "benchmark").select(F.col("item_id").alias("query_id"),
                                            F.explode(tokens("text")).alias("lexeme")).distinct()
    top = search.search_documents(docs, "doc_id", {"title": "A", "subtitle": "B", "long_description": "C"}, q, k=10)
    return top.select("query_id", "doc_id", F.col("rank").cast("long").alias("rank"), F.round("score", 4).alias("score"))


def _fts_documents(spark: SparkSession, sf: str) -> DataFrame:
    return load(spark, sf, "documents").select(
        "doc_id", F.concat(F.lit("doc "), F.col("doc_id").cast("string"), F.lit(" "), F.col("source")).alias("title"),
        F.col("lang").alias("subtitle"), F.col("text").alias("long_description"))


def q_stored_search(spark: SparkSession, sf: str) -> DataFrame:
    """Q38b (O-94): top 10 documents per query through the stored index of blocks; ``or`` for the benchmark's texts,
    ``and`` for the first four words of each."""
    path = stage_path(spark, "text-index")
    text_index.write_text_index(_fts_documents(spark, sf), path, "doc_id", {"title": "A", "subtitle": "B", "long_description": "C"},
                                stem=False)
    asked = load(spark, sf, "benchmark").select(F.col("item_id").alias("query_id"), "text",
                                                F.substring_index("text", " ", 4).alias("few"))
    out = None
    for mode, text in (("or", "text"), ("and", "few")):
        terms = text_index.query_terms(asked, text, stem=False)
        top = text_index.search_text_index(spark, path, terms, k=10, mode=mode, key="doc_id").select(
            F.lit(mode).alias("mode"), "query_id", "doc_id", F.col("rank").cast("long").alias("rank"), F.round("score", 4).alias("score"))
        out = top if out is None else out.unionByName(top)
    return out


# Titles in another inflection than the queries that look for them.
_NOUN = "(anvil|bolt|gear|gizmo|plate|ring|rod|widget)"


def q_stemmed_search(spark: SparkSession, sf: str) -> DataFrame:
    """Q38c (O-93): every third title in the plural, asked for in other inflections, and by ISBN (weight A);
    top 10 books, all words needed."""
    part, c = load(spark, sf, "part"), F.col
    k = F.regexp_extract("record_reference", "([0-9]+)$", 1).cast("long")
    books = adapters.books_from_part(part).withColumn(
        "title", F.when(k % 3 == 0, F.regexp_replace("title", _NOUN, "$1s")).otherwise(c("title")))
    path = stage_path(spark, "text-index")
    text_index.write_text_index(books, path, "record_reference", {"title": "A", "subtitle": "B", "isbn13": "A", "long_description": "C"})
    names = part.select("p_name").distinct()
    asked = (names.select(c("p_name").alias("query_id"), F.regexp_replace("p_name", _NOUN, "$1s").alias("text"))
             .unionByName(names.select(F.concat(c("p_name"), F.lit(" ing")), F.regexp_replace("p_name", "(ring|bolt)", "$1ing")).toDF("query_id", "text"))
             .unionByName(part.where(c("p_partkey") % 50 == 0).select(isbn_of("978", "p_partkey").alias("query_id"), isbn_of("978", "p_partkey").alias("text"))))
    top = text_index.search_text_index(spark, path, text_index.query_terms(asked, "text"), mode="and", key="record_reference")
    return top.select("query_id", "record_reference", F.col("rank").cast("long").alias("rank"), F.round("score", 4).alias("score"))


def q_trigram_title(spark: SparkSession, sf: str) -> DataFrame:
    """Q39 (O-95): the misspelt title of every 50th part, matched to all titles by trigram similarity >= 0.3."""
    title = F.concat_ws(" ", "p_name", "p_brand", F.col("p_partkey").cast("string"))
    titles = load(spark, sf, "part").select("p_partkey", title.alias("title"))
    queries = titles.where(F.col("p_partkey") % 50 == 0).select(F.regexp_replace("title", "e", "a").alias("query")).distinct()
    return search.trigram_match(titles.select("title").distinct(), "title", "title", queries, "query", threshold=0.3, digits=4)


def q_key_lookups(spark: SparkSession, sf: str) -> DataFrame:
    """Q40 (O-97): books by an ISBN set and a publisher list."""
    part, li = load(spark, sf, "part"), load(spark, sf, "lineitem")
    books = adapters.books_from_part(part)
    keys = li.where(F.col("l_returnflag") == "R").select(isbn_of("978", "l_partkey").alias("isbn13"))
    out = search.lookup(books, keys, "isbn13", publisher_name=["Brand#1", "Brand#12", "Brand#23"])
    return out.select("record_reference", "isbn13", "title", "publisher_name")


def _stored_table(spark: SparkSession, rows: DataFrame, name: str, key: str, by: tuple[str, ...]) -> str:
    root = stage_path(spark, name)
    store.replace_buckets(rows, root, key, range(8), 8)
    for column in by:
        lookups.write_lookup(store.read_buckets(spark, root), root, column, key, range_rows=2000)
    return root


def q_stored_lookups(spark: SparkSession, sf: str) -> DataFrame:
    """Q40b (O-97): the six lookups on stored tables (ISBN, title, publisher, availability, promotion finish date,
    reverse ISBN redirect), after a run that moved every seventh book to another publisher."""
    part, c = load(spark, sf, "part"), F.col
    k = F.regexp_extract("record_reference", "([0-9]+)$", 1).cast("long")
    books = adapters.books_from_part(part).withColumn(
        "availability_code", F.element_at(F.array(*map(F.lit, ("20", "21", "40", "31"))), (k % 4 + 1).cast("int")))
    shop = _stored_table(spark, books, "books", "record_reference", ("isbn13", "title", "publisher_name", "availability_code"))
    moved = books.where(k % 7 == 0).withColumn("publisher_name", F.concat(F.lit("New "), "publisher_name"))
    jobs._update(spark, shop, "record_reference", moved.select("record_reference"), books,
                 lambda current: merge.upsert(current, moved, "record_reference"))
    promo = current_promotions(load(spark, sf, "customer")).withColumn(
        "finish_date", F.date_add(F.lit("2024-01-01").cast("date"), F.regexp_extract("title", "([0-9]+)$", 1).cast("int") % 60))
    promos = _stored_table(spark, promo, "promotions", "isbn13", ("finish_date",))
    slips = load(spark, sf, "supplier").select(isbn_of("978", "s_suppkey").alias("old_isbn13"),
                                               isbn_of("979", "s_nationkey").alias("new_isbn13"))
    redirects = _stored_table(spark, slips, "slips", "old_isbn13", ("new_isbn13",))

    returned = load(spark, sf, "lineitem").where(c("l_returnflag") == "R").select(isbn_of("978", "l_partkey").alias("value"))
    titles = books.where(k % 50 == 0).select(c("title").alias("value"))
    days = [F.lit(d).cast("date") for d in ("2024-01-10", "2024-01-20")]
    low, high = spark.range(1).select(*days).first()
    asked = {
        "isbn": (shop, "record_reference", "isbn13", {"values": returned}),
        "title": (shop, "record_reference", "title", {"values": titles}),
        "title_prefix": (shop, "record_reference", "title", {"prefix": "small r"}),
        "publisher": (shop, "record_reference", "publisher_name", {"values": ["Brand#12", "New Brand#7", "none"]}),
        "availability": (shop, "record_reference", "availability_code", {"values": ["21"]}),
        "finish_date": (promos, "isbn13", "finish_date", {"low": low, "high": high}),
        "redirected_from": (redirects, "old_isbn13", "new_isbn13", {"values": ["9790000000003", "9790000000011"]}),
    }
    out = None
    for name, (root, key, column, condition) in asked.items():
        rows = lookups.look_up(spark, root, key, column, **condition).select(
            F.lit(name).alias("lookup"), c(key).alias("key"), c(column).cast("string").alias("value"))
        out = rows if out is None else out.unionByName(rows)
    return out


def q_vector_codec(spark: SparkSession, sf: str) -> DataFrame:
    """O-85: vectors written as ``[a,b,…]`` text and read back unchanged."""
    from quire.functions.scalars import format_vector, parse_vector
    e = load(spark, sf, "embeddings")
    txt = e.select("vec_id", "embedding", format_vector("embedding").alias("txt"))
    back = txt.select("vec_id", parse_vector("txt").alias("v"), "embedding", "txt")
    return back.select("vec_id", F.size("v").cast("long").alias("n_dims"),
                       (F.col("v") == F.col("embedding")).alias("roundtrip_ok"),
                       F.col("txt").startswith("[").alias("bracketed"))


def q_text_vector_stats(spark: SparkSession, sf: str) -> DataFrame:
    """O-93: weighted text vector of every document (lexeme, weight, positions)."""
    docs = load(spark, sf, "documents").select(
        "doc_id", F.concat(F.lit("doc "), F.col("doc_id").cast("string"), F.lit(" "), F.col("source")).alias("title"),
        F.col("lang").alias("subtitle"), F.col("text").alias("long_description"))
    vec = search.text_vector(docs, "doc_id", {"title": "A", "subtitle": "B", "long_description": "C"})
    return vec.groupBy("doc_id").agg(F.count("*").alias("n_entries"),
                                     F.sum(F.size("positions")).cast("long").alias("n_positions"),
                                     F.max(F.array_max("positions")).cast("long").alias("last_position"))
