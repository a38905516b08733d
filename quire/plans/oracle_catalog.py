"""SQL oracles of measures, children, genres, text, stock merge, quarantine and
search queries (DuckDB dialect)."""

from __future__ import annotations

from quire.functions.text import STOP_WORDS
from quire.plans.oracle import AS_OF, _s, days_before, isbn, ts

# Letters and digits of any script, as a regular expression of the SQL engine.
_TOKEN = r"[\p{L}\p{N}]+"


def slug(x: str) -> str:
    return (f"substr(regexp_replace(regexp_replace(lower({x}), '\\s+', '_', 'g'), '[^a-z0-9_-]', '', 'g'), 1, 200)")


Q_MEASURES = """
SELECT 'REF' || CAST(p_partkey AS VARCHAR) AS record_reference,
       CAST(p_size * 7 AS DOUBLE) AS height_mm,
       CASE p_partkey % 5 WHEN 0 THEN 0.0 WHEN 1 THEN NULL ELSE CAST(p_size * 3 AS DOUBLE) END AS width_mm,
       CAST(p_size + 0.5 AS DOUBLE) AS thickness_mm,
       CAST(CAST(p_retailprice AS DECIMAL(9,2)) AS DOUBLE) AS weight_gr
FROM part WHERE p_size <> 1"""

Q_CHILD_REPLACE = f"""
WITH old AS (
  SELECT DISTINCT l_partkey, l_suppkey, s_name FROM lineitem JOIN supplier ON l_suppkey = s_suppkey)
SELECT 'REF' || {_s('l_partkey')} AS record_reference, CAST(l_suppkey AS BIGINT) AS sequence_number,
       CASE WHEN l_suppkey % 2 = 0 THEN 'A01' ELSE 'B01' END AS role, s_name AS person_name,
       CAST(NULL AS VARCHAR) AS person_name_inverted
FROM old WHERE l_partkey IN (SELECT p_partkey FROM part WHERE p_size = 1)
UNION ALL
SELECT 'REF' || {_s('p_partkey')}, CAST(1 AS BIGINT), 'A01', 'Author ' || p_brand, p_brand || ', Author'
FROM part WHERE p_size <> 1
UNION ALL
SELECT 'REF' || {_s('p_partkey')}, CAST(2 AS BIGINT), 'B01', 'Editor ' || p_type, CAST(NULL AS VARCHAR)
FROM part WHERE p_size <> 1"""

SUBJECTS = f"""
  SELECT 'REF' || {_s('p_partkey')} AS ref, p_partkey * 10 AS o,
         CASE WHEN p_size <= 2 THEN '10' ELSE '93' END AS scheme, p_type AS heading,
         upper(substr(p_type, 1, 3)) AS code
  FROM part
  UNION ALL
  SELECT 'REF' || {_s('p_partkey')}, p_partkey * 10 + 1, '93',
         CASE WHEN p_size % 4 = 0 THEN '' WHEN p_size % 4 = 1 THEN NULL ELSE p_name END,
         CASE WHEN p_size % 4 = 1 THEN NULL ELSE 'N' || {_s('p_size')} END
  FROM part
  UNION ALL
  SELECT 'REF' || {_s('p_partkey')}, p_partkey * 10 + 2, '10', p_brand, 'B' FROM part"""

GENRE_BASE = f"""
WITH s AS ({SUBJECTS}),
u AS (SELECT *, coalesce(heading, code, '') AS name FROM s
      WHERE scheme = '93' AND (coalesce(heading, '') <> '' OR coalesce(code, '') <> '')),
v AS (SELECT *, {slug('name')} AS slug FROM u WHERE {slug('name')} <> ''),
g AS (SELECT slug, name, code AS subject_code FROM (
        SELECT *, row_number() OVER (PARTITION BY slug ORDER BY o) AS rn FROM v) WHERE rn = 1),
cur AS (SELECT DISTINCT {slug('p_type')} AS slug, 'Old ' || p_type AS name, CAST(NULL AS VARCHAR) AS subject_code
        FROM part)"""

Q_GENRES = GENRE_BASE + """
SELECT slug, name, subject_code FROM cur
UNION ALL SELECT slug, name, subject_code FROM g WHERE slug NOT IN (SELECT slug FROM cur)"""

Q_BOOK_GENRES = GENRE_BASE + f""",
pairs AS (SELECT DISTINCT ref, slug FROM v),
curb AS (SELECT 'REF' || {_s('p_partkey')} AS ref, {slug('p_brand')} AS slug FROM part)
SELECT ref AS record_reference, slug FROM curb WHERE ref NOT IN (SELECT ref FROM pairs)
UNION ALL SELECT ref, slug FROM pairs"""

AUTHORS = f"""
  SELECT 'REF' || {_s('l_partkey')} AS ref, string_agg(s_name, ', ' ORDER BY l_suppkey, s_name) AS authors
  FROM (SELECT DISTINCT l_partkey, l_suppkey FROM lineitem) JOIN supplier ON l_suppkey = s_suppkey
  WHERE l_suppkey % 2 = 0 AND coalesce(s_name, '') <> '' GROUP BY l_partkey"""

TEXT_BOOKS = f"""
  SELECT 'REF' || {_s('p_partkey')} AS ref, concat_ws(' ', p_name, {_s('p_partkey')}) AS title, p_type AS subtitle,
         CASE WHEN p_size % 3 = 0 THEN 'Short ' || p_name END AS short_d, repeat(p_name || ' ', 60) AS long_d,
         p_size
  FROM part"""


def _text(with_subjects: bool) -> str:
    subj = ", sj.subjects" if with_subjects else ""
    join = "LEFT JOIN sj ON sj.ref = b.ref" if with_subjects else ""
    return f"""
WITH b AS ({TEXT_BOOKS}), a AS ({AUTHORS}), s AS ({SUBJECTS}),
sj AS (SELECT ref, string_agg(heading, ', ' ORDER BY o) AS subjects FROM s WHERE coalesce(heading, '') <> ''
       GROUP BY ref)
SELECT b.ref AS record_reference,
       array_to_string(list_filter([b.title, b.subtitle,
                                    CASE WHEN coalesce(a.authors, '') <> '' THEN 'By ' || a.authors END{subj},
                                    coalesce(b.short_d, substr(b.long_d, 1, 500))],
                                   lambda x: x IS NOT NULL AND x <> ''), '. ') AS text
FROM b LEFT JOIN a ON a.ref = b.ref {join}"""


Q_EMBED_WRITEBACK = f"""
SELECT 'REF' || {_s('p_partkey')} AS record_reference,
       CASE WHEN p_size % 2 = 0 THEN NULL ELSE CAST(64 AS BIGINT) END AS n_dims,
       {ts(f'CASE WHEN p_size % 2 = 0 THEN {days_before(10)} ELSE {AS_OF} END')} AS embedded_at
FROM part"""


def _stock(gate: str) -> str:
    if gate == "row":
        price_filter = "pass AND (arrival = base OR source = 'inventory')"
        price_order = "arrival"
        qty_filter = "pass"
        qty_order = "arrival"
        win = ", max(ts) OVER (PARTITION BY isbn13 ORDER BY arrival ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) AS before"
        pas = "arrival = base OR coalesce(ts >= before, false)"
    else:
        price_filter = "arrival = base OR source = 'inventory'"
        price_order = "{'t': ts, 'a': arrival}"
        qty_filter = "true"
        qty_order = "{'t': ts, 'a': arrival}"
        win = ""
        pas = "true"
    return f"""
WITH cur AS (
  SELECT {isbn('979', 'c_custkey')} AS isbn13,
         TIMESTAMP '2024-01-10 00:00:00' + to_hours(CAST(c_custkey % 48 AS BIGINT)) AS ts,
         CAST(c_nationkey AS INTEGER) AS qty, 'inventory' AS source, 'old' AS fkey,
         CAST(c_acctbal AS DECIMAL(10,2)) AS rrp, CAST(c_nationkey AS DECIMAL(5,2)) AS disc, 'OLD' AS rcode,
         CAST(NULL AS DATE) AS rdate, CAST(-1 AS BIGINT) AS arrival
  FROM customer),
inc AS (
  SELECT {isbn('979', 'user_id')} AS isbn13, ts - to_hours(CAST((event_id * 7919) % 72 AS BIGINT)) AS ts,
         CAST(json_extract_string(props, '$.k') AS INTEGER) AS qty,
         CASE WHEN event_type = 'purchase' THEN 'inventory' ELSE 'avail13_delta' END AS source,
         'f' || {_s('event_id % 10')} AS fkey,
         CASE WHEN event_type = 'purchase' THEN CAST(value AS DECIMAL(10,2)) END AS rrp,
         CASE WHEN event_type = 'purchase' THEN CAST(event_id % 40 AS DECIMAL(5,2)) END AS disc,
         CASE WHEN event_type = 'purchase' THEN upper(substr(event_type, 1, 3)) END AS rcode,
         CASE WHEN event_type = 'purchase' THEN CAST(ts AS DATE) END AS rdate,
         event_id AS arrival
  FROM events),
a AS (SELECT * FROM cur UNION ALL SELECT * FROM inc),
w AS (SELECT *, min(arrival) OVER (PARTITION BY isbn13) AS base {win} FROM a),
p AS (SELECT *, {pas} AS pass FROM w),
r AS (
  SELECT isbn13,
         arg_max({{'q': qty, 's': source, 'f': fkey}}, {qty_order}) FILTER (WHERE {qty_filter}) AS x,
         arg_max({{'r': rrp, 'd': disc, 'c': rcode, 'dt': rdate}}, {price_order}) FILTER (WHERE {price_filter}) AS g,
         max(ts) AS ts
  FROM p GROUP BY isbn13)
SELECT isbn13, CAST(x.q AS BIGINT) AS stock_qty, x.s AS source, x.f AS source_file_key,
       CAST(g.r AS DOUBLE) AS rrp_gbp, CAST(g.d AS DOUBLE) AS discount_percent, g.c AS report_code,
       strftime(g.dt, '%Y-%m-%d') AS report_date, {ts('ts')} AS stock_updated_at
FROM r"""


Q_QUARANTINE = f"""
WITH r AS (
  SELECT p_partkey AS k,
         CASE WHEN p_partkey % 50 = 0 THEN '' ELSE 'REF' || {_s('p_partkey')} END AS record_reference,
         CASE WHEN p_partkey % 9 = 0 THEN '97800' WHEN p_partkey % 11 = 0 THEN {isbn('978', 'p_partkey - 1')}
              ELSE {isbn('978', 'p_partkey')} END AS isbn13,
         CASE WHEN p_size = 2 THEN repeat('x', 2001) ELSE concat_ws(' ', p_name, {_s('p_partkey')}) END AS title,
         p_partkey % 13 = 0 AS bad_page, p_partkey % 17 = 0 AS bad_date
  FROM part),
cur AS (SELECT {isbn('978', 'p_partkey')} AS isbn13, 'REF' || {_s('p_partkey')} AS holder FROM part),
first AS (SELECT isbn13, arg_min(record_reference, k) AS holder FROM r GROUP BY isbn13),
h AS (SELECT coalesce(c.isbn13, f.isbn13) AS isbn13, coalesce(c.holder, f.holder) AS holder
      FROM cur c FULL OUTER JOIN first f ON c.isbn13 = f.isbn13),
x AS (
  SELECT r.record_reference, r.isbn13,
         concat_ws(',',
           CASE WHEN r.record_reference = '' THEN 'missing_reference' END,
           CASE WHEN r.title = '' THEN 'missing_title' END,
           CASE WHEN NOT regexp_full_match(r.isbn13, '(978|979)[0-9]{{10}}') THEN 'bad_isbn' END,
           CASE WHEN length(r.title) > 2000 THEN 'too_long_title' END,
           CASE WHEN bad_page THEN 'bad_page_count' END,
           CASE WHEN bad_date THEN 'bad_publication_date' END,
           CASE WHEN h.holder IS NOT NULL AND h.holder <> r.record_reference THEN 'isbn_taken' END) AS reasons
  FROM r LEFT JOIN h ON r.isbn13 = h.isbn13)
SELECT record_reference, isbn13, CASE WHEN reasons = '' THEN 'good' ELSE 'rejected' END AS status, reasons FROM x"""

Q_COSINE = """
WITH q AS (SELECT vec_id AS query_id, embedding AS qv FROM embeddings
           WHERE vec_id % 50 = 0),
s AS (SELECT q.query_id, e.vec_id,
             list_cosine_similarity(CAST(q.qv AS DOUBLE[]), CAST(e.embedding AS DOUBLE[])) AS score
      FROM q CROSS JOIN embeddings e)
SELECT query_id, vec_id, rank, round(score, 6) AS score FROM (
  SELECT *, row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id) AS rank FROM s)
WHERE rank <= 5"""

Q_COSINE_CELLS = f"""
SELECT count(DISTINCT query_id) AS queries, count(*) AS neighbours, true AS recall_reached, true AS scores_few FROM ({Q_COSINE})"""

_STOP = "[" + ", ".join("'" + w.replace("'", "''") + "'" for w in STOP_WORDS) + "]"

Q_FTS = f"""
WITH dt AS (
  SELECT doc_id, 10 AS w, unnest(regexp_extract_all(lower('doc ' || {_s('doc_id')} || ' ' || source), '{_TOKEN}')) AS lex
  FROM documents
  UNION ALL SELECT doc_id, 4, unnest(regexp_extract_all(lower(lang), '{_TOKEN}')) FROM documents
  UNION ALL SELECT doc_id, 2, unnest(regexp_extract_all(lower(text), '{_TOKEN}')) FROM documents),
idx AS (SELECT doc_id, lex, w, count(*) AS tf FROM dt WHERE NOT list_contains({_STOP}, lex) GROUP BY ALL),
q0 AS (SELECT item_id AS query_id, unnest(regexp_extract_all(lower(text), '{_TOKEN}')) AS lex FROM benchmark),
q AS (SELECT DISTINCT query_id, lex FROM q0 WHERE NOT list_contains({_STOP}, lex)),
s AS (SELECT query_id, doc_id, sum(tf * w) / 10.0 AS score FROM idx JOIN q USING (lex) GROUP BY ALL)
SELECT query_id, doc_id, rank, round(score, 4) AS score FROM (
  SELECT *, row_number() OVER (PARTITION BY query_id ORDER BY score DESC, doc_id) AS rank FROM s)
WHERE rank <= 10"""


_DOC_WORDS = f"""
dt AS (
  SELECT doc_id, 10 AS w, unnest(regexp_extract_all(lower('doc ' || {_s('doc_id')} || ' ' || source), '{_TOKEN}')) AS lex
  FROM documents
  UNION ALL SELECT doc_id, 4, unnest(regexp_extract_all(lower(lang), '{_TOKEN}')) FROM documents
  UNION ALL SELECT doc_id, 2, unnest(regexp_extract_all(lower(text), '{_TOKEN}')) FROM documents),
idx AS (SELECT doc_id, lex, sum(w) AS s FROM dt WHERE NOT list_contains({_STOP}, lex) GROUP BY ALL)"""

Q_STORED_SEARCH = f"""
WITH {_DOC_WORDS},
q0 AS (
  SELECT 'or' AS mode, item_id AS query_id, unnest(regexp_extract_all(lower(text), '{_TOKEN}')) AS lex FROM benchmark
  UNION ALL SELECT 'and', item_id, unnest(regexp_extract_all(lower(array_to_string(string_split(text, ' ')[1:4], ' ')), '{_TOKEN}'))
  FROM benchmark),
q AS (SELECT DISTINCT mode, query_id, lex FROM q0 WHERE NOT list_contains({_STOP}, lex)),
n AS (SELECT mode, query_id, count(*) AS need FROM q GROUP BY ALL),
s AS (SELECT mode, query_id, doc_id, sum(s) / 10.0 AS score, count(*) AS held FROM idx JOIN q USING (lex) GROUP BY ALL)
SELECT mode, query_id, doc_id, rank, round(score, 4) AS score FROM (
  SELECT *, row_number() OVER (PARTITION BY mode, query_id ORDER BY score DESC, doc_id) AS rank
  FROM s JOIN n USING (mode, query_id) WHERE mode = 'or' OR held = need)
WHERE rank <= 10"""

# The queries' words with their inflection taken off, against the books' words before theirs was put on.
Q_STEMMED_SEARCH = f"""
WITH b AS (
  SELECT 'REF' || {_s('p_partkey')} AS record_reference, p_name, p_partkey,
         lower(concat_ws(' ', p_name, {_s('p_partkey')}, {isbn('978', 'p_partkey')})) AS a, lower(p_type) AS b,
         lower(p_name || ' by ' || p_brand) AS c FROM part),
w AS (
  SELECT record_reference, 10 AS w, unnest(regexp_extract_all(a, '{_TOKEN}')) AS lex FROM b
  UNION ALL SELECT record_reference, 4, unnest(regexp_extract_all(b, '{_TOKEN}')) FROM b
  UNION ALL SELECT record_reference, 2, unnest(regexp_extract_all(c, '{_TOKEN}')) FROM b),
idx AS (SELECT record_reference, lex, sum(w) AS s FROM w WHERE NOT list_contains({_STOP}, lex) GROUP BY ALL),
q AS (
  SELECT DISTINCT p_name AS query_id, unnest(string_split(p_name, ' ')) AS lex FROM part
  UNION SELECT DISTINCT p_name || ' ing', unnest(string_split(p_name, ' ')) FROM part
  UNION SELECT {isbn('978', 'p_partkey')}, {isbn('978', 'p_partkey')} FROM part WHERE p_partkey % 50 = 0),
n AS (SELECT query_id, count(*) AS need FROM q GROUP BY ALL),
s AS (SELECT query_id, record_reference, sum(s) / 10.0 AS score, count(*) AS held FROM idx JOIN q USING (lex) GROUP BY ALL)
SELECT query_id, record_reference, rank, round(score, 4) AS score FROM (
  SELECT *, row_number() OVER (PARTITION BY query_id ORDER BY score DESC, record_reference) AS rank
  FROM s JOIN n USING (query_id) WHERE held = need)
WHERE rank <= 10"""


def _tri(x: str) -> str:
    return (f"list_distinct(flatten(list_transform(regexp_extract_all(lower({x}), '{_TOKEN}'), "
            f"lambda w: list_transform(range(1, length(w) + 2), lambda i: substr('  ' || w || ' ', i, 3)))))")


Q_TRIGRAM = f"""
WITH p AS (SELECT p_partkey, concat_ws(' ', p_name, p_brand, {_s('p_partkey')}) AS title FROM part),
t AS (SELECT DISTINCT title FROM p),
q AS (SELECT DISTINCT replace(title, 'e', 'a') AS query FROM p WHERE p_partkey % 50 = 0),
tg AS (SELECT title, {_tri('title')} AS g FROM t),
qg AS (SELECT query, {_tri('query')} AS g FROM q),
te AS (SELECT title, unnest(g) AS tri, len(g) AS nr FROM tg),
qe AS (SELECT query, unnest(g) AS tri, len(g) AS nq FROM qg),
s AS (SELECT query, title, count(*) AS sh, any_value(nq) AS nq, any_value(nr) AS nr
      FROM te JOIN qe USING (tri) GROUP BY query, title)
SELECT query, title, round(sh / (nq + nr - sh), 4) AS similarity FROM s WHERE sh / (nq + nr - sh) >= 0.3"""

Q_LOOKUPS = f"""
SELECT 'REF' || {_s('p_partkey')} AS record_reference, {isbn('978', 'p_partkey')} AS isbn13,
       concat_ws(' ', p_name, {_s('p_partkey')}) AS title, p_brand AS publisher_name
FROM part
WHERE p_brand IN ('Brand#1', 'Brand#12', 'Brand#23')
  AND p_partkey IN (SELECT l_partkey FROM lineitem WHERE l_returnflag = 'R')"""


Q_STORED_LOOKUPS = f"""
WITH b AS (
  SELECT 'REF' || {_s('p_partkey')} AS key, p_partkey AS k, {isbn('978', 'p_partkey')} AS isbn13,
         concat_ws(' ', p_name, {_s('p_partkey')}) AS title,
         CASE WHEN p_partkey % 7 = 0 THEN 'New ' ELSE '' END || p_brand AS publisher,
         CASE p_partkey % 4 WHEN 0 THEN '20' WHEN 1 THEN '21' WHEN 2 THEN '40' ELSE '31' END AS availability
  FROM part)
SELECT 'isbn' AS lookup, key, isbn13 AS value FROM b WHERE k IN (SELECT l_partkey FROM lineitem WHERE l_returnflag = 'R')
UNION ALL SELECT 'title', key, title FROM b WHERE title IN (SELECT title FROM b WHERE k % 50 = 0)
UNION ALL SELECT 'title_prefix', key, title FROM b WHERE starts_with(title, 'small r')
UNION ALL SELECT 'publisher', key, publisher FROM b WHERE publisher IN ('Brand#12', 'New Brand#7', 'none')
UNION ALL SELECT 'availability', key, availability FROM b WHERE availability = '21'
UNION ALL SELECT 'finish_date', {isbn('978', 'c_custkey')}, strftime(DATE '2024-01-01' + CAST(c_custkey % 60 AS INTEGER), '%Y-%m-%d')
  FROM customer WHERE c_custkey % 60 BETWEEN 9 AND 19
UNION ALL SELECT 'redirected_from', {isbn('978', 's_suppkey')}, {isbn('979', 's_nationkey')}
  FROM supplier WHERE s_nationkey IN (3, 11)"""

Q_VECTOR_CODEC = """
SELECT vec_id, CAST(len(embedding) AS BIGINT) AS n_dims, true AS roundtrip_ok, true AS bracketed FROM embeddings"""

Q_TEXT_VECTOR = f"""
WITH dt AS (
  SELECT doc_id, 'A' AS w, unnest(regexp_extract_all(lower('doc ' || {_s('doc_id')} || ' ' || source), '{_TOKEN}'))
         AS lex, 0 AS part FROM documents
  UNION ALL SELECT doc_id, 'B', unnest(regexp_extract_all(lower(lang), '{_TOKEN}')), 1 FROM documents
  UNION ALL SELECT doc_id, 'C', unnest(regexp_extract_all(lower(text), '{_TOKEN}')), 2 FROM documents),
total AS (
  SELECT doc_id,
         len(regexp_extract_all(lower('doc ' || {_s('doc_id')} || ' ' || source), '{_TOKEN}'))
         + len(regexp_extract_all(lower(lang), '{_TOKEN}'))
         + len(regexp_extract_all(lower(text), '{_TOKEN}')) AS n_words,
         list_reverse(list_concat(regexp_extract_all(lower('doc ' || {_s('doc_id')} || ' ' || source), '{_TOKEN}'),
                                  regexp_extract_all(lower(lang), '{_TOKEN}'),
                                  regexp_extract_all(lower(text), '{_TOKEN}'))) AS rev
  FROM documents),
last AS (
  SELECT doc_id, n_words - coalesce(list_position(list_transform(rev, lambda x: list_contains({_STOP}, x)), false), 0) + 1
         AS last_position
  FROM total)
SELECT d.doc_id, count(DISTINCT (lex, w)) AS n_entries, count(*) AS n_positions,
       CAST(any_value(l.last_position) AS BIGINT) AS last_position
FROM dt d JOIN last l ON d.doc_id = l.doc_id
WHERE NOT list_contains({_STOP}, lex) GROUP BY d.doc_id"""


def oracles() -> dict[str, str]:
    return {
        "vector_codec": Q_VECTOR_CODEC,
        "text_vector_stats": Q_TEXT_VECTOR,
        "onix_measure_pivot": Q_MEASURES,
        "child_replace": Q_CHILD_REPLACE,
        "genres_upsert": Q_GENRES,
        "book_genres_replace": Q_BOOK_GENRES,
        "embedding_text": _text(True),
        "backfill_text": _text(False),
        "embed_writeback": Q_EMBED_WRITEBACK,
        "stock_gated_merge": _stock("row"),
        "stock_gated_merge_group": _stock("group"),
        "quarantine": Q_QUARANTINE,
        "cosine_topk": Q_COSINE,
        "cosine_cells": Q_COSINE_CELLS,
        "fts_rank": Q_FTS,
        "stored_search": Q_STORED_SEARCH,
        "stemmed_search": Q_STEMMED_SEARCH,
        "trigram_title": Q_TRIGRAM,
        "key_lookups": Q_LOOKUPS,
        "stored_lookups": Q_STORED_LOOKUPS,
    }
