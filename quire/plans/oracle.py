"""Independent SQL (DuckDB dialect) for every query with a set-based oracle.

Written from the operator rules, not from the Spark plans: windows and joins
where Spark uses aggregates, full joins where Spark uses anti-joins.
"""

from __future__ import annotations

AS_OF = "TIMESTAMP '2024-06-01 00:00:00'"
TS = "'%Y-%m-%d %H:%M:%S'"
D = "'%Y-%m-%d'"


def _s(x: str) -> str:
    return f"CAST({x} AS VARCHAR)"


def isbn(prefix: str, x: str) -> str:
    return f"('{prefix}' || lpad({_s(x)}, 10, '0'))"


def ts(x: str) -> str:
    return f"strftime({x}, {TS})"


def days_before(n: int) -> str:
    return f"({AS_OF} - INTERVAL {n} DAY)"


LINE_ORDER_DESC = ("l_shipdate DESC, l_orderkey DESC, l_linenumber DESC, l_partkey DESC, l_suppkey DESC, "
                   "l_quantity DESC, l_extendedprice DESC, l_discount DESC, l_tax DESC, "
                   "l_returnflag DESC, l_linestatus DESC")

BOOKS_CUR = f"""
  SELECT 'REF' || {_s('p_partkey')} AS record_reference,
         {isbn('978', 'p_partkey')} AS isbn13,
         concat_ws(' ', p_name, {_s('p_partkey')}) AS title,
         p_type AS subtitle,
         p_name || ' by ' || p_brand AS long_description,
         p_brand AS publisher_name,
         CAST(p_size AS BIGINT) AS page_count,
         CAST(NULL AS VARCHAR) AS publication_date,
         CASE WHEN p_size % 2 = 0 THEN {days_before(10)} END AS embedded_at,
         false AS is_removed,
         CAST(NULL AS TIMESTAMP) AS removed_at,
         {days_before(30)} AS created_at,
         {days_before(30)} AS updated_at
  FROM part"""


def notices(with_deletes: bool = False) -> str:
    ntype = "CASE WHEN l_returnflag = 'R' THEN '05' ELSE '03' END" if with_deletes else "'03'"
    isbn_e = (f"CASE WHEN l_linenumber <= 5 THEN {isbn('978', 'l_partkey')} ELSE {isbn('979', 'l_partkey')} END")
    if with_deletes:
        isbn_e = f"CASE WHEN l_returnflag = 'R' AND l_linestatus = 'O' THEN NULL ELSE {isbn_e} END"
    return f"""
  SELECT CASE WHEN l_linenumber <= 5 THEN 'REF' ELSE 'NEW' END || {_s('l_partkey')} AS record_reference,
         {ntype} AS notification_type,
         {isbn_e} AS isbn13,
         CASE WHEN l_returnflag = 'R' THEN p_name || ' (revised ' || {_s('l_linenumber')} || ')'
              ELSE concat_ws(' ', p_name, {_s('l_partkey')}) END AS title,
         p_type AS subtitle,
         CASE WHEN l_linestatus = 'O' THEN 'Open edition of ' || p_name ELSE p_name || ' by ' || p_brand END
           AS long_description,
         p_brand AS publisher_name,
         CAST(trunc(l_quantity) AS BIGINT) AS page_count,
         strftime(CAST(l_shipdate AS DATE), {D}) AS publication_date,
         l_shipdate, l_orderkey, l_linenumber, l_partkey, l_suppkey, l_quantity, l_extendedprice,
         l_discount, l_tax, l_returnflag, l_linestatus
  FROM lineitem JOIN part ON l_partkey = p_partkey"""


def _book_merge(inc_filter: str = "") -> str:
    return f"""
WITH cur AS ({BOOKS_CUR}),
inc AS ({notices()}),
last AS (
  SELECT * FROM (
    SELECT *, row_number() OVER (PARTITION BY record_reference ORDER BY {LINE_ORDER_DESC}) AS rn
    FROM inc {inc_filter}) WHERE rn = 1),
merged AS (
  SELECT coalesce(n.record_reference, o.record_reference) AS record_reference,
         CASE WHEN n.record_reference IS NOT NULL THEN n.isbn13 ELSE o.isbn13 END AS isbn13,
         CASE WHEN n.record_reference IS NOT NULL THEN n.title ELSE o.title END AS title,
         CASE WHEN n.record_reference IS NOT NULL THEN n.subtitle ELSE o.subtitle END AS subtitle,
         CASE WHEN n.record_reference IS NOT NULL THEN n.long_description ELSE o.long_description END
           AS long_description,
         CASE WHEN n.record_reference IS NOT NULL THEN n.publisher_name ELSE o.publisher_name END
           AS publisher_name,
         CASE WHEN n.record_reference IS NOT NULL THEN n.page_count ELSE o.page_count END AS page_count,
         CASE WHEN n.record_reference IS NOT NULL THEN n.publication_date ELSE o.publication_date END
           AS publication_date,
         false AS is_removed,
         CASE WHEN n.record_reference IS NULL THEN o.embedded_at
              WHEN o.record_reference IS NULL THEN NULL
              WHEN n.title <> o.title OR n.long_description IS DISTINCT FROM o.long_description THEN NULL
              ELSE o.embedded_at END AS embedded_at,
         CASE WHEN o.record_reference IS NOT NULL THEN o.created_at ELSE {AS_OF} END AS created_at,
         CASE WHEN n.record_reference IS NOT NULL THEN {AS_OF} ELSE o.updated_at END AS updated_at,
         n.record_reference IS NOT NULL AS touched
  FROM cur o FULL OUTER JOIN last n ON o.record_reference = n.record_reference)"""


Q_BOOK_UPSERT = _book_merge() + f"""
SELECT record_reference, isbn13, title, subtitle, long_description, publisher_name, page_count,
       publication_date, is_removed, {ts('embedded_at')} AS embedded_at,
       {ts('created_at')} AS created_at, {ts('updated_at')} AS updated_at
FROM merged"""

Q_NEEDS_EMBEDDING = _book_merge() + """
SELECT record_reference, title FROM merged WHERE touched AND embedded_at IS NULL"""

Q_SOFT_DELETE = f"""
WITH cur AS ({BOOKS_CUR}),
inc AS (SELECT *, row_number() OVER (ORDER BY l_shipdate, l_orderkey, l_linenumber, l_partkey, l_suppkey,
          l_quantity, l_extendedprice, l_discount, l_tax, l_returnflag, l_linestatus) AS seq
        FROM ({notices(True)})),
ups AS (SELECT * FROM inc WHERE notification_type <> '05'),
last AS (SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY record_reference ORDER BY seq DESC) AS rn
                        FROM ups) WHERE rn = 1),
merged AS (
  SELECT coalesce(n.record_reference, o.record_reference) AS record_reference,
         CASE WHEN n.record_reference IS NOT NULL THEN n.isbn13 ELSE o.isbn13 END AS isbn13,
         CASE WHEN n.record_reference IS NOT NULL THEN n.title ELSE o.title END AS title,
         CASE WHEN n.record_reference IS NOT NULL THEN false ELSE o.is_removed END AS is_removed,
         CASE WHEN n.record_reference IS NOT NULL THEN NULL ELSE o.removed_at END AS removed_at,
         CASE WHEN n.record_reference IS NOT NULL THEN {AS_OF} ELSE o.updated_at END AS updated_at
  FROM cur o FULL OUTER JOIN last n ON o.record_reference = n.record_reference),
targets AS (
  SELECT m.record_reference, i.seq, i.notification_type
  FROM inc i JOIN merged m ON i.notification_type = '05' AND i.isbn13 IS NOT NULL AND m.isbn13 = i.isbn13
  UNION ALL
  SELECT i.record_reference, i.seq, i.notification_type
  FROM inc i WHERE i.notification_type = '05' AND i.isbn13 IS NULL
  UNION ALL
  SELECT record_reference, seq, notification_type FROM ups),
final_notice AS (
  SELECT record_reference, arg_max(notification_type, seq) AS last_type FROM targets GROUP BY record_reference)
SELECT m.record_reference, m.isbn13, m.title,
       CASE WHEN f.last_type = '05' THEN true ELSE m.is_removed END AS is_removed,
       {ts("CASE WHEN f.last_type = '05' THEN " + AS_OF + " ELSE m.removed_at END")} AS removed_at,
       {ts('m.updated_at')} AS updated_at
FROM merged m LEFT JOIN final_notice f ON m.record_reference = f.record_reference"""


Q_ONIX_SCAN = f"""
SELECT 'REF' || {_s('p_partkey')} AS record_reference, '03' AS notification_type,
       {isbn('978', 'p_partkey')} AS isbn13, upper(substr(p_type, 1, 2)) AS product_form,
       '00' AS product_composition, CAST(nullif(p_partkey % 3, 0) AS BIGINT) AS edition_number,
       CAST(nullif(p_size * 10, 0) AS BIGINT) AS page_count, CAST(p_size * 7 AS DOUBLE) AS height_mm,
       CAST(CAST(p_retailprice AS DECIMAL(9,2)) AS DOUBLE) AS weight_gr,
       concat_ws(' ', p_name, {_s('p_partkey')}) AS title, p_type AS subtitle,
       p_name || ' & ' || p_brand AS long_description, p_brand AS publisher_name, '04' AS publishing_status,
       strftime(make_date(2024, CAST(p_partkey % 12 + 1 AS INTEGER), CAST(p_partkey % 28 + 1 AS INTEGER)), {D})
         AS publication_date,
       '21' AS availability_code, CAST(0 AS BIGINT) AS n_contributors, p_type AS first_subject,
       true AS first_subject_main,
       CAST(CAST(nullif(p_retailprice, 0) AS DECIMAL(12,2)) AS DOUBLE) AS price_amount, 'GBP' AS currency_code
FROM part WHERE p_size <> 1"""

Q_ONIX_CORRUPT = f"""
SELECT 'REF' || {_s('p_partkey')} AS record_reference,
       CASE WHEN p_partkey % 17 = 0 THEN 'malformed' ELSE 'ok' END AS status
FROM part"""


Q_ONIX_SUMMARY = """
SELECT CAST(greatest(4, ceil(count(*) / 50000)) AS BIGINT) AS files,
       CAST(count(*) FILTER (WHERE p_partkey % 17 <> 0) AS BIGINT) AS parsed,
       CAST(count(*) FILTER (WHERE p_partkey % 17 <> 0 AND p_size <> 1) AS BIGINT) AS kept,
       CAST(count(*) FILTER (WHERE p_partkey % 17 = 0) AS BIGINT) AS corrupt,
       CAST(count(*) FILTER (WHERE p_partkey % 17 <> 0 AND p_size = 1) AS BIGINT) AS dropped_no_title
FROM part"""


Q_BOOK_ID_LOOKUP = """
SELECT DISTINCT 'REF' || CAST(l_partkey AS VARCHAR) AS record_reference, l_partkey * 10 AS book_id
FROM lineitem JOIN part ON l_partkey = p_partkey WHERE l_linenumber <= 5"""


def oracles() -> dict[str, str]:
    return {
        "book_id_lookup": Q_BOOK_ID_LOOKUP,
        "onix_scan_summary": Q_ONIX_SUMMARY,
        "onix_scan_project": Q_ONIX_SCAN,
        "onix_corrupt_split": Q_ONIX_CORRUPT,
        "book_upsert": Q_BOOK_UPSERT,
        "needs_embedding": Q_NEEDS_EMBEDDING,
        "soft_delete_reactivate": Q_SOFT_DELETE,
    }
