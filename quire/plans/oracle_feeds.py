"""SQL oracles of the wholesaler-feed queries (DuckDB dialect)."""

from __future__ import annotations

from quire.plans.oracle import AS_OF, LINE_ORDER_DESC, _s, days_before, isbn, ts

FIXED_NAMES = "['GARDPROM13.CSV', 'FIRMSALE13.CSV', 'ISBNSL13.CSV', 'RESTRICT.CSV', 'REGIONS.CSV', 'README.TXT']"

Q_FEED_MANIFEST = f"""
WITH f AS (
  SELECT *, CASE
    WHEN o_orderpriority = '1-URGENT' THEN 'IV' || strftime(o_orderdate, '%m%d%Y') || '.TXT'
    WHEN o_orderpriority = '2-HIGH' THEN 'AV_' || strftime(o_orderdate, '%Y%m%d') || '.'
         || lpad({_s('o_orderkey % 1000')}, 3, '0')
    WHEN o_orderpriority = '3-MEDIUM' THEN 'WholesaleONIX3_wk' || {_s('o_orderkey % 52 + 1')}
         || CASE WHEN o_orderstatus = 'F' THEN '_Full.zip' ELSE '_Delta.zip' END
    WHEN o_orderpriority = '4-NOT SPECIFIED' THEN {FIXED_NAMES}[CAST(o_orderkey % 6 + 1 AS INTEGER)]
    ELSE CASE WHEN o_orderstatus = 'P' THEN 'BookImages_wk' || {_s('o_orderkey % 9')} || '.zip'
              ELSE 'iv' || strftime(o_orderdate, '%m%d%Y') || '.txt.bak' END END AS fn
  FROM orders),
m AS (
  SELECT '/feeds/' || {_s('o_custkey')} || '/' || {_s('o_orderkey')} || '/' || fn AS path,
         CAST(trunc(o_totalprice * 100000) AS BIGINT) AS size,
         CASE WHEN regexp_full_match(fn, '(?i)IV[0-9]{{8}}\\.TXT') THEN 'inventory'
              WHEN regexp_full_match(fn, '(?i)AV_[0-9]{{8}}\\.[0-9]{{3}}') THEN 'avail13'
              WHEN regexp_full_match(fn, '(?i)WholesaleONIX3_wk([0-9]+)_Delta\\.zip') THEN 'biblio_delta'
              WHEN regexp_full_match(fn, '(?i)WholesaleONIX3_wk([0-9]+)_Full\\.zip') THEN 'biblio_full'
              WHEN regexp_full_match(fn, '(?i)BookImages_wk[0-9]+\\.zip') THEN 'covers_update'
              WHEN upper(fn) = 'GARDPROM13.CSV' THEN 'promotions'
              WHEN upper(fn) = 'FIRMSALE13.CSV' THEN 'firm_sale'
              WHEN upper(fn) = 'ISBNSL13.CSV' THEN 'isbn_slips'
              WHEN upper(fn) = 'RESTRICT.CSV' THEN 'market_restrictions'
              WHEN upper(fn) = 'REGIONS.CSV' THEN 'regions' END AS feed
  FROM f)
SELECT path, feed, feed = 'inventory' AS needs_done,
       (feed = 'covers_update' AND size > 5368709120) AS oversize
FROM m WHERE feed IS NOT NULL"""

Q_DONE_GATE = f"""
SELECT '/inv/' || {_s('o_orderkey')} || '/IV' || strftime(o_orderdate, '%m%d%Y') || '.TXT' AS path
FROM orders WHERE o_orderstatus = 'F'"""

Q_FRAMED_INVENTORY = f"""
SELECT {isbn('979', 'user_id')} AS isbn13,
       CAST(CAST(value AS DECIMAL(10,2)) AS DOUBLE) AS rrp_gbp,
       CAST(event_id % 40 AS DOUBLE) AS discount_percent,
       CASE WHEN event_type = 'view' THEN NULL ELSE CAST(json_extract_string(props, '$.k') AS BIGINT) END
         AS stock_qty,
       upper(substr(event_type, 1, 3)) AS report_code,
       CASE WHEN event_id % 13 = 0 THEN NULL ELSE strftime(ts, '%Y-%m-%d') END AS report_date,
       'inventory' AS source
FROM events WHERE event_type <> 'error'"""

NL = "(SELECT greatest(2, CAST(ceil(count(*) / 100000) AS BIGINT)) FROM events)"

Q_FRAMED_SUMMARY = f"""
WITH per AS (
  SELECT event_id % (2 * {NL}) AS f, count(*) AS n,
         count(*) FILTER (WHERE event_type <> 'error') AS acc,
         count(*) FILTER (WHERE event_type = 'error' AND event_id % 7 <> 0) AS sk,
         count(*) FILTER (WHERE event_type = 'error' AND event_id % 7 = 0) AS pe
  FROM events GROUP BY 1)
SELECT CASE WHEN f < {NL} THEN 'bespoke' ELSE 'generic' END AS layout, count(*) AS files,
       CAST(sum(acc) AS BIGINT) AS total_rows, CAST(sum(sk) AS BIGINT) AS skipped_rows,
       CAST(sum(pe) AS BIGINT) AS parse_error_rows,
       CAST(sum(n + CASE WHEN f = {NL} + 1 THEN 1 ELSE 0 END) AS BIGINT) AS trailer_total,
       count(*) FILTER (WHERE f = {NL} + 1) AS mismatched_files
FROM per GROUP BY 1"""

Q_UNFRAMED_AVAIL = f"""
SELECT {isbn('979', 'user_id')} AS isbn13, CAST(json_extract_string(props, '$.k') AS BIGINT) AS stock_qty,
       CASE WHEN event_id % (SELECT greatest(4, CAST(ceil(count(*) / 50000) AS BIGINT)) FROM events) = 0
            THEN 'avail13_full' ELSE 'avail13_delta' END AS source
FROM events WHERE event_type NOT IN ('error', 'view')"""

Q_PARSE_SCALARS = """
SELECT o_orderkey,
       CAST(nullif(try_cast(regexp_extract(o_orderpriority, '^\\s*([+-]?[0-9]+)', 1) AS INTEGER), 0) AS BIGINT)
         AS priority_int,
       CAST(nullif(CAST(trunc(o_totalprice) AS INTEGER), 0) AS BIGINT) AS price_int,
       CAST(nullif(o_orderkey % 7 - 3, 0) AS BIGINT) AS small_int,
       CASE WHEN o_orderkey % 19 = 0 OR o_orderkey % 5 = 0 THEN NULL
            ELSE strftime(o_orderdate, '%Y-%m-%d') END AS pub_date
FROM orders"""

Q_ISBN_FILTER = f"""
WITH c AS (
  SELECT c_custkey, CASE c_custkey % 6
    WHEN 0 THEN {isbn('978', 'c_custkey')}
    WHEN 1 THEN ' ' || {isbn('979', 'c_custkey')} || ' '
    WHEN 2 THEN {isbn('977', 'c_custkey')}
    WHEN 3 THEN '978' || lpad({_s('c_custkey')}, 9, '0')
    WHEN 4 THEN c_name
    ELSE '9790' || lpad({_s('c_custkey')}, 9, '0') || 'X' END AS raw
  FROM customer)
SELECT c_custkey, raw, coalesce(regexp_full_match(trim(raw), '(978|979)[0-9]{{10}}'), false) AS is_valid,
       CASE WHEN regexp_full_match(trim(raw), '(978|979)[0-9]{{10}}') THEN trim(raw) END AS isbn13
FROM c"""

Q_FEED_DATES = """
WITH o AS (SELECT o_orderkey, strftime(o_orderdate, '%d/%m/%Y') AS d, strftime(o_orderdate, '%d/%m/%y') AS d2
           FROM orders),
r AS (
  SELECT o_orderkey,
         CASE WHEN o_orderkey % 11 = 0 THEN '00' || substr(d, 3, 8)
              WHEN o_orderkey % 13 = 0 THEN substr(d, 1, 3) || '13' || substr(d, 6, 5) ELSE d END AS raw1,
         CASE WHEN o_orderkey % 17 = 0 THEN '31/02/' || substr(d2, 7, 2) ELSE d2 END AS raw2
  FROM o)
SELECT o_orderkey, raw1,
       CASE WHEN substr(raw1, 1, 2) <> '00' THEN strftime(try_strptime(raw1, '%d/%m/%Y'), '%Y-%m-%d') END AS date1,
       raw2,
       strftime(try_strptime('20' || substr(raw2, 7, 2) || '-' || substr(raw2, 4, 2) || '-' || substr(raw2, 1, 2),
                             '%Y-%m-%d'), '%Y-%m-%d') AS date2
FROM r"""


def _promotions(sweep: bool) -> str:
    return f"""
WITH cur AS (
  SELECT {isbn('978', 'c_custkey')} AS isbn13, c_name AS title, c_mktsegment AS author,
         CAST(c_acctbal AS DECIMAL(10,2)) AS price, CAST(c_nationkey AS DECIMAL(5,2)) AS discount_percent,
         'R' AS returns_flag, CAST(NULL AS DATE) AS finish_date, {days_before(7)} AS synced_at,
         {days_before(30)} AS created_at
  FROM customer),
inc AS (
  SELECT * FROM (
    SELECT {isbn('978', 'o_custkey')} AS isbn13, 'Order ' || {_s('o_orderkey')} AS title,
           o_orderpriority AS author, CAST(o_totalprice AS DECIMAL(10,2)) AS price,
           CAST(o_orderkey % 50 AS DECIMAL(5,2)) AS discount_percent,
           CASE WHEN o_orderstatus = 'F' THEN 'F' ELSE 'R' END AS returns_flag,
           CAST(try_strptime('20' || strftime(o_orderdate, '%y-%m-%d'), '%Y-%m-%d') AS DATE) AS finish_date,
           {AS_OF} AS synced_at,
           row_number() OVER (PARTITION BY o_custkey ORDER BY o_orderkey DESC) AS rn
    FROM orders WHERE o_orderstatus <> 'P') WHERE rn = 1),
m AS (
  SELECT coalesce(n.isbn13, o.isbn13) AS isbn13,
         CASE WHEN n.isbn13 IS NOT NULL THEN n.title ELSE o.title END AS title,
         CASE WHEN n.isbn13 IS NOT NULL THEN n.author ELSE o.author END AS author,
         CASE WHEN n.isbn13 IS NOT NULL THEN n.price ELSE o.price END AS price,
         CASE WHEN n.isbn13 IS NOT NULL THEN n.discount_percent ELSE o.discount_percent END AS discount_percent,
         CASE WHEN n.isbn13 IS NOT NULL THEN n.returns_flag ELSE o.returns_flag END AS returns_flag,
         CASE WHEN n.isbn13 IS NOT NULL THEN n.finish_date ELSE o.finish_date END AS finish_date,
         CASE WHEN n.isbn13 IS NOT NULL THEN n.synced_at ELSE o.synced_at END AS synced_at,
         CASE WHEN o.isbn13 IS NOT NULL THEN o.created_at ELSE {AS_OF} END AS created_at
  FROM cur o FULL OUTER JOIN inc n ON o.isbn13 = n.isbn13)
SELECT isbn13, title, author, CAST(price AS DOUBLE) AS price, CAST(discount_percent AS DOUBLE) AS discount_percent,
       returns_flag, strftime(finish_date, '%Y-%m-%d') AS finish_date, {ts('synced_at')} AS synced_at,
       {ts('created_at')} AS created_at
FROM m {"WHERE synced_at >= " + AS_OF if sweep else ""}"""


Q_FIRM_SALE = f"""
WITH cur AS (
  SELECT {isbn('978', 'p_partkey')} AS isbn13, p_brand AS report_code, {days_before(7)} AS synced_at,
         {days_before(30)} AS created_at FROM part),
inc AS (
  SELECT * FROM (
    SELECT {isbn('978', 'l_partkey')} AS isbn13,
           CASE WHEN l_linestatus = 'O' THEN NULL ELSE l_returnflag || l_linestatus END AS report_code,
           row_number() OVER (PARTITION BY l_partkey ORDER BY {LINE_ORDER_DESC}) AS rn
    FROM lineitem) WHERE rn = 1)
SELECT coalesce(n.isbn13, o.isbn13) AS isbn13,
       CASE WHEN n.isbn13 IS NOT NULL THEN n.report_code ELSE o.report_code END AS report_code,
       {ts(f"CASE WHEN n.isbn13 IS NOT NULL THEN {AS_OF} ELSE o.synced_at END")} AS synced_at,
       {ts(f"CASE WHEN o.isbn13 IS NOT NULL THEN o.created_at ELSE {AS_OF} END")} AS created_at
FROM cur o FULL OUTER JOIN inc n ON o.isbn13 = n.isbn13"""

Q_ISBN_SLIPS = f"""
WITH cur AS (
  SELECT {isbn('978', 'p_partkey')} AS old_isbn13, {isbn('979', 'p_partkey')} AS new_isbn13,
         {days_before(7)} AS synced_at, {days_before(30)} AS created_at FROM part),
inc AS (
  SELECT {isbn('978', 's_suppkey')} AS old_isbn13, {isbn('979', 's_suppkey * 7 + s_nationkey')} AS new_isbn13
  FROM supplier WHERE s_acctbal >= 0)
SELECT coalesce(n.old_isbn13, o.old_isbn13) AS old_isbn13,
       CASE WHEN n.old_isbn13 IS NOT NULL THEN n.new_isbn13 ELSE o.new_isbn13 END AS new_isbn13,
       {ts(f"CASE WHEN n.old_isbn13 IS NOT NULL THEN {AS_OF} ELSE o.synced_at END")} AS synced_at,
       {ts(f"CASE WHEN o.old_isbn13 IS NOT NULL THEN o.created_at ELSE {AS_OF} END")} AS created_at
FROM cur o FULL OUTER JOIN inc n ON o.old_isbn13 = n.old_isbn13"""

Q_RESTRICTIONS = f"""
WITH cur AS (
  SELECT {isbn('978', 'c_custkey')} AS isbn13, 'N' AS flag, n_name AS region_code,
         {days_before(7)} AS synced_at, {days_before(30)} AS created_at
  FROM customer JOIN nation ON c_nationkey = n_nationkey),
inc AS (
  SELECT * FROM (
    SELECT {isbn('978', 'o_custkey')} AS isbn13,
           CASE WHEN o_orderstatus = 'F' THEN 'Y' ELSE 'N' END AS flag, n_name AS region_code,
           row_number() OVER (PARTITION BY o_custkey, n_name ORDER BY o_orderkey DESC) AS rn
    FROM orders JOIN customer ON o_custkey = c_custkey JOIN nation ON c_nationkey = n_nationkey
    WHERE o_orderstatus IN ('F', 'O') AND o_orderpriority <> '5-LOW') WHERE rn = 1)
SELECT coalesce(n.isbn13, o.isbn13) AS isbn13, coalesce(n.region_code, o.region_code) AS region_code,
       CASE WHEN n.isbn13 IS NOT NULL THEN n.flag ELSE o.flag END AS flag,
       {ts(f"CASE WHEN n.isbn13 IS NOT NULL THEN {AS_OF} ELSE o.synced_at END")} AS synced_at,
       {ts(f"CASE WHEN o.isbn13 IS NOT NULL THEN o.created_at ELSE {AS_OF} END")} AS created_at
FROM cur o FULL OUTER JOIN inc n ON o.isbn13 = n.isbn13 AND o.region_code = n.region_code"""

Q_REGIONS = f"""
WITH cur AS (SELECT 'R' || {_s('r_regionkey')} AS code, r_name AS name, {days_before(7)} AS synced_at FROM region),
inc AS (
  SELECT * FROM (
    SELECT 'R' || {_s('n_regionkey')} AS code, n_name AS name,
           row_number() OVER (PARTITION BY n_regionkey ORDER BY n_nationkey DESC) AS rn
    FROM nation WHERE n_nationkey % 5 <> 4) WHERE rn = 1)
SELECT coalesce(n.code, o.code) AS code, CASE WHEN n.code IS NOT NULL THEN n.name ELSE o.name END AS name,
       {ts(f"CASE WHEN n.code IS NOT NULL THEN {AS_OF} ELSE o.synced_at END")} AS synced_at
FROM cur o FULL OUTER JOIN inc n ON o.code = n.code"""

Q_BOOK_ID_BACKFILL = f"""
WITH s AS (SELECT {isbn('978', 'l_partkey')} AS isbn13,
                  CASE WHEN max(l_linenumber) >= 7 THEN -1 END AS book_id
           FROM lineitem GROUP BY l_partkey),
t AS (SELECT DISTINCT {isbn('978', 'l_partkey')} AS isbn13 FROM lineitem WHERE l_returnflag = 'R'),
b AS (SELECT p_partkey * 10 AS id, {isbn('978', 'p_partkey')} AS isbn13 FROM part)
SELECT s.isbn13, CAST(coalesce(s.book_id, b.id) AS BIGINT) AS book_id
FROM s LEFT JOIN (SELECT * FROM b WHERE isbn13 IN (SELECT isbn13 FROM t)) b ON s.isbn13 = b.isbn13"""


Q_MULTILINE_CSV = f"""
SELECT {isbn('978', 'o_orderkey')} AS isbn13,
       'Order ' || {_s('o_orderkey')} || CASE WHEN o_orderkey % 5 = 0 THEN '/second, line'
         WHEN o_orderkey % 7 = 0 THEN '/says "no"/' ELSE '' END AS title,
       CAST(CAST(o_totalprice AS DECIMAL(10,2)) AS DOUBLE) AS price
FROM orders"""


def oracles() -> dict[str, str]:
    return {
        "multiline_csv": Q_MULTILINE_CSV,
        "feed_manifest": Q_FEED_MANIFEST,
        "done_gate": Q_DONE_GATE,
        "framed_csv_inventory": Q_FRAMED_INVENTORY,
        "framed_csv_summary": Q_FRAMED_SUMMARY,
        "unframed_csv_avail": Q_UNFRAMED_AVAIL,
        "onix_parse_scalars": Q_PARSE_SCALARS,
        "isbn_filter": Q_ISBN_FILTER,
        "feed_dates": Q_FEED_DATES,
        "promotions_upsert": _promotions(False),
        "mark_and_sweep": _promotions(True),
        "firm_sale_upsert": Q_FIRM_SALE,
        "isbn_slips": Q_ISBN_SLIPS,
        "restrictions_upsert": Q_RESTRICTIONS,
        "regions_upsert": Q_REGIONS,
        "book_id_backfill": Q_BOOK_ID_BACKFILL,
    }
