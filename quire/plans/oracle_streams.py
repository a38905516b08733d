"""SQL oracles of the flagship ingest and the streaming jobs (DuckDB dialect)."""

from __future__ import annotations

from quire.plans.oracle import AS_OF, BOOKS_CUR, D, _s, isbn, ts

Q_ONIX_INGEST = f"""
WITH cur AS ({BOOKS_CUR}),
n AS (
  SELECT 'REF' || {_s('p_partkey')} AS record_reference, {isbn('978', 'p_partkey')} AS isbn13,
         concat_ws(' ', p_name, {_s('p_partkey')}) AS title, p_type AS subtitle,
         p_name || ' & ' || p_brand AS long_description, p_brand AS publisher_name,
         CAST(nullif(p_size * 10, 0) AS BIGINT) AS page_count,
         strftime(make_date(2024, CAST(p_partkey % 12 + 1 AS INTEGER), CAST(p_partkey % 28 + 1 AS INTEGER)), {D})
           AS publication_date
  FROM part WHERE p_size <> 1)
SELECT coalesce(n.record_reference, o.record_reference) AS record_reference,
       CASE WHEN n.record_reference IS NOT NULL THEN n.isbn13 ELSE o.isbn13 END AS isbn13,
       CASE WHEN n.record_reference IS NOT NULL THEN n.title ELSE o.title END AS title,
       CASE WHEN n.record_reference IS NOT NULL THEN n.subtitle ELSE o.subtitle END AS subtitle,
       CASE WHEN n.record_reference IS NOT NULL THEN n.long_description ELSE o.long_description END
         AS long_description,
       CASE WHEN n.record_reference IS NOT NULL THEN n.publisher_name ELSE o.publisher_name END AS publisher_name,
       CASE WHEN n.record_reference IS NOT NULL THEN n.page_count ELSE o.page_count END AS page_count,
       CASE WHEN n.record_reference IS NOT NULL THEN n.publication_date ELSE o.publication_date END
         AS publication_date,
       false AS is_removed,
       {ts('''CASE WHEN n.record_reference IS NULL THEN o.embedded_at
              WHEN o.record_reference IS NULL THEN NULL
              WHEN n.title <> o.title OR n.long_description IS DISTINCT FROM o.long_description THEN NULL
              ELSE o.embedded_at END''')} AS embedded_at,
       {ts(f'CASE WHEN o.record_reference IS NOT NULL THEN o.created_at ELSE {AS_OF} END')} AS created_at,
       {ts(f'CASE WHEN n.record_reference IS NOT NULL THEN {AS_OF} ELSE o.updated_at END')} AS updated_at
FROM cur o FULL OUTER JOIN n ON o.record_reference = n.record_reference"""

Q_STREAM_STOCK = f"""
WITH cur AS (
  SELECT {isbn('979', 'c_custkey')} AS isbn13,
         TIMESTAMP '2024-01-10 00:00:00' + to_hours(CAST(c_custkey % 48 AS BIGINT)) AS ts,
         CAST(c_nationkey AS BIGINT) AS qty, 'inventory' AS source, 'old' AS fkey,
         CAST(c_acctbal AS DECIMAL(10,2)) AS rrp, CAST(c_nationkey AS DECIMAL(5,2)) AS disc, 'OLD' AS rcode
  FROM customer),
inc AS (
  SELECT {isbn('979', 'user_id')} AS isbn13, event_id,
         CAST(floor(event_id * (SELECT greatest(4, CAST(ceil(count(*) / 50000) AS BIGINT)) FROM events)
                    / (SELECT count(*) FROM events)) AS INTEGER) AS k,
         CAST(json_extract_string(props, '$.k') AS BIGINT) AS qty
  FROM events WHERE event_type NOT IN ('error', 'view')),
last AS (SELECT isbn13, arg_max({{'q': qty, 'k': k}}, event_id) AS x, max(k) AS mk FROM inc GROUP BY isbn13)
SELECT coalesce(c.isbn13, l.isbn13) AS isbn13,
       CASE WHEN l.isbn13 IS NOT NULL THEN l.x.q ELSE c.qty END AS stock_qty,
       CASE WHEN l.isbn13 IS NULL THEN c.source WHEN l.x.k = 0 THEN 'avail13_full' ELSE 'avail13_delta' END AS source,
       CASE WHEN l.isbn13 IS NOT NULL THEN 'AV_20240101.' || lpad({_s('l.x.k')}, 3, '0') ELSE c.fkey END
         AS source_file_key,
       CAST(c.rrp AS DOUBLE) AS rrp_gbp, CAST(c.disc AS DOUBLE) AS discount_percent, c.rcode AS report_code,
       CAST(NULL AS VARCHAR) AS report_date,
       {ts("CASE WHEN l.isbn13 IS NOT NULL THEN TIMESTAMP '2024-02-01 06:00:00' + to_hours(CAST(l.mk AS BIGINT)) ELSE c.ts END")}
         AS stock_updated_at
FROM cur c FULL OUTER JOIN last l ON c.isbn13 = l.isbn13"""


Q_BOOTSTRAP = """
SELECT 'books' AS feed, 'completed' AS status, count(*) AS rows FROM part
UNION ALL SELECT 'regions', 'completed', count(DISTINCT n_regionkey) FROM nation
UNION ALL SELECT 'firm_sale', 'failed', CAST(0 AS BIGINT)"""


def oracles() -> dict[str, str]:
    return {
        "bootstrap_status": Q_BOOTSTRAP,
        "onix_ingest": Q_ONIX_INGEST,
        "stream_onix_merge": Q_ONIX_INGEST,
        "stream_stock_merge": Q_STREAM_STOCK,
    }
