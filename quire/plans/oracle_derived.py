"""SQL oracles of the derived meanings (DuckDB dialect)."""

from __future__ import annotations

from quire.plans.oracle import isbn, ts

Q_SELLABLE = f"""
WITH r AS (
  SELECT {isbn('978', 'o_custkey')} AS isbn13, n_name AS region_code,
         CASE WHEN o_orderstatus = 'F' THEN 'Y' ELSE 'N' END AS flag
  FROM orders JOIN customer ON o_custkey = c_custkey
  JOIN nation ON n_nationkey = CASE WHEN o_orderkey % 2 = 0 THEN c_nationkey ELSE (c_nationkey + 1) % 25 END),
l AS (SELECT isbn13, bool_or(flag = 'Y') AS has_allow,
             list(DISTINCT region_code) FILTER (WHERE flag = 'Y') AS allow,
             list(DISTINCT region_code) FILTER (WHERE flag = 'N') AS deny
      FROM r GROUP BY isbn13),
p AS (SELECT {isbn('978', 'c_custkey')} AS isbn13, n_name AS region_code
      FROM customer JOIN nation ON c_nationkey = n_nationkey
      UNION ALL
      SELECT {isbn('978', 'c_custkey')}, n_name FROM customer JOIN nation ON (c_nationkey + 2) % 25 = n_nationkey)
SELECT p.isbn13, p.region_code,
       CASE WHEN l.isbn13 IS NULL THEN true
            WHEN l.has_allow THEN list_contains(l.allow, p.region_code)
            ELSE NOT coalesce(list_contains(l.deny, p.region_code), false) END AS sellable
FROM p LEFT JOIN l ON p.isbn13 = l.isbn13"""

Q_REDIRECTS = f"""
WITH RECURSIVE k AS (
  SELECT p_partkey AS a, CASE WHEN p_partkey % 700 // 7 < 99 THEN p_partkey + 7
                              WHEN p_partkey // 700 % 10 = 0 THEN p_partkey - 693 END AS b
  FROM part),
s AS (SELECT a, b FROM k WHERE b > 0),
walk(start, cur, hops) AS (
  SELECT a, b, 1 FROM s
  UNION ALL
  SELECT w.start, s.b, w.hops + 1 FROM walk w JOIN s ON s.a = w.cur WHERE w.cur <> w.start),
r AS (SELECT start, bool_or(cur = start) AS cycle, arg_max(cur, hops) AS final, max(hops) AS hops FROM walk GROUP BY start)
SELECT {isbn('978', 'start')} AS old_isbn13, CASE WHEN NOT cycle THEN {isbn('978', 'final')} END AS final,
       CASE WHEN NOT cycle THEN CAST(hops AS BIGINT) END AS hops, cycle
FROM r"""

Q_ZERO_FILL = f"""
WITH cur AS (
  SELECT {isbn('979', 'c_custkey')} AS isbn13,
         TIMESTAMP '2024-01-10 00:00:00' + to_hours(CAST(c_custkey % 48 AS BIGINT)) AS ts,
         CAST(c_nationkey AS BIGINT) AS qty, CAST(c_acctbal AS DECIMAL(10,2)) AS rrp,
         CAST(c_nationkey AS DECIMAL(5,2)) AS disc
  FROM customer),
f AS (SELECT DISTINCT {isbn('979', 'user_id')} AS isbn13 FROM events
      WHERE event_type = 'purchase')
SELECT c.isbn13,
       CASE WHEN f.isbn13 IS NULL THEN 0 ELSE c.qty END AS stock_qty,
       CASE WHEN f.isbn13 IS NULL THEN 'avail13_full' ELSE 'inventory' END AS source,
       'old' AS source_file_key, CAST(c.rrp AS DOUBLE) AS rrp_gbp, CAST(c.disc AS DOUBLE) AS discount_percent,
       'OLD' AS report_code, CAST(NULL AS VARCHAR) AS report_date,
       {ts("CASE WHEN f.isbn13 IS NULL THEN greatest(c.ts, TIMESTAMP '2024-02-01 06:00:00') ELSE c.ts END")}
         AS stock_updated_at
FROM cur c LEFT JOIN f ON c.isbn13 = f.isbn13"""


def oracles() -> dict[str, str]:
    return {"region_sellability": Q_SELLABLE, "redirect_resolution": Q_REDIRECTS, "stock_zero_fill": Q_ZERO_FILL}
