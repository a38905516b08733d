"""SQL oracles of the ledger, job, excerpt and cover queries (DuckDB dialect)."""

from __future__ import annotations

from quire.plans.oracle import AS_OF, _s, days_before, isbn, ts

TS_ = "'%Y-%m-%d %H:%M:%S'"
STATUS = "CASE o_orderstatus WHEN 'F' THEN 'completed' WHEN 'O' THEN 'processing' WHEN 'P' THEN 'failed' END"

FILE_LEDGER = f"""
  SELECT * FROM (
    SELECT lower(c_mktsegment) AS feed, '/feeds/' || {_s('o_custkey')} || '.csv' AS remote_path,
           {STATUS} AS status,
           CAST(4 AS BIGINT) AS total_chunks,
           CAST(CASE WHEN o_orderstatus = 'F' THEN 4 ELSE o_orderkey % 4 END AS BIGINT) AS processed_chunks,
           CASE WHEN o_orderstatus = 'P' THEN 'boom' END AS error_message,
           {AS_OF} - to_hours(CAST(o_orderkey % 6 AS BIGINT)) AS started_at,
           CASE WHEN o_orderstatus = 'F' THEN {AS_OF} - to_hours(CAST(o_orderkey % 6 AS BIGINT)) END AS completed_at,
           row_number() OVER (PARTITION BY lower(c_mktsegment), o_custkey ORDER BY o_orderkey DESC) AS rn
    FROM orders JOIN customer ON o_custkey = c_custkey) WHERE rn = 1"""

UNCLAIMED = f"""
WITH led AS ({FILE_LEDGER}),
blk AS (SELECT feed, remote_path FROM led
        WHERE status = 'completed' OR (status <> 'failed' AND started_at > {AS_OF} - INTERVAL 3 HOUR)),
man AS (SELECT lower(c_mktsegment) AS feed, '/feeds/' || {_s('c_custkey')} || '.csv' AS path FROM customer),
un AS (SELECT * FROM man WHERE NOT EXISTS (
         SELECT 1 FROM blk WHERE blk.feed = man.feed AND blk.remote_path = man.path))"""

Q_UNCLAIMED = UNCLAIMED + "\nSELECT path, feed FROM un"

Q_CLAIM = UNCLAIMED + f"""
SELECT feed, remote_path, status, processed_chunks, total_chunks, error_message,
       {ts('started_at')} AS started_at, {ts('completed_at')} AS completed_at
FROM led WHERE NOT EXISTS (SELECT 1 FROM un WHERE un.feed = led.feed AND un.path = led.remote_path)
UNION ALL
SELECT feed, path, 'downloading', CAST(0 AS BIGINT), CAST(NULL AS BIGINT), CAST(NULL AS VARCHAR),
       {ts(AS_OF)}, CAST(NULL AS VARCHAR)
FROM un"""

JOBS = f"""SELECT o_orderkey AS id, 'onix/' || {_s('o_custkey')} || '.xml' AS file_key, {STATUS} AS status,
          o_orderdate AS created_at FROM orders"""
ONIX_MANIFEST = f"SELECT 'onix/' || {_s('c_custkey')} || '.xml' AS file_key FROM customer"

Q_UNPROCESSED = f"""
WITH jobs AS ({JOBS}), man AS ({ONIX_MANIFEST})
SELECT file_key FROM man WHERE file_key NOT IN (SELECT file_key FROM jobs WHERE status <> 'failed')"""

Q_TRIGGER_GUARD = f"""
WITH jobs AS ({JOBS}), man AS ({ONIX_MANIFEST})
SELECT file_key, CASE WHEN file_key IN (SELECT file_key FROM jobs WHERE status <> 'failed')
                      THEN 'rejected' ELSE 'accepted' END AS decision
FROM man"""

CHUNKS = """
  SELECT l_orderkey AS job_id, l_linenumber AS chunk_index, count(*) AS n,
         count(*) FILTER (WHERE l_returnflag = 'R') AS f,
         CASE WHEN count(*) FILTER (WHERE l_returnflag = 'R') = count(*) THEN 'failed' ELSE 'completed' END AS st
  FROM lineitem GROUP BY 1, 2"""

Q_JOB_PROGRESS = f"""
WITH ch AS ({CHUNKS}),
agg AS (SELECT job_id, count(*) AS pc, sum(n - f) AS pb, count(*) FILTER (WHERE f > 0) AS fc FROM ch GROUP BY 1),
jobs AS (
  SELECT o_orderkey AS id, 'onix/' || {_s('o_orderkey')} || '.xml' AS file_key,
         coalesce(a.pc, 0) + CASE WHEN o_orderstatus = 'P' THEN 1 ELSE 0 END AS total_chunks,
         coalesce(a.pc, 0) AS pc, coalesce(a.pb, 0) AS pb, coalesce(a.fc, 0) AS fc
  FROM orders LEFT JOIN agg a ON a.job_id = o_orderkey)
SELECT id, file_key, CASE WHEN pc = total_chunks THEN 'completed' ELSE 'processing' END AS status,
       CAST(total_chunks AS BIGINT) AS total_chunks, CAST(pc AS BIGINT) AS processed_chunks,
       CAST(fc AS BIGINT) AS failed_chunks, CAST(pb AS BIGINT) AS processed_books,
       CASE WHEN pc = total_chunks THEN {ts(AS_OF)} END AS completed_at
FROM jobs"""

Q_JOB_DETAIL = f"""
WITH ch AS ({CHUNKS})
SELECT o_orderkey AS id, string_agg({_s('chunk_index')} || ':' || st, ',' ORDER BY chunk_index) AS chunk_list
FROM orders LEFT JOIN ch ON ch.job_id = o_orderkey GROUP BY o_orderkey"""

Q_JOB_PAGE = f"""
SELECT o_orderkey AS id, 'onix/' || {_s('o_custkey')} || '.xml' AS file_key, {ts('o_orderdate')} AS created_at
FROM orders ORDER BY o_orderdate DESC, o_orderkey DESC LIMIT 20 OFFSET 40"""

Q_LATEST_FULL = f"""
SELECT landing_key FROM (
  SELECT 'onix/biblio-wk' || {_s('o_orderkey % 52 + 1')} || '-full.xml' AS landing_key,
         o_orderdate AS completed_at, '/onix/' || {_s('o_orderkey')} AS remote_path
  FROM orders
  WHERE o_orderpriority = '3-MEDIUM' AND o_orderstatus = 'F' AND o_orderkey % 4 <> 0)
ORDER BY completed_at DESC, remote_path DESC LIMIT 1"""

CHUNK_TABLE = f"""
  SELECT job_id, chunk_index, status,
         CASE WHEN status <> 'completed' AND chunk_index % 2 = 1 THEN 'k' END AS data_key,
         {AS_OF} - to_days(CAST(job_id % 60 AS INTEGER)) AS updated_at
  FROM (SELECT job_id, chunk_index, CASE WHEN job_id % 5 = 0 THEN 'processing' ELSE st END AS status
        FROM ({CHUNKS}))"""

Q_RESUME = f"""
SELECT job_id, count(*) FILTER (WHERE status <> 'completed') AS requeued,
       count(*) FILTER (WHERE status <> 'completed' AND data_key IS NOT NULL) AS resent,
       count(*) FILTER (WHERE status = 'completed') AS already_completed
FROM ({CHUNK_TABLE}) GROUP BY job_id"""

Q_RETENTION = f"""
SELECT job_id, chunk_index FROM ({CHUNK_TABLE})
WHERE status = 'failed' AND data_key IS NOT NULL AND updated_at < {days_before(30)}"""

Q_TRANSITIONS = f"""
WITH li AS (SELECT l_orderkey, count(*) AS n, count(*) FILTER (WHERE l_linestatus = 'F') AS nf
            FROM lineitem GROUP BY 1),
j AS (SELECT o_orderkey, o_orderstatus, o_orderpriority, coalesce(li.n, 0) AS n, coalesce(li.nf, 0) AS nf
      FROM orders LEFT JOIN li ON l_orderkey = o_orderkey),
s AS (
  SELECT 'f/' || {_s('o_orderkey')} AS remote_path,
         CASE o_orderstatus WHEN 'F' THEN 'completed' WHEN 'O' THEN 'processing' ELSE 'downloading' END AS status,
         CASE WHEN o_orderstatus IN ('F', 'O') THEN n END AS total_chunks,
         CASE WHEN o_orderstatus = 'F' THEN n ELSE 0 END AS processed_chunks,
         CASE WHEN o_orderstatus = 'F' THEN {days_before(1)} END AS completed_at,
         CASE WHEN o_orderstatus IN ('O', 'P') THEN nf
              WHEN o_orderstatus = 'F' AND o_orderpriority = '2-HIGH' THEN 1 END AS done,
         CASE WHEN o_orderstatus = 'P' THEN n END AS r_total,
         CASE WHEN o_orderstatus = 'P' AND o_orderpriority = '1-URGENT' THEN 'unreachable' END AS err
  FROM j),
t AS (
  SELECT *, coalesce(r_total, total_chunks) AS tot, processed_chunks + coalesce(done, 0) AS proc,
         (done IS NOT NULL OR r_total IS NOT NULL OR err IS NOT NULL) AS touched
  FROM s),
u AS (
  SELECT *, CASE WHEN NOT touched THEN status
                 WHEN err IS NOT NULL THEN 'failed'
                 WHEN status = 'completed' THEN 'completed'
                 WHEN tot IS NOT NULL AND (tot = 0 OR proc = tot) THEN 'completed'
                 WHEN r_total IS NOT NULL THEN 'processing'
                 ELSE status END AS new_status
  FROM t)
SELECT remote_path, new_status AS status, CAST(proc AS BIGINT) AS processed_chunks,
       CAST(tot AS BIGINT) AS total_chunks,
       {ts(f"CASE WHEN status <> 'completed' AND new_status = 'completed' THEN {AS_OF} ELSE completed_at END")}
         AS completed_at,
       (status <> 'completed' AND new_status = 'completed') AS just_completed
FROM u"""

EXCERPT_BASE = f"""
WITH feed AS (
  SELECT {isbn('978', 'doc_id')} AS isbn13, 'Doc ' || {_s('doc_id')} AS title,
         'https://excerpts.example/' || {_s('doc_id')} AS url,
         CASE WHEN lang = 'de' THEN false
              ELSE coalesce(CASE WHEN n_chars % 3 = 0 THEN false WHEN n_chars % 3 = 1 THEN NULL ELSE true END, true)
         END AS available,
         CAST('2024-05-' || lpad({_s('doc_id % 28 + 1')}, 2, '0') || ' 10:00:00' AS TIMESTAMP) AS jb_updated_at
  FROM documents),
books AS (SELECT {isbn('978', 'doc_id')} AS isbn13 FROM labels WHERE quality = 1),
kept AS (SELECT * FROM feed WHERE isbn13 IN (SELECT isbn13 FROM books)),
skipped AS (SELECT * FROM feed WHERE isbn13 NOT IN (SELECT isbn13 FROM books)),
cur AS (SELECT {isbn('978', 'doc_id')} AS isbn13, 'old' AS title, CAST(NULL AS VARCHAR) AS url, true AS available,
               CAST(NULL AS TIMESTAMP) AS jb_updated_at, {days_before(20)} AS fetched_at,
               {days_before(60)} AS created_at
        FROM labels WHERE toxic = 1)"""

Q_EXCERPT_UPSERT = EXCERPT_BASE + f"""
SELECT coalesce(n.isbn13, o.isbn13) AS isbn13,
       CASE WHEN n.isbn13 IS NOT NULL THEN n.title ELSE o.title END AS title,
       CASE WHEN n.isbn13 IS NOT NULL THEN n.url ELSE o.url END AS url,
       CASE WHEN n.isbn13 IS NOT NULL THEN n.available ELSE o.available END AS available,
       {ts('CASE WHEN n.isbn13 IS NOT NULL THEN n.jb_updated_at ELSE o.jb_updated_at END')} AS jb_updated_at,
       {ts(f'CASE WHEN n.isbn13 IS NOT NULL THEN {AS_OF} ELSE o.fetched_at END')} AS fetched_at,
       {ts(f'CASE WHEN o.isbn13 IS NOT NULL THEN o.created_at ELSE {AS_OF} END')} AS created_at
FROM cur o FULL OUTER JOIN kept n ON o.isbn13 = n.isbn13"""

Q_EXCERPT_COUNTS = EXCERPT_BASE + """
SELECT outcome, count(*) AS count FROM (
  SELECT CASE WHEN available THEN 'upserted' ELSE 'withdrawn' END AS outcome FROM kept
  UNION ALL SELECT 'skipped' FROM skipped) GROUP BY outcome"""

Q_WATERMARK = f"""
SELECT event_type,
       {ts("greatest(max(ts), TIMESTAMP '2024-01-20 00:00:00' - INTERVAL 14 DAY)")} AS since,
       false AS full_load
FROM events GROUP BY event_type"""

COVER_BOOKS = f"""
  SELECT 'REF' || {_s('p_partkey')} AS record_reference, p_partkey AS k,
         CASE WHEN p_size % 7 = 0 THEN NULL ELSE {isbn('978', 'p_partkey')} END AS isbn13,
         concat_ws(' ', p_name, {_s('p_partkey')}) AS title,
         CASE WHEN p_size % 5 = 0 THEN 'https://cdn.example/old/' || {_s('p_partkey')} || '.jpg' END AS cover_url,
         CASE WHEN p_size % 3 = 0 THEN NULL WHEN p_size % 3 = 1 THEN {days_before(40)} ELSE {days_before(10)} END
           AS cover_checked_at,
         CASE WHEN p_partkey % 4 = 0 THEN NULL WHEN p_partkey % 4 = 1 THEN {days_before(45)} ELSE {days_before(5)} END
           AS cover_fetched_at
  FROM part"""

FALLBACK_WHERE = (f"cover_url IS NULL AND (isbn13 IS NULL OR cover_checked_at IS NOT NULL) "
                  f"AND (cover_fetched_at IS NULL OR cover_fetched_at < {days_before(30)})")

Q_AUTHORS = f"""
WITH b AS ({COVER_BOOKS}),
cand AS (SELECT * FROM b WHERE {FALLBACK_WHERE}),
con AS (SELECT DISTINCT l_partkey, l_suppkey FROM lineitem),
a AS (SELECT 'REF' || {_s('l_partkey')} AS record_reference,
             string_agg(s_name, ', ' ORDER BY l_suppkey, s_name) AS authors,
             arg_min(s_name, l_suppkey) AS first_author
      FROM con JOIN supplier ON l_suppkey = s_suppkey
      WHERE l_suppkey % 2 = 0 AND coalesce(s_name, '') <> '' GROUP BY l_partkey)
SELECT c.record_reference, a.authors,
       url_encode(CASE WHEN coalesce(c.isbn13, '') <> '' THEN 'isbn:' || c.isbn13
                       ELSE 'intitle:' || coalesce(c.title, '')
                            || CASE WHEN coalesce(a.first_author, '') <> '' THEN '+inauthor:' || a.first_author
                                    ELSE '' END END) AS query
FROM cand c LEFT JOIN a ON a.record_reference = c.record_reference"""

COVER_PASS = f"""
WITH b AS ({COVER_BOOKS}),
w AS (SELECT *, CASE k % 3 WHEN 0 THEN 'fetched' WHEN 1 THEN 'notFound' ELSE 'error' END AS outcome
      FROM b WHERE isbn13 IS NOT NULL AND (cover_checked_at IS NULL
            OR (cover_url IS NULL AND cover_checked_at < {days_before(30)}))),
aw AS (
  SELECT b.record_reference, b.k, b.isbn13,
         CASE WHEN w.outcome = 'fetched' THEN 'https://cdn.example/covers/' || b.isbn13 || '.jpg'
              ELSE b.cover_url END AS cover_url,
         CASE WHEN w.outcome IS NOT NULL THEN {AS_OF} ELSE b.cover_checked_at END AS cover_checked_at,
         b.cover_fetched_at
  FROM b LEFT JOIN w ON b.record_reference = w.record_reference),
f AS (SELECT *, CASE k % 4 WHEN 0 THEN 'fetched' WHEN 1 THEN 'notFound' ELSE 'error' END AS outcome,
             CASE WHEN k % 4 = 0 THEN 'https://cdn.example/covers/' || coalesce(isbn13, 'vol' || {_s('k')})
                  || '.jpg' END AS url
      FROM aw WHERE {FALLBACK_WHERE})"""

Q_COVERS = COVER_PASS + f"""
SELECT aw.record_reference,
       CASE WHEN f.outcome IN ('fetched', 'notFound') THEN f.url ELSE aw.cover_url END AS cover_url,
       {ts('aw.cover_checked_at')} AS cover_checked_at,
       {ts(f'CASE WHEN f.outcome IS NOT NULL THEN {AS_OF} ELSE aw.cover_fetched_at END')} AS cover_fetched_at
FROM aw LEFT JOIN f ON aw.record_reference = f.record_reference"""

Q_COVER_COUNTS = COVER_PASS + """
SELECT source, outcome, count(*) AS count FROM (
  SELECT 'wholesaler' AS source, outcome FROM w UNION ALL SELECT 'fallback', outcome FROM f)
GROUP BY source, outcome"""


def _set_param(src: str, key: str, value: str) -> str:
    keys = f"list_transform({src}, lambda p: split_part(p, '=', 1))"
    pos = f"list_position({keys}, '{key}')"
    kept = (f"list_filter(list_transform({src}, lambda p, i: CASE WHEN split_part(p, '=', 1) <> '{key}' THEN p "
            f"WHEN i = {pos} THEN '{key}={value}' END), lambda x: x IS NOT NULL)")
    return f"CASE WHEN {pos} IS NULL THEN list_append({src}, '{key}={value}') ELSE {kept} END"


Q_KEYS_URLS = f"""
WITH p AS (
  SELECT page_id, url,
         regexp_extract(url, '^[a-z]+://([^/?#:]+)', 1) AS host,
         regexp_extract(url, '^[a-z]+://[^/?#]+([^?#]*)', 1) AS path,
         regexp_extract(url, '\\?([^#]*)', 1) AS query,
         CASE WHEN contains(url, '#') THEN regexp_extract(url, '#(.*)$', 1) END AS ref,
         regexp_extract(url, '^[a-z]+://[^/]+(/[^?#]*)', 1) AS fname,
         {isbn('978', 'page_id')} AS isbn13
  FROM pages),
q0 AS (SELECT *, list_filter(string_split(query, '&'), lambda x: x <> '') AS p0 FROM p),
q1 AS (SELECT *, {_set_param('p0', 'zoom', '5')} AS p1 FROM q0),
q2 AS (SELECT *, {_set_param('p1', 'fife', 'w800')} AS p2 FROM q1),
q3 AS (SELECT *, list_filter(p2, lambda x: split_part(x, '=', 1) <> 'edge') AS p3,
              regexp_extract(fname, '([^/]*)$', 1) AS base FROM q2),
q4 AS (SELECT *, regexp_extract(base, '^.+(\\.[^.]*)$', 1) AS ext FROM q3)
SELECT page_id,
       'https://' || lower(host) || CASE WHEN path = '' THEN '/' ELSE path END || '?' || array_to_string(p3, '&')
         || CASE WHEN ref IS NOT NULL THEN '#' || ref ELSE '' END AS cover_url,
       nullif(regexp_extract(url || '&id=v' || {_s('page_id')}, '[?&]id=([^&]+)', 1), '') AS volume_id,
       regexp_replace(regexp_replace(lower(substr(base, 1, length(base) - length(ext))), '\\s+', '_', 'g'),
                      '[^a-z0-9_-]', '', 'g') || '_' || {_s('page_id')} || ext AS safe_name,
       {_s('page_id % 53')} AS week,
       'https://cdn.example/covers/' || isbn13 || '.jpg' AS public_url,
       '/Books/Full/' || substr(isbn13, 1, 8) || '/' || isbn13 || '.jpg' AS remote_path,
       CASE WHEN contains(url, '.html') THEN 'png' ELSE 'jpg' END AS image_ext
FROM q4"""

Q_ARCHIVE_INDEX = f"""
SELECT {isbn('978', 'p_partkey')} AS isbn13,
       'BookImages_wk' || {_s('p_partkey % (SELECT greatest(4, CAST(ceil(count(*) / 20000) AS BIGINT)) FROM part) + 1')}
         || '.zip' AS archive,
       CAST(p_size AS BIGINT) AS size
FROM part"""


Q_REPLAY_GUARD = """
SELECT DISTINCT l_orderkey * 10 + l_linenumber AS batch_id FROM lineitem
WHERE l_orderkey NOT IN (SELECT o_orderkey FROM orders WHERE o_orderstatus = 'F')"""


Q_RESUME_CHUNKS = f"""
SELECT job_id, chunk_index,
       CASE WHEN status <> 'completed' AND data_key IS NOT NULL THEN 'pending' ELSE status END AS status,
       CASE WHEN status <> 'completed' AND data_key IS NOT NULL THEN NULL ELSE 'err' END AS error_message
FROM ({CHUNK_TABLE})"""


def oracles() -> dict[str, str]:
    return {
        "resume_chunks": Q_RESUME_CHUNKS,
        "replay_guard": Q_REPLAY_GUARD,
        "unclaimed_files": Q_UNCLAIMED,
        "ledger_claim": Q_CLAIM,
        "unprocessed_files": Q_UNPROCESSED,
        "trigger_guard": Q_TRIGGER_GUARD,
        "job_progress": Q_JOB_PROGRESS,
        "job_detail": Q_JOB_DETAIL,
        "job_page": Q_JOB_PAGE,
        "latest_full_file": Q_LATEST_FULL,
        "resume_plan": Q_RESUME,
        "retention_plan": Q_RETENTION,
        "ledger_transitions": Q_TRANSITIONS,
        "excerpt_upsert": Q_EXCERPT_UPSERT,
        "excerpt_counts": Q_EXCERPT_COUNTS,
        "excerpt_watermark": Q_WATERMARK,
        "authors_lookup_text": Q_AUTHORS,
        "cover_candidates": Q_COVERS,
        "cover_outcome_counts": Q_COVER_COUNTS,
        "keys_and_urls": Q_KEYS_URLS,
        "cover_archive_index": Q_ARCHIVE_INDEX,
    }
