"""SQL oracles of the three ingest runs and of moving ISBNs (DuckDB dialect)."""

from __future__ import annotations

from quire.plans.oracle import AS_OF, BOOKS_CUR, _s, isbn, ts
from quire.plans.oracle_catalog import slug

# What became of each part: long and broken in run 1, changed in run 2 (a: no subjects, b: another one).
_PARTS = f"""
WITH p AS (
  SELECT *, p_partkey AS k, 'REF' || {_s('p_partkey')} AS ref, p_partkey % 40 = 11 AS broken, p_partkey % 50 = 7 AS long,
         p_partkey % 3 = 0 AS a, p_partkey % 3 = 1 AND p_partkey % 5 = 0 AS b
  FROM part),
q AS (SELECT *, NOT broken AND NOT long AS good, a OR b AS two, (NOT broken AND NOT long) OR a OR b AS held FROM p)"""


def _row(table: str, key: str, value: list[str], rest: str) -> str:
    text = " || '|' || ".join(f"coalesce({_s(v)}, '-')" for v in value)
    return f"SELECT '{table}' AS table_name, {key} AS key, {text} AS value {rest}"


def _run(n: str) -> str:
    return f"('2024-06-0' || {_s(n)} || ' 00:00:00')"


_REMOVED = "(k % 12 = 0 OR k % 7 = 0)"
_PAIRS = f"""(
  SELECT ref, {slug('p_type')} AS slug, p_type AS name FROM q WHERE good AND NOT b AND p_type <> ''
  UNION SELECT ref, {slug('p_name')}, p_name FROM q WHERE good AND NOT b AND k % 3 = 0 AND p_name <> ''
  UNION SELECT ref, 'other_genre', 'Other genre' FROM q WHERE b)"""
_GENRES = f"""(
  SELECT {slug('p_type')} AS slug, p_type AS name FROM q WHERE good AND p_type <> ''
  UNION SELECT {slug('p_name')}, p_name FROM q WHERE good AND k % 3 = 0 AND p_name <> ''
  UNION SELECT 'other_genre', 'Other genre' FROM q WHERE b)"""

Q_INGEST_TABLES = _PARTS + " " + " UNION ALL ".join([
    _row("books", "ref", [
        f"CASE WHEN k % 6 = 0 THEN {isbn('979', 'k')} ELSE {isbn('978', 'k')} END",
        f"CASE WHEN two THEN concat_ws(' ', p_name, '2nd', {_s('k')}) ELSE concat_ws(' ', p_name, {_s('k')}) END",
        _REMOVED, f"CASE WHEN {_REMOVED} THEN {_run('3')} END", _run("CASE WHEN good THEN 1 ELSE 2 END"),
        _run("CASE WHEN two THEN 2 ELSE 1 END")], "FROM q WHERE held"),
    _row("book_contributors", "ref || '|0'", ["'1'", "'A01'", "CASE WHEN two THEN 'Second ' ELSE 'Author ' END || p_brand"], "FROM q WHERE held"),
    _row("book_contributors", "ref || '|1'", ["'2'", "'B01'", "p_type"], "FROM q WHERE two"),
    _row("book_subjects", "ref || '|0'", ["'93'", "upper(substr(p_type, 1, 3))", "p_type"], "FROM q WHERE good AND NOT two"),
    _row("book_subjects", "ref || '|1'", ["'10'", "'B'", "p_brand"], "FROM q WHERE good AND NOT two"),
    _row("book_subjects", "ref || '|0'", ["'93'", "'OG'", "'Other genre'"], "FROM q WHERE b"),
    _row("book_prices", "ref || '|0'", ["'02'", f"{_s('p_size')} || '.50'", "'GBP'", "'S'", "'20.00'"], "FROM q WHERE good AND NOT two"),
    _row("book_prices", "ref || '|1'", ["'02'", f"{_s('p_size')} || '.00'", "'GBP'", "NULL", "NULL"], "FROM q WHERE good AND NOT two AND k % 2 = 0"),
    _row("book_prices", "ref || '|0'", ["'02'", "'9.99'", "'GBP'", "'S'", f"{_s('p_size % 10')} || '.00'"], "FROM q WHERE two"),
    _row("genres", "slug", ["name"], f"FROM (SELECT slug, min(name) AS name FROM {_GENRES} GROUP BY slug)"),
    _row("book_genres", "ref", ["slug"], f"FROM (SELECT DISTINCT ref, slug FROM {_PAIRS})"),
    _row("rejects", "'run1|' || ref", ["'too_long_title'"], "FROM q WHERE long AND NOT broken"),
    _row("rejects", "'run1|' || ref", ["'malformed'"], "FROM q WHERE false"),
    _row("summaries", "'run1'", ["count(*) FILTER (WHERE good)", "count(*) FILTER (WHERE long AND NOT broken)", "count(*) FILTER (WHERE broken)"], "FROM q"),
    _row("summaries", "'run2'", ["count(*) FILTER (WHERE two)", "0", "0"], "FROM q"),
    _row("summaries", "'run3'", ["count(*) FILTER (WHERE k % 6 = 0) + count(*) FILTER (WHERE k % 12 = 0) + count(*) FILTER (WHERE k % 7 = 0)", "0", "0"], "FROM q"),
])

# Tenure of every ISBN, from one notice of a book to its next; deletes fall into tenures.
Q_ISBN_MOVES = f"""
WITH cur AS ({BOOKS_CUR}),
n AS (
  SELECT 'REF' || {_s('l_partkey')} AS ref, l_returnflag = 'R' AS gone,
         CASE WHEN l_linenumber = 2 THEN {isbn('978', 'l_partkey + 1')} WHEN l_linenumber <> 3 THEN {isbn('978', 'l_partkey')} END AS isbn,
         row_number() OVER (ORDER BY l_shipdate, l_orderkey, l_linenumber, l_partkey, l_suppkey, l_quantity, l_extendedprice,
                            l_discount, l_tax, l_returnflag, l_linestatus) AS seq
  FROM lineitem JOIN part ON l_partkey = p_partkey),
held AS (
  SELECT record_reference AS ref, isbn13 AS isbn, 0 AS seq FROM cur
  UNION ALL SELECT ref, isbn, seq FROM n WHERE NOT gone),
tenure AS (SELECT *, lead(seq) OVER (PARTITION BY ref ORDER BY seq) AS until FROM held),
hits AS (
  SELECT t.ref, d.seq FROM n d JOIN tenure t ON d.gone AND d.isbn = t.isbn AND d.seq > t.seq AND (t.until IS NULL OR d.seq < t.until)
  UNION ALL SELECT ref, seq FROM n WHERE gone AND isbn IS NULL),
last AS (SELECT * FROM tenure WHERE until IS NULL),
hit AS (SELECT ref, max(seq) AS seq FROM hits GROUP BY ref)
SELECT l.ref AS record_reference, l.isbn AS isbn13, coalesce(h.seq > l.seq, false) AS is_removed,
       {ts(f'CASE WHEN h.seq > l.seq THEN {AS_OF} END')} AS removed_at
FROM last l LEFT JOIN hit h ON h.ref = l.ref"""


def oracles() -> dict[str, str]:
    return {"ingest_tables": Q_INGEST_TABLES, "isbn_moves": Q_ISBN_MOVES}
