"""O-74: bad-record isolation without a slow path.

Each rule is a column predicate that is true for a bad row; a row carries the
names of all rules it breaks, and the batch splits into good and rejected rows
in one pass. Nothing falls back to row-by-row processing.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from quire.functions.scalars import valid_isbn13
from quire.schemas import BOOK_LENGTHS
from quire.session import bounded_broadcast


def quarantine(rows: DataFrame, rules: Sequence[tuple[str, Column]]) -> tuple[DataFrame, DataFrame]:
    """``(good, rejected)``; ``rejected`` has a ``reasons`` array (rule order)."""
    tagged = judged(rows, rules)
    return (tagged.where(F.size("reasons") == 0).drop("reasons"),
            tagged.where(F.size("reasons") > 0))


def judged(rows: DataFrame, rules: Sequence[tuple[str, Column]]) -> DataFrame:
    """All ``rows`` with their ``reasons`` (empty: a good row), for jobs that read both kinds."""
    reasons = F.filter(F.array(*[F.when(F.coalesce(bad, F.lit(False)), F.lit(name)) for name, bad in rules]),
                       lambda x: x.isNotNull())
    return rows.withColumn("reasons", reasons)


def isbn_holders(rows: DataFrame, books: DataFrame, order: str = "arrival",
                 key: str = "record_reference", isbn: str = "isbn13") -> DataFrame:
    """Of each ISBN of a run the reference allowed to hold it: the catalogue's current
    holder, else the first row of the run carrying it (second unique key).

    Only the run's ISBNs are looked up, so the catalogue is read in two columns and
    reduced to them before anything of it is shuffled. A bad value that many rows share
    is one row here; their join with it is split by AQE's skew rule, or broadcast."""
    first = rows.where(F.col(isbn).isNotNull()).groupBy(isbn).agg(F.min_by(key, order).alias("__first"))
    cur = books.select(isbn, F.col(key).alias("__cur")).join(bounded_broadcast(first.select(isbn)), isbn, "left_semi")
    return first.join(cur, isbn, "left").select(isbn, F.coalesce("__cur", "__first").alias("__holder"))


def book_rules(raw_page: str | None = "page_raw", raw_date: str | None = "date_raw",
               holder: str | None = "__holder") -> list[tuple[str, Column]]:
    """The catalogue's constraints as rules: not-null keys, column lengths,
    ISBN format, failed number/date parses, ISBN held by another reference."""
    c = F.col
    rules = [
        ("missing_reference", F.coalesce(c("record_reference"), F.lit("")) == ""),
        ("missing_title", (F.coalesce(c("title"), F.lit("")) == "") & (c("notification_type") != "05")),
        ("bad_isbn", c("isbn13").isNotNull() & ~valid_isbn13(c("isbn13"))),
    ]
    for col_name, n in BOOK_LENGTHS.items():
        if col_name == "isbn13":
            continue
        rules.append((f"too_long_{col_name}", F.length(c(col_name)) > n))
    if raw_page:
        rules.append(("bad_page_count", c(raw_page).isNotNull() & c("page_count").isNull()))
    if raw_date:
        rules.append(("bad_publication_date", c(raw_date).isNotNull() & c("publication_date").isNull()))
    if holder:
        rules.append(("isbn_taken", c(holder).isNotNull() & (c(holder) != c("record_reference"))))
    return rules


def enum_rule(column: str, allowed) -> tuple[str, Column]:
    """A status outside its enumeration (the catalogue's enum types) is rejected."""
    return (f"bad_{column}", F.col(column).isNotNull() & ~F.col(column).isin(*allowed))


def ledger_rules(kind: str) -> list[tuple[str, Column]]:
    """Allowed statuses of job, chunk and file-ledger rows."""
    from quire.schemas import CHUNK_STATUSES, FEED_NAMES, FETCH_STATUSES, JOB_STATUSES
    allowed = {"job": JOB_STATUSES, "chunk": CHUNK_STATUSES, "fetch": FETCH_STATUSES}[kind]
    rules = [enum_rule("status", allowed)]
    return rules + [enum_rule("feed", FEED_NAMES)] if kind == "fetch" else rules
