"""Set-based merges (O-39, O-54 … O-56, O-61 … O-72).

Every merge is a pure function ``(current, incoming, …) -> current'``; the
caller writes the result as a new snapshot (``quire.sources.store``). All
joins are equi-joins on the table key, so a table bucketed on its key only
shuffles the incoming side. Aggregates used for de-duplication are
``max_by``/``min_by``. Spark sorts the (wide) incoming rows for them, so rows are
first dealt to tasks by key and one of SALTS parts (``_dealt``): the sorts follow the
shuffle's partitions, not the input's splits, and a key holding a third of all rows
is reduced in SALTS tasks before its parts meet.
"""

from __future__ import annotations

from collections.abc import Callable, Mapping, Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from quire.functions.scalars import slugify

Keys = Sequence[str]
SALTS = 8       # tasks that share the rows of one key


def _keys(keys) -> list[str]:
    return [keys] if isinstance(keys, str) else list(keys)


def _dealt(df: DataFrame, keys: Keys, order: Column) -> DataFrame:
    """``df`` with ``__salt``, dealt to tasks by the keys and it."""
    return df.withColumn("__salt", F.pmod(F.xxhash64(order), F.lit(SALTS))).repartition(*keys, "__salt")


def last_wins(df: DataFrame, keys, order) -> DataFrame:
    """O-54: one row per key, the one with the greatest ``order`` (file order)."""
    keys = _keys(keys)
    order_col = F.col(order) if isinstance(order, str) else order
    rest = [c for c in df.columns if c not in keys]
    if not rest:
        return df.dropDuplicates(keys)
    packed = F.struct(*[F.col(c) for c in rest])
    parts = _dealt(df, keys, order_col).groupBy(*keys, "__salt").agg(
        F.max_by(packed, order_col).alias("__row"), F.max(order_col).alias("__at"))
    return (parts.groupBy(*keys).agg(F.max_by("__row", "__at").alias("__row"))
            .select(*keys, "__row.*"))


def first_wins(df: DataFrame, keys, order) -> DataFrame:
    """O-55: one row per key, the one with the smallest ``order``."""
    keys = _keys(keys)
    order_col = F.col(order) if isinstance(order, str) else order
    rest = [c for c in df.columns if c not in keys]
    packed = F.struct(*[F.col(c) for c in rest])
    return (df.groupBy(*keys).agg(F.min_by(packed, order_col).alias("__row"))
            .select(*keys, "__row.*"))


class _Side:
    def __init__(self, alias: str):
        self.alias = alias

    def __call__(self, name: str) -> Column:
        return F.col(f"{self.alias}.{name}")


def upsert(current: DataFrame, incoming: DataFrame, keys, order=None, keep: Keys = (),
           on_update: Mapping[str, Callable[[_Side, _Side], Column]] | None = None,
           on_insert: Mapping[str, Column] | None = None) -> DataFrame:
    """Keyed upsert (O-62, O-70, O-72, O-73): incoming rows replace current rows.

    * ``order``: when given, incoming is first reduced to its last row per key.
    * ``keep``: columns a matched row keeps from the current row.
    * ``on_update``: ``col -> f(old, new)`` for matched rows.
    * ``on_insert``: ``col -> Column`` for rows new to the table (default: the
      incoming value, or null).

    With nothing kept the merge is an anti-join plus union; otherwise a full
    outer join on the key.
    """
    keys = _keys(keys)
    inc = last_wins(incoming, keys, order) if order is not None else incoming
    on_update = dict(on_update or {})
    on_insert = dict(on_insert or {})
    out_cols = list(current.columns) + [c for c in inc.columns if c not in current.columns]
    if not keep and not on_update and not on_insert:
        untouched = current.join(inc.select(*keys), keys, "left_anti")
        return untouched.unionByName(inc, allowMissingColumns=True).select(*out_cols)

    O, N = _Side("o"), _Side("n")
    o = current.withColumn("__old", F.lit(True)).alias("o")
    n = inc.withColumn("__new", F.lit(True)).alias("n")
    j = o.join(n, [F.col(f"o.{k}") == F.col(f"n.{k}") for k in keys], "full_outer")
    has_old, has_new = O("__old").isNotNull(), N("__new").isNotNull()
    cols = []
    for c in out_cols:
        if c in keys:
            cols.append(F.coalesce(N(c), O(c)).alias(c))
            continue
        new_v = N(c) if c in inc.columns else F.lit(None)
        old_v = O(c) if c in current.columns else F.lit(None)
        ins_v = on_insert.get(c, new_v)
        if c in on_update:
            upd_v = on_update[c](O, N)
        elif c in keep:
            upd_v = old_v
        else:
            upd_v = new_v
        cols.append(F.when(has_old & has_new, upd_v).when(has_new, ins_v).otherwise(old_v).alias(c))
    return j.select(*cols)


def upsert_books(books: DataFrame, products: DataFrame, as_of, order: str = "arrival") -> DataFrame:
    """O-62 + O-63 + O-65: book upsert by ``record_reference``.

    All product fields replace the stored ones; the book is active again;
    ``created_at`` and cover/embedding columns are kept; ``embedded_at`` is
    cleared when the title changed or the long description differs.
    """
    from quire.schemas import BOOK_FIELDS

    ts = F.lit(as_of).cast("timestamp") if not isinstance(as_of, Column) else as_of
    inc = products.select(*BOOK_FIELDS, order)
    inc = last_wins(inc, "record_reference", order).drop(order)
    inc = inc.withColumns({"is_removed": F.lit(False), "removed_at": F.lit(None).cast("timestamp"),
                           "updated_at": ts})
    keep = [c for c in books.columns if c not in inc.columns and c != "embedded_at"]

    def embedded(o, n):
        changed = (n("title") != o("title")) | ~n("long_description").eqNullSafe(o("long_description"))
        return F.when(F.coalesce(changed, F.lit(False)), F.lit(None)).otherwise(o("embedded_at"))

    return upsert(books, inc, "record_reference", keep=keep,
                  on_update={"embedded_at": embedded},
                  on_insert={"created_at": ts, "embedded_at": F.lit(None).cast("timestamp")})


def soft_delete(books: DataFrame, notices: DataFrame, as_of, order: str = "arrival",
                primary: str = "isbn13", fallback: str = "record_reference") -> DataFrame:
    """O-64: mark books removed by delete notices (``notification_type='05'``).

    A notice targets the book holding its ISBN, or, without an ISBN, the book
    with its record reference; unmatched notices insert nothing and
    ``updated_at`` is untouched. Notices of other types are reactivations:
    whichever notice of a book comes last in file order decides its state.
    """
    ts = F.lit(as_of).cast("timestamp") if not isinstance(as_of, Column) else as_of
    n = notices.select(fallback, primary, "notification_type", order)
    dels = n.where(F.col("notification_type") == "05")
    by_primary = (dels.where(F.col(primary).isNotNull()).groupBy(primary)
                  .agg(F.max(order).alias("del_at"))
                  .join(books.select(fallback, primary).where(F.col(primary).isNotNull()), primary)
                  .select(fallback, "del_at"))
    by_fallback = (dels.where(F.col(primary).isNull()).groupBy(fallback)
                   .agg(F.max(order).alias("del_at")))
    last_del = by_primary.unionByName(by_fallback).groupBy(fallback).agg(F.max("del_at").alias("del_at"))
    last_up = (n.where(F.col("notification_type") != "05").groupBy(fallback)
               .agg(F.max(order).alias("up_at")))
    state = last_del.join(last_up, fallback, "left")
    removed = F.col("s.del_at").isNotNull() & (F.col("s.up_at").isNull() | (F.col("s.del_at") > F.col("s.up_at")))
    j = books.alias("b").join(state.alias("s"), fallback, "left")
    cols = []
    for c in books.columns:
        if c == "is_removed":
            cols.append(F.when(removed, F.lit(True)).otherwise(F.col("b.is_removed")).alias(c))
        elif c == "removed_at":
            cols.append(F.when(removed, ts).otherwise(F.col("b.removed_at")).alias(c))
        elif c == fallback:
            cols.append(F.col(fallback))
        else:
            cols.append(F.col(f"b.{c}"))
    return j.select(*cols)


def apply_notices(books: DataFrame, products: DataFrame, as_of, order: str = "arrival",
                  primary: str = "isbn13", fallback: str = "record_reference") -> DataFrame:
    """Merge one run of ONIX notices (O-62 … O-65) in one pass.

    Upserts replace a book's fields (last notice per reference wins); delete
    notices (``05``) remove the book holding their ISBN at their place in the run, or
    their reference when they carry no ISBN; whichever notice of a book comes last
    decides its state. Unmatched deletes insert nothing.

    Plan: the notices are read once and reduced to one row per (kind, key), in
    SALTS parts first, so a hot key is shared; delete-by-ISBN keys
    are mapped to references through a size-checked broadcast; the catalogue
    is joined once (full outer join on the reference).
    """
    from quire.schemas import BOOK_FIELDS
    from quire.session import bounded_broadcast, cut_lineage

    ts = F.lit(as_of).cast("timestamp") if not isinstance(as_of, Column) else as_of
    is_del = F.col("notification_type") == "05"
    by_isbn = is_del & F.col(primary).isNotNull()
    t = products.select(
        F.when(by_isbn, F.lit("i")).otherwise(F.lit("r")).alias("__kind"),
        F.when(by_isbn, F.col(primary)).otherwise(F.col(fallback)).alias("__k"),
        is_del.alias("__del"), F.col(order).alias("__at"),
        F.struct(*[F.col(c) for c in BOOK_FIELDS if c != fallback]).alias("__p"))
    parts = _dealt(t, ["__kind", "__k"], F.col("__at")).groupBy("__kind", "__k", "__salt").agg(
        F.max_by("__p", F.when(~F.col("__del"), F.col("__at"))).alias("__p"),
        F.max(F.when(~F.col("__del"), F.col("__at"))).alias("__up"),
        F.max(F.when(F.col("__del"), F.col("__at"))).alias("__dl"))
    agg = parts.groupBy("__kind", "__k").agg(
        F.max_by("__p", "__up").alias("__p"), F.max("__up").alias("__up"), F.max("__dl").alias("__dl"))
    # the reduced run (one row per key) is read by three branches and a size
    # check: cut the lineage once (reliable checkpoint in the shared folder) so
    # the feed is parsed once, not per branch
    agg = cut_lineage(agg)
    refs = agg.where(F.col("__kind") == "r").select(F.col("__k").alias(fallback), "__p", "__up", "__dl")
    isbn_dels = bounded_broadcast(agg.where(F.col("__kind") == "i").select(F.col("__k").alias(primary),
                                                                           F.col("__dl").alias("__dli")))
    # A delete counts only after the book's last upsert (which undoes earlier ones), so a book is
    # found by the ISBN that it holds from then on: that of its last upsert in the run, else the stored one.
    moved = refs.where(F.col("__p").isNotNull())
    stored = books.select(fallback, primary).join(isbn_dels, primary).select(fallback, "__dli").join(moved, fallback, "left_anti")
    held = moved.select(fallback, F.col(f"__p.{primary}").alias(primary)).join(isbn_dels, primary).select(fallback, "__dli")
    via_isbn = stored.unionByName(held).groupBy(fallback).agg(F.max("__dli").alias("__dli"))
    inc = refs.join(via_isbn, fallback, "full")
    dl = F.greatest(F.col("n.__dl"), F.col("n.__dli"))

    o = books.withColumn("__old", F.lit(True)).alias("o")
    j = o.join(inc.alias("n"), F.col(f"o.{fallback}") == F.col(f"n.{fallback}"), "full_outer")
    has_old = F.col("o.__old").isNotNull()
    has_new = F.col("n.__p").isNotNull()
    removed = dl.isNotNull() & (F.col("n.__up").isNull() | (dl > F.col("n.__up")))
    changed = (F.col("n.__p.title") != F.col("o.title")) | \
        ~F.col("n.__p.long_description").eqNullSafe(F.col("o.long_description"))
    cols = []
    for c in books.columns:
        if c == fallback:
            cols.append(F.coalesce(F.col(f"o.{c}"), F.col(f"n.{c}")).alias(c))
        elif c in BOOK_FIELDS:
            cols.append(F.when(has_new, F.col(f"n.__p.{c}")).otherwise(F.col(f"o.{c}")).alias(c))
        elif c == "is_removed":
            cols.append(F.when(removed, F.lit(True)).when(has_new, F.lit(False)).otherwise(F.col(f"o.{c}")).alias(c))
        elif c == "removed_at":
            cols.append(F.when(removed, ts).when(has_new, F.lit(None)).otherwise(F.col(f"o.{c}")).alias(c))
        elif c == "updated_at":
            cols.append(F.when(has_new, ts).otherwise(F.col(f"o.{c}")).alias(c))
        elif c == "created_at":
            cols.append(F.when(has_old, F.col(f"o.{c}")).otherwise(ts).alias(c))
        elif c == "embedded_at":
            cols.append(F.when(has_new & ~has_old, F.lit(None))
                        .when(has_new & F.coalesce(changed, F.lit(False)), F.lit(None))
                        .otherwise(F.col(f"o.{c}")).alias(c))
        else:
            cols.append(F.col(f"o.{c}").alias(c))
    return j.where(has_old | has_new).select(*cols)


def gated_merge(current: DataFrame, incoming: DataFrame, key: str = "isbn13",
                ts: str = "stock_updated_at", arrival: str = "arrival",
                always: Keys = ("stock_qty", "source", "source_file_key"),
                gated: Keys = ("rrp_gbp", "discount_percent", "report_code", "report_date"),
                source: str = "source", gated_source: str = "inventory", gate: str = "row",
                bucket_width: int = 1 << 20, as_of=None) -> DataFrame:
    """O-61 / O-99 / O-100: freshness-gated merge of two feeds into one row per key.

    Fold semantics, applied in ``arrival`` order (non-negative longs; the
    current row comes first): the first row of a key goes in whole; a later
    row *passes* when its ``ts`` is at least the greatest ``ts`` seen before it.
    ``always`` columns follow the last passing row; ``gated`` columns the last
    passing row from ``gated_source`` (``gate="row"``, the source system's rule)
    or the freshest such row (``gate="group"``); ``ts`` becomes the greatest.

    The "greatest before" is a prefix maximum computed in two levels so a hot
    key never lands in one task: maxima per (key, arrival bucket), a window
    over the few buckets of a key, then a window inside each bucket.
    """
    always, gated = list(always), list(gated)
    fields = always + [c for c in gated if c not in always]
    extra = [c for c in current.columns if c not in fields and c not in (key, ts)]
    # columns only the current table has (created_at, book_id, ...) ride along
    # in one struct, so the big current table is read once and never re-joined
    x = F.struct(*[F.col(c) for c in extra]) if extra else F.lit(None)
    cur = current.select(key, ts, *fields, F.lit(-1).cast("long").alias(arrival), x.alias("__x"))
    inc = incoming.select(key, ts, *fields, F.col(arrival).cast("long").alias(arrival),
                          F.lit(None).cast(cur.schema["__x"].dataType).alias("__x"))
    rows = cur.withColumn("__cur", F.lit(True)).unionByName(inc.withColumn("__cur", F.lit(False)))
    rows = rows.withColumn("__b", F.floor(F.col(arrival) / F.lit(bucket_width)))

    is_src = F.coalesce(F.col(source) == gated_source, F.lit(False))
    # Level 1: one row per (key, bucket) — few rows per key even for a hot key.
    bagg = rows.groupBy(key, "__b").agg(F.max(ts).alias("__bmax"), F.min(arrival).alias("__bmin"))
    wk = Window.partitionBy(key)
    bagg = bagg.withColumn("__base", F.min("__bmin").over(wk))
    if gate == "row":
        wb = wk.orderBy("__b").rowsBetween(Window.unboundedPreceding, -1)
        bagg = bagg.withColumn("__prior", F.max("__bmax").over(wb))
    rows = rows.join(bagg.drop("__bmax", "__bmin"), [key, "__b"])
    first = F.col(arrival) == F.col("__base")
    rows = rows.withColumn("__first", first)
    if gate == "row":
        # Level 2: running maximum inside one bucket (at most bucket_width rows).
        wi = Window.partitionBy(key, "__b").orderBy(arrival).rowsBetween(Window.unboundedPreceding, -1)
        before = F.greatest(F.col("__prior"), F.max(ts).over(wi))
        rows = rows.withColumn("__pass", F.col("__first") | F.coalesce(F.col(ts) >= before, F.lit(False)))
        price_ok = F.col("__pass") & (F.col("__first") | is_src)
        price_order = F.col(arrival)
    else:
        rows = rows.withColumn("__pass", F.lit(True))
        price_ok = F.col("__first") | is_src
        price_order = F.struct(F.col(ts), F.col(arrival))

    qty_order = F.when(F.col("__pass"), F.col(arrival)) if gate == "row" else F.struct(F.col(ts), F.col(arrival))
    aggs = [F.max_by(F.struct(*[F.col(c) for c in always]), qty_order).alias("__a"),
            F.max_by(F.struct(*[F.col(c) for c in gated]), F.when(price_ok, price_order)).alias("__g"),
            F.max(ts).alias(ts)]
    if extra:
        aggs.append(F.max_by("__x", F.when(F.col("__cur"), F.lit(1))).alias("__x"))
    out = rows.groupBy(key).agg(*aggs)
    sel = [key, *[F.col(f"__a.{c}").alias(c) for c in always],
           *[F.col(f"__g.{c}").alias(c) for c in gated if c not in always], ts]
    return out.select(*sel, *[F.col(f"__x.{c}").alias(c) for c in extra])


def replace_children(child: DataFrame, touched: DataFrame, new: DataFrame, key) -> DataFrame:
    """O-66 / O-69: every touched parent loses all its children and gets the new
    ones (an empty list clears)."""
    keys = _keys(key)
    kept = child.join(touched.select(*keys).distinct(), keys, "left_anti")
    return kept.unionByName(new.select(*child.columns))


def insert_absent(current: DataFrame, new: DataFrame, keys) -> DataFrame:
    """O-68: insert rows whose key is absent; an existing key keeps its row."""
    keys = _keys(keys)
    return current.unionByName(new.join(current.select(*keys), keys, "left_anti").select(*current.columns))


def sweep(current: DataFrame, synced_at: str, cutoff) -> DataFrame:
    """O-71: mark-and-sweep — drop rows not re-synced by the full file."""
    cut = F.lit(cutoff).cast("timestamp") if not isinstance(cutoff, Column) else cutoff
    return current.where(F.col(synced_at) >= cut)


def derive_genres(subjects: DataFrame, book_key: str = "record_reference",
                  order: str = "pos") -> tuple[DataFrame, DataFrame]:
    """O-67 / O-55 / O-56: genres from scheme-93 subjects.

    ``subjects`` is flat: ``book_key``, ``order``, ``scheme_identifier``,
    ``subject_code``, ``subject_heading_text``. A subject counts when heading or
    code is non-empty; its name is the heading unless that is null (an empty
    heading gives an empty slug, so the subject is dropped). Returns
    ``(genres, pairs)``: first occurrence per slug, and distinct (book, slug).
    """
    s = subjects.where((F.col("scheme_identifier") == "93") & (
        (F.coalesce(F.col("subject_heading_text"), F.lit("")) != "")
        | (F.coalesce(F.col("subject_code"), F.lit("")) != "")))
    name = F.coalesce(F.col("subject_heading_text"), F.col("subject_code"), F.lit(""))
    s = s.select(book_key, order, name.alias("name"), slugify(name).alias("slug"),
                 "subject_code", "scheme_identifier").where(F.col("slug") != "")
    genres = first_wins(s.select("slug", "name", "subject_code", "scheme_identifier", order), "slug",
                        order).drop(order)
    pairs = s.select(book_key, "slug").dropDuplicates()
    return genres, pairs


def link_ids(rows: DataFrame, books: DataFrame, on: str = "isbn13", id_col: str = "book_id",
             book_id: str = "id", touched: DataFrame | None = None) -> DataFrame:
    """O-39: fill ``book_id`` of unlinked rows from the book with the same ISBN,
    only for ISBNs of this run (``touched``) when given."""
    b = books.select(F.col(on).alias("__k"), F.col(book_id).alias("__id")).where(F.col("__k").isNotNull())
    if touched is not None:
        b = b.join(touched.select(F.col(on).alias("__k")).distinct(), "__k", "left_semi")
    j = rows.join(b, rows[on] == F.col("__k"), "left")
    return j.select(*[F.coalesce(F.col(id_col), F.col("__id")).alias(c) if c == id_col else F.col(c)
                      for c in rows.columns])


def lookup_ids(rows: DataFrame, books: DataFrame, on: str = "record_reference",
               book_id: str = "id") -> DataFrame:
    """O-45: attach the book id by natural key (inner equi-join)."""
    return rows.join(books.select(on, F.col(book_id).alias("book_id")), on)


def arrival_ordinal(df: DataFrame, order: str, name: str | None = None) -> DataFrame:
    """Replace the orderable ``order`` column (e.g. a file-order struct) by a long
    that increases in that order: a distributed range sort, then
    ``monotonically_increasing_id`` (partition index, then row) on the sorted
    partitions. No single-partition window.

    The numbered rows are checkpointed (shared folder): the bounds of a range sort
    are sampled, so numbering the rows anew for each use of the frame would give
    one row different numbers."""
    from quire.session import cut_lineage

    name = name or order
    return cut_lineage(df.orderBy(order).withColumn("__ord", F.monotonically_increasing_id())
                       .drop(order).withColumnRenamed("__ord", name))
