"""Merges: gated stock merge against a row-by-row fold, upsert idempotence,
soft delete / reactivation order, child replace, genres, sweep."""

import datetime as dt
import random

from pyspark.sql import functions as F

from quire.operators import merge

T0 = dt.datetime(2024, 1, 1)
STOCK = "isbn13 string, stock_updated_at timestamp, stock_qty int, source string, source_file_key string, " \
        "rrp_gbp double, discount_percent double, report_code string, report_date date"


def fold(current, incoming):
    """The source system's per-row statement, applied in arrival order."""
    table = {r[0]: dict(zip(["isbn13", "ts", "qty", "source", "fkey", "rrp", "disc", "code", "date"], r))
             for r in current}
    for r in sorted(incoming, key=lambda x: x[-1]):
        new = dict(zip(["isbn13", "ts", "qty", "source", "fkey", "rrp", "disc", "code", "date"], r[:-1]))
        old = table.get(new["isbn13"])
        if old is None:
            table[new["isbn13"]] = new
            continue
        fresh = new["ts"] >= old["ts"]
        out = dict(old)
        if fresh:
            out.update(qty=new["qty"], source=new["source"], fkey=new["fkey"])
            if new["source"] == "inventory":
                out.update(rrp=new["rrp"], disc=new["disc"], code=new["code"], date=new["date"])
        out["ts"] = max(old["ts"], new["ts"])
        table[new["isbn13"]] = out
    return {k: (v["ts"], v["qty"], v["source"], v["fkey"], v["rrp"], v["disc"], v["code"]) for k, v in table.items()}


def random_case(rng, n_keys=6, n_rows=60, with_current=True):
    cur = []
    if with_current:
        for k in range(0, n_keys, 2):
            cur.append((f"k{k}", T0 + dt.timedelta(hours=rng.randint(0, 30)), rng.randint(0, 9), "inventory", "old",
                        float(rng.randint(1, 99)), 5.0, "OLD", None))
    inc = []
    for a in range(n_rows):
        inv = rng.random() < 0.4
        inc.append((f"k{rng.randint(0, n_keys - 1)}", T0 + dt.timedelta(hours=rng.randint(0, 40)), rng.randint(0, 99),
                    "inventory" if inv else "avail13_delta", f"f{a}", float(a) if inv else None,
                    float(a % 7) if inv else None, "NEW" if inv else None, None, a))
    return cur, inc


def run_spark(spark, cur, inc, bucket_width):
    c = spark.createDataFrame(cur, STOCK)
    i = spark.createDataFrame(inc, STOCK + ", arrival long")
    out = merge.gated_merge(c, i, bucket_width=bucket_width).collect()
    return {r.isbn13: (r.stock_updated_at, r.stock_qty, r.source, r.source_file_key, r.rrp_gbp, r.discount_percent,
                       r.report_code) for r in out}


def test_gated_merge_equals_fold(spark):
    rng = random.Random(7)
    for case in range(12):
        cur, inc = random_case(rng, with_current=case % 3 != 0)
        expected = fold(cur, inc)
        # tiny buckets force the two-level prefix maximum across many buckets
        for width in (3, 1 << 20):
            assert run_spark(spark, cur, inc, width) == expected, (case, width)


def test_hot_key_split_over_buckets(spark):
    """One key holding most rows gives the same answer at any bucket width."""
    rng = random.Random(3)
    cur, inc = random_case(rng, n_keys=2, n_rows=200)
    expected = fold(cur, inc)
    assert run_spark(spark, cur, inc, 7) == expected


BOOKS = ("record_reference string, isbn13 string, title string, long_description string, embedded_at timestamp, "
         "is_removed boolean, removed_at timestamp, created_at timestamp, updated_at timestamp")


def _products(spark, rows):
    from quire.schemas import BOOK_FIELDS
    df = spark.createDataFrame(rows, "record_reference string, notification_type string, isbn13 string, "
                                     "title string, long_description string, arrival long")
    return df.select(*[F.col(c) if c in df.columns else F.lit(None).cast("string").alias(c) for c in BOOK_FIELDS],
                     "arrival")


def test_book_upsert_rules(spark):
    books = spark.createDataFrame([
        ("A", "978A", "Title A", "long", T0, False, None, T0, T0),
        ("B", "978B", "Title B", "long", T0, True, T0, T0, T0),
        ("C", "978C", "Title C", None, T0, False, None, T0, T0),
    ], BOOKS)
    prods = _products(spark, [
        ("A", "03", "978A", "Title A", "long", 1),       # same text -> embedding kept
        ("B", "03", "978B", "Title B2", "long", 2),      # retitled -> invalidated, reactivated
        ("C", "03", "978C", "Title C", "now set", 3),    # description null -> set: invalidated
        ("D", "03", "978D", "New", None, 4),             # insert
        ("D", "03", "978D", "Newer", None, 5),           # last notice of D wins
    ])
    out = {r.record_reference: r for r in merge.upsert_books(books, prods, "2024-06-01").collect()}
    assert out["A"].embedded_at == T0 and out["B"].embedded_at is None and out["C"].embedded_at is None
    assert out["B"].is_removed is False and out["B"].removed_at is None
    assert out["D"].title == "Newer" and out["D"].created_at == dt.datetime(2024, 6, 1)
    assert out["A"].created_at == T0 and out["A"].updated_at == dt.datetime(2024, 6, 1)


def test_upsert_idempotent(spark):
    books = spark.createDataFrame([("A", "978A", "Title A", "x", T0, False, None, T0, T0)], BOOKS)
    prods = _products(spark, [("A", "03", "978A", "T", "y", 1), ("E", "03", "978E", "E", None, 2)])
    once = merge.upsert_books(books, prods, "2024-06-01")
    twice = merge.upsert_books(once, prods, "2024-06-01")
    assert sorted(map(tuple, once.collect())) == sorted(map(tuple, twice.collect()))


def test_soft_delete_by_isbn_then_reference_and_reactivation(spark):
    books = spark.createDataFrame([
        ("A", "978A", "A", None, None, False, None, T0, T0),
        ("B", "978B", "B", None, None, False, None, T0, T0),
        ("C", None, "C", None, None, False, None, T0, T0),
    ], BOOKS)
    notices = _products(spark, [
        ("X", "05", "978A", "", None, 1),   # delete by ISBN (reference differs)
        ("C", "05", None, "", None, 2),     # delete by reference
        ("B", "05", "978B", "", None, 3),
        ("B", "03", "978B", "B again", None, 4),   # later normal notice reactivates
        ("Z", "05", None, "", None, 5),     # unmatched: nothing inserted
    ])
    out = {r.record_reference: r for r in merge.apply_notices(books, notices, "2024-06-01").collect()}
    assert set(out) == {"A", "B", "C"}
    assert out["A"].is_removed and out["C"].is_removed and not out["B"].is_removed
    assert out["A"].updated_at == T0 and out["A"].removed_at == dt.datetime(2024, 6, 1)


def test_replace_children_and_genres(spark):
    child = spark.createDataFrame([("A", 1, "old"), ("B", 1, "keep")], "book string, seq int, name string")
    touched = spark.createDataFrame([("A",), ("C",)], "book string")
    new = spark.createDataFrame([("A", 1, "new")], "book string, seq int, name string")
    out = sorted(map(tuple, merge.replace_children(child, touched, new, "book").collect()))
    assert out == [("A", 1, "new"), ("B", 1, "keep")]

    subj = spark.createDataFrame([
        ("A", 1, "93", "Fiction & Stuff", "F1"), ("B", 2, "93", "Fiction  & stuff", "F2"),
        ("C", 3, "93", "", "X"), ("D", 4, "93", None, "Code Only"), ("E", 5, "10", "Other", "O")],
        "record_reference string, pos long, scheme_identifier string, subject_heading_text string, subject_code string")
    genres, pairs = merge.derive_genres(subj)
    g = {r.slug: r.name for r in genres.collect()}
    assert g == {"fiction__stuff": "Fiction & Stuff", "code_only": "Code Only"}
    assert sorted(map(tuple, pairs.collect())) == [("A", "fiction__stuff"), ("B", "fiction__stuff"), ("D", "code_only")]
    cur = spark.createDataFrame([("code_only", "Kept", None, "93")], "slug string, name string, subject_code string, "
                                                                      "scheme_identifier string")
    merged = {r.slug: r.name for r in merge.insert_absent(cur, genres, "slug").collect()}
    assert merged["code_only"] == "Kept"


def test_sweep_and_link_ids(spark):
    t = spark.createDataFrame([("a", T0), ("b", dt.datetime(2024, 6, 1))], "isbn13 string, synced_at timestamp")
    assert [r.isbn13 for r in merge.sweep(t, "synced_at", "2024-06-01").collect()] == ["b"]
    rows = spark.createDataFrame([("1", None), ("2", None), ("3", 9)], "isbn13 string, book_id long")
    books = spark.createDataFrame([(10, "1"), (20, "2"), (30, "3")], "id long, isbn13 string")
    touched = spark.createDataFrame([("1",), ("3",)], "isbn13 string")
    out = dict(map(tuple, merge.link_ids(rows, books, touched=touched).collect()))
    assert out == {"1": 10, "2": None, "3": 9}


def test_deletes_follow_an_isbn_as_a_row_by_row_fold(spark):
    """ISBNs that move between books before and after a delete, against a fold of the notices."""
    from quire.schemas import BOOK_FIELDS
    rng = random.Random(9)
    types = ", ".join(f"{c} string" for c in BOOK_FIELDS)
    state = "embedded_at timestamp, is_removed boolean, removed_at timestamp, created_at timestamp, updated_at timestamp"
    for _ in range(3):
        stored = {f"b{k}": f"i{k}" for k in range(6)}
        run = []
        for at in range(60):
            ref, gone = f"b{rng.randrange(9)}", rng.random() < 0.4
            run.append((at, ref, "05" if gone else "03", rng.choice([None, *(f"i{k}" for k in range(8))])))
        held, removed = dict(stored), {r: False for r in stored}
        for at, ref, kind, isbn in run:
            if kind != "05":
                held[ref], removed[ref] = isbn, False
            elif isbn is None:
                removed.update({ref: True} if ref in held else {})
            else:
                removed.update({r: True for r, i in held.items() if i == isbn})
        row = lambda ref, isbn: tuple(ref if c == "record_reference" else isbn if c == "isbn13" else "t" for c in BOOK_FIELDS)
        books = spark.createDataFrame([(*row(r, i), None, False, None, T0, T0) for r, i in stored.items()], f"{types}, {state}")
        notices = spark.createDataFrame(
            [(*(kind if c == "notification_type" else v for c, v in zip(BOOK_FIELDS, row(ref, isbn))), at) for at, ref, kind, isbn in run],
            f"{types}, arrival long")
        got = {r.record_reference: (r.isbn13, r.is_removed) for r in merge.apply_notices(books, notices, T0).collect()}
        assert got == {r: (held[r], removed[r]) for r in held}


def _sorts_before_shuffle(df) -> bool:
    plan = df._jdf.queryExecution().executedPlan().toString()
    return "Sort" in plan[plan.rindex("Exchange"):]


def test_wide_rows_are_dealt_before_they_are_sorted(spark):
    """Map tasks do not sort what they read; hot and null keys, null orders and repeats give one row a key."""
    rows = [(None if k % 50 == 0 else "hot" if k % 3 else f"k{k % 40}", (None if k % 7 == 0 else k // 2, f"t{k // 2}"), f"v{k // 2}")
            for k in range(2000)] + [("nulls", None, "x")] * 2
    df = spark.createDataFrame(rows, "k string, at struct<a: int, b: string>, v string")
    best = {}
    for k, at, v in rows:
        key = None if at is None else (at[0] is not None, at[0] or 0, at[1])
        if k not in best or (key is not None and (best[k][0] is None or key > best[k][0])):
            best[k] = (key, None if key is None else v)
    out = merge.last_wins(df, "k", "at")
    assert sorted(((r.k, r.v) for r in out.collect()), key=str) == sorted(((k, v) for k, (_, v) in best.items()), key=str)
    assert not _sorts_before_shuffle(out)
