"""Excerpt merge: time formats and the delta run."""

import datetime as dt

from quire.operators import enrich

FEED = "isbn13 string, title string, url string, available boolean, update_reason string, updated_at string, created_at string, " \
       "file_mtime timestamp, source_file string, pos int"
TABLE = "isbn13 string, title string, url string, available boolean, jb_updated_at timestamp, fetched_at timestamp, created_at timestamp"


def feed(spark, *times):
    t = dt.datetime(2024, 1, 1)
    return spark.createDataFrame([(str(9780000000000 + i), f"t{i}", "u", True, None, x, None, t, "f", i) for i, x in enumerate(times)], FEED)


def books(spark, n=10):
    return spark.createDataFrame([(str(9780000000000 + i),) for i in range(n)], "isbn13 string")


def test_any_iso_time(spark):
    rows = enrich.excerpt_rows(feed(spark, "2024-05-01T10:00:00.000Z", "2024-05-01", "2024-05-01T10:00:00+02:00", "2024-05-01 10:00:00", "soon", None),
                               "2024-06-01").collect()
    got = [r.jb_updated_at for r in sorted(rows, key=lambda r: r.arrival.pos)]
    assert got == [dt.datetime(2024, 5, 1, 10), dt.datetime(2024, 5, 1), dt.datetime(2024, 5, 1, 8), dt.datetime(2024, 5, 1, 10), None, None]


def test_delta_run_takes_rows_since_the_watermark(spark):
    t0 = dt.datetime(2024, 5, 28)
    current = spark.createDataFrame([("9780000000009", "old", "u", True, t0, t0, t0)], TABLE)
    news = feed(spark, "2024-05-29T00:00:00Z", "2024-05-27T00:00:00Z", None, "2024-05-28T00:00:00Z")
    table, counts = enrich.merge_excerpt_delta(current, news, books(spark), "2024-06-01")
    assert sorted(r.isbn13[-1] for r in table.collect()) == ["0", "2", "3", "9"]
    assert {r.outcome: r["count"] for r in counts.collect()} == {"upserted": 3}
    # an old table is clamped to the feed's 14 days; an empty one takes everything
    old = current.withColumn("fetched_at", enrich.F.lit(dt.datetime(2023, 1, 1)))
    assert enrich.merge_excerpt_delta(old, feed(spark, "2024-05-10T00:00:00Z", "2024-05-20T00:00:00Z"), books(spark), "2024-06-01")[0].count() == 2
    assert enrich.merge_excerpt_delta(current.limit(0), news, books(spark), "2024-06-01")[0].count() == 4
