"""Snapshot store, ordered feed parts, distributed arrival ordinals."""

from pyspark.sql import functions as F

from quire.operators.merge import arrival_ordinal
from quire.sources import feeds as src
from quire.sources.store import _table_name, read_table, write_ordered_text, write_table


def test_snapshot_versions_and_bucketed_reregistration(spark, tmp_path):
    root = str(tmp_path / "t")
    assert read_table(spark, root) is None
    df = spark.range(100).select(F.col("id").cast("string").alias("k"), F.col("id").alias("v"))
    assert write_table(df, root, bucket_col="k", buckets=4) == 0
    assert write_table(df.withColumn("v", F.col("v") + 1), root, bucket_col="k", buckets=4) == 1
    t = read_table(spark, root)
    assert t.agg(F.sum("v")).first()[0] == sum(range(100)) + 100
    # a new session has no catalog entry: the pointer's bucket spec registers it again
    spark.sql(f"DROP TABLE IF EXISTS {_table_name(root, 1)}")
    again = read_table(spark, root)
    info = {r.col_name: r.data_type for r in spark.sql(f"DESCRIBE TABLE EXTENDED {_table_name(root, 1)}").collect()}
    assert again.count() == 100 and info.get("Num Buckets") == "4" and "k" in info.get("Bucket Columns", "")


def test_ordered_parts_keep_line_order(spark, tmp_path):
    lines = spark.range(1000).select(F.col("id").alias("seq"), F.col("id").cast("string").alias("line"))
    parts = write_ordered_text(lines, str(tmp_path / "feed"), rows_per_file=150)
    assert len(parts) == 7
    got = [int(r.line) for r in src.scan_lines(spark, str(tmp_path / "feed")).orderBy("arrival").collect()]
    assert got == list(range(1000))


def test_arrival_ordinal_is_monotonic(spark):
    df = spark.range(5000).select((F.col("id") * 7919 % 5000).alias("x")).repartition(9)
    df = df.withColumn("arrival", F.struct(F.col("x").alias("a")))
    out = arrival_ordinal(df, "arrival").collect()
    pairs = sorted((r.arrival, r.x) for r in out)
    xs = [x for _, x in pairs]
    assert xs == sorted(xs) and len(set(r.arrival for r in out)) == 5000


def test_a_writer_that_dies_leaves_a_readable_table(spark, tmp_path, monkeypatch):
    from quire.sources import store

    root, df = str(tmp_path / "t"), spark.range(3)
    write_table(df, root)

    def dies(*_):
        raise RuntimeError("killed")
    monkeypatch.setattr(store, "_write_pointer", dies)
    try:
        write_table(df.union(df), root)
    except RuntimeError:
        pass
    assert read_table(spark, root).count() == 3          # written, but not published
    monkeypatch.undo()
    assert write_table(df.union(df).union(df), root) == 1 and read_table(spark, root).count() == 9
    assert store.vacuum(spark, root, keep=1) == [0] and read_table(spark, root).count() == 9


def test_bucket_count_follows_the_stored_size(spark, tmp_path):
    from quire.sources.store import bucket_count

    root = str(tmp_path / "t")
    assert bucket_count(spark, root) == 8
    write_table(spark.range(50_000).select(F.col("id").cast("string").alias("k")), root, bucket_col="k", buckets=8)
    assert bucket_count(spark, root) == 8 and bucket_count(spark, root, bucket_bytes=1 << 14) > 8


def test_stock_numbers_do_not_depend_on_the_run(spark):
    """One row has one arrival number wherever the numbered frame is used."""
    from quire.operators.merge import gated_merge

    rows = spark.range(200_000).select(
        F.format_string("97800%08d", F.col("id") * 7 % 5000).alias("isbn13"), (F.col("id") % 97).cast("int").alias("stock_qty"),
        F.lit("avail13_delta").alias("source"), F.lit("f").alias("source_file_key"), F.lit(None).cast("double").alias("rrp_gbp"),
        F.lit(None).cast("double").alias("discount_percent"), F.lit(None).cast("string").alias("report_code"),
        F.lit(None).cast("date").alias("report_date"), F.timestamp_seconds(F.floor(F.col("id") / 10_000)).alias("stock_updated_at"),
        F.struct(F.col("id").alias("a")).alias("arrival"))
    want = {r.isbn13: r.stock_qty for r in rows.groupBy("isbn13").agg(F.max_by("stock_qty", "arrival.a").alias("stock_qty")).collect()}
    for _ in range(2):
        out = gated_merge(rows.drop("arrival").limit(0), arrival_ordinal(rows.repartition(13), "arrival"))
        assert {r.isbn13: r.stock_qty for r in out.collect()} == want


def test_a_delta_reads_and_writes_only_its_buckets(spark, tmp_path):
    from pyspark.sql import functions as F

    from quire.operators import merge
    from quire.sources import store
    from quire.streaming.jobs import _update
    root = str(tmp_path / "t")
    rows = spark.range(5000).select(F.concat(F.lit("k"), "id").alias("k"), F.col("id").alias("v"))
    store.replace_buckets(rows, root, "k", range(256), 256)
    files = lambda: {f"{p.parent.name}/{p.name}": p.parent.name for p in (tmp_path / "t" / "of=256").rglob("*.parquet")}
    before = files()
    delta = spark.range(40).select(F.concat(F.lit("k"), "id").alias("k"), (-F.col("id")).alias("v"))
    only = store.touched_buckets(delta, "k", 256)
    held = store.read_buckets(spark, root, only)
    assert 0 < len(only) <= 40 and len(held.inputFiles()) == 256
    scan = held._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull(bucket" in scan or "PartitionFilters: [bucket" in scan
    assert {f"bucket={b}" for b in only} == {f.split("/")[-2] for f in held.select(F.input_file_name()).distinct().toPandas().iloc[:, 0]}

    _update(spark, root, "k", delta, rows, lambda cur: merge.upsert(cur, delta, "k"))
    after = files()
    assert {after[f] for f in set(after) - set(before)} == {f"bucket={b}" for b in only}
    assert {before[f] for f in set(before) - set(after)} == {f"bucket={b}" for b in only}
    got = {r.k: r.v for r in store.read_table(spark, root).collect()}
    assert len(got) == 5000 and all(got[f"k{i}"] == (-i if i < 40 else i) for i in range(5000))

    _update(spark, root, "k", delta, rows, lambda cur: cur.join(delta.select("k"), "k", "left_anti"))     # buckets may be left empty
    assert store.read_table(spark, root).count() == 4960
    store.rebucket(spark, root, "k", 512)
    assert store.layout(spark, root) == 512 and store.read_table(spark, root).count() == 4960
    _update(spark, root, "k", None, rows, lambda cur: cur.limit(0))
    assert store.read_table(spark, root) is None or store.read_table(spark, root).count() == 0


def test_a_snapshot_moves_into_buckets(spark, tmp_path):
    from quire.sources import store
    root = str(tmp_path / "old")
    df = spark.createDataFrame([(f"k{i}", i) for i in range(20)], "k string, v long")
    store.write_table(df, root, bucket_col="k", buckets=4)
    assert store.open_buckets(spark, root, "k", df) == 8 and store.layout(spark, root) == 8
    assert sorted(r.v for r in store.read_table(spark, root).collect()) == list(range(20))
