"""Lookups by other columns on stored tables: results, pruning, upkeep."""

import random
import re

import pytest
from pyspark.sql import functions as F

from quire.operators import merge
from quire.sources import lookups, store
from quire.streaming import jobs


def files_read(df) -> int:
    df.collect()
    leaf = df._jdf.queryExecution().executedPlan().collectLeaves().head()
    return leaf.metrics().apply("numFiles").value()


@pytest.fixture
def table(spark, tmp_path):
    """One value holds a third of the rows, one row has none."""
    rng = random.Random(3)
    rows = [(f"k{i:04d}", "hot" if i % 3 == 0 else f"v{rng.randint(0, 300):03d}", i) for i in range(2000)] + [("none", None, 0)]
    root = str(tmp_path / "t")
    df = spark.createDataFrame(rows, "k string, v string, n int")
    store.replace_buckets(df, root, "k", range(8), 8)
    lookups.write_lookup(store.read_buckets(spark, root), root, "v", "k", range_rows=100)
    return root, rows


def test_every_condition_equals_a_scan(spark, table):
    root, rows = table
    some = spark.createDataFrame([("hot",), ("v007",), ("v300",), ("zzz",), (None,)], "value string")
    cases = [({"values": ["hot"]}, lambda v: v == "hot"), ({"values": ["v001", "v299", "a"]}, lambda v: v in ("v001", "v299")),
             ({"values": some}, lambda v: v in ("hot", "v007", "v300")), ({"values": []}, lambda v: False),
             ({"values": [None]}, lambda v: False), ({"low": "v100", "high": "v110"}, lambda v: "v100" <= v <= "v110"),
             ({"low": "v290"}, lambda v: v >= "v290"), ({"high": "hot"}, lambda v: v <= "hot"),
             ({"prefix": "v1"}, lambda v: v.startswith("v1")), ({"prefix": "ho"}, lambda v: v.startswith("ho")),
             ({"prefix": "x"}, lambda v: False)]
    for condition, holds in cases:
        got = sorted(r.k for r in lookups.look_up(spark, root, "k", "v", **condition).collect())
        assert got == sorted(k for k, v, _ in rows if v is not None and holds(v)), condition


def test_a_lookup_opens_few_ranges_and_buckets(spark, table):
    root, _ = table
    found = lookups.find(spark, root, "v", values=["v123"])
    text = found._jdf.queryExecution().executedPlan().toString()
    assert re.search(r"PartitionFilters: \[[^\]]*range#", text) and "PushedFilters: [IsNotNull(value), EqualTo(value,v123)]" in text
    assert files_read(found) <= 2 and files_read(lookups.find(spark, root, "v", low="a")) >= 20
    # the value of a third of all rows lies in several ranges
    assert files_read(lookups.find(spark, root, "v", values=["hot"])) >= 6
    rows = lookups.look_up(spark, root, "k", "v", values=["v123"])
    assert re.search(r"PartitionFilters: \[[^\]]*bucket#", rows._jdf.queryExecution().executedPlan().toString())


def test_a_run_keeps_the_lookups_up(spark, table, monkeypatch):
    root, rows = table
    want = {k: v for k, v, _ in rows}
    rng = random.Random(4)
    monkeypatch.setattr(lookups, "MOST_ROWS", 300)
    for step in range(3):
        some = [(k, rng.choice(["hot", "v005", f"new{step}", None]), 1) for k in rng.sample(sorted(want), 40)]
        some.append((f"more{step}", f"new{step}", 1))
        want.update((k, v) for k, v, _ in some)
        run = spark.createDataFrame(some, "k string, v string, n int")
        jobs._update(spark, root, "k", run.select("k"), run, lambda current, run=run: merge.upsert(current, run, "k"))
        held = sorted((r.value, r.key) for r in lookups.find(spark, root, "v", low="").collect())
        assert held == sorted((v, k) for k, v in want.items() if v is not None)
    # a run that adds more than the ranges hold makes them anew
    run = spark.range(900).select(F.format_string("x%04d", "id").alias("k"), F.lit("v005").alias("v"), F.lit(1).alias("n"))
    jobs._update(spark, root, "k", run.select("k"), run, lambda current: merge.upsert(current, run, "k"))
    assert len(lookups._generations(spark, root, "v")) == 2
    got = {r.k for r in lookups.look_up(spark, root, "k", "v", values=["v005"]).collect()}
    assert got == {k for k, v in want.items() if v == "v005"} | {f"x{i:04d}" for i in range(900)}


def test_a_writer_that_dies_loses_no_record(spark, table, monkeypatch):
    root, rows = table
    run = spark.createDataFrame([("k0000", "moved", 1), ("k0001", "moved", 1)], "k string, v string, n int")

    def update():
        jobs._update(spark, root, "k", run.select("k"), run, lambda current: merge.upsert(current, run, "k"))

    def found(value):
        return {r.k for r in lookups.look_up(spark, root, "k", "v", values=[value]).collect()}

    def dies(*_, **__):
        raise RuntimeError("killed")
    hot = {k for k, v, _ in rows if v == "hot"}
    monkeypatch.setattr(store, "replace_buckets", dies)
    with pytest.raises(RuntimeError):
        update()                    # entries are added, the table is as it was
    monkeypatch.undo()
    assert found("moved") == set() and found("hot") == hot
    monkeypatch.setattr(lookups, "drop_entries", dies)
    with pytest.raises(RuntimeError):
        update()                    # the table is written, old entries are still there
    monkeypatch.undo()
    update()
    assert found("moved") == {"k0000", "k0001"} and found("hot") == hot - {"k0000"}


def test_an_empty_table_has_an_empty_lookup(spark, tmp_path):
    root = str(tmp_path / "t")
    df = spark.createDataFrame([("a", "x")], "k string, v string")
    store.replace_buckets(df, root, "k", range(8), 8)
    lookups.write_lookup(df.limit(0), root, "v", "k")
    assert lookups.columns(spark, root) == ["v"]
    assert lookups.find(spark, root, "v", values=["x"]).count() == 0 and lookups.find(spark, root, "v", values=df.select(F.col("v").alias("value"))).count() == 0
    lookups.add_entries(df.limit(0), df, root, "v", "k")
    assert lookups.look_up(spark, root, "k", "v", values=["x"]).count() == 1
