"""Derived meanings: sellability lists, redirect chains with cycles, zero fill."""

import datetime as dt

from pyspark.sql import functions as F

from quire.operators import derived


def test_sellable(spark):
    r = spark.createDataFrame([("a", "GB", "Y"), ("b", "US", "N")], "isbn13 string, region_code string, flag string")
    p = spark.createDataFrame([("a", "GB"), ("a", "US"), ("b", "US"), ("b", "GB"), ("c", "FR")],
                              "isbn13 string, region_code string")
    got = {(x.isbn13, x.region_code): x.sellable for x in derived.sellable(r, p).collect()}
    assert got == {("a", "GB"): True, ("a", "US"): False, ("b", "US"): False, ("b", "GB"): True, ("c", "FR"): True}


def test_redirect_chains_and_cycles(spark):
    s = spark.createDataFrame([("1", "2"), ("2", "3"), ("3", "4"), ("7", "8"), ("8", "7")],
                              "old_isbn13 string, new_isbn13 string")
    got = {x.old_isbn13: (x.final, x.hops, x.cycle) for x in derived.resolve_redirects(s).collect()}
    assert got["1"] == ("4", 3, False) and got["3"] == ("4", 1, False)
    assert got["7"] == got["8"] == (None, None, True)


def test_long_redirect_chain_and_a_way_into_a_cycle(spark):
    links = [(f"c{i}", f"c{i + 1}") for i in range(150)] + [("a", "b"), ("b", "d"), ("d", "b")]
    s = spark.createDataFrame(links, "old_isbn13 string, new_isbn13 string")
    got = {x.old_isbn13: (x.final, x.hops, x.cycle) for x in derived.resolve_redirects(s).collect()}
    assert all(got[f"c{i}"] == ("c150", 150 - i, False) for i in range(150))
    assert got["a"] == got["b"] == got["d"] == (None, None, True) and len(got) == 153


def test_zero_fill(spark):
    t0 = dt.datetime(2024, 1, 1)
    stock = spark.createDataFrame([("a", 5, "inventory", t0), ("b", 3, "avail13_delta", t0)],
                                  "isbn13 string, stock_qty int, source string, stock_updated_at timestamp")
    full = spark.createDataFrame([("a",)], "isbn13 string")
    out = {x.isbn13: x for x in derived.zero_fill(stock, full, F.lit(dt.datetime(2024, 1, 2))).collect()}
    assert out["a"].stock_qty == 5 and out["b"].stock_qty == 0 and out["b"].source == "avail13_full"
