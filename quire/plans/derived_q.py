"""Queries of the derived meanings (X-01 … X-03)."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from quire.operators import derived
from quire.plans.catalog import stock_current, stock_view
from quire.plans.common import isbn_of, load


def q_region_sellability(spark: SparkSession, sf: str) -> DataFrame:
    """X-01: allow/deny lists per ISBN applied to (ISBN, region) questions."""
    o, cu, n = load(spark, sf, "orders"), load(spark, sf, "customer"), load(spark, sf, "nation")
    c = F.col
    nn = n.select("n_nationkey", "n_name")
    region = F.when(c("o_orderkey") % 2 == 0, c("c_nationkey")).otherwise((c("c_nationkey") + 1) % 25)
    r = (o.join(cu.select("c_custkey", "c_nationkey"), o.o_custkey == cu.c_custkey)
         .select(isbn_of("978", "o_custkey").alias("isbn13"), region.alias("nk"),
                 F.when(c("o_orderstatus") == "F", F.lit("Y")).otherwise(F.lit("N")).alias("flag"))
         .join(nn, c("nk") == c("n_nationkey")).select("isbn13", c("n_name").alias("region_code"), "flag"))
    own = cu.join(nn, cu.c_nationkey == nn.n_nationkey).select(isbn_of("978", "c_custkey").alias("isbn13"),
                                                               c("n_name").alias("region_code"))
    nxt = cu.join(nn, (cu.c_nationkey + 2) % 25 == nn.n_nationkey).select(isbn_of("978", "c_custkey").alias("isbn13"),
                                                                          c("n_name").alias("region_code"))
    return derived.sellable(r, own.unionByName(nxt))


def q_redirect_resolution(spark: SparkSession, sf: str) -> DataFrame:
    """X-02: chains of ISBN redirects followed to their last ISBN.

    All parts: chains of 100 links (key -> key + 7), every tenth of them closed to a cycle."""
    key = F.col("p_partkey")
    chain, place = F.floor(key / 700), F.floor(F.pmod(key, F.lit(700)) / 7)
    to = F.when(place < 99, key + 7).when(chain % 10 == 0, key - 99 * 7)
    slips = load(spark, sf, "part").withColumn("to", to.cast("long")).where("to is not null and to > 0").select(
        isbn_of("978", "p_partkey").alias("old_isbn13"), isbn_of("978", "to").alias("new_isbn13"))
    out = derived.resolve_redirects(slips)
    return out.select("old_isbn13", "final", F.col("hops").cast("long").alias("hops"), "cycle")


def q_stock_zero_fill(spark: SparkSession, sf: str) -> DataFrame:
    """X-03: ISBNs missing from the full hourly snapshot drop to zero stock."""
    ev = load(spark, sf, "events")
    full = ev.where(F.col("event_type") == "purchase").select(
        isbn_of("979", "user_id").alias("isbn13"))
    ts = F.lit("2024-02-01 06:00:00").cast("timestamp")
    return stock_view(derived.zero_fill(stock_current(load(spark, sf, "customer")), full, ts))
