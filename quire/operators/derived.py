"""Meanings the source data states but nothing computed (X-01 … X-03)."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from quire.session import cut_lineage


def sellable(restrictions: DataFrame, pairs: DataFrame, key: str = "isbn13", region: str = "region_code") -> DataFrame:
    """X-01: is each (ISBN, region) pair sellable? Any ``Y`` rows of an ISBN make
    an allow-list, ``N`` rows a deny-list, an unlisted ISBN sells everywhere.

    Per ISBN the sets are bounded by the number of regions; ``collect_set`` is
    combined map-side, so a hot ISBN does not gather its rows in one task."""
    lists = restrictions.groupBy(key).agg(
        F.collect_set(F.when(F.col("flag") == "Y", F.col(region))).alias("__allow"),
        F.collect_set(F.when(F.col("flag") == "N", F.col(region))).alias("__deny"))
    j = pairs.join(lists, key, "left")
    ok = (F.when(F.col("__allow").isNull(), F.lit(True))
          .when(F.size("__allow") > 0, F.array_contains("__allow", F.col(region)))
          .otherwise(~F.array_contains("__deny", F.col(region))))
    return j.select(*pairs.columns, ok.alias("sellable"))


def resolve_redirects(slips: DataFrame, old: str = "old_isbn13", new: str = "new_isbn13") -> DataFrame:
    """X-02: follow ISBN redirects old -> new to the last ISBN of each chain.

    Pointer doubling: every round joins the table of still moving pointers with
    itself, so a chain of n links ends after log2(n) rounds, whatever n is. A
    round in which no pointer reaches an end leaves only pointers that run in or
    into a cycle: those are flagged ``cycle`` and have no final ISBN and no
    hops (null). Each round's pointers are checkpointed. An ISBN with several
    redirects follows the least. Returns ``old, final, hops, cycle``."""
    links = slips.where(F.col(old).isNotNull() & F.col(new).isNotNull()).groupBy(F.col(old).alias("__from")).agg(
        F.min(new).alias("__to"))
    ends = links.select(F.col("__to").alias("__end")).join(links, F.col("__end") == F.col("__from"), "left_anti").distinct()
    done = links.join(ends, F.col("__to") == F.col("__end"), "left_semi").select(
        "__from", "__to", F.lit(1).cast("long").alias("__hops"))
    moving = links.join(ends, F.col("__to") == F.col("__end"), "left_anti").select(
        "__from", "__to", F.lit(1).cast("long").alias("__hops"))
    done, moving = cut_lineage(done), cut_lineage(moving)
    finished = done                       # pointers that stand at an end
    while moving.limit(1).count():
        nxt = finished.select(F.col("__from").alias("__at"), F.col("__to").alias("__next"), F.col("__hops").alias("__more"),
                              F.lit(True).alias("__ends")).unionByName(
            moving.select(F.col("__from").alias("__at"), F.col("__to").alias("__next"), F.col("__hops").alias("__more"),
                          F.lit(False).alias("__ends")))
        step = cut_lineage(moving.join(nxt, F.col("__to") == F.col("__at")).select(
            "__from", F.col("__next").alias("__to"), (F.col("__hops") + F.col("__more")).alias("__hops"), "__ends"))
        arrived = step.where("__ends").drop("__ends")
        moving = step.where("not __ends").drop("__ends")
        if not arrived.limit(1).count():
            break
        finished = finished.unionByName(arrived)
    return finished.select(F.col("__from").alias(old), F.col("__to").alias("final"), F.col("__hops").alias("hops"),
                           F.lit(False).alias("cycle")).unionByName(
        moving.select(F.col("__from").alias(old), F.lit(None).cast(slips.schema[new].dataType).alias("final"),
                      F.lit(None).cast("long").alias("hops"), F.lit(True).alias("cycle")))


def zero_fill(stock: DataFrame, full_snapshot: DataFrame, ts: Column, key: str = "isbn13",
              source: str = "avail13_full") -> DataFrame:
    """X-03 (opt-in): an ISBN absent from the day's full stock snapshot has no
    stock — its quantity becomes 0, stamped with the snapshot's time."""
    present = full_snapshot.select(key).distinct().withColumn("__in", F.lit(True))
    j = stock.join(present, key, "left")
    gone = F.col("__in").isNull()
    cols = []
    for c in stock.columns:
        if c == "stock_qty":
            cols.append(F.when(gone, F.lit(0)).otherwise(F.col(c)).cast(stock.schema[c].dataType).alias(c))
        elif c == "source":
            cols.append(F.when(gone, F.lit(source)).otherwise(F.col(c)).alias(c))
        elif c == "stock_updated_at":
            cols.append(F.when(gone, F.greatest(F.col(c), ts)).otherwise(F.col(c)).alias(c))
        else:
            cols.append(F.col(c))
    return j.select(*cols)
