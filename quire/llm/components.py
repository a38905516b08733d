"""Connected components of a link table, by alternating large-star and small-star steps."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from quire.llm.common import staged


def _star(edges: DataFrame, large: bool) -> DataFrame:
    """Hang each node's larger (or smaller) neighbours on the least node around it."""
    both = edges.select(F.col("a").alias("u"), F.col("b").alias("v"))
    if large:
        both = both.union(edges.select(F.col("b").alias("u"), F.col("a").alias("v")))
    else:   # only neighbours below u
        both = both.select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v"))
    least = both.groupBy("u").agg(F.least(F.min("v"), F.col("u")).alias("m"))
    hung = both.join(least, "u")
    if large:
        out = hung.filter(F.col("v") > F.col("u")).select(F.col("v").alias("a"), F.col("m").alias("b"))
    else:
        out = hung.select(F.col("v").alias("a"), F.col("m").alias("b")).union(
            least.select(F.col("u").alias("a"), F.col("m").alias("b")))
    return out.filter("a <> b").distinct()


def components(links: DataFrame) -> DataFrame:
    """(id, component) of every node of the undirected links (a, b): component is
    the least id reachable. Each round is written to the shared folder; the
    rounds end when every node hangs on its component's least node."""
    edges = staged(links.select("a", "b").filter("a <> b").distinct(), "links")
    while True:
        edges = staged(_star(_star(edges, large=True), large=False), "stars")
        # Done when no node is both hung up and a hook, and none hangs twice.
        hooks = edges.select(F.col("b").alias("a")).distinct()
        loose = edges.join(hooks, "a", "left_semi").limit(1).count()
        twice = edges.groupBy("a").count().filter("count > 1").limit(1).count()
        if not loose and not twice:
            break
    return edges.select(F.col("a").alias("id"), F.col("b").alias("component")).union(
        edges.select(F.col("b").alias("id"), F.col("b").alias("component")).distinct())
