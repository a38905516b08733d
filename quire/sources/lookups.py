"""Lookups on stored tables by columns other than their key (O-97).

For a column of a table in buckets, the folder ``_by_<column>`` beside them holds
``value, key`` rows in folders ``range=<n>``: ranges of (value, key), so that a value held
by a third of all rows lies in many of them, sorted inside. The lower bounds of the
ranges are a small table of their own. A lookup compares the bounds, reads only the folders that
can hold the value (a partition filter), there only the row groups that can (Parquet
statistics), and then only the buckets of the keys found.

Entries are added before their table is written and dropped afterwards, and every found record is
held against the value again, so a writer that dies in between leaves at most
entries too many. Null values are not found.
"""

from __future__ import annotations

from bisect import bisect_left, bisect_right

import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from quire.session import bounded_broadcast, cut_lineage, hadoop_fs
from quire.sources.store import layout, read_buckets, replace_partitions, touched_buckets

RANGE_ROWS = 200_000            # rows a range when it is made
MOST_ROWS = 4 * RANGE_ROWS      # rows in a range beyond which all ranges are made anew
ROW_GROUP = 1 << 20             # bytes; a lookup reads few rows


def _home(root: str, column: str) -> str:
    return f"{root}/_by_{column}"


def columns(spark: SparkSession, root: str) -> list[str]:
    """The columns by which the table at ``root`` can be looked up."""
    fs, p = hadoop_fs(spark, root)
    if not fs.exists(p):
        return []
    names = (st.getPath().getName() for st in fs.listStatus(p))
    return sorted(n[4:] for n in names if n.startswith("_by_") and _generations(spark, root, n[4:]))


def _generations(spark: SparkSession, root: str, column: str) -> list[int]:
    """Whole generations: the bounds are written last."""
    fs, p = hadoop_fs(spark, _home(root, column))
    if not fs.exists(p):
        return []
    found = (int(st.getPath().getName()[4:]) for st in fs.listStatus(p) if st.getPath().getName().startswith("gen="))
    return sorted(n for n in found if fs.exists(hadoop_fs(spark, f"{_home(root, column)}/gen={n}/bounds/_SUCCESS")[1]))


def _current(spark: SparkSession, root: str, column: str) -> str:
    found = _generations(spark, root, column)
    if not found:
        raise ValueError(f"{root} has no lookup by {column}")
    return f"{_home(root, column)}/gen={found[-1]}"


def _entries(spark: SparkSession, gen: str) -> DataFrame:
    schema = spark.read.parquet(f"{gen}/bounds").select("range", "value", "key").schema
    return spark.read.schema(schema).option("basePath", f"{gen}/rows").parquet(f"{gen}/rows").select("value", "key", "range")


def _bounds(spark: SparkSession, gen: str) -> list[tuple]:
    """``(value, key, range)`` of the lowest entry of every range: one row a range, in order."""
    return sorted((r["value"], r["key"], r["range"]) for r in spark.read.parquet(f"{gen}/bounds").collect())


def write_lookup(table: DataFrame, root: str, column: str, key: str, range_rows: int = RANGE_ROWS) -> None:
    """Make the lookup by ``column`` of the table at ``root``, whose rows are ``table``, or make it anew.

    One range shuffle of two columns. The generation before stays for readers that are on it."""
    spark = table.sparkSession
    done = _generations(spark, root, column)
    n = done[-1] + 1 if done else 0
    gen = f"{_home(root, column)}/gen={n}"
    pairs = table.where(F.col(column).isNotNull() & F.col(key).isNotNull()).select(F.col(column).alias("value"), F.col(key).alias("key"))
    ranges = max(1, -(-pairs.count() // range_rows))
    placed = (pairs.repartitionByRange(ranges, "value", "key").withColumn("range", F.spark_partition_id())
              .sortWithinPartitions("range", "value", "key"))
    (placed.write.mode("overwrite").option("parquet.block.size", str(ROW_GROUP)).partitionBy("range").parquet(f"{gen}/rows"))
    schema = placed.schema
    written = spark.read.schema(schema).option("basePath", f"{gen}/rows").parquet(f"{gen}/rows")
    low = written.groupBy("range").agg(F.min(F.struct("value", "key")).alias("low")).select("range", "low.*")
    low.coalesce(1).write.mode("overwrite").parquet(f"{gen}/bounds")
    fs, _ = hadoop_fs(spark, root)
    for old in done[:-1]:
        fs.delete(hadoop_fs(spark, f"{_home(root, column)}/gen={old}")[1], True)


def _places(spark: SparkSession, pairs: DataFrame, bounds: list[tuple]) -> DataFrame:
    """``pairs`` (value, key) with the range that each belongs to."""
    low = spark.sparkContext.broadcast(([b[:2] for b in bounds], [b[2] for b in bounds]))

    @F.pandas_udf("int")
    def place(value: pd.Series, key: pd.Series) -> pd.Series:
        lows, names = low.value
        return pd.Series([names[max(0, bisect_right(lows, pair) - 1)] for pair in zip(value, key)], dtype="int32")
    return pairs.withColumn("range", place("value", "key"))


def _ranges_of(spark: SparkSession, values: DataFrame, bounds: list[tuple]) -> list[int]:
    """The ranges that can hold one of the values (numbers, at most one a range)."""
    low = spark.sparkContext.broadcast([b[0] for b in bounds])

    @F.pandas_udf("array<int>")
    def span(value: pd.Series) -> pd.Series:
        lows = low.value
        return pd.Series([[max(0, bisect_left(lows, v) - 1), max(0, bisect_right(lows, v) - 1)] for v in value])
    spans = values.where(F.col("value").isNotNull()).select(span("value").alias("s")).distinct().collect()
    return sorted({bounds[i][2] for r in spans for i in range(r["s"][0], r["s"][1] + 1)}) if bounds else []


def _differences(before: DataFrame, after: DataFrame, column: str, key: str) -> tuple[DataFrame, DataFrame]:
    """Entries that the rows of a run gain and lose."""
    def pairs(df: DataFrame) -> DataFrame:
        return df.where(F.col(column).isNotNull() & F.col(key).isNotNull()).select(
            F.col(column).alias("value"), F.col(key).alias("key")).distinct()
    old, new = pairs(before), pairs(after)
    return new.join(old, ["value", "key"], "left_anti"), old.join(new, ["value", "key"], "left_anti")


def _change(spark: SparkSession, root: str, column: str, key: str, pairs: DataFrame, add: bool) -> None:
    gen = _current(spark, root, column)
    bounds = _bounds(spark, gen)
    if not bounds:                      # an empty table so far
        if add:
            write_lookup(pairs.select(F.col("value").alias(column), F.col("key").alias(key)), root, column, key)
        return
    moved = cut_lineage(_places(spark, pairs, bounds))
    only = sorted(r[0] for r in moved.select("range").distinct().collect())
    if not only:
        return
    held = _entries(spark, gen).where(F.col("range").isin(*only)).select("value", "key", "range")
    out = held.join(moved, ["value", "key"], "left_anti").select("value", "key", "range")
    if add:
        out = out.unionByName(moved)
    replace_partitions(out, f"{gen}/rows", "range", only, ("value", "key"), options={"parquet.block.size": str(ROW_GROUP)})
    if add:
        grown = _entries(spark, gen).where(F.col("range").isin(*only)).groupBy("range").count().agg(F.max("count")).first()[0]
        if grown > MOST_ROWS:
            write_lookup(_entries(spark, gen).select(F.col("value").alias(column), F.col("key").alias(key)), root, column, key)


def add_entries(before: DataFrame, after: DataFrame, root: str, column: str, key: str) -> None:
    """Add what the rows of a run gain. Call it before the table is written; only the
    ranges of gained values are read and written."""
    _change(after.sparkSession, root, column, key, _differences(before, after, column, key)[0], True)


def drop_entries(before: DataFrame, after: DataFrame, root: str, column: str, key: str) -> None:
    """Drop what the rows of a run lose. Call it after the table is written."""
    _change(after.sparkSession, root, column, key, _differences(before, after, column, key)[1], False)


def find(spark: SparkSession, root: str, column: str, values=None, low=None, high=None, prefix: str | None = None) -> DataFrame:
    """``value, key`` entries with one of ``values`` (a list, or a frame with a column ``value``),
    from ``low`` to ``high`` (both included), or beginning with ``prefix``."""
    gen = _current(spark, root, column)
    bounds = _bounds(spark, gen)
    rows, value = _entries(spark, gen), F.col("value")
    if isinstance(values, DataFrame):
        values = values.select("value").distinct()
        rows = rows.where(F.col("range").isin(*_ranges_of(spark, values, bounds)))
        return rows.join(bounded_broadcast(values), "value", "left_semi").select("value", "key")
    lows = [b[0] for b in bounds]
    spans = [(v, v) for v in values or [] if v is not None]
    keep = value.isin(*[v for v, _ in spans])
    if prefix is not None:
        # The least text after all that begin with the prefix has no simple form; the bounds are compared as prefixes.
        first = max(0, bisect_left(lows, prefix) - 1)
        last = max([first, *(i for i, v in enumerate(lows) if v <= prefix or v.startswith(prefix))])
        spans, keep = [], value.startswith(prefix)
        only = range(first, last + 1)
    elif values is None:
        spans = [(low, high)]
        keep = F.lit(True)
        keep = keep if low is None else keep & (value >= F.lit(low))
        keep = keep if high is None else keep & (value <= F.lit(high))
        only = []
    else:
        only = []
    picked = set(only)
    for a, b in spans:
        first = 0 if a is None else max(0, bisect_left(lows, a) - 1)
        last = len(lows) - 1 if b is None else max(0, bisect_right(lows, b) - 1)
        picked |= set(range(first, last + 1))
    names = sorted(bounds[i][2] for i in picked if i < len(bounds))
    return rows.where(F.col("range").isin(*names)).where(keep).select("value", "key")


def look_up(spark: SparkSession, root: str, key: str, column: str, **condition) -> DataFrame:
    """Records of the table at ``root`` by the value of ``column`` (``find``'s conditions): only
    the buckets of the keys found are read, and each record's own value decides."""
    found = cut_lineage(find(spark, root, column, **condition))
    held = read_buckets(spark, root, touched_buckets(found.withColumnRenamed("key", key), key, layout(spark, root)))
    own = found.select(F.col("key").alias(key), F.col("value").alias(column)).distinct()
    return held.join(bounded_broadcast(own), [key, column], "left_semi")
