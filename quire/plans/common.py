"""Shared pieces of the query plans: table loading, fixed run clock, output
formatting that both Spark and the SQL oracle render identically."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

# One fixed run clock, so that runs repeat and the oracle can match.
AS_OF = "2024-06-01 00:00:00"

TABLES = ("region", "nation", "customer", "supplier", "part", "orders", "lineitem", "events",
          "documents", "embeddings", "pages", "benchmark", "labels", "conversations")


def load(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def as_of() -> Column:
    return F.lit(AS_OF).cast("timestamp")


def days_before(n: int) -> Column:
    return as_of() - F.make_interval(F.lit(0), F.lit(0), F.lit(0), F.lit(n))


def ts_str(c) -> Column:
    c = F.col(c) if isinstance(c, str) else c
    return F.date_format(c, "yyyy-MM-dd HH:mm:ss")


def date_str(c) -> Column:
    c = F.col(c) if isinstance(c, str) else c
    return F.date_format(c, "yyyy-MM-dd")


def isbn_of(prefix: str, c) -> Column:
    """A synthetic ISBN-13: 978/979 + the key left-padded to 10 digits."""
    c = F.col(c) if isinstance(c, str) else c
    return F.concat(F.lit(prefix), F.lpad(c.cast("string"), 10, "0"))


def ref_of(prefix: str, c) -> Column:
    c = F.col(c) if isinstance(c, str) else c
    return F.concat(F.lit(prefix), c.cast("string"))


def xml_escape(c) -> Column:
    c = F.col(c) if isinstance(c, str) else c
    c = F.regexp_replace(c, "&", "&amp;")
    c = F.regexp_replace(c, "<", "&lt;")
    return F.regexp_replace(c, ">", "&gt;")


def el(tag: str, value: Column) -> Column:
    """``<tag>value</tag>``, or nothing when value is null."""
    return F.coalesce(F.concat(F.lit(f"<{tag}>"), value, F.lit(f"</{tag}>")), F.lit(""))


def el_raw(tag: str, *parts: Column) -> Column:
    return F.concat(F.lit(f"<{tag}>"), *parts, F.lit(f"</{tag}>"))


def flat_sort(df: DataFrame) -> DataFrame:
    return df.select(sorted(df.columns))
