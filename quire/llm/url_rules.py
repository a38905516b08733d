"""URL filters: host-suffix and path-prefix expressions, joined on short hashes.

Each URL is expanded into expressions "host suffix + path prefix" (suffixes at
dots, prefixes that end at a slash, and the empty prefix), no deeper than the
deepest rule. Their digests are equi-joined with the rules' digests on the
first 32 bits; the full digest and the rule's whole path then confirm a match,
and the longest rule decides.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from quire.llm.common import staged

PREFIX_HEX = 8   # 32 bits of the digest travel through the join
_UPPER, _LOW = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


def host_of(url: Column) -> Column:
    """What stands between the first ``://`` and the next ``/ ? #``, A-Z lower-cased; else empty."""
    return F.translate(F.coalesce(F.regexp_extract(url, r"://([^/?#]*)", 1), F.lit("")), _UPPER, _LOW)


def path_of(url: Column) -> Column:
    """What follows the host, up to ``?`` or ``#``; else empty."""
    return F.coalesce(F.regexp_extract(url, r"://[^/?#]*([^?#]*)", 1), F.lit(""))


def _suffixes(host: Column, most: int) -> Column:
    labels = F.split(host, r"\.", -1)
    return F.transform(F.sequence(F.lit(1), F.least(F.size(labels), F.lit(most))),
                       lambda k: F.array_join(F.slice(labels, F.size(labels) - k + 1, k), "."))


def _prefixes(path: Column, most: int) -> Column:
    parts = F.split(path, "/", -1)
    depth = F.least(F.size(parts) - 1, F.lit(most))
    steps = F.when(depth >= 1, F.sequence(F.lit(1), F.greatest(depth, F.lit(1)))).otherwise(F.array().cast("array<int>"))
    return F.concat(F.array(F.lit("")), F.transform(
        steps, lambda k: F.concat(F.array_join(F.slice(parts, F.lit(1), k), "/"), F.lit("/"))))


def url_verdicts(pages: DataFrame, rules: DataFrame, id_col: str = "page_id", url_col: str = "url",
                 default: str = "allow") -> DataFrame:
    """Judge every row's URL by ``rules`` (rule_host, rule_path, verdict).

    A rule fits its host and all subdomains if the URL's path starts with the
    rule's path. The longest rule (host and path together, then host) wins; of
    rules that tie, one that blocks. Without a rule the verdict is ``default``.

    Returns ``id_col``, host, path, rule (host + path, null if none), verdict:
    one row per input row, repeated rows included. A null URL, or one without
    ``://``, has an empty host and path and no rule. Ports and user names are
    part of the host as written. Other columns of ``pages`` are not read.
    """
    rules = rules.select(
        F.translate("rule_host", _UPPER, _LOW).alias("rule_host"), F.coalesce("rule_path", F.lit("")).alias("rule_path"),
        "verdict").filter("rule_host is not null").withColumn("stem", F.regexp_extract("rule_path", r"(?s)^(.*/)?", 0))
    deepest = rules.agg(F.max(F.size(F.split("rule_host", r"\.", -1))).alias("labels"),
                        F.max(F.size(F.split("stem", "/", -1)) - 1).alias("slashes")).first()
    rules = rules.withColumn("digest", F.sha2(F.concat("rule_host", "stem"), 256))

    urls = pages.select(F.col(id_col).alias("id"), host_of(F.col(url_col)).alias("host"),
                        path_of(F.col(url_col)).alias("path"))
    urls = urls.withColumn("key", F.md5(F.concat_ws("\n", "host", "path")))
    distinct = urls.groupBy("key").agg(F.first("host").alias("host"), F.first("path").alias("path"))
    expanded = distinct.withColumn("suffix", F.explode(_suffixes(F.col("host"), deepest["labels"] or 1))).withColumn(
        "prefix", F.explode(_prefixes(F.col("path"), deepest["slashes"] or 0))).select(
        "key", "path", F.sha2(F.concat("suffix", "prefix"), 256).alias("full"))
    short = lambda c: F.substring(c, 1, PREFIX_HEX)
    found = expanded.join(rules, short("full") == short("digest")).filter(
        (F.col("full") == F.col("digest")) & F.col("path").startswith(F.col("rule_path")))
    best = found.groupBy("key").agg(F.max(F.struct(
        (F.length("rule_host") + F.length("rule_path")).alias("len"), F.length("rule_host").alias("host_len"),
        F.col("verdict").alias("verdict"), F.concat("rule_host", "rule_path").alias("rule"))).alias("best"))
    # The winners as a table of their own: the join back has an exchange on both
    # sides, so that a URL that a third of the rows share can be split.
    best = staged(best, "url-rules")
    return urls.join(best, "key", "left").select(
        F.col("id").alias(id_col), "host", "path", F.col("best.rule").alias("rule"),
        F.coalesce("best.verdict", F.lit(default)).alias("verdict"))
