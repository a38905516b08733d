"""Ranked search over a stored index of blocks (O-93, O-94).

``write_text_index`` sorts documents by their number of words, cuts them into blocks of
neighbours and stores, per lexeme and block, the postings and the best score among
them, in folders ``part=<n>`` by a hash of the lexeme. A search first reads only the best scores: their
sum over a query's lexemes bounds what any document of a block can reach. The blocks with
the highest bounds are scored, and then only those whose bound reaches the score of the
``k``-th document found. The result is the one of ``search.text_search``, ties by key.
"""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from quire.functions.text import WEIGHTS, stemmed, words
from quire.operators.search import by_document, split_words, weighted_words
from quire.session import bounded_broadcast, cut_lineage

BLOCK_DOCS = 64                 # documents a block
RANGE_DOCS = 100_000            # documents a range of the sort
PARTS = 64                      # folders of lexemes
FIRST_BLOCKS = 4                # blocks a query scores before it skips any


def _part(lexeme: str | Column, parts: int) -> Column:
    return F.pmod(F.xxhash64(lexeme), F.lit(parts)).cast("int")


def write_text_index(rows: DataFrame, path: str, key: str, fields: Mapping[str, str], stem: bool = True,
                     block_docs: int = BLOCK_DOCS, parts: int = PARTS) -> None:
    """Store the index of ``rows`` at ``path``; ``fields`` maps column -> weight letter, ``stem``
    indexes English stems (ask with ``query_terms(..., stem=True)`` then).

    The score of a lexeme in a document is summed over the fields in tenths, so ties are exact.
    Whole texts are dealt to tasks by block, and occurrences counted and listed there; numbering
    is done inside ranges of at most about RANGE_DOCS documents, never in one task."""
    spark = rows.sparkSession
    factor = F.create_map(*[x for kv in WEIGHTS.items() for x in (F.lit(kv[0]), F.lit(kv[1]))])
    length = sum((F.size(words(c)) for c in fields), F.lit(0))
    docs = rows.where(F.col(key).isNotNull()).select(F.col(key), length.alias("__n")).groupBy(key).agg(F.max("__n").alias("__n"))
    ranges = max(1, -(-rows.count() // RANGE_DOCS))
    numbered = (docs.repartitionByRange(ranges, F.col("__n").desc(), F.col(key)).withColumn("__range", F.spark_partition_id()))
    numbered = cut_lineage(numbered)            # a range's number must not change under a retry
    place = F.row_number().over(Window.partitionBy("__range").orderBy(F.col("__n").desc(), key)) - 1
    blocks = numbered.select(key, F.struct("__range", F.floor(place / block_docs).alias("at")).alias("block"))
    placed = rows.select(key, *fields).join(bounded_broadcast(blocks), key)
    said = split_words(by_document(placed, [key, "block"], fields, "block"), [key, "block"], fields)
    counted = said.groupBy(key, "block", "lexeme").agg(F.sum(factor[F.col("weight")]).alias("s"))
    if stem:
        counted = stemmed(counted).groupBy(key, "block", "lexeme").agg(F.sum("s").alias("s"))
    lists = (counted.groupBy("lexeme", "block")
             .agg(F.max("s").alias("best"), F.collect_list(F.struct(F.col(key).alias("key"), "s")).alias("postings")))
    placed = lists.withColumn("part", _part("lexeme", parts))
    (placed.hint("rebalance", "part").sortWithinPartitions("part", "lexeme", "block")
     .write.mode("overwrite").partitionBy("part").parquet(path))
    # The number of folders and the columns, for the searches (an empty index has no file).
    columns = [F.lit(None).cast(f.dataType).alias(f.name) for f in lists.schema.fields]
    spark.range(1).select(F.lit(parts).alias("part"), *columns).coalesce(1).write.mode("overwrite").parquet(f"{path}/_layout")


def query_terms(queries: DataFrame, text: str, query_id: str = "query_id", stem: bool = True) -> DataFrame:
    """Distinct ``query_id, lexeme`` of query texts; stop words go."""
    terms = weighted_words(queries, query_id, {text: "A"}).select(query_id, "lexeme")
    return (stemmed(terms) if stem else terms).distinct()


def search_text_index(spark: SparkSession, path: str, terms: DataFrame, k: int = 10, mode: str = "or", key: str = "key",
                      query_id: str = "query_id", first_blocks: int = FIRST_BLOCKS) -> DataFrame:
    """Top ``k`` documents per query: ``query_id, key, score, rank``, and how many blocks hold a
    term (``and``: every term) of the query and how many of them were scored (blocks, scored)."""
    layout = spark.read.parquet(f"{path}/_layout")
    parts = layout.first()["part"]
    terms = cut_lineage(terms.select(query_id, "lexeme").where(F.col("lexeme").isNotNull()).distinct())
    asked = [r[0] for r in terms.select(_part("lexeme", parts).alias("p")).distinct().collect()]     # at most PARTS numbers
    index = spark.read.schema(layout.schema).parquet(path).where(F.col("part").isin(*asked))

    bounds = (index.select("lexeme", "block", "best").join(bounded_broadcast(terms), "lexeme")
              .groupBy(query_id, "block").agg(F.sum("best").alias("bound"), F.count("*").alias("held")))
    if mode == "and":
        need = terms.groupBy(query_id).agg(F.count("*").alias("need"))
        bounds = bounds.join(bounded_broadcast(need), query_id).where(F.col("held") == F.col("need")).drop("need")
    bounds = cut_lineage(bounds)

    def scored(blocks: DataFrame) -> DataFrame:
        wanted = blocks.join(bounded_broadcast(terms), query_id)
        hits = (index.join(bounded_broadcast(wanted.select(query_id, "lexeme", "block", "held")), ["lexeme", "block"])
                .select(query_id, "held", "lexeme", F.inline("postings")))
        out = hits.groupBy(query_id, "key").agg(F.sum("s").alias("tenths"), F.count("*").alias("matched"), F.first("held").alias("held"))
        return out.where(F.col("matched") == F.col("held")) if mode == "and" else out

    best = Window.partitionBy(query_id).orderBy(F.col("bound").desc(), "block")
    head = bounds.withColumn("__at", F.row_number().over(best)).where(F.col("__at") <= first_blocks)
    found = cut_lineage(scored(head.select(query_id, "block", "held")))
    ranked = Window.partitionBy(query_id).orderBy(F.col("tenths").desc(), "key")
    least = (found.withColumn("rank", F.row_number().over(ranked)).where(F.col("rank") == k)
             .select(query_id, F.col("tenths").alias("least")))
    # A block at the very score can hold a smaller key. The first blocks are not scored again.
    left = (bounds.join(bounded_broadcast(least), query_id, "left").where(F.col("least").isNull() | (F.col("bound") >= F.col("least")))
            .join(bounded_broadcast(head.select(query_id, "block")), [query_id, "block"], "left_anti"))
    left = cut_lineage(left.select(query_id, "block", "held"))
    top = (found.unionByName(scored(left)).withColumn("rank", F.row_number().over(ranked)).where(F.col("rank") <= k))
    seen = (head.select(query_id).unionByName(left.select(query_id)).groupBy(query_id).agg(F.count("*").alias("scored"))
            .join(bounds.groupBy(query_id).agg(F.count("*").alias("blocks")), query_id))
    return (top.join(bounded_broadcast(seen), query_id)
            .select(query_id, F.col("key").alias(key), (F.col("tenths") / 10.0).alias("score"), "rank", "blocks", "scored"))
