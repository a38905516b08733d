"""Registered queries of the training-data operators: each applies its operator,
with production parameters, to its whole table."""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from quire.llm.bpe import bpe_round_trip
from quire.llm.chat import as_records, format_turns, formatted_digests, mixed_turns
from quire.llm.common import documents
from quire.llm.jaccard_join import Rule, jaccard_groups
from quire.llm.language_id import language_id
from quire.llm.mil_quality import quality_scores
from quire.llm.minhash import near_duplicates
from quire.llm.ns_kmeans import cluster
from quire.llm.packing import pack_documents
from quire.llm.quality_rules import quality_rules
from quire.llm.sharding import shard_documents
from quire.llm.syncmers import fingerprints
from quire.llm.url_rules import url_verdicts
from quire.llm.whitening import whiten
from quire.plans.common import load

TOKENIZER = "byte_bpe_50k.json"

# The rules of the URL query (host, path, verdict).
URL_RULES = (
    ("com", "/", "allow"),
    ("example.com", "/en/", "block"),
    ("www.example.com", "/en/", "allow"),
    ("net", "/es/", "block"),
    ("net", "/fr/", "block"),
)


def op1_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    pieces = pack_documents(documents(spark, sf_dir), public_tokenizers.path(TOKENIZER))
    return pieces.withColumn("ids_crc32", F.crc32("ids")).select(
        "doc_id", "start", "length", "ids_crc32", "doc_tokens", "sequence_id", "offset")


def op2_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    return bpe_round_trip(documents(spark, sf_dir), public_tokenizers.path(TOKENIZER))


def op3_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    return language_id(documents(spark, sf_dir))


def op4_chat_format(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All conversations (turns as rows) and one that comes as prompt and response, mixed in one frame."""
    said = "</s>[INST] ok [/INST]"
    extra = spark.range(1).selectExpr("cast(-1 as bigint) as conv_id", f"'{said}' as prompt", f"'{said}' as response")
    records = as_records(load(spark, sf_dir, "conversations")).unionByName(as_records(extra))
    turns = mixed_turns(records, "record").where(F.col("turn").isNotNull() | F.col("role").isNotNull())
    return formatted_digests(format_turns(turns))


def op5_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality_rules(documents(spark, sf_dir), load(spark, sf_dir, "labels"))


def op6_jaccard_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    return jaccard_groups(documents(spark, sf_dir), Rule(words=3, num=9, den=10))


def op7_syncmers(spark: SparkSession, sf_dir: str) -> DataFrame:
    return fingerprints(documents(spark, sf_dir))


def op8_url_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    rules = spark.sql("SELECT * FROM VALUES " + ", ".join(map(str, URL_RULES)) + " AS r(rule_host, rule_path, verdict)")
    return url_verdicts(load(spark, sf_dir, "pages"), rules)


def op9_sharding(spark: SparkSession, sf_dir: str) -> DataFrame:
    return shard_documents(documents(spark, sf_dir), n_shards=8)


def op10_mil_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality_scores(documents(spark, sf_dir), load(spark, sf_dir, "labels"))


def op11_whitening(spark: SparkSession, sf_dir: str) -> DataFrame:
    return whiten(load(spark, sf_dir, "embeddings"))


def op12_ns_kmeans(spark: SparkSession, sf_dir: str) -> DataFrame:
    return cluster(load(spark, sf_dir, "embeddings")).drop("scanned")


def op13_minhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near_duplicates(documents(spark, sf_dir))


URL_SQL = """
WITH u AS (
  SELECT page_id,
         translate(coalesce(regexp_extract(url, '://([^/?#]*)', 1), ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS host,
         coalesce(regexp_extract(url, '://[^/?#]*([^?#]*)', 1), '') AS path
  FROM pages
), r AS (
  SELECT *, CASE
    WHEN starts_with(path, '/en/') AND (host = 'www.example.com' OR ends_with(host, '.www.example.com')) THEN 'www.example.com/en/'
    WHEN starts_with(path, '/en/') AND (host = 'example.com' OR ends_with(host, '.example.com')) THEN 'example.com/en/'
    WHEN starts_with(path, '/es/') AND (host = 'net' OR ends_with(host, '.net')) THEN 'net/es/'
    WHEN starts_with(path, '/fr/') AND (host = 'net' OR ends_with(host, '.net')) THEN 'net/fr/'
    WHEN starts_with(path, '/') AND (host = 'com' OR ends_with(host, '.com')) THEN 'com/'
  END AS rule
  FROM u
)
SELECT page_id, host, path, rule,
       CASE WHEN rule IN ('example.com/en/', 'net/es/', 'net/fr/') THEN 'block' ELSE 'allow' END AS verdict
FROM r
"""

# Turn texts as they are; only the formatted length depends on the template:
# 32 characters of marks a turn, and a backslash for every control string inside a role or text.
CHAT_SQL = r"""
WITH t AS (
  SELECT conv_id, turn, role, coalesce(text, '') AS text FROM conversations
  UNION ALL SELECT -1, 0, 'user', '</s>[INST] ok [/INST]'
  UNION ALL SELECT -1, 1, 'assistant', '</s>[INST] ok [/INST]'
), s AS (
  SELECT *, length(role) + length(text) + 32
    + len(regexp_extract_all(role || chr(0) || text,
      '<\\*(\|im_start\|>|\|im_sep\|>|\|im_end\|>|\|endoftext\|>|s>|/s>|<SYS>>|</SYS>>)|\[\\*(INST\]|/INST\])')) AS shown
  FROM t
)
SELECT conv_id, count(*) AS n_turns,
       sha256(string_agg(role || chr(10) || text || chr(10), '' ORDER BY turn, role, text)) AS turns_sha256,
       sum(CASE WHEN role = 'assistant' THEN length(text) ELSE 0 END)::BIGINT AS loss_chars,
       sha256(coalesce(string_agg(text, '' ORDER BY turn, text) FILTER (WHERE role = 'assistant'), '')) AS loss_sha256,
       sum(shown)::BIGINT AS formatted_chars
FROM s GROUP BY conv_id
"""


# The five rounds written out, every vector against every centroid.
KMEANS_HEAD = """
WITH kept AS MATERIALIZED (
  SELECT vec_id, list_transform(embedding, lambda c: CAST(floor(256 * CAST(c AS DOUBLE)) AS BIGINT)) AS x
  FROM embeddings
  WHERE len(embedding) = 64 AND len(list_filter(embedding, lambda c: c IS NULL OR NOT isfinite(c))) = 0
), c0 AS MATERIALIZED (
  SELECT CAST(row_number() OVER (ORDER BY h, x) - 1 AS INTEGER) AS j, x AS c
  FROM (SELECT sha256('2:' || CAST(vec_id AS VARCHAR)) AS h, x FROM kept ORDER BY h, x LIMIT 40)
)"""

# Distances of all pairs; of the nearest, the smaller number.
KMEANS_ASSIGN = """, a{t} AS MATERIALIZED (
  SELECT row_id, any_value(vec_id) AS vec_id, any_value(x) AS x, min({{'d': d, 'j': j}}) AS best
  FROM (SELECT k.row_id, k.vec_id, k.x, c{t}.j, list_sum(list_transform(list_zip(k.x, c{t}.c), lambda p: (p[1] - p[2]) * (p[1] - p[2]))) AS d
        FROM (SELECT *, row_number() OVER () AS row_id FROM kept) k CROSS JOIN c{t})
  GROUP BY row_id
)"""

KMEANS_MOVE = """, s{u} AS (
  SELECT j, pos, sum(v)::HUGEINT AS s, count(*) AS n
  FROM (SELECT best.j AS j, unnest(x) AS v, unnest(range(64)) AS pos FROM a{t}) GROUP BY j, pos
), m{u} AS (
  SELECT j, list(CAST((s - ((s % n) + n) % n) // n AS BIGINT) ORDER BY pos) AS c FROM s{u} GROUP BY j
), c{u} AS MATERIALIZED (
  SELECT c{t}.j, coalesce(m{u}.c, c{t}.c) AS c FROM c{t} LEFT JOIN m{u} ON m{u}.j = c{t}.j
)"""

KMEANS_TAIL = """
SELECT vec_id, best.j AS cluster, CAST(best.d AS BIGINT) AS distance,
       CAST(sum(best.d) OVER (PARTITION BY best.j) AS BIGINT) AS cluster_inertia, CAST(sum(best.d) OVER () AS BIGINT) AS inertia,
       sha256(array_to_string(c5.c, ',')) AS centroid_sha256
FROM a5 JOIN c5 ON c5.j = a5.best.j"""

KMEANS_SQL = KMEANS_HEAD + "".join(
    KMEANS_ASSIGN.format(t=t) + (KMEANS_MOVE.format(t=t, u=t + 1) if t < 5 else "") for t in range(6)) + KMEANS_TAIL

# All pairs with a common shingle, their overlaps counted, and the links followed.
MINHASH_SQL = r"""
WITH RECURSIVE w AS MATERIALIZED (
  SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                                    '[^\x20\x09-\x0D]+') AS words
  FROM documents
), s AS MATERIALIZED (
  SELECT doc_id, list_distinct(CASE WHEN len(words) < 4 THEN [array_to_string(words, ' ')]
      ELSE list_transform(range(1, len(words) - 2), lambda i: array_to_string(words[i:i + 3], ' ')) END) AS g
  FROM w WHERE len(words) > 0
), e AS MATERIALIZED (
  SELECT doc_id, unnest(g) AS x, len(g) AS n FROM s
), l AS MATERIALIZED (
  SELECT a.doc_id AS u, b.doc_id AS v
  FROM e a JOIN e b ON a.x = b.x AND a.doc_id <> b.doc_id AND 5 * least(a.n, b.n) >= 4 * greatest(a.n, b.n)
  GROUP BY a.doc_id, b.doc_id, a.n, b.n HAVING 100 * count(*) >= 80 * (a.n + b.n - count(*))
), r AS (
  SELECT doc_id AS id, doc_id AS reached FROM w
  UNION
  SELECT r.id, l.v FROM r JOIN l ON l.u = r.reached
), c AS (SELECT id, min(reached) AS component_id FROM r GROUP BY id)
SELECT w.doc_id, coalesce(len(s.g), 0) AS n_shingles, c.component_id, w.doc_id = c.component_id AS kept
FROM w JOIN c ON c.id = w.doc_id LEFT JOIN s ON s.doc_id = w.doc_id
"""


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    return {
        "op1_packing": op1_packing,
        "op2_bpe": op2_bpe,
        "op3_language_id": op3_language_id,
        "op4_chat_format": op4_chat_format,
        "op5_quality_rules": op5_quality_rules,
        "op6_jaccard_join": op6_jaccard_join,
        "op7_syncmers": op7_syncmers,
        "op8_url_rules": op8_url_rules,
        "op9_sharding": op9_sharding,
        "op10_mil_quality": op10_mil_quality,
        "op11_whitening": op11_whitening,
        "op12_ns_kmeans": op12_ns_kmeans,
        "op13_minhash": op13_minhash,
    }


def oracle_sql() -> dict[str, str]:
    return {"op4_chat_format": CHAT_SQL, "op8_url_rules": URL_SQL, "op12_ns_kmeans": KMEANS_SQL, "op13_minhash": MINHASH_SQL}
