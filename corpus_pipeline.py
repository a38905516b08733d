"""A corpus pipeline: quality, language, near duplicates, packing.

Each stage is a function (spark, docs, sf_dir) -> DataFrame. ``run`` writes every
stage's rows as Parquet in the shared folder and reads them again as the next
stage's documents. All stages but the last return the columns of ``documents``.
"""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from quire.llm import language_id, mil_quality
from quire.llm.common import documents, fresh_name, staged
from quire.llm.jaccard_join import Rule, keep_one
from quire.llm.packing import pack_documents
from quire.plans.common import load

TOKENIZER = "byte_bpe_50k.json"
NEAR_DUPLICATE = Rule(words=5, num=4, den=5)

# Models and packing are no SQL; the stages are tested against brute force.
ORACLE_SQL = None


def quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the passage classifier predicts to be good (score >= 0.5)."""
    model = mil_quality.fit(docs, load(spark, sf_dir, "labels"))
    name = fresh_name("score", docs.columns)
    return mil_quality.score(docs, model, docs.columns, name=name).filter(F.col(name) >= 0.5).select(docs.columns)


def language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents in the learned languages, also in several of them; those without
    letters go, and those that all samples together explain no better than the
    limits allow which held-out labelled texts set (``language_id.limits``)."""
    samples = language_id.learn(docs)
    rates, besides = language_id.limits(docs, samples)
    prefix = "found_"
    while any(c.lower().startswith(prefix) for c in docs.columns):
        prefix = "_" + prefix
    found = language_id.predict(docs, samples, docs.columns, prefix=prefix, mixed=True)
    lang, phrases, symbols = (F.col(prefix + c) for c in ("lang_pred", "phrases", "n_symbols"))
    rate = F.lit(float("inf"))
    for name, value in rates.items():
        rate = F.when(lang == name, F.lit(value)).otherwise(rate)
    known = phrases <= rate * symbols + F.lit(besides)
    return found.filter((lang != language_id.UNDETERMINED) & known).select(docs.columns)


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near duplicates."""
    return keep_one(docs, NEAR_DUPLICATE).select(docs.columns)


def packing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pieces of all documents left, in windows of 2048 tokens."""
    return pack_documents(docs, public_tokenizers.path(TOKENIZER)).withColumn("ids_crc32", F.crc32("ids")).select(
        "doc_id", "start", "length", "ids_crc32", "doc_tokens", "sequence_id", "offset")


STAGES = [("quality", quality), ("language", language), ("near_duplicates", near_duplicates), ("packing", packing)]


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = documents(spark, sf_dir)
    for name, stage in STAGES:
        docs = staged(stage(spark, docs, sf_dir), f"pipeline-{name}")
    return docs
