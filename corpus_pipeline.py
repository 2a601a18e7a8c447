"""Corpus pipeline: every stage takes (spark, docs, sf_dir) and returns a DataFrame."""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from orderlake import session
from orderlake.llm import byte_bpe, common, decontaminate, langid, pii, simhash


def language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents whose language is told with enough margin."""
    session.prepare(spark)
    return langid.accepted(docs, langid.learn(docs.filter(~langid.held_out())))


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near copies."""
    session.prepare(spark)
    return simhash.deduplicate(docs)


def decontamination(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents in which no benchmark window occurs."""
    session.prepare(spark)
    return decontaminate.clean(docs, common.table(spark, sf_dir, "benchmark"))


def personal_data(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents with personal data masked."""
    session.prepare(spark)
    return pii.redact(docs)


def tokens(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token ids of each document, and its text decoded from them, beside the other columns."""
    session.prepare(spark)
    path = public_tokenizers.path("byte_bpe_multi_50k.tiktoken")
    others = [c for c in docs.columns if c != "text"]
    found = byte_bpe.encode(docs, path, public_tokenizers.PATTERN, others)
    decoded = found.columns[-1]
    return found.withColumn(decoded, F.decode(F.col(decoded), "UTF-8")).withColumnRenamed(decoded, "text")


STAGES = [
    ("language", language),
    ("near_duplicates", near_duplicates),
    ("decontamination", decontamination),
    ("personal_data", personal_data),
    ("tokens", tokens),
]
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over documents; each result is written to the shared folder and read again."""
    docs = common.table(spark, sf_dir, "documents")
    for name, step in STAGES[:-1]:
        docs = common.stage(step(spark, docs, sf_dir), name)
    return STAGES[-1][1](spark, docs, sf_dir)
