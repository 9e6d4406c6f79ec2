"""The corpus pipeline: STAGES in order, each over the documents that its predecessor kept.

Each stage takes (spark, docs, sf_dir) and returns a DataFrame, written as Parquet and read again
as the next stage's docs. All but the last return the columns of documents. Both classifiers are
fitted on a bounded sample of the labelled rows that a stage is given.

Defined results, stage by stage: null and empty texts are not toxic, are scored for quality like any
other, are copies of nothing, and are left out of the mix; rows with a null doc_id are kept by the first
two stages, and by the third as one document of their group; rows that repeat are one group of copies,
whose rows of the least doc_id all stay, and share the mix evenly; ties in the order of the mix go by
doc_id; an empty table gives no rows in any stage; columns beyond those of documents, whatever their
names, are handed on up to the last stage. The mix gives rows in the order of its slots, which Parquet
keeps within and among its files.
"""

from __future__ import annotations

import uuid

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession

from epochal.llm import bpe, common, mixing, neardup, quality, toxicity


def drop_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the toxicity score does not reject."""
    return toxicity.keep(docs, toxicity.fit(docs, common.table(spark, sf_dir, "labels")))


def keep_good(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the quality score does not reject."""
    return quality.keep(docs, quality.fit(docs, common.table(spark, sf_dir, "labels")))


def dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near copies: five words, similarity of 0.8 or more."""
    return neardup.keep(docs)


def mix(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents as often as the mix of sources walks over them."""
    return mixing.apply(docs)


def encode(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """doc_id, n_tokens and digests of the ids and of the decoded bytes of each document."""
    return bpe.digests(docs, public_tokenizers.path("byte_bpe_multi_50k.tiktoken"), public_tokenizers.PATTERN)


STAGES = [("toxicity", drop_toxic), ("quality", keep_good), ("neardup", dedup), ("mixing", mix), ("bpe", encode)]

#: The classifiers of the first two stages are fitted, which SQL can't express.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Applies STAGES to documents; what a stage returns goes through the shared checkpoint folder."""
    common.prepare(spark)
    docs = common.table(spark, sf_dir)
    base = f"{common.checkpoint_dir(spark).rstrip('/')}/pipeline-{uuid.uuid4().hex}"
    for name, stage in STAGES[:-1]:
        stage(spark, docs, sf_dir).write.parquet(f"{base}/{name}")
        docs = spark.read.parquet(f"{base}/{name}")
    return STAGES[-1][1](spark, docs, sf_dir)
