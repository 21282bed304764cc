"""A training corpus from documents, in five stages: quality rules, exact and near copies, mixing, tokens.

Each stage gets what the one before it wrote, and all but the last return the columns of documents. The last one
returns the corpus as token ids, with doc_id, lang, source, the number of tokens and digests of ids and decoded text.
"""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession

from loomspark.llm import bpe, dedup, mixing, quality, simhash
from loomspark.llm.common import checkpoint_dir, documents


def quality_rules(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return quality.cleaned(docs)


def exact_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return dedup.drop_copies(docs)


def near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return simhash.drop_near_copies(docs)


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return mixing.mixed(docs)


def encode(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return bpe.encode_texts(docs, ids=True, carry=("doc_id", "lang", "source"))


STAGES = [("quality rules", quality_rules), ("exact dedup", exact_dedup), ("simhash near dedup", near_dedup), ("mixing", mix_sources), ("bpe", encode)]

#: SQL can't express near copies, so run() is tested against a brute-force version.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The stages over documents; each result but the last is written to the shared folder and read again."""
    docs, folder = documents(spark, sf_dir), f"{checkpoint_dir(spark)}/pipeline-{uuid.uuid4()}"
    for k, (_, stage) in enumerate(STAGES):
        docs = stage(spark, docs, sf_dir)
        if k < len(STAGES) - 1:
            docs.write.parquet(f"{folder}/{k}")
            docs = spark.read.parquet(f"{folder}/{k}")
    return docs
