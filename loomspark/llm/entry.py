"""Queries of this subpackage, opN_<name>, each over its whole table, and SQL for those that SQL can express."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from loomspark.llm import bpe, chat, counts, dedup, langid, mixing, pii, quality, simhash, urls
from loomspark.llm.common import documents
from loomspark.llm.sql import ORACLE


def op1_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality.quality(documents(spark, sf_dir))


def op2_chat(spark: SparkSession, sf_dir: str) -> DataFrame:
    return chat.format_digests(chat.with_probe(spark.read.parquet(f"{sf_dir}/conversations.parquet")))


def op3_langid(spark: SparkSession, sf_dir: str) -> DataFrame:
    return langid.identify(documents(spark, sf_dir))


def op4_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return counts.length_table(counts.lengths(documents(spark, sf_dir)))


def op5_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mixing.mix(documents(spark, sf_dir)).select("doc_id", "size", "source_size", "target", "taken")


def op6_urls(spark: SparkSession, sf_dir: str) -> DataFrame:
    return urls.judge(spark.read.parquet(f"{sf_dir}/pages.parquet"))


def op7_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    return simhash.near_dedup(documents(spark, sf_dir))


def op8_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    return bpe.encode_texts(documents(spark, sf_dir))


def op9_pii(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pii.find(documents(spark, sf_dir))


def op10_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return dedup.exact_dedup(documents(spark, sf_dir))


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    own = (op1_quality, op2_chat, op3_langid, op4_token_counts, op5_mixing, op6_urls, op7_simhash, op8_bpe, op9_pii, op10_dedup)
    return {f.__name__: f for f in own}


def oracle_sql() -> dict[str, str]:
    return dict(ORACLE)
