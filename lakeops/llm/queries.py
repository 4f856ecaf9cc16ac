"""The operators over the given tables, one query each."""

from __future__ import annotations

from collections.abc import Callable
from functools import wraps
from pathlib import Path

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from lakeops.llm import (
    bpe,
    chat,
    interaction,
    jaccard,
    language,
    licenses,
    pages,
    quality,
    sharding,
    simhash,
    suffixes,
    trie,
    winnowing,
)
from lakeops.llm.common import table
from lakeops.llm.oracle import ORACLE  # noqa: F401

VOCABULARY = "byte_bpe_50k.tiktoken"
ROOT = str(Path(__file__).parents[2])
Query = Callable[[SparkSession, str], DataFrame]


def importable(query: Query) -> Query:
    """Workers that do not have this library installed find it where the driver has it."""

    @wraps(query)
    def run(spark: SparkSession, sf_dir: str) -> DataFrame:
        environment = spark.sparkContext.environment
        paths = environment.get("PYTHONPATH", "").split(":")
        if ROOT not in paths:
            environment["PYTHONPATH"] = ":".join([ROOT, *filter(None, paths)])
        return query(spark, sf_dir)

    return run


def op1_licenses(spark: SparkSession, sf_dir: str) -> DataFrame:
    return licenses.scan(table(spark, sf_dir, "documents"))


def op2_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality.judge(table(spark, sf_dir, "documents"))


def op3_sharding(spark: SparkSession, sf_dir: str) -> DataFrame:
    return sharding.shard_documents(table(spark, sf_dir, "documents"), shards=8, seed=20)


def op4_chat(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = table(spark, sf_dir, "conversations").select("conv_id", "turn", "role", "text")
    said = "</s>[INST] ok [/INST]"
    extra = spark.range(2).select(
        F.lit(-1).cast("long").alias("conv_id"),
        F.col("id").alias("turn"),
        F.when(F.col("id") == 0, "user").otherwise("assistant").alias("role"),
        F.lit(said).alias("text"),
    )
    every = rows.unionByName(extra)
    parts = chat.text_parts(F.col("text"))
    turns = chat.format_turns(every, F.col("conv_id"), F.col("turn"), F.col("role"), parts)
    return chat.digests(turns)


def op5_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    return winnowing.contamination(
        table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark")
    )


def op6_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    return bpe.digests(table(spark, sf_dir, "documents"), public_tokenizers.path(VOCABULARY))


def op7_pages(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pages.main_text(table(spark, sf_dir, "pages"))


def op8_suffixes(spark: SparkSession, sf_dir: str) -> DataFrame:
    return suffixes.removed_bytes(table(spark, sf_dir, "documents"))


def op9_language(spark: SparkSession, sf_dir: str) -> DataFrame:
    return language.predictions(table(spark, sf_dir, "documents"))


def op10_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    return simhash.near_duplicates(table(spark, sf_dir, "documents"), shingle=4, distance=4)


def op11_interaction(spark: SparkSession, sf_dir: str) -> DataFrame:
    return interaction.audit(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


def op12_jaccard(spark: SparkSession, sf_dir: str) -> DataFrame:
    return jaccard.near_sets(table(spark, sf_dir, "documents"), size=3, percent=90)


def op13_trie(spark: SparkSession, sf_dir: str) -> DataFrame:
    return trie.shared_prefixes(table(spark, sf_dir, "conversations"), every=100, most=6)


QUERIES: dict[str, Query] = {
    f.__name__: importable(f)
    for f in (
        op1_licenses,
        op2_quality,
        op3_sharding,
        op4_chat,
        op5_decontamination,
        op6_bpe,
        op7_pages,
        op8_suffixes,
        op9_language,
        op10_simhash,
        op11_interaction,
        op12_jaccard,
        op13_trie,
    )
}
