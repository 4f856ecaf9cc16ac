"""Documents made ready for training, stage by stage.

Every stage takes all that the one before it kept, written as Parquet and read again, and
returns the columns of `documents`; the last returns the tokens of each text.
"""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession

from lakeops.llm import bpe, quality, simhash, suffixes, winnowing
from lakeops.llm.common import stored, table
from lakeops.llm.queries import VOCABULARY, importable


def quality_rules(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the rules or the verdict on their host reject go."""
    return quality.keep_good(docs)


def simhash_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of each group of near duplicates the document with the smallest id stays."""
    return simhash.keep_one(docs, shingle=4, distance=4)


def suffix_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Strings of 200 bytes that stand anywhere else are cut out of the texts."""
    return suffixes.without_repeats(docs)


def decontaminate(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that share a window with the benchmark go."""
    return winnowing.drop_contaminated(docs, table(spark, sf_dir, "benchmark"))


def tokenize(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Number and digest of the tokens of each text, and of what they decode to."""
    return bpe.digests(docs, public_tokenizers.path(VOCABULARY))


STAGES = [
    ("quality rules", quality_rules),
    ("simhash dedup", simhash_dedup),
    ("suffix dedup", suffix_dedup),
    ("decontamination", decontaminate),
    ("tokens", tokenize),
]

# SimHash components, suffix dedup and BPE are beyond SQL.
ORACLE_SQL = None


@importable
def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = stored(stage(spark, docs, sf_dir), name.replace(" ", "_"))
    return STAGES[-1][1](spark, docs, sf_dir)
