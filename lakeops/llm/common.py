"""Helpers that the operators of this folder share."""

from __future__ import annotations

import re
from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from lakeops.session import work_folder

# Separators of words, as Java and Python regular expressions.
SPACE = r"[\x20\x09-\x0D]+"
NON_WORD = r"[\x00-\x2F\x3A-\x60\x7B-\x7F]+"
# One or more bytes of a word in lower-cased UTF-8; all bytes over 0x7F belong to words.
WORD_BYTES = re.compile(rb"[^\x00-\x2f\x3a-\x60\x7b-\x7f]+")

UPPER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def stored(df: DataFrame, name: str) -> DataFrame:
    """`df` written to the shared folder and read back: lineage is cut, no executor holds it."""
    path = work_folder(df.sparkSession, name)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def let(value: Column, body: Callable[[Column], Column]) -> Column:
    """`body` of a value that is computed once, though `body` may use it in inner lambdas."""
    return F.get(F.transform(F.array(value), body), F.lit(0))


def ascii_lower(text: Column) -> Column:
    """`text` with A-Z in lower case. Texts of ASCII alone take the built-in function's fast way."""
    plain = F.octet_length(text) == F.length(text)
    return F.when(plain, F.lower(text)).otherwise(F.translate(text, UPPER, UPPER.lower()))


def split_words(text: Column, separators: str) -> Column:
    """Words of a text; none of a null text."""
    return F.array_remove(F.split(F.coalesce(text, F.lit("")), separators), "")


def window_hashes(items: Column, width: int) -> Column:
    """A 64-bit hash of every window of `width` items, in order; `items` is a column by name.

    Windows double in width by pairing hashes with later ones, so each takes a few steps.
    """
    if width == 1:
        return F.transform(items, lambda a: F.xxhash64(a))

    def pair(a: Column, b: Column) -> Column:
        return F.xxhash64(a, b)

    def grow(found: Column, have: int) -> Column:
        if have == width:
            return F.slice(found, 1, F.greatest(F.size(items) - width + 1, F.lit(0)))
        by = min(have, width - have)
        if by == have:
            return let(found, lambda x: grow(F.zip_with(x, _from(x, by), pair), 2 * have))
        if by == 1:
            return grow(F.zip_with(found, _from(items, have), pair), width)
        return let(found, lambda x: grow(F.zip_with(x, _from(x, by), pair), have + by))

    return grow(F.zip_with(items, _from(items, 1), pair), 2)


def _from(items: Column, start: int) -> Column:
    return F.slice(items, start + 1, F.size(items))


def packed(df: DataFrame, name: str = "row") -> DataFrame:
    """All columns in one struct, so that no name of theirs can clash with an operator's."""
    return df.select(F.struct(*[F.col(f"`{c}`") for c in df.columns]).alias(name))
