"""Uniform shuffle of rows into shards of exact sizes.

The counts that a uniform shuffle sends from each block of rows to each shard follow the
multivariate hypergeometric law with the block sizes and the shard sizes as margins. They
are drawn first; then each block permutes its own rows and deals them out by these counts,
and each shard permutes what it gets. Only block sizes and counts pass through the driver:
one block for every `BLOCK_ROWS` rows.

The permutations order rows by a hash of their values, their number among equal rows and a seed,
so a task that runs again after a lost executor deals the same rows to the same places. Blocks are
hash classes of the same, so no block depends on how files were split, and equal rows, however
many, are spread over all blocks. They are numbered by counting them, not by sorting.

Defined cases: null texts have size 1; null ids are values like others; rows that repeat are
dealt out one by one; fewer rows than shards leave shards empty; an empty table gives none.
"""

from __future__ import annotations

import json
import math
import random

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from lakeops.llm.common import stored

BLOCK_ROWS = 1_000_000
MIN_BLOCKS = 64
EQUAL_ROWS = 10_000


def hypergeometric(rng: random.Random, good: int, bad: int, draws: int) -> int:
    """How many of `draws` from `good` + `bad` items, without return, are good.

    Inversion from the mode outwards: as many steps as the deviation is large, at most.
    """
    low, high = max(0, draws - bad), min(good, draws)
    if low >= high:
        return low
    mode = min(high, max(low, (draws + 1) * (good + 1) // (good + bad + 2)))

    def log_choose(n: int, k: int) -> float:
        return math.lgamma(n + 1) - math.lgamma(k + 1) - math.lgamma(n - k + 1)

    start = math.exp(
        log_choose(good, mode) + log_choose(bad, draws - mode) - log_choose(good + bad, draws)
    )
    u = rng.random() - start
    if u < 0:
        return mode
    up, p_up, down, p_down = mode, start, mode, start
    while up < high or down > low:
        if up < high:
            p_up *= (good - up) * (draws - up) / ((up + 1) * (bad - draws + up + 1))
            up += 1
            u -= p_up
            if u < 0:
                return up
        if down > low:
            p_down *= down * (bad - draws + down) / ((good - down + 1) * (draws - down + 1))
            down -= 1
            u -= p_down
            if u < 0:
                return down
    return mode  # what rounding left over


def shard_sizes(rows: int, shards: int) -> list[int]:
    """Sizes that differ by one at most."""
    return [rows // shards + (s < rows % shards) for s in range(shards)]


def communication_matrix(blocks: list[int], shards: list[int], seed: int) -> list[list[int]]:
    """Rows from each block to each shard; margins are `blocks` and `shards`."""
    rng, left, rows = random.Random(seed), list(shards), []
    for block in blocks:
        row, draws, total = [], block, sum(left)
        for s, room in enumerate(left):
            got = hypergeometric(rng, room, total - room, draws)
            total -= room
            draws -= got
            left[s] -= got
            row.append(got)
        rows.append(row)
    return rows


def _running(counts: list[int]) -> list[int]:
    out = [0]
    for c in counts:
        out.append(out[-1] + c)
    return out


def _numbers(values: list[list[int]]) -> Column:
    return F.from_json(F.lit(json.dumps(values)), "array<array<bigint>>")


def _counts(df: DataFrame, *by: str) -> dict[tuple, int]:
    """Sizes of a number of groups that the row count bounds (see `BLOCK_ROWS`)."""
    return {tuple(r[:-1]): r[-1] for r in df.groupBy(*by).count().collect()}


def _numbered(df: DataFrame) -> DataFrame:
    """`df` with `_k`, a number from 0 among rows that are equal."""
    values = [F.col(f"`{c}`") for c in df.columns]
    counted = df.groupBy(*values).agg(F.count("*").alias("_n"))
    first = F.explode(F.sequence(F.lit(0).cast("long"), F.col("_n") - 1, F.lit(EQUAL_ROWS).cast("long")))
    # Pieces of a number of equal rows are made into rows each in its own task.
    pieces = counted.select("*", first.alias("_from")).repartition(*values, "_from")
    upto = F.least(F.col("_n"), F.col("_from") + EQUAL_ROWS) - 1
    return pieces.select(*values, F.explode(F.sequence("_from", upto)).alias("_k"))


def shuffle_into_shards(df: DataFrame, shards: int = 8, seed: int = 0) -> DataFrame:
    """`df` with `shard` and `slot`, gapless from 0 in each shard; sizes are one apart at most.

    `df` should hold what identifies a row and little else: all of its columns are moved.
    """
    columns = df.columns
    df = stored(_numbered(df), "numbered")
    values = [F.col(f"`{c}`") for c in df.columns]
    rows = df.count()
    n_blocks = max(MIN_BLOCKS, math.ceil(rows / BLOCK_ROWS))
    first, second = F.xxhash64(F.lit(seed), *values), F.xxhash64(F.lit(seed + 1), *values)
    dealt = df.select(*values, first.alias("_p"), F.pmod(first, F.lit(n_blocks)).alias("_b"))
    sizes = _counts(dealt, "_b")
    blocks = [sizes.get((b,), 0) for b in range(n_blocks)]
    matrix = communication_matrix(blocks, shard_sizes(rows, shards), seed)
    ends = _numbers([_running(row)[1:] for row in matrix])

    local = Window.partitionBy("_b").orderBy("_p", *values)
    rank = F.row_number().over(local) - 1
    dealt = dealt.select(*values, "_b", rank.alias("_r"), F.get(ends, F.col("_b")).alias("_e"))
    shard = F.size(F.filter("_e", lambda end: end <= F.col("_r"))).cast("int")
    parts = max(1, n_blocks // shards)
    sent = dealt.select(
        *values,
        shard.alias("shard"),
        second.alias("_p"),
        F.pmod(second, F.lit(parts)).alias("_b"),
    )
    sent = stored(sent, "shards")

    sizes = _counts(sent, "shard", "_b")
    starts = _numbers(
        [_running([sizes.get((s, b), 0) for b in range(parts)])[:-1] for s in range(shards)]
    )
    again = Window.partitionBy("shard", "_b").orderBy("_p", *values)
    start = F.get(F.get(starts, F.col("shard")), F.col("_b").cast("int"))
    slot = start + F.row_number().over(again) - 1
    return sent.select(*values[: len(columns)], "shard", slot.cast("long").alias("slot"))


def shard_documents(df: DataFrame, shards: int = 8, seed: int = 0) -> DataFrame:
    """Each document's size, checksum and place; the texts themselves are not moved."""
    body = F.coalesce(F.col("text"), F.lit(""))
    light = df.select(
        "doc_id",
        (F.octet_length(body) + 1).cast("long").alias("size"),
        F.crc32(body.cast("binary")).alias("text_crc32"),
    )
    out = shuffle_into_shards(light, shards, seed)
    return out.select(
        "doc_id",
        "size",
        "text_crc32",
        F.lit("rows").alias("law"),
        "shard",
        "slot",
        F.lit(None).cast("int").alias("grown_shard"),
    )
