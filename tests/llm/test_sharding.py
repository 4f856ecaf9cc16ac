import random
import zlib
from collections import Counter

import pytest
from conftest import texts_of
from pyspark.sql import functions as F

from lakeops.llm import sharding


def shards_of(df, n=8, seed=3):
    return sharding.shard_documents(df, n, seed).collect()


def test_sizes_slots_and_values(documents, awkward):
    for df in (documents, awkward):
        rows, n = shards_of(df), df.count()
        sizes = Counter(r["shard"] for r in rows)
        assert len(rows) == n and max(sizes.values()) - min(sizes.values()) <= 1
        for s, size in sizes.items():
            assert sorted(r["slot"] for r in rows if r["shard"] == s) == list(range(size))
        got = Counter((r["doc_id"], r["size"], r["text_crc32"]) for r in rows)
        data = [(d, (t or "").encode()) for d, t in texts_of(df)]
        assert got == Counter((d, len(t) + 1, zlib.crc32(t)) for d, t in data)


def test_same_seed_same_places_however_files_are_split(documents):
    once = sorted(map(tuple, shards_of(documents.repartition(7))), key=str)
    assert once == sorted(map(tuple, shards_of(documents.coalesce(1))), key=str)
    assert once != sorted(map(tuple, shards_of(documents, seed=4)), key=str)


def test_few_and_no_rows(documents, no_documents):
    assert sorted(r["shard"] for r in shards_of(documents.limit(3))) == [0, 1, 2]
    assert shards_of(no_documents) == []


def test_draws_follow_the_hypergeometric_law():
    rng = random.Random(1)
    for good, bad, draws in ((7, 12, 6), (50, 3, 20), (5, 5, 10), (0, 4, 2), (300, 500, 90)):
        n = 4000
        found = [sharding.hypergeometric(rng, good, bad, draws) for _ in range(n)]
        assert all(max(0, draws - bad) <= x <= min(good, draws) for x in found)
        total, p = good + bad, good / (good + bad)
        var = draws * p * (1 - p) * (total - draws) / max(1, total - 1)
        mean = sum(found) / n
        assert abs(mean - draws * p) <= 5 * (var / n) ** 0.5 + 1e-9
        spread = sum((x - mean) ** 2 for x in found) / n
        assert spread == pytest.approx(var, rel=0.15, abs=1e-9)


def test_matrix_has_both_margins():
    blocks, shards = [5, 0, 17, 40, 1], sharding.shard_sizes(63, 8)
    matrix = sharding.communication_matrix(blocks, shards, 9)
    assert [sum(r) for r in matrix] == blocks and [sum(c) for c in zip(*matrix)] == shards


def test_neighbours_part(documents):
    """Rows that stand together in the table are spread over all shards about evenly."""
    rows = sorted(shards_of(documents), key=lambda r: r["doc_id"])
    pairs = sum(a["shard"] == b["shard"] for a, b in zip(rows, rows[1:]))
    assert pairs < 0.25 * len(rows)


def plain_shuffle(df, shards, seed):
    """The same shuffle over a list, with the draws of the library and the hashes of Spark."""
    numbered, seen = [], Counter()
    for values in sorted(map(tuple, df.collect()), key=str):
        numbered.append((*values, seen[values]))
        seen[values] += 1
    spark = df.sparkSession
    held = spark.createDataFrame(numbered, f"{df._jdf.schema().toDDL()}, _k long")
    hashes = [F.xxhash64(F.lit(s), *held.columns) for s in (seed, seed + 1)]
    rows = [tuple(r) for r in held.select("*", *hashes).collect()]
    n = max(sharding.MIN_BLOCKS, -(-len(rows) // sharding.BLOCK_ROWS))
    blocks = [[r for r in rows if r[-2] % n == b] for b in range(n)]
    sizes = sharding.shard_sizes(len(rows), shards)
    matrix = sharding.communication_matrix([len(b) for b in blocks], sizes, seed)
    dealt = [[] for _ in range(shards)]
    for block, counts in zip(blocks, matrix):
        block.sort(key=lambda r: (r[-2], r[:-2]))
        for s, count in enumerate(counts):
            dealt[s] += block[:count]
            del block[:count]
    parts, out = max(1, n // shards), []
    for s, own in enumerate(dealt):
        own.sort(key=lambda r: (r[-1] % parts, r[-1], r[:-2]))
        out += [(*r[:-3], s, slot) for slot, r in enumerate(own)]
    return sorted(out, key=str)


def test_same_as_the_plain_shuffle(spark, documents):
    light = documents.select("doc_id", F.crc32(F.col("text").cast("binary")).alias("c"))
    equal = light.unionAll(spark.range(700).select(F.lit(7).cast("long"), F.lit(1).cast("long")))
    for df in (light, equal):
        found = sharding.shuffle_into_shards(df, 5, 11).collect()
        assert sorted(map(tuple, found), key=str) == plain_shuffle(df, 5, 11)


def test_equal_rows_are_spread(spark, monkeypatch):
    """A table of one row many times: its copies lie in all blocks and all shards."""
    monkeypatch.setattr(sharding, "EQUAL_ROWS", 100)
    df = spark.range(5000).select(F.lit(None).cast("long").alias("doc_id"), F.lit("same").alias("text"))
    numbered = sharding._numbered(df.select("doc_id"))
    assert sorted(r["_k"] for r in numbered.collect()) == list(range(5000))
    rows = sharding.shard_documents(df, 8, 3).collect()
    assert set(Counter(r["shard"] for r in rows).values()) == {625}
    assert all(sorted(r["slot"] for r in rows if r["shard"] == s) == list(range(625)) for s in range(8))
