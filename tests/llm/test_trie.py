import hashlib
import random
import zlib
from collections import Counter, defaultdict

import brute
import pytest
from conftest import SMALL, bag
from pyspark.sql import functions as F

from lakeops.llm import trie

SCHEMA = "conv_id long, turn long, role string, text string"


def plain(rows, every=100, most=6):
    convs = defaultdict(list)
    for c, t, role, text in rows:
        if c is not None:
            convs[c].append((t is not None, t or 0, (role or "").encode(), (text or "").encode()))
    whole = {}
    for c, turns in convs.items():
        turns.sort()
        h = zlib.crc32(str(c).encode()) % most
        base = c - int(c / every) * every
        whole[c] = sorted(convs.get(c - base, []))[:h] + turns[h:]
    whole = {c: tuple(t[2:] for t in turns) for c, turns in whole.items()}
    members = defaultdict(list)
    for c, seq in whole.items():
        for d in range(len(seq) + 1):
            members[seq[:d]].append(c)
    children = Counter(seq[:-1] for seq in members if seq)
    leaves, saved = Counter(), Counter()
    for seq, inside in members.items():
        worth = (len(inside) - 1) * len(seq[-1][1].decode()) if seq else 0
        for d in range(len(seq) + 1):
            saved[seq[:d]] += worth
            leaves[seq[:d]] += seq not in children
    out = []
    for seq, inside in members.items():
        ends = ",".join(str(c) for c in sorted(inside) if whole[c] == seq)
        parent = min(members[seq[:-1]]) if seq else None
        sums = (len(inside), children[seq], leaves[seq], saved[seq])
        out.append((min(inside), len(seq), parent, *sums, hashlib.sha256(ends.encode()).hexdigest()))
    return brute.ordered(out)


def check(df, **how):
    rows = [tuple(r) for r in df.select("conv_id", "turn", "role", "text").collect()]
    assert bag(trie.shared_prefixes(df, **how)) == plain(rows, **how)


def test_given_conversations(spark):
    check(spark.read.parquet(f"{SMALL}/conversations.parquet"))


@pytest.mark.parametrize("block", [3, 4096])
def test_random_conversations(spark, monkeypatch, block):
    """Few different turns, so that edges are split at all places; long ones take many blocks."""
    monkeypatch.setattr(trie, "BLOCK", block)
    draw, rows = random.Random(block), []
    for c in range(120):
        last = draw.choice([0, 1, 3, 8, 30])
        rows += [(3 * c, t, draw.choice("ua"), draw.choice(["x", "yy", "é"])) for t in range(last)]
    rows += [(500 + c, t, "u", "same") for c in range(60) for t in range(12 if c % 5 else 20)]
    df = spark.createDataFrame(rows, SCHEMA)
    check(df.repartition(7))
    check(df, every=10, most=20)


def test_awkward_rows(spark):
    """Nulls, ties, repeated rows, negative ids, a conversation that is lost, a clashing column."""
    rows = [(1, None, None, None), (1, None, "u", None), (1, 0, None, "x"), (1, 0, None, "x"), (1, 0, "a", "x")]
    rows += [(None, 1, "u", "x"), (100, 1, "u", "x"), (150, 1, "u", "y"), (-7, 1, "u", "z"), (-250, 0, "u", "z")]
    rows += [(c, t, "u", "x") for c in range(300, 340) for t in range(c % 4 + 1)]
    df = spark.createDataFrame([(*r, "s", 1) for r in rows], f"{SCHEMA}, s string, _block int")
    check(df)
    assert trie.shared_prefixes(df.filter("conv_id IS NULL")).count() == 0
    turnless = df.filter("conv_id IN (310, 317)")
    check(turnless)


def test_numbers_do_not_depend_on_partitions(spark):
    df = spark.range(1000).select(F.lit(1).alias("g"), F.pmod(F.xxhash64("id"), F.lit(300)).alias("k"))
    found = trie.numbered(df.repartition(9), "g", ["k"]).orderBy("pos").collect()
    assert [r["pos"] for r in found] == list(range(1, 1001))
    assert [r["k"] for r in found] == sorted(r["k"] for r in found)


def test_fattest(spark):
    pairs = [(l, r) for l in range(40) for r in range(l + 1, 40)] + [(0, 2**40), (2**40 - 1, 2**40 + 3)]
    df = spark.createDataFrame(pairs, "l long, r long").select("l", "r", trie._fattest("l", "r").alias("f"))
    for low, high, f in df.collect():
        if high < 100:
            assert f == max(range(low + 1, high + 1), key=lambda x: (x & -x, -x))
        else:
            assert f == 2**40
