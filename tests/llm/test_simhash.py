import random

import brute
import numpy as np
import pytest
from conftest import bag, texts_of
from pyspark.sql import functions as F

from lakeops.llm import simhash


def expected(df):
    rows = [(doc, brute.fingerprint(text)) for doc, text in texts_of(df)]
    least = brute.components(rows)
    return brute.ordered((doc, f"{fp:016x}", c) for (doc, fp), c in zip(rows, least))


def test_as_found_plainly(documents, awkward):
    for df in (documents, awkward):
        assert bag(simhash.near_duplicates(df)) == expected(df)


def test_hash_is_that_of_sql(spark):
    df = spark.createDataFrame([("a b c d",)], "t string").select(F.xxhash64("t"))
    assert simhash.fingerprint(b"A b\tc  D", 4) == df.first()[0] % (1 << 64)


@pytest.mark.parametrize("segments", [2, 3])
def test_links_join_what_is_near(spark, segments, monkeypatch):
    """Random clusters; with short entries both ways of linking are used."""
    monkeypatch.setattr(simhash, "LONG_ENTRY", 8)
    draw, prints = random.Random(segments), set()
    for _ in range(12):
        centre = draw.getrandbits(64)
        for _ in range(draw.randint(1, 25)):
            near = centre
            for b in draw.sample(range(64), draw.randint(0, 4)):
                near ^= 1 << b
            prints.add(near)
    prints = sorted(prints)
    df = spark.createDataFrame([(simhash._signed(p),) for p in prints], "fp long")
    found = simhash.links(df, 4, segments).collect()
    assert all((r["a"] ^ r["b"]).bit_count() <= 4 for r in found if (r["a"] < 0) == (r["b"] < 0))
    roots = {r["node"]: r["root"] for r in simhash.components(simhash.links(df, 4, segments)).collect()}
    classes = [roots.get(simhash._signed(p), simhash._signed(p)) for p in prints]
    plain = brute.components(list(enumerate(prints)))
    pairs = set(zip(classes, plain))
    assert len(pairs) == len(set(classes)) == len(set(plain))


def test_balls_find_every_near_pair():
    draw = random.Random(7)
    for segments in (2, 3, 5):
        balls = simhash.balls(4, segments)
        assert sum(len(f) for _, f in balls) < 1 << 20
        for _ in range(50):
            flips = sum(1 << b for b in draw.sample(range(64), 4))
            assert any(simhash._signed(flips) & mask in set(f) for mask, f in balls)


def test_components_of_a_long_chain_and_a_hub(spark):
    chain = [(i, i + 1) for i in range(100, 160)]
    hub = [(1000, 2000 + i) for i in range(300)]
    df = spark.createDataFrame(chain + hub, "a long, b long")
    roots = {r["node"]: r["root"] for r in simhash.components(df).collect()}
    assert {roots[i] for i in range(100, 161)} == {100}
    assert {roots[2000 + i] for i in range(300)} == {1000}


def test_a_tree_instead_of_all_pairs():
    values = np.array([1 << b for b in range(64)], np.uint64)
    a, b = simhash._tree(values, np.ones(64, bool), 2)
    assert len(a) == len(b) == 63
    # Those not at home meet through one that is.
    home = np.arange(64) == 5
    a, b = simhash._tree(values, home, 2)
    assert len(a) == 63 and set(a.tolist()) == {1 << 5}


def test_one_of_each_group_stays(awkward, documents, no_documents):
    for df in (documents, awkward):
        out = simhash.keep_one(df)
        assert out.columns == df.columns
        prints = [(d, brute.fingerprint(t)) for d, t in texts_of(df)]
        ids = [r["doc_id"] for r in out.collect()]
        assert len(ids) == len(set(brute.classes(prints)))
        assert set(ids) == set(brute.components(prints))
    assert simhash.keep_one(no_documents).count() == simhash.near_duplicates(no_documents).count() == 0


def test_entries_are_split_while_they_are_long(spark, monkeypatch):
    """A third of all fingerprints share a segment, far apart or near; no link is lost."""
    draw, prints = random.Random(9), set()
    for _ in range(60):
        prints.add(draw.getrandbits(64))
        crowded = draw.getrandbits(43) << 21 | 0x12345
        prints.add(crowded)
        for _ in range(draw.randint(0, 3)):
            prints.add(crowded ^ sum(1 << b for b in draw.sample(range(64), draw.randint(1, 4))))
    prints = sorted(prints)
    df = spark.createDataFrame([(simhash._signed(p),) for p in prints], "fp long")
    whole = simhash._entries(df, 4, 3).groupBy("entry").count().agg(F.max("count")).first()[0]
    monkeypatch.setattr(simhash, "SPLIT", 12)
    entries = simhash._entries(df, 4, 3)
    longest = entries.groupBy("entry").agg(F.count("*").alias("n"), F.max("home").alias("any"))
    assert longest.filter("any").agg(F.max("n")).first()[0] <= 12 < 50 < whole
    roots = {r["node"]: r["root"] for r in simhash.components(simhash.links(df, 4, 3)).collect()}
    classes = [roots.get(simhash._signed(p), simhash._signed(p)) for p in prints]
    plain = brute.components(list(enumerate(prints)))
    assert len(set(zip(classes, plain))) == len(set(classes)) == len(set(plain))
