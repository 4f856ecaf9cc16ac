import random

import brute
import numpy as np
from conftest import bag, texts_of

from lakeops.llm import jaccard


def shingles(text, size=3):
    words = brute.VISIBLE.findall(brute.lower(text))
    if not words:
        return frozenset()
    size = min(size, len(words))
    return frozenset(tuple(words[i : i + size]) for i in range(len(words) - size + 1))


def plain(docs, percent=90):
    sets = [shingles(t) for _, t in docs]
    root = list(range(len(docs)))

    def find(i):
        while root[i] != i:
            i = root[i]
        return i

    for i, a in enumerate(sets):
        for j in range(i if a else 0):
            b = sets[j]
            if b and 100 * len(a & b) >= percent * len(a | b):
                root[find(i)] = find(j)
    least = {}
    for i, (doc, _) in enumerate(docs):
        if doc is not None:
            least[find(i)] = min(doc, least.get(find(i), doc))
    return brute.ordered((d, len(s), least.get(find(i))) for i, ((d, _), s) in enumerate(zip(docs, sets)))


def check(df, percent=90):
    assert bag(jaccard.near_sets(df, percent=percent)) == plain(texts_of(df), percent)


def edited(draw, words, edits):
    words = list(words)
    for _ in range(edits):
        words[draw.randrange(len(words))] = f"w{draw.randrange(10**6)}"
    return " ".join(words)


def families(spark, seed, copies, most):
    """Texts around a few that share a long passage, each copy with some words changed."""
    draw, rows = random.Random(seed), []
    passage = [f"p{i}" for i in range(80)]
    for f in range(3):
        base = passage + [f"f{f}w{i}" for i in range(draw.randint(20, 150))]
        rows += [edited(draw, base, draw.randint(0, most)) for _ in range(copies)]
    draw.shuffle(rows)
    rows = [(1000 - i, t) for i, t in enumerate(rows)]
    return spark.createDataFrame(rows, "doc_id long, text string").repartition(4)


def test_given_and_awkward_texts(documents, awkward):
    check(documents)
    check(awkward)


def test_families(spark):
    check(families(spark, 1, 40, 6))
    check(families(spark, 2, 25, 12), percent=75)


def test_short_texts(spark):
    draw = random.Random(3)
    rows = [(i, " ".join(draw.choice("abcd") for _ in range(draw.randint(0, 14)))) for i in range(150)]
    check(spark.createDataFrame(rows, "doc_id long, text string"), percent=60)


def test_links_outside_the_pivots_component(spark, monkeypatch):
    """Two groups in one posting list, and a chain: later pairs are needed to join what is linked."""
    found = []
    real = jaccard.other_pairs
    monkeypatch.setattr(jaccard, "other_pairs", lambda *a: found.append(real(*a)) or found[-1])
    words = [f"w{i}" for i in range(120)]
    rows = []
    for i in range(12):
        chain = [f"x{j}" if j < 4 * i else w for j, w in enumerate(words)]
        rows.append((i, " ".join(chain)))
    check(spark.createDataFrame(rows, "doc_id long, text string"))
    assert found[0].count() > 0


def test_no_documents(no_documents):
    assert jaccard.near_sets(no_documents).count() == 0


def test_no_similar_pair_is_filtered():
    """The first common token of similar sets is in both prefixes, whatever the order."""
    draw = random.Random(5)
    for _ in range(200):
        common = draw.sample(range(10**6), draw.randint(1, 60))
        a = common + draw.sample(range(10**6, 2 * 10**6), draw.randint(0, 4))
        b = common + draw.sample(range(2 * 10**6, 3 * 10**6), draw.randint(0, 4))
        if 100 * len(common) < 90 * len({*a, *b}):
            continue
        order = {t: draw.random() for t in {*a, *b}}
        heads = [set(sorted(s, key=order.get)[: jaccard.prefix_size(len(s), 90)]) for s in (a, b)]
        assert heads[0] & heads[1]


def test_hashes_tell_shingles_apart():
    texts = ["a b c", "a b d", "b a c", "ab c", "a bc", "a b", "a", "abc", "a b c d"]
    found = [set(jaccard.shingles(t.encode(), 3).tolist()) for t in texts]
    assert len(set().union(*found)) == 9
    assert jaccard.shingles(b"A b\tC", 3) == jaccard.shingles(b"a  B c\n", 3)
    assert jaccard.shingles(b" \n", 3).dtype == np.uint64
