import random

import brute
import numpy as np
import pytest
from conftest import bag, texts_of

from lakeops.llm import suffixes


def made(seed):
    draw = random.Random(seed)

    def text(n):
        return "".join(draw.choices("abcde é", k=n))

    shared, base = [text(400) for _ in range(4)], text(2500)
    texts = ["", None, "a" * 199, "a" * 200, "a" * 900, "xy" * 600, text(3000)]
    for _ in range(40):
        texts.append(text(draw.randint(0, 300)) + draw.choice(shared)[draw.randint(0, 150) :] + text(200))
    for _ in range(15):
        near = list(base)
        for _ in range(draw.randint(0, 5)):
            near[draw.randrange(len(near))] = "Z"
        texts.append("".join(near))
    return [(i % 45, t) for i, t in enumerate(texts + [texts[10]] * 3)]


@pytest.mark.parametrize(("many", "part"), [(20_000, 1 << 21), (1, 1 << 21), (20_000, 700)])
def test_as_found_plainly(spark, monkeypatch, many, part):
    monkeypatch.setattr(suffixes, "MANY", many)
    monkeypatch.setattr(suffixes, "PART", part)
    rows = made(5)
    df = spark.createDataFrame(rows, "doc_id long, text string").repartition(4)
    assert bag(suffixes.removed_bytes(df)) == brute.repeats(rows)


def test_given_tables(documents, awkward):
    for df in (documents, awkward):
        assert bag(suffixes.removed_bytes(df)) == brute.repeats(texts_of(df))


def test_texts_without_repeats(awkward, no_documents):
    out = suffixes.without_repeats(awkward)
    assert out.columns == awkward.columns and out.count() == awkward.count()
    found = {r["doc_id"]: r for r in out.filter("doc_id is not null").collect()}
    assert found[0]["text"] is None and found[1]["text"] == ""
    assert found[12]["text"] == "" and found[12]["n_chars"] == 0
    assert found[15]["text"] == "日本語のテキスト。 もう一つ。" and found[15]["words"] == "w"
    assert suffixes.without_repeats(no_documents).count() == 0
    assert suffixes.removed_bytes(no_documents).count() == 0


def test_characters_are_not_torn(spark):
    shared = "é" * 150
    rows = [(1, "ê" + shared + "ABC"), (2, "ª" + shared + "DEF")]  # their last bytes are equal
    df = spark.createDataFrame(rows, "doc_id long, text string")
    found = {r["doc_id"]: r["text"] for r in suffixes.without_repeats(df).collect()}
    assert found[1] == "ABC" and found[2] == "DEF"


def test_order_and_common_prefixes():
    draw = random.Random(3)
    texts = [bytes(draw.choices(b"ab\0", k=draw.choice([0, 3, 70, 100, 150]))) for _ in range(300)]
    texts += [b"ab" * 60 + bytes(draw.choices(b"ab", k=20)) for _ in range(300)] + [b"ab" * 60] * 5
    order, lcp = suffixes._order(texts)
    found = [texts[i] for i in order]
    assert sorted(order.tolist()) == list(range(len(texts))) and found == sorted(texts)

    def common(a, b):
        return next((i for i, (x, y) in enumerate(zip(a, b)) if x != y), min(len(a), len(b)))

    assert lcp[1:].tolist() == [common(a, b) for a, b in zip(found, found[1:])]


def test_multikey_quicksort_orders_like_a_sort():
    draw = np.random.default_rng(3)
    for n, high in ((1, 5), (2, 1), (300, 3), (500, 10**6)):
        keys = draw.integers(0, high, (n, 4)).astype(np.uint64)
        order, group = suffixes._multikey_quicksort(keys)
        rows = [tuple(r) for r in keys[order].tolist()]
        assert rows == sorted(map(tuple, keys.tolist())) and sorted(order.tolist()) == list(range(n))
        assert [a == b for a, b in zip(group[1:], group)] == [a == b for a, b in zip(rows[1:], rows)]


def test_rows_alike_in_id_keep_what_they_do_not_share(spark):
    """Texts without an id, whose 32-bit hashes may meet: each loses its own repeats alone."""
    draw = random.Random(8)

    def prose(n):
        return " ".join(str(draw.getrandbits(40)) for _ in range(n))

    passage = prose(20)
    rows = [(None, f"{passage} {prose(3)}"), (None, prose(25)), (3, f"{prose(2)} {passage}")]
    rows += [(None, prose(30)) for _ in range(200)]
    df = spark.createDataFrame(rows, "doc_id long, text string")
    keys = suffixes._keyed(df, "doc_id", "text").select("_hash").distinct().collect()
    assert len(keys) == len(rows) and all(len(r["_hash"]) == 16 for r in keys)
    assert bag(suffixes.removed_bytes(df)) == brute.repeats(rows)
