import brute
import pytest
from conftest import bag, texts_of

from lakeops.llm import winnowing

ITEMS = "item_id long, text string"


@pytest.fixture(scope="module")
def items(spark, benchmark_items):
    more = [(900, "the of"), (901, ""), (902, None), (903, "And in THE"), (None, "the"), (904, "one Two three"),
            (905, "x"), (900, "the of")]
    more.append((906, "the old house by the river was sold to a young couple from nowhere at all"))
    return benchmark_items.select("item_id", "text").unionByName(spark.createDataFrame(more, ITEMS))


def test_as_found_plainly(documents, awkward, items):
    pairs = [(r[0], r[1]) for r in items.collect()]
    for df in (documents, awkward):
        found = bag(winnowing.contamination(df, items))
        assert found == brute.contamination(texts_of(df), pairs)
        clean = [r[0] for r in found if not r[-1]]
        kept = winnowing.drop_contaminated(df, items)
        assert kept.columns == df.columns
        assert sorted(map(str, (r[0] for r in kept.select("doc_id").collect()))) == sorted(map(str, clean))


def test_every_place_of_a_window_is_found(spark):
    words = [f"w{i}" for i in range(40)]
    docs = [(i, " ".join(["z"] * i + words[i : i + 10] + ["y"] * (i % 3))) for i in range(31)]
    docs += [(100 + i, " ".join(words[i : i + 9])) for i in range(31)]
    df = spark.createDataFrame(docs, "doc_id long, text string")
    items = spark.createDataFrame([(1, " ".join(words))], ITEMS)
    found = {r["doc_id"]: r["n_hit"] for r in winnowing.contamination(df, items).collect()}
    assert all(found[i] == 10 for i in range(31)) and all(found[100 + i] == 0 for i in range(31))


def test_empty_sides(documents, no_documents, benchmark_items):
    none = benchmark_items.limit(0)
    assert winnowing.contamination(documents, none).filter("n_hit > 0 or contaminated").count() == 0
    assert winnowing.drop_contaminated(documents, none).count() == documents.count()
    assert winnowing.contamination(no_documents, benchmark_items).count() == 0
    assert winnowing.drop_contaminated(no_documents, benchmark_items).count() == 0


def test_items_without_an_id_hit_words(spark):
    df = spark.createDataFrame([(1, "a b c"), (2, "x b"), (3, None), (None, "c")], "doc_id long, text string")
    items = spark.createDataFrame([(None, "b"), (None, "c"), (7, "a"), (7, "c")], ITEMS)
    pairs = [(r[0], r[1]) for r in items.collect()]
    found = bag(winnowing.contamination(df, items))
    assert found == brute.contamination(texts_of(df), pairs)
    assert [r[:4] for r in found] == [(None, 1, 1, 2), (1, 3, 3, 2), (2, 2, 1, 1), (3, 0, 0, 0)]
    assert [r["doc_id"] for r in winnowing.drop_contaminated(df, items).collect()] == [3]


def test_a_very_long_hit_text(spark):
    """Half a million places, most of them with a mark; its cost is its length."""
    words = [f"w{i % 97}" for i in range(300_000)]
    df = spark.createDataFrame([(1, " ".join(words))], "doc_id long, text string")
    items = spark.createDataFrame([(5, " ".join(words[:60]))], ITEMS)
    row = winnowing.contamination(df, items).first()
    assert row["n_words"] == 300_000 and row["n_items"] == 1
    # Of each round of 97 words 60 are the item's.
    assert row["n_hit"] == 300_000 // 97 * 60 + min(300_000 % 97, 60)
