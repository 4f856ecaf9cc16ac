from collections import defaultdict
from itertools import permutations

import brute
from conftest import bag
from pyspark.sql import functions as F

from lakeops.llm import interaction


def fails(text):
    words = brute.VISIBLE.findall(text)
    capitals = sum("A" <= c <= "Z" for c in text)
    return {
        "A": len(words) < 50,
        "B": 100 * len(set(words)) < 65 * len(words),
        "C": 100 * capitals > 5 * len(text),
        "D": any(c in "#$%&*|" for c in text),
    }


def plain(docs, labels):
    """Every order applied to every row, one filter after the other."""
    docs = [(d, t or "", s or "") for d, t, s in docs]
    good = {d for d, quality, _ in labels if d is not None and quality == 1}
    toxic = {d for d, _, bad in labels if d is not None and bad == 1}
    least = {}
    for d, t, _ in docs:
        if d is not None:
            least[t] = min(d, least.get(t, d))
    marked = []
    for d, t, s in docs:
        found = {x for x, failed in fails(t).items() if failed}
        if d is not None and d > least[t]:
            found.add("E")
        marked.append((s, d, found))
    out, by_letter = [], defaultdict(int)
    for part in {s for s, _, _ in marked}:
        for order in permutations("ABCDE"):
            left = [(d, found) for s, d, found in marked if s == part]
            gone = []
            for step, x in enumerate(order, 1):
                now = [r for r in left if x in r[1]]
                row = (
                    sum(x in r[1] for r in gone),
                    sum(r[1] == {x} for r in left + gone),
                    sum(r[0] in good for r in now),
                    sum(r[0] in toxic for r in now),
                )
                gone += now
                left = [r for r in left if x not in r[1]]
                by_letter[part, x] += len(now)
                out.append((part, "".join(order), step, len(left), len(now), *row, x))
    return brute.ordered((*row[:-1], by_letter[row[0], row[-1]]) for row in out)


def check(df, labels):
    docs = [(r["doc_id"], r["text"], r["source"]) for r in df.select("doc_id", "text", "source").collect()]
    marks = [(r["doc_id"], r["quality"], r["toxic"]) for r in labels.collect()]
    out = interaction.audit(df, labels)
    assert out.columns == ["part", "filter_order", "step", *interaction.TOTALS, "shapley"]
    assert bag(out) == plain(docs, marks)


def test_every_order_as_applied_plainly(spark, awkward):
    rows = [(i, i % 2, i % 3) for i in range(30)]
    rows += [(1, None, 1), (1, 1, None), (None, 1, 1), (8, 1, 0), (99, 1, 1)]
    labels = spark.createDataFrame(rows, "doc_id long, quality int, toxic int")
    check(awkward, labels)
    check(awkward, labels.limit(0))


def test_given_documents(documents, spark):
    from conftest import SMALL

    check(documents.filter("source < 'src12'"), spark.read.parquet(f"{SMALL}/labels.parquet"))


def test_copies(spark):
    """One text in many rows and parts, ids that repeat, null ids, and a null and an empty text."""
    rows = [(i % 40, "same", f"s{i % 7}") for i in range(400)]
    rows += [(None, "same", "s1"), (None, None, "s1"), (3, "", "s2"), (2, None, None), (5, None, "")]
    df = spark.createDataFrame(rows, "doc_id long, text string, source string").repartition(5)
    check(df, spark.createDataFrame([(0, 1, 1), (39, 1, 0)], "doc_id long, quality int, toxic int"))


def test_no_rows(no_documents, spark):
    labels = spark.createDataFrame([], "doc_id long, quality int, toxic int")
    assert interaction.audit(no_documents, labels).count() == 0


def test_intervals_are_the_orders(spark):
    """For three letters: each order and step is in just the intervals that it should be in."""
    inside = defaultdict(set)
    for mask, kind, step, begin, end in interaction.intervals("ABC"):
        for rank in range(begin, end):
            assert rank not in inside[mask, kind, step]
            inside[mask, kind, step].add(rank)
    for rank, order in enumerate(permutations(range(3))):
        for step, x in enumerate(order, 1):
            for mask in range(8):
                before = any(mask >> y & 1 for y in order[: step - 1])
                has = bool(mask >> x & 1)
                assert (rank in inside[mask, "removed", step]) == (has and not before)
                assert (rank in inside[mask, "redundant", step]) == (has and before)
                assert (rank in inside[mask, "kept", step]) == (not has and not before)
                assert (rank in inside[mask, "unique", step]) == (mask == 1 << x)


def test_texts_are_not_moved(awkward):
    masks = interaction.masks(awkward, awkward.selectExpr("doc_id", "1 quality", "0 toxic"),
                              interaction.text_mask(F.col("_text")), 16)
    assert masks.columns == ["part", "mask", "n", "good", "toxic"]
    assert masks.agg(F.sum("n")).first()[0] == awkward.count()
