import brute
from conftest import bag, texts_of

from lakeops.llm import quality


def expected(df):
    return brute.ordered((doc, *brute.quality(text)) for doc, text in texts_of(df))


COLUMNS = ("doc_id", *quality.COUNTS, "base_failed")


def test_counts_as_counted_plainly(documents, awkward):
    for df in (documents, awkward):
        assert bag(quality.judge(df), *COLUMNS) == expected(df)


def test_a_bad_host_loses_all_documents_and_a_small_one_does_not(spark):
    good, bad = "this is a plain text of more than ten words in all of it", "no"
    rows = [(i, bad, "bad") for i in range(90)] + [(90 + i, good, "bad") for i in range(10)]
    rows += [(200 + i, good, f"g{i % 20}") for i in range(400)]
    rows += [(900, bad, "tiny"), (901, good, "tiny"), (902, good, None)]
    df = spark.createDataFrame(rows, "doc_id long, text string, source string")
    kept = {r[0] for r in quality.judge(df).filter("kept").select("doc_id").collect()}
    assert not kept & set(range(100))
    assert {901, 902} | set(range(200, 600)) <= kept
    assert bag(quality.keep_good(df), "doc_id") == [(i,) for i in sorted(kept, key=str)]


def test_shares_are_shrunk_to_the_prior(spark):
    rows = [("a", i < 3) for i in range(4)] + [("b", i < 10) for i in range(100)]
    df = spark.createDataFrame(rows, "host string, rule_failed boolean")
    m, v = (0.75 + 0.1) / 2, ((0.75 - 0.425) ** 2 + (0.1 - 0.425) ** 2) / 2
    c = max(1.0, m * (1 - m) / v - 1)
    found = {r["host"]: r["share"] for r in quality.host_verdicts(df, "host").collect()}
    assert abs(found["a"] - (3 + m * c) / (4 + c)) < 1e-12
    assert abs(found["b"] - (10 + m * c) / (100 + c)) < 1e-12


def test_columns_stay_and_empty_tables_pass(awkward, no_documents):
    assert quality.keep_good(awkward).columns == awkward.columns
    assert quality.judge(no_documents).count() == quality.keep_good(no_documents).count() == 0
