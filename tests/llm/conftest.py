import sys
from pathlib import Path

import pytest

ROOT = str(Path(__file__).parents[2])
sys.path[:0] = [str(Path(__file__).parent)]

SMALL = "/root/testdata/sf0.001"
DOCUMENTS = "doc_id long, text string, lang string, source string, n_chars long"


@pytest.fixture(scope="session", autouse=True)
def importable(spark):
    spark.sparkContext.environment["PYTHONPATH"] = ROOT


@pytest.fixture(scope="session")
def documents(spark):
    return spark.read.parquet(f"{SMALL}/documents.parquet")


@pytest.fixture(scope="session")
def benchmark_items(spark):
    return spark.read.parquet(f"{SMALL}/benchmark.parquet")


@pytest.fixture(scope="session")
def awkward(spark):
    """Nulls in every column, empty and long texts, repeated rows, columns with clashing names."""
    prose = "the old house by the river was sold to a young couple from the city last spring "
    texts = [
        None, "", " ", "\n\n\n", "a", "É", "!!!", "one two three", prose, prose * 2, prose * 300,
        "word " * 4000, "x" * 30000, "Tab\tand\vfeed\f and   spaces\r\nnew line", "\x00 nul \x1c sep",
        "日本語のテキスト。 もう一つ。", "😀 emoji 😀 emoji 😀 emoji 😀", "All rights reserved.\nCC BY\n", "don't we'll I've 'tis ''s",
    ]
    rows = [(i, t, "en", f"s{i % 3}", len(t or "")) for i, t in enumerate(texts)]
    rows += [(8, prose, "en", "s2", len(prose))] * 2 + [(8, prose + "!", "en", "s2", 0)]
    rows += [(None, prose, None, None, None), (None, None, None, None, None), (30, prose, None, "s1", 1)]
    good = "quite another sentence of a dozen words or more that is number"
    rows += [(40 + i, f"{good} {i} of {i * i} here", "en", "good host", 1) for i in range(5)]
    rows = [(*r, "w", 1, 2, "row", 3) for r in rows]
    extra = "words string, _id int, fp int, `row` string, n_words int"
    return spark.createDataFrame(rows, f"{DOCUMENTS}, {extra}").repartition(4)


@pytest.fixture(scope="session")
def no_documents(spark):
    return spark.createDataFrame([], DOCUMENTS)


def bag(df, *columns):
    found = [tuple(r) for r in (df.select(*columns) if columns else df).collect()]
    return sorted(found, key=lambda r: [(x is not None, str(x)) for x in r])


def texts_of(df):
    return [(r["doc_id"], r["text"]) for r in df.select("doc_id", "text").collect()]
