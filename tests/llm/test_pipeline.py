import brute
import corpus_pipeline
import public_tokenizers
import pytest
import tiktoken
from conftest import SMALL

import __spark_entry__ as entry
from lakeops.llm import bpe, quality


def plain(docs, items):
    """The stages one after the other, on lists."""
    docs = [(d, t) for d, t in docs if not brute.quality(t)[-1]]
    ids = brute.components([(d, brute.fingerprint(t)) for d, t in docs])
    docs = [(d, t) for (d, t), least in zip(docs, ids) if d == least]
    docs = [(d, cut) for (d, _), cut in zip(docs, remainders([t for _, t in docs]))]
    dirty = {r[0] for r in brute.contamination(docs, items) if r[-1]}
    docs = [(d, t) for d, t in docs if d not in dirty]
    path = public_tokenizers.path("byte_bpe_50k.tiktoken")
    library = tiktoken.Encoding(
        "own", pat_str=public_tokenizers.PATTERN, mergeable_ranks=bpe.load_ranks(path), special_tokens={}
    )
    out = []
    for d, t in docs:
        ids = library.encode_ordinary(t)
        out.append((d, len(ids), brute.sha(b"".join(i.to_bytes(4, "little") for i in ids)), brute.sha(t)))
    return brute.ordered(out)


def remainders(texts, length=200):
    data = [t.encode() for t in texts]
    times = {}
    for t in data:
        for i in range(len(t) - length + 1):
            times[t[i : i + length]] = times.get(t[i : i + length], 0) + 1
    for t in data:
        keep = bytearray(b"\1" * len(t))
        for i in range(len(t) - length + 1):
            if times[t[i : i + length]] > 1:
                keep[i : i + length] = bytes(length)
        yield bytes(b for b, k in zip(t, keep) if k).decode(errors="ignore")


def test_as_the_plain_stages(spark, documents, benchmark_items):
    # No host is rejected here, so the first stage is the rules alone.
    assert quality.judge(documents).filter("host_rejected").count() == 0
    docs = [(r["doc_id"], r["text"]) for r in documents.collect()]
    expected = plain(docs, [(r[0], r[1]) for r in benchmark_items.collect()])
    found = entry.queries()["pipeline"](spark, SMALL).collect()
    assert brute.ordered(found) == expected


@pytest.mark.parametrize("stage", range(len(corpus_pipeline.STAGES)))
def test_stages_on_awkward_and_empty_tables(spark, awkward, no_documents, stage):
    _, function = corpus_pipeline.STAGES[stage]
    out = function(spark, awkward, SMALL)
    if stage < len(corpus_pipeline.STAGES) - 1:
        assert out.dtypes == awkward.dtypes
    assert 0 < out.count() <= awkward.count()
    assert function(spark, no_documents, SMALL).count() == 0


def test_queries_are_registered():
    names = entry.queries()
    assert [sum(n.startswith(f"op{i}_") for n in names) for i in range(1, 11)] == [1] * 10
