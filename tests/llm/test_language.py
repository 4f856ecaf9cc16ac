import math
import random
import zlib
from collections import defaultdict

import numpy as np
import pytest
from conftest import texts_of

from lakeops.llm import language


def plain_bits(model_texts, text):
    """Code length of a text, from counts of a single language, without any cut."""
    counts = defaultdict(lambda: defaultdict(int))
    for t in model_texts:
        for order in range(language.ORDER + 1):
            for i in range(order, len(t)):
                counts[t[i - order : i]][t[i]] += 1
    total = 0.0
    for i, byte in enumerate(text):
        for order in range(min(i, language.ORDER), -1, -1):
            seen = counts.get(text[i - order : i])
            if not seen:
                continue
            n, u = sum(seen.values()), len(seen)
            if byte in seen:
                total += math.log2((n + u) / seen[byte])
                break
            total += math.log2((n + u) / u)
        else:
            total += 8
    return total


def test_exact_code_lengths(spark):
    train = ["the cat sat on the mat and the dog", "what is that then", "a"]
    rows = [(t, "xx") for t in train] + [("le chat est dans la maison", "yy")]
    model = language.train(spark.createDataFrame(rows, "text string, lang string"))
    texts = [b"the hat", b"zzz q", "thé".encode(), b"", b"t", b"that the cat is then on a mat"]
    bits = model.code_lengths(texts)
    assert model.languages == ["xx", "yy"]
    own = [t.encode() for t in train]
    assert bits[:, 0] == pytest.approx([plain_bits(own, t) for t in texts], rel=1e-5)
    # Texts that are scored together do not touch.
    assert np.allclose(bits, np.concatenate([model.code_lengths([t]) for t in texts]), rtol=1e-6)


def test_held_out_accuracy(spark):
    df = spark.read.parquet("/root/testdata/sf0.01/documents.parquet")
    truth = {r["doc_id"]: r["lang"] for r in df.select("doc_id", "lang").collect()}
    rows = language.predictions(df).collect()
    out = [r for r in rows if r["held_out"]]
    assert {r["doc_id"] for r in out} == {d for d in truth if zlib.crc32(str(d).encode()) % 4 == 2}
    assert len(rows) == len(truth) and all(0 <= r["score"] <= 1 for r in rows)
    assert sum(r["lang_pred"] == truth[r["doc_id"]] for r in out) >= 0.98 * len(out)


def test_texts_without_letters_and_nulls(awkward, no_documents):
    found = {r["doc_id"]: r for r in language.predictions(awkward).collect()}
    letters = {d: any(c.isalpha() for c in t or "") for d, t in texts_of(awkward)}
    for doc in range(19):
        assert (found[doc]["lang_pred"] == "und") == (not letters[doc])
    assert found[0]["score"] == 0 and not found[None]["held_out"]
    assert language.predictions(no_documents).count() == 0


def test_labels_of_held_out_documents_teach_nothing(spark):
    ids = [i for i in range(100) if zlib.crc32(str(i).encode()) % 4 == 2]
    rows = [(i, "some words here", "zz") for i in ids]
    df = spark.createDataFrame(rows, "doc_id long, text string, lang string")
    assert {r["lang_pred"] for r in language.predictions(df).collect()} == {"und"}


def test_no_more_contexts_than_the_bound(documents, monkeypatch):
    monkeypatch.setattr(language, "CONTEXTS", 50)
    model = language.train(documents)
    assert model.bits.shape[1] <= (1 + 256 + 2 * 50) * 256


@pytest.mark.parametrize("limit", [language.MODEL_BYTES, 3 * 1024 * 30])
def test_exact_code_lengths_of_more_contexts_than_are_held(spark, monkeypatch, limit):
    """One language fills the list of held contexts many times over; another has a few texts.
    With the lower limit not even the contexts of one byte are all held."""
    monkeypatch.setattr(language, "MODEL_BYTES", limit)
    draw = random.Random(9)
    many = ["".join(draw.choices("abcdefghijklmnopqrstuvwxyzABCDEFGHIJKLMNOP äöü", k=300)) for _ in range(250)]
    few = {"yy": ["le chat est dans la maison", "la maison du chat"], "zz": ["кот дома", "дом кота и кот"]}
    rows = [(t, "xx") for t in many] + [(t, k) for k, own in few.items() for t in own]
    learnt = language.learn(spark.createDataFrame(rows, "text string, lang string"))
    held = {c for t in many for c in zip(t.encode(), t.encode()[1:], t.encode()[2:])}
    assert len(held) > 5 * language.CONTEXTS and learnt.counts.count() > 0
    assert learnt.model.bits.nbytes <= limit
    texts = [*many[:3], *few["yy"], *few["zz"], "кот est zz", "a", "äü la дом" * 30, many[5][:50] * 2]
    df = spark.createDataFrame(list(enumerate(texts)), "i long, _text string").repartition(3)
    found = {r["i"]: r["bits"] for r in language.code_lengths(learnt, df).collect()}
    own = {"xx": many, **few}
    assert learnt.model.languages == sorted(own)
    for n, k in enumerate(sorted(own)):
        taught = [t.encode() for t in own[k]]
        expected = [plain_bits(taught, t.encode()) for t in texts]
        assert [found[i][n] for i in range(len(texts))] == pytest.approx(expected, rel=1e-5)


def test_model_is_bounded_for_any_number_of_languages():
    assert language.held_contexts(4) == [256, language.CONTEXTS, language.CONTEXTS]
    for n in (1, 100, 1000, 5000, 1 << 18):
        assert 1024 * n * (1 + sum(language.held_contexts(n))) <= language.MODEL_BYTES
    assert language.held_contexts(1 << 20) == [0, 0, 0]


def test_held_contexts_change_no_prediction(documents, monkeypatch):
    every = {r["doc_id"]: r for r in language.predictions(documents).collect()}
    monkeypatch.setattr(language, "CONTEXTS", 50)
    for r in language.predictions(documents).collect():
        whole = every[r["doc_id"]]
        assert (r["held_out"], r["lang_pred"]) == (whole["held_out"], whole["lang_pred"])
        assert r["score"] == pytest.approx(whole["score"], rel=1e-3)
