import random

import brute
import numpy as np
import public_tokenizers
import pytest
import regex
import tiktoken
from conftest import bag, texts_of

from lakeops.llm import bpe

PATH = public_tokenizers.path("byte_bpe_50k.tiktoken")


@pytest.fixture(scope="module")
def library():
    return tiktoken.Encoding(
        "own", pat_str=public_tokenizers.PATTERN, mergeable_ranks=bpe.load_ranks(PATH), special_tokens={}
    )


@pytest.fixture(scope="module")
def codec():
    return bpe.Codec(PATH)


def packed(library, text):
    return np.array(library.encode_ordinary(text), "<u4").tobytes()


def test_documents_as_the_library_encodes_them(documents, awkward, library):
    for df in (documents, awkward):
        expected = []
        for doc, text in texts_of(df):
            ids = packed(library, text or "")
            expected.append((doc, len(ids) // 4, brute.sha(ids), brute.sha(text or "")))
        assert bag(bpe.digests(df, PATH)) == brute.ordered(expected)
        ids = {bytes(r["ids"]) for r in bpe.tokenized(df, PATH).collect()}
        assert ids == {packed(library, t or "") for _, t in texts_of(df)}


def test_every_code_point(codec, library):
    points = [chr(p) for p in range(0, 0x110000, 7) if not 0xD800 <= p < 0xE000]
    texts = [f"{c}a1 {c} {c}{c}" for c in points]
    found = codec.encode(texts)
    assert [t for t, x in zip(texts, found) if x != packed(library, t)] == []


def test_mixtures(codec, library):
    parts = ["'", "'s", "'re", "'ll", "'ve", "'S", "l", "e", "v", " ", "  ", "\n", "\t", " ", "　", "é",
             "1", "٣", "½", "!?", "''", "\x85", "\x1c", "日", "😀", "́", "​", "²", "ǅ", "<|endoftext|>"]
    draw = random.Random(2)
    texts = ["".join(draw.choices(parts, k=draw.randint(0, 30))) for _ in range(4000)]
    found = codec.encode(texts)
    assert [t for t, x in zip(texts, found) if x != packed(library, t)] == []
    assert all(codec.decode(x) == t.encode() for t, x in zip(texts, found))


def test_offsets_of_pieces(codec, library):
    pattern = regex.compile(public_tokenizers.PATTERN)
    texts = ["", "It's  1st\n\n日本 été!", "", "  a", "x" * 700 + " y" * 40]
    for text, found in zip(texts, codec.encode_pieces(texts)):
        pieces = [m[0] for m in pattern.finditer(text)]
        ids, places = [0], [0]
        for p in pieces:
            ids.append(ids[-1] + len(library.encode_ordinary(p)))
            places.append(places[-1] + len(p.encode()))
        assert (found.id_at.tolist(), found.byte_at.tolist()) == (ids[:-1], places[:-1])


def test_ranges_are_decoded_by_their_pieces(codec, monkeypatch):
    monkeypatch.setattr(bpe, "DECODED", 3)
    draw = random.Random(5)
    texts = ["", "one", "It's  1st\n\n日本 été! " * 20, "ab" * 900]
    for text, found in zip(texts, codec.encode_pieces(texts)):
        data = text.encode()
        assert codec.decode_pieces(found) == data
        for _ in range(200):
            a, b = draw.randint(0, len(data) + 5), draw.randint(0, len(data) + 5)
            assert codec.decode_pieces(found, a, b) == data[a:b]
            assert codec.decode_pieces(found, a) == data[a:]
    found = codec.encode_pieces(["a b c d e f g h"])[0]
    codec.decoded.clear()
    assert codec.decode_pieces(found, 4, 5) == b"c" and len(codec.decoded) == 1


def test_tables_are_decoded_by_offsets(awkward, no_documents):
    tokens = bpe.tokenized(awkward, PATH)
    expected = brute.ordered((d, (t or "").encode()) for d, t in texts_of(awkward))
    assert brute.ordered((r[0], bytes(r[1])) for r in bpe.detokenized(tokens, PATH).collect()) == expected
    part = bpe.detokenized(tokens, PATH, 2, 9).collect()
    assert brute.ordered((r[0], bytes(r[1])) for r in part) == brute.ordered((d, t[2:9]) for d, t in expected)
    assert bpe.detokenized(bpe.tokenized(no_documents, PATH), PATH).count() == 0


def test_long_pieces_and_a_full_cache(codec, library, monkeypatch):
    monkeypatch.setattr(bpe, "CACHE", 5)
    texts = ["x" * 5000, "ab" * 20000, "y'" * 3000, "a b c d e f g h i j k l m n o p"]
    assert bpe.Codec(PATH).encode(texts) == [packed(library, t) for t in texts]


def test_scan_is_the_plain_composition():
    symbols, compose, _, _ = bpe._machine()
    draw = np.random.default_rng(0)
    functions = symbols[draw.integers(0, 16, 3000)]
    plain = [0]
    for f in functions[:-1]:
        plain.append(int(compose[plain[-1], f]))
    assert bpe._scan(functions, compose).tolist() == plain


def test_empty_table(no_documents):
    assert bpe.digests(no_documents, PATH).count() == bpe.tokenized(no_documents, PATH).count() == 0
