"""Byte-level BPE: encoding and decoding.

Texts are cut into pieces without a regular expression. Every code point gets a symbol: its
class, with what follows it where that matters. A symbol is a function on the eight states
of the cutter; functions compose, and as only few different ones arise, each is a number and
composition is a table. A scan over that table, in rows of fixed length and then over the
rows' totals, gives the state before every code point, and with it the piece starts. Pieces
are merged by rank, with a cache that starts anew when it is full, so memory stays bounded.
The offsets of pieces, in ids and in bytes, are kept beside the ids: decoding goes piece by
piece, and for a range of a text it decodes only the pieces that the range meets.

Defined cases: a null text is empty and has no tokens; any white space, control characters
and unassigned code points are cut as the pattern of the vocabulary cuts them; rows that
repeat are encoded each; an empty table gives no rows; other columns are not touched. A range
beyond a text's end ends with the text; one that may cut a character gives its bytes.
"""

from __future__ import annotations

import base64
import hashlib
import heapq
from collections.abc import Iterable, Iterator
from dataclasses import dataclass
from functools import lru_cache

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

LETTER, NUMBER, OTHER, SPACE = range(4)
# Symbols: a letter, a number, another character, an apostrophe before one letter or before
# two that belong to it, a blank before a non-space, other white space before a non-space,
# white space before more of it or before the end.
L, N, O, A1, A2, J, K, S = range(8)
# States: nothing open, a piece of letters, numbers, others or white space, a blank that the
# next piece takes up, one or two letters left of a contraction.
FREE, LETTERS, NUMBERS, OTHERS, SPACES, JOINED, ONE, TWO = range(8)
# Code points with the property White_Space (fixed values).
WHITE_SPACE = [
    *range(0x09, 0x0E), 0x20, 0x85, 0xA0, 0x1680, *range(0x2000, 0x200B),
    0x2028, 0x2029, 0x202F, 0x205F, 0x3000,
]
# Contractions that are pieces of their own (fixed values).
SHORT = "stmd"
PAIRS = ("re", "ve", "ll")

CACHE = 500_000
DECODED = 100_000
CHUNK = 1 << 20
ROW = 256


def _step(state: int, symbol: int) -> tuple[bool, int]:
    """Whether a piece starts at the symbol, and the state after it."""
    if state in (ONE, TWO):
        return False, FREE if state == ONE else ONE
    if symbol in (L, N, O):
        own = (LETTERS, NUMBERS, OTHERS)[symbol]
        return state not in (own, JOINED), own
    if symbol in (A1, A2):
        if state in (OTHERS, JOINED):
            return False, OTHERS
        return True, ONE if symbol == A1 else TWO
    if symbol == J:
        return True, JOINED
    if symbol == K:
        return True, FREE
    return state != SPACES, SPACES


@lru_cache(None)
def _machine():
    """Numbers of the symbols' functions, their composition, results from FREE, and starts.

    Symbols 8 to 15 are 0 to 7 at the first code point of a text: they forget the state.
    """
    plain = [tuple(_step(q, s)[1] for q in range(8)) for s in range(8)]
    first = [(f[FREE],) * 8 for f in plain]
    number: dict[tuple, int] = {tuple(range(8)): 0}
    for f in plain + first:
        number.setdefault(f, len(number))
    grown = 0
    while grown < len(number):
        grown = len(number)
        for f in list(number):
            for g in list(number):
                number.setdefault(tuple(g[q] for q in f), len(number))
    every = list(number)
    compose = np.array([[number[tuple(g[q] for q in f)] for g in every] for f in every], np.uint16)
    starts = np.array([[_step(q, s)[0] for s in range(8)] for q in range(8)])
    return (
        np.array([number[f] for f in plain + first], np.uint16),
        compose,
        np.array([f[FREE] for f in every], np.uint8),
        starts,
    )


@lru_cache(None)
def _classes() -> np.ndarray:
    """The class of every code point."""
    points = [p for p in range(0x110000) if not 0xD800 <= p < 0xE000]
    text = "".join(map(chr, points))
    out = np.full(0x110000, OTHER, np.uint8)
    for kind, pattern in ((LETTER, r"\p{L}+"), (NUMBER, r"\p{N}+")):
        for m in regex.finditer(pattern, text):
            out[[ord(c) for c in m[0]]] = kind
    out[WHITE_SPACE] = SPACE
    return out


def _scan(functions: np.ndarray, compose: np.ndarray) -> np.ndarray:
    """The composition of all functions before each place (exclusive scan)."""
    n = len(functions)
    if n <= ROW:
        out = np.zeros(n, np.uint16)
        for i in range(1, n):
            out[i] = compose[out[i - 1], functions[i - 1]]
        return out
    rows = -(-n // ROW)
    grid = np.zeros(rows * ROW, np.uint16)
    grid[:n] = functions
    grid = grid.reshape(rows, ROW).T.copy()
    inside = np.zeros((ROW + 1, rows), np.uint16)
    for i in range(ROW):
        inside[i + 1] = compose[inside[i], grid[i]]
    before = _scan(inside[ROW], compose)
    return compose[before[None, :], inside[:ROW]].T.reshape(-1)[:n]


def piece_starts(points: np.ndarray, first: np.ndarray) -> np.ndarray:
    """Places of code points at which pieces start; `first` are the starts of the texts."""
    n = len(points)
    symbols, compose, state, starts = _machine()
    kind = _classes()[points]
    after = np.append(kind[1:], SPACE)
    code = np.append(points[1:], 0)
    code2 = np.append(points[2:], [0, 0])[:n]
    ends = first[1:] - 1
    after[ends] = SPACE
    code[ends] = 0
    code2[ends] = 0
    code2[ends[ends > 0] - 1] = 0
    symbol = kind.copy()
    space = kind == SPACE
    symbol[space] = np.where(
        after[space] == SPACE, S, np.where(points[space] == 0x20, J, K)
    )
    marks = np.flatnonzero(points == 0x27)
    if len(marks):
        next_one, next_two = code[marks], code2[marks]
        symbol[marks[np.isin(next_one, [ord(c) for c in SHORT])]] = A1
        for a, b in PAIRS:
            symbol[marks[(next_one == ord(a)) & (next_two == ord(b))]] = A2
    which = symbol.copy()
    which[first[first < n]] += 8
    before = state[_scan(symbols[which], compose)]
    before[first[first < n]] = FREE
    return np.flatnonzero(starts[before, symbol])


def load_ranks(path: str) -> dict[bytes, int]:
    with open(path, "rb") as lines:
        return {base64.b64decode(a): int(b) for a, b in map(bytes.split, lines)}


def merge(piece: bytes, ranks: dict[bytes, int]) -> list[int]:
    """Ids of a piece: of all adjacent parts the pair of lowest rank joins first, leftmost first."""
    if piece in ranks:
        return [ranks[piece]]
    n = len(piece)
    end = list(range(1, n + 1))
    prev = list(range(-1, n - 1))
    alive = [True] * n

    def pair(i: int):
        j = end[i]
        return ranks.get(piece[i : end[j]]) if j < n else None

    heap = [(r, i, i + 2) for i in range(n - 1) if (r := ranks.get(piece[i : i + 2])) is not None]
    heapq.heapify(heap)
    while heap:
        _, i, stop = heapq.heappop(heap)
        if not alive[i] or end[i] >= n or end[end[i]] != stop:
            continue
        j = end[i]
        alive[j] = False
        end[i] = end[j]
        if end[i] < n:
            prev[end[i]] = i
        for k in (i, prev[i]):
            if k >= 0 and (r := pair(k)) is not None:
                heapq.heappush(heap, (r, k, end[end[k]]))
    return [ranks[piece[i : end[i]]] for i in range(n) if alive[i]]


class _Cache(dict):
    """Packed ids of pieces, worked out when first asked for."""

    def __init__(self, ranks: dict[bytes, int]):
        self.ranks = ranks

    def __missing__(self, piece: bytes) -> bytes:
        if len(self) >= CACHE:
            self.clear()
        found = np.array(merge(piece, self.ranks), "<u4").tobytes()
        if len(piece) <= 256:
            self[piece] = found
        return found


class _Decoded(dict):
    """Bytes of pieces by their packed ids, joined when first asked for."""

    def __init__(self, tokens: list[bytes]):
        self.tokens = tokens

    def __missing__(self, ids: bytes) -> bytes:
        if len(self) >= DECODED:
            self.clear()
        found = b"".join([self.tokens[i] for i in np.frombuffer(ids, "<u4").tolist()])
        if len(found) <= 256:
            self[ids] = found
        return found


@dataclass
class Encoded:
    """Packed ids of a text, and of each piece the place of its first id and of its first byte."""

    ids: bytes
    id_at: np.ndarray
    byte_at: np.ndarray


class Codec:
    """Encodes texts to packed ids and decodes them, with the ranks of one vocabulary."""

    def __init__(self, path: str):
        ranks = load_ranks(path)
        self.cache = _Cache(ranks)
        self.tokens = [b""] * (max(ranks.values()) + 1)
        for token, rank in ranks.items():
            self.tokens[rank] = token
        self.decoded = _Decoded(self.tokens)

    def encode(self, texts: list[str]) -> list[bytes]:
        """Ids of each text as little-endian unsigned 32-bit integers."""
        return [e.ids for e in self.encode_pieces(texts)]

    def encode_pieces(self, texts: list[str]) -> list[Encoded]:
        """Ids of each text with the offsets of its pieces."""
        joined = "".join(texts)
        first = np.zeros(len(texts) + 1, np.int64)
        np.cumsum([len(t) for t in texts], out=first[1:])
        points = np.frombuffer(joined.encode("utf-32-le"), np.uint32)
        if not len(points):
            none = np.zeros(0, np.int32)
            return [Encoded(b"", none, none) for _ in texts]
        starts = piece_starts(points, np.unique(first))
        data = joined.encode()
        at = starts
        if len(data) > len(points):
            width = 1 + (points >= 0x80) + (points >= 0x800) + (points >= 0x10000)
            at = np.r_[0, np.cumsum(width)][starts]
        cuts = [*at.tolist(), len(data)]
        cache = self.cache
        ids = [cache[data[a:b]] for a, b in zip(cuts, cuts[1:])]
        bounds = np.searchsorted(starts, first).tolist()
        id_at = np.cumsum([0, *map(len, ids)])[:-1] // 4

        def own(at: np.ndarray, a: int, b: int) -> np.ndarray:
            return (at[a:b] - at[a]).astype(np.int32) if a < b else np.zeros(0, np.int32)

        return [
            Encoded(b"".join(ids[a:b]), own(id_at, a, b), own(at, a, b))
            for a, b in zip(bounds, bounds[1:])
        ]

    def decode(self, ids: bytes) -> bytes:
        """Bytes of ids whose pieces are not known."""
        tokens = self.tokens
        return b"".join([tokens[i] for i in np.frombuffer(ids, "<u4").tolist()])

    def decode_pieces(self, text: Encoded, start: int = 0, stop: int | None = None) -> bytes:
        """Bytes `start` to `stop` of a text (to its end: None), by the pieces that hold them."""
        start, stop = max(start, 0), None if stop is None else max(stop, 0)
        from_ = max(int(np.searchsorted(text.byte_at, start, "right")) - 1, 0)
        to = len(text.byte_at) if stop is None else int(np.searchsorted(text.byte_at, stop))
        if from_ >= to:
            return b""
        ends = [*text.id_at[from_ + 1 : to].tolist()]
        ends.append(int(text.id_at[to]) if to < len(text.id_at) else len(text.ids) // 4)
        ids, decoded, a, parts = text.ids, self.decoded, int(text.id_at[from_]), []
        for b in ends:
            parts.append(decoded[ids[4 * a : 4 * b]])
            a = b
        before = int(text.byte_at[from_])
        return b"".join(parts)[start - before : None if stop is None else stop - before]


@lru_cache(2)
def codec(path: str) -> Codec:
    return Codec(path)


def _chunks(texts: list[str]) -> Iterator[list[str]]:
    """Texts in turn, about `CHUNK` characters at a time."""
    held, size = [], 0
    for t in texts:
        held.append(t)
        size += len(t)
        if size >= CHUNK:
            yield held
            held, size = [], 0
    if held:
        yield held


def tokenized(df: DataFrame, path: str, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """`doc_id`, the packed `ids` of the text, and of its pieces the places of their first ids and
    first bytes, `id_at` and `byte_at`.

    `path` is a place of the vocabulary on every executor.
    """

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        use = codec(path)
        for b in batches:
            parts = _chunks(b.column("_text").to_pylist())
            found = [x for part in parts for x in use.encode_pieces(part)]
            yield pa.RecordBatch.from_arrays(
                [b.column("doc_id"), pa.array([x.ids for x in found], pa.binary()),
                 pa.array([x.id_at for x in found], pa.list_(pa.int32())),
                 pa.array([x.byte_at for x in found], pa.list_(pa.int32()))],
                ["doc_id", "ids", "id_at", "byte_at"],
            )

    rows = _rows(df, doc_id, text)
    kind = rows.schema["doc_id"].dataType.simpleString()
    return rows.mapInArrow(run, f"doc_id {kind}, ids binary, id_at array<int>, byte_at array<int>")


def detokenized(df: DataFrame, path: str, start: int = 0, stop: int | None = None) -> DataFrame:
    """`doc_id` and the `decoded` bytes, from `start` to `stop`, of rows that `tokenized` made."""

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        use = codec(path)
        for b in batches:
            columns = (b.column("ids").to_pylist(), b.column("id_at"), b.column("byte_at"))
            texts = [Encoded(i, x.values.to_numpy(), y.values.to_numpy()) for i, x, y in zip(*columns)]
            out = pa.array([use.decode_pieces(t, start, stop) for t in texts], pa.binary())
            yield pa.RecordBatch.from_arrays([b.column("doc_id"), out], ["doc_id", "decoded"])

    rows = df.select("doc_id", "ids", "id_at", "byte_at")
    kind = rows.schema["doc_id"].dataType.simpleString()
    return rows.mapInArrow(run, f"doc_id {kind}, decoded binary")


def _rows(df: DataFrame, doc_id: str, text: str) -> DataFrame:
    body = F.coalesce(F.col(f"`{text}`"), F.lit(""))
    return df.select(F.col(f"`{doc_id}`").alias("doc_id"), body.alias("_text"))


def digests(df: DataFrame, path: str, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """Per document: tokens, and digests of the ids and of what they decode to."""

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        use = codec(path)
        for b in batches:
            counts, of_ids, of_text = [], [], []
            for part in _chunks(b.column("_text").to_pylist()):
                for found in use.encode_pieces(part):
                    counts.append(len(found.ids) // 4)
                    of_ids.append(hashlib.sha256(found.ids).hexdigest())
                    of_text.append(hashlib.sha256(use.decode_pieces(found)).hexdigest())
            yield pa.RecordBatch.from_arrays(
                [b.column("doc_id"), pa.array(counts, pa.int64()), pa.array(of_ids, pa.string()),
                 pa.array(of_text, pa.string())],
                ["doc_id", "n_tokens", "ids_sha256", "decoded_sha256"],
            )

    rows = _rows(df, doc_id, text)
    kind = rows.schema["doc_id"].dataType.simpleString()
    return rows.mapInArrow(
        run, f"doc_id {kind}, n_tokens long, ids_sha256 string, decoded_sha256 string"
    )
