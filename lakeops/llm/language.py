"""Language identification by prediction by partial matching.

Every language has a tree of byte contexts with counts. The code length of a byte is that of
the longest context in which the language has seen it, plus an escape for every longer one
that has not: a symbol seen c times in a context of n bytes, u of them different, costs
log2((n + u) / c) bits, an escape log2((n + u) / u); with no context left a byte costs 8.
The language with the shortest code wins. Statistics are frozen before any text is scored.

All labelled training texts are counted, by partial sums per language and context, and every
count is used. The `CONTEXTS` most frequent contexts of each order are held in memory, fewer if
there are so many languages that their table would pass `MODEL_BYTES`: laid over one set of contexts, the code lengths of all languages for a context and a
byte are one row of a table, and scoring is a walk down the contexts and a look-up per byte.
The other contexts stay in written tables that grow with the corpus. Bytes behind one of them,
which a bit per possible context tells, are counted per text and meet the tables in joins; the
sums are of whole numbers, `UNIT` to a bit, so no order of rows changes them.

Defined cases: a null text, or one without a letter, is `und` with score 0, as is everything
if there is nothing to learn from; texts without a label or an id teach nothing; ties go to
the first language in order; repeated rows count as often as they occur; an empty table gives
no rows; other columns are not touched.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from lakeops.llm.common import stored

ORDER = 3
CONTEXTS = 4096
MODEL_BYTES = 1 << 28
# Fractions of a bit in which the joins count.
UNIT = 1 << 24
UNKNOWN = "und"
_LETTER = regex.compile(r"\p{L}")
CHUNK = 1 << 20


def held_out(doc_id: Column) -> Column:
    """Documents that nothing is learnt from."""
    mark = F.crc32(doc_id.cast("string").cast("binary"))
    return F.coalesce(F.pmod(mark, F.lit(4)) == 2, F.lit(False))


def _chunks(texts: Iterable[bytes | None]) -> Iterator[list[bytes]]:
    held, size = [], 0
    for t in texts:
        held.append(t or b"")
        size += len(held[-1])
        if size >= CHUNK:
            yield held
            held, size = [], 0
    if held:
        yield held


def _states(data: np.ndarray, begin: np.ndarray, maps: list[np.ndarray]) -> np.ndarray:
    """The deepest kept context before each byte; `begin` tells how far a byte's text has come.

    `maps[k][s, b]` is the context of order k + 1 that the byte `b` in front of the context `s`
    makes, 0 if it is not kept; so a walk starts at the latest byte and goes back.
    """
    state = np.zeros(len(data), np.int32)
    live = np.arange(len(data))
    for k, step in enumerate(maps):
        live = live[begin[live] > k]
        to = step[state[live], data[live - k - 1]]
        live, to = live[to > 0], to[to > 0]
        state[live] = to
    return state


@dataclass
class Model:
    """Contexts and, for each, the code lengths of every byte in every language."""

    languages: list[str]
    maps: list[np.ndarray]
    bits: np.ndarray

    def code_lengths(self, texts: list[bytes], other: Other | None = None) -> np.ndarray:
        """Bits of each text in each language, by the contexts held here; bytes behind one of
        the `other` contexts count nothing."""
        sizes = np.array([len(t) for t in texts], np.int64)
        out = np.zeros((len(texts), len(self.languages)))
        data = np.frombuffer(b"".join(texts), np.uint8)
        if not len(data):
            return out
        starts = np.r_[0, np.cumsum(sizes)[:-1]]
        begin = np.arange(len(data)) - np.repeat(starts, sizes)
        row = _states(data, begin, self.maps).astype(np.int64) * 256 + data
        here = None if other is None else other.keys(data, begin) == 0
        some = sizes > 0
        for i in range(len(self.languages)):
            bits = self.bits[i][row] if here is None else self.bits[i][row] * here
            out[some, i] = np.add.reduceat(bits, starts[some], dtype=np.float64)
        return out

    def last_bytes(self, keys: np.ndarray) -> np.ndarray:
        """Bits of the last byte of each key (see `Other`) in each language, by the contexts here."""
        order = keys >> 32
        state = np.zeros(len(keys), np.int64)
        live = np.arange(len(keys))
        for k, step in enumerate(self.maps):
            live = live[order[live] > k]
            to = step[state[live], keys[live] >> (8 * (k + 1)) & 255]
            live, to = live[to > 0], to[to > 0]
            state[live] = to
        return self.bits[:, state * 256 + (keys & 255)].T.astype(np.float64)


@dataclass
class Other:
    """A bit for each possible context of an order above 1: whether it is counted, but not held.

    A key is an order in its high half and the bytes of a context and the one behind it in its
    low half.
    """

    marks: dict[int, np.ndarray]

    def keys(self, data: np.ndarray, begin: np.ndarray) -> np.ndarray:
        """The key of the deepest such context before each byte, 0 where there is none."""
        out = np.zeros(len(data), np.int64)
        code = data.astype(np.int64)
        for order in range(1, ORDER + 1):
            code[order:] += data[:-order].astype(np.int64) << (8 * order)
            if order in self.marks:
                at = np.flatnonzero(begin >= order)
                context = code[at] >> 8
                at = at[self.marks[order][context >> 3] >> (context & 7).astype(np.uint8) & 1 > 0]
                out[at] = code[at] | order << 32
        return out

    def counted(self, texts: list[bytes]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Keys that texts hold: how many each text has, the keys, how often each is there."""
        sizes = np.array([len(t) for t in texts], np.int64)
        data = np.frombuffer(b"".join(texts), np.uint8)
        begin = np.arange(len(data)) - np.repeat(np.cumsum(sizes) - sizes, sizes)
        keys = self.keys(data, begin)
        at = np.flatnonzero(keys)
        which, keys = np.repeat(np.arange(len(texts)), sizes)[at], keys[at]
        turn = np.lexsort([keys, which])
        which, keys = which[turn], keys[turn]
        first = np.flatnonzero(np.r_[True, (which[1:] != which[:-1]) | (keys[1:] != keys[:-1])][: len(keys)])
        n = np.diff(np.r_[first, len(keys)])
        return np.bincount(which[first], minlength=len(texts)), keys[first], n


@dataclass
class Learnt:
    """The model, and what it does not hold: `counts` of such contexts by `id` (order in the high
    half, context in the low), `byte` and `lang`, nothing if it holds all."""

    model: Model
    other: Other | None
    counts: DataFrame | None


def held_contexts(languages: int) -> list[int]:
    """How many contexts of each order from 1 up are held in memory, the shorter ones first; a
    context has 256 code lengths of four bytes in each language."""
    left = max(MODEL_BYTES // (1024 * languages) - 1, 0)
    out = []
    for order in range(1, ORDER + 1):
        share = left if order == 1 else left // (ORDER + 1 - order)
        out.append(min(256 if order == 1 else CONTEXTS, share))
        left -= out[-1]
    return out


def _contexts(counts: DataFrame, order: int, limit: int) -> DataFrame:
    """The kept contexts of an order: `context` and how often any byte follows."""
    own = counts.filter(F.col("order") == order).groupBy("context").agg(F.sum("n").alias("n"))
    return own.orderBy(F.desc("n"), "context").limit(limit)


def _counts(df: DataFrame, lang: str, text: str) -> DataFrame:
    """`lang`, `order`, `context`, `byte`, `n` of all texts; contexts are numbers, latest byte last."""

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            langs = b.column("lang").dictionary_encode()
            names = langs.dictionary.to_pylist()
            which = langs.indices.to_pylist()
            texts = b.column("_text").cast(pa.binary()).to_pylist()
            for i, name in enumerate(names):
                for part in _chunks(t for t, w in zip(texts, which) if w == i):
                    yield from _part_counts(name, part)

    rows = df.filter(F.col(f"`{lang}`").isNotNull() & F.col(f"`{text}`").isNotNull())
    rows = rows.select(F.col(f"`{lang}`").alias("lang"), F.col(f"`{text}`").alias("_text"))
    rows = rows.mapInArrow(run, "lang string, order int, context long, byte int, n long")
    return rows.groupBy("lang", "order", "context", "byte").agg(F.sum("n").alias("n"))


def _part_counts(name: str, texts: list[bytes]) -> Iterator[pa.RecordBatch]:
    data = np.frombuffer(b"".join(texts), np.uint8).astype(np.int64)
    sizes = np.array([len(t) for t in texts])
    begin = np.arange(len(data)) - np.repeat(np.r_[0, np.cumsum(sizes)[:-1]], sizes)
    code = data.copy()
    for order in range(ORDER + 1):
        at = np.flatnonzero(begin >= order)
        if order:
            code[order:] += data[:-order] << (8 * order)
        # The highest bytes are the earliest: context, then the byte itself.
        keys, n = np.unique(code[at], return_counts=True)
        yield pa.RecordBatch.from_arrays(
            [pa.array([name] * len(keys), pa.string()), pa.array([order] * len(keys), pa.int32()),
             pa.array(keys >> 8), pa.array(keys & 255, pa.int32()), pa.array(n, pa.int64())],
            ["lang", "order", "context", "byte", "n"],
        )


def train(df: DataFrame, lang: str = "lang", text: str = "text") -> Model | None:
    """The model of all texts, of the contexts held in memory."""
    learnt = learn(df, lang, text)
    return None if learnt is None else learnt.model


def _marks(counts: DataFrame) -> dict[int, np.ndarray]:
    """A bit per context, by order; at most two million bytes for an order of 3."""
    wide = 1 << 15  # bits of a row's bitmap
    order, context = F.shiftright("id", 32), F.col("id").bitwiseAND(F.lit((1 << 32) - 1))
    rows = counts.groupBy(order.cast("int").alias("order"), F.floor(context / wide).alias("part"))
    out: dict[int, np.ndarray] = {}
    for order, part, marks in rows.agg(F.bitmap_construct_agg(context % wide)).collect():
        own = out.setdefault(order, np.zeros(max(1, 256**order // 8), np.uint8))
        at = part * wide // 8
        own[at : at + wide // 8] = np.frombuffer(bytes(marks), np.uint8)[: len(own) - at]
    return out


def learn(df: DataFrame, lang: str = "lang", text: str = "text") -> Learnt | None:
    """Counts of all texts. What comes to the driver is bounded by the number of languages, of
    held contexts and of byte values; all other counts are written."""
    counts = stored(_counts(df, lang, text), "contexts")
    languages = sorted(r[0] for r in counts.select("lang").distinct().collect())
    if not languages:
        return None
    maps: list[np.ndarray] = []
    numbers: list[dict[int, int]] = [{0: 0}]
    total = 1
    for order, limit in enumerate(held_contexts(len(languages)), 1):
        known = numbers[-1]
        kept = sorted(r["context"] for r in _contexts(counts, order, limit).collect())
        kept = [c for c in kept if (c & ((1 << 8 * (order - 1)) - 1)) in known]
        step = np.zeros((total, 256), np.int32)
        numbers.append({})
        for c in kept:
            step[known[c & ((1 << 8 * (order - 1)) - 1)], c >> 8 * (order - 1)] = total
            numbers[-1][c] = total
            total += 1
        maps.append(step)
    parent = np.zeros(total, np.int64)
    for order in range(1, ORDER + 1):
        for c, i in numbers[order].items():
            parent[i] = numbers[order - 1][c & ((1 << 8 * (order - 1)) - 1)]
    rows = [(o, c, i) for o in range(ORDER + 1) for c, i in numbers[o].items()]
    kept = df.sparkSession.createDataFrame(rows, "order int, context long, number int")
    # As many rows as contexts are kept.
    found = counts.join(F.broadcast(kept), ["order", "context"]).select("lang", "number", "byte", "n")
    table = found.toArrow()
    langs, number, byte, n = (table.column(c).to_numpy() for c in ("lang", "number", "byte", "n"))
    bits = np.empty((len(languages), total * 256), np.float32)
    for i, name in enumerate(languages):
        own = langs == name
        seen = np.zeros((total, 256))
        seen[number[own], byte[own]] = n[own]
        bits[i] = _bits(seen, parent, numbers).reshape(-1)
    model = Model(languages, maps, bits)
    rest = counts.join(F.broadcast(kept), ["order", "context"], "left_anti")
    key = F.shiftleft(F.col("order").cast("long"), 32).bitwiseOR(F.col("context"))
    rest = stored(rest.select(key.alias("id"), "byte", "lang", "n"), "other_contexts")
    marks = _marks(rest)
    return Learnt(model, Other(marks), rest) if marks else Learnt(model, None, None)


def _bits(seen: np.ndarray, parent: np.ndarray, numbers: list[dict[int, int]]) -> np.ndarray:
    """Code lengths of every byte in every context of a language, shorter contexts first."""
    total, kinds = seen.sum(axis=1), (seen > 0).sum(axis=1)
    total = total + kinds
    bits = np.full(seen.shape, 8.0)
    with np.errstate(divide="ignore", invalid="ignore"):
        for own in numbers:
            at = np.array(sorted(own.values()), np.int64)
            escape = np.where(kinds[at] > 0, np.log2(total[at] / kinds[at]), 0.0)
            known = np.log2(total[at, None] / seen[at])
            below = bits[parent[at]]  # of the empty context 8 bits, as it is its own parent
            bits[at] = np.where(seen[at] > 0, known, escape[:, None] + below)
    return bits


def _answers(learnt: Learnt, asked: DataFrame, model) -> DataFrame:
    """`key`, and `bits` in each language, in `UNIT`s, of its last byte behind its context.

    From order 2 up: a language that has seen the byte in the context pays for that, one that
    has seen the context alone pays an escape, any other what it paid before.
    """

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            bits = model.value.last_bytes(b.column("key").to_numpy())
            lists = pa.FixedSizeListArray.from_arrays(pa.array(bits.reshape(-1)), bits.shape[1])
            lists = lists.cast(pa.list_(pa.float64()))
            yield pa.RecordBatch.from_arrays([b.column("key"), lists], ["key", "bits"])

    languages = F.array(*map(F.lit, learnt.model.languages))
    counts = learnt.counts.withColumn("lang", F.array_position(languages, F.col("lang")).cast("int") - 1)
    sums = stored(counts.groupBy("id", "lang").agg(F.sum("n").alias("n"), F.count("*").alias("u")), "sums")
    escape = F.map_from_entries(F.collect_list(F.struct("lang", F.log2((F.col("n") + F.col("u")) / F.col("u")))))
    escapes = stored(sums.groupBy("id").agg(escape.alias("escape")), "escapes")
    cost = F.log2((F.col("s.n") + F.col("s.u")) / F.col("c.n"))
    seen = counts.alias("c").join(sums.alias("s"), ["id", "lang"]).select("id", "byte", "lang", cost.alias("cost"))
    seen = seen.groupBy("id", "byte").agg(F.map_from_entries(F.collect_list(F.struct("lang", "cost"))).alias("seen"))
    seen = stored(seen, "seen")

    out = asked.mapInArrow(run, "key long, bits array<double>")
    for order in sorted(learnt.other.marks):
        # The last `order` bytes before the byte; no context has the number that shorter ones get.
        context = F.shiftright("key", 8).bitwiseAND(F.lit(256**order - 1))
        own = F.when(F.shiftright("key", 32) >= order, context.bitwiseOR(F.lit(order << 32)))
        byte = F.col("key").bitwiseAND(F.lit(255)).cast("int")
        out = out.select("key", "bits", F.coalesce(own, -F.col("key")).alias("id"), byte.alias("byte"))
        out = out.join(escapes, "id", "left").join(seen, ["id", "byte"], "left")
        more = F.transform(
            "bits",
            lambda x, i: F.coalesce(F.col("seen")[i], F.coalesce(F.col("escape")[i], F.lit(0.0)) + x),
        )
        out = out.select("key", more.alias("bits"))
    return out.select("key", F.transform("bits", lambda x: F.round(x * UNIT).cast("long")).alias("bits"))


def code_lengths(learnt: Learnt, df: DataFrame, text: str = "_text") -> DataFrame:
    """The columns of `df`, with the bits in each language, `bits`, in place of its text; null
    for a text that is null or has no letter."""
    model = df.sparkSession.sparkContext.broadcast(learnt.model)
    other = df.sparkSession.sparkContext.broadcast(learnt.other)
    others = [c for c in df.columns if c != text]

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            texts = b.column(text).to_pylist()
            known = [t is not None and _LETTER.search(t) is not None for t in texts]
            parts = list(_chunks(t.encode() if k else b"" for t, k in zip(texts, known)))
            bits = [model.value.code_lengths(p, other.value).tolist() for p in parts]
            bits = [x if k else None for x, k in zip((x for p in bits for x in p), known)]
            columns = [b.column(c) for c in others] + [pa.array(bits, pa.list_(pa.float64()))]
            if other.value is not None:
                found = [other.value.counted(p) for p in parts] or [[np.zeros(0, np.int64)] * 3]
                size, keys, n = (np.concatenate(x) for x in zip(*found))
                ends = pa.array(np.r_[0, np.cumsum(size)], pa.int32())
                columns += [pa.ListArray.from_arrays(ends, pa.array(x, pa.int64())) for x in (keys, n)]
            yield pa.RecordBatch.from_arrays(columns, names)

    kinds = ", ".join(f"`{c}` {df.schema[c].dataType.simpleString()}" for c in others)
    names = [*others, "bits"]
    if learnt.other is None:
        return df.mapInArrow(run, f"{kinds}, bits array<double>")
    names = ["_row", *names, "_keys", "_n"]
    others = ["_row", *others]
    numbered = df.withColumn("_row", F.monotonically_increasing_id())
    kinds = f"_row long, {kinds}, bits array<double>, _keys array<long>, _n array<long>"
    rows = stored(numbered.mapInArrow(run, kinds), "held_bits")

    places = rows.select("_row", F.explode(F.arrays_zip("_keys", "_n")).alias("p"))
    places = places.select("_row", F.col("p._keys").alias("key"), F.col("p._n").alias("n"))
    answers = stored(_answers(learnt, places.select("key").distinct(), model), "answers")
    sums = [F.sum(F.col("n") * F.col("bits")[i]) for i in range(len(learnt.model.languages))]
    more = places.join(answers, "key").groupBy("_row").agg(F.array(*sums).alias("_more"))
    both = F.zip_with("bits", "_more", lambda x, y: x + y / UNIT)
    bits = F.when(F.col("_more").isNull(), F.col("bits")).otherwise(both).alias("bits")
    return rows.drop("_keys", "_n").join(more, "_row", "left").select(*others[1:], bits)


def predictions(
    df: DataFrame, doc_id: str = "doc_id", text: str = "text", lang: str = "lang"
) -> DataFrame:
    """Per document: whether it is held out, the language, and its share of the likelihood."""
    out = held_out(F.col(f"`{doc_id}`"))
    teach = df.filter(~out & F.col(f"`{doc_id}`").isNotNull())
    learnt = learn(teach, lang, text)
    rows = df.select(
        F.col(f"`{doc_id}`").alias("doc_id"), out.alias("held_out"), F.col(f"`{text}`").alias("_text")
    )
    if learnt is None:
        return rows.select("doc_id", "held_out", F.lit(UNKNOWN).alias("lang_pred"), F.lit(0.0).alias("score"))
    languages = learnt.model.languages

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            known = b.column("bits").is_valid().to_numpy(zero_copy_only=False)
            bits = np.array([x or [0.0] * len(languages) for x in b.column("bits").to_pylist()])
            bits = bits.reshape(-1, len(languages))
            best = bits.argmin(axis=1)
            share = 1 / np.exp2(bits.min(axis=1, keepdims=True) - bits).sum(axis=1)
            yield pa.RecordBatch.from_arrays(
                [b.column("doc_id"), b.column("held_out"),
                 pa.array([languages[i] if k else UNKNOWN for i, k in zip(best, known)], pa.string()),
                 pa.array(np.where(known, share, 0.0).astype(float), pa.float64())],
                ["doc_id", "held_out", "lang_pred", "score"],
            )

    kind = rows.schema["doc_id"].dataType.simpleString()
    scored = code_lengths(learnt, rows)
    return scored.mapInArrow(run, f"doc_id {kind}, held_out boolean, lang_pred string, score double")
