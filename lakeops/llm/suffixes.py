"""Removal of long strings that occur more than once, by sorting suffixes.

A string of `LENGTH` bytes (a window) is judged repeated if it starts anywhere else too. All
suffixes of all texts are never moved. Of the hashes of the `GRAM`-byte grams in a window the
smallest, leftmost, is its anchor: a choice by content, so equal windows have equal anchors
at equal offsets. Consecutive windows with one anchor form a run; what they span, some 250
bytes, goes by its anchor's hash.

1. Runs that are alike (digest of what they span) are counted together, however many there
   are. A run without a like whose anchor occurs nowhere else has no repeated window.
2. Where one anchor has different runs, one of each kind is fetched, and the suffixes that
   start at the anchors are sorted, and the reversed prefixes that end there: by multikey
   quicksort down to `SHALLOW` bytes, then by blind tries for the groups that are still tied. Windows at one offset are equal if they are neighbours in
   both orders with common prefixes long enough, which the orders' LCPs tell for all runs
   at once.
3. Runs take their verdicts by anchor and digest; the windows found cover the bytes to go.

An anchor with over `MANY` different runs is not sorted in one task. Its windows are dealt out by
the bytes next to the anchor: those with up to `STEP` different numbers of bytes before it share
all bytes between their ends but these, and windows that differ there meet in no bucket. The
buckets are sorted like anchors. One that is still longer is dealt out by single offsets, where
all windows of a bucket are equal and nothing is left to sort.

Defined cases: null and short texts lose nothing; a row that repeats loses what it shares with
its like; matches never cross texts; an empty table gives no rows; other columns are not
touched, and `without_repeats` keeps them.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterable, Iterator
from functools import reduce

import numpy as np
import pandas as pd
import pyarrow as pa
import zstandard
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from lakeops.llm.common import stored

LENGTH = 200
GRAM = 48
SHALLOW = 64
MANY = 20_000
STEP = 16
# Bytes of runs that are sorted at once.
CHUNK = 8 << 20
# Windows that are hashed at once.
PART = 1 << 21

BASE = 0x9E3779B97F4A7C15  # odd, so it has an inverse modulo 2^64
MASK = (1 << 64) - 1

_powers = np.ones(1, np.uint64)
_inverse = np.ones(1, np.uint64)


def _grow(n: int) -> None:
    global _powers, _inverse
    if len(_powers) < n:
        n = max(n, 2 * len(_powers))
        for base, name in ((BASE, "_powers"), (pow(BASE, -1, 1 << 64), "_inverse")):
            table = np.full(n, base, np.uint64)
            table[0] = 1
            globals()[name] = np.cumprod(table, dtype=np.uint64)


def _gram_hashes(text: np.ndarray) -> np.ndarray:
    n = len(text)
    _grow(n + 1)
    sums = np.zeros(n + 1, np.uint64)
    np.cumsum((text.astype(np.uint64) + np.uint64(1)) * _powers[:n], out=sums[1:])
    h = (sums[GRAM:] - sums[: n - GRAM + 1]) * _inverse[: n - GRAM + 1]
    h ^= h >> np.uint64(29)
    h *= np.uint64(0xBF58476D1CE4E5B9)
    h ^= h >> np.uint64(32)
    return h


def runs(data: bytes) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """First and last window of each run, its anchor's place, and the anchor's hash.

    A very long text is worked on in parts. A run that a part's end divides becomes two, whose
    windows are judged like those of whole runs.
    """
    parts = []
    for at in range(0, max(1, len(data) - LENGTH + 1), PART):
        first, last, place, anchor = _part_runs(data[at : at + PART + LENGTH - 1])
        parts.append((first + at, last + at, place + at, anchor))
    return tuple(np.concatenate(x) for x in zip(*parts))


def _part_runs(data: bytes) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    if len(data) < LENGTH:
        none = np.zeros(0, np.int64)
        return none, none, none, np.zeros(0, np.uint64)
    h = _gram_hashes(np.frombuffer(data, np.uint8))
    width = LENGTH - GRAM + 1
    least, have = h, 1
    while have < width:
        by = min(have, width - have)
        least = np.minimum(least[:-by], least[by:])
        have += by
    first = np.r_[0, np.flatnonzero(least[1:] != least[:-1]) + 1]
    last = np.r_[first[1:], len(least)] - 1
    place = np.empty(len(first), np.int64)
    windows = np.lib.stride_tricks.sliding_window_view(h, width)
    for at in range(0, len(first), 1 << 14):
        some = first[at : at + (1 << 14)]
        place[at : at + (1 << 14)] = some + windows[some].argmin(axis=1)
    late = np.flatnonzero(place < last)
    if len(late):
        # The smallest hash occurs again before the run ends: later windows take the next one.
        a, b, p = [first[place >= last]], [last[place >= last]], [place[place >= last]]
        for i in late:
            every = first[i] + np.flatnonzero(h[first[i] : last[i] + width] == least[first[i]])
            every = every[: np.searchsorted(every, last[i]) + 1]
            a.append(np.r_[first[i], every[:-1] + 1])
            b.append(np.minimum(every, last[i]))
            p.append(every)
        first, last, place = map(np.concatenate, (a, b, p))
        some = np.lexsort([first])
        some = some[first[some] <= last[some]]
        first, last, place = first[some], last[some], place[some]
    return first, last, place, h[place]


def _digests(data: bytes, first: np.ndarray, last: np.ndarray) -> np.ndarray:
    parts = [
        hashlib.blake2b(data[a:b], digest_size=8).digest()
        for a, b in zip(first.tolist(), (last + LENGTH).tolist())
    ]
    return np.frombuffer(b"".join(parts), np.int64)


def _order(texts: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
    """The order of the texts, and the common prefix of each with the one before it.

    Multikey quicksort down to `SHALLOW` bytes; blind tries order what is still tied then.
    """
    n = len(texts)
    if n == 0:
        return np.zeros(0, np.int64), np.zeros(0, np.int64)
    lengths = np.array([len(t) for t in texts], np.int64)
    heads = np.frombuffer(b"".join([t[:SHALLOW].ljust(SHALLOW, b"\0") for t in texts]), ">u8")
    heads = heads.reshape(n, SHALLOW // 8).astype(np.uint64)
    order, group = _multikey_quicksort(heads)
    lcp = np.zeros(n, np.int64)
    a, b = heads[order[1:]], heads[order[:-1]]
    same = (a.astype(">u8").view(np.uint8) == b.astype(">u8").view(np.uint8)).reshape(n - 1, SHALLOW)
    lcp[1:] = np.where(same.all(axis=1), SHALLOW, same.argmin(axis=1))
    starts = np.flatnonzero(np.r_[True, group[1:] != group[:-1]])
    ends = np.r_[starts[1:], n]
    for s, e in zip(starts.tolist(), ends.tolist()):
        if e - s > 1:
            members = order[s:e].tolist()
            ranked, common = _blind_trie(members, texts)
            order[s:e] = ranked
            lcp[s + 1 : e] = common
    lcp[1:] = np.minimum(lcp[1:], np.minimum(lengths[order[1:]], lengths[order[:-1]]))
    return order, lcp


def _multikey_quicksort(keys: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The order of rows of words, and for each place a number that tied rows share.

    Each group of rows that agree in the words before is split by the word of its middle row into
    less, equal and greater; the equal ones go on to the next word. All groups are split in step:
    a row's new place is that of its part of the group and its rank there, by running counts.
    """
    n, words = keys.shape
    order, group, depth = np.arange(n), np.zeros(n, np.int64), np.zeros(n, np.int64)
    while True:
        size = np.bincount(group)
        at = np.flatnonzero((size[group] > 1) & (depth < words))
        if not len(at):
            return order, group
        own = group[at]
        new = np.r_[True, own[1:] != own[:-1]]
        start = np.flatnonzero(new)
        part = np.cumsum(new) - 1
        key = keys[order[at], depth[at]]
        pivot = key[start + size[own[start]] // 2][part]
        side = np.where(key < pivot, 0, np.where(key == pivot, 1, 2))
        place = np.empty(len(at), np.int64)
        before = start.copy()
        for s in range(3):
            hit = side == s
            upto = np.cumsum(hit)
            within = upto - (upto[start] - hit[start])[part]
            place[hit] = (before[part] + within - 1)[hit]
            before += np.add.reduceat(hit, start)
        order[at[place]] = order[at].copy()
        sides = np.empty_like(side)
        sides[place] = side
        depth[at] += sides == 1
        # Groups are numbered anew by place, each split into its parts.
        code = np.full(n, -1)
        code[at] = sides
        group = np.cumsum(np.r_[False, (group[1:] != group[:-1]) | (code[1:] != code[:-1])])


def _blind_trie(members: list[int], texts: list[bytes]) -> tuple[list[int], list[int]]:
    """Members in order and the common prefixes of neighbours.

    A node is [depth, {byte: child}] and skips bytes its leaves share; a leaf is a member. A
    new text walks down by the nodes' bytes alone, is compared once with any leaf below, and
    goes in where they part. -1 stands for the end of a text, before all bytes.
    """

    def byte(t: bytes, depth: int) -> int:
        return t[depth] if depth < len(t) else -1

    def leaf(node):
        while isinstance(node, list):
            node = next(iter(node[1].values()))
        return node

    root = members[0]
    like: dict[int, list[int]] = {}
    kind: dict[bytes, int] = {texts[root]: root}
    for m in members[1:]:
        text = texts[m]
        if (twin := kind.setdefault(text, m)) != m:
            like.setdefault(twin, []).append(m)
            continue
        node = root
        while isinstance(node, list) and (child := node[1].get(byte(text, node[0]))) is not None:
            node = child
        depth = _common(text, texts[leaf(node)])
        up, node = None, root
        while isinstance(node, list) and node[0] < depth:
            up, node = node, node[1][byte(text, node[0])]
        if isinstance(node, list) and node[0] == depth:
            node[1][byte(text, depth)] = m
            continue
        split = [depth, {byte(texts[leaf(node)], depth): node, byte(text, depth): m}]
        if up is None:
            root = split
        else:
            up[1][byte(text, up[0])] = split

    out: list[int] = []
    common: list[int] = []
    todo: list = [(root, 0)]
    while todo:
        node, depth = todo.pop()
        if isinstance(node, list):
            kids = sorted(node[1].items(), reverse=True)
            # Below a node neighbours share its depth; its first child keeps what came before.
            for i, (_, child) in enumerate(kids):
                todo.append((child, depth if i == len(kids) - 1 else node[0]))
        else:
            for x in (node, *like.get(node, ())):
                if out:
                    common.append(depth if x == node else len(texts[node]))
                out.append(x)
    return out, common


def _common(a: bytes, b: bytes) -> int:
    """Length of the common prefix."""
    n = min(len(a), len(b))
    if a[:n] == b[:n]:
        return n
    low, high = 0, n
    while high - low > 1:
        mid = (low + high) // 2
        if a[low:mid] == b[low:mid]:
            low = mid
        else:
            high = mid
    return low


def repeated_windows(
    spans: list[bytes], offset: np.ndarray, count: np.ndarray, copies: np.ndarray
) -> list[np.ndarray]:
    """For each run, which of its `count` windows are repeated.

    `spans` are the bytes of different runs, `offset` the anchor's place in them; `copies` tells
    how often a run occurs.
    """
    n = len(spans)
    right, right_lcp = _order([s[o:] for s, o in zip(spans, offset.tolist())])
    left, left_lcp = _order([s[:o][::-1] for s, o in zip(spans, offset.tolist())])
    base = np.r_[0, np.cumsum(count)]
    found = np.repeat(copies > 1, count)
    right_class, left_class = np.empty(n, np.int64), np.empty(n, np.int64)
    low = offset - count + 1  # bytes before the anchor in the last window
    for before in range(int(low.min(initial=0)), int(offset.max(initial=-1)) + 1):
        everyone = np.flatnonzero((low <= before) & (before <= offset))
        right_class[right] = np.cumsum(right_lcp < LENGTH - before)
        left_class[left] = np.cumsum(left_lcp < before) if before else 0
        key = right_class[everyone] * (n + 1) + left_class[everyone]
        _, where, times = np.unique(key, return_inverse=True, return_counts=True)
        hit = everyone[times[where] > 1]
        found[base[hit] + offset[hit] - before] = True
    return np.split(found, base[1:-1])


def _spans(mask: np.ndarray) -> list[tuple[int, int]]:
    """First and last of each run of true values."""
    edges = np.flatnonzero(np.diff(np.r_[0, mask.view(np.int8), 0]))
    return list(zip(edges[::2].tolist(), (edges[1::2] - 1).tolist()))


# --- distributed steps


def _keyed(df: DataFrame, doc_id: str, text: str) -> DataFrame:
    """A text goes by its id and a 128-bit digest, so rows alike in id do not meet by chance."""
    body = F.coalesce(F.col(f"`{text}`"), F.lit("")).cast("binary")
    return df.select(F.col(f"`{doc_id}`").alias("_id"), _digest(body).alias("_hash"), body.alias("_text"))


def _digest(body: Column) -> Column:
    return F.unhex(F.md5(body))


def _same(left: str, right: str) -> Column:
    ids = F.col(f"{left}._id").eqNullSafe(F.col(f"{right}._id"))
    return ids & (F.col(f"{left}._hash") == F.col(f"{right}._hash"))


def _all_runs(docs: DataFrame) -> DataFrame:
    """`anchor`, `digest`, key of the text, first window, number of windows, anchor's offset."""
    schema = docs.select("_id", "_hash").schema
    arrow = pa.schema(
        [("start", pa.int32()), ("count", pa.int16()), ("offset", pa.int16()),
         ("anchor", pa.int64()), ("digest", pa.int64())]
    )

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            texts = b.column("_text")
            held, rows, size = [], [], 0
            for i in range(len(texts)):
                data = texts[i].as_py()
                first, last, place, anchor = runs(data)
                rows.append(len(first))
                size += len(first)
                if len(first):
                    held.append(
                        (first, last - first + 1, place - first, anchor.view(np.int64),
                         _digests(data, first, last))
                    )
                if size >= 200_000 or i == len(texts) - 1:
                    if held:
                        at = np.repeat(np.arange(i + 1 - len(rows), i + 1), rows)
                        cols = [np.concatenate(c) for c in zip(*held)]
                        made = [pa.array(c.astype(f.type.to_pandas_dtype())) for c, f in zip(cols, arrow)]
                        keys = [b.column(k).take(pa.array(at)) for k in ("_id", "_hash")]
                        yield pa.RecordBatch.from_arrays(
                            keys + made, ["_id", "_hash", *arrow.names]
                        )
                    held, rows, size = [], [], 0

    types = ", ".join(f"{f.name} {f.dataType.simpleString()}" for f in schema)
    return docs.mapInArrow(
        run, f"{types}, start int, count smallint, offset smallint, anchor long, digest long"
    )


def _packed(docs: DataFrame) -> DataFrame:
    """Texts compressed, for the way through a shuffle."""

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        press = zstandard.ZstdCompressor(level=3)
        for b in batches:
            small = pa.array([press.compress(t.as_py()) for t in b.column("_text")], pa.binary())
            names = [n for n in b.schema.names if n != "_text"]
            yield pa.RecordBatch.from_arrays(
                [*[b.column(n) for n in names], small], [*names, "_packed"]
            )

    names = [c for c in docs.columns if c != "_text"]
    types = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in docs.select(*names).schema)
    return docs.select(*names, "_text").mapInArrow(run, f"{types}, _packed binary")


def _unpack(data: bytes) -> bytes:
    return zstandard.ZstdDecompressor().decompress(data)


def _fetched(docs: DataFrame, wanted: DataFrame) -> DataFrame:
    """The bytes of the wanted runs."""
    per_text = wanted.groupBy("_id", "_hash").agg(
        F.collect_list(F.struct("start", "count", "offset", "anchor", "digest", "copies", "kinds")).alias("runs")
    )
    light = _packed(docs).alias("d").join(per_text.alias("w"), _same("d", "w"))
    names = ["anchor", "digest", "offset", "count", "copies", "kinds"]

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def made(rows, spans):
            cols = [pa.array([r[n] for r in rows], pa.int64()) for n in names]
            return pa.RecordBatch.from_arrays([*cols, pa.array(spans, pa.binary())], [*names, "span"])

        for b in batches:
            rows, spans, size = [], [], 0
            for small, wanted in zip(b.column("_packed"), b.column("runs")):
                data = _unpack(small.as_py())
                for r in wanted.as_py():
                    rows.append(r)
                    spans.append(data[r["start"] : r["start"] + r["count"] - 1 + LENGTH])
                    size += len(spans[-1])
                if size >= CHUNK:
                    yield made(rows, spans)
                    rows, spans, size = [], [], 0
            if rows:
                yield made(rows, spans)

    # A text that repeats brings its runs more than once; they have more than one copy anyway.
    return light.select("_packed", "runs").mapInArrow(
        run, "anchor long, digest long, offset long, count long, copies long, kinds long, span binary"
    )


VERDICT = "anchor long, digest long, first int, last int"


def _verdict(t: pd.DataFrame, found: list[np.ndarray]) -> pa.RecordBatch | None:
    rows = [
        (a, d, s + first, e + first)
        for a, d, first, mask in zip(t["anchor"].tolist(), t["digest"].tolist(), t["first"].tolist(), found)
        if mask.any()
        for s, e in _spans(mask)
    ]
    if not rows:
        return None
    kinds = (pa.int64(), pa.int64(), pa.int32(), pa.int32())
    cols = [pa.array(c, k) for c, k in zip(zip(*rows), kinds)]
    return pa.RecordBatch.from_arrays(cols, ["anchor", "digest", "first", "last"])


# Runs or parts of them in the bucket where they are sorted; `first` is a part's first window.
PARTS = ("bucket", "anchor", "digest", "first", "offset", "count", "copies", "span")


def _sorted_verdicts(parts: DataFrame) -> DataFrame:
    """Repeated windows of buckets with a bounded number of parts."""

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def judged(t: pd.DataFrame):
            found = repeated_windows(
                t["span"].tolist(), t["offset"].to_numpy(), t["count"].to_numpy(), t["copies"].to_numpy()
            )
            return _verdict(t, found)

        held, size = [], 0
        for b in batches:
            held.append(b.to_pandas())
            size += b.nbytes
            if size >= CHUNK:
                every = pd.concat(held, ignore_index=True)
                done = every["bucket"] != every["bucket"].iloc[-1]
                if done.any() and (out := judged(every[done].reset_index(drop=True))) is not None:
                    yield out
                held = [every[~done]]
                size = int(held[0]["span"].map(len).sum())
        if held:
            every = pd.concat(held, ignore_index=True)
            if len(every) and (out := judged(every)) is not None:
                yield out

    rows = parts.select(*PARTS).repartition("bucket")
    return rows.sortWithinPartitions("bucket").mapInArrow(run, VERDICT)


def _dealt(parts: DataFrame, step: int) -> DataFrame:
    """Parts of long buckets by the number of bytes before the anchor, `step` numbers together,
    and by the bytes that all windows with these numbers have; with the size of the new bucket."""

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        names = [n for n in PARTS if n != "bucket"]
        for b in batches:
            out = []
            for r in b.to_pylist():
                low, offset, span = r["offset"] - r["count"] + 1, r["offset"], r["span"]
                for k in range(low // step, offset // step + 1):
                    least, most = max(low, k * step), min(offset, k * step + step - 1)
                    core = span[offset - k * step : offset - (k * step + step - 1) + LENGTH]
                    mark = b"%d %d %d " % (r["anchor"], step, k)
                    new = {
                        "bucket": hashlib.blake2b(mark + core, digest_size=16).hexdigest(),
                        "first": r["first"] + offset - most,
                        "offset": most,
                        "count": most - least + 1,
                        "span": span[offset - most : offset - least + LENGTH],
                    }
                    out.append({**r, **new})
            if out:
                cols = {n: [o[n] for o in out] for n in names}
                yield pa.RecordBatch.from_arrays(
                    [pa.array([o["bucket"] for o in out])]
                    + [pa.array(cols[n], pa.binary() if n == "span" else pa.int64()) for n in names],
                    list(PARTS),
                )

    schema = ", ".join(f"{n} {'string' if n == 'bucket' else 'binary' if n == 'span' else 'long'}" for n in PARTS)
    dealt = stored(parts.select(*PARTS).mapInArrow(run, schema), "dealt")
    sizes = stored(dealt.groupBy("bucket").agg(F.count("*").alias("kinds")), "sizes")
    return dealt.join(sizes, "bucket")


def _bucket_verdicts(spans: DataFrame) -> list[DataFrame]:
    """Verdicts of all fetched runs, sorted in buckets of `MANY` parts at most."""
    first = F.lit(0).cast("long").alias("first")
    rows = spans.select(F.col("anchor").cast("string").alias("bucket"), first, *[c for c in PARTS if c not in ("bucket", "first")], "kinds")
    out = []
    for step in (STEP, 1):
        out.append(_sorted_verdicts(rows.filter(F.col("kinds") <= MANY)))
        long = rows.filter(F.col("kinds") > MANY)
        if not long.limit(1).count():
            return out
        rows = _dealt(long, step)
    # Single windows: those of a bucket are equal.
    window = F.col("first").cast("int")
    again = rows.filter("kinds > 1 OR copies > 1")
    out.append(again.select("anchor", "digest", window.alias("first"), window.alias("last")))
    return out


def _members(docs: DataFrame) -> DataFrame:
    """The runs whose anchors occur more than once."""
    often = _all_runs(docs).groupBy("anchor").count().filter("count > 1").select("anchor")
    often = stored(often, "anchors")
    return stored(_all_runs(docs).join(often, "anchor"), "runs")


def _verdicts(docs: DataFrame, members: DataFrame) -> DataFrame:
    """`anchor`, `digest` and the repeated windows, for all runs that have any."""
    kinds = members.groupBy("anchor", "digest").agg(
        F.count("*").alias("copies"),
        F.min("count").alias("count"),
        F.min("offset").alias("offset"),
        F.min(F.struct("_id", "_hash", "start")).alias("one"),
    )
    kinds = stored(kinds, "kinds")
    # Written, so that it does not share the shuffle of the join, whose hot anchors can be split.
    several = kinds.groupBy("anchor").agg(F.count("*").alias("kinds")).filter("kinds > 1")
    several = stored(several, "several")
    both = stored(kinds.join(several, "anchor", "left"), "anchored")
    whole = both.filter(F.col("kinds").isNull()).select(
        "anchor", "digest", F.lit(0).alias("first"), (F.col("count") - 1).cast("int").alias("last")
    )
    wanted = both.filter(F.col("kinds").isNotNull()).select("*", "one.*")
    spans = stored(_fetched(docs, wanted), "spans")
    return stored(reduce(DataFrame.unionByName, _bucket_verdicts(spans), whole), "verdicts")


def _removals(docs: DataFrame) -> DataFrame:
    """Per text that loses anything: the first byte and the byte after each repeated stretch."""
    members = _members(docs)
    found = members.join(_verdicts(docs, members), ["anchor", "digest"])
    start = F.col("start") + F.col("first")
    pair = F.struct(start.alias("a"), (F.col("start") + F.col("last") + LENGTH).alias("b"))
    return found.groupBy("_id", "_hash").agg(F.sort_array(F.collect_set(pair)).alias("gone"))


def _cut(data: bytes, gone: list[dict] | None) -> tuple[list[bytes], int]:
    """The bytes that stay, in stretches, and how many stretches go."""
    kept, at, spans, end = [], 0, 0, -1
    for g in gone or ():
        if g["a"] > end:
            spans += 1
            kept.append(data[at : g["a"]])
        end = at = max(end, g["b"])
    kept.append(data[at:])
    return kept, spans


def removed_bytes(df: DataFrame, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """Per document: its bytes, those removed, the stretches removed, a digest of the rest."""
    docs = _keyed(df, doc_id, text)
    gone = stored(_removals(docs), "removals")
    both = _packed(docs).alias("d").join(gone.alias("g"), _same("d", "g"), "left")
    kind = docs.schema["_id"].dataType.simpleString()

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            out = []
            for small, cuts in zip(b.column("_packed"), b.column("gone")):
                data = _unpack(small.as_py())
                kept, spans = _cut(data, cuts.as_py())
                rest = hashlib.sha256()
                for k in kept:
                    rest.update(k)
                out.append((len(data), len(data) - sum(map(len, kept)), spans, rest.hexdigest()))
            cols = list(zip(*out)) if out else [()] * 4
            types = (pa.int64(), pa.int64(), pa.int64(), pa.string())
            yield pa.RecordBatch.from_arrays(
                [b.column("_id"), *[pa.array(c, t) for c, t in zip(cols, types)]],
                ["doc_id", "n_bytes", "n_removed", "n_spans", "kept_sha256"],
            )

    return both.select("d._id", "d._packed", "g.gone").mapInArrow(
        run, f"doc_id {kind}, n_bytes long, n_removed long, n_spans long, kept_sha256 string"
    )


def without_repeats(df: DataFrame) -> DataFrame:
    """`df` with repeated stretches cut out of `text` and `n_chars`, where there is one, anew.

    A code point that a cut leaves in part goes as a whole; a null text stays null.
    """
    keyed = _keyed(df, "doc_id", "text")
    gone = stored(_removals(keyed), "removals")
    body = F.coalesce(F.col("row.text"), F.lit("")).cast("binary")
    rest = [c for c in df.columns if c not in ("text", "n_chars")]
    rows = df.select(F.struct(*[F.col(f"`{c}`") for c in df.columns]).alias("row")).select(
        F.struct(*[F.col(f"row.`{c}`") for c in rest]).alias("rest"),
        F.col("row.text").isNull().alias("_null"),
        F.col("row.doc_id").alias("_id"),
        _digest(body).alias("_hash"),
        body.alias("_text"),
    )
    both = _packed(rows).alias("d").join(gone.alias("g"), _same("d", "g"), "left")

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            texts = []
            for small, cuts, null in zip(b.column("_packed"), b.column("gone"), b.column("_null")):
                kept, _ = _cut(_unpack(small.as_py()), cuts.as_py())
                texts.append(None if null.as_py() else b"".join(kept).decode(errors="ignore"))
            yield pa.RecordBatch.from_arrays(
                [b.column("rest"), pa.array(texts, pa.string())], ["rest", "text"]
            )

    kind = rows.schema["rest"].dataType.simpleString()
    out = both.select("d.rest", "d._null", "d._packed", "g.gone").mapInArrow(
        run, f"rest {kind}, text string"
    )
    new = {"text": F.col("text"), "n_chars": F.length("text").cast("long")}
    return out.select(*[(new[c] if c in new else F.col(f"rest.`{c}`")).alias(c) for c in df.columns])
