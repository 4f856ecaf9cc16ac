"""Near duplicates by SimHash, found with multi-index hashing.

The 64 bits are cut into segments. If two fingerprints differ in at most `d` bits and each
segment i has a radius r_i with sum(r_i) = d - segments + 1, then in some segment they differ
in r_i bits at most. So every fingerprint is filed under each of its segments, looks into the
table entries of the small Hamming ball around each, and complete distances decide. With three
segments that is 45 rows for a fingerprint, and two million entries for a segment; beyond
`MANY_PRINTS` fingerprints there are two segments, with 562 rows and four billion entries.

An entry with over `SPLIT` rows is a table of its own: its fingerprints agree in that segment but
for the flipped bits, so the same is done with their other bits, and again with what is left
then. So however many fingerprints share a segment, a task holds few of them at a time.

Texts with equal fingerprints are one class from the start. In a long table entry links are
followed from one fingerprint to the next over those not yet reached, so a dense entry costs
little more than its length, any other the product of those filed and those that look, and all
that comes out is a tree of links, never all pairs. Components come from
alternating large-star and small-star steps over written tables.

Defined cases: null and wordless texts have the fingerprint zero; texts shorter than a
shingle are one shingle; null ids never name a component that has another id; repeated rows
share a component; an empty table gives no rows.
"""

from __future__ import annotations

from collections.abc import Iterable, Iterator
from functools import reduce
from itertools import accumulate, combinations

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lakeops.llm.common import packed, stored

SEED = 42
SEGMENTS = 3
# Fingerprints beyond which the segments are wider.
MANY_PRINTS = 1 << 24
# Table entries longer than this are linked by following links.
LONG_ENTRY = 64
# Rows of an entry beyond which it is split by its other bits.
SPLIT = 20_000
# Shingles whose bits are counted at once.
BLOCK = 1 << 16


def fingerprint(text: bytes, shingle: int) -> int:
    """Majority bits of the shingles' XXH64, repeats included."""
    words = text.lower().split()
    if not words:
        return 0
    line = b" ".join(words)
    if len(words) < shingle:
        hashes = [xxhash.xxh64_intdigest(line, SEED)]
    else:
        ends = list(accumulate(len(w) + 1 for w in words))
        starts = [0, *ends]
        hashes = [
            xxhash.xxh64_intdigest(line[a : b - 1], SEED)
            for a, b in zip(starts, ends[shingle - 1 :])
        ]
    values = np.array(hashes, np.uint64).view(np.uint8).reshape(-1, 8)
    ones = np.zeros(64, np.int64)
    for at in range(0, len(values), BLOCK):
        bits = np.unpackbits(values[at : at + BLOCK], axis=1, bitorder="little")
        ones += bits.sum(axis=0, dtype=np.int64)
    return int(np.packbits(2 * ones > len(hashes), bitorder="little").view(np.uint64)[0])


def fingerprints(df: DataFrame, shingle: int, doc_id: str = "doc_id", text: str = "text"):
    """`_id`, a hash of the text and `fp` of every row."""

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            texts = b.column("_text").cast(pa.binary())
            found = np.fromiter(
                (fingerprint(t.as_py(), shingle) for t in texts), np.uint64, len(texts)
            )
            yield pa.RecordBatch.from_arrays(
                [b.column("_id"), b.column("_hash"), pa.array(found.view(np.int64))],
                ["_id", "_hash", "fp"],
            )

    body = F.coalesce(F.col(f"`{text}`"), F.lit(""))
    rows = df.select(
        F.col(f"`{doc_id}`").cast("long").alias("_id"),
        F.xxhash64(body).alias("_hash"),
        body.alias("_text"),
    )
    return rows.mapInArrow(run, "_id long, _hash long, fp long")


def _signed(x: int) -> int:
    return x - (1 << 64) if x >> 63 else x


def balls(
    distance: int, segments: int, mask: int = (1 << 64) - 1
) -> list[tuple[int, list[int]]]:
    """For every segment of the bits of `mask` its own mask and the bit patterns of its ball; the
    first has the centre."""
    spare = max(0, distance - segments + 1)
    places = [b for b in range(64) if mask >> b & 1]
    out, low = [], 0
    for s in range(segments):
        width = len(places) // segments + (s >= segments - len(places) % segments)
        radius = spare // segments + (s < spare % segments)
        bits = [1 << b for b in places[low : low + width]]
        flips = [sum(c) for r in range(radius + 1) for c in combinations(bits, r)]
        out.append((_signed(sum(bits)), [_signed(x) for x in flips]))
        low += width
    return out


def _filed(rows: DataFrame, distance: int, segments: int, rest: int) -> DataFrame:
    """Rows (`entry`, `fp`, `home`) filed under the segments of the bits `rest`, within their entry.

    `home` tells whether the fingerprint is filed there or only looks there, and `rest` becomes
    the bits that no entry it is in has looked at.
    """
    out = None
    for s, (mask, flips) in enumerate(balls(distance, segments, rest)):
        looks = rows.select("entry", "fp", "home", F.explode(F.array(*map(F.lit, flips))).alias("flip"))
        key = F.col("fp").bitwiseXOR(F.col("flip")).bitwiseAND(F.lit(mask))
        part = looks.select(
            F.xxhash64("entry", F.lit(s), key).alias("entry"),
            "fp",
            (F.col("home") & (F.col("flip") == 0)).alias("home"),
            F.lit(_signed(rest & ~mask)).alias("rest"),
        )
        out = part if out is None else out.unionAll(part)
    return out


def _entries(prints: DataFrame, distance: int, segments: int) -> DataFrame:
    """`entry`, `fp` and `home`, in entries of `SPLIT` rows at most while bits are left."""
    start = prints.select(F.lit(0).cast("long").alias("entry"), "fp", F.lit(True).alias("home"))
    rows, done = _filed(start, distance, segments, (1 << 64) - 1), None
    while True:
        sizes = rows.groupBy("entry", "rest").agg(F.count("*").alias("n"), F.max("home").alias("any"))
        long = stored(sizes.filter((F.col("n") > SPLIT) & F.col("any")).select("entry", "rest"), "long")
        # One number for each set of bits that is left, of which there are few.
        masks = [r[0] for r in long.select("rest").distinct().collect()]
        masks = [m for m in masks if (m % (1 << 64)).bit_count() > distance]
        if not masks:
            return rows if done is None else done.unionAll(rows)
        split = long.filter(F.col("rest").isin(masks))
        kept = rows.join(split.select("entry"), "entry", "left_anti")
        done = kept if done is None else done.unionAll(kept)
        inside = stored(rows.join(split.select("entry"), "entry", "left_semi"), "inside")
        parts = [
            _filed(inside.filter(F.col("rest") == m), distance, segments, m % (1 << 64)) for m in masks
        ]
        rows = reduce(DataFrame.unionAll, parts)


def _tree(values: np.ndarray, home: np.ndarray, distance: int) -> tuple[np.ndarray, np.ndarray]:
    """Links that connect what links of short distance, with one end at home, connect.

    One link for each value but a component's first: values once reached are compared no more,
    and those not at home only with those that are.
    """
    homes, guests, a, b = values[home], values[~home], [], []
    while len(homes):
        queue, homes = [(homes[0], True)], homes[1:]
        while queue:
            x, at_home = queue.pop()
            near = np.bitwise_count(homes ^ x) <= distance
            found, homes = homes[near], homes[~near]
            queue.extend((y, True) for y in found)
            if at_home:
                near = np.bitwise_count(guests ^ x) <= distance
                more, guests = guests[near], guests[~near]
                queue.extend((y, False) for y in more)
                found = np.concatenate([found, more])
            a.append(np.full(len(found), x))
            b.append(found)
    none = np.zeros(0, np.uint64)
    return np.concatenate([none, *a]), np.concatenate([none, *b])


def _links(entry: np.ndarray, fp: np.ndarray, home: np.ndarray, distance: int):
    """Links within entries; rows are sorted by entry, those at home first."""
    new = np.r_[True, entry[1:] != entry[:-1]]
    starts = np.flatnonzero(new)
    sizes = np.diff(np.r_[starts, len(entry)])
    size = np.repeat(sizes, sizes)
    long = sizes > LONG_ENTRY
    for at, n in zip(starts[long], sizes[long]):
        if home[at]:
            yield _tree(fp[at : at + n], home[at : at + n], distance)
    keep = (size <= LONG_ENTRY) & (size > 1)
    entry, fp, home = entry[keep], fp[keep], home[keep]
    for lag in range(1, int(size[keep].max(initial=1))):
        at = np.flatnonzero((entry[lag:] == entry[:-lag]) & home[:-lag])
        if not len(at):
            break
        at = at[np.bitwise_count(fp[at] ^ fp[at + lag]) <= distance]
        yield fp[at], fp[at + lag]


def links(prints: DataFrame, distance: int, segments: int) -> DataFrame:
    """Links `a` < `b` between different fingerprints that connect all near ones."""

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def made(parts, last: bool):
            cut = len(parts[0]) if last else int(np.searchsorted(parts[0], parts[0][-1]))
            if cut:
                found = list(_links(*[p[:cut] for p in parts], distance))
                if found:
                    a = np.concatenate([x for x, _ in found]).view(np.int64)
                    b = np.concatenate([x for _, x in found]).view(np.int64)
                    pair = np.unique(np.stack([np.minimum(a, b), np.maximum(a, b)], 1), axis=0)
                    yield pa.RecordBatch.from_arrays(
                        [pa.array(pair[:, 0]), pa.array(pair[:, 1])], ["a", "b"]
                    )
            return [p[cut:] for p in parts]

        held = None
        for batch in batches:
            if not batch.num_rows:
                continue
            cols = [c.to_numpy(zero_copy_only=False) for c in batch.columns]
            cols[1] = cols[1].view(np.uint64)
            held = cols if held is None else [np.concatenate(p) for p in zip(held, cols)]
            held = yield from made(held, last=False)
        if held is not None and len(held[0]):
            yield from made(held, last=True)

    rows = _entries(prints, distance, segments).select("entry", "fp", "home").repartition("entry")
    rows = rows.sortWithinPartitions("entry", F.desc("home"))
    return rows.mapInArrow(run, "a long, b long").filter("a <> b").distinct()


def components(edges: DataFrame) -> DataFrame:
    """`node` and `root`, the smallest node that `edges` (`a`, `b`) reach from it.

    Every step replaces edges by ones that lead to smaller nodes, until all are stars. Steps
    are written; what the driver sees is a count and a checksum.
    """

    def star(e: DataFrame, large: bool) -> DataFrame:
        if large:
            near = e.select("a", "b").unionAll(e.select(F.col("b").alias("a"), F.col("a").alias("b")))
        else:
            near = e.select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b"))
        least = near.groupBy("a").agg(F.min("b").alias("m"))
        least = least.select("a", F.least("a", "m").alias("m"))
        both = near.join(least, "a")
        if large:
            out = both.filter("b > a").select(F.col("b").alias("a"), F.col("m").alias("b"))
        else:
            out = both.select(F.col("b").alias("a"), F.col("m").alias("b"))
            out = out.unionAll(least.select("a", F.col("m").alias("b")))
        return out.filter("a <> b").distinct()

    def state(e: DataFrame):
        return tuple(e.agg(F.count("*"), F.bit_xor(F.xxhash64("a", "b"))).first())

    edges = stored(edges.filter("a <> b"), "edges")
    seen = None
    while (now := state(edges)) != seen and now[0]:
        seen = now
        edges = stored(star(star(edges, large=True), large=False), "edges")
    roots = edges.select(F.col("a").alias("node"), F.col("b").alias("root"))
    return roots.unionAll(edges.select(F.col("b").alias("node"), F.col("b").alias("root"))).distinct()


def classes(df: DataFrame, shingle: int, distance: int) -> DataFrame:
    """`_id`, `_hash`, `fp`, `root` (a component's fingerprint) and `component_id` per row."""
    rows = stored(fingerprints(df, shingle), "prints")
    prints = stored(rows.groupBy("fp").agg(F.min("_id").alias("least")), "classes")
    segments = SEGMENTS if prints.count() <= MANY_PRINTS else SEGMENTS - 1
    found = components(links(prints, distance, min(segments, distance + 1)))
    joined = prints.join(found, prints["fp"] == found["node"], "left")
    roots = stored(joined.select("fp", "least", F.coalesce("root", "fp").alias("root")), "roots")
    # Written, so that it does not share the shuffle of the join, whose hot roots can be split.
    least = stored(roots.groupBy("root").agg(F.min("least").alias("component_id")), "least")
    named = stored(roots.select("fp", "root").join(least, "root"), "components")
    return rows.join(named, "fp").select("_id", "_hash", "fp", "root", "component_id")


def near_duplicates(df: DataFrame, shingle: int = 4, distance: int = 4) -> DataFrame:
    """One row per document: its fingerprint and the smallest id that links reach."""
    return classes(df, shingle, distance).select(
        F.col("_id").alias("doc_id"),
        F.lpad(F.lower(F.hex("fp")), 16, "0").alias("fingerprint"),
        "component_id",
    )


def keep_one(df: DataFrame, shingle: int = 4, distance: int = 4) -> DataFrame:
    """One row of every component, that with the smallest id; all columns are kept."""
    found = stored(classes(df, shingle, distance), "members")
    first = F.struct(F.col("_id").isNull(), F.col("_id"), F.col("_hash"))
    best = found.groupBy("root").agg(F.min(first).alias("best"))
    best = best.select("root", F.col("best._id").alias("_k"), F.col("best._hash").alias("_h"))
    best = stored(best, "best")
    gone = found.alias("m").join(
        best.alias("b"),
        (F.col("m.root") == F.col("b.root"))
        & F.col("m._id").eqNullSafe(F.col("b._k"))
        & (F.col("m._hash") == F.col("b._h")),
        "left_anti",
    )
    gone = stored(gone.select("_id", "_hash").distinct(), "dropped")
    rows = packed(df).select(
        "row",
        F.col("row.doc_id").cast("long").alias("_id"),
        F.xxhash64(F.coalesce(F.col("row.text"), F.lit(""))).alias("_hash"),
    )
    same = F.col("d._id").eqNullSafe(F.col("g._id")) & (F.col("d._hash") == F.col("g._hash"))
    kept = rows.alias("d").join(gone.alias("g"), same, "left_anti")
    # Rows alike in id and text share their key; only tables that have such rows pay for it.
    if found.groupBy("_id", "_hash").count().filter("count > 1").limit(1).count():
        kept = kept.dropDuplicates(["_id", "_hash"])
    return kept.select("row.*")
