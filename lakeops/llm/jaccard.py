"""Join of documents by the Jaccard similarity of their word shingles, filtered by several orders.

Texts with equal sets are one node. If two sets are similar enough then, whatever the order of
tokens, the first token that they share stands near the front of both: it is in their prefixes,
and its places bound what they can share. A pair is compared in full only if it has such a token
under every one of several orders.

The first orders tell which documents can have a partner at all, and who it can be. One puts a
slice of the hash space before the rest and in it rare tokens before frequent ones, so counts over
all documents are needed for that slice alone. Tokens of one document come first and meet nobody,
and most documents are out. The others are read again, and counted again among themselves in full:
that order puts all tokens of one document first, so texts that differ in many places meet no
more. Candidates come from it, and have to pass two orders by hash before they are compared.

What very many documents share is not paired with itself. Each posting list compares all its
members with one of them, that with the fewest tokens of its own; the links found give components.
Only members of other components than that one's are then held against the list, so a group of
near copies costs its length and what stays out of it, and no link between components is lost.
Links within a component may be left out, as components are all that is returned.

Defined cases: null and wordless texts have the empty set and link with nothing, not even each
other; texts shorter than a shingle are one shingle; null ids never name a component that has
another id; rows that repeat share a component; an empty table gives no rows. Ids are integers.
"""

from __future__ import annotations

import math
from collections.abc import Iterable, Iterator
from hashlib import blake2b

import numpy as np
import pandas as pd
import pyarrow as pa
import zstandard
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from lakeops.llm.common import stored
from lakeops.llm.simhash import components

# One part in so many of the hash space is counted and comes first in the first order.
SLICE = 6
LOW = (1 << 64) // SLICE
# Orders by hash that candidates have to pass after those by frequency.
SEEDS = (1, 2)


def _mixed(x: np.ndarray) -> np.ndarray:
    """A bijection of 64-bit numbers whose bits all depend on all."""
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def shingles(text: bytes, size: int) -> np.ndarray:
    """The set of a text: hashes of its different shingles, ascending."""
    words = text.lower().split()
    if not words:
        return np.zeros(0, np.uint64)
    size = min(size, len(words))
    hashes = pd.util.hash_array(np.array(words, object), categorize=False)
    n = len(words) - size + 1
    found = np.full(n, size, np.uint64)
    for i in range(size):
        found = _mixed(found * np.uint64(0x9E3779B97F4A7C15) + hashes[i : i + n])
    return np.unique(found)


def prefix_size(n: int, percent: int) -> int:
    """How many of `n` tokens there are up to the last that similar sets may have first in common."""
    return (100 - percent) * n // 100 + 1


def _texts(df: DataFrame, doc_id: str, text: str) -> DataFrame:
    body = F.coalesce(F.col(f"`{text}`"), F.lit(""))
    return df.select(
        F.col(f"`{doc_id}`").cast("long").alias("_id"),
        F.xxhash64(body).alias("_hash"),
        body.alias("_text"),
    )


def _lists(arrays: list[np.ndarray]) -> pa.Array:
    ends = np.cumsum([0, *map(len, arrays)])
    flat = np.concatenate([np.zeros(0, np.uint64), *arrays]).view(np.int64)
    return pa.ListArray.from_arrays(pa.array(ends, pa.int32()), pa.array(flat))


def measured(df: DataFrame, size: int, percent: int, doc_id: str, text: str) -> DataFrame:
    """Per row `n` shingles, the digest `key` of the set, and `head`, the tokens it is filed under:
    those of the slice, `low` of them, or all if these do not fill the prefix."""

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            keys, sizes, lows, heads = [], [], [], []
            for t in b.column("_text").cast(pa.binary()):
                found = shingles(t.as_py(), size)
                low = int(np.searchsorted(found, np.uint64(LOW)))
                keys.append(blake2b(found.tobytes(), digest_size=16).digest())
                sizes.append(len(found))
                lows.append(low)
                heads.append(found if low < prefix_size(len(found), percent) else found[:low])
            yield pa.RecordBatch.from_arrays(
                [b.column("_id"), b.column("_hash"), pa.array(keys, pa.binary()),
                 pa.array(sizes, pa.int64()), pa.array(lows, pa.int64()), _lists(heads)],
                ["_id", "_hash", "key", "n", "low", "head"],
            )

    schema = "_id long, _hash long, key binary, n long, low long, head array<long>"
    return _texts(df, doc_id, text).mapInArrow(run, schema)


def prefixes(nodes: DataFrame, percent: int, sliced: bool) -> DataFrame:
    """`token`, `node`, `n`, `at` and `own` for tokens in a prefix that two nodes at least have.

    `nodes` have `n` tokens and are filed under those in `head`. With `sliced` the `low` tokens of
    the slice come first, else rare ones do. `at` is the token's place in the order, and `own`
    counts the tokens in `head` of no other node.
    """
    postings = nodes.select("node", F.explode("head").alias("token"))
    counts = postings.groupBy("token").agg(F.count("*").alias("df")).filter("df > 1")
    shared = postings.join(stored(counts, "tokens"), "token")
    high = ~F.col("token").between(0, LOW - 1) if sliced else F.lit(False)
    order = F.sort_array(F.collect_list(F.struct(high.alias("high"), "df", "token")))
    ranked = shared.groupBy("node").agg(order.alias("found"))
    ranked = ranked.join(nodes.select("node", "n", "low", F.size("head").alias("sent")), "node")

    n_low = F.size(F.filter("found", lambda x: ~x["high"]))
    ranked = ranked.withColumn("n_low", n_low)
    # Tokens of one node come first in the slice, and first in the rest.
    place = F.when(F.col("x.high"), F.col("sent") - F.size("found")).otherwise(F.col("low") - F.col("n_low"))
    return (
        ranked.select("*", F.posexplode("found").alias("i", "x"))
        .select(
            F.col("x.token").alias("token"),
            "node",
            "n",
            (place + F.col("i")).cast("long").alias("at"),
            (F.col("sent") - F.size("found")).cast("long").alias("own"),
        )
        .filter(100 * F.col("at") <= (100 - percent) * F.col("n"))
    )


def _may(a: str, b: str, percent: int) -> Column:
    """Whether two sets whose first common token stands at these places can be similar."""
    rest = F.least(F.col(f"{a}.n") - F.col(f"{a}.at"), F.col(f"{b}.n") - F.col(f"{b}.at"))
    return (100 + percent) * rest >= percent * (F.col(f"{a}.n") + F.col(f"{b}.n"))


def _pairs(met: DataFrame) -> DataFrame:
    a, b = F.col("x.node"), F.col("y.node")
    return met.select(F.least(a, b).alias("a"), F.greatest(a, b).alias("b")).distinct()


def hopeful(filed: DataFrame, percent: int) -> DataFrame:
    """The nodes that may be similar to another of a list they are in, by what the list has.

    Lists are cut into bands of sizes, so wide that similar sets are in one or in neighbours; each
    set is in its own and in the next. Of the others there, the one with fewest tokens and the one
    that lets the largest set be similar to it are enough to tell. Where a node is that one
    itself, it stays.
    """
    reach = (100 + percent) * (F.col("n") - F.col("at")) - percent * F.col("n")
    width = max(math.log(100 / percent), 1e-6) * (1 + 1e-9)
    band = F.floor(F.log("n") / width)
    rows = filed.withColumns({"reach": reach, "band": F.explode(F.array(band, band + 1))})
    rows = rows.withColumn("home", F.col("band") == band)
    lists = rows.groupBy("token", "band").agg(
        F.count("*").alias("members"),
        F.max("home").alias("any"),
        F.min(F.struct("n", "node")).alias("least"),
        F.max(F.struct("reach", "node")).alias("most"),
    )
    lists = stored(lists.filter("members > 1 AND any").drop("members", "any"), "lists")
    met = rows.join(lists, ["token", "band"])
    smaller = (F.col("least.node") == F.col("node")) | (F.col("reach") >= percent * F.col("least.n"))
    larger = (F.col("most.node") == F.col("node")) | (F.col("most.reach") >= percent * F.col("n"))
    return met.filter(smaller & larger).select("node").distinct()


def first_pairs(filed: DataFrame, pivots: DataFrame, percent: int) -> DataFrame:
    """Candidates of every list's pivot with the list."""
    met = filed.alias("x").join(pivots.alias("y"), F.col("x.token") == F.col("y.token"))
    return _pairs(met.filter((F.col("x.node") != F.col("y.node")) & _may("x", "y", percent)))


def other_pairs(filed: DataFrame, pivots: DataFrame, roots: DataFrame, percent: int) -> DataFrame:
    """Candidates in different components, one of them not in that of the list's pivot."""
    known = filed.join(roots, "node", "left").withColumn("root", F.coalesce("root", "node"))
    of_pivot = pivots.select("token", "node").join(roots, "node", "left")
    of_pivot = of_pivot.select("token", F.coalesce("root", "node").alias("centre"))
    known = stored(known.join(of_pivot, "token"), "known")
    outside = known.filter("root <> centre")
    lists = stored(outside.select("token").distinct(), "open_lists")
    every = known.join(lists, "token", "left_semi")
    met = outside.alias("x").join(every.alias("y"), F.col("x.token") == F.col("y.token"))
    return _pairs(met.filter((F.col("x.root") != F.col("y.root")) & _may("x", "y", percent)))


def profiles(df: DataFrame, nodes: DataFrame, size: int, percent: int, doc_id: str, text: str):
    """`node`, its whole `tokens`, and its prefix under each order by hash, `p0` and so on."""

    def pack(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        press = zstandard.ZstdCompressor(level=3)
        for b in batches:
            small = [press.compress(t.as_py()) for t in b.column("_text").cast(pa.binary())]
            columns = [b.column("_id"), b.column("_hash"), pa.array(small, pa.binary())]
            yield pa.RecordBatch.from_arrays(columns, ["_id", "_hash", "_packed"])

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        unpack = zstandard.ZstdDecompressor()
        for b in batches:
            sets = [shingles(unpack.decompress(t.as_py()), size) for t in b.column("_packed")]
            columns = [b.column("node"), _lists(sets)]
            for seed in SEEDS:
                first = [
                    s[np.argsort(_mixed(s + np.uint64(seed)), kind="stable")][: prefix_size(len(s), percent)]
                    for s in sets
                ]
                columns.append(_lists(first))
            yield pa.RecordBatch.from_arrays(columns, names)

    names = ["node", "tokens", *(f"p{i}" for i in range(len(SEEDS)))]
    wanted = nodes.select("node", F.col("rep._id").alias("_w"), F.col("rep._hash").alias("_x"))
    same = F.col("_id").eqNullSafe(F.col("_w")) & (F.col("_hash") == F.col("_x"))
    # Texts are compressed on their way through the shuffle.
    packed = _texts(df, doc_id, text).mapInArrow(pack, "_id long, _hash long, _packed binary")
    rows = packed.join(wanted, same).select("node", "_packed")
    schema = ", ".join(["node long", *(f"{c} array<long>" for c in names[1:])])
    # Rows alike in id and text are one node.
    return rows.mapInArrow(run, schema).dropDuplicates(["node"])


def similar(pairs: DataFrame, known: DataFrame, percent: int) -> DataFrame:
    """The pairs that share a prefix token under every order by hash, and are similar."""
    orders = [f"p{i}" for i in range(len(SEEDS))]

    def side(columns: list[str], end: str) -> DataFrame:
        return known.select(F.col("node").alias(end), *[F.col(c).alias(f"{end}_{c}") for c in columns])

    met = pairs.join(side(orders, "a"), "a").join(side(orders, "b"), "b")
    for p in orders:
        met = met.filter(F.arrays_overlap(f"a_{p}", f"b_{p}"))
    met = stored(met.select("a", "b"), "candidates")
    met = met.join(side(["tokens"], "a"), "a").join(side(["tokens"], "b"), "b")
    both = F.size(F.array_intersect("a_tokens", "b_tokens"))
    every = F.size("a_tokens") + F.size("b_tokens") - both
    return met.filter(100 * both.cast("long") >= percent * every.cast("long")).select("a", "b")


def near_sets(
    df: DataFrame, size: int = 3, percent: int = 90, doc_id: str = "doc_id", text: str = "text"
) -> DataFrame:
    """One row per document: `n_shingles` and the smallest id that links reach."""
    rows = stored(measured(df, size, percent, doc_id, text), "sets")
    least = F.min(F.struct(F.col("_id").isNull().alias("nameless"), "_id", "_hash")).alias("rep")
    sets = rows.filter("n > 0").groupBy("key").agg(
        least, *[F.first(c).alias(c) for c in ("n", "low", "head")]
    )
    nodes = stored(sets.withColumn("node", F.monotonically_increasing_id()), "nodes")

    filed = stored(prefixes(nodes, percent, sliced=True).select("token", "node", "n", "at"), "prefixes")
    met = hopeful(filed, percent)
    candidates = stored(nodes.join(met, "node", "left_semi").select("node", "rep"), "met")
    known = stored(profiles(df, candidates, size, percent, doc_id, text), "profiles")

    n = F.size("tokens").cast("long")
    wide = known.select("node", n.alias("n"), n.alias("low"), F.col("tokens").alias("head"))
    filed = stored(prefixes(wide, percent, sliced=False), "prefixes")
    centre = F.min(F.struct("own", "node", "n", "at")).alias("c")
    pivots = filed.groupBy("token").agg(centre, F.count("*").alias("members")).filter("members > 1")
    pivots = stored(pivots.select("token", "c.node", "c.n", "c.at"), "pivots")
    first = stored(first_pairs(filed, pivots, percent), "first_pairs")
    links = stored(similar(first, known, percent), "links")
    roots = stored(components(links).select("node", "root"), "roots")
    rest = other_pairs(filed, pivots, roots, percent).join(first, ["a", "b"], "left_anti")
    more = stored(similar(stored(rest, "other_pairs"), known, percent), "links")
    if more.limit(1).count():
        roots = stored(components(links.unionAll(more)).select("node", "root"), "roots")

    named = nodes.select("key", "node", F.col("rep._id").alias("least")).join(roots, "node", "left")
    named = stored(named.withColumn("root", F.coalesce("root", "node")), "named")
    least = named.groupBy("root").agg(F.min("least").alias("component_id"))
    named = stored(named.select("key", "root").join(stored(least, "least"), "root").drop("root"), "named")
    linked = rows.filter("n > 0").select("_id", "n", "key").join(named, "key")
    alone = rows.filter("n = 0").select("_id", "n", F.col("_id").alias("component_id"))
    return linked.select("_id", "n", "component_id").unionAll(alone).toDF(
        "doc_id", "n_shingles", "component_id"
    )
