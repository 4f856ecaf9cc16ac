"""Trie of the prefixes that conversations share, built as a z-fast trie.

A prefix of d turns is known by two 64-bit numbers: the exclusive or of hashes of its turns, each
salted with its place. Prefixes of all lengths are running sums then, so a conversation is cut
into blocks of turns and never has to be in one task.

The trie is compacted: a node ends an edge `(lo, e]` of turns on the path of a conversation `rep`.
Its handle is the prefix of it whose length has the most trailing zeros in that range. Conversations
come in batches, each several times the one before. Each finds its exit edge by a fat binary search:
it looks up its own prefix of the fattest length between what is known to be inside and what is
known to be outside, so it takes as many lookups as its length has bits. Where it leaves the
edge, the edge is split; what is beyond is compacted among those that leave there together.
At the end every edge is expanded into one row per turn.

All lookups are joins with written tables, whose hot keys the adaptive plan splits. What a window
over one conversation holds are the ends of edges on its path. The digest of the members that end
at a node is sequential by its contract: one task reads their ids one by one.

Defined cases: turns are ordered by number (null first), then role, then text; null roles and
texts are empty; rows without a conversation belong to none and are left out; rows that repeat
are turns of their own; an empty table gives no rows, not even the root.
"""

from __future__ import annotations

from collections.abc import Iterable, Iterator
from hashlib import sha256

import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from lakeops.llm.common import stored

# Turns of a conversation that are summed in one window.
BLOCK = 4096
# Of 64 parts of the conversations, those inserted up to the end of each batch.
BATCHES = (1, 8, 64)


def _before(*group: str, order: Column) -> Window:
    return Window.partitionBy(*group).orderBy(order).rowsBetween(Window.unboundedPreceding, -1)


def numbered(df: DataFrame, group: str, order: list[str]) -> DataFrame:
    """`df` with `pos`, from 1 in each group, by the order; nulls come first.

    Rows are sorted into ranges of group and order together, so a group may lie in many tasks.
    """
    ranges = stored(df.repartitionByRange(group, *order).withColumn("_part", F.spark_partition_id()), "ranges")
    counts = ranges.groupBy(group, "_part").agg(F.count("*").alias("_n"))
    start = F.sum("_n").over(_before(group, order=F.col("_part"))).alias("_start")
    starts = stored(counts.select(group, "_part", start).filter("_start IS NOT NULL"), "starts")
    inside = Window.partitionBy(group, "_part").orderBy(*order)
    rows = ranges.withColumn("pos", F.row_number().over(inside).cast("long"))
    rows = rows.join(starts, [group, "_part"], "left")
    return rows.withColumn("pos", F.col("pos") + F.coalesce("_start", F.lit(0))).drop("_part", "_start")


def running(df: DataFrame, group: str, at: str, xors: list[str], sums: list[str]) -> DataFrame:
    """`df` with columns replaced by what they come to up to each row, in blocks of places."""
    rows = df.withColumn("_block", F.floor(F.col(at) / BLOCK))
    inside = Window.partitionBy(group, "_block").orderBy(at).rowsBetween(Window.unboundedPreceding, 0)
    folds = {**dict.fromkeys(xors, F.bit_xor), **dict.fromkeys(sums, F.sum)}
    totals = rows.groupBy(group, "_block").agg(*[f(c).alias(f"_{c}") for c, f in folds.items()])
    before = _before(group, order=F.col("_block"))
    carried = [f(f"_{c}").over(before).alias(f"_{c}") for c, f in folds.items()]
    carried = totals.select(group, "_block", *carried)
    carried = stored(carried.filter(" OR ".join(f"_{c} IS NOT NULL" for c in folds)), "carried")
    rows = rows.withColumns({c: f(c).over(inside) for c, f in folds.items()})
    rows = rows.join(carried, [group, "_block"], "left")
    done = {c: F.col(c).bitwiseXOR(F.coalesce(f"_{c}", F.lit(0))) for c in xors}
    done |= {c: F.col(c) + F.coalesce(f"_{c}", F.lit(0)) for c in sums}
    return rows.withColumns(done).drop("_block", *[f"_{c}" for c in folds])


def ordered_turns(df: DataFrame) -> DataFrame:
    """`conv`, `pos` from 1, a hash `h` of role and text, and the code points of the text, `size`."""
    rows = df.filter("conv_id IS NOT NULL").select(
        F.col("conv_id").cast("long").alias("conv"),
        "turn",
        F.coalesce("role", F.lit("")).alias("role"),
        F.coalesce("text", F.lit("")).alias("text"),
    )
    rows = numbered(rows, "conv", ["turn", "role", "text"])
    h = F.struct(F.xxhash64(F.lit(1), "role", "text"), F.xxhash64(F.lit(2), "role", "text"))
    return rows.select("conv", "pos", h.alias("h"), F.length("text").cast("long").alias("size"))


def rebuilt(turns: DataFrame, every: int = 100, most: int = 6) -> tuple[DataFrame, DataFrame]:
    """The turns of all conversations that begin like the first of their `every`, and the ids.

    A conversation takes the first h turns of that one in place of its own first h, with h below
    `most` by a checksum of its id.
    """
    turns = stored(turns, "turns")
    sizes = stored(turns.groupBy("conv").agg(F.max("pos").alias("has")), "conversations")
    conv = F.col("conv")
    upto = F.crc32(conv.cast("string").cast("binary")) % most
    convs = sizes.select("conv", (conv - conv % every).alias("base"), upto.alias("upto"))
    bases = sizes.withColumnRenamed("conv", "base")
    k = F.least("upto", F.coalesce("has", F.lit(0))).alias("k")
    plan = stored(convs.join(bases, "base", "left").select("conv", "base", "upto", k), "plan")
    heads = turns.filter((F.col("pos") < most) & (conv % every == 0)).withColumnRenamed("conv", "base")
    heads = plan.join(heads, "base").filter("pos <= upto").select("conv", "pos", "h", "size")
    own = turns.join(plan, "conv").filter("pos > upto")
    own = own.select("conv", (F.col("pos") - F.col("upto") + F.col("k")).alias("pos"), "h", "size")
    return heads.unionByName(own), plan.select("conv")


def paths(turns: DataFrame) -> DataFrame:
    """Every prefix of every conversation: `conv`, its length `d`, digest `p`, `q`, the digest
    `pp`, `pq` of the prefix before, the code points `size` of its last turn and `total` of all."""
    salted = {c: F.xxhash64(F.lit(i), "pos", "h") for i, c in enumerate("pq")}
    rows = turns.select("conv", F.col("pos").alias("d"), "size", *[v.alias(c) for c, v in salted.items()])
    rows = rows.withColumns({"pp": F.col("p"), "pq": F.col("q"), "total": F.col("size")})
    rows = stored(rows, "turns")
    rows = running(rows, "conv", "d", ["p", "q"], ["total"])
    return rows.withColumns({f"p{c}": F.col(f"p{c}").bitwiseXOR(F.col(c)) for c in "pq"})


def _fattest(low: str, high: str) -> Column:
    """The number in (low, high] with the most trailing zeros."""
    bits = f"shiftleft(-1L, length(bin({low} ^ {high})) - 1)"
    return F.expr(f"CASE WHEN {low} < {high} THEN {high} & {bits} END")


def _nodes(edges: DataFrame, rows: DataFrame) -> DataFrame:
    """Edges (`rep`, `lo`, `e`) with the digests at their handle, their end and their first turn."""
    edges = edges.withColumn("f", _fattest("lo", "e"))
    places = F.explode(F.array("f", "e", F.col("lo") + 1)).alias("d")
    found = edges.select("*", places).join(rows.select(F.col("s").alias("rep"), "d", "p", "q"), ["rep", "d"])
    at = {"": F.col("e"), "h": F.col("f"), "c": F.col("lo") + 1}
    return found.groupBy("rep", "lo", "e", "f").agg(
        *[F.max(F.when(F.col("d") == d, F.col(c))).alias(n + c) for n, d in at.items() for c in "pq"]
    )


def _exits(seqs: DataFrame, rows: DataFrame, trie: DataFrame) -> DataFrame:
    """Where each sequence leaves the trie: the edge it is in and the depth `at` that it shares."""
    none = F.lit(None).cast("long")
    seek = seqs.select(
        "s", "m", F.lit(0).cast("long").alias("l"), F.col("m").alias("r"),
        none.alias("rep"), none.alias("lo"), none.alias("e"),
    )
    own = rows.select("s", F.col("d").alias("f"), F.col("p").alias("hp"), F.col("q").alias("hq"))
    edge = ["rep", "lo", "e"]

    def looked_up(seek: DataFrame, place: Column, key: list[str]) -> DataFrame:
        """The edge filed under the sequence's prefix of a length, as `_rep`, `_lo`, `_e`."""
        keys = [F.col(c).alias(n) for c, n in zip(key, ("f", "hp", "hq"))]
        filed = trie.withColumn("first", F.col("lo") + 1)
        filed = filed.select(*[F.col(c).alias(f"_{c}") for c in edge], *keys)
        met = seek.withColumn("f", place).join(own, ["s", "f"], "left")
        return met.join(filed, ["f", "hp", "hq"], "left").drop("hp", "hq")

    found = F.col("_e").isNotNull()
    taken = {c: F.coalesce(f"_{c}", c) for c in edge}
    while True:
        met = looked_up(seek, _fattest("l", "r"), ["f", "hp", "hq"])
        r = F.when(found | F.col("f").isNull(), F.col("r")).otherwise(F.col("f") - 1)
        met = met.select("s", "m", F.coalesce("_e", "l").alias("l"), r.alias("r"), *[
            v.alias(c) for c, v in taken.items()
        ])
        seek = stored(met, "seek")
        if not seek.filter("l < r").limit(1).count():
            break
    # The search ends above an edge that was entered without its handle being reached.
    met = looked_up(seek, F.coalesce("e", F.lit(0)) + 1, ["first", "cp", "cq"])
    seek = stored(met.select("s", "m", *[v.alias(c) for c, v in taken.items()]), "exits")

    mine = rows.select("s", "d", "p", "q")
    theirs = rows.select(F.col("s").alias("rep"), "d", "p", "q")
    inside = seek.join(mine, "s").filter("d > lo AND d <= e")
    shared = inside.join(theirs, ["rep", "d", "p", "q"]).groupBy("s").agg(F.max("d").alias("shared"))
    at = F.coalesce("shared", "lo", F.lit(0)).alias("at")
    return seek.join(shared, "s", "left").select("s", "m", *edge, at)


def _inserted(trie: DataFrame | None, seqs: DataFrame, rows: DataFrame) -> DataFrame:
    """The trie with a batch of sequences; `rows` are the paths of all."""
    if trie is None:
        none = F.lit(None).cast("long")
        zero = F.lit(0).cast("long").alias("at")
        exits = seqs.select("s", "m", none.alias("rep"), none.alias("lo"), none.alias("e"), zero)
    else:
        exits = stored(_exits(seqs, rows, trie), "placed")

    beyond = rows.join(exits.select("s", "m", "at"), "s").filter("d > at")
    beyond = stored(beyond, "beyond")
    prefixes = beyond.groupBy("d", "p", "q", "pp", "pq").agg(
        F.min("s").alias("rep"), F.max(F.col("d") == F.col("m")).alias("ends")
    )
    prefixes = stored(prefixes, "prefixes")
    next_turns = prefixes.groupBy((F.col("d") - 1).alias("d"), F.col("pp").alias("p"), F.col("pq").alias("q"))
    next_turns = next_turns.agg(F.count("*").alias("n_next"))
    ends = prefixes.join(next_turns, ["d", "p", "q"], "left").filter("ends OR n_next <> 1")
    ends = stored(ends.select("d", "p", "q", "rep"), "ends")
    on_path = beyond.select("s", "d", "p", "q", "at").join(ends, ["d", "p", "q"])
    above = F.lag("d").over(Window.partitionBy("s").orderBy("d"))
    edges = on_path.select("s", "rep", F.col("d").alias("e"), F.coalesce(above, "at").alias("lo"))
    edges = edges.filter("s = rep").select("rep", "lo", "e")
    if trie is None:
        return stored(_nodes(edges, rows), "trie")

    cuts = stored(exits.filter("at > lo AND at < e").select("rep", "lo", "e", "at").distinct(), "cuts")
    whole = cuts.select("rep", "lo", "e").distinct()
    pieces = cuts.unionByName(whole.withColumn("at", F.col("e")))
    above = F.lag("at").over(Window.partitionBy("rep", "e").orderBy("at"))
    pieces = pieces.select("rep", F.coalesce(above, "lo").alias("lo"), F.col("at").alias("e"))
    kept = trie.join(whole.select("rep", "e"), ["rep", "e"], "left_anti")
    return stored(kept.unionByName(_nodes(pieces.unionByName(edges), rows)), "trie")


def built(seqs: DataFrame, rows: DataFrame) -> DataFrame:
    """Edges of the trie of all sequences (`s`, `m` turns), inserted batch by batch."""
    part = F.pmod(F.xxhash64("p", "q"), F.lit(BATCHES[-1]))
    trie = None
    for low, high in zip((0, *BATCHES), BATCHES):
        trie = _inserted(trie, seqs.filter((part >= low) & (part < high)), rows)
    return trie


def _member_digests(ends: DataFrame, seqs: DataFrame) -> DataFrame:
    """`s` and the digest of the ids of all conversations that are this sequence."""

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def done():
            return pa.RecordBatch.from_arrays(
                [pa.array([last], pa.int64()), pa.array([state.hexdigest()])], ["s", "sha"]
            )

        last, state = None, sha256()
        for b in batches:
            for s, conv in zip(b.column(0).to_pylist(), b.column(1).to_pylist()):
                if s != last:
                    if last is not None:
                        yield done()
                    last, state = s, sha256(b"%d" % conv)
                else:
                    state.update(b",%d" % conv)
        if last is not None:
            yield done()

    same = seqs.filter("c > 1").select("m", "p", "q", "s")
    members = ends.join(same, ["m", "p", "q"]).select("s", "conv")
    many = members.repartition("s").sortWithinPartitions("s", "conv").mapInArrow(run, "s long, sha string")
    one = seqs.filter("c = 1").select("s", F.sha2(F.col("s").cast("string"), 256).alias("sha"))
    return many.unionByName(one)


def prefix_trie(turns: DataFrame, convs: DataFrame) -> DataFrame:
    """One row per node of the trie of `turns` (`conv`, `pos`, `h`, `size`), the root included.

    `convs` names all conversations, those without turns too.
    """
    rows = stored(paths(turns), "paths")
    last = rows.groupBy("conv").agg(F.max(F.struct("d", "p", "q")).alias("x"))
    ends = convs.join(last, "conv", "left")
    zero = F.lit(0).cast("long")
    ends = ends.select("conv", *[F.coalesce(f"x.{c}", zero).alias(n) for c, n in zip("dpq", "mpq")])
    ends = stored(ends, "ends")
    seqs = ends.groupBy("m", "p", "q").agg(F.count("*").alias("c"), F.min("conv").alias("s"))
    seqs = stored(seqs, "sequences")
    rows = stored(rows.withColumnRenamed("conv", "s").join(seqs.select("s"), "s", "left_semi"), "distinct")
    trie = built(seqs.filter("m > 0"), rows).select("lo", F.col("e").alias("d"), "p", "q")

    # Nodes on the path of each sequence, first to count, then to add up along paths.
    met = rows.join(trie, ["d", "p", "q"]).join(seqs.select("s", "c"), "s")
    nodes = met.groupBy("d", "p", "q", "lo").agg(F.sum("c").alias("n"), F.min("s").alias("conv_id"))
    nodes = stored(nodes, "nodes")
    path = Window.partitionBy("s").orderBy("d")
    below = Window.partitionBy("s").orderBy(F.desc("d")).rowsBetween(Window.unboundedPreceding, 0)
    mine = F.col("s") == F.col("conv_id")
    worth = (F.col("n") - 1) * (F.col("total") - F.col("above"))
    met = rows.select("s", "d", "p", "q", "total").join(nodes, ["d", "p", "q"]).withColumns(
        {
            "above": F.coalesce(F.lag("total").over(path), F.lit(0)),
            "parent": F.lag("conv_id").over(path),
            "lp": F.coalesce(F.lag("p").over(path), F.lit(0)),
            "lq": F.coalesce(F.lag("q").over(path), F.lit(0)),
            "own": F.when(mine, worth).otherwise(0),
        }
    )
    met = stored(met.withColumn("saved", F.sum("own").over(below)), "met")
    kids = met.filter(mine).groupBy(F.col("lo").alias("d"), F.col("lp").alias("p"), F.col("lq").alias("q"))
    kids = stored(kids.agg(F.count("*").alias("kids")), "kids")
    leaf = seqs.filter("m > 0").select("s", F.col("m").alias("d"), "p", "q")
    leaf = stored(leaf.join(kids, ["d", "p", "q"], "left_anti").select("s", F.lit(1).alias("leaf")), "leaves")
    every = met.join(leaf, "s", "left").groupBy("d", "p", "q").agg(
        *[F.max(F.when(mine, F.col(c))).alias(c) for c in ("lo", "n", "conv_id", "above", "parent")],
        F.sum("saved").alias("saved"),
        F.sum(F.coalesce("leaf", F.lit(0))).alias("leaves"),
    )
    every = every.join(kids, ["d", "p", "q"], "left").withColumn("kids", F.coalesce("kids", F.lit(0)))
    every = stored(every, "summed")

    digests = stored(_member_digests(ends, seqs).join(seqs.select("s", "m", "p", "q"), "s"), "members")
    digests = digests.select(F.col("m").alias("d"), "p", "q", "sha")
    empty = F.sha2(F.lit(""), 256)
    # One number: the smallest of all is the root's.
    least = F.lit(seqs.agg(F.min("s")).first()[0]).cast("long")
    # An edge in pieces of a block, then in turns.
    start = F.explode(F.sequence(F.col("lo") + 1, F.col("d"), F.lit(BLOCK)))
    split = every.drop("p", "q").withColumnsRenamed({"conv_id": "s"}).withColumn("_start", start)
    split = split.withColumnRenamed("d", "e")
    split = split.withColumn("d", F.explode(F.sequence("_start", F.least(F.col("_start") + BLOCK - 1, "e"))))
    grown = split.join(rows, ["s", "d"]).join(digests, ["d", "p", "q"], "left")
    at_end = F.col("d") == F.col("e")
    inner = grown.select(
        F.col("s").alias("conv_id"),
        F.col("d").alias("depth"),
        F.when(F.col("d") > F.col("lo") + 1, F.col("s")).otherwise(F.coalesce("parent", least)).alias("parent_conv_id"),
        F.col("n").alias("n_convs"),
        F.when(at_end, F.col("kids")).otherwise(1).cast("long").alias("n_children"),
        F.col("leaves").cast("long").alias("n_leaves"),
        (F.col("saved") - (F.col("n") - 1) * (F.col("total") - F.col("size") - F.col("above"))).alias("saved_tokens"),
        F.coalesce("sha", empty).alias("ends_sha256"),
    )
    none, no = F.lit(None), F.lit(0).cast("long")
    top = (
        seqs.select(F.col("s").alias("conv_id"), F.col("c").alias("n"), *[no.alias(c) for c in ("kids", "leaves", "saved")],
                    none.cast("string").alias("sha"))
        .unionAll(every.filter("lo = 0").select(none.cast("long"), no, no + 1, "leaves", "saved", none.cast("string")))
        .unionAll(digests.filter("d = 0").select(none.cast("long"), no, no, no, no, "sha"))
        .agg(F.min("conv_id").alias("conv_id"), *[F.sum(c).alias(c) for c in ("n", "kids", "leaves", "saved")],
             F.max("sha").alias("sha"))
        .filter("conv_id IS NOT NULL")
    )
    root = top.select(
        "conv_id", no.alias("depth"), none.cast("long").alias("parent_conv_id"), "n", "kids",
        F.greatest("leaves", F.lit(1)), "saved", F.coalesce("sha", empty),
    )
    return inner.unionAll(root)


def shared_prefixes(df: DataFrame, every: int = 100, most: int = 6) -> DataFrame:
    """The trie of the conversations as `rebuilt` makes them."""
    turns, convs = rebuilt(ordered_turns(df), every, most)
    return prefix_trie(turns, convs)
