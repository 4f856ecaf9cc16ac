"""What filters do in every order in which they can be applied.

A row is known by the set of filters that it fails, its mask; texts are read once, and all else
works on counts per part and mask. Orders are numbered lexicographically (their Lehmer rank), so
those that begin with given letters are one interval of ranks. A mask is removed at step s by the
letter that is the first of its own: the orders where that happens are some of these intervals.
Every mask adds its counts where an interval begins and takes them away where it ends; running
sums over the ranks then give the totals of all orders.

Whether a text stands under a smaller id is settled without a join: rows are counted per digest,
part, labels and id, then per digest, part and labels, each with map-side combine, so a text that
very many rows share is a few counts.

Defined cases: a null text is empty; a null part is the empty one; a null id is never a copy and
makes none; rows that repeat are counted each, and are no copies of each other; a label counts for
an id if any row of `labels` gives it, and null ids have none; an empty table gives no rows.
"""

from __future__ import annotations

from itertools import permutations
from math import factorial

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from lakeops.llm.common import SPACE, split_words, stored

# A text fails with fewer words than this, with a smaller share of distinct words or with a
# larger share of capitals (both in percent), or with any of these characters.
MIN_WORDS, MIN_DISTINCT, MAX_CAPITALS, ODD = 50, 65, 5, "[#$%&*|]"

# What an interval says of the orders in it, and the counts of a mask that it carries.
KINDS = {
    "kept": ("kept",),
    "removed": ("removed", "good_lost", "toxic_lost"),
    "redundant": ("redundant",),
    "unique": ("unique_fails",),
}
COUNTS = {"good_lost": "good", "toxic_lost": "toxic"}
TOTALS = ("kept", "removed", "redundant", "unique_fails", "good_lost", "toxic_lost")


def text_mask(text: Column) -> Column:
    """The filters A to D that a text fails, as bits."""
    words = split_words(text, SPACE)
    n, distinct = F.size(words), F.size(F.array_distinct(words))
    capitals = F.length(F.regexp_replace(text, "[^A-Z]+", ""))
    fails = (
        n < MIN_WORDS,
        100 * distinct < MIN_DISTINCT * n,
        100 * capitals > MAX_CAPITALS * F.length(text),
        text.rlike(ODD),
    )
    return sum((F.when(f, 1 << i).otherwise(0) for i, f in enumerate(fails)), F.lit(0))


def intervals(letters: str) -> list[tuple[int, str, int, int, int]]:
    """(mask, kind, step, begin, end) of the ranks, by rule; neighbours are one interval.

    There are `2 ** n` masks and at most `sum(n! / (n - s)!)` intervals for each.
    """
    n = len(letters)
    found: dict[tuple[int, str, int], list[list[int]]] = {}
    for step in range(1, n + 1):
        width = factorial(n - step)
        for place, prefix in enumerate(permutations(range(n), step)):
            begin = place * width
            before = sum(1 << i for i in prefix[:-1])
            own = 1 << prefix[-1]
            for mask in range(1 << n):
                kinds = []
                if not mask & (before | own):
                    kinds.append("kept")
                if mask & own:
                    kinds.append("redundant" if mask & before else "removed")
                if mask == own:
                    kinds.append("unique")
                for kind in kinds:
                    runs = found.setdefault((mask, kind, step), [])
                    if runs and runs[-1][1] == begin:
                        runs[-1][1] = begin + width
                    else:
                        runs.append([begin, begin + width])
    return [(m, k, s, a, b) for (m, k, s), runs in found.items() for a, b in runs]


def _orders(spark: SparkSession, letters: str) -> DataFrame:
    """All orders, their rank and each step's letter: `n * n!` rows, whatever the data."""
    rows = [
        (rank, "".join(order), step, letter)
        for rank, order in enumerate(permutations(letters))
        for step, letter in enumerate(order, 1)
    ]
    return spark.createDataFrame(rows, "rank int, filter_order string, step int, letter string")


def order_totals(masks: DataFrame, letters: str) -> DataFrame:
    """Totals of every order and step, from `part`, `mask`, `n`, `good`, `toxic`.

    Bit i of a mask stands for letter i, and the letters are in alphabetical order. For each
    part there are `n * n!` rows, and no window holds more than `n!`.
    """
    spark = masks.sparkSession
    ends = spark.createDataFrame(
        [
            (mask, kind, step, rank, sign)
            for mask, kind, step, begin, end in intervals(letters)
            for rank, sign in ((begin, 1), (end, -1))
        ],
        "mask int, kind string, step int, rank int, sign int",
    )
    steps = [
        F.sum(F.when(F.col("kind") == kind, F.col("sign") * F.col(COUNTS.get(total, "n"))))
        .alias(total)
        for kind, totals in KINDS.items()
        for total in totals
    ]
    # Both sides are small: counts per part and mask, and a table whose size the letters give.
    changes = masks.join(F.broadcast(ends), "mask").groupBy("part", "step", "rank").agg(*steps)
    ranks = F.explode(F.sequence(F.lit(0), F.lit(factorial(len(letters)) - 1)))
    every = masks.select("part").distinct().select("part", ranks.alias("rank"))
    every = every.join(F.broadcast(_orders(spark, letters)), "rank")
    placed = every.join(changes, ["part", "step", "rank"], "left")
    upto = Window.partitionBy("part", "step").orderBy("rank").rowsBetween(Window.unboundedPreceding, 0)
    totals = {t: F.coalesce(F.sum(t).over(upto), F.lit(0)).cast("long") for t in TOTALS}
    totals = placed.withColumns(totals)
    shapley = F.sum("removed").over(Window.partitionBy("part", "letter"))
    return totals.select("part", "filter_order", "step", *TOTALS, shapley.alias("shapley"))


def _labelled(labels: DataFrame) -> DataFrame:
    flags = [
        F.max(F.coalesce(F.col(c) == 1, F.lit(False))).alias(f"_{c}") for c in ("quality", "toxic")
    ]
    known = labels.select(F.col("doc_id").alias("_doc"), "quality", "toxic").filter("_doc IS NOT NULL")
    return stored(known.groupBy("_doc").agg(*flags), "labels")


def masks(
    df: DataFrame,
    labels: DataFrame,
    failures: Column,
    copies: int,
    doc_id: str = "doc_id",
    text: str = "text",
    part: str = "source",
) -> DataFrame:
    """Counts per part and mask: `n`, and how many are `good` and `toxic` by `labels`.

    `failures` are bits over the column `_text`, `copies` is the bit of rows whose text a smaller
    id has. Filters of the text are part of what is counted by digest, as equal texts fail alike.
    """
    body = F.coalesce(F.col(f"`{text}`"), F.lit(""))
    rows = df.select(
        F.col(f"`{doc_id}`").alias("_doc"),
        F.coalesce(F.col(f"`{part}`").cast("string"), F.lit("")).alias("_part"),
        body.alias("_text"),
    )
    rows = rows.select(
        "_doc",
        "_part",
        F.unhex(F.sha2("_text", 256)).alias("_digest"),
        failures.cast("int").alias("_mask"),
    )
    by = ["_digest", "_part", "_mask"]
    rows = rows.groupBy(*by, "_doc").agg(F.count("*").alias("_n"))
    known = rows.join(_labelled(labels), "_doc", "left").withColumns(
        {c: F.coalesce(c, F.lit(False)) for c in ("_quality", "_toxic")}
    )
    # Ids that repeat in a group are one row by now, so the smallest id has one count.
    first = F.min(F.when(F.col("_doc").isNotNull(), F.struct("_doc", "_n")))
    groups = known.groupBy(*by, "_quality", "_toxic").agg(
        F.sum("_n").alias("_n"),
        F.sum(F.when(F.col("_doc").isNull(), F.col("_n")).otherwise(0)).alias("_nameless"),
        first.alias("_first"),
    )
    groups = stored(groups, "digests")
    least = groups.groupBy("_digest").agg(F.min("_first._doc").alias("_least"), F.count("*").alias("_g"))
    # A text in one group alone knows its smallest id; the others meet a written table.
    least = stored(least.filter("_g > 1").select("_digest", "_least"), "least_ids")
    met = groups.join(least, "_digest", "left")
    is_first = F.coalesce(F.col("_first._doc") == F.coalesce("_least", "_first._doc"), F.lit(False))
    singles = F.col("_nameless") + F.when(is_first, F.col("_first._n")).otherwise(0)
    split = F.array(
        F.struct(F.col("_mask").alias("mask"), singles.alias("n")),
        F.struct(
            F.col("_mask").bitwiseOR(F.lit(copies)).alias("mask"), (F.col("_n") - singles).alias("n")
        ),
    )
    split = met.select("_part", "_quality", "_toxic", F.inline(split)).filter("n > 0")
    return split.groupBy(F.col("_part").alias("part"), "mask").agg(
        F.sum("n").alias("n"),
        F.sum(F.when(F.col("_quality"), F.col("n")).otherwise(0)).alias("good"),
        F.sum(F.when(F.col("_toxic"), F.col("n")).otherwise(0)).alias("toxic"),
    )


def audit(df: DataFrame, labels: DataFrame) -> DataFrame:
    """One row per part, order of the five filters and step, zeros included."""
    counted = masks(df, labels, text_mask(F.col("_text")), copies=16)
    return order_totals(stored(counted, "masks"), "ABCDE")
