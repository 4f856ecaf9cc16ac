"""Benchmark passages in documents, found by winnowing.

A window is `WINDOW` consecutive words of a benchmark item, or the whole of a shorter item.
Of the hashes of the `GRAM`-word grams inside a window the smallest is kept. Equal windows
keep equal hashes, so every shared window shares a fingerprint: documents and items meet on
fingerprints alone, a few for every ten words, and only around shared ones are whole windows
compared, word by word. The windows that agree cover the hit words.

Defined cases: null or wordless texts have no words and no hits; wordless items have no
windows; an item or a document that repeats gives the same result each time (an item counts
once by id); the windows of items without an id hit words like others, and these items count as
one, which the digest of ids leaves out; an empty table on either side gives no hits; other columns are not touched.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from lakeops.llm.common import (
    NON_WORD,
    ascii_lower,
    let,
    packed,
    split_words,
    stored,
    window_hashes,
)

WINDOW = 10
GRAM = 5
ANY_CASE_NON_WORD = r"[\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+"


def _words(text: Column) -> Column:
    return split_words(ascii_lower(text), NON_WORD)


def _sliding_min(hashes: Column, width: int) -> Column:
    """The smallest of every `width` consecutive hashes."""

    def grow(found: Column, have: int) -> Column:
        if have == width:
            return found
        by = min(have, width - have)

        def step(x: Column) -> Column:
            later = F.slice(x, by + 1, F.size(x))
            first = F.slice(x, 1, F.greatest(F.size(x) - by, F.lit(0)))
            return F.zip_with(first, later, lambda a, b: F.when(a < b, a).otherwise(b))

        return let(found, lambda x: grow(step(x), have + by))

    return grow(hashes, 1)


def _shape(length: int) -> tuple[int, int]:
    """Words of a gram, and grams of a window of `length` words."""
    gram = min(GRAM, length)
    return gram, length - gram + 1


def _exploded(df: DataFrame, items: Column, name: str, *keep: str) -> DataFrame:
    """A row for each item. The plain form would compute `items` again in a filter of its own."""
    return df.select(*keep, F.explode_outer(items).alias(name)).filter(F.col(name).isNotNull())


def _fingerprints(df: DataFrame, words: str, length: int, *keep: str) -> DataFrame:
    """A row for every distinct fingerprint of `length`-word windows in `words`."""
    gram, width = _shape(length)
    marks = F.array_distinct(_sliding_min(window_hashes(F.col(words), gram), width))
    return _exploded(df, marks, "mark", *keep)


def _windows(df: DataFrame, words: str, length: int, *keep: str) -> DataFrame:
    """A row for every window of `length` words: its start and its words."""
    starts = F.sequence(F.lit(0), F.size(words) - length)
    starts = F.when(F.size(words) >= length, starts)
    every = _exploded(df, starts, "start", *keep, words)
    window = F.array_join(F.slice(F.col(words), F.col("start") + 1, length), " ")
    return every.select(*keep, "start", window.alias("window"))


def _covered(spans: Column) -> Column:
    """Words inside any of the spans (start, end), which are sorted."""
    first = F.struct(F.lit(0).alias("end"), F.lit(0).alias("words"))

    def add(state: Column, span: Column) -> Column:
        new = F.greatest(span["end"] - F.greatest(span["start"], state["end"]), F.lit(0))
        return F.struct(
            F.greatest(state["end"], span["end"]).alias("end"), (state["words"] + new).alias("words")
        )

    return F.aggregate(spans, first, add)["words"]


def _keyed(df: DataFrame, doc_id: str, text: str) -> DataFrame:
    """`_id`, `_hash` and `_text`: rows alike in id and text are one document."""
    body = F.coalesce(F.col(f"`{text}`"), F.lit(""))
    return df.select(
        F.col(f"`{doc_id}`").alias("_id"), F.xxhash64(body).alias("_hash"), body.alias("_text")
    )


def _same(left: str, right: str) -> Column:
    ids = F.col(f"{left}._id").eqNullSafe(F.col(f"{right}._id"))
    return ids & (F.col(f"{left}._hash") == F.col(f"{right}._hash"))


def _shared(docs: DataFrame, windows: DataFrame, marks: DataFrame, length: int) -> DataFrame:
    """Spans of `docs` that equal one of the windows, with the ids of its items."""
    gram, width = _shape(length)
    split = docs.select("_id", "_hash", _words(F.col("_text")).alias("words"))
    near = _fingerprints(split, "words", length, "_id", "_hash").join(marks, "mark")
    near = stored(near.groupBy("_id", "_hash").agg(F.collect_set("mark").alias("marks")), "near")

    some = docs.alias("d").join(near.alias("n"), _same("d", "n"))
    some = some.select("d._id", "d._hash", _words(F.col("d._text")).alias("words"))
    some = stored(some, "near_words")
    # Places meet the marks in a join, so a long text costs its length; only numbers are moved.
    places = F.transform(_sliding_min(window_hashes(F.col("words"), gram), width), lambda m, i: F.struct(m.alias("mark"), i.alias("start")))
    places = _exploded(some, places, "place", "_id", "_hash").select("_id", "_hash", "place.*")
    starts = places.join(marks, "mark").groupBy("_id", "_hash").agg(F.collect_set("start").alias("starts"))
    starts = some.alias("d").join(stored(starts, "starts").alias("n"), _same("d", "n"))

    def window(start: Column) -> Column:
        words = F.array_join(F.slice("words", start + 1, length), " ")
        return F.struct(start.alias("start"), words.alias("window"))

    starts = _exploded(starts, F.transform("n.starts", window), "w", "d._id", "d._hash")
    starts = starts.select("_id", "_hash", "w.*")
    return starts.join(windows, "window").select(
        "_id", "_hash", "start", (F.col("start") + length).alias("end"), "ids"
    )


def _hits(docs: DataFrame, items: DataFrame) -> DataFrame | None:
    """Per document of `docs` that shares a window: `n_hit` and its sorted `items`; else None.

    `items` has `item_id` and `words`. Windows of one length make a table of their own; there
    are `WINDOW` lengths at most. The tables of windows and marks are written, so that the
    planner sends them to all tasks only if their size is known to be small.
    """
    items = stored(items, "items")
    size = F.least(F.size("words"), F.lit(WINDOW))
    lengths = [r[0] for r in items.select(size).distinct().collect() if r[0] > 0]
    found = None
    for length in sorted(lengths):
        own = items.filter(size == length)
        marks = stored(_fingerprints(own, "words", length).distinct(), "marks")
        windows = _windows(own, "words", length, "item_id").groupBy("window")
        windows = stored(windows.agg(F.collect_set(F.struct("item_id")).alias("ids")), "windows")
        hit = _shared(docs, windows, marks, length)
        found = hit if found is None else found.unionByName(hit)
    if found is None:
        return None
    spans = F.sort_array(F.collect_set(F.struct("start", "end")))
    ids = F.array_distinct(F.flatten(F.collect_set("ids")))
    found = found.groupBy("_id", "_hash").agg(spans.alias("spans"), ids.alias("ids"))
    names = F.filter(F.transform("ids", lambda x: x["item_id"].cast("string")), F.isnotnull)
    n_hit = _covered(F.col("spans")).alias("n_hit")
    return found.select("_id", "_hash", n_hit, F.size("ids").alias("n_items"), F.array_sort(names).alias("items"))


def _items(df: DataFrame) -> DataFrame:
    return df.select("item_id", _words(F.col("text")).alias("words"))


def contamination(df: DataFrame, benchmark: DataFrame) -> DataFrame:
    """One row per document: its words, those hit, and the items that share windows with it."""
    docs = _keyed(df, "doc_id", "text")
    # Letters of either case belong to words, so counting needs no lower-casing.
    n_words = F.size(split_words(F.col("_text"), ANY_CASE_NON_WORD)).cast("long")
    out = docs.select("_id", "_hash", n_words.alias("n_words"))
    hits = _hits(docs, _items(benchmark))
    if hits is None:
        none = F.array().cast("array<string>")
        out = out.withColumns({"n_hit": F.lit(0), "n_items": F.lit(0), "items": none})
    else:
        hits = stored(hits, "hits")
        out = out.alias("d").join(hits.alias("h"), _same("d", "h"), "left")
        out = out.select("d.*", "h.n_hit", "h.n_items", "h.items")
    n_hit = F.coalesce("n_hit", F.lit(0)).cast("long")
    items = F.coalesce("items", F.array().cast("array<string>"))
    return out.select(
        F.col("_id").alias("doc_id"),
        "n_words",
        n_hit.alias("n_hit"),
        F.coalesce("n_items", F.lit(0)).cast("long").alias("n_items"),
        F.sha2(F.array_join(items, ",").cast("binary"), 256).alias("items_sha256"),
        (n_hit > 0).alias("contaminated"),
    )


def drop_contaminated(df: DataFrame, benchmark: DataFrame) -> DataFrame:
    """The rows of documents that share no window with the benchmark, with all their columns."""
    hits = _hits(_keyed(df, "doc_id", "text"), _items(benchmark))
    if hits is None:
        return df
    hits = stored(hits.select("_id", "_hash"), "hits")
    rows = packed(df)
    rows = rows.select(
        "row",
        F.col("row.doc_id").alias("_id"),
        F.xxhash64(F.coalesce(F.col("row.text"), F.lit(""))).alias("_hash"),
    )
    return rows.alias("d").join(hits.alias("h"), _same("d", "h"), "left_anti").select("row.*")
