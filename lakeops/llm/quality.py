"""Quality rules per document and a verdict per host.

Every document is held against fixed rules. A host's share of failing documents is shrunk
towards a beta prior fitted to all hosts (method of moments), so a host with two bad pages
is not condemned like one with two thousand; hosts whose shrunk share is over a limit lose
all their documents.

Defined cases: a null text has no words and fails; a null host is a host of its own;
repeated rows count as often as they occur; an empty table gives an empty result; other
columns are kept by `keep_good` whatever their names.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from lakeops.llm.common import SPACE, let, packed, split_words, stored, window_hashes

SYMBOLS = "#*$%&|<>"
NGRAM = 5
# Characters of symbols per word, and mean characters of a word, beyond which a text fails.
MAX_SYMBOLS_PER_WORD = 0.3
MEAN_WORD = (2.0, 20.0)
# A host is rejected if its shrunk share of failing documents is over this.
MAX_HOST_FAILURES = 0.5

COUNTS = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words")


def _duplicate_lines(text: Column) -> Column:
    lines = F.filter(F.split(text, "\n"), lambda x: x.rlike(r"[^\x20\x09-\x0D]"))
    return let(lines, lambda x: F.size(x) - F.size(F.array_distinct(x)))


def _covered(windows: Column) -> Column:
    """How many words lie in windows that occur at least twice."""
    places = F.sort_array(F.transform(windows, lambda h, i: F.struct(h.alias("h"), i.alias("i"))))

    def same(a: Column, i: Column, j: Column) -> Column:
        return F.coalesce(F.get(a, i)["h"] == F.get(a, j)["h"], F.lit(False))

    def repeated(a: Column) -> Column:
        every = F.sequence(F.lit(0), F.size(a) - 1)
        hits = F.filter(every, lambda j: same(a, j, j - 1) | same(a, j, j + 1))
        return F.sort_array(F.transform(hits, lambda j: F.get(a, j)["i"]))

    def length(p: Column) -> Column:
        steps = F.transform(p, lambda x, j: F.least(F.get(p, j + 1) - x, F.lit(NGRAM)))
        return F.aggregate(steps, F.lit(0), lambda s, x: s + F.coalesce(x, F.lit(NGRAM)))

    found = let(let(places, repeated), length)
    return F.when(F.size(F.array_distinct(windows)) < F.size(windows), found).otherwise(0)


def measured(df: DataFrame, text: Column, *keep: Column) -> DataFrame:
    """`keep` and the counts of `COUNTS`, with `base_failed` and `rule_failed`."""
    kept = [c.alias(f"_k{i}") for i, c in enumerate(keep)]
    keys = [f"_k{i}" for i in range(len(keep))]
    body = F.coalesce(text, F.lit(""))
    step = df.select(*kept, body.alias("_t"), split_words(text, SPACE).alias("_w"))
    step = step.select(*keys, "_t", "_w", window_hashes(F.col("_w"), NGRAM).alias("_g"))
    t = F.col("_t")
    counts = {
        "n_words": F.size("_w"),
        "word_chars": F.length(F.array_join("_w", "")),
        "n_symbols": F.length(F.regexp_replace(t, f"[^{SYMBOLS}]+", "")),
        "n_dup_lines": _duplicate_lines(t),
        "n_repeat_words": _covered(F.col("_g")),
    }
    step = step.select(*keys, *[v.cast("long").alias(k) for k, v in counts.items()])
    n, chars = F.col("n_words"), F.col("word_chars")
    base = (n < 10) | (100 * F.col("n_repeat_words") > 20 * n)
    rules = (
        base
        | (F.col("n_symbols") > MAX_SYMBOLS_PER_WORD * n)
        | (chars < MEAN_WORD[0] * n)
        | (chars > MEAN_WORD[1] * n)
    )
    return step.withColumns({"base_failed": base, "rule_failed": rules})


def host_verdicts(features: DataFrame, host: str) -> DataFrame:
    """One row per host: documents, failing ones, the shrunk share and `rejected`.

    The prior has the mean `m` and the variance `v` of the hosts' shares: a = m * c and
    b = (1 - m) * c with c = m * (1 - m) / v - 1, at least 1. With no spread between hosts
    every share becomes the mean.
    """
    hosts = features.groupBy(F.col(host).alias("host")).agg(
        F.count("*").alias("n"), F.sum(F.col("rule_failed").cast("long")).alias("failed")
    )
    hosts = stored(hosts, "host_counts")
    share = F.col("failed") / F.col("n")
    # Two numbers.
    m, v = hosts.agg(F.avg(share), F.var_pop(share)).first()
    if v:
        c = max(1.0, m * (1 - m) / v - 1)
        share = (F.col("failed") + m * c) / (F.col("n") + c)
    else:
        share = F.lit(m).cast("double")
    return hosts.select("host", "n", "failed", share.alias("share")).withColumn(
        "rejected", F.coalesce(F.col("share") > MAX_HOST_FAILURES, F.lit(False))
    )


def _with_verdict(df: DataFrame, host: Column, verdicts: DataFrame) -> DataFrame:
    """The host's `rejected` beside each row.

    Verdicts are a written table, so the planner knows their size: small ones are sent to
    all tasks, others meet the rows in a join whose hot keys the adaptive plan splits.
    """
    bad = verdicts.filter("rejected").select(F.col("host").alias("_host"), F.lit(True).alias("_bad"))
    joined = df.join(bad, host.eqNullSafe(F.col("_host")), "left")
    return joined.withColumn("host_rejected", F.coalesce("_bad", F.lit(False))).drop("_host", "_bad")


def judge(df: DataFrame, doc_id: str = "doc_id", text: str = "text", host: str = "source"):
    """One row per document: its counts, `base_failed`, `host_rejected` and `kept`."""
    found = stored(measured(df, F.col(text), F.col(doc_id), F.col(host)), "quality")
    verdicts = stored(host_verdicts(found, "_k1"), "hosts")
    out = _with_verdict(found, F.col("_k1"), verdicts)
    kept = ~F.col("base_failed") & ~F.col("host_rejected")
    return out.select(
        F.col("_k0").alias("doc_id"), *COUNTS, "base_failed", "host_rejected", kept.alias("kept")
    )


def keep_good(df: DataFrame, text: str = "text", host: str = "source") -> DataFrame:
    """The rows that `judge` keeps, with all their columns.

    The texts are measured twice rather than written out beside their counts: once for the
    hosts, once for the filter.
    """
    hosts = measured(df, F.col(text), F.col(host))
    verdicts = stored(host_verdicts(hosts, "_k0"), "hosts")
    rows = packed(df)
    good = measured(rows, F.col(f"row.{text}"), F.col("row"))
    # A filter on the column itself would be moved down and measure the texts several times.
    good = good.select("_k0", F.explode_outer(F.array("base_failed")).alias("_bad")).filter("NOT _bad")
    good = _with_verdict(good.select("_k0"), F.col(f"_k0.{host}"), verdicts)
    return good.filter(~F.col("host_rejected")).select("_k0.*")
