"""Filling of missing values by rules.

Rules that need a mean look it up only for the rows with a gap; all other rows pass
by without a shuffle. The two parts are filtered from the same scan, so a gap-free
row group of a Parquet file is skipped for the first and nothing is kept in memory.
"""

from collections.abc import Callable, Sequence
from dataclasses import dataclass
from functools import reduce
from operator import or_

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from lakeops.functions.time import epoch_seconds
from lakeops.operators.moving import join_means, trailing_means


@dataclass(frozen=True)
class WindowMean:
    """Null -> rounded mean of the last `hours` per key; with `nan`, NaN counts as null."""

    field: str
    hours: int
    key: str
    nan: bool = False
    digits: int = 3


@dataclass(frozen=True)
class KeyMean:
    """Null -> mean of the rows with the same key. Rows without a key stay as they are."""

    field: str
    key: str


@dataclass(frozen=True)
class Literal:
    """Null -> a fixed value."""

    field: str
    value: object


@dataclass(frozen=True)
class DateOffset:
    """Null -> another date column plus a number of days."""

    field: str
    start: str
    days: int


@dataclass(frozen=True)
class FromColumn:
    """Null -> another column, where `status` has the given value."""

    field: str
    source: str
    status: str
    equals: str


Rule = WindowMean | KeyMean | Literal | DateOffset | FromColumn


def nan_to_null(df: DataFrame, fields: Sequence[str]) -> DataFrame:
    return df.withColumns({f: F.when(~F.isnan(f), F.col(f)) for f in fields})


def _with_gap(fields: Sequence[str]) -> Column:
    return reduce(or_, [F.col(f).isNull() for f in fields])


def _fill_gaps(
    df: DataFrame, gap: Column, fill: Callable[[DataFrame], DataFrame], fields: Sequence[str]
) -> DataFrame:
    """`fill` for the rows with a gap, all others as they are; columns keep their order."""
    filled = fill(df.filter(gap)).select(*df.columns)
    types = dict(filled.select(*fields).dtypes)
    others = df.filter(~gap).withColumns({f: F.col(f).cast(types[f]) for f in fields})
    return others.unionByName(filled)


# Rows of other runs with event times between two, as seconds since 1970; None if there are none.
Earlier = Callable[[int, int], DataFrame | None]


def _in_frames(
    earlier: Earlier, gaps: DataFrame, hours: int, key: str, timestamp: str
) -> DataFrame | None:
    """Rows of other runs that the frames of the gaps can hold, by the time bounds of all gaps
    and then those of each key. Null times are peers of each other alone, as in a run."""
    width, sec = hours * 3600, epoch_seconds(timestamp)
    bounds = gaps.agg(F.min(sec).alias("low"), F.max(sec).alias("high")).first()
    rows = None if bounds.low is None else earlier(bounds.low - width, bounds.high)
    if rows is None:
        return None
    known = gaps.groupBy(F.col(key).alias("__key")).agg(F.min(sec).alias("__low"), F.max(sec).alias("__high"))
    inside = F.col(key).eqNullSafe(F.col("__key")) & sec.between(F.col("__low") - width, F.col("__high"))
    return rows.join(known, inside, "left_semi")


def impute_window(
    df: DataFrame,
    fields: Sequence[str],
    hours: int,
    key: str,
    timestamp: str = "timestamp",
    nan: bool = False,
    digits: int = 3,
    sum_type: str | None = None,
    earlier: Earlier | None = None,
) -> DataFrame:
    """Fill the gaps of all `fields` that share a frame in one pass.

    A field stays null where its frame holds no value. With `sum_type`, a mean that ends
    in a five is rounded as the decimal it is, not as the double next to it. `earlier` gives
    rows of other runs: they count in the means and are not in the result.
    """
    if nan:
        df = nan_to_null(df, fields)
    gap = _with_gap(fields)
    rows, wanted = df, gap
    if earlier is not None:
        columns = [key, timestamp, *fields]
        rows, wanted = df.select(*columns, gap.alias("__gap")), F.col("__gap")
        before = _in_frames(earlier, df.filter(gap), hours, key, timestamp)
        if before is not None:
            before = nan_to_null(before, fields) if nan else before
            rows = rows.unionByName(before.select(*columns, F.lit(False).alias("__gap")))
    means = trailing_means(rows, fields, hours, key, timestamp, sum_type, only_where=wanted)

    def rounded(mean: str) -> Column:
        if sum_type is None:
            return F.round(mean, digits)
        return F.round(F.col(mean).cast("decimal(38,9)"), digits).cast("double")

    def fill(rows: DataFrame) -> DataFrame:
        return join_means(rows, means, key, timestamp).withColumns(
            {f: F.coalesce(f, rounded(f"__mean_{i}")) for i, f in enumerate(fields)}
        )

    return _fill_gaps(df, gap, fill, fields)


def key_totals(
    df: DataFrame, fields: Sequence[str], key: str, sum_type: str | None = None
) -> DataFrame:
    """One row per key with the sum and the number of the values of the fields, `__s<i>` and
    `__n<i>`: what can be added up over runs."""
    parts = []
    for i, f in enumerate(fields):
        parts.append(F.sum(F.col(f).cast(sum_type) if sum_type else F.col(f)).alias(f"__s{i}"))
        parts.append(F.count(f).alias(f"__n{i}"))
    return df.groupBy(F.col(key).alias("__key")).agg(*parts)


def means_of(totals: DataFrame, n: int) -> DataFrame:
    """The means of totals, as `__mean_<i>`; totals of several runs are added up."""
    added = totals.groupBy("__key").agg(*[F.sum(f"__{c}{i}").alias(f"__{c}{i}") for i in range(n) for c in "sn"])
    return added.select("__key", *[_mean(i) for i in range(n)])


def _mean(i: int) -> Column:
    count = F.col(f"__n{i}")
    return (F.col(f"__s{i}").cast("double") / F.when(count > 0, count)).alias(f"__mean_{i}")


def key_means(
    df: DataFrame, fields: Sequence[str], key: str, sum_type: str | None = None
) -> DataFrame:
    """One row per key with the means of the fields as `__mean_<i>`."""
    totals = key_totals(df, fields, key, sum_type)
    return totals.select("__key", *[_mean(i) for i in range(len(fields))])


# Given the totals of a run, its key and fields, those of all runs up to it.
Totals = Callable[[DataFrame, str, Sequence[str]], DataFrame]


def impute_key_mean(
    df: DataFrame,
    fields: Sequence[str],
    key: str,
    sum_type: str | None = None,
    totals: Totals | None = None,
) -> DataFrame:
    """Fill gaps with the mean of the rows with the same key: those of `df`, or with `totals`
    those of all runs that it adds up."""
    means = key_means(df, fields, key, sum_type)
    if totals is not None:
        means = means_of(totals(key_totals(df, fields, key, sum_type), key, fields), len(fields))
    gap = _with_gap(fields) & F.col(key).isNotNull()

    def fill(rows: DataFrame) -> DataFrame:
        # Null-safe only so that no null check of the key, which may be costly to
        # compute, is pushed below the aggregate: no row with a null key gets here.
        joined = rows.join(means, F.col(key).eqNullSafe(F.col("__key")), "left")
        return joined.withColumns(
            {f: F.coalesce(f, f"__mean_{i}") for i, f in enumerate(fields)}
        )

    return _fill_gaps(df, gap, fill, fields)


def impute_literal(df: DataFrame, field: str, value: object) -> DataFrame:
    return df.fillna({field: value})


def impute_date_offset(df: DataFrame, field: str, start: str, days: int) -> DataFrame:
    return df.withColumn(field, F.coalesce(field, F.date_add(start, days)))


def impute_from_column(
    df: DataFrame, field: str, source: str, status: str, equals: str
) -> DataFrame:
    missing = F.col(field).isNull() & (F.col(status) == equals)
    return df.withColumn(field, F.when(missing, F.col(source)).otherwise(F.col(field)))


def _reads(rule: Rule, timestamp: str) -> set[str]:
    match rule:
        case WindowMean():
            return {rule.key, timestamp}
        case KeyMean():
            return {rule.key}
        case DateOffset():
            return {rule.start}
        case FromColumn():
            return {rule.source, rule.status}
        case _:
            return set()


def _batches(rules: Sequence[Rule], timestamp: str) -> list[list[Rule]]:
    """Rules in order, with mean rules of the same frame or key put together.

    Only where the order cannot matter: no field is filled twice or read by a rule.
    """
    for rule in rules:
        if not isinstance(rule, Rule):
            raise ValueError(f"unknown imputation rule: {rule!r}")
    fields = [r.field for r in rules]
    read = set().union(*[_reads(r, timestamp) for r in rules])
    if len(set(fields)) < len(fields) or read & set(fields):
        return [[r] for r in rules]
    batches: dict[object, list[Rule]] = {}
    for i, r in enumerate(rules):
        match r:
            case WindowMean():
                spec = (r.hours, r.key, r.nan, r.digits)
            case KeyMean():
                spec = r.key
            case _:
                spec = i
        batches.setdefault((type(r), spec), []).append(r)
    return list(batches.values())


def impute(
    df: DataFrame,
    rules: Sequence[Rule],
    timestamp: str = "timestamp",
    sum_type: str | None = None,
    earlier: Earlier | None = None,
    totals: Totals | None = None,
) -> DataFrame:
    """Apply the rules in their order; an unknown rule raises while the plan is built.

    `earlier` and `totals` bring in what other runs know, for the window and the key means.
    """
    for batch in _batches(rules, timestamp):
        r, fields = batch[0], [b.field for b in batch]
        match r:
            case WindowMean():
                df = impute_window(
                    df, fields, r.hours, r.key, timestamp, r.nan, r.digits, sum_type, earlier
                )
            case KeyMean():
                df = impute_key_mean(df, fields, r.key, sum_type, totals)
            case Literal():
                df = impute_literal(df, r.field, r.value)
            case DateOffset():
                df = impute_date_offset(df, r.field, r.start, r.days)
            case FromColumn():
                df = impute_from_column(df, r.field, r.source, r.status, r.equals)
    return df
