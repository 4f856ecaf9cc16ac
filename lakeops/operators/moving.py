"""Trailing means over a time range, per key.

The frame of a row at second `t` is `[t - w, t]`, both ends and the row itself
included. A plain range window would put all rows of a key into one task and read
the whole frame again for every row. Here the rows are first summed per key and
second, then cut into time blocks one frame long. A frame touches at most two
blocks, so its sum is a suffix of the previous block plus a prefix of its own:
running sums only, nothing subtracted, and a window group never holds more than
two blocks of seconds however many rows a key or a second has.
"""

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from lakeops.functions.time import epoch_seconds


def _value(field: str, sum_type: str | None) -> Column:
    return F.col(field).cast(sum_type) if sum_type else F.col(field)


def trailing_means(
    df: DataFrame,
    fields: Sequence[str],
    hours: int,
    key: str,
    timestamp: str = "timestamp",
    sum_type: str | None = None,
    only_where: Column | None = None,
) -> DataFrame:
    """One row per key and second: `__key`, `__sec` and the mean of every field as `__mean_<i>`.

    `sum_type` names a decimal type to sum in, for results that do not depend on the
    order of rows. With `only_where`, keep only the seconds where it holds for some row.
    """
    width = hours * 3600
    sums = {f"__s{i}": F.sum(_value(f, sum_type)) for i, f in enumerate(fields)}
    counts = {f"__n{i}": F.count(f) for i, f in enumerate(fields)}
    wanted = F.lit(True) if only_where is None else only_where
    seconds = df.groupBy(F.col(key).alias("__key"), epoch_seconds(timestamp).alias("__sec")).agg(
        *[c.alias(n) for n, c in (sums | counts).items()],
        F.max(wanted).alias("__wanted"),
    )

    # Every second stands once in its own block and once, as context, in the next. There
    # its position is the last second whose frame still holds it. Null times have no
    # next block: as in a range window they are peers of each other and of nothing else.
    copies = F.when(F.col("__sec").isNull(), F.array(F.lit(0))).otherwise(
        F.array(F.lit(0), F.lit(1))
    )
    placed = seconds.withColumn("__ctx", F.explode(copies)).withColumns(
        {
            "__block": F.floor(F.col("__sec") / (width + 1)) + F.col("__ctx"),
            "__pos": F.col("__sec") + F.col("__ctx") * width,
        }
    )

    block = Window.partitionBy("__key", "__block")
    start = (Window.unboundedPreceding, Window.currentRow)
    prefix = block.orderBy(F.col("__pos").asc()).rangeBetween(*start)
    suffix = block.orderBy(F.col("__pos").desc()).rangeBetween(*start)
    own, context = F.col("__ctx") == 0, F.col("__ctx") == 1
    parts = {}
    for name in (*sums, *counts):
        parts[f"{name}p"] = F.sum(F.when(own, F.col(name))).over(prefix)
        parts[f"{name}c"] = F.sum(F.when(context, F.col(name))).over(suffix)
    summed = placed.withColumns(parts).filter(own & F.col("__wanted"))

    def total(name: str) -> Column:
        before, now = F.col(f"{name}c"), F.col(f"{name}p")
        return F.when(before.isNull(), now).when(now.isNull(), before).otherwise(before + now)

    return summed.select(
        "__key",
        "__sec",
        *[
            (
                total(f"__s{i}").cast("double")
                / F.when(total(f"__n{i}") > 0, total(f"__n{i}"))
            ).alias(f"__mean_{i}")
            for i in range(len(fields))
        ],
    )


def moving_average(
    df: DataFrame,
    field: str,
    hours: int,
    key: str,
    timestamp: str = "timestamp",
    sum_type: str | None = None,
) -> DataFrame:
    """Add `mean_last_<hours>h`, the mean of `field` over the trailing frame of every row."""
    means = trailing_means(df, [field], hours, key, timestamp, sum_type)
    return join_means(df, means, key, timestamp).withColumnRenamed(
        "__mean_0", f"mean_last_{hours}h"
    )


def join_means(df: DataFrame, means: DataFrame, key: str, timestamp: str) -> DataFrame:
    """Bring the means back to the rows; null keys and null times match themselves.

    `means` has one row per key and second, so rows are never multiplied and the
    adaptive skew join may split the rows of one hot second over tasks.
    """
    rows = df.withColumns({"__row_key": F.col(key), "__row_sec": epoch_seconds(timestamp)})
    same = F.col("__row_key").eqNullSafe(F.col("__key")) & F.col("__row_sec").eqNullSafe(
        F.col("__sec")
    )
    return rows.join(means, same, "left").drop("__row_key", "__row_sec", "__key", "__sec")
