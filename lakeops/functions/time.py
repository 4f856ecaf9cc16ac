"""Event times and the date columns derived from them."""

import datetime as dt

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def default_timestamp(df: DataFrame, column: str, run_ts: dt.datetime) -> DataFrame:
    """Null event times become the time of the run, one literal for the whole run."""
    return df.withColumn(column, F.coalesce(column, F.lit(run_ts)))


def partition_columns(df: DataFrame, column: str = "timestamp") -> DataFrame:
    return df.withColumns(
        {"year": F.year(column), "month": F.month(column), "day": F.dayofmonth(column)}
    )


def epoch_millis(raw: Column) -> Column:
    """Milliseconds since 1970, as number or text, to a timestamp of whole seconds."""
    return F.timestamp_seconds((raw.try_cast("double") / 1000).try_cast("bigint"))


def epoch_seconds(column: str) -> Column:
    """Whole seconds since 1970; a timestamp without zone is read in the session zone."""
    return F.col(column).cast("timestamp").cast("long")
