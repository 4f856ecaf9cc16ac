"""Scans of catalog tables: whole, by ingestion time, by date."""

import datetime as dt

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

INGESTED = "_ingestion_time"


def read_table(spark: SparkSession, table: str) -> DataFrame:
    """The table as it is now, with the files that others have added."""
    spark.catalog.refreshTable(table)
    return spark.table(table)


def ingested_between(low: dt.datetime | Column | None, high: dt.datetime | Column) -> Column:
    """Rows after `low` up to and including `high`; without `low`, all up to `high`.

    The upper bound is fixed before the rows are read, so rows that arrive meanwhile
    are left to the next run instead of being marked as done.
    """
    time = F.col(INGESTED)
    upper = time <= F.lit(high)
    return time.isNull() | upper if low is None else (time > F.lit(low)) & upper


def high_mark(df: DataFrame, low: dt.datetime | Column | None = None) -> DataFrame:
    """One row with the latest ingestion time after `low`, null when there is nothing new."""
    newer = df if low is None else df.filter(F.col(INGESTED) > F.lit(low))
    return newer.agg(F.max(INGESTED).alias("high_mark"))


def date_range(df: DataFrame, first: dt.date, last: dt.date) -> DataFrame:
    """Rows of the days `first` to `last`, by the partition columns alone.

    A filter on the timestamp does not prune `year/month/day` partitions; this one does.
    """
    year = F.col("year")
    day = F.make_date("year", "month", "day")
    return df.filter(
        year.between(first.year, last.year) & day.between(F.lit(first), F.lit(last))
    )
