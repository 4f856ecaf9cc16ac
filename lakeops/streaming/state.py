"""How far a table has been handed over to the next one, by ingestion time.

The state of a pipeline is a table of its own with one row: the bounds of its last run, and
whether that run is done. It is replaced as a whole, so it does not grow, and pipelines do not
meet in one folder. A pipeline has one writer at a time. Marks are microseconds since 1970, so
they do not depend on any zone.
"""

import datetime as dt
from collections.abc import Callable
from dataclasses import dataclass
from uuid import uuid4

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from lakeops.operators.sinks import BATCH, INGESTED_AT, overwrite_table
from lakeops.sources.tables import high_mark, ingested_between, read_table

UTC = dt.timezone.utc


def _mark(micros: int | None) -> Column:
    return F.timestamp_micros(F.lit(micros).cast("bigint"))


@dataclass(frozen=True)
class Run:
    """Rows after `low` up to `high`, handed over at `at`."""

    run_id: str
    low: int | None
    high: int
    at: int

    @property
    def time(self) -> dt.datetime:
        return dt.datetime.fromtimestamp(0, UTC) + dt.timedelta(microseconds=self.at)


@dataclass(frozen=True)
class StateTable:
    """The state of one pipeline."""

    spark: SparkSession
    table: str
    location: str

    def _row(self):
        if not self.spark.catalog.tableExists(self.table):
            return None
        micros = [F.unix_micros(c).alias(c) for c in ("low_mark", "high_mark", "run_ts")]
        return read_table(self.spark, self.table).select("run_id", "status", *micros).first()

    def last_mark(self) -> int | None:
        """The mark up to which all rows are handed over."""
        row = self._row()
        if row is None:
            return None
        return row.high_mark if row.status == "done" else row.low_mark

    def unfinished(self) -> Run | None:
        """A run that was started and not recorded as done."""
        row = self._row()
        if row is None or row.status == "done":
            return None
        return Run(row.run_id, row.low_mark, row.high_mark, row.run_ts)

    def last_done(self) -> str | None:
        """An id up to which all runs are done: that of the last, or the mark before an open one."""
        row = self._row()
        if row is None:
            return None
        return row.run_id if row.status == "done" else f"{row.low_mark or 0:017d}-~"

    def record(self, run: Run, status: str) -> None:
        row = self.spark.range(1).select(
            F.lit(run.run_id).alias("run_id"),
            F.lit(status).alias("status"),
            _mark(run.low).alias("low_mark"),
            _mark(run.high).alias("high_mark"),
            _mark(run.at).alias("run_ts"),
        )
        overwrite_table(row.coalesce(1), self.table, self.location)


def new_rows(rows: DataFrame, low: int | None, high: int | None = None) -> DataFrame:
    """Rows ingested after the mark `low` and up to `high`, from the partitions of those alone.

    Of a table without such partitions all files are candidates.
    """
    if INGESTED_AT in rows.columns:
        at = F.col(INGESTED_AT)
        if low is not None:
            rows = rows.filter(at > low)
        if high is not None:
            rows = rows.filter(at <= high)
        rows = rows.drop(INGESTED_AT, BATCH)
    if high is None:
        return rows
    return rows.filter(ingested_between(None if low is None else _mark(low), _mark(high)))


def hand_over(
    state: StateTable,
    source: str,
    write: Callable[[DataFrame, Run], None],
    run_ts: dt.datetime | None = None,
) -> bool:
    """Give the rows of `source` that are new since the last run to `write`.

    The bounds and the time of the run are recorded first. After a failure the same run is
    done again, with the same rows, id and time, whatever its first try had written: `write`
    has to replace what it wrote under that id. Returns whether there was anything new.
    """
    rows = read_table(state.spark, source)
    run = state.unfinished()
    if run is None:
        low = state.last_mark()
        newer = high_mark(new_rows(rows, low), None if low is None else _mark(low))
        high = newer.select(F.unix_micros("high_mark").alias("m")).first().m
        if high is None:
            return False
        at = (run_ts or dt.datetime.now(UTC)) - dt.datetime.fromtimestamp(0, UTC)
        # Ids are in the order of runs, as their marks are.
        run_id = f"{high:017d}-{uuid4().hex[:8]}"
        run = Run(run_id, low, high, at // dt.timedelta(microseconds=1))
        state.record(run, "started")
    write(new_rows(rows, run.low, run.high), run)
    state.record(run, "done")
    return True
