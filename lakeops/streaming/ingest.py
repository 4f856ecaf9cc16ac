"""Draining a stream into a table."""

from collections.abc import Callable, Mapping

from pyspark.sql import DataFrame


def drain(
    df: DataFrame,
    path: str,
    checkpoint: str,
    name: str,
    fmt: str = "parquet",
    options: Mapping[str, str] | None = None,
) -> None:
    """Append what the stream has now, then stop.

    The checkpoint records what was read, so a second run with nothing new adds nothing
    and a run that was cut off goes on where it stopped.
    """
    query = (
        df.writeStream.format(fmt)
        .options(**(options or {}))
        .option("checkpointLocation", checkpoint)
        .outputMode("append")
        .trigger(availableNow=True)
        .queryName(name)
        .start(path)
    )
    query.awaitTermination()


def drain_batches(
    df: DataFrame, write: Callable[[DataFrame, int], None], checkpoint: str, name: str
) -> None:
    """Give what the stream has now to `write`, batch by batch with its number, then stop.

    A batch that was cut off is given again with the same number, rows and `current_timestamp`
    of the stream, so a `write` that replaces what it wrote for the number adds nothing twice,
    to however many tables it writes.
    """
    query = (
        df.writeStream.foreachBatch(write)
        .option("checkpointLocation", checkpoint)
        .trigger(availableNow=True)
        .queryName(name)
        .start()
    )
    query.awaitTermination()
