"""Tables over a path: registration, append and overwrite."""

import datetime as dt
import re
import time
from collections.abc import Mapping, Sequence
from dataclasses import dataclass
from itertools import islice
from uuid import uuid4

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

EPOCH = dt.datetime(1970, 1, 1, tzinfo=dt.timezone.utc)


def create_schema(spark: SparkSession, schema: str, location: str) -> None:
    spark.sql(f"CREATE SCHEMA IF NOT EXISTS {schema} LOCATION '{location}'")


def register_table(
    spark: SparkSession, table: str, location: str, schema: T.StructType, fmt: str = "parquet"
) -> None:
    """Make a path a table if it is none yet; a table that exists gets the new columns."""
    if fmt == "delta":
        spark.sql(f"CREATE TABLE IF NOT EXISTS {table} USING delta LOCATION '{location}'")
        return
    if not spark.catalog.tableExists(table):
        nullable = T.StructType([T.StructField(f.name, f.dataType) for f in schema])
        spark.catalog.createTable(table, location, fmt, nullable)
        return
    add_columns(spark, table, schema)


def add_columns(spark: SparkSession, table: str, schema: T.StructType) -> None:
    """Give a table the columns that it does not have."""
    there = {c.lower() for c in spark.table(table).columns}
    new = [f for f in schema if f.name.lower() not in there]
    if new:
        columns = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in new)
        spark.sql(f"ALTER TABLE {table} ADD COLUMNS ({columns})")


def ensure_partitioned(
    spark: SparkSession, table: str, location: str, schema: T.StructType, parts: Sequence[str], fmt: str
) -> None:
    """Make a path a partitioned table if it is none yet, with the partitions that are there.

    A table that exists gets the new columns. Files of a new Parquet table are packed with zstd,
    which makes them about half as large as by default.
    """
    if spark.catalog.tableExists(table):
        add_columns(spark, table, schema)
        return
    columns = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in schema)
    keys = ", ".join(f"`{c}`" for c in parts)
    packed = "OPTIONS (compression = 'zstd') " if fmt == "parquet" else ""
    spark.sql(
        f"CREATE TABLE {table} ({columns}) USING {fmt} {packed}PARTITIONED BY ({keys}) LOCATION '{location}'"
    )
    fs, path = _fs(spark, location)
    if fs.exists(path):
        spark.catalog.recoverPartitions(table)


def _replace_partition(
    rows: DataFrame, table: str, fixed: Mapping[str, str], dynamic: Sequence[str] = ()
) -> None:
    """Overwrite the partition with the `fixed` values by rows, columns matched by name."""
    spark, there = rows.sparkSession, {c.lower() for c in rows.columns}
    columns = [
        f"`{f.name}`" if f.name.lower() in there else f"CAST(NULL AS {f.dataType.simpleString()})"
        for f in spark.table(table).schema
        if f.name not in fixed
    ]
    keys = ", ".join([*(f"`{k}` = {v}" for k, v in fixed.items()), *(f"`{c}`" for c in dynamic)])
    spark.sql(
        f"INSERT OVERWRITE TABLE {table} PARTITION ({keys}) SELECT {', '.join(columns)} FROM {{rows}}",
        rows=rows,
    )


# The partitions of an ingested table: the time of ingestion in microseconds, and the batch.
INGESTED_AT, BATCH = "_ingested_at", "_batch"


def append_batch(
    df: DataFrame, table: str, location: str, batch: int, at: dt.datetime, fmt: str = "parquet"
) -> None:
    """Add the rows of a micro-batch that was ingested at a time; done again, it replaces them.

    A batch is a partition by that time and its number, so a scan for what was ingested after a
    mark opens no file of an older batch, and the numbers of a new checkpoint meet no old ones.
    With Delta, the transaction of a batch is done once.
    """
    spark, micros = df.sparkSession, (at - EPOCH) // dt.timedelta(microseconds=1)
    rows = df.withColumn("_ingestion_time", F.timestamp_micros(F.lit(micros).cast("bigint")))
    if fmt == "delta":
        keyed = rows.withColumns({INGESTED_AT: F.lit(micros).cast("bigint"), BATCH: F.lit(batch).cast("bigint")})
        (
            keyed.write.format(fmt).mode("append").partitionBy(INGESTED_AT, BATCH)
            .option("path", location).option("mergeSchema", True)
            .option("txnAppId", f"{table} {micros}").option("txnVersion", batch).saveAsTable(table)
        )
        return
    ensure_partitioned(spark, table, location, ingested_schema(rows.schema), (INGESTED_AT, BATCH), fmt)
    _replace_partition(rows, table, {INGESTED_AT: str(micros), BATCH: str(batch)})


def ingested_schema(schema: T.StructType) -> T.StructType:
    return T.StructType([*schema, T.StructField(INGESTED_AT, T.LongType()), T.StructField(BATCH, T.LongType())])


# The run that put a row into a table, and in a pack the run that it came with.
RUN_ID, PACKED_RUN = "_run_id", "_packed_run"


def append_table(
    df: DataFrame,
    table: str,
    location: str,
    run_id: str,
    partition_by: Sequence[str] = ("year", "month", "day"),
    fmt: str = "parquet",
) -> None:
    """Add the rows of a run to a partitioned table; done again, it replaces what it had added.

    The run is the first partition, so its rows have a folder of their own, which is replaced
    as a whole. New columns of the rows are added to the table first, columns are matched by
    name, and one that the rows do not have is null.

    Rows are brought together by partition, so that a run does not write one small file
    per task and day. It is a rebalance, not a repartition: a day with very many rows is
    split into tasks of the advisory size, and small days share one.
    """
    spark, parts = df.sparkSession, [RUN_ID, *partition_by]
    rows = df.withColumn(RUN_ID, F.lit(run_id)).hint("rebalance", *partition_by)
    if fmt == "delta":
        (
            rows.write.format(fmt).mode("overwrite").partitionBy(*parts).option("path", location)
            .option("replaceWhere", f"{RUN_ID} = '{run_id}'").option("mergeSchema", True)
            .saveAsTable(table)
        )
        return
    ensure_partitioned(spark, table, location, rows.schema, parts, fmt)
    _replace_partition(rows.drop(RUN_ID), table, {RUN_ID: f"'{run_id}'"}, partition_by)


@dataclass(frozen=True)
class Layout:
    """Which runs of a partitioned table its view shows.

    Runs up to the id `upto` are shown by the `packs` that hold them, later ones by themselves.
    `gone` are what the last compaction replaced; readers that began before it may still use them.
    The id of a pack is that of its last run with the number of its runs.
    """

    packs: tuple[str, ...] = ()
    upto: str = ""
    gone: tuple[str, ...] = ()

    @property
    def shown(self) -> str:
        """A condition on the first partition."""
        packs = ", ".join(f"'{p}'" for p in self.packs)
        later = f"({RUN_ID} > '{self.upto}' AND {RUN_ID} NOT LIKE '%{PACK}%')"
        return f"({RUN_ID} IN ({packs}) OR {later})" if packs else later


PACK = "~"


def read_layout(spark: SparkSession, view: str) -> Layout:
    if not spark.catalog.tableExists(view):
        return Layout()
    found = {r.key: r.value for r in spark.sql(f"SHOW TBLPROPERTIES {view}").collect()}

    def ids(key: str) -> tuple[str, ...]:
        return tuple(x for x in found.get(f"layout.{key}", "").split(",") if x)

    return Layout(ids("packs"), found.get("layout.upto", ""), ids("gone"))


def publish(spark: SparkSession, view: str, table: str, layout: Layout) -> None:
    """Make the view show the runs of a layout: one change of the catalog, whatever it hides."""
    properties = f"'layout.packs' = '{','.join(layout.packs)}', 'layout.upto' = '{layout.upto}', "
    properties += f"'layout.gone' = '{','.join(layout.gone)}'"
    spark.sql(
        f"CREATE OR REPLACE VIEW {view} TBLPROPERTIES ({properties}) "
        f"AS SELECT * FROM {table} WHERE {layout.shown}"
    )


def compact(
    spark: SparkSession,
    view: str,
    table: str,
    location: str,
    finished: str,
    partition_by: Sequence[str] = ("year", "month", "day"),
    at_least: int = 2,
) -> bool:
    """Pack the runs of a table up to the id `finished` that no pack holds yet.

    Their rows are written as one run, with the files of a day put together, and the view is
    switched to it when it is whole: readers see either all old or all new files, and a compaction
    that is cut off leaves nothing that is shown. Packs of no more runs than the new one are
    packed again with it, so there are as many packs as the number of runs has bits, and a row is
    written as often at most. What a compaction replaces, or a cut-off one left, goes with the
    next one. Returns whether there was enough to pack.
    """
    layout, there = read_layout(spark, view), _runs(spark, location)
    for old in there:
        if old in layout.gone or (PACK in old and old not in layout.packs):
            _drop_run(spark, table, location, old)
    packs = list(layout.packs)
    runs = [r for r in there if PACK not in r and layout.upto < r <= finished]
    if len(runs) < at_least:
        publish(spark, view, table, Layout(layout.packs, layout.upto))
        return False
    n, merged = len(runs), []
    while packs and (size := int(packs[-1].split(PACK)[1])) <= n:
        merged.append(packs.pop())
        n += size
    pack = f"{max(runs)}{PACK}{n}{PACK}{uuid4().hex[:8]}"
    # By folder: a table that is read as a whole cannot be written to.
    folders = [f"{location.rstrip('/')}/{RUN_ID}={r}" for r in [*merged, *runs]]
    rows = spark.read.schema(spark.table(table).schema).option("basePath", location).parquet(*folders)
    rows = rows.withColumn(PACKED_RUN, run_of(rows)).drop(RUN_ID)
    append_table(rows, table, location, pack, partition_by)
    publish(spark, view, table, Layout((*packs, pack), max(runs), (*merged, *runs)))
    return True


def run_of(rows: DataFrame) -> Column:
    """The run that a row of a table came with, packed or not."""
    return F.coalesce(PACKED_RUN, RUN_ID) if PACKED_RUN in rows.columns else F.col(RUN_ID)


def rows_of_runs(rows: DataFrame, after: str | None, upto: str) -> DataFrame:
    """Rows of the runs after an id and up to another; packs of older runs alone are not opened."""
    if after is not None:
        rows = rows.filter((F.col(RUN_ID) > after) & (run_of(rows) > after))
    return rows.filter(run_of(rows) <= upto)


def last_run(spark: SparkSession, table: str) -> str | None:
    """The latest run of a table, by its partitions."""
    if not spark.catalog.tableExists(table):
        return None
    names = F.split(F.element_at(F.split("partition", f"{RUN_ID}="), -1), "/")[0]
    return spark.sql(f"SHOW PARTITIONS {table}").agg(F.max(names)).first()[0]


def _fs(spark: SparkSession, location: str):
    path = spark._jvm.org.apache.hadoop.fs.Path(location)
    return path.getFileSystem(spark._jsc.hadoopConfiguration()), path


def _runs(spark: SparkSession, location: str) -> list[str]:
    """Ids of the runs that have a folder: those since the last compactions, and packs."""
    fs, path = _fs(spark, location)
    names = [s.getPath().getName() for s in fs.listStatus(path)] if fs.exists(path) else []
    return sorted(n.split("=", 1)[1] for n in names if n.startswith(f"{RUN_ID}="))


# Partitions that leave the catalog in one statement.
DROPPED_AT_ONCE = 500


def _drop_run(spark: SparkSession, table: str, location: str, run_id: str) -> None:
    """Take a run's partitions out of the catalog, then remove its folder."""
    found = spark.sql(f"SHOW PARTITIONS {table} PARTITION ({RUN_ID} = '{run_id}')").toLocalIterator()
    while some := [r.partition for r in islice(found, DROPPED_AT_ONCE)]:
        specs = []
        for name in some:
            pairs = [p.split("=", 1) for p in name.split("/")]
            values = ", ".join(
                f"`{k}` = " + ("null" if v == "__HIVE_DEFAULT_PARTITION__" else f"'{v}'") for k, v in pairs
            )
            specs.append(f"PARTITION ({values})")
        spark.sql(f"ALTER TABLE {table} DROP IF EXISTS {', '.join(specs)}")
    fs, _ = _fs(spark, location)
    fs.delete(spark._jvm.org.apache.hadoop.fs.Path(f"{location.rstrip('/')}/{RUN_ID}={run_id}"), True)


def overwrite_table(df: DataFrame, table: str, location: str, fmt: str = "parquet") -> None:
    """Replace the contents of a table.

    Parquet goes to a new folder below `location`, and the table is switched to it when it is
    whole, so a write that fails leaves the table as it was. The folder before the last one
    is removed: who still reads the last one can go on.
    """
    if fmt == "delta":
        df.write.format(fmt).mode("overwrite").option("path", location).saveAsTable(table)
        return
    spark = df.sparkSession
    folder = f"{location.rstrip('/')}/v{time.time_ns()}-{uuid4().hex[:8]}"
    df.write.format(fmt).save(folder)
    schema = T.StructType([T.StructField(f.name, f.dataType) for f in df.schema])
    if spark.catalog.tableExists(table) and spark.table(table).schema == schema:
        spark.sql(f"ALTER TABLE {table} SET LOCATION '{folder}'")
        spark.catalog.refreshTable(table)
    else:
        spark.sql(f"DROP TABLE IF EXISTS {table}")
        spark.catalog.createTable(table, folder, fmt, schema)
    _keep_newest(spark, location, 2)


def _keep_newest(spark: SparkSession, location: str, n: int) -> None:
    """Remove all but the newest of the folders that `overwrite_table` made."""
    fs, path = _fs(spark, location)
    made = sorted((s.getPath() for s in fs.listStatus(path)), key=lambda p: p.getName())
    for old in [p for p in made if re.fullmatch(r"v\d+-[0-9a-f]{8}", p.getName())][:-n]:
        fs.delete(old, True)
