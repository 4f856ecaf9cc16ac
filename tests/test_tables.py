import datetime as dt
from concurrent.futures import ThreadPoolExecutor
from uuid import uuid4

import pytest
from pyspark.sql import functions as F

from lakeops.functions.time import partition_columns
from lakeops.operators import sinks
from lakeops.sources import tables
from lakeops.streaming.state import Run, StateTable, hand_over

UTC = dt.timezone.utc


@pytest.fixture
def schema(spark, tmp_path):
    name = f"s{uuid4().hex[:8]}"
    sinks.create_schema(spark, name, f"{tmp_path}/{name}")
    yield name
    spark.sql(f"DROP SCHEMA {name} CASCADE")


def events(spark, *seconds):
    df = spark.createDataFrame([(s,) for s in seconds], "s long")
    return df.withColumn("_ingestion_time", F.timestamp_seconds("s"))


def test_bounds_of_the_incremental_scan(spark, rows):
    df = events(spark, None, 10, 20, 30)
    low, high = (dt.datetime.fromtimestamp(s, UTC) for s in (10, 20))
    assert rows(df.filter(tables.ingested_between(low, high)), "s") == [(20,)]
    assert rows(df.filter(tables.ingested_between(None, high)), "s") == [(None,), (10,), (20,)]


def test_high_mark(spark):
    df = events(spark, 10, 30, 20).select(tables.INGESTED)
    mark = tables.high_mark(df).select(F.unix_seconds("high_mark"))
    assert mark.first()[0] == 30
    assert tables.high_mark(df, dt.datetime.fromtimestamp(30, UTC)).first().high_mark is None


def test_registered_table_gets_new_columns(spark, schema, tmp_path, rows):
    path = f"{tmp_path}/t"
    for df in (spark.sql("SELECT 1 AS a"), spark.sql("SELECT 2 AS a, 'x' AS b")):
        df.write.mode("append").parquet(path)
        sinks.register_table(spark, f"{schema}.t", path, df.schema)
    assert rows(tables.read_table(spark, f"{schema}.t")) == [(1, None), (2, "x")]


def test_append_by_day_and_read_by_day(spark, schema, tmp_path, rows):
    days = [None, "2024-12-31 10:00:00", "2025-01-01 00:00:00", "2025-01-02 23:59:59"]
    df = spark.createDataFrame([(d,) for d in days], "d string")
    df = partition_columns(df.withColumn("timestamp", F.col("d").cast("timestamp")))
    for _ in range(2):
        sinks.append_table(df, f"{schema}.t", f"{tmp_path}/t", uuid4().hex)
    table = tables.read_table(spark, f"{schema}.t")
    assert table.count() == 8
    found = tables.date_range(table, dt.date(2024, 12, 31), dt.date(2025, 1, 1))
    assert rows(found, "d") == [(days[1],)] * 2 + [(days[2],)] * 2
    spark.conf.set("spark.sql.maxMetadataStringLength", 10_000)
    plan = tables.date_range(table, dt.date(2025, 1, 1), dt.date(2025, 1, 1))
    scan = plan._jdf.queryExecution().sparkPlan().toString()
    filters = scan[scan.index("PartitionFilters") : scan.index("PushedFilters")]
    assert "make_date" in filters and "year" in filters


def test_a_hot_day_is_split_over_tasks(spark, schema, tmp_path):
    """All rows of one day: the rebalance writes several files, not one task's single file."""
    key, value = "spark.sql.adaptive.advisoryPartitionSizeInBytes", "64k"
    before = spark.conf.get(key)
    spark.conf.set(key, value)
    try:
        df = spark.range(0, 200_000, 1, 8).withColumn("timestamp", F.lit("2025-01-01 00:00:00"))
        df = partition_columns(df.withColumn("timestamp", F.col("timestamp").cast("timestamp")))
        sinks.append_table(df, f"{schema}.t", f"{tmp_path}/t", "run")
    finally:
        spark.conf.set(key, before)
    written = tables.read_table(spark, f"{schema}.t")
    assert written.count() == 200_000
    assert len(written.inputFiles()) > 1


def test_overwrite(spark, schema, tmp_path, rows):
    for n in (3, 2):
        sinks.overwrite_table(spark.range(n).toDF("n"), f"{schema}.t", f"{tmp_path}/t")
    assert rows(tables.read_table(spark, f"{schema}.t")) == [(0,), (1,)]


def test_a_failed_overwrite_leaves_the_table(spark, schema, tmp_path, rows):
    table, path = f"{schema}.t", f"{tmp_path}/t"
    sinks.overwrite_table(spark.range(5), table, path)
    bad = spark.range(9).select(F.when(F.col("id") < 8, F.col("id")).otherwise(F.raise_error(F.lit("no"))).alias("id"))
    with pytest.raises(Exception, match="no"):
        sinks.overwrite_table(bad, table, path)
    assert len(rows(tables.read_table(spark, table))) == 5
    for n in (2, 3, 4):
        sinks.overwrite_table(spark.range(n).selectExpr("id", "id AS more"), table, path)
    assert len(rows(tables.read_table(spark, table))) == 4
    assert len([f for f in (tmp_path / "t").iterdir() if f.name.startswith("v")]) == 2


def test_append_adds_columns_and_replaces_its_own_run(spark, schema, tmp_path, rows):
    table, path = f"{schema}.t", f"{tmp_path}/t"

    def add(run_id, sql):
        sinks.append_table(spark.sql(sql), table, path, run_id, partition_by=["day"])

    add("r1", "SELECT 1 AS a, 1 AS day UNION ALL SELECT 2, 2")
    add("r2", "SELECT 'x' AS b, 3 AS a, 1 AS day")
    add("r3", "SELECT 1 AS day, 'y' AS B")
    add("r2", "SELECT 'z' AS b, 4 AS a, 1 AS day")
    assert rows(tables.read_table(spark, table), "a", "b", "day") == [
        (None, "y", 1), (1, None, 1), (2, None, 2), (4, "z", 1),
    ]


class HandOver:
    def __init__(self, spark, schema, tmp_path, name="events"):
        self.spark, self.schema, self.root = spark, schema, tmp_path
        self.state = StateTable(spark, f"{schema}.{name}_state", f"{tmp_path}/state/{name}")
        self.source, self.sink = f"{schema}.bronze", f"{schema}.silver"

    def add(self, *seconds):
        events(self.spark, *seconds).write.mode("append").option(
            "path", f"{self.root}/bronze"
        ).saveAsTable(self.source)

    def write(self, df, run):
        sinks.append_table(df, self.sink, f"{self.root}/silver", run.run_id, partition_by=[])

    def run(self, write=None):
        return hand_over(self.state, self.source, write or self.write)

    def silver(self):
        return sorted(r.s for r in tables.read_table(self.spark, self.sink).collect())


def test_hand_over_takes_new_rows_once(spark, schema, tmp_path):
    h = HandOver(spark, schema, tmp_path)
    h.add(10, 20)
    assert h.run() and h.silver() == [10, 20]
    assert not h.run() and h.silver() == [10, 20]
    h.add(30)
    assert h.run() and h.silver() == [10, 20, 30]
    assert h.state.last_mark() == 30_000_000


def test_hand_over_leaves_rows_that_arrive_while_it_runs(spark, schema, tmp_path):
    h = HandOver(spark, schema, tmp_path)
    h.add(10)

    def write_late(df, run):
        h.add(15)
        h.write(df, run)

    h.run(write_late)
    assert h.silver() == [10]
    h.run()
    assert h.silver() == [10, 15]


def test_hand_over_after_a_failed_write(spark, schema, tmp_path):
    h = HandOver(spark, schema, tmp_path)
    h.add(10)

    def fail(df, run):
        raise OSError("disk full")

    with pytest.raises(OSError):
        h.run(fail)
    h.add(20)
    assert h.run() and h.silver() == [10]
    assert h.run() and h.silver() == [10, 20]


def test_hand_over_after_half_a_write_gives_all_rows_once(spark, schema, tmp_path):
    h = HandOver(spark, schema, tmp_path)
    h.add(*range(1000))
    times = []

    def half(df, run):
        times.append(run.time)
        h.write(df.filter("s < 400"), run)
        raise OSError("driver lost")

    def whole(df, run):
        times.append(run.time)
        h.write(df, run)

    with pytest.raises(OSError):
        h.run(half)
    assert len(h.silver()) == 400
    assert h.run(whole) and h.silver() == list(range(1000))
    assert times[0] == times[1]
    assert not h.run() and len(h.silver()) == 1000


def test_hand_over_after_a_lost_record_does_not_write_twice(spark, schema, tmp_path):
    h = HandOver(spark, schema, tmp_path)
    h.add(10)

    def fail_after(df, run):
        h.write(df, run)
        raise OSError("driver lost")

    with pytest.raises(OSError):
        h.run(fail_after)
    assert h.run() and h.silver() == [10]
    assert not h.run()


def test_pipelines_record_side_by_side_and_state_does_not_grow(spark, schema, tmp_path):
    def record(i):
        state = HandOver(spark, schema, tmp_path, f"p{i}").state
        for k in range(6):
            state.record(Run(f"{i}-{k}", k, k + 1, 0), "done")
        return state

    with ThreadPoolExecutor(5) as pool:
        for state in pool.map(record, range(5)):
            assert state.last_mark() == 6 and state.unfinished() is None
            assert tables.read_table(spark, state.table).count() == 1
