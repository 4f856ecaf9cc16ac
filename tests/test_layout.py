"""Layout of the tables: scans that open only what is new, batches done again, packed runs."""

import datetime as dt
import json
import random
from pathlib import Path
from uuid import uuid4

import pytest
from pyspark.sql import functions as F

from lakeops.functions.decode import framed_json_payload
from lakeops.operators import sinks
from lakeops.plans import lake as lake_module
from lakeops.plans.lake import Lake
from lakeops.sources.tables import read_table
from lakeops.streaming import state as state_module
from lakeops.streaming.state import StateTable, hand_over, new_rows

UTC = dt.timezone.utc


@pytest.fixture
def schema(spark, tmp_path):
    name = f"s{uuid4().hex[:8]}"
    sinks.create_schema(spark, name, f"{tmp_path}/{name}")
    yield name
    spark.sql(f"DROP SCHEMA {name} CASCADE")


@pytest.fixture
def lake(spark, tmp_path):
    prefix = f"l{uuid4().hex[:8]}_"
    yield Lake(spark, f"{tmp_path}/landing", f"{tmp_path}/lake", prefix=prefix)
    for s in spark.catalog.listDatabases(f"{prefix}*"):
        spark.sql(f"DROP SCHEMA {s.name} CASCADE")


def at(second):
    return dt.datetime.fromtimestamp(second, UTC)


# --- batches and pruned scans


def test_the_next_run_opens_its_own_files_alone(spark, schema, tmp_path, monkeypatch):
    """A hundred ingested batches, handed over, then one more: no old file is opened for it."""
    table, path = f"{schema}.bronze", f"{tmp_path}/bronze"
    rows = spark.range(1).withColumn("_ingestion_time", F.lit(at(0)))
    sinks.append_batch(rows, table, path, 0, at(1))
    # The other batches as an earlier session left them: folders that the new table finds.
    first = next(Path(path).rglob("part-*.parquet"))
    for i in range(1, 100):
        folder = Path(path, f"_ingested_at={(i + 1) * 10**6}", f"_batch={i}")
        folder.mkdir(parents=True)
        (folder / "part-0.parquet").write_bytes(first.read_bytes())
    spark.sql(f"DROP TABLE {table}")
    sinks.ensure_partitioned(
        spark, table, path, sinks.ingested_schema(rows.schema), (sinks.INGESTED_AT, sinks.BATCH), "parquet"
    )
    assert len(read_table(spark, table).inputFiles()) == 100

    state = StateTable(spark, f"{schema}.state", f"{tmp_path}/state")
    state.record(state_module.Run("r", None, 100 * 10**6, 0), "done")
    sinks.append_batch(spark.range(5).withColumn("_ingestion_time", F.lit(at(0))), table, path, 100, at(101))
    opened, marks, real = [], [], state_module.high_mark
    monkeypatch.setattr(state_module, "high_mark", lambda df, low: marks.append(df.inputFiles()) or real(df, low))
    assert hand_over(state, table, lambda df, run: opened.append((df.inputFiles(), df.count(), df.columns)))
    [(files, count, columns)] = opened
    assert len(files) == len(marks[0]) == len(new_rows(read_table(spark, table), 100 * 10**6).inputFiles())
    assert all("_ingested_at=101000000" in f for f in files + marks[0])
    assert (count, columns) == (5, ["id", "_ingestion_time"])
    assert not hand_over(state, table, lambda df, run: opened.append(df))


def test_a_batch_done_again_replaces_itself_alone(spark, schema, tmp_path, rows):
    table, path = f"{schema}.t", f"{tmp_path}/t"

    def add(n, batch, second):
        df = spark.range(n).withColumn("_ingestion_time", F.lit(at(5)))
        sinks.append_batch(df, table, path, batch, at(second))

    add(3, 0, 10)
    add(2, 1, 20)
    add(4, 1, 20)
    add(1, 1, 30)  # the same number under a new checkpoint
    found = read_table(spark, table).groupBy("_batch", F.unix_seconds("_ingestion_time").alias("s")).count()
    assert rows(found) == [(0, 10, 3), (1, 20, 4), (1, 30, 1)]
    add(0, 7, 40)
    assert read_table(spark, table).count() == 8


def test_new_columns_of_a_batch(spark, schema, tmp_path, rows):
    for i, sql in enumerate(("SELECT 1 AS a", "SELECT 'x' AS b, 2 AS a")):
        df = spark.sql(sql).withColumn("_ingestion_time", F.lit(at(0)))
        sinks.append_batch(df, f"{schema}.t", f"{tmp_path}/t", i, at(i))
    assert rows(read_table(spark, f"{schema}.t"), "a", "b") == [(1, None), (2, "x")]


# --- records of several schemas


DDL = "timestamp timestamp, soil_temperature double, soil_humidity double, soil_quality double"


def put_records(spark, tmp_path, values, offset=0):
    path = f"{tmp_path}/topic"
    df = spark.createDataFrame(
        [(b"sensor", bytes(v), "t", 0, offset + i, at(0), 0) for i, v in enumerate(values)],
        "key binary, value binary, topic string, partition int, offset bigint, timestamp timestamp, timestampType int",
    )
    df.write.mode("append").parquet(path)
    return spark.readStream.schema(df.schema).parquet(path)


def framed(schema_id, value):
    return b"\x00" + schema_id.to_bytes(4, "big") + value.encode()


GOOD = '{"timestamp":"2025-03-01T10:00:00Z","soil_temperature":1.5}'


def test_records_of_another_schema_are_kept_aside(spark, lake, tmp_path, rows):
    values = [framed(7, GOOD), framed(8, "other"), b"no frame", b"", framed(7, GOOD)]
    for _ in range(2):
        stream = put_records(spark, tmp_path, values) if _ == 0 else spark.readStream.schema(stream.schema).parquet(f"{tmp_path}/topic")
        lake.ingest("iot_sensors", schema_id=7, payload=framed_json_payload(DDL), records=stream)
    bronze = read_table(spark, lake.table("bronze", "iot_sensors"))
    assert rows(bronze, "_offset", "soil_temperature") == [(0, 1.5), (4, 1.5)]
    rejects = read_table(spark, lake.table("bronze", "iot_sensors_rejects"))
    assert rows(rejects, "_offset", "_schema_id", "_value") == [
        (1, 8, framed(8, "other")), (2, None, b"no frame"), (3, None, b""),
    ]
    assert lake.process("iot_sensors", at(10))
    assert read_table(spark, lake.table("silver", "iot_sensors")).count() == 2


@pytest.mark.parametrize("lost", [1, 2])
def test_a_batch_cut_off_between_its_tables_doubles_nothing(spark, lake, tmp_path, monkeypatch, lost):
    """The driver is lost after the rejects, or after both tables, and the batch is done again."""
    stream = put_records(spark, tmp_path, [framed(7, GOOD), framed(8, "other"), framed(7, GOOD)])
    real, calls = lake_module.append_batch, []

    def cut(*args):
        real(*args)
        calls.append(args[1])
        if len(calls) == lost:
            raise OSError("driver lost")

    monkeypatch.setattr(lake_module, "append_batch", cut)
    how = {"schema_id": 7, "payload": framed_json_payload(DDL)}
    with pytest.raises(Exception, match="driver lost"):
        lake.ingest("iot_sensors", records=stream, **how)
    lake.ingest("iot_sensors", records=stream, **how)
    put_records(spark, tmp_path, [framed(9, "later")], offset=3)
    lake.ingest("iot_sensors", records=stream, **how)
    assert len(calls) == lost + 2 + 2 - (lost == 1) * 0 if lost == 2 else len(calls) == 5
    assert read_table(spark, lake.table("bronze", "iot_sensors")).count() == 2
    assert read_table(spark, lake.table("bronze", "iot_sensors_rejects")).count() == 2


# --- packed runs


class Runs:
    def __init__(self, spark, schema, tmp_path):
        self.spark, self.view, self.table = spark, f"{schema}.t", f"{schema}.t_runs"
        self.path, self.n = f"{tmp_path}/t", 0

    def add(self, *values):
        """A run with a row for each value, and that as its day, null for a day that is not known."""
        self.n += 1
        df = self.spark.createDataFrame([(self.n, v) for v in values], "run int, day int")
        sinks.append_table(df, self.table, self.path, self.id(self.n), ["day"])
        sinks.publish(self.spark, self.view, self.table, sinks.read_layout(self.spark, self.view))

    def id(self, n):
        return f"{n:017d}-aaaaaaaa"

    def compact(self, upto=None):
        return sinks.compact(self.spark, self.view, self.table, self.path, self.id(upto or self.n), ["day"])

    def rows(self):
        found = read_table(self.spark, self.view).select("run", "day").collect()
        return sorted(map(tuple, found), key=str)

    def files(self):
        return len(read_table(self.spark, self.view).inputFiles())

    def folders(self):
        return sorted(p.name for p in Path(self.path).iterdir() if p.name.startswith("_run_id"))


def test_fifty_runs_end_in_few_files(spark, schema, tmp_path):
    t, expected = Runs(spark, schema, tmp_path), []
    for i in range(50):
        days = (1, 2, None) if i % 5 == 0 else (1,)
        t.add(*days)
        expected += [(t.n, d) for d in days]
        if i in (9, 29):
            assert t.compact()
    expected.sort(key=str)
    assert t.rows() == expected and t.files() > 20
    assert t.compact()
    assert t.rows() == expected
    packs = sinks.read_layout(spark, t.view).packs
    assert [int(p.split("~")[1]) for p in packs] == [30, 20] and t.files() == 6
    # What was replaced stays for readers that began before, until the next compaction.
    assert len(t.folders()) > 20
    assert not t.compact()
    assert len(t.folders()) == 2 and t.rows() == expected
    assert spark.sql(f"SHOW PARTITIONS {t.table}").count() == 6


def test_packs_are_as_many_as_the_number_of_runs_has_bits(spark, schema, tmp_path):
    t = Runs(spark, schema, tmp_path)
    for _ in range(7):
        t.add(1)
        t.add(1)
        assert t.compact()
    sizes = [int(p.split("~")[1]) for p in sinks.read_layout(spark, t.view).packs]
    assert sizes == [8, 4, 2]
    assert t.rows() == [(n, 1) for n in sorted(range(1, 15), key=str)]


def test_a_compaction_that_is_cut_off_changes_nothing(spark, schema, tmp_path, monkeypatch):
    t = Runs(spark, schema, tmp_path)
    for _ in range(4):
        t.add(1, 2)
    before, reader = t.rows(), read_table(spark, t.view)

    def lost(*args):
        raise OSError("driver lost")

    with monkeypatch.context() as m:
        m.setattr(sinks, "publish", lost)
        with pytest.raises(OSError):
            t.compact()
    assert t.rows() == before and len(t.folders()) == 5
    assert t.compact() and t.rows() == before
    # A reader that began before the switch goes on with the old files.
    assert reader.count() == 8
    t.compact()
    assert len(t.folders()) == 1 and t.rows() == before


def test_runs_that_are_not_done_stay_as_they_are(spark, schema, tmp_path):
    t = Runs(spark, schema, tmp_path)
    for _ in range(3):
        t.add(1)
    assert t.compact(upto=2)
    assert sinks.read_layout(spark, t.view).upto == t.id(2)
    t.add(4)
    assert t.rows() == [(1, 1), (2, 1), (3, 1), (4, 4)]


def test_lake_compacts_what_is_processed(spark, lake, tmp_path):
    folder = tmp_path / "landing" / "internal_system" / "inventory"
    folder.mkdir(parents=True)
    header = "timestamp,category,product,stock_quantity,sales_price,manufacturing_date,expiration_date"
    assert not lake.compact("inventory")
    for i in range(3):
        line = f"2025-03-01 10:00:00,seeds,seed_{i} corn,{i},2.0,2025-01-01,2025-02-01"
        (folder / f"{i}.csv").write_text(f"{header}\n{line}\n")
        lake.ingest("inventory")
        assert lake.process("inventory", at(i))
    silver = lake.table("silver", "inventory")
    before = sorted(map(str, read_table(spark, silver).drop("_run_id").collect()))
    assert lake.compact("inventory")
    after = read_table(spark, silver)
    assert sorted(map(str, after.drop("_run_id", "_packed_run").collect())) == before
    assert len(after.inputFiles()) == 1
    with pytest.raises(ValueError, match="weather"):
        lake.compact("weather")


# --- what runs know of each other


def put_climate(tmp_path, name, readings):
    """Minutes after midnight, station and temperature."""
    folder = tmp_path / "landing" / "meteorologic_center" / "climate"
    folder.mkdir(parents=True, exist_ok=True)
    fields = ("temperature_C", "precipitation_mm", "humidity_percent", "solar_radiation_Wm2", "wind_speed_mps")
    lines = []
    for minute, station, value in readings:
        millis = (1740787200 + minute * 60) * 1000
        line = {"timestamp": millis, "station_id": station, "coord": [40.5, -3.25], **dict.fromkeys(fields, value)}
        lines.append(json.dumps(line))
    (folder / name).write_text("\n".join(lines))


def draw_readings(seed, n=60):
    draw = random.Random(seed)
    return [(20 * i, f"st{draw.randrange(3)}", None if draw.random() < 0.4 else draw.randrange(100) / 4) for i in range(n)]


def climate_runs(spark, tmp_path, cuts, across_runs, compact=False, name="lake"):
    """The silver table after runs over parts of the same readings."""
    prefix = f"l{uuid4().hex[:8]}_"
    lake = Lake(spark, f"{tmp_path}/{name}/landing", f"{tmp_path}/{name}/lake", prefix=prefix, sum_type="decimal(18,3)")
    readings = draw_readings(4)
    for i, (a, b) in enumerate(zip([0, *cuts], [*cuts, len(readings)])):
        put_climate(tmp_path / name, f"{i}.json", readings[a:b])
        lake.ingest("climate")
        assert lake.process("climate", at(i), across_runs)
        if compact and i == 1:
            assert lake.compact("climate")
    df = read_table(spark, lake.table("silver", "climate"))
    found = sorted((r.timestamp, r.station_id, r.temperature_C, r.wind_speed_mps) for r in df.na.fill(-1).collect())
    for s in spark.catalog.listDatabases(f"{prefix}*"):
        spark.sql(f"DROP SCHEMA {s.name} CASCADE")
    return found


def test_trailing_means_across_runs(spark, tmp_path):
    """Three runs fill like one if they see each other, and not if they do not."""
    one = climate_runs(spark, tmp_path, [], False, name="one")
    assert climate_runs(spark, tmp_path, [], True, name="one too") == one
    assert climate_runs(spark, tmp_path, [21, 40], True, name="three") == one
    assert climate_runs(spark, tmp_path, [11, 21, 40], True, compact=True, name="packed") == one
    assert climate_runs(spark, tmp_path, [21, 40], False, name="apart") != one


def put_stock(tmp_path, name, rows):
    folder = tmp_path / "landing" / "internal_system" / "inventory"
    folder.mkdir(parents=True, exist_ok=True)
    lines = ["timestamp,category,product,stock_quantity,sales_price,manufacturing_date,expiration_date"]
    lines += [f"2025-03-01 10:00:00,seeds,{p} corn,{'' if q is None else q},2.0,2025-01-01,2025-02-01" for p, q in rows]
    (folder / name).write_text("\n".join(lines) + "\n")


def test_means_by_key_across_runs(spark, lake, tmp_path, monkeypatch, rows):
    runs = [[("seed_1", 10), ("seed_2", None)], [("seed_1", 20), ("seed_2", 4), ("seed_1", None)], [("seed_1", None), ("seed_2", None)]]
    real, lost = lake_module.append_table, []

    def cut(df, table, *args, **kwargs):
        real(df, table, *args, **kwargs)
        if table.endswith("totals_product_id_stock_quantity_sales_price") and not lost:
            lost.append(table)
            raise OSError("driver lost")

    for i, stock in enumerate(runs):
        put_stock(tmp_path, f"{i}.csv", stock)
        lake.ingest("inventory")
        if i == 1:
            monkeypatch.setattr(lake_module, "append_table", cut)
            with pytest.raises(OSError):
                lake.process("inventory", at(i), across_runs=True)
        assert lake.process("inventory", at(i), across_runs=True)
    assert lost
    df = read_table(spark, lake.table("silver", "inventory"))
    # 10, 20 and no own filled values count for seed_1; the first gap of seed_2 had nothing yet.
    assert rows(df, "product_id", "stock_quantity") == sorted(
        [("SEED_1", 10.0), ("SEED_1", 20.0), ("SEED_1", 15.0), ("SEED_1", 15.0), ("SEED_2", None), ("SEED_2", 4.0), ("SEED_2", 4.0)],
        key=lambda r: [(x is not None, str(x)) for x in r],
    )
    totals = read_table(spark, lake.table("silver", "inventory_totals_product_id_stock_quantity_sales_price"))
    added = totals.groupBy("__key").agg(F.sum("__s0"), F.sum("__n0"))
    assert rows(added) == [("SEED_1", 30.0, 2), ("SEED_2", 4.0, 1)]


# --- gold by parts


def put_sales(tmp_path, name, n, start):
    folder = tmp_path / "landing" / "webpage" / "online_sales"
    folder.mkdir(parents=True, exist_ok=True)
    lines = ["order_id,sales_price,currency,payment_method,transaction_status,coord,city,address,category,product,timestamp"]
    for i in range(start, start + n):
        price = "" if i % 4 == 0 else i / 4
        lines.append(f'o{i},{price},EUR,card,done,"(40.5, -3.5)",Lugo,"Rua, 1",c{i % 3},seed_1 corn,2025-03-0{1 + i % 4} 10:00:00')
    (folder / name).write_text("\n".join(lines) + "\n")


def test_gold_by_parts_is_the_full_form(spark, tmp_path, monkeypatch, rows):
    prefix = f"l{uuid4().hex[:8]}_"
    lake = Lake(spark, f"{tmp_path}/landing", f"{tmp_path}/lake", prefix=prefix, sum_type="decimal(18,3)")
    real, read = lake_module.rows_of_runs, []
    monkeypatch.setattr(lake_module, "rows_of_runs", lambda *a: read.append(real(*a).count()) or real(*a))
    names = ("sales_volume", "climate_impact")
    for i in range(5):
        put_sales(tmp_path, f"{i}.csv", 10 + i, 20 * i)
        put_climate(tmp_path, f"{i}.json", draw_readings(i, 30))
        for dataset in ("online_sales", "climate"):
            lake.ingest(dataset)
            lake.process(dataset, at(i))
        if i in (1, 3):
            lake.compact("online_sales")
        if i != 2:
            for name in names:
                lake.aggregate(name, by_parts=True)
                found = rows(read_table(spark, lake.table("gold", name)))
                lake.aggregate(name)
                assert rows(read_table(spark, lake.table("gold", name))) == found and found
    # Every run was read once for each table, also those that were packed meanwhile.
    assert read[:1] == [10] and sum(read) == 2 * sum(range(10, 15)) + 5 * 30
    before = len(read)
    lake.aggregate("sales_volume", by_parts=True)
    assert len(read) == before
    with pytest.raises(ValueError, match="order_fulfillment"):
        lake.aggregate("order_fulfillment_performance", by_parts=True)
    for s in spark.catalog.listDatabases(f"{prefix}*"):
        spark.sql(f"DROP SCHEMA {s.name} CASCADE")
