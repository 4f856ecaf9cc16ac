"""The operators as queries over the given tables."""

import datetime as dt
from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from lakeops.functions import decode, geo, text, time
from lakeops.operators import impute, metrics, moving, sinks
from lakeops.plans import standins as v
from lakeops.plans.datasets import SILVER, clean_online_sales
from lakeops.plans.lake import Lake
from lakeops.session import work_folder
from lakeops.sources import files, tables
from lakeops.streaming.ingest import drain

# Prices and readings of the given tables have two decimals.
EXACT = "decimal(18,2)"
# Null event times become this time, so that results do not depend on the clock.
RUN_TIME = dt.datetime(2030, 1, 1, tzinfo=dt.timezone.utc)


def _plain_times(df: DataFrame) -> DataFrame:
    """Timestamps without zone, as the given tables have them."""
    times = [c for c, t in df.dtypes if t == "timestamp"]
    return df.withColumns({c: F.col(c).cast("timestamp_ntz") for c in times})


# --- gold


def sales_volume(spark: SparkSession, sf_dir: str) -> DataFrame:
    return metrics.sales_volume(v.sales(spark, sf_dir, category=True), EXACT)


def order_fulfillment_performance(spark: SparkSession, sf_dir: str) -> DataFrame:
    return metrics.order_fulfillment_performance(
        v.sales(spark, sf_dir, category=True, city=True), v.raw_logistics(spark, sf_dir)
    )


def climate_impact(spark: SparkSession, sf_dir: str) -> DataFrame:
    return metrics.climate_impact(v.sales(spark, sf_dir), v.daily_readings(spark, sf_dir), EXACT)


def climate_impact_as_coded(spark: SparkSession, sf_dir: str) -> DataFrame:
    return metrics.climate_impact(
        v.sales(spark, sf_dir), v.daily_readings(spark, sf_dir), EXACT, per_reading=True
    )


def delivery_delay(spark: SparkSession, sf_dir: str) -> DataFrame:
    df = metrics.with_delivery_delay(v.raw_logistics(spark, sf_dir))
    return df.select("order_id", "delivery_delay_days", "on_time_delivery")


# --- means and imputation


def moving_average(spark: SparkSession, sf_dir: str) -> DataFrame:
    df = moving.moving_average(
        v.station_readings(spark, sf_dir), "temperature_C", 72, "station_id", sum_type=EXACT
    )
    return df.select("event_id", "station_id", "mean_last_72h")


def impute_window_null(spark: SparkSession, sf_dir: str) -> DataFrame:
    df = impute.impute_window(
        v.station_readings(spark, sf_dir), ["temperature_C"], 72, "station_id", sum_type=EXACT
    )
    return df.select("event_id", "station_id", "temperature_C")


def impute_window_nan(spark: SparkSession, sf_dir: str) -> DataFrame:
    readings = v.station_readings(spark, sf_dir, missing=F.lit(float("nan")))
    df = impute.impute_window(
        readings, ["temperature_C"], 72, "station_id", nan=True, sum_type=EXACT
    )
    return df.select("event_id", "station_id", "temperature_C")


def _inventory_by_product(spark: SparkSession, sf_dir: str) -> DataFrame:
    return text.split_product(v.raw_inventory(spark, sf_dir))


def impute_mean_by_key(spark: SparkSession, sf_dir: str) -> DataFrame:
    fields = ["stock_quantity", "sales_price"]
    df = impute.impute_key_mean(
        _inventory_by_product(spark, sf_dir), fields, "product_id", sum_type=EXACT
    )
    return df.select("l_orderkey", "l_linenumber", "product_id", *fields)


def mean_by_key(spark: SparkSession, sf_dir: str) -> DataFrame:
    df = _inventory_by_product(spark, sf_dir)
    means = impute.key_means(df, ["stock_quantity"], "product_id", EXACT)
    return means.toDF("product_id", "stock_quantity_mean")


def impute_date_offset(spark: SparkSession, sf_dir: str) -> DataFrame:
    df = v.raw_inventory(spark, sf_dir)
    df = impute.impute_date_offset(df, "expiration_date", "manufacturing_date", 40)
    return df.select("l_orderkey", "l_linenumber", "expiration_date")


def impute_literal(spark: SparkSession, sf_dir: str) -> DataFrame:
    df = impute.impute_literal(v.sales(spark, sf_dir), "payment_method", "CREDIT_CARD")
    return df.select("order_id", "sales_price", "payment_method")


def impute_from_column(spark: SparkSession, sf_dir: str) -> DataFrame:
    df = text.uppercase(v.raw_logistics(spark, sf_dir), ["shipment_status"])
    df = impute.impute_from_column(
        df, "actual_delivery_date", "scheduled_delivery_date", "shipment_status", "RECEIVED"
    )
    return df.select("order_id", "shipment_status", "actual_delivery_date")


# --- cleaning


def default_timestamp(spark: SparkSession, sf_dir: str) -> DataFrame:
    df = v.raw_iot(spark, sf_dir).select("event_id", "timestamp")
    return _plain_times(time.default_timestamp(df, "timestamp", F.lit(RUN_TIME)))


def partition_columns(spark: SparkSession, sf_dir: str) -> DataFrame:
    return time.partition_columns(v.read(spark, sf_dir, "events").select("event_id", "ts"), "ts")


def uppercase(spark: SparkSession, sf_dir: str) -> DataFrame:
    parts = v.read(spark, sf_dir, "part")
    df = parts.select("p_partkey", "p_name", F.lower("p_type").alias("p_type"))
    return text.uppercase(df, ["p_name", "p_type"])


def split_product(spark: SparkSession, sf_dir: str) -> DataFrame:
    return text.split_product(v.products(spark, sf_dir))


def _supplier_coords(spark: SparkSession, sf_dir: str) -> DataFrame:
    suppliers = v.read(spark, sf_dir, "supplier")
    return suppliers.select("s_suppkey", v.coord_text("s_suppkey").alias("coord"))


def split_coord_string(spark: SparkSession, sf_dir: str) -> DataFrame:
    return geo.split_coord_text(_supplier_coords(spark, sf_dir))


def split_coord_string_as_coded(spark: SparkSession, sf_dir: str) -> DataFrame:
    return geo.split_coord_text(_supplier_coords(spark, sf_dir), pattern=geo.UNSIGNED_PAIR)


def split_coord_array(spark: SparkSession, sf_dir: str) -> DataFrame:
    df = v.raw_climate(spark, sf_dir).select("event_id", "coord")
    return geo.split_coord_array(df)


def split_coord_array_uncast(spark: SparkSession, sf_dir: str) -> DataFrame:
    df = v.raw_climate(spark, sf_dir).select("event_id", "coord")
    return geo.split_coord_array(df, cast=None)


def split_address(spark: SparkSession, sf_dir: str) -> DataFrame:
    customers = v.read(spark, sf_dir, "customer")
    df = customers.select("c_custkey", v.address_text("c_custkey").alias("address"))
    return text.split_address(df)


def epoch_millis(spark: SparkSession, sf_dir: str) -> DataFrame:
    df = v.raw_climate(spark, sf_dir)
    return _plain_times(
        df.select("event_id", time.epoch_millis(F.col("timestamp")).alias("event_time"))
    )


# --- decoding and rescue


def _kafka_records(spark: SparkSession, sf_dir: str, value: Column) -> DataFrame:
    """Events in the shape of the Kafka source."""
    return v.read(spark, sf_dir, "events").select(
        F.col("user_id").cast("string").cast("binary").alias("key"),
        value.alias("value"),
        F.lit("events").alias("topic"),
        F.lit(0).alias("partition"),
        F.col("event_id").alias("offset"),
        F.col("ts").cast("timestamp").alias("timestamp"),
        F.lit(0).alias("timestampType"),
    )


def decode_json_value(spark: SparkSession, sf_dir: str) -> DataFrame:
    records = _kafka_records(spark, sf_dir, F.col("props").cast("binary"))
    df = decode.decode_value(records, "json", ddl="k int, missing string")
    return _plain_times(df.drop("_ingestion_time"))


def strip_frame(spark: SparkSession, sf_dir: str) -> DataFrame:
    framed = F.concat(F.unhex(F.lit("0000000001")), F.col("event_type").cast("binary"))
    df = v.read(spark, sf_dir, "events").select("event_id", framed.alias("value"))
    return df.select("event_id", F.hex(decode.strip_frame(F.col("value"))).alias("payload"))


def _event_json() -> Column:
    """The properties of an event, with a value that is no number or a field that is new."""
    number = F.get_json_object("props", "$.k")
    return (
        F.when(F.col("event_id") % 3 == 0, F.col("props"))
        .when(F.col("event_id") % 3 == 1, F.concat(F.lit('{"k": "x'), number, F.lit('"}')))
        .otherwise(
            F.concat(
                F.lit('{"k": '), number, F.lit(', "new": "'), F.col("event_type"), F.lit('"}')
            )
        )
    )


def rescue_json(spark: SparkSession, sf_dir: str) -> DataFrame:
    df = v.read(spark, sf_dir, "events").select("event_id", _event_json().alias("value"))
    return files.rescue_json(df, T.StructType.fromDDL("k int"))


def rescue_texts(spark: SparkSession, sf_dir: str) -> DataFrame:
    key = F.col("o_orderkey")
    df = v.read(spark, sf_dir, "orders").select(
        key.cast("string").alias("order_id"),
        F.when(key % 4 == 0, F.lit("unknown"))
        .otherwise(F.date_format("o_orderdate", "yyyy-MM-dd"))
        .alias("order_date"),
        F.when(key % 5 == 0, F.col("o_orderpriority")).alias("remark"),
    )
    return files.rescue_texts(df, T.StructType.fromDDL("order_id bigint, order_date date"))


# --- tables


def _bronze_events(spark: SparkSession, sf_dir: str) -> DataFrame:
    return v.read(spark, sf_dir, "events").select(
        "event_id", "event_type", F.col("ts").cast("timestamp").alias("_ingestion_time")
    )


def incremental_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    low = F.lit("2024-01-10 00:00:00").cast("timestamp")
    high = F.lit("2024-01-20 12:00:00").cast("timestamp")
    rows = _bronze_events(spark, sf_dir).filter(tables.ingested_between(low, high))
    return _plain_times(rows)


def high_mark(spark: SparkSession, sf_dir: str) -> DataFrame:
    low = F.lit("2024-01-10 00:00:00").cast("timestamp")
    return _plain_times(tables.high_mark(_bronze_events(spark, sf_dir), low))


def partitioned_append(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Events appended to a table by day, then three weeks of it by partition."""
    lake = _new_lake(spark, "partitioned")
    sinks.create_schema(spark, f"{lake.prefix}silver", f"{lake.root}/silver")
    events = time.partition_columns(v.read(spark, sf_dir, "events"), "ts")
    sinks.append_table(events, lake.table("silver", "events"), f"{lake.root}/silver/events", "run")
    days = tables.date_range(_kept(lake, "silver", "events"), dt.date(2024, 1, 3), dt.date(2024, 1, 23))
    return days.select("event_id", "event_type", "value", "year", "month", "day")


def widened_append(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Events appended in two runs, the second one twice and with a column more."""
    lake = _new_lake(spark, "widened")
    sinks.create_schema(spark, f"{lake.prefix}silver", f"{lake.root}/silver")
    events = time.partition_columns(v.read(spark, sf_dir, "events"), "ts")
    first = events.filter("event_id % 2 = 0").select("event_id", "value", "year", "month", "day")
    second = events.filter("event_id % 2 = 1").select(
        "year", "month", "day", "event_type", "value", "event_id"
    )
    for run, rows in (("r1", first), ("r2", second), ("r2", second)):
        sinks.append_table(rows, lake.table("silver", "events"), f"{lake.root}/silver/events", run)
    return _kept(lake, "silver", "events").select(
        "event_id", "event_type", "value", "year", "month", "day"
    )


# --- streams and whole jobs


def _new_lake(spark: SparkSession, name: str) -> Lake:
    folder = work_folder(spark, name)
    prefix = f"lake_{folder.rsplit('-', 1)[1]}_"
    return Lake(spark, f"{folder}/landing", f"{folder}/lakehouse", prefix=prefix, sum_type=EXACT)


def _kept(lake: Lake, layer: str, name: str) -> DataFrame:
    """A table's files, without the catalog entries of its lake."""
    spark, name = lake.spark, lake.table(layer, name)
    schema, runs = tables.read_table(spark, name).schema, f"{name}_runs"
    is_view = spark.catalog.tableExists(runs)
    about = spark.sql(f"DESCRIBE TABLE EXTENDED {runs if is_view else name}")
    location = about.filter("col_name = 'Location'").first().data_type
    df = spark.read.schema(schema).parquet(location)
    if is_view:
        df = df.filter(sinks.read_layout(spark, name).shown)
    for schema in spark.catalog.listDatabases(f"{lake.prefix}*"):
        # With a schema goes its folder, so it gets an empty one first.
        spark.sql(f"ALTER SCHEMA {schema.name} SET LOCATION '{lake.root}/dropped/{schema.name}'")
        spark.sql(f"DROP SCHEMA {schema.name} CASCADE")
    return df


def _ingested(
    spark: SparkSession,
    rows: DataFrame,
    fmt: str,
    hints: str,
    others: DataFrame | None = None,
    **options: str,
):
    """Write rows as landing files and ingest them twice; the second time adds nothing."""
    folder = work_folder(spark, f"ingest-{fmt}")
    landing, bronze = f"{folder}/landing", f"{folder}/bronze"
    rows.write.format(fmt).options(**options).save(landing)
    if others is not None:
        others.write.format(fmt).options(**options).save(f"{landing}/others")

    def write(rows: DataFrame, batch: int) -> None:
        rows.write.mode("overwrite").parquet(f"{bronze}/batch={batch}")

    for _ in range(2):
        files.drain_files(
            spark, landing, fmt, f"{folder}/schema", f"{folder}/checkpoint", write, folder, options, hints
        )
    df = spark.read.parquet(bronze).drop("batch")
    return _plain_times(
        df.withColumns(
            {
                "_ingested_filename": F.col("_ingested_filename").contains("/landing/"),
                "_ingestion_time": F.col("_ingestion_time").isNotNull(),
            }
        )
    )


def ingest_csv(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = v.read(spark, sf_dir, "orders").withColumn("o_orderdate", F.to_date("o_orderdate"))
    return _ingested(
        spark, rows, "csv", "o_totalprice double, o_orderdate date, o_orderkey bigint, "
        "o_custkey bigint", header="true", sep=","
    )


def ingest_json(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = v.read(spark, sf_dir, "events").select(
        "event_id", F.col("ts").cast("string").alias("ts"), "user_id", "event_type", "value"
    )
    return _ingested(spark, rows, "json", "ts timestamp")


def ingest_parquet(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = v.read(spark, sf_dir, "lineitem")
    return _ingested(spark, rows, "parquet", "l_shipdate date")


def ingest_parquet_types(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Files of two types for a column, the second with texts that are no numbers."""
    rows = v.read(spark, sf_dir, "lineitem").select("l_orderkey", "l_linenumber", "l_returnflag")
    number = F.col("l_linenumber").cast("string")
    text = F.when(F.col("l_linenumber") == 1, F.concat(F.lit("line "), number)).otherwise(number)
    odd = F.col("l_orderkey") % 5 == 0
    others = rows.filter(odd).withColumn("l_linenumber", text)
    return _ingested(spark, rows.filter(~odd), "parquet", "l_linenumber int", others)


def ingest_binary_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Pages as files of text; the bytes that arrive in bronze."""
    folder = work_folder(spark, "ingest-binary")
    pages = v.read(spark, sf_dir, "pages").select("html")
    pages.write.option("maxRecordsPerFile", 100).text(f"{folder}/landing")
    for _ in range(2):
        stream = files.read_file_stream(
            spark, f"{folder}/landing", "binaryFile", "", {"pathGlobFilter": "*.txt"}
        )
        drain(stream, f"{folder}/bronze", f"{folder}/checkpoint", folder)
    return spark.read.parquet(f"{folder}/bronze").agg(
        F.sum("length").alias("total_bytes"),
        F.sum(F.length("content")).alias("content_bytes"),
    )


def _silver(spark: SparkSession, name: str, raw: DataFrame) -> DataFrame:
    """The silver step of a dataset as a query, without its tables."""
    spec = SILVER[name]
    return _plain_times(impute.impute(spec.clean(raw, F.lit(RUN_TIME)), spec.rules, sum_type=EXACT))


def silver_climate(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _silver(spark, "climate", v.raw_climate(spark, sf_dir))


def silver_inventory(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _silver(spark, "inventory", v.raw_inventory(spark, sf_dir))


def silver_iot_sensors(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _silver(spark, "iot_sensors", v.raw_iot(spark, sf_dir))


def silver_logistics(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _silver(spark, "logistics", v.raw_logistics(spark, sf_dir))


def silver_online_sales(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _silver(spark, "online_sales", v.raw_sales(spark, sf_dir))


def bronze_to_gold_sales(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Raw sales cleaned and imputed, then their volume per category and day."""
    spec = SILVER["online_sales"]
    cleaned = clean_online_sales(v.raw_sales(spark, sf_dir), F.lit(RUN_TIME))
    silver = impute.impute(cleaned, spec.rules)
    return metrics.sales_volume(silver, EXACT)


def lakehouse_sales_volume(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Sales as CSV files through all three layers and their tables."""
    lake = _new_lake(spark, "sales")
    raw = v.raw_sales_of_events(spark, sf_dir)
    raw.write.option("header", True).csv(f"{lake.landing}/webpage/online_sales")
    lake.ingest("online_sales")
    lake.process("online_sales", RUN_TIME)
    lake.aggregate("sales_volume")
    return _kept(lake, "gold", "sales_volume")


def lakehouse_two_runs(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The same in two runs, with files that came between them in folders of the folder."""
    lake = _new_lake(spark, "runs")
    raw = v.raw_sales_of_events(spark, sf_dir)
    number = F.col("order_id").cast("bigint")
    for rest, folder in ((0, "a"), (1, "b/deep")):
        part = raw.filter(number % 2 == rest).write.option("header", True)
        part.csv(f"{lake.landing}/webpage/online_sales/{folder}")
        for _ in range(2):
            lake.ingest("online_sales")
            lake.process("online_sales", RUN_TIME)
    lake.aggregate("sales_volume")
    return _kept(lake, "gold", "sales_volume")


def _through_tables(spark: SparkSession, name: str, raw: DataFrame, plain: DataFrame, fmt: str, **options):
    """The silver table of a dataset, with the columns and types of the silver step alone."""
    lake = _new_lake(spark, name)
    writer = raw.write.format(fmt).options(**options)
    writer.save(f"{lake.landing}/{SILVER[name].datasource}/{name}")
    lake.ingest(name)
    lake.process(name, RUN_TIME)
    df = _kept(lake, "silver", name)
    return df.select(*[F.col(f.name).cast(f.dataType) for f in plain.schema])


def lakehouse_climate(spark: SparkSession, sf_dir: str) -> DataFrame:
    raw = v.raw_climate(spark, sf_dir)
    return _through_tables(spark, "climate", raw, silver_climate(spark, sf_dir), "json")


def lakehouse_logistics(spark: SparkSession, sf_dir: str) -> DataFrame:
    raw = v.raw_logistics(spark, sf_dir)
    return _through_tables(spark, "logistics", raw, silver_logistics(spark, sf_dir), "parquet")


def lakehouse_inventory(spark: SparkSession, sf_dir: str) -> DataFrame:
    raw = v.raw_inventory(spark, sf_dir)
    plain = silver_inventory(spark, sf_dir)
    return _through_tables(spark, "inventory", raw, plain, "csv", header="true")


def lakehouse_fulfillment(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Sales and deliveries through their silver tables to gold; every event is an order."""
    lake = _new_lake(spark, "fulfillment")
    raw = v.raw_sales_of_events(spark, sf_dir)
    raw.write.option("header", True).csv(f"{lake.landing}/webpage/online_sales")
    deliveries = v.raw_logistics(spark, sf_dir)
    deliveries.write.parquet(f"{lake.landing}/internal_system/logistics")
    for name in ("online_sales", "logistics"):
        lake.ingest(name)
        lake.process(name, RUN_TIME)
    lake.aggregate("order_fulfillment_performance")
    return _kept(lake, "gold", "order_fulfillment_performance")


def lakehouse_client_data(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Events as records of the topic, decoded into bronze."""
    lake = _new_lake(spark, "clients")
    ts = F.col("ts").cast("timestamp")
    value = F.struct(
        ts.alias("timestamp"),
        F.concat(F.lit("user "), "user_id").alias("full_name"),
        (F.col("user_id") % 80).alias("age"),
        F.array("event_type", F.lit("x")).alias("wishlist_items"),
        F.col("value").alias("engagement_score"),
    )
    bad = F.col("event_id") % 10 == 0
    records = v.read(spark, sf_dir, "events").select(
        F.col("user_id").cast("string").cast("binary").alias("key"),
        F.when(bad, "junk").otherwise(F.to_json(value)).cast("binary").alias("value"),
        F.lit("topic_client_data").alias("topic"),
        F.lit(0).alias("partition"),
        F.col("event_id").alias("offset"),
        ts.alias("timestamp"),
        F.lit(0).alias("timestampType"),
    )
    records.write.parquet(f"{lake.landing}/topic")
    stream = spark.readStream.schema(records.schema).parquet(f"{lake.landing}/topic")
    lake.ingest("client_data", records=stream)
    df = _kept(lake, "bronze", "client_data")
    columns = ["_offset", "key", "full_name", "age", "engagement_score", "timestamp"]
    items = F.array_join("wishlist_items", ",").alias("items")
    return _plain_times(df.select(*columns, items))


def _iot_lake(spark: SparkSession, sf_dir: str) -> Lake:
    """Sensor readings as framed records of one schema, with some of another one and without a
    frame between them, ingested twice."""
    lake = _new_lake(spark, "sensors")
    raw = v.raw_iot(spark, sf_dir)
    fields = [f.name for f in raw.schema if f.name != "key"]
    values = [F.col(c).cast("string").alias(c) if c == "timestamp" else F.col(c) for c in fields]
    kind = F.col("event_id") % 10
    foreign = F.concat(F.unhex(F.lit("0000000109")), F.col("key").cast("binary"))
    value = (
        F.when(F.col("copy") == 0, F.concat(F.unhex(F.lit("0000000007")), F.to_json(F.struct(*values)).cast("binary")))
        .when(kind == 0, foreign)
        .otherwise(F.col("key").cast("binary"))
    )
    copies = F.explode(F.when(kind < 2, F.array(F.lit(0), F.lit(1))).otherwise(F.array(F.lit(0))))
    records = raw.withColumn("copy", copies).select(
        F.col("key").cast("binary").alias("key"),
        value.alias("value"),
        F.lit("topic_iot_sensors").alias("topic"),
        F.lit(0).alias("partition"),
        F.col("event_id").alias("offset"),
        F.lit(RUN_TIME).alias("timestamp"),
        F.lit(0).alias("timestampType"),
    )
    records.write.parquet(f"{lake.landing}/topic")
    ddl = "event_id bigint, timestamp timestamp, soil_temperature double, soil_humidity double, soil_quality double"
    for _ in range(2):
        stream = spark.readStream.schema(records.schema).parquet(f"{lake.landing}/topic")
        payload = decode.framed_json_payload(ddl)
        lake.ingest("iot_sensors", schema_id=7, payload=payload, records=stream)
    return lake


def lakehouse_iot_sensors(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The silver table of records of several schemas, of which one is decoded."""
    lake = _iot_lake(spark, sf_dir)
    lake.process("iot_sensors", RUN_TIME)
    plain = silver_iot_sensors(spark, sf_dir).schema
    return _kept(lake, "silver", "iot_sensors").select(*[F.col(f.name).cast(f.dataType) for f in plain])


def ingest_rejects(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The records of the other schemas, as they came."""
    rejects = _kept(_iot_lake(spark, sf_dir), "bronze", "iot_sensors_rejects")
    return rejects.select("_offset", "_schema_id", F.hex("_value").alias("value"))


def lakehouse_packed_runs(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Sales in five runs, packed after the third and after the fifth, to gold."""
    lake = _new_lake(spark, "packed")
    raw = v.raw_sales_of_events(spark, sf_dir)
    for run in range(5):
        part = raw.filter(F.col("order_id").cast("bigint") % 5 == run).write.option("header", True)
        part.csv(f"{lake.landing}/webpage/online_sales/{run}")
        lake.ingest("online_sales")
        lake.process("online_sales", RUN_TIME)
        if run in (2, 4):
            lake.compact("online_sales")
    lake.aggregate("sales_volume")
    return _kept(lake, "gold", "sales_volume")


def lakehouse_climate_impact(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Sales and climate through their silver tables to gold."""
    lake = _new_lake(spark, "impact")
    sales = v.raw_sales_of_events(spark, sf_dir)
    sales.write.option("header", True).csv(f"{lake.landing}/webpage/online_sales")
    v.raw_climate(spark, sf_dir).write.json(f"{lake.landing}/meteorologic_center/climate")
    for name in ("online_sales", "climate"):
        lake.ingest(name)
        lake.process(name, RUN_TIME)
    lake.aggregate("climate_impact")
    return _kept(lake, "gold", "climate_impact")


def lakehouse_images(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Pages as files, as the images arrive, into bronze."""
    lake = _new_lake(spark, "images")
    pages = v.read(spark, sf_dir, "pages").select("html")
    pages.write.option("maxRecordsPerFile", 100).text(f"{lake.landing}/internal_system/products_images")
    for _ in range(2):
        lake.ingest("products_images", options={"pathGlobFilter": "*.txt"})
    return _kept(lake, "bronze", "products_images").agg(
        F.sum("length").alias("total_bytes"), F.sum(F.length("content")).alias("content_bytes")
    )


def split_by_schema(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Framed events of two schemas and without a frame: those to decode, and the rejects."""
    number = F.col("event_id") % 3
    frame = F.when(number == 0, "0000000007").when(number == 1, "0000000107").otherwise("")
    value = F.concat(F.unhex(frame), F.encode("event_type", "UTF-8"))
    events = v.read(spark, sf_dir, "events").select("event_id", value.alias("value"))
    known, others = decode.split_by_schema(events, 7)
    return known.select(
        "event_id", F.lit(False).alias("rejected"), F.hex(decode.strip_frame(F.col("value"))).alias("payload")
    ).unionAll(others.select("event_id", F.lit(True), F.hex("value")))


def ingest_misfits(spark: SparkSession, sf_dir: str) -> DataFrame:
    """JSON lines with nested fields that do not fit, or are not known, through the stream."""
    folder = work_folder(spark, "misfits")
    number = F.col("event_id").cast("string")
    events = v.read(spark, sf_dir, "events")
    rest = F.col("event_id") % 4
    line = (
        F.when(rest == 0, F.concat(F.lit('{"id":'), number, F.lit(',"s":{"a":'), number, F.lit("}}")))
        .when(rest == 1, F.concat(F.lit('{"id":'), number, F.lit(',"s":{"a":"x"}}')))
        .when(rest == 2, F.concat(F.lit('{"id":'), number, F.lit(',"l":[{"a":1,"z":'), number, F.lit("}]}")))
        .otherwise(F.concat(F.lit('{"id":"x'), number, F.lit('"}')))
    )
    events.select(line.alias("value")).write.text(f"{folder}/landing/deep/er")
    hints = "id bigint, s struct<a:bigint>, l array<struct<a:bigint>>"
    for _ in range(2):
        stream = files.read_file_stream(spark, f"{folder}/landing", "json", f"{folder}/schema", {}, hints)
        drain(stream, f"{folder}/bronze", f"{folder}/checkpoint", folder)
    return spark.read.parquet(f"{folder}/bronze").select(
        "id", F.col("s.a").alias("a"), F.get("l", F.lit(0))["a"].alias("first"), "_rescued_data"
    )


def ingest_binary_content(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Pages as files of text, in folders of the folder; a digest of every line in bronze."""
    folder = work_folder(spark, "content")
    pages = v.read(spark, sf_dir, "pages").select("html")
    pages.write.option("maxRecordsPerFile", 100).text(f"{folder}/landing/deep")
    stream = files.read_file_stream(
        spark, f"{folder}/landing", "binaryFile", "", {"pathGlobFilter": "*.txt"}
    )
    drain(stream, f"{folder}/bronze", f"{folder}/checkpoint", folder)
    text = F.decode("content", "UTF-8")
    lines = F.split(F.substring(text, F.lit(1), F.length(text) - 1), "\n")
    return spark.read.parquet(f"{folder}/bronze").select(F.explode(lines).alias("line")).select(
        F.md5(F.col("line").cast("binary")).alias("line_md5")
    )


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    f.__name__: f
    for f in (
        sales_volume,
        order_fulfillment_performance,
        climate_impact,
        climate_impact_as_coded,
        delivery_delay,
        moving_average,
        impute_window_null,
        impute_window_nan,
        impute_mean_by_key,
        mean_by_key,
        impute_date_offset,
        impute_literal,
        impute_from_column,
        default_timestamp,
        partition_columns,
        uppercase,
        split_product,
        split_coord_string,
        split_coord_string_as_coded,
        split_coord_array,
        split_coord_array_uncast,
        split_address,
        epoch_millis,
        decode_json_value,
        strip_frame,
        rescue_json,
        rescue_texts,
        incremental_scan,
        high_mark,
        partitioned_append,
        ingest_csv,
        ingest_json,
        ingest_parquet,
        ingest_parquet_types,
        ingest_binary_files,
        silver_climate,
        silver_inventory,
        silver_iot_sensors,
        silver_logistics,
        silver_online_sales,
        bronze_to_gold_sales,
        lakehouse_sales_volume,
        lakehouse_two_runs,
        lakehouse_climate,
        lakehouse_logistics,
        lakehouse_inventory,
        lakehouse_fulfillment,
        lakehouse_client_data,
        lakehouse_iot_sensors,
        lakehouse_packed_runs,
        lakehouse_climate_impact,
        lakehouse_images,
        ingest_rejects,
        split_by_schema,
        ingest_misfits,
        ingest_binary_content,
        widened_append,
    )
}
