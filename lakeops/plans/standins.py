"""Views on the TPC-H-like tables that look like the datasets of the lakehouse.

Every view covers its whole tables. Nulls and dirty text are derived from keys, so that
the same view can be written in SQL (`lakeops.plans.oracle`).
"""

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F


def read(spark: SparkSession, sf_dir: str, table: str) -> DataFrame:
    spark.conf.set("spark.sql.session.timeZone", "UTC")
    return spark.read.parquet(f"{sf_dir}/{table}.parquet")


def _null_where(condition: Column, value: Column) -> Column:
    return F.when(~condition, value)


def _every(n: int, *keys: str) -> Column:
    total = F.col(keys[0])
    for k in keys[1:]:
        total = total + F.col(k)
    return total % n == 0


def _sold_lines(spark: SparkSession, sf_dir: str, part: bool, city: bool) -> DataFrame:
    """Order lines with their order and, where asked for, part and nation of the customer."""
    lines = read(spark, sf_dir, "lineitem")
    orders = read(spark, sf_dir, "orders")
    df = lines.join(orders, lines.l_orderkey == orders.o_orderkey)
    if part:
        parts = read(spark, sf_dir, "part")
        df = df.join(parts, df.l_partkey == parts.p_partkey)
    if city:
        nations = read(spark, sf_dir, "nation")
        customers = read(spark, sf_dir, "customer")
        customers = customers.join(nations, customers.c_nationkey == nations.n_nationkey)
        df = df.join(customers, df.o_custkey == customers.c_custkey)
    return df


def sales(
    spark: SparkSession, sf_dir: str, category: bool = False, city: bool = False
) -> DataFrame:
    df = _sold_lines(spark, sf_dir, part=category, city=city)
    return df.select(
        F.col("l_orderkey").alias("order_id"),
        F.col("l_extendedprice").alias("sales_price"),
        F.col("o_orderdate").cast("timestamp").alias("timestamp"),
        _null_where(_every(4, "l_linenumber"), F.col("o_orderpriority")).alias("payment_method"),
        *([F.col("p_type").alias("category")] if category else []),
        *([F.col("n_name").alias("city")] if city else []),
    )


def product_text() -> Column:
    separator = (
        F.when(_every(3, "p_partkey"), " - ")
        .when(F.col("p_partkey") % 3 == 1, ", ")
        .otherwise("   ")
    )
    return F.concat(
        F.lit("brand_"), F.substring("p_brand", 7, 9), separator, "p_name", F.lit(" 20-10-10")
    )


def products(spark: SparkSession, sf_dir: str) -> DataFrame:
    return read(spark, sf_dir, "part").select("p_partkey", product_text().alias("product"))


def coord_text(key: str) -> Column:
    k = F.col(key)
    sign = F.when(_every(2, key), "").otherwise("-")
    return F.concat(
        F.lit("("), (36 + k % 7).cast("string"), F.lit(".25, "),
        sign, (k % 13).cast("string"), F.lit(".5)"),
    )


def address_text(key: str) -> Column:
    k = F.col(key)
    code = F.lpad((k % 52000 + 1000).cast("string"), 5, "0")
    return F.concat(
        F.lit("Calle Mayor, "),
        k.cast("string"),
        F.when(_every(4, key), "").otherwise(F.concat(F.lit(", "), code)),
    )


def raw_sales(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Online sales as they arrive: mixed case, texts not split, gaps."""
    df = _sold_lines(spark, sf_dir, part=True, city=True)
    return df.select(
        F.col("l_orderkey").cast("string").alias("order_id"),
        F.concat_ws("-", F.lit("t"), "l_orderkey", "l_linenumber").alias("transaction_id"),
        F.col("l_extendedprice").alias("sales_price"),
        _null_where(_every(3, "l_linenumber"), F.lit("USD")).alias("currency"),
        _null_where(_every(4, "l_linenumber"), F.lower("o_orderpriority")).alias("payment_method"),
        F.lower("o_orderstatus").alias("transaction_status"),
        coord_text("l_suppkey").alias("coord"),
        F.lower("n_name").alias("city"),
        address_text("o_custkey").alias("address"),
        F.lower("p_type").alias("category"),
        product_text().alias("product"),
        _null_where(_every(11, "l_orderkey"), F.col("o_orderdate").cast("timestamp")).alias(
            "timestamp"
        ),
    )


def raw_sales_of_events(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Events as online sales as they arrive."""
    number = F.col("event_id").cast("string")
    return read(spark, sf_dir, "events").select(
        number.alias("order_id"),
        F.concat(F.lit("t-"), number).alias("transaction_id"),
        F.col("user_id").cast("string").alias("user_id"),
        F.col("value").alias("sales_price"),
        _null_where(_every(3, "event_id"), F.lit("USD")).alias("currency"),
        _null_where(_every(4, "event_id"), F.lit("card")).alias("payment_method"),
        F.lit("completed").alias("transaction_status"),
        coord_text("event_id").alias("coord"),
        F.lit("city").alias("city"),
        address_text("event_id").alias("address"),
        F.col("event_type").alias("category"),
        F.concat(F.col("event_type"), F.lit("_"), "user_id", F.lit(" - Item")).alias("product"),
        _null_where(_every(11, "event_id"), F.col("ts").cast("timestamp")).alias("timestamp"),
    )


def raw_logistics(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Deliveries as they arrive: status in lower case, delivery date sometimes missing."""
    key, state = F.col("o_orderkey"), F.col("o_orderstatus")
    status = F.when(state == "F", "received").when(state == "O", "sent").otherwise("pending")
    scheduled = F.date_add(F.col("o_orderdate").cast("date"), (key % 3).cast("int"))
    late = F.when(key % 5 == 0, 1 + key % 4).otherwise(0).cast("int")
    actual = F.when((state == "F") & ~_every(11, "o_orderkey"), F.date_add(scheduled, late))
    return read(spark, sf_dir, "orders").select(
        key.alias("order_id"),
        _null_where(_every(13, "o_orderkey"), F.col("o_orderdate").cast("timestamp")).alias(
            "timestamp"
        ),
        F.array(36.25 + key % 7, -0.5 - key % 3).alias("coord"),
        F.col("o_orderdate").cast("date").alias("pickup_date"),
        scheduled.alias("scheduled_delivery_date"),
        status.alias("shipment_status"),
        actual.alias("actual_delivery_date"),
    )


def station_readings(spark: SparkSession, sf_dir: str, missing: Column | None = None) -> DataFrame:
    """Events as readings of a station; every tenth temperature is `missing`."""
    value = F.when(_every(10, "event_id"), missing if missing is not None else F.lit(None))
    return read(spark, sf_dir, "events").select(
        "event_id",
        F.col("user_id").alias("station_id"),
        F.col("ts").cast("timestamp").alias("timestamp"),
        value.otherwise(F.col("value")).alias("temperature_C"),
    )


def daily_readings(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Order lines as weather readings of their shipping day."""
    return read(spark, sf_dir, "lineitem").select(
        F.col("l_shipdate").cast("timestamp").alias("timestamp"),
        F.col("l_quantity").alias("temperature_C"),
        F.col("l_discount").alias("humidity_percent"),
    )


def raw_climate(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Climate as it arrives: epoch milliseconds as text, a coordinate array, gaps."""
    millis = F.floor(F.unix_micros(F.col("ts").cast("timestamp")) / 1000)
    value = F.col("value")
    return read(spark, sf_dir, "events").select(
        "event_id",
        F.col("user_id").alias("station_id"),
        _null_where(_every(97, "event_id"), millis.cast("string")).alias("timestamp"),
        F.array(40 + F.col("user_id") % 3, -3 - F.col("user_id") % 2).alias("coord"),
        _null_where(_every(10, "event_id"), value).alias("temperature_C"),
        _null_where(_every(7, "event_id"), value + 1).alias("humidity_percent"),
        _null_where(_every(5, "event_id"), value + 2).alias("precipitation_mm"),
        _null_where(_every(3, "event_id"), value + 3).alias("solar_radiation_Wm2"),
        _null_where(_every(2, "event_id"), value + 4).alias("wind_speed_mps"),
    )


def raw_iot(spark: SparkSession, sf_dir: str) -> DataFrame:
    nan, value = F.lit(float("nan")), F.col("value")
    return read(spark, sf_dir, "events").select(
        "event_id",
        F.col("user_id").cast("string").alias("key"),
        _null_where(_every(89, "event_id"), F.col("ts").cast("timestamp")).alias("timestamp"),
        F.when(_every(10, "event_id"), nan).otherwise(value).alias("soil_temperature"),
        F.when(_every(3, "event_id"), nan).otherwise(value + 1).alias("soil_humidity"),
        F.when(_every(2, "event_id"), nan).otherwise(value + 2).alias("soil_quality"),
    )


def raw_inventory(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Order lines as stock of a product; some products have no text, some no id in it."""
    shipped = F.col("l_shipdate").cast("date")
    text = F.when(_every(51, "l_partkey"), F.lit("no id here")).otherwise(
        F.concat(F.lit("p_"), F.col("l_partkey").cast("string"), F.lit(" - Part, 20-10-10"))
    )
    return read(spark, sf_dir, "lineitem").select(
        "l_orderkey",
        "l_linenumber",
        _null_where(_every(17, "l_orderkey"), F.col("l_shipdate").cast("timestamp")).alias(
            "timestamp"
        ),
        F.lower("l_returnflag").alias("category"),
        _null_where(_every(50, "l_partkey"), text).alias("product"),
        _null_where(_every(7, "l_orderkey", "l_linenumber"), F.col("l_quantity")).alias(
            "stock_quantity"
        ),
        _null_where(_every(9, "l_orderkey", "l_linenumber"), F.col("l_extendedprice")).alias(
            "sales_price"
        ),
        shipped.alias("manufacturing_date"),
        _null_where(_every(5, "l_orderkey"), F.date_add(shipped, 30)).alias("expiration_date"),
    )
