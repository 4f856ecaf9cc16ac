"""What is done to every dataset, layer by layer."""

from collections.abc import Callable, Mapping, Sequence
from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from lakeops.functions.geo import SIGNED_PAIR, split_coord_array, split_coord_text
from lakeops.functions.text import split_address, split_product, uppercase
from lakeops.functions.time import default_timestamp, epoch_millis, partition_columns
from lakeops.operators import metrics
from lakeops.operators.impute import (
    DateOffset,
    FromColumn,
    KeyMean,
    Literal,
    Rule,
    WindowMean,
)


@dataclass(frozen=True)
class FileSource:
    datasource: str
    fmt: str
    options: Mapping[str, str] = field(default_factory=dict)
    hints: str | None = None


@dataclass(frozen=True)
class KafkaSource:
    datasource: str
    topic: str
    value_format: str
    ddl: str | None = None


@dataclass(frozen=True)
class Silver:
    datasource: str
    clean: Callable[[DataFrame, Column], DataFrame]
    rules: Sequence[Rule]


@dataclass(frozen=True)
class Gold:
    """`parts` of each input, if there are any, are what runs add to the whole that `merge` makes."""

    inputs: Sequence[str]
    aggregate: Callable[..., DataFrame]
    sums: bool = True
    parts: Sequence[Callable[..., DataFrame]] = ()
    merge: Callable[..., DataFrame] | None = None


CSV = {"header": "true", "sep": ","}

# Datasets, formats, topics, columns and rules as the data producers and
# the business agreed on them.
BRONZE: dict[str, FileSource | KafkaSource] = {
    "climate": FileSource(
        "meteorologic_center",
        "json",
        hints="temperature_C double, precipitation_mm double, humidity_percent double, "
        "solar_radiation_Wm2 double, wind_speed_mps double, timestamp string",
    ),
    "products_images": FileSource("internal_system", "binaryFile"),
    "inventory": FileSource(
        "internal_system",
        "csv",
        CSV,
        "stock_quantity double, purchase_price double, sales_price double, "
        "timestamp timestamp, manufacturing_date date, expiration_date date",
    ),
    "logistics": FileSource(
        "internal_system",
        "parquet",
        hints="timestamp timestamp, pickup_date date, scheduled_delivery_date date, "
        "actual_delivery_date date",
    ),
    "online_sales": FileSource(
        "webpage", "csv", CSV, "sales_price double, timestamp timestamp"
    ),
    "client_data": KafkaSource(
        "applications",
        "topic_client_data",
        "json",
        "timestamp timestamp, full_name string, email string, age int, clicked_ads int, "
        "wishlist_items array<string>, engagement_score double",
    ),
    "iot_sensors": KafkaSource("telemetry", "topic_iot_sensors", "avro"),
}

CLIMATE_FIELDS = (
    "temperature_C",
    "humidity_percent",
    "precipitation_mm",
    "solar_radiation_Wm2",
    "wind_speed_mps",
)
IOT_FIELDS = ("soil_temperature", "soil_humidity", "soil_quality")
SALES_UPPER = (
    "payment_method",
    "transaction_status",
    "city",
    "category",
    "address",
    "product_id",
    "product_name",
)


def clean_climate(df: DataFrame, run_ts: Column) -> DataFrame:
    df = df.withColumn("timestamp", epoch_millis(F.col("timestamp")))
    return split_coord_array(partition_columns(df))


def clean_inventory(df: DataFrame, run_ts: Column) -> DataFrame:
    df = partition_columns(default_timestamp(df, "timestamp", run_ts))
    return uppercase(split_product(df), ["category"])


def clean_iot_sensors(df: DataFrame, run_ts: Column) -> DataFrame:
    return partition_columns(default_timestamp(df, "timestamp", run_ts))


def clean_logistics(df: DataFrame, run_ts: Column) -> DataFrame:
    df = partition_columns(default_timestamp(df, "timestamp", run_ts))
    return uppercase(split_coord_array(df, cast=None), ["shipment_status"])


def clean_online_sales(
    df: DataFrame, run_ts: Column, coord_pattern: str = SIGNED_PAIR
) -> DataFrame:
    df = partition_columns(default_timestamp(df, "timestamp", run_ts))
    df = split_product(split_address(split_coord_text(df, pattern=coord_pattern)))
    return uppercase(df, SALES_UPPER)


SILVER: dict[str, Silver] = {
    "climate": Silver(
        "meteorologic_center",
        clean_climate,
        [WindowMean(f, 3, "station_id") for f in CLIMATE_FIELDS],
    ),
    "inventory": Silver(
        "internal_system",
        clean_inventory,
        [
            KeyMean("stock_quantity", "product_id"),
            DateOffset("expiration_date", "manufacturing_date", 40),
            KeyMean("sales_price", "product_id"),
        ],
    ),
    "iot_sensors": Silver(
        "telemetry",
        clean_iot_sensors,
        [WindowMean(f, 2, "key", nan=True) for f in IOT_FIELDS],
    ),
    "logistics": Silver(
        "internal_system",
        clean_logistics,
        [
            FromColumn(
                "actual_delivery_date", "scheduled_delivery_date", "shipment_status", "RECEIVED"
            )
        ],
    ),
    "online_sales": Silver(
        "webpage",
        clean_online_sales,
        [Literal("currency", "EUR"), Literal("payment_method", "CREDIT_CARD")],
    ),
}

GOLD: dict[str, Gold] = {
    "climate_impact": Gold(
        ("online_sales", "climate"),
        metrics.climate_impact,
        parts=(metrics.daily_sales_parts, metrics.weather_parts),
        merge=metrics.climate_impact_of,
    ),
    "order_fulfillment_performance": Gold(
        ("online_sales", "logistics"), metrics.order_fulfillment_performance, sums=False
    ),
    "sales_volume": Gold(
        ("online_sales",),
        metrics.sales_volume,
        parts=(metrics.sales_parts,),
        merge=metrics.sales_volume_of,
    ),
}
