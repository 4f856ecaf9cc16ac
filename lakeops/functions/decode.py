"""From raw Kafka records to columns."""

from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

_PAYLOAD = "__payload"
# Fixed value: 1 magic byte and a 4-byte schema id stand before an Avro value.
FRAME_BYTES = 5


def prefix_envelope(df: DataFrame) -> DataFrame:
    """Prefix the Kafka columns with `_`, so that payload fields cannot clash with them."""
    return df.toDF(*[f"_{c}" for c in df.columns])


def strip_frame(value: Column) -> Column:
    return F.substring(value, F.lit(FRAME_BYTES + 1), F.length(value) - FRAME_BYTES)


def schema_id(value: Column) -> Column:
    """The id of the writer schema in the frame of a value, null if there is no whole frame."""
    digits = F.conv(F.hex(F.substring(value, 2, FRAME_BYTES - 1)), 16, 10).cast("bigint")
    framed = (F.length(value) >= FRAME_BYTES) & (F.hex(F.substring(value, 1, 1)) == "00")
    return F.when(framed, digits)


def split_by_schema(df: DataFrame, known: int, value: str = "value") -> tuple[DataFrame, DataFrame]:
    """Records framed with the id `known`, and all others for a reject table.

    A value of another schema, decoded by this one, would stop the stream or give wrong
    numbers.
    """
    same = F.coalesce(schema_id(F.col(value)) == known, F.lit(False))
    return df.filter(same), df.filter(~same)


def decode_with(df: DataFrame, payload: Callable[[Column], Column], ingested: Column | None = None):
    """Kafka records with the fields of what `payload` makes of their value.

    `ingested` is the time of ingestion, that of the query unless given.
    """
    envelope = prefix_envelope(df)
    return (
        envelope.withColumns(
            {
                "key": F.col("_key").cast("string"),
                _PAYLOAD: payload(F.col("_value")),
                "_ingestion_time": F.current_timestamp() if ingested is None else ingested,
            }
        )
        .select("*", f"{_PAYLOAD}.*")
        .drop(_PAYLOAD, "_key", "_value")
    )


def json_payload(ddl: str) -> Callable[[Column], Column]:
    return lambda value: F.from_json(value.cast("string"), ddl)


def framed_json_payload(ddl: str) -> Callable[[Column], Column]:
    return lambda value: F.from_json(strip_frame(value).cast("string"), ddl)


def avro_payload(schema_json: str) -> Callable[[Column], Column]:
    """Framed Avro of one writer schema. Needs the external `spark-avro` module on the class path."""
    from pyspark.sql.avro.functions import from_avro

    return lambda value: from_avro(strip_frame(value), schema_json)


def decode_json(df: DataFrame, ddl: str) -> DataFrame:
    """Kafka records with JSON values; a malformed value or field gives nulls."""
    return decode_with(df, json_payload(ddl))


def decode_avro(df: DataFrame, schema_json: str) -> DataFrame:
    """Kafka records with framed Avro values, decoded by one writer schema."""
    return decode_with(df, avro_payload(schema_json))


def payload_of(value_format: str, ddl: str | None = None, avro_schema: str | None = None):
    """What makes the fields of a value of a format."""
    if value_format == "json":
        return json_payload(ddl)
    if value_format == "avro":
        return avro_payload(avro_schema)
    raise ValueError(f"unknown value format: {value_format!r}")


def decode_value(
    df: DataFrame, value_format: str, ddl: str | None = None, avro_schema: str | None = None
) -> DataFrame:
    if value_format == "json":
        return decode_json(df, ddl)
    if value_format == "avro":
        return decode_avro(df, avro_schema)
    raise ValueError(f"unknown value format: {value_format!r}")
