import datetime as dt

import pytest
from pyspark.sql import functions as F

from lakeops.functions import decode, geo, text, time


@pytest.mark.parametrize(
    ("product", "expected"),
    [
        ("fert_001 - Nitrogen Boost 20-10-10", ("FERT_001", "NITROGEN BOOST 201010")),
        ("FERT_001, Nitrogen, Boost", ("FERT_001", "NITROGEN BOOST")),
        ("no id here", ("", "NO ID HERE")),
        (None, (None, None)),
    ],
)
def test_split_product(spark, product, expected):
    df = text.split_product(spark.createDataFrame([(product,)], "product string"))
    assert df.columns == ["product_id", "product_name"]
    assert tuple(df.first()) == expected


@pytest.mark.parametrize(
    ("address", "expected"),
    [
        ("Gran Via, 12, 28013", ("Gran Via 12", 28013)),
        ("Gran Via, 12", ("Gran Via 12", None)),
        ("28013, Gran Via, 12345, x", ("Gran Via  x", 28013)),
        ("Calle 123456", ("Calle 123456", None)),
        (None, (None, None)),
    ],
)
def test_split_address(spark, address, expected):
    df = text.split_address(spark.createDataFrame([(address,)], "address string"))
    assert tuple(df.select("address", "postal_code").first()) == expected


def test_split_address_output_name(spark):
    df = spark.createDataFrame([("Gran Via, 1",)], "street string")
    row = text.split_address(df, "street", output="cleaned").first()
    assert (row.street, row.cleaned) == ("Gran Via, 1", "Gran Via 1")


@pytest.mark.parametrize(
    ("coord", "signed", "unsigned"),
    [
        ("(40.123456, -3.654321)", (40.123456, -3.654321), (40.123456, 3.654321)),
        ("(40.1, 12.5)", (40.1, 12.5), (40.1, 2.5)),
        ("(40, 3.5)", (40.0, 3.5), (None, None)),
        (None, (None, None), (None, None)),
    ],
)
def test_split_coord_text(spark, coord, signed, unsigned):
    df = spark.createDataFrame([(coord,)], "coord string")
    assert tuple(geo.split_coord_text(df).first()) == signed
    assert tuple(geo.split_coord_text(df, pattern=geo.UNSIGNED_PAIR).first()) == unsigned


def test_split_coord_array(spark, rows):
    df = spark.createDataFrame([([1, 2],), ([3],), ([],), (None,)], "coord array<int>")
    cast = geo.split_coord_array(df)
    assert dict(cast.dtypes) == {"latitude": "double", "longitude": "double"}
    assert rows(cast) == [(None, None), (None, None), (1.0, 2.0), (3.0, None)]
    assert dict(geo.split_coord_array(df, cast=None).dtypes)["latitude"] == "int"


def test_uppercase(spark):
    df = spark.createDataFrame([("a", "b", None)], "x string, y string, z string")
    assert tuple(text.uppercase(df, ["x", "z"]).first()) == ("A", "b", None)


def test_epoch_millis_cuts_to_seconds_and_bears_bad_text(spark):
    df = spark.createDataFrame(
        [("1740787200999",), ("1740787200000.0",), ("2025-03-01",), (None,)], "raw string"
    )
    seconds = df.select(time.epoch_millis(F.col("raw")).cast("long").alias("s"))
    assert [r.s for r in seconds.collect()] == [1740787200, 1740787200, None, None]


def test_default_timestamp_is_one_literal_per_run(spark):
    run = dt.datetime(2025, 3, 1, 12, tzinfo=dt.timezone.utc)
    df = spark.createDataFrame([(None,), (None,)], "ts timestamp")
    times = time.default_timestamp(df, "ts", run).select(F.col("ts").cast("long").alias("s"))
    assert {r.s for r in times.collect()} == {int(run.timestamp())}


def test_partition_columns(spark):
    df = spark.createDataFrame([("2025-03-09 23:59:59",), (None,)], "t string")
    df = time.partition_columns(df.select(F.col("t").cast("timestamp").alias("timestamp")))
    assert [tuple(r)[1:] for r in df.collect()] == [(2025, 3, 9), (None, None, None)]


KAFKA = (
    "key binary, value binary, topic string, partition int, offset bigint, timestamp timestamp, "
    "timestampType int"
)


def kafka_records(spark, values):
    records = [(b"user_1", v, "t", 0, i, None, 0) for i, v in enumerate(values)]
    return spark.createDataFrame(records, KAFKA)


def test_decode_json(spark):
    df = kafka_records(spark, [b'{"a": 1, "value": "v"}', b'{"a": "x"}', b"junk", None])
    df = decode.decode_value(df, "json", ddl="a int, value string")
    assert df.columns == [
        "_topic", "_partition", "_offset", "_timestamp", "_timestampType", "key",
        "_ingestion_time", "a", "value",
    ]
    assert [(r.key, r.a, r.value) for r in df.orderBy("_offset").collect()] == [
        ("user_1", 1, "v"),
        ("user_1", None, None),
        ("user_1", None, None),
        ("user_1", None, None),
    ]


def test_strip_frame(spark):
    df = spark.createDataFrame([(bytes.fromhex("0000000001AABB"),)], "v binary")
    assert bytes(df.select(decode.strip_frame(F.col("v"))).first()[0]) == b"\xaa\xbb"


def test_unknown_value_format(spark):
    with pytest.raises(ValueError, match="xml"):
        decode.decode_value(kafka_records(spark, [b""]), "xml")


def test_decode_avro(spark):
    schema = '{"type": "record", "name": "r", "fields": [{"name": "a", "type": "long"}]}'
    if spark._jvm.java.lang.Thread.currentThread().getContextClassLoader().getResource(
        "org/apache/spark/sql/avro/AvroDataToCatalyst.class"
    ) is None:
        pytest.skip("the spark-avro module is not on the class path")
    df = decode.decode_avro(kafka_records(spark, [bytes.fromhex("000000000106")]), schema)
    assert df.first().a == 3
