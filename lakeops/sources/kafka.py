"""Kafka topics as a stream. Needs the external `spark-sql-kafka` module on the class path."""

from collections.abc import Mapping

from pyspark.sql import DataFrame, SparkSession


def sasl_options(servers: str, user: str, password: str) -> dict[str, str]:
    """Options for a broker that asks for a user and a password over TLS."""
    login = "org.apache.kafka.common.security.plain.PlainLoginModule"
    return {
        "kafka.bootstrap.servers": servers,
        "kafka.security.protocol": "SASL_SSL",
        "kafka.sasl.mechanism": "PLAIN",
        "kafka.sasl.jaas.config": f'{login} required username="{user}" password="{password}";',
    }


def read_kafka_stream(
    spark: SparkSession, topic: str, options: Mapping[str, str], starting: str = "earliest"
) -> DataFrame:
    return (
        spark.readStream.format("kafka")
        .options(**options)
        .option("subscribe", topic)
        .option("startingOffsets", starting)
        .load()
    )
