"""Streams from sockets and Kafka topics.

Kafka needs the `spark-sql-kafka-0-10` package on the session's class path.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F


def stream_socket(spark: SparkSession, host: str, port: int) -> DataFrame:
    """Lines from a socket. The source cannot be replayed, so it suits trials only."""
    return spark.readStream.format("socket").option("host", host).option("port", port).load()


def kafka_options(
    servers: str,
    topic: str,
    group: str | None = None,
    min_partitions: int | None = None,
    starting: str = "latest",
    max_offsets: int | None = None,
) -> dict[str, str]:
    """Reader options. `min_partitions` splits the topic over more tasks than it
    has partitions; `max_offsets` bounds a micro-batch after a pause."""
    options = {
        "kafka.bootstrap.servers": servers,
        "subscribe": topic,
        "startingOffsets": starting,
        "kafka.group.id": group,
        "minPartitions": min_partitions,
        "maxOffsetsPerTrigger": max_offsets,
    }
    return {name: str(value) for name, value in options.items() if value is not None}


def stream_kafka_binary(spark: SparkSession, **options) -> DataFrame:
    """(`key` string, `value` binary) of a topic; see `kafka_options`."""
    records = spark.readStream.format("kafka").options(**kafka_options(**options)).load()
    return keyed_bytes(records)


def stream_kafka(spark: SparkSession, **options) -> DataFrame:
    """(`key`, `value`) strings of a topic; see `kafka_options`."""
    records = spark.readStream.format("kafka").options(**kafka_options(**options)).load()
    return keyed_text(records)


def keyed_bytes(records: DataFrame) -> DataFrame:
    return records.select(F.col("key").cast("string"), F.col("value").cast("binary"))


def keyed_text(records: DataFrame) -> DataFrame:
    return records.select(F.col("key").cast("string"), F.col("value").cast("string"))
