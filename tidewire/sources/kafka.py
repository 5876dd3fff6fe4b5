"""Thin adapter to Spark's Kafka connector.

The connector is a separate package (``spark-sql-kafka-0-10``). This module
has not been run against a broker; everything behind it takes the same columns
from ``tidewire.sources.topic_log``.
"""

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import DataStreamWriter

# Fixed value: brokers of a local three-node cluster.
LOCAL_SERVERS = "localhost:9092,localhost:9093,localhost:9094"


def _as_text(records: DataFrame) -> DataFrame:
    return records.select(
        "topic",
        "partition",
        "offset",
        F.col("key").cast("string").alias("key"),
        F.col("value").cast("string").alias("value"),
        "timestamp",
    )


def stream_topics(spark: SparkSession, *topics: str, servers: str = LOCAL_SERVERS, starting: str = "latest") -> DataFrame:
    """Topic records as a stream.

    ``starting`` counts only on the first start of a checkpoint. A monitor that
    must never replay uses ``latest`` with a new checkpoint per run; a consumer
    that must not miss anything uses ``earliest`` and keeps its checkpoint.
    """
    reader = (
        spark.readStream.format("kafka")
        .option("kafka.bootstrap.servers", servers)
        .option("subscribe", ",".join(topics))
        .option("startingOffsets", starting)
    )
    return _as_text(reader.load())


def read_topics(spark: SparkSession, *topics: str, servers: str = LOCAL_SERVERS) -> DataFrame:
    """Everything now on the topics, as a batch."""
    reader = (
        spark.read.format("kafka")
        .option("kafka.bootstrap.servers", servers)
        .option("subscribe", ",".join(topics))
        .option("startingOffsets", "earliest")
        .option("endingOffsets", "latest")
    )
    return _as_text(reader.load())


def publish(records: DataFrame, servers: str = LOCAL_SERVERS) -> None:
    """Send ``topic, key, value`` rows; the broker client picks partitions from the keys."""
    (
        records.select("topic", "key", "value")
        .write.format("kafka")
        .option("kafka.bootstrap.servers", servers)
        .option("kafka.acks", "1")
        .save()
    )


def publish_stream(records: DataFrame, checkpoint: str, servers: str = LOCAL_SERVERS) -> DataStreamWriter:
    """Writer for a streaming publish; start it with the caller's trigger."""
    return (
        records.select("topic", "key", "value")
        .writeStream.format("kafka")
        .option("kafka.bootstrap.servers", servers)
        .option("kafka.acks", "1")
        .option("checkpointLocation", checkpoint)
    )
