"""The live feed: one thin row shape for both topics, served per named stream."""

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import Window as W

from tidewire import schemas
from tidewire.functions.codec import decode

# Fixed value: rows a panel keeps.
PANEL_SIZE = 200

# Fixed value: shown where an action has no target.
NO_TARGET = "-"

#: Tasks whose newest rows are compared together before those of the whole stream.
TASKS_IN_LOT = 256


def action_items(actions: DataFrame) -> DataFrame:
    return actions.select(
        F.lit(schemas.USER_ACTIONS_TOPIC).alias("topic"),
        F.col("action_type").alias("event_type"),
        F.col("user_id").alias("primary_key"),
        F.coalesce("target_id", F.lit(NO_TARGET)).alias("detail"),
        "partition",
        "offset",
        "occurred_at",
    )


def interaction_items(interactions: DataFrame) -> DataFrame:
    """No validation and no poison test: the feed shows whatever is on the topic."""
    return interactions.select(
        F.lit(schemas.CONTENT_INTERACTIONS_TOPIC).alias("topic"),
        F.col("interaction_type").alias("event_type"),
        F.col("user_id").alias("primary_key"),
        F.col("content_id").alias("detail"),
        "partition",
        "offset",
        "occurred_at",
    )


def union_feed(actions: DataFrame, interactions: DataFrame) -> DataFrame:
    return action_items(actions).unionByName(interaction_items(interactions))


def feed_items(events: DataFrame) -> DataFrame:
    """Feed items of the events of both topics in one pass."""
    acts = F.col("topic") == schemas.USER_ACTIONS_TOPIC
    return events.select(
        "topic",
        F.when(acts, F.col("action_type")).otherwise(F.col("interaction_type")).alias("event_type"),
        F.col("user_id").alias("primary_key"),
        F.when(acts, F.coalesce("target_id", F.lit(NO_TARGET))).otherwise(F.col("content_id")).alias("detail"),
        "partition",
        "offset",
        "occurred_at",
    )


def decoded(records: DataFrame) -> DataFrame:
    """Records of both topics, read in one pass instead of one per topic; ``raw_value`` keeps what was sent."""
    of_feed = records.where(F.col("topic").isin(schemas.USER_ACTIONS_TOPIC, schemas.CONTENT_INTERACTIONS_TOPIC))
    return decode(of_feed.withColumn("raw_value", F.col("value")), schemas.USER_ACTION, schemas.CONTENT_INTERACTION)


def readable(read: DataFrame) -> DataFrame:
    """Feed items of ``decoded`` records."""
    return feed_items(read.where(F.col("decode_error").isNull()))


def rejects(read: DataFrame) -> DataFrame:
    """The ``decoded`` records that could not be read: their place, key and value as sent, and the reason."""
    return read.where(F.col("decode_error").isNotNull()).select(
        "topic", "partition", "offset", "key", F.col("raw_value").alias("value"), F.col("decode_error").alias("reason"))


def feed_from_records(records: DataFrame) -> DataFrame:
    """Feed items of raw topic records; what cannot be read is in ``feed_rejects``."""
    return readable(decoded(records))


def feed_rejects(records: DataFrame) -> DataFrame:
    """Records of the feed's topics that cannot be read. Each record is an item or a reject."""
    return rejects(decoded(records))


def newest_per_stream(feed: DataFrame, size: int = PANEL_SIZE, newest_by: tuple[str, ...] = ("occurred_at",)) -> DataFrame:
    """The newest ``size`` rows of each stream.

    A stream's history never meets in one task, whatever the size: the newest
    rows of each task are kept first, then those of each lot of tasks, then
    those of the stream.
    """
    order = [F.col(name).desc() for name in newest_by]
    rows = feed.withColumn("_task", F.spark_partition_id()).withColumn("_lot", F.floor(F.col("_task") / TASKS_IN_LOT))
    for held in (["topic", "_task"], ["topic", "_lot"], ["topic"]):
        rows = rows.withColumn("_rank", F.row_number().over(W.partitionBy(*held).orderBy(*order)))
        rows = rows.where(F.col("_rank") <= size)
    return rows.drop("_task", "_lot", "_rank")


def newest_with_offsets(
    records: DataFrame, size: int = PANEL_SIZE, order_by: tuple[str, ...] = ("occurred_at", "event_id")
) -> DataFrame:
    """The newest ``size`` records of each topic with their ``offset``, without numbering the topics.

    Whatever is newer in the same partition is among the newest of the topic
    too, so the rank from the newest and the partition's count give the offset.
    """
    counts = records.groupBy("topic", "partition").agg(F.count("*").alias("_size")).select(
        F.col("topic").alias("_topic"), F.col("partition").alias("_partition"), "_size")
    from_newest = W.partitionBy("topic", "partition").orderBy(*(F.col(name).desc() for name in order_by))
    newest = newest_per_stream(records, size, order_by).withColumn("_back", F.row_number().over(from_newest))
    same = F.col("topic").eqNullSafe(F.col("_topic")) & F.col("partition").eqNullSafe(F.col("_partition"))
    return newest.join(counts, same).withColumn("offset", F.col("_size") - F.col("_back")).drop(
        "_topic", "_partition", "_size", "_back")


def panel_counts(feed: DataFrame) -> DataFrame:
    return feed.groupBy(F.col("topic").alias("stream_name")).agg(F.count("*").alias("n"))


def write_feed(feed: DataFrame, path: str, mode: str = "append") -> None:
    """Store feed items by stream, so that a subscriber reads only its own folder."""
    feed.withColumn("stream_name", F.col("topic")).write.mode(mode).partitionBy("stream_name").parquet(path)


def subscribe(spark: SparkSession, path: str, stream_name: str) -> DataFrame:
    """Stored feed items of one stream; the filter prunes the other folders."""
    return spark.read.parquet(path).where(F.col("stream_name") == stream_name)
