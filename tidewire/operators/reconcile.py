"""Checks that nothing was lost or changed between two stages."""

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

MATCHED = "matched"
LOST = "lost"
UNEXPECTED = "unexpected"


def roundtrip(published: DataFrame, consumed: DataFrame, key: str = "event_id") -> DataFrame:
    """Status of every event id seen on either side.

    A full outer join by counting: both sides are stacked and summed per id.
    Ids seen many times are summed before the shuffle, where a join would
    send every copy to one task and multiply them.
    """
    sides = published.select(key, F.lit(1).alias("_out"), F.lit(0).alias("_in")).unionByName(
        consumed.select(key, F.lit(0).alias("_out"), F.lit(1).alias("_in"))
    )
    status = (
        F.when((F.sum("_out") > 0) & (F.sum("_in") > 0), F.lit(MATCHED))
        .when(F.sum("_out") > 0, F.lit(LOST))
        .otherwise(F.lit(UNEXPECTED))
    )
    return sides.groupBy(key).agg(status.alias("status"))


def roundtrip_counts(published: DataFrame, consumed: DataFrame, key: str = "event_id") -> DataFrame:
    return roundtrip(published, consumed, key).groupBy("status").agg(F.count("*").alias("n"))


def feed_mismatches(feed: DataFrame, source: DataFrame) -> DataFrame:
    """Per topic: positions whose feed row and source item differ in any field, or that only one side has.

    Both inputs have the feed's columns. ``(topic, partition, offset)`` names
    one record, so the groups are small: both sides are stacked and compared
    per position, where an outer join would shuffle the same rows.
    """
    position = ["topic", "partition", "offset"]
    item = F.struct(*(name for name in feed.columns if name not in position)).alias("_item")
    sides = feed.select(*position, item, F.lit(1).alias("_served")).unionByName(
        source.select(*position, item, F.lit(-1).alias("_served")))
    paired = sides.groupBy(*position).agg(
        F.sum("_served").alias("_balance"), F.size(F.collect_set("_item")).alias("_forms"))
    differs = (F.col("_balance") != 0) | (F.col("_forms") != 1)
    return paired.groupBy("topic").agg(F.count_if(differs).alias("mismatches"))
