"""How unevenly records are spread over partitions and keys."""

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

#: Items a frequency sketch holds, and how many of the largest it names. Its error is below a thousandth of all rows.
TRACKED, NAMED = 10_000, 1_000
#: Sketches that are merged together in the first step.
LOTS = 64


def partition_skew(records: DataFrame) -> DataFrame:
    """Per topic: partitions seen, records, the largest partition, the mean, and their ratio."""
    sizes = records.groupBy("topic", "partition").agg(F.count("*").alias("n"))
    return sizes.groupBy("topic").agg(
        F.count("*").alias("partitions"), F.sum("n").alias("records"), F.max("n").alias("largest"),
        F.round(F.sum("n") / F.count("*"), 6).alias("mean"), F.round(F.max("n") * F.count("*") / F.sum("n"), 6).alias("skew"))


def hot_keys(records: DataFrame, share: float, by: str = "topic", key: str = "key") -> DataFrame:
    """Keys with at least ``share`` of their topic's records, with exact counts and the salts that would level them.

    A mergeable frequent-items sketch per task, merged in two steps, names every key that can be so frequent; a second
    pass counts these alone, per task before the shuffle. So no key is counted in one task. ``salts`` is the number of
    parts of at most ``share`` the key would fall into.
    """
    if share < 10 / NAMED:
        raise ValueError(f"a share below {10 / NAMED} needs a larger sketch")
    named = records.where(F.col(key).isNotNull())
    lots = named.groupBy(by, (F.spark_partition_id() % LOTS).alias("_lot")).agg(
        F.expr(f"approx_top_k_accumulate(`{key}`, {TRACKED})").alias("_sketch"))
    whole = lots.groupBy(by).agg(F.expr(f"approx_top_k_combine(_sketch, {TRACKED})").alias("_sketch"))
    candidates = whole.select(by, F.explode(F.expr(f"approx_top_k_estimate(_sketch, {NAMED})")).alias("_item")).select(
        by, F.col("_item.item").alias(key))
    # At most NAMED keys a topic.
    counted = named.join(F.broadcast(candidates), [by, key]).groupBy(by, key).agg(F.count("*").alias("n"))
    totals = records.groupBy(by).agg(F.count("*").alias("_all"))
    return counted.join(totals, by).where(F.col("n") >= F.lit(share) * F.col("_all")).select(
        by, key, "n", F.round(F.col("n") / F.col("_all"), 6).alias("share"),
        F.ceil(F.col("n") / (F.lit(share) * F.col("_all"))).alias("salts"))
