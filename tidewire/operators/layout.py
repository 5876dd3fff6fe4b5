"""Declared table layouts against what the data shows. Mismatches are reported, never corrected."""

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidewire.functions.sql import fill

# Audit text and statuses.
MISMATCH_DETAIL = "%s (expected %s partitions, found %s)"
MISSING = "missing"
VERIFIED = "verified"
MISMATCHED = "mismatched"


def observed_layout(records: DataFrame, declared: DataFrame | None = None) -> DataFrame:
    """Partitions seen per topic.

    An empty partition leaves no record; pass a ``declared`` layout of
    ``(topic, partitions)`` to take its count where it is higher.
    """
    seen = records.groupBy("topic").agg(F.count_distinct("partition").cast("int").alias("partitions"))
    if declared is None:
        return seen
    return seen.unionByName(declared.select("topic", "partitions")).groupBy("topic").agg(
        F.max("partitions").alias("partitions")
    )


def missing(desired: DataFrame, observed: DataFrame) -> DataFrame:
    """Desired names that do not exist yet, each once."""
    return desired.join(observed, desired["name"] == observed["topic"], "left_anti").select("name").distinct()


def present(desired: DataFrame, observed: DataFrame) -> DataFrame:
    """Desired names that exist; only the name counts."""
    return desired.join(observed, desired["name"] == observed["topic"], "left_semi").select("name")


def name_difference(desired: DataFrame, observed: DataFrame) -> DataFrame:
    return desired.select("name").exceptAll(observed.select(F.col("topic").alias("name")))


def name_intersection(desired: DataFrame, observed: DataFrame) -> DataFrame:
    return desired.select("name").intersect(observed.select(F.col("topic").alias("name")))


def audit(desired: DataFrame, observed: DataFrame) -> DataFrame:
    """One row per desired name: missing, verified, or mismatched with both counts."""
    found = observed.select(F.col("topic").alias("name"), F.col("partitions").alias("found"))
    same = F.col("partitions") == F.col("found")
    absent = F.col("found").isNull()
    return desired.select("name", "partitions").join(found, "name", "left").select(
        "name",
        F.when(absent, F.lit(MISSING)).when(same, F.lit(VERIFIED)).otherwise(F.lit(MISMATCHED)).alias("status"),
        F.when(~absent & ~same, F.expr(fill(MISMATCH_DETAIL, "name", "partitions", "found"))).alias("detail"),
    )


def has_mismatches(audited: DataFrame) -> bool:
    return not audited.where(F.col("status") == MISMATCHED).isEmpty()
