"""The event catalog and the declared topics, as bounded dimension tables."""

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import Window as W

from tidewire import schemas

# The event catalog, in declared order.
TAXONOMY = (
    (schemas.USER_ACTION, "POST_CREATED", "A user published a new post."),
    (schemas.USER_ACTION, "POST_DELETED", "A user removed a post they previously published."),
    (schemas.USER_ACTION, "USER_FOLLOWED", "A user started following another user."),
    (schemas.USER_ACTION, "USER_UNFOLLOWED", "A user stopped following another user."),
    (schemas.USER_ACTION, "PROFILE_UPDATED", "A user changed profile fields (bio, avatar, display name)."),
    (schemas.CONTENT_INTERACTION, "CONTENT_LIKED", "A user liked a piece of content."),
    (schemas.CONTENT_INTERACTION, "CONTENT_COMMENTED", "A user commented on a piece of content."),
    (schemas.CONTENT_INTERACTION, "CONTENT_SHARED", "A user shared a piece of content to their own timeline."),
    (schemas.SYSTEM, "CONTENT_MODERATION_FLAGGED", "The moderation pipeline flagged content for review."),
    (schemas.SYSTEM, "RECOMMENDATION_MODEL_UPDATED", "A new recommendation model version was promoted to production."),
)

# Production partition counts, the counts of a local run, replicas and configs.
PRODUCTION_PARTITIONS = {schemas.USER_ACTIONS_TOPIC: 1000, schemas.CONTENT_INTERACTIONS_TOPIC: 500}
LOCAL_PARTITIONS = {schemas.USER_ACTIONS_TOPIC: 12, schemas.CONTENT_INTERACTIONS_TOPIC: 6}
REPLICATION_FACTOR = 3
RETENTION_DAYS = 7
TOPIC_CONFIGS = {
    "cleanup.policy": "delete",
    "retention.ms": str(RETENTION_DAYS * 24 * 60 * 60 * 1000),
    "min.insync.replicas": "2",
}


def taxonomy(spark: SparkSession) -> DataFrame:
    """Ten catalog rows with their declared position."""
    rows = [(at, *entry) for at, entry in enumerate(TAXONOMY, start=1)]
    return spark.createDataFrame(rows, schemas.CATALOG_ENTRY)


def topic_catalog(spark: SparkSession, partitions: dict[str, int] | None = None) -> DataFrame:
    """The two declared topics; ``partitions`` overrides the production counts."""
    counts = {**PRODUCTION_PARTITIONS, **(partitions or {})}
    rows = [(name, count, REPLICATION_FACTOR, TOPIC_CONFIGS) for name, count in counts.items()]
    return spark.createDataFrame(rows, schemas.TOPIC_SPEC)


def at_local_scale(partitions: dict[str, int]) -> bool:
    """True if any topic runs with other than its production partition count."""
    return any(partitions.get(name, count) != count for name, count in PRODUCTION_PARTITIONS.items())


def lookup(events: DataFrame) -> DataFrame:
    """Each event with its catalog description, null where the type is unknown.

    The catalog always has ten rows, so it is broadcast and the events do not shuffle.
    """
    catalog = taxonomy(events.sparkSession).select("category", "event_type", "description")
    return events.join(F.broadcast(catalog), ["category", "event_type"], "left")


def unknown_types(events: DataFrame) -> DataFrame:
    """Events whose type the catalog does not list."""
    catalog = taxonomy(events.sparkSession).select("category", "event_type")
    return events.join(F.broadcast(catalog), ["category", "event_type"], "left_anti")


def usage(events: DataFrame) -> DataFrame:
    """The whole catalog with the number of events of each type, zero where none occurred."""
    seen = events.groupBy("category", "event_type").agg(F.count("*").alias("n"))
    return (
        taxonomy(events.sparkSession)
        .join(seen, ["category", "event_type"], "left")
        .select("ordinal", "category", "event_type", "description", F.coalesce("n", F.lit(0)).alias("n"))
    )


def report(catalog: DataFrame) -> DataFrame:
    """Catalog rows in declared order; the first row of each category carries it as a header.

    The input is the catalog, whose size is fixed, so one ordered window is enough.
    """
    before = F.lag("category").over(W.orderBy("ordinal"))
    return catalog.select(
        "*", F.when(~before.eqNullSafe(F.col("category")), F.col("category")).alias("header")
    ).orderBy("ordinal")


def by_category(events: DataFrame) -> DataFrame:
    """Per category: catalog entries and events seen."""
    counted = usage(events).groupBy("category").agg(F.count("*").alias("types"), F.sum("n").alias("n"))
    return counted


def topic_usage(records: DataFrame, partitions: dict[str, int] | None = None) -> DataFrame:
    """Declared topics next to the number of records seen on each."""
    seen = records.groupBy("topic").agg(F.count("*").alias("n"))
    declared = topic_catalog(records.sparkSession, partitions)
    return declared.join(seen, declared["name"] == seen["topic"], "left").select(
        "name", "partitions", "replication_factor", F.coalesce("n", F.lit(0)).alias("n")
    )
