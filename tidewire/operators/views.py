"""Table views of change logs, and joins of events with the version that held at their time."""

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F


def latest_by_key(changes: DataFrame, key: str, time: str, *ties: str) -> DataFrame:
    """The table a change log stands for: the last row of every key. Kept per task before the shuffle."""
    values = F.struct(*(c for c in changes.columns if c != key))
    return changes.groupBy(key).agg(F.max_by(values, F.struct(time, *ties)).alias("_last")).select(key, "_last.*")


def valid_spans(versions: DataFrame, key: str, since: str) -> DataFrame:
    """Versions of a small catalog with ``until``, the time of the next version of their key (null: none yet)."""
    return versions.withColumn("until", F.lead(since).over(W.partitionBy(key).orderBy(since)))


def with_catalog_version(events: DataFrame, spans: DataFrame, key: str, time: str, since: str = "since") -> DataFrame:
    """Each event, of a batch or a stream, with the catalog version of its key and time; null where there is none.

    For catalogs: ``spans`` should be small, Spark sends it to all tasks if its measured size allows.
    """
    table = spans.withColumnRenamed(key, "_key")
    held = (F.col(key) == F.col("_key")) & (F.col(time) >= F.col(since)) & (
        F.col("until").isNull() | (F.col(time) < F.col("until")))
    return events.join(table, held, "left").drop("_key", since, "until")


def as_of_join(
    events: DataFrame, changes: DataFrame, key: str, time: str, changed: str, order: list[str], span_seconds: int
) -> DataFrame:
    """Each event with the last change of its key before or at its time, as the struct ``version`` (null: none).

    For change logs of any size. Key and time are cut into spans of ``span_seconds``; a span's events and changes meet
    in one group, and what held when the span began comes from a summary of one row a key and span. So neither a hot
    key nor a long log makes one group of all its rows. ``order`` breaks ties of changes at one time.
    """
    def span(column: str) -> Column:
        return F.window(column, f"{span_seconds} seconds")["start"]

    value = F.struct(*(c for c in changes.columns if c != key))
    logged = changes.where(F.col(key).isNotNull() & F.col(changed).isNotNull()).select(
        F.col(key).alias("_key"), span(changed).alias("_span"), F.col(changed).alias("_at"),
        F.struct(*(F.col(c) for c in order)).alias("_tie"), value.alias("_version"))
    asked = events.where(F.col(key).isNotNull() & F.col(time).isNotNull()).select(
        F.col(key).alias("_key"), span(time).alias("_span"), F.col(time).alias("_at"), F.struct(*events.columns).alias("_event"))
    ends = logged.groupBy("_key", "_span").agg(F.max_by("_version", F.struct("_at", "_tie")).alias("_end"))
    wanted = asked.select("_key", "_span").distinct().withColumn("_end", F.lit(None).cast(ends.schema["_end"].dataType))
    summary = ends.unionByName(wanted).groupBy("_key", "_span").agg(F.first("_end", ignorenulls=True).alias("_end"))
    earlier = W.partitionBy("_key").orderBy("_span").rowsBetween(W.unboundedPreceding, -1)
    carried = summary.select("_key", "_span", F.last("_end", ignorenulls=True).over(earlier).alias("_carried"))
    both = asked.withColumn("_tie", F.lit(None).cast(logged.schema["_tie"].dataType)).withColumn(
        "_version", F.lit(None).cast(logged.schema["_version"].dataType)).unionByName(
        logged.withColumn("_event", F.lit(None).cast(asked.schema["_event"].dataType)))
    within = W.partitionBy("_key", "_span").orderBy("_at", F.col("_event").isNotNull(), "_tie").rowsBetween(
        W.unboundedPreceding, 0)
    found = both.withColumn("_seen", F.last("_version", ignorenulls=True).over(within)).where(F.col("_event").isNotNull())
    joined = found.join(carried, ["_key", "_span"], "left").select(
        "_event.*", F.coalesce("_seen", "_carried").alias("version"))
    rest = events.where(F.col(key).isNull() | F.col(time).isNull())
    return joined.unionByName(rest.withColumn("version", F.lit(None).cast(joined.schema["version"].dataType)))
