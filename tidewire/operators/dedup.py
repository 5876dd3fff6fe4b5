"""Copies of one event, told by its id, within a horizon of event time."""

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def drop_copies(events: DataFrame, horizon_seconds: int, time: str = "occurred_at", key: str = "event_id") -> DataFrame:
    """Events without those that follow an event of the same id by less than the horizon.

    Time is cut into spans of the horizon. Within a span all but the first event of an id are copies, so every task
    keeps one row an id and span before the shuffle, however often an id was sent. The first event of a span is a copy
    if the span before ends in one too near; that is one join of the spans with themselves.

    Events of one id and time are ordered by their other columns; events without an id or a time are all kept.
    """
    kept = [c for c in events.columns if c not in (key, time)]
    micros = F.unix_micros(F.col(time).cast("timestamp"))
    width = horizon_seconds * 1_000_000
    known = events.where(F.col(key).isNotNull() & F.col(time).isNotNull()).select(
        F.col(key).alias("_key"), F.floor(micros / width).alias("_span"), micros.alias("_at"),
        F.struct(micros.alias("_at"), F.to_json(F.struct(*kept)).alias("_text"), F.struct(*events.columns).alias("_row")).alias("_first"))
    # Maps cannot be compared, so the least row is found by its text.
    spans = known.groupBy("_key", "_span").agg(
        F.min_by("_first", F.struct("_first._at", "_first._text")).alias("_first"), F.max("_at").alias("_last"))
    before = spans.select("_key", (F.col("_span") + 1).alias("_span"), F.col("_last").alias("_before"))
    first = spans.join(before, ["_key", "_span"], "left").where(
        F.col("_before").isNull() | (F.col("_first._at") - F.col("_before") >= width))
    return first.select("_first._row.*").unionByName(events.where(F.col(key).isNull() | F.col(time).isNull()))


def drop_copies_stream(events: DataFrame, horizon_seconds: int, time: str = "timestamp", key: str = "event_id") -> DataFrame:
    """The streaming form: an id is remembered for the horizon after its event, and until the watermark has passed that.

    It agrees with the batch form where the copies of an event lie within one horizon of it, or come after the
    watermark has passed the horizon. Events older than the watermark are dropped as late.
    """
    return events.withWatermark(time, f"{horizon_seconds} seconds").dropDuplicatesWithinWatermark([key])
