"""Queries that run a streaming job to its end and return what it stored."""

from pyspark.sql import functions as F

from tidewire import schemas
from tidewire.functions import codec
from tidewire.functions.instants import to_instant
from tidewire.operators import envelope, rates
from tidewire.plans.oracle import model
from tidewire.plans.records import ROUTED, interaction_records
from tidewire.plans.registry import register
from tidewire.plans.throughput import TICK_SECONDS, _HISTORY, flat_history
from tidewire.session import fresh_path
from tidewire.sources import tables, topic_log
from tidewire.streaming import jobs
from tidewire.streaming.sinks import read_table

#: Records before this time are on the log at the first start, the rest arrive later.
SECOND_START = "TIMESTAMP_NTZ '2024-01-16 00:00:00'"


@register("src_earliest_resume", model("pub", "SELECT event_id, topic FROM pub"))
def src_earliest_resume(spark, folder):
    log, out, checkpoint = (fresh_path(spark, name) for name in ("log", "copy", "progress"))
    records = envelope.topic_records(tables.social_events(spark, folder, *ROUTED))
    early = F.expr(f"timestamp < {to_instant(SECOND_START)}")
    for arriving in (records.where(early), records.where(~early)):
        topic_log.append(arriving, log)
        jobs.drain(jobs.copy_job(topic_log.stream(spark, log), out, checkpoint))
    stored = codec.decode(read_table(spark, out), schemas.USER_ACTION, schemas.CONTENT_INTERACTION)
    return stored.select("event_id", "topic")


@register("src_latest_arrival", model("env", 'SELECT event_id, topic FROM env WHERE "offset" % 2 = 1'))
def src_latest_arrival(spark, folder):
    """A monitor that starts when half of the records, of all times, have arrived."""
    log, mark, out, checkpoint = (fresh_path(spark, name) for name in ("log", "mark", "copy", "progress"))
    records = envelope.topic_records(tables.social_events(spark, folder, *ROUTED))
    odd = F.col("offset") % 2 == 1
    topic_log.append(records.where(~odd), log)
    topic_log.mark_start(spark, log, mark)
    topic_log.append(records.where(odd), log)
    jobs.drain(jobs.copy_job(topic_log.stream_from_mark(spark, log, mark), out, checkpoint))
    stored = codec.decode(read_table(spark, out), schemas.USER_ACTION, schemas.CONTENT_INTERACTION)
    return stored.select("event_id", "topic")


@register("stream_engagement", model("judged", """
SELECT event_id, topic, partition, "offset", status, reason, attempts FROM judged"""))
def stream_engagement(spark, folder):
    log, out, checkpoint = (fresh_path(spark, name) for name in ("log", "outcomes", "progress"))
    topic_log.append(interaction_records(spark, folder), log)
    jobs.drain(jobs.engagement_job(
        topic_log.stream(spark, log, schemas.CONTENT_INTERACTIONS_TOPIC),
        tables.NOW,
        [tables.POISON_CONTENT_ID],
        out,
        checkpoint,
    ))
    return read_table(spark, out).select("event_id", "topic", "partition", "offset", "status", "reason", "attempts")


@register("fanout_two_queries", model("env", """
SELECT consumer, topic, partition, "offset" FROM env, (VALUES ('feed'), ('engagement')) AS c(consumer)
WHERE topic = 'content-interactions'"""))
def fanout_two_queries(spark, folder):
    log, feed_out, engagement_out = (fresh_path(spark, name) for name in ("log", "feed", "outcomes"))
    topic_log.append(interaction_records(spark, folder), log)
    topic = schemas.CONTENT_INTERACTIONS_TOPIC
    both = [
        jobs.feed_job(topic_log.stream(spark, log, topic), feed_out, fresh_path(spark, "progress")),
        jobs.engagement_job(
            topic_log.stream(spark, log, topic),
            tables.NOW,
            [tables.POISON_CONTENT_ID],
            engagement_out,
            fresh_path(spark, "progress"),
        ),
    ]
    try:
        for query in both:
            jobs.drain(query)
    finally:
        for query in both:
            query.stop()
    seen = [
        read_table(spark, path).select(F.lit(consumer).alias("consumer"), "topic", "partition", "offset")
        for consumer, path in (("feed", feed_out), ("engagement", engagement_out))
    ]
    return seen[0].unionByName(seen[1])


@register("stream_rate_snapshot", model("filled", f"""
SELECT topic, tick, rate, total, array_to_string(h, ',') AS history FROM ({_HISTORY})"""))
def stream_rate_snapshot(spark, folder):
    log, out, checkpoint = (fresh_path(spark, name) for name in ("log", "rates", "progress"))
    records = envelope.topic_records(tables.social_events(spark, folder, *ROUTED))
    newer = F.col("offset") >= 40
    halves = records.where(newer), records.where(~newer)
    # Two runs of the job: the second brings the older half of the records, which count all the same.
    for part in halves:
        topic_log.append(part, log)
        jobs.drain(jobs.rate_job(topic_log.stream(spark, log), out, checkpoint, TICK_SECONDS))
    return flat_history(rates.snapshots(jobs.stored_rates(spark, out), TICK_SECONDS))
