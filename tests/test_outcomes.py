import json
from datetime import datetime, timedelta

from conftest import NOW, interaction
from pyspark.sql import functions as F

from tidewire import schemas
from tidewire.functions.text import numbered_uuid
from tidewire.operators import envelope, feed, outcomes
from tidewire.sources import generators

POISON = ["post-BOOM"]


def generated(spark, now, n=14):
    """Topic records of a generator run."""
    made = generators.engagement_feed(spark.range(n).withColumnRenamed("id", "i"))
    events = made.select(
        F.expr(numbered_uuid("i")).alias("event_id"),
        F.expr(now).alias("occurred_at"),
        F.lit(schemas.CONTENT_INTERACTION).alias("category"),
        "user_id",
        F.lit(None).cast("string").alias("action_type"),
        F.lit(None).cast("string").alias("target_id"),
        "content_id",
        "interaction_type",
        F.lit(None).cast("string").alias("system_event_type"),
        F.lit(None).cast("string").alias("subject_id"),
        F.lit(None).cast("map<string,string>").alias("metadata"),
    )
    return envelope.topic_records(events)


def test_generator_rows(spark):
    rows = generators.engagement_feed(spark.range(14).withColumnRenamed("id", "i")).orderBy("i").collect()
    assert len(rows) == 15
    types = schemas.INTERACTION_TYPES
    assert all((r.user_id, r.content_id, r.interaction_type) == (f"user-{i % 5}", f"post-{i % 4}", types[i % 3])
               for i, r in enumerate(rows[:14]))
    assert tuple(rows[14]) == (14, "user-0", "post-BOOM", "CONTENT_LIKED")


def test_keyed_load(spark):
    rows = generators.keyed_load(spark.range(4000).withColumnRenamed("id", "i")).collect()
    assert {r.key for r in rows} == {f"raw-demo-user-{t}-{i}" for t in range(8) for i in range(500)}
    assert {r.value for r in rows} == {"raw-producer-demo-event"}


def test_generator_run_processes_fourteen_recovers_one_and_feeds_fifteen(spark, now):
    log = generated(spark, now)
    judged = outcomes.consume_engagement(log, now, POISON)
    assert {r.status: r.n for r in outcomes.outcome_counts(judged).collect()} == {"processed": 14, "recovered": 1}
    assert feed.feed_from_records(log).count() == 15


def test_keyed_load_is_quarantined_not_lost(spark, now):
    load = generators.keyed_load(spark.range(40).withColumnRenamed("id", "i")).select(
        F.lit("content-interactions").alias("topic"), F.lit(0).alias("partition"),
        F.monotonically_increasing_id().alias("offset"), "key", "value",
    )
    judged = outcomes.consume_engagement(load, now, POISON).collect()
    assert len(judged) == 40
    assert {(r.status, r.reason, r.attempts) for r in judged} == {("recovered", "undecodable value", 3)}


def test_reasons_attempts_and_lines(spark, events, now):
    rows = events(
        interaction(),
        interaction(content_id="post-BOOM"),
        interaction(content_id="post-BOOM", user_id=" ", occurred_at=NOW + timedelta(days=1)),
    ).withColumns({
        "topic": F.lit("content-interactions"), "partition": F.lit(2), "key": F.col("content_id"),
        "offset": F.substring("event_id", -1, 1).cast("bigint"), "decode_error": F.lit(None).cast("string"),
    })
    judged = outcomes.engagement_outcomes(rows, now, POISON)
    good, poison, invalid = judged.orderBy("offset").collect()
    assert (good.status, good.reason, good.attempts) == ("processed", None, 1)
    assert (poison.status, poison.attempts) == ("recovered", 3)
    assert poison.reason == "simulated processing failure for post-BOOM"
    assert invalid.reason == (
        "invalid ContentInteractionEvent at offset 2: "
        "occurredAt=must be a date in the past or in the present;userId=must not be blank"
    )
    assert [r.line for r in outcomes.processed_lines(judged).collect()] == [
        "STRUCTURED_EVENT event=engagement-processed interactionType=CONTENT_LIKED userId=user-7 "
        "contentId=post-normal partition=2 offset=0"
    ]
    lines = sorted(r.line for r in outcomes.recovered_lines(judged).collect())
    assert lines[0] == (
        "STRUCTURED_ERROR event=engagement-processing-recovered topic=content-interactions partition=2 offset=1 "
        "key=post-BOOM reason=simulated processing failure for post-BOOM"
    )
    assert len(lines) == 2


def test_missing_values_print_as_null(events, now):
    rows = events(interaction(user_id=None)).withColumns({
        "topic": F.lit("content-interactions"), "partition": F.lit(0), "key": F.lit(None).cast("string"),
        "offset": F.lit(0), "decode_error": F.lit(None).cast("string"),
    })
    line = outcomes.recovered_lines(outcomes.engagement_outcomes(rows, now, POISON)).first().line
    assert " key=null reason=invalid" in line


def test_delivery_summary(spark):
    start = datetime(2024, 1, 1)
    rows = [(start + timedelta(days=1, milliseconds=500) if i == 9 else start, "failed" if i == 3 else "ok")
            for i in range(10)]
    got = outcomes.delivery_summary(spark.createDataFrame(rows, "occurred_at timestamp_ntz, status string")).first()
    assert (got.total, got.acknowledged, got.failed, got.elapsed_s) == (10, 9, 1, 86400.5)
    assert got.per_s == round(10 / 86400.5, 6)
    instant = outcomes.delivery_summary(spark.createDataFrame(rows[:1], "occurred_at timestamp_ntz, status string"))
    assert instant.first().per_s is None


def test_wire_text_of_a_record_is_plain_json(spark, now):
    value = generated(spark, now, 1).where("key = 'post-0'").first().value
    assert json.loads(value) == {
        "eventId": "00000000-0000-4000-8000-000000000000", "occurredAt": "2024-01-30T00:00:00Z",
        "userId": "user-0", "contentId": "post-0", "interactionType": "CONTENT_LIKED",
    }
