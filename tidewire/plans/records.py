"""Queries over sources, sinks, envelopes and projections."""

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidewire import schemas
from tidewire.functions import codec
from tidewire.functions import events as ev
from tidewire.operators import envelope, feed, outcomes, reconcile, validation
from tidewire.plans.oracle import NOW, REQUEST_VIOLATIONS, blank, model, utf16
from tidewire.plans.registry import register
from tidewire.session import fresh_path
from tidewire.sources import generators, tables, topic_log

#: Where the "read from latest" query starts.
LATEST_START = "2024-01-15 00:00:00"


#: Categories that reach a topic.
ROUTED = tuple(ev.ROUTES)


def published(spark: SparkSession, folder: str) -> DataFrame:
    return envelope.publishable(tables.social_events(spark, folder, *ROUTED))


def on_the_wire(spark: SparkSession, folder: str, category: str) -> DataFrame:
    events = envelope.publishable(tables.social_events(spark, folder, category))
    return events.selectExpr(f"{codec.encode(category)} AS value")


def interaction_records(spark: SparkSession, folder: str) -> DataFrame:
    """Records of the interactions topic. Offsets are per topic, so the other one is left out early."""
    return envelope.topic_records(tables.social_events(spark, folder, schemas.CONTENT_INTERACTION))


def judged(spark: SparkSession, folder: str) -> DataFrame:
    return outcomes.consume_engagement(
        interaction_records(spark, folder), tables.NOW, [tables.POISON_CONTENT_ID]
    )


@register("src_from_latest", model(
    "pub", f"SELECT event_id, topic FROM pub WHERE occurred_at > TIMESTAMP '{LATEST_START}'"))
def src_from_latest(spark, folder):
    return topic_log.from_latest(published(spark, folder), LATEST_START, "occurred_at").select("event_id", "topic")


@register("src_raw_counts", model("pub", "SELECT topic, count(*) AS n FROM pub GROUP BY topic"))
def src_raw_counts(spark, folder):
    return topic_log.arrivals(published(spark, folder))


@register("decode_user_action", model("pub", """
SELECT event_id, occurred_at, user_id, action_type, target_id FROM pub WHERE topic = 'user-actions'"""))
def decode_user_action(spark, folder):
    decoded = codec.decode(on_the_wire(spark, folder, schemas.USER_ACTION), schemas.USER_ACTION)
    return decoded.where(F.col("decode_error").isNull()).drop("decode_error")


@register("decode_interaction", model("pub", """
SELECT event_id, occurred_at, user_id, content_id, interaction_type FROM pub WHERE topic = 'content-interactions'"""))
def decode_interaction(spark, folder):
    decoded = codec.decode(on_the_wire(spark, folder, schemas.CONTENT_INTERACTION), schemas.CONTENT_INTERACTION)
    return decoded.where(F.col("decode_error").isNull()).drop("decode_error")


def _json(**fields: str) -> str:
    """DuckDB text of a JSON object; the values need no escapes."""
    parts = [f"""'"{name}":' || coalesce('"' || {value} || '"', 'null')""" for name, value in fields.items()]
    return "'{' || " + " || ',' || ".join(parts) + " || '}'"


#: Fractions of a second without their last zeros, and none without a fraction.
_ISO = "regexp_replace(strftime(occurred_at, '%Y-%m-%dT%H:%M:%S.%f'), '[.]?0*$', '') || 'Z'"
_HEAD = {"eventId": "event_id", "occurredAt": _ISO}
_SPAM = """CASE WHEN k % 3 = 0 THEN '{"reason":"spam"}' ELSE 'null' END"""
_SYSTEM_JSON = _json(**_HEAD, systemEventType="system_event_type", subjectId="subject_id")


@register("encode_event", model("typed", f"""
SELECT event_id, true AS equal, CASE category
  WHEN 'UserActionEvent' THEN {_json(**_HEAD, userId="user_id", actionType="action_type", targetId="target_id")}
  WHEN 'ContentInteractionEvent'
  THEN {_json(**_HEAD, userId="user_id", contentId="content_id", interactionType="interaction_type")}
  ELSE left({_SYSTEM_JSON}, -1) || ',"metadata":' || {_SPAM} || '}}' END AS value
FROM typed"""))
def encode_event(spark, folder):
    columns = list(dict.fromkeys(c for fields in schemas.WIRE_FIELDS.values() for c in fields.values()))
    sent = tables.social_events(spark, folder).selectExpr(
        f"struct({', '.join(columns)}) AS sent", f"{codec.encode_any()} AS value"
    )
    equal = f"decode_error IS NULL AND {ev.same_event('sent', columns)}"
    read = codec.decode(sent.withColumn("wire", F.col("value")))
    return read.selectExpr("sent.event_id", f"{equal} AS equal", "wire AS value")


@register("record_envelope", model("env", 'SELECT topic, event_id, key, partition, "offset" FROM env'))
def record_envelope(spark, folder):
    records = envelope.envelopes(tables.social_events(spark, folder, *ROUTED), "key")
    return records.select("topic", "event_id", "key", "partition", "offset")


@register("gen_engagement", """
SELECT event_id AS i, 'user-' || (event_id % 5) AS user_id, 'post-' || (event_id % 4) AS content_id,
       ['CONTENT_LIKED', 'CONTENT_COMMENTED', 'CONTENT_SHARED'][event_id % 3 + 1] AS interaction_type
FROM events
UNION ALL
SELECT max(event_id) + 1, 'user-0', 'post-BOOM', 'CONTENT_LIKED' FROM events""")
def gen_engagement(spark, folder):
    return generators.engagement_feed(tables.raw_events(spark, folder).select(F.col("event_id").alias("i")))


@register("gen_keyed_load", """
SELECT 'raw-demo-user-' || (event_id % 8) || '-' || (event_id // 8) AS key, 'raw-producer-demo-event' AS value
FROM events""")
def gen_keyed_load(spark, folder):
    return generators.keyed_load(tables.raw_events(spark, folder).select(F.col("event_id").alias("i")))


@register("publish_rows", model("pub", "SELECT topic, key, event_id FROM pub"))
def publish_rows(spark, folder):
    return published(spark, folder).select("topic", "key", "event_id")


@register("log_processed", model("judged", """
SELECT 'STRUCTURED_EVENT event=engagement-processed interactionType=' || interaction_type || ' userId=' || user_id
       || ' contentId=' || content_id || ' partition=' || partition || ' offset=' || "offset" AS line
FROM judged WHERE status = 'processed'"""))
def log_processed(spark, folder):
    return outcomes.processed_lines(judged(spark, folder))


@register("log_recovered", model("judged", """
SELECT 'STRUCTURED_ERROR event=engagement-processing-recovered topic=' || topic || ' partition=' || partition
       || ' offset=' || "offset" || ' key=' || key || ' reason=' || reason AS line
FROM judged WHERE status = 'recovered'"""))
def log_recovered(spark, folder):
    return outcomes.recovered_lines(judged(spark, folder))


@register("delivery_receipts", model("env", 'SELECT event_id, topic, partition, "offset" FROM env'))
def delivery_receipts(spark, folder):
    return envelope.delivery_receipts(envelope.envelopes(tables.social_events(spark, folder, *ROUTED)))


_POSTS = rf"""
WITH posts AS (
  SELECT printf('00000000-0000-4000-8000-%012x', doc_id) AS request_id,
         CASE WHEN doc_id % 25 <> 0 THEN 'user-' || (doc_id % 150) END AS user_id, text AS content
  FROM documents
),
valid AS (
  SELECT *, md5('event' || chr(31) || request_id) AS e, md5('post' || chr(31) || request_id) AS p,
         CAST(CAST('0x' || substr(md5(user_id), 1, 8) AS BIGINT) % 12 AS INTEGER) AS partition
  FROM posts WHERE user_id IS NOT NULL AND NOT {blank('content')} AND {utf16('content')} <= 2000
)"""


@register("post_receipts", _POSTS + f"""
SELECT substr(e,1,8)||'-'||substr(e,9,4)||'-'||substr(e,13,4)||'-'||substr(e,17,4)||'-'||substr(e,21,12) AS event_id,
       substr(p,1,8)||'-'||substr(p,9,4)||'-'||substr(p,13,4)||'-'||substr(p,17,4)||'-'||substr(p,21,12) AS post_id,
       {NOW} AS occurred_at, 'user-actions' AS topic, partition,
       row_number() OVER (PARTITION BY partition ORDER BY e) - 1 AS "offset"
FROM valid""")
def post_receipts(spark, folder):
    valid = validation.accepted(validation.with_post_request_violations(tables.post_requests(spark, folder)))
    posts = validation.enrich_posts(valid, tables.NOW).select(
        "event_id",
        "post_id",
        "occurred_at",
        F.lit(schemas.USER_ACTIONS_TOPIC).alias("topic"),
        F.expr(envelope.partition_of("user_id", "12")).alias("partition"),
    )
    return envelope.delivery_receipts(envelope.assign_offsets(posts), "post_id", "occurred_at")


_FEED_COLUMNS = 'topic, event_type, primary_key, detail, partition, "offset", occurred_at'


def _feed_envelopes(spark: SparkSession, folder: str, *categories: str) -> DataFrame:
    columns = ("category", "key", "user_id", "action_type", "target_id", "content_id", "interaction_type")
    return envelope.envelopes(tables.social_events(spark, folder, *categories), *columns)


@register("feed_user_actions", model("feed", f"SELECT {_FEED_COLUMNS} FROM feed WHERE topic = 'user-actions'"))
def feed_user_actions(spark, folder):
    return feed.action_items(_feed_envelopes(spark, folder, schemas.USER_ACTION))


@register("feed_interactions", model("feed", f"SELECT {_FEED_COLUMNS} FROM feed WHERE topic = 'content-interactions'"))
def feed_interactions(spark, folder):
    return feed.interaction_items(_feed_envelopes(spark, folder, schemas.CONTENT_INTERACTION))


@register("feed_union", model("feed", f"SELECT {_FEED_COLUMNS} FROM feed"))
def feed_union(spark, folder):
    return feed.feed_items(_feed_envelopes(spark, folder, *ROUTED))


@register("feed_by_stream", model("feed", """
SELECT topic AS stream_name, count(*) AS n, min("offset") AS min_offset, max("offset") AS max_offset
FROM feed GROUP BY topic"""))
def feed_by_stream(spark, folder):
    path = fresh_path(spark, "feed")
    feed.write_feed(feed.feed_from_records(envelope.topic_records(tables.social_events(spark, folder, *ROUTED))), path)
    panels = [
        feed.subscribe(spark, path, name)
        .groupBy("stream_name")
        .agg(F.count("*").alias("n"), F.min("offset").alias("min_offset"), F.max("offset").alias("max_offset"))
        for name in (schemas.USER_ACTIONS_TOPIC, schemas.CONTENT_INTERACTIONS_TOPIC)
    ]
    return panels[0].unionByName(panels[1])


@register("feed_rejects", model("feed", """
SELECT topic, partition, "offset", CASE "offset" % 50 WHEN 7 THEN 'null payload' ELSE 'undecodable value' END AS reason
FROM feed WHERE "offset" % 50 IN (7, 11, 13)"""))
def feed_rejects(spark, folder):
    # Of fifty records one has no value, one is cut off and one has an object where its user should be.
    records = envelope.topic_records(tables.social_events(spark, folder, *ROUTED))
    spoiled = F.expr("""CASE offset % 50 WHEN 7 THEN NULL WHEN 11 THEN left(value, length(value) - 1)
                        WHEN 13 THEN regexp_replace(value, '"userId":"[^"]*"', '"userId":{"id":1}') ELSE value END""")
    return feed.feed_rejects(records.withColumn("value", spoiled)).select("topic", "partition", "offset", "reason")


@register("panel_counts", model("pub", "SELECT topic AS stream_name, count(*) AS n FROM pub GROUP BY topic"))
def panel_counts(spark, folder):
    return feed.panel_counts(published(spark, folder))


@register("feed_last_200", model("feed", f"""
SELECT {_FEED_COLUMNS} FROM feed
QUALIFY row_number() OVER (PARTITION BY topic ORDER BY occurred_at DESC, event_id DESC) <= 200"""))
def feed_last_200(spark, folder):
    return feed.feed_items(feed.newest_with_offsets(published(spark, folder)))


@register("first_record", model("feed", f"""
SELECT {_FEED_COLUMNS} FROM feed ORDER BY topic, partition, "offset" LIMIT 1"""))
def first_record(spark, folder):
    return feed.feed_items(envelope.first_published(published(spark, folder)))


@register("event_type_of", model("typed", "SELECT event_id, event_type FROM typed"))
def event_type_of(spark, folder):
    return tables.social_events(spark, folder).selectExpr("event_id", f"{ev.EVENT_TYPE} AS event_type")


@register("category_dispatch", model("typed", """
SELECT event_id, CASE category WHEN 'UserActionEvent' THEN 'user-action'
                               WHEN 'ContentInteractionEvent' THEN 'content-interaction' ELSE 'system' END AS category
FROM typed"""))
def category_dispatch(spark, folder):
    events = tables.social_events(spark, folder)
    return events.selectExpr("event_id", f"{ev.category_name()} AS category")


@register("route_topic", model("pub", "SELECT event_id, topic FROM keyed"))
def route_topic(spark, folder):
    events = tables.social_events(spark, folder)
    return events.selectExpr("event_id", f"{ev.topic_of()} AS topic")


@register("describe_v1", model("leaf", """
SELECT event_id AS id, CASE event_type
  WHEN 'PostCreated' THEN 'user ' || user_id || ' created post ' || post_id
  WHEN 'PostDeleted' THEN 'user ' || user_id || ' deleted post ' || post_id
  WHEN 'ProfileUpdated' THEN 'user ' || user_id || ' updated ' || field_changed
  WHEN 'PostLiked' THEN 'user ' || user_id || ' liked post ' || post_id
  WHEN 'PostShared' THEN 'user ' || user_id || ' shared post ' || post_id || ' to ' || shared_to_user_id
  WHEN 'PostCommented' THEN 'user ' || user_id || ' commented on post ' || post_id
  WHEN 'ServiceHealthChanged' THEN 'service ' || service_name || ' is now ' || status
  WHEN 'RebalanceTriggered' THEN 'consumer group ' || consumer_group_id || ' reassigned '
       || partitions_reassigned || ' partitions' END AS description
FROM leaf"""))
def describe_v1(spark, folder):
    return tables.leaf_events(spark, folder).selectExpr("event_id AS id", f"{ev.describe_leaf()} AS description")


@register("describe_v2", model("typed", """
SELECT event_id AS id, category || ' [' || event_type || '] eventId=' || event_id AS description FROM typed"""))
def describe_v2(spark, folder):
    return tables.social_events(spark, folder).selectExpr("event_id AS id", f"{ev.describe_event()} AS description")


@register("enrich_request", model("req", f"""
SELECT substr(h,1,8)||'-'||substr(h,9,4)||'-'||substr(h,13,4)||'-'||substr(h,17,4)||'-'||substr(h,21,12) AS event_id,
       {NOW} AS occurred_at, user_id, action_type, target_id
FROM (
  SELECT *, md5(request_id || chr(31) || user_id || chr(31) || action_type || chr(31) || coalesce(target_id, '')) AS h
  FROM req WHERE {REQUEST_VIOLATIONS} = ''
)"""))
def enrich_request(spark, folder):
    requests = validation.accepted(validation.with_request_violations(tables.action_requests(spark, folder)))
    return validation.enrich_actions(requests, tables.NOW)


@register("topic_search", model("env", """
SELECT topic, partition, "offset" FROM env
WHERE key = 'user-99' AND action_type = 'USER_FOLLOWED'"""))
def topic_search(spark, folder):
    sent = envelope.publishable(tables.social_events(spark, folder, schemas.USER_ACTION))
    found = f"key = 'user-99' AND contains({codec.encode(schemas.USER_ACTION)}, 'USER_FOLLOWED')"
    return envelope.find_published(sent, found).select("topic", "partition", "offset")


@register("engagement_outcomes", model("judged", """
SELECT event_id, topic, partition, "offset", status, reason, attempts FROM judged"""))
def engagement_outcomes(spark, folder):
    return judged(spark, folder).select("event_id", "topic", "partition", "offset", "status", "reason", "attempts")


@register("outcome_counts", model("judged", "SELECT status, count(*) AS n FROM judged GROUP BY status"))
def outcome_counts(spark, folder):
    # Counting needs no offsets, so nothing is sorted or stored here.
    decoded = codec.decode(on_the_wire(spark, folder, schemas.CONTENT_INTERACTION), schemas.CONTENT_INTERACTION)
    unplaced = decoded.withColumn("offset", F.lit(None).cast("bigint"))
    return outcomes.outcome_counts(
        outcomes.engagement_outcomes(unplaced, tables.NOW, [tables.POISON_CONTENT_ID])
    )


@register("delivery_summary", model("pub", """
SELECT count(*) AS total, count(*) FILTER (WHERE k <> 13) AS acknowledged, count(*) FILTER (WHERE k = 13) AS failed,
       round(epoch_us(max(occurred_at) - min(occurred_at)) / 1e6, 6) AS elapsed_s,
       round(count(*) / (epoch_us(max(occurred_at) - min(occurred_at)) / 1e6), 6) AS per_s
FROM pub"""))
def delivery_summary(spark, folder):
    status = F.when(F.col("k") == 13, F.lit("failed")).otherwise(F.lit("ok"))
    return outcomes.delivery_summary(published(spark, folder).select("occurred_at", status.alias("status")))


@register("roundtrip_reconcile", model("pub", """
SELECT CASE WHEN k = 17 THEN 'lost' WHEN k = 23 THEN 'unexpected' ELSE 'matched' END AS status, count(*) AS n
FROM pub GROUP BY 1"""))
def roundtrip_reconcile(spark, folder):
    events = published(spark, folder)
    return reconcile.roundtrip_counts(events.where("k != 23"), events.where("k != 17"))


@register("feed_reconcile", model("feed", """
SELECT topic, count(*) FILTER (WHERE "offset" % 50 IN (7, 11)) AS mismatches FROM feed GROUP BY topic"""))
def feed_reconcile(spark, folder):
    # The same records once through the wire format and once as they were. One row in fifty is served with
    # another detail and one is not served at all, so that there is something to find.
    placed = _feed_envelopes(spark, folder, *ROUTED)
    served = feed.feed_from_records(envelope.as_topic_records(placed.where("offset % 50 != 11")))
    changed = F.when(F.expr("offset % 50 = 7"), F.lit("changed")).otherwise(F.col("detail"))
    return reconcile.feed_mismatches(served.withColumn("detail", changed), feed.feed_items(placed))


@register("key_order_audit", model("env", """
SELECT topic, key, CAST(count(DISTINCT partition) AS BIGINT) AS partitions,
       CAST(count(*) FILTER (WHERE before > moment) AS BIGINT) AS inversions
FROM (SELECT *, lag(moment) OVER (PARTITION BY topic, key, partition ORDER BY placed) AS before
      FROM (SELECT *, {'at': occurred_at, 'id': event_id} AS moment,
                   CASE WHEN "offset" % 10 < 8 THEN "offset" // 10 * 10 + 7 - "offset" % 10 ELSE "offset" END AS placed
            FROM env))
GROUP BY topic, key"""))
def key_order_audit(spark, folder):
    # Of every ten records of a partition eight are put down in reverse, so that there is something to find.
    placed = envelope.envelopes(tables.social_events(spark, folder, *ROUTED), "key")
    turned = F.expr("IF(offset % 10 < 8, offset div 10 * 10 + 7 - offset % 10, offset)")
    return envelope.key_order_audit(placed.withColumn("offset", turned))
