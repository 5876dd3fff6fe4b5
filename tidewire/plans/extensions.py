"""Queries over copies, skew, trends, table views and dead letters."""

from pyspark.sql import functions as F

from tidewire import schemas
from tidewire.functions import codec
from tidewire.operators import catalog, dead_letters, dedup, envelope, outcomes, skew, trends, views
from tidewire.plans.oracle import model
from tidewire.plans.records import ROUTED, interaction_records
from tidewire.plans.registry import register
from tidewire.session import fresh_path, state_in_rocksdb
from tidewire.sources import tables, topic_log
from tidewire.streaming import compaction, jobs, ordering
from tidewire.streaming.sinks import read_table

HORIZON = 600
#: When the catalog's second edition holds.
SECOND_EDITION = "2024-01-16 00:00:00"


def _with_copies(spark, folder):
    """Events, copies of some of them nine minutes later, and of some two days later."""
    events = tables.social_events(spark, folder).withColumn("sent", F.lit("first"))
    near = events.where("k % 7 = 0").selectExpr("* EXCEPT (occurred_at, sent)", "occurred_at + INTERVAL 9 MINUTES AS occurred_at", "'near' AS sent")
    far = events.where("k % 11 = 0").selectExpr("* EXCEPT (occurred_at, sent)", "occurred_at + INTERVAL 2 DAYS AS occurred_at", "'far' AS sent")
    return events.unionByName(near).unionByName(far)


@register("dedup_events", model("typed", """
SELECT event_id, occurred_at, 'first' AS sent FROM typed
UNION ALL SELECT event_id, occurred_at + INTERVAL 2 DAYS, 'far' FROM typed WHERE k % 11 = 0"""))
def dedup_events(spark, folder):
    return dedup.drop_copies(_with_copies(spark, folder), HORIZON).select("event_id", "occurred_at", "sent")


@register("stream_dedup_events", model("typed", """
SELECT event_id, sent FROM typed, (VALUES ('first'), ('far')) AS s(sent) WHERE sent = 'first' OR k % 11 = 0"""))
def stream_dedup_events(spark, folder):
    """Three runs of one job: the events with near copies, a record that moves the watermark on, and late copies."""
    log, out, checkpoint = (fresh_path(spark, name) for name in ("log", "distinct", "progress"))
    columns = ("event_id", "sent", "timestamp")
    sent = _with_copies(spark, folder).select("event_id", "sent", "occurred_at", "k")
    first = sent.where("sent <> 'far'").selectExpr("event_id", "'first' AS sent", "CAST(occurred_at AS TIMESTAMP) AS timestamp")
    later = sent.where("sent = 'first' AND k % 11 = 0").selectExpr(
        "event_id", "'far' AS sent", "CAST(occurred_at + INTERVAL 90 DAYS AS TIMESTAMP) AS timestamp")
    mark = first.agg(F.max("timestamp").alias("timestamp")).selectExpr(
        "'mark' AS event_id", "'mark' AS sent", "timestamp + INTERVAL 30 DAYS AS timestamp")
    for part in (first, mark, later):
        part.select(*columns).write.mode("append").parquet(log)
        stream = spark.readStream.schema(part.select(*columns).schema).parquet(log)
        jobs.drain(jobs.copy_job(dedup.drop_copies_stream(stream, HORIZON), out, checkpoint))
    return read_table(spark, out).where("sent <> 'mark'").select("event_id", "sent")


@register("partition_skew", model("pub", """
SELECT topic, count(*) AS partitions, CAST(sum(n) AS BIGINT) AS records, max(n) AS largest,
       round(sum(n) / count(*), 6) AS mean, round(max(n) * count(*) / sum(n), 6) AS skew
FROM (SELECT topic, partition, count(*) AS n FROM pub GROUP BY ALL) GROUP BY topic"""))
def partition_skew(spark, folder):
    return skew.partition_skew(envelope.envelopes(tables.social_events(spark, folder, *ROUTED), "key"))


@register("hot_keys", model("pub", """
SELECT topic, key, n, round(n / total, 6) AS share, CAST(ceil(n / (0.01 * total)) AS BIGINT) AS salts
FROM (SELECT topic, key, count(*) AS n FROM pub GROUP BY ALL) JOIN (
  SELECT topic, count(*) AS total FROM pub GROUP BY ALL) USING (topic)
WHERE n >= 0.01 * total"""))
def hot_keys(spark, folder):
    published = envelope.publishable(tables.social_events(spark, folder, *ROUTED))
    return skew.hot_keys(published, 0.01)


@register("trending_content", model("typed", """
SELECT start, rank, content_id, n FROM (
  SELECT *, row_number() OVER (PARTITION BY start ORDER BY n DESC, content_id) AS rank
  FROM (
    SELECT time_bucket(INTERVAL 6 HOURS, occurred_at, TIMESTAMP '2024-01-01') - to_hours(CAST(6 * back AS INTEGER)) AS start,
           content_id, count(*) AS n
    FROM typed, range(4) AS b(back) WHERE content_id IS NOT NULL GROUP BY ALL
  )
) WHERE rank <= 5"""))
def trending_content(spark, folder):
    events = tables.social_events(spark, folder, schemas.CONTENT_INTERACTION)
    found = trends.trending(events, "content_id", 5, 24 * 3600, 6 * 3600)
    return found.withColumnRenamed("item", "content_id").withColumn("rank", F.col("rank").cast("long"))


def _catalog_changes(spark):
    """The catalog as a change log: every entry, and a second edition of those with an even place."""
    entries = catalog.taxonomy(spark).withColumn("since", F.lit("2023-01-01").cast("timestamp_ntz"))
    second = entries.where("ordinal % 2 = 0").withColumn("description", F.concat(F.lit("2nd: "), "description")).withColumn(
        "since", F.lit(SECOND_EDITION).cast("timestamp_ntz"))
    return entries.unionByName(second).select("event_type", "description", "since")


_EDITIONS = ", ".join(
    f"('{kind}', '{text}', {place})" for place, (_, kind, text) in enumerate(catalog.TAXONOMY, start=1))


@register("stream_catalog_join", model("pub", f"""
SELECT event_id, pub.event_type,
       CASE WHEN place % 2 = 0 AND occurred_at >= TIMESTAMP '{SECOND_EDITION}' THEN '2nd: ' ELSE '' END || text AS description
FROM pub JOIN (VALUES {_EDITIONS}) AS c(event_type, text, place) ON c.event_type = pub.event_type"""))
def stream_catalog_join(spark, folder):
    log, out, checkpoint = (fresh_path(spark, name) for name in ("log", "joined", "progress"))
    events = envelope.publishable(tables.social_events(spark, folder, *ROUTED)).select("event_id", "event_type", "occurred_at")
    events.write.parquet(log)
    spans = views.valid_spans(_catalog_changes(spark), "event_type", "since")
    stream = spark.readStream.schema(events.schema).parquet(log)
    jobs.drain(jobs.copy_job(views.with_catalog_version(stream, spans, "event_type", "occurred_at"), out, checkpoint))
    return read_table(spark, out).select("event_id", "event_type", "description")


@register("user_table_view", model("typed", """
SELECT user_id, action_type, target_id, occurred_at FROM typed WHERE category = 'UserActionEvent'
QUALIFY row_number() OVER (PARTITION BY user_id ORDER BY occurred_at DESC, event_id DESC) = 1"""))
def user_table_view(spark, folder):
    actions = tables.social_events(spark, folder, schemas.USER_ACTION)
    changes = actions.select("user_id", "occurred_at", "event_id", "action_type", "target_id")
    return views.latest_by_key(changes, "user_id", "occurred_at", "event_id").select(
        "user_id", "action_type", "target_id", "occurred_at")


@register("interaction_user_state", model("typed", """
SELECT i.event_id, a.action_type AS last_action, a.target_id AS last_target
FROM (SELECT * FROM typed WHERE category = 'ContentInteractionEvent') i ASOF LEFT JOIN (
  SELECT * FROM typed WHERE category = 'UserActionEvent'
  QUALIFY row_number() OVER (PARTITION BY user_id, occurred_at ORDER BY event_id DESC) = 1
) a ON a.user_id = i.user_id AND a.occurred_at <= i.occurred_at"""))
def interaction_user_state(spark, folder):
    actions = tables.social_events(spark, folder, schemas.USER_ACTION).selectExpr(
        "user_id", "occurred_at AS acted_at", "event_id AS action_id", "action_type", "target_id")
    seen = tables.social_events(spark, folder, schemas.CONTENT_INTERACTION).select("event_id", "user_id", "occurred_at")
    found = views.as_of_join(seen, actions, "user_id", "occurred_at", "acted_at", ["action_id"], 24 * 3600)
    return found.selectExpr("event_id", "version.action_type AS last_action", "version.target_id AS last_target")


@register("dead_letters", model("judged", f"""
SELECT event_id, topic, partition, "offset", reason, CAST(3 AS INTEGER) AS attempts, CAST(0 AS INTEGER) AS round, 'sent on' AS fate
FROM judged WHERE status = 'recovered' AND found = ''
UNION ALL
SELECT event_id, topic, partition, "offset", reason, CAST(3 * (r + 1) AS INTEGER), CAST(r AS INTEGER),
       CASE WHEN r < 2 THEN 'sent on' ELSE 'dead' END
FROM judged, range(3) AS t(r) WHERE status = 'recovered' AND found <> ''"""))
def dead_letters_query(spark, folder):
    """Letters of three rounds. Before the second, the poison is cured; each round is run twice, which changes nothing."""
    graves, ledger = fresh_path(spark, "letters"), fresh_path(spark, "ledger")
    sent = interaction_records(spark, folder)
    judged = outcomes.consume_engagement(sent, tables.NOW, [tables.POISON_CONTENT_ID])
    dead_letters.bury(dead_letters.letters(sent, judged), graves, "0")
    for run in ("1", "2"):
        for _ in range(2):
            again = dead_letters.redrive(spark, graves, ledger, run, most_rounds=2)
            judged = outcomes.consume_engagement(again.select(*schemas.TOPIC_RECORD.fieldNames()), tables.NOW, [])
            dead_letters.bury(dead_letters.letters(again.drop("reason", "attempts", "round"), judged, again), graves, run)
    sent_on = spark.read.schema(dead_letters.LETTER).parquet(ledger).select("topic", "partition", "offset", "round").withColumn(
        "fate", F.lit("sent on"))
    every = dead_letters.buried(spark, graves).join(sent_on, ["topic", "partition", "offset", "round"], "left")
    return every.selectExpr(
        "get_json_object(value, '$.eventId') AS event_id", "topic", "partition", "offset", "reason", "attempts", "round",
        "coalesce(fate, 'dead') AS fate")


@register("stream_compacted_feed", model("feed", 'SELECT topic, event_type, primary_key, detail, partition, "offset" FROM feed'))
def stream_compacted_feed(spark, folder):
    """The feed of a job that ran in three parts, its first batches compacted and their folders deleted."""
    log, out, checkpoint = (fresh_path(spark, name) for name in ("log", "feed", "progress"))
    records = envelope.topic_records(tables.social_events(spark, folder, *ROUTED))
    for part in range(3):
        topic_log.append(records.where(F.col("offset") % 3 == part), log)
        jobs.drain(jobs.feed_job(topic_log.stream(spark, log), out, checkpoint))
    compaction.compact(spark, out, "stream_name")
    compaction.vacuum(spark, out)
    return read_table(spark, out).select("topic", "event_type", "primary_key", "detail", "partition", "offset")


@register("stream_in_order", model("env", """
SELECT topic, partition, "offset", event_id FROM env WHERE topic = 'user-actions'"""))
def stream_in_order(spark, folder):
    """Records that arrive by falling offset, those of each third offset twice, leave in order and once."""
    log, out, checkpoint = (fresh_path(spark, name) for name in ("log", "ordered", "progress"))
    records = envelope.topic_records(tables.social_events(spark, folder, schemas.USER_ACTION))
    for part in (F.col("offset") % 3 > 0, F.col("offset") % 3 == 0, F.col("offset") % 3 == 0):
        topic_log.append(records.where(part).orderBy(F.desc("offset")), log)
        stream = ordering.in_order(topic_log.stream(spark, log, schemas.USER_ACTIONS_TOPIC), most=None)
        with state_in_rocksdb(spark):
            jobs.drain(jobs.copy_job(stream, out, checkpoint))
    stored = codec.decode(read_table(spark, out).where("missing = 0"), schemas.USER_ACTION)
    return stored.select("topic", "partition", "offset", "event_id")
