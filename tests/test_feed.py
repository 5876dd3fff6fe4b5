from datetime import timedelta

import pytest
from conftest import NOW, action, interaction
from pyspark.sql import functions as F

from tidewire.operators import envelope, feed, reconcile


@pytest.fixture
def log(events):
    rows = [action(user_id=f"user-{i}", occurred_at=NOW + timedelta(seconds=i)) for i in range(20)]
    rows += [interaction(content_id=f"post-{i % 3}", user_id=" " if i == 0 else "user-1") for i in range(10)]
    rows += [action(action_type="PROFILE_UPDATED", target_id=None)]
    return envelope.topic_records(events(*rows))


def test_feed_items(log):
    items = feed.feed_from_records(log)
    assert items.columns == ["topic", "event_type", "primary_key", "detail", "partition", "offset", "occurred_at"]
    profile = items.where("event_type = 'PROFILE_UPDATED'").first()
    assert (profile.topic, profile.primary_key, profile.detail) == ("user-actions", "user-42", "-")
    liked = items.where("topic = 'content-interactions'").collect()
    assert {r.detail for r in liked} == {"post-0", "post-1", "post-2"}
    # The feed has no validation: the interaction of a blank user shows.
    assert any(r.primary_key == " " for r in liked)


def test_both_ways_to_the_feed_agree(events):
    rows = events(action(), interaction(), action(action_type="PROFILE_UPDATED", target_id=None))
    placed = envelope.envelopes(rows, "user_id", "action_type", "target_id", "content_id", "interaction_type")
    typed = feed.union_feed(placed.where("topic = 'user-actions'"), placed.where("topic = 'content-interactions'"))
    served = feed.feed_from_records(envelope.topic_records(rows))
    assert typed.exceptAll(served).isEmpty() and served.exceptAll(typed).isEmpty()
    assert [r.mismatches for r in reconcile.feed_mismatches(served, typed).collect()] == [0, 0]


def test_feed_mismatches_see_changed_and_unknown_rows(log):
    items = feed.feed_from_records(log)
    changed = items.withColumn("detail", F.when(F.col("primary_key") == "user-3", "x").otherwise(F.col("detail")))
    unknown = changed.withColumn("offset", F.when(F.col("primary_key") == "user-5", 999).otherwise(F.col("offset")))
    got = {r.topic: r.mismatches for r in reconcile.feed_mismatches(unknown, items).collect()}
    # The moved row counts twice: where it now is there is no source, and where it was nothing is served.
    assert got == {"user-actions": 3, "content-interactions": 0}
    without = items.where("primary_key != 'user-7'")
    got = {r.topic: r.mismatches for r in reconcile.feed_mismatches(without, items).collect()}
    assert got == {"user-actions": 1, "content-interactions": 0}


def test_newest_rows_per_stream(log):
    items = feed.feed_from_records(log)
    newest = feed.newest_per_stream(items, size=5, newest_by=("occurred_at", "offset", "partition"))
    assert {r.stream_name: r.n for r in feed.panel_counts(newest).collect()} == {
        "user-actions": 5, "content-interactions": 5
    }
    kept = {r.primary_key for r in newest.where("topic = 'user-actions'").collect()}
    assert kept == {f"user-{i}" for i in range(15, 20)}
    plan = newest._jdf.queryExecution().executedPlan().toString()
    assert "WindowGroupLimit" in plan


def test_newest_rows_of_a_hot_stream_beyond_the_group_limit(spark):
    rows = spark.range(0, 30_000, 1, 12).selectExpr("IF(id % 10 = 0, 'cold', 'hot') AS topic", "id")
    newest = feed.newest_per_stream(rows, size=2000, newest_by=("id",))
    got = {r.topic: (r.n, r.least) for r in newest.groupBy("topic").agg(
        F.count("*").alias("n"), F.min("id").alias("least")).collect()}
    hot = [i for i in range(30_000) if i % 10][-2000:]
    assert got == {"hot": (2000, hot[0]), "cold": (2000, 10_000)}
    assert newest._jdf.queryExecution().executedPlan().toString().count("Window [") >= 3


def test_newest_and_first_records_know_their_offsets_without_numbering_the_topic(events):
    rows = [action(user_id=f"user-{i % 7}", occurred_at=NOW + timedelta(seconds=i * 31 % 97)) for i in range(60)]
    sent = envelope.publishable(events(*rows, interaction()))
    numbered = {r.event_id: r.offset for r in envelope.assign_offsets(sent).collect()}
    newest = feed.newest_with_offsets(sent, size=20)
    got = newest.collect()
    assert len(got) == 21 and all(numbered[r.event_id] == r.offset for r in got)
    first = envelope.first_published(sent)
    wanted = envelope.first_record(envelope.assign_offsets(sent)).first()
    assert (first.first().event_id, first.first().offset) == (wanted.event_id, wanted.offset)
    for plan in (newest, first):
        text = plan._jdf.queryExecution().executedPlan().toString()
        assert "rangepartitioning" not in text and "parquet" not in text.lower()


def test_panel_smaller_than_its_size_keeps_everything(log):
    items = feed.feed_from_records(log)
    assert feed.newest_per_stream(items).count() == items.count() == 31


def test_subscriber_reads_only_its_stream(spark, log, tmp_path):
    path = str(tmp_path / "feed")
    feed.write_feed(feed.feed_from_records(log), path)
    mine = feed.subscribe(spark, path, "content-interactions")
    assert mine.count() == 10
    assert "PartitionFilters: [isnotnull(stream_name" in mine._jdf.queryExecution().executedPlan().toString()
    assert feed.subscribe(spark, path, "nobody").count() == 0


def test_roundtrip_statuses_and_duplicates(spark):
    sent = spark.createDataFrame([("a",), ("b",), ("b",), ("c",)], "event_id string")
    seen = spark.createDataFrame([("a",), ("a",), ("a",), ("b",), ("z",)], "event_id string")
    got = {r.event_id: r.status for r in reconcile.roundtrip(sent, seen).collect()}
    assert got == {"a": "matched", "b": "matched", "c": "lost", "z": "unexpected"}
    counts = {r.status: r.n for r in reconcile.roundtrip_counts(sent, seen).collect()}
    assert counts == {"matched": 2, "lost": 1, "unexpected": 1}
