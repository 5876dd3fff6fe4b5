import time
from datetime import timedelta

import pytest
from conftest import NOW, action, interaction
from pyspark.sql import functions as F

from tidewire.operators import envelope, feed, outcomes, rates
from tidewire.sources import topic_log
from tidewire.streaming import jobs
from tidewire.streaming.meter import meter
from tidewire.streaming.sinks import read_table, table_sink, with_retries

POISON = ["post-BOOM"]


@pytest.fixture
def records(events):
    rows = [interaction(content_id=f"post-{i % 4}", occurred_at=NOW - timedelta(seconds=100 - i)) for i in range(40)]
    rows += [interaction(content_id="post-BOOM"), interaction(user_id=" "), action(), action(user_id="user-1")]
    return envelope.topic_records(events(*rows))


def same(left, right):
    return left.exceptAll(right).isEmpty() and right.exceptAll(left).isEmpty()


def test_log_reads_back_and_prunes_topics(spark, records, tmp_path):
    path = str(tmp_path / "log")
    topic_log.append(records, path)
    assert same(topic_log.read(spark, path).select(*records.columns), records)
    mine = topic_log.read(spark, path, "user-actions")
    assert mine.count() == 2
    assert "PartitionFilters: [isnotnull(topic" in mine._jdf.queryExecution().executedPlan().toString()
    assert {r.topic: r.n for r in topic_log.arrivals(records).collect()} == {
        "content-interactions": 42, "user-actions": 2
    }


def test_latest_skips_what_was_there_before(spark, records, tmp_path):
    path = str(tmp_path / "log")
    topic_log.append(records, path)
    start = str(NOW - timedelta(seconds=70))
    late = topic_log.read(spark, path, after=start)
    assert 0 < late.count() < records.count()
    assert late.where(F.col("timestamp") <= F.lit(start).cast("timestamp")).isEmpty()


def test_monitor_stream_never_replays(spark, records, tmp_path):
    log = str(tmp_path / "log")
    topic_log.append(records, log)
    start = str(NOW - timedelta(seconds=70))
    monitor = topic_log.stream(spark, log, after=start)
    jobs.drain(jobs.copy_job(monitor, str(tmp_path / "out"), str(tmp_path / "p")))
    seen = read_table(spark, str(tmp_path / "out"))
    assert same(seen.select(*records.columns), topic_log.from_latest(records, start))
    assert 0 < seen.count() < records.count()


def test_stream_equals_batch_over_many_batches(spark, records, now, tmp_path):
    log, out = str(tmp_path / "log"), str(tmp_path / "out")
    topic_log.append(records.repartition(5), log)
    stream = topic_log.stream(spark, log, "content-interactions", files_per_batch=1)
    lines = str(tmp_path / "lines")
    jobs.drain(jobs.engagement_job(stream, now, POISON, out, str(tmp_path / "progress"), log_path=lines))
    stored = read_table(spark, out)
    judged = outcomes.consume_engagement(records, now, POISON)
    expected = outcomes.processed_lines(judged).unionByName(outcomes.recovered_lines(judged))
    assert same(spark.read.text(lines).select(F.col("value").alias("line")), expected)
    assert stored.select("batch_id").distinct().count() > 1
    columns = ["event_id", "partition", "offset", "status", "reason", "attempts"]
    assert same(stored.select(*columns), outcomes.consume_engagement(records, now, POISON).select(*columns))
    assert stored.where("status = 'recovered'").count() == 2


def test_consumers_of_one_topic_each_see_every_record(spark, records, now, tmp_path):
    log = str(tmp_path / "log")
    topic_log.append(records, log)
    first = jobs.feed_job(topic_log.stream(spark, log), str(tmp_path / "feed"), str(tmp_path / "p1"))
    second = jobs.copy_job(topic_log.stream(spark, log), str(tmp_path / "copy"), str(tmp_path / "p2"))
    for query in (first, second):
        jobs.drain(query)
    served = read_table(spark, str(tmp_path / "feed")).drop("batch_id", "stream_name")
    assert same(served.select(*feed.feed_from_records(records).columns), feed.feed_from_records(records))
    assert read_table(spark, str(tmp_path / "copy")).count() == records.count()


def test_feed_puts_aside_what_it_cannot_read(spark, records, tmp_path):
    log, out, aside, progress = (str(tmp_path / name) for name in ("log", "feed", "rejects", "progress"))
    spoiled = records.withColumn("value", F.expr("CASE WHEN offset % 3 = 0 THEN left(value, 9) ELSE value END"))
    topic_log.append(spoiled, log)
    for _ in range(2):  # a second run finds nothing new
        jobs.drain(jobs.feed_job(topic_log.stream(spark, log), out, progress, rejects_path=aside))
    items, rejects = read_table(spark, out), read_table(spark, aside)
    wanted = feed.feed_rejects(spoiled)
    assert same(items.select(*feed.feed_from_records(spoiled).columns), feed.feed_from_records(spoiled))
    assert rejects.count() > 0 and same(rejects.select(*wanted.columns), wanted)
    assert items.count() + rejects.count() == records.count()


def test_restart_resumes_where_it_stopped(spark, records, tmp_path):
    log, out, progress = (str(tmp_path / name) for name in ("log", "out", "progress"))

    def run():
        jobs.drain(jobs.copy_job(topic_log.stream(spark, log), out, progress))
        return read_table(spark, out)

    topic_log.append(records.where("offset < 4"), log)
    first = run().count()
    assert first == records.where("offset < 4").count()
    assert run().count() == first
    topic_log.append(records.where("offset >= 4"), log)
    everything = run()
    assert same(everything.select(*records.columns), records)


def test_a_fresh_checkpoint_starts_from_earliest(spark, records, tmp_path):
    log, out = str(tmp_path / "log"), str(tmp_path / "out")
    topic_log.append(records, log)
    for name in ("p1", "p2"):
        jobs.drain(jobs.copy_job(topic_log.stream(spark, log), f"{out}-{name}", str(tmp_path / name)))
        assert read_table(spark, f"{out}-{name}").count() == records.count()


def test_replayed_batch_leaves_no_copies(spark, records, tmp_path):
    out = str(tmp_path / "out")
    sink = table_sink(out, "topic")
    for _ in range(2):
        sink(records, 0)
    sink(records.limit(3), 1)
    assert read_table(spark, out).count() == records.count() + 3


def test_sink_failures_are_retried_then_recovered(spark):
    calls, lost = [], []

    def flaky(batch, batch_id):
        calls.append(batch_id)
        if batch_id == 1 and calls.count(1) == 3:
            return
        raise OSError("sink is away")

    run = with_retries(flaky, lambda batch, batch_id, failure: lost.append((batch_id, str(failure))), wait_seconds=0)
    run(None, 1)
    assert calls == [1, 1, 1] and not lost
    run(None, 2)
    assert calls == [1, 1, 1, 2, 2, 2] and lost == [(2, "sink is away")]
    with pytest.raises(OSError):
        with_retries(flaky, wait_seconds=0)(None, 3)


def test_transform_and_sink_can_be_the_callers(spark, records, tmp_path):
    log, seen = str(tmp_path / "log"), []
    topic_log.append(records, log)
    jobs.drain(jobs.transform_job(
        topic_log.stream(spark, log), lambda df: df.where("topic = 'user-actions'").select("key"),
        lambda batch, batch_id: seen.extend(r.key for r in batch.collect()), str(tmp_path / "p"),
    ))
    assert sorted(seen) == ["user-1", "user-42"]


def test_event_time_rates_equal_the_batch(spark, records, tmp_path):
    log, out, progress = (str(tmp_path / name) for name in ("log", "out", "progress"))
    early = F.col("timestamp") < F.lit(str(NOW - timedelta(seconds=75))).cast("timestamp")
    # Two runs on one checkpoint: the second adds to a tick the first has counted.
    for part in (records.where(early), records.where(~early)):
        topic_log.append(part, log)
        jobs.drain(jobs.rate_job(topic_log.stream(spark, log), out, progress, tick_seconds=20))
    timed = records.withColumn("occurred_at", F.col("timestamp").cast("timestamp_ntz"))
    expected = rates.snapshots(rates.rate_per_tick(timed, 20), 20)
    got = rates.snapshots(jobs.stored_rates(spark, out), 20)
    assert same(got.select(*expected.columns), expected)


def test_poll_cadence_and_stop(spark, records, tmp_path):
    log, out = str(tmp_path / "log"), str(tmp_path / "out")
    topic_log.append(records, log)
    with jobs.running(jobs.copy_job(topic_log.stream(spark, log), out, str(tmp_path / "p"), jobs.POLL)) as query:
        query.processAllAvailable()
        assert query.isActive
    assert not query.isActive
    assert read_table(spark, out).count() == records.count()


def test_meter_ticks_without_input(spark, records, tmp_path):
    log, rows = str(tmp_path / "log"), []
    topic_log.append(records, log)

    def keep(batch, batch_id):
        rows.extend(batch.collect())

    stream = meter(topic_log.stream(spark, log, "content-interactions"), history=3)
    query = stream.writeStream.outputMode("append").foreachBatch(keep).option(
        "checkpointLocation", str(tmp_path / "p")).trigger(processingTime="200 milliseconds").start()
    with jobs.running(query):
        deadline = time.time() + 90
        while len(rows) < 5 and time.time() < deadline and query.isActive:
            time.sleep(0.5)
        assert query.exception() is None
    assert len(rows) >= 5
    assert {r.topic for r in rows} == {"content-interactions"}
    assert (rows[0].rate, rows[0].total, rows[0].history) == (42, 42, [42])
    assert sum(r.rate for r in rows) == 42
    assert all(r.total == 42 and len(r.history) <= 3 for r in rows)
    assert rows[4].history == [0, 0, 0]


def test_a_topic_without_interactions_gives_an_empty_table(spark, events, now, tmp_path):
    log, out, lines = (str(tmp_path / name) for name in ("log", "out", "lines"))
    topic_log.append(envelope.topic_records(events(action())), log)
    stream = topic_log.stream(spark, log, "content-interactions")
    jobs.drain(jobs.engagement_job(stream, now, POISON, out, str(tmp_path / "p"), log_path=lines))
    judged = outcomes.consume_engagement(topic_log.read(spark, log), now, POISON)
    assert read_table(spark, out, judged.schema).isEmpty()


def test_rates_hold_no_state_and_count_late_records(spark, records, tmp_path):
    log, out, progress = (str(tmp_path / name) for name in ("log", "out", "progress"))
    for part in (records.where("offset >= 2"), records.where("offset < 2")):
        topic_log.append(part, log)
        query = jobs.rate_job(topic_log.stream(spark, log), out, progress, tick_seconds=20)
        jobs.drain(query)
        assert query.lastProgress is None or not query.lastProgress["stateOperators"]
    assert jobs.stored_rates(spark, out).selectExpr("sum(rate)").first()[0] == records.count()


def test_a_new_checkpoint_keeps_what_an_old_one_stored(spark, records, tmp_path):
    log, out = str(tmp_path / "log"), str(tmp_path / "out")
    topic_log.append(records, log)
    for run in ("one", "two"):
        jobs.drain(jobs.copy_job(topic_log.stream(spark, log), out, str(tmp_path / run)))
    assert read_table(spark, out).count() == 2 * records.count()


def test_latest_goes_by_arrival_and_not_by_time(spark, records, tmp_path):
    log, mark, out, progress = (str(tmp_path / name) for name in ("log", "mark", "out", "p"))
    old = records.where("offset % 2 = 0").withColumn("timestamp", F.col("timestamp") + F.expr("INTERVAL 900 DAYS"))
    late = records.where("offset % 2 = 1").withColumn("timestamp", F.col("timestamp") - F.expr("INTERVAL 900 DAYS"))
    topic_log.append(old, log)
    topic_log.mark_start(spark, log, mark)
    for _ in range(2):  # started before and after the late-stamped records arrive
        jobs.drain(jobs.copy_job(topic_log.stream_from_mark(spark, log, mark), out, progress))
        topic_log.append(late, log)
        topic_log.mark_start(spark, log, mark)
    jobs.drain(jobs.copy_job(topic_log.stream_from_mark(spark, log, mark, files_per_batch=1), out, progress))
    twice = late.unionByName(late)
    assert same(read_table(spark, out, records.schema).select(*records.columns), twice.select(*records.columns))


def test_meter_keeps_time_and_declared_topics_start_with_zeros(spark, records, tmp_path):
    log, rows = str(tmp_path / "log"), []
    topic_log.append(records.where("topic = 'user-actions'"), log)
    declared = spark.createDataFrame([("user-actions",), ("content-interactions",)], "name string")

    def slow(batch, batch_id):
        rows.extend(batch.collect())
        time.sleep(1.5)  # every batch takes longer than a tick

    stream = meter(topic_log.stream(spark, log), tick_millis=400, history=3, topics=declared)
    query = stream.writeStream.outputMode("append").foreachBatch(slow).option(
        "checkpointLocation", str(tmp_path / "p")).trigger(processingTime="200 milliseconds").start()
    with jobs.running(query):
        deadline = time.time() + 90
        while len(rows) < 24 and time.time() < deadline and query.isActive:
            if len(rows) > 8 and records is not None:
                topic_log.append(records.where("topic = 'content-interactions'"), log)
                records = None
            time.sleep(0.3)
        assert query.exception() is None
    assert len(rows) >= 24 and {r.topic for r in rows} == {"user-actions", "content-interactions"}
    for topic in ("user-actions", "content-interactions"):
        mine = sorted((r for r in rows if r.topic == topic), key=lambda r: r.tick)
        assert {b.tick - a.tick for a, b in zip(mine, mine[1:])} == {400}
        assert all(r.total == sum(x.rate for x in mine[:at + 1]) or at == 0 for at, r in enumerate(mine) if r.rate)
    quiet = [r for r in rows if r.topic == "content-interactions"]
    assert quiet[0].rate == 0 and quiet[0].total == 0
