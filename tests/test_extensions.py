"""Copies, skew, trends, table views and dead letters, on small inputs against plain Python."""

from collections import Counter
from datetime import datetime, timedelta

import pytest
from conftest import interaction
from pyspark.sql import functions as F

from tidewire import schemas
from tidewire.operators import dead_letters, dedup, envelope, outcomes, skew, trends, views
from tidewire.sources import topic_log
from tidewire.streaming import jobs
from tidewire.streaming.sinks import read_table

DAY = datetime(2024, 1, 1)


def at(seconds):
    return DAY + timedelta(seconds=seconds)


def test_copies_within_the_horizon_are_dropped(spark):
    rows = [("a", 0, 1), ("a", 50, 2), ("a", 140, 3), ("a", 400, 4), ("b", 99, 5), ("b", 101, 6), ("b", 300, 7),
            (None, 5, 8), (None, 5, 9), ("c", 7, 10), ("c", 7, 11), ("d", 250, 12)]
    rows = [(k, at(t), n, {"x": str(n)}) for k, t, n in rows] + [("e", None, 13, None), ("e", None, 14, None)]
    events = spark.createDataFrame(rows, "event_id string, occurred_at timestamp_ntz, n int, tags map<string,string>")
    kept = dedup.drop_copies(events, 100)
    assert kept.columns == events.columns
    # a: 0 opens, 50 and 140 each follow within 100 s of the one before; b: 101 follows 99 over a span's edge.
    assert sorted(r.n for r in kept.collect()) == [1, 4, 5, 7, 8, 9, 10, 12, 13, 14]


def test_one_id_with_most_rows_leaves_one_row_a_span(spark):
    events = spark.range(5000).selectExpr(
        "if(id % 3 = 0, 'hot', concat('e', id)) AS event_id",
        "TIMESTAMP_NTZ '2024-01-01' + make_dt_interval(0, 0, 0, id) AS occurred_at")
    kept = dedup.drop_copies(events, 60)
    assert kept.where("event_id = 'hot'").count() == 1
    plan = kept._jdf.queryExecution().executedPlan().toString()
    assert "partial_min_by" in plan and "Window" not in plan


def test_streaming_copies_are_dropped_and_state_shrinks(spark, tmp_path):
    log, out, progress = (str(tmp_path / n) for n in ("log", "out", "progress"))
    sizes = []
    for part in ([("a", 0), ("b", 10), ("a", 30), ("c", 40)], [("mark", 5000)], [("a", 6000), ("b", 6001), ("b", 6002)]):
        spark.createDataFrame([(k, at(t)) for k, t in part], "event_id string, timestamp timestamp").write.mode("append").parquet(log)
        stream = spark.readStream.schema("event_id string, timestamp timestamp").parquet(log)
        query = jobs.copy_job(dedup.drop_copies_stream(stream, 100), out, progress)
        jobs.drain(query)
        sizes.append(query.lastProgress["stateOperators"][0]["numRowsTotal"])
    seen = Counter(r.event_id for r in read_table(spark, out).collect())
    assert seen == {"a": 2, "b": 2, "c": 1, "mark": 1}
    assert sizes[0] == 3 and sizes[1] == 1  # the watermark has passed a, b and c


def test_hot_keys_are_exact_however_rows_are_dealt(spark):
    keys = ["hot"] * 400 + ["warm"] * 60 + [f"k{i}" for i in range(540)] + [None] * 10
    records = spark.createDataFrame([("t", i % 7, k) for i, k in enumerate(keys)], "topic string, partition int, key string")
    found = {r.key: (r.n, r.salts) for r in skew.hot_keys(records.repartition(9), 0.05).collect()}
    assert found == {"hot": (400, 8), "warm": (60, 2)}
    report = skew.partition_skew(records).first()
    sizes = Counter(i % 7 for i in range(len(keys)))
    assert (report.partitions, report.records, report.largest) == (7, 1010, max(sizes.values()))
    with pytest.raises(ValueError):
        skew.hot_keys(records, 0.0001)


def test_trends_equal_counting_every_window(spark):
    rows = [(f"p{(i * i) % 7}", at(i * 97)) for i in range(300)] + [(None, at(3)), ("p1", None)]
    events = spark.createDataFrame(rows, "content_id string, occurred_at timestamp_ntz")
    counts = Counter()
    for item, when in rows:
        if item and when:
            pane = int((when - DAY).total_seconds()) // 600 * 600
            for back in range(3):
                counts[at(pane - 600 * back), item] += 1
    want = set()
    for start in {s for s, _ in counts}:
        ranked = sorted(((-n, i) for (s, i), n in counts.items() if s == start))[:2]
        want |= {(start, rank, i, -n) for rank, (n, i) in enumerate(ranked, start=1)}
    found = trends.trending(events, "content_id", 2, 1800, 600)
    assert {tuple(r) for r in found.collect()} == want
    assert "WindowGroupLimit" in found._jdf.queryExecution().executedPlan().toString()
    with pytest.raises(ValueError):
        trends.windows(trends.pane_counts(events, 600, "content_id"), 1000, 600)


def test_as_of_join_equals_a_search(spark):
    changes = [("u", 10, 1), ("u", 10, 2), ("u", 250, 3), ("v", 900, 4), (None, 1, 5), ("u", None, 6), ("w", 5, 7)]
    asked = [("u", 5), ("u", 10), ("u", 99), ("u", 251), ("u", 5000), ("v", 899), ("v", 900), ("x", 1), (None, 4), ("w", 4000), ("u", None)]
    when = lambda t: None if t is None else at(t)
    log = spark.createDataFrame([(k, when(t), n) for k, t, n in changes], "key string, changed timestamp_ntz, n int")
    events = spark.createDataFrame([(i, k, when(t)) for i, (k, t) in enumerate(asked)], "id int, key string, t timestamp_ntz")
    got = {r.id: r.version and r.version.n for r in views.as_of_join(events, log, "key", "t", "changed", ["n"], 100).collect()}
    want = {}
    for i, (k, t) in enumerate(asked):
        held = [(c, n) for key, c, n in changes if k and t is not None and c is not None and key == k and c <= t]
        want[i] = max(held)[1] if held else None
    assert got == want
    last = {r.key: r.n for r in views.latest_by_key(log.where("key IS NOT NULL"), "key", "changed", "n").collect()}
    assert last == {"u": 3, "v": 4, "w": 7}


def test_two_versions_of_a_catalog_key_by_time(spark):
    catalog = spark.createDataFrame([("k", "old", at(0)), ("k", "new", at(100))], "kind string, text string, since timestamp_ntz")
    events = spark.createDataFrame([("k", at(99)), ("k", at(100)), ("k", at(-1)), ("z", at(5))], "kind string, t timestamp_ntz")
    found = views.with_catalog_version(events, views.valid_spans(catalog, "kind", "since"), "kind", "t")
    assert {(r.t, r.text) for r in found.collect()} == {(at(99), "old"), (at(100), "new"), (at(-1), None), (at(5), None)}


def test_two_redrives_leave_no_copies(spark, events, now, tmp_path):
    graves, ledger = str(tmp_path / "letters"), str(tmp_path / "ledger")
    records = envelope.topic_records(events(
        interaction(), interaction(content_id="post-BOOM"), interaction(user_id=" "), interaction(content_id="post-BOOM")))
    first = outcomes.consume_engagement(records, now, ["post-BOOM"])
    dead_letters.bury(dead_letters.letters(records, first), graves, "0")
    assert dead_letters.buried(spark, graves).count() == 3
    again = dead_letters.redrive(spark, graves, ledger, "1")
    assert again.count() == 3
    plain = again.select(*schemas.TOPIC_RECORD.fieldNames())
    second = outcomes.consume_engagement(plain, now, [])
    for _ in range(2):  # a repeated run overwrites its own letters
        dead_letters.bury(dead_letters.letters(plain, second, again), graves, "1")
    assert dead_letters.redrive(spark, graves, ledger, "1").count() == 3
    left = dead_letters.redrive(spark, graves, ledger, "2").collect()
    assert [(r.round, r.attempts) for r in left] == [(1, 6)]
    assert dead_letters.redrive(spark, graves, ledger, "3").isEmpty()
    assert spark.read.parquet(ledger).groupBy("topic", "partition", "offset", "round").count().where("count > 1").isEmpty()
