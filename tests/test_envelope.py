import random
from datetime import datetime, timedelta
from pathlib import Path

from conftest import NOW, action, interaction, system_event
from pyspark.sql import functions as F

from tidewire.operators import envelope
from tidewire.session import released

START = datetime(2024, 1, 1)


def records(spark, rows):
    return spark.createDataFrame(rows, "topic string, partition int, occurred_at timestamp_ntz, event_id string")


def numbered(df):
    got = [tuple(r) for r in df.select("topic", "partition", "occurred_at", "event_id", "offset").collect()]
    return sorted(got)


def expected_offsets(rows):
    seen, out = {}, []
    for row in sorted(rows):
        place = row[:2]
        out.append((*row, seen.get(place, 0)))
        seen[place] = seen.get(place, 0) + 1
    return sorted(out)


def test_gate_route_and_key(events):
    rows = events(action(), action(user_id=" "), interaction(user_id=" "), system_event())
    got = {(r.topic, r.key) for r in envelope.publishable(rows).collect()}
    assert got == {("user-actions", "user-42"), ("content-interactions", "post-normal")}


def test_one_key_has_one_partition(events):
    rows = events(*(action(user_id=f"user-{i % 40}") for i in range(200)))
    placed = envelope.publishable(rows, {"user-actions": 12, "content-interactions": 6})
    per_key = placed.groupBy("key").agg(F.count_distinct("partition").alias("n")).collect()
    assert len(per_key) == 40 and all(r.n == 1 for r in per_key)
    used = {r.partition for r in placed.select("partition").distinct().collect()}
    assert len(used) > 6 and used <= set(range(12))


def test_offsets_match_brute_force_with_a_hot_partition(spark):
    rng = random.Random(7)
    rows = [
        ("t" if rng.random() < 0.9 else "u", 0 if rng.random() < 0.6 else rng.randrange(5),
         START + timedelta(seconds=rng.randrange(50)), f"e{i:05}")
        for i in range(3000)
    ]
    got = numbered(envelope.assign_offsets(records(spark, rows).repartition(7)))
    assert got == expected_offsets(rows)


def test_copies_of_one_record_get_offsets_of_their_own(spark):
    rows = [("t", 0, START, "same")] * 1500 + [("t", 0, START + timedelta(seconds=i), f"e{i}") for i in range(1, 500)]
    got = numbered(envelope.assign_offsets(records(spark, rows).repartition(5)))
    assert [r[-1] for r in sorted(got, key=lambda r: r[-1])] == list(range(len(rows)))
    assert {r[-1] for r in got if r[3] == "same"} == set(range(1500))


def test_a_hot_partition_is_spread_over_tasks(spark):
    rows = [("t", 0, START, f"e{i:05}") for i in range(4000)]
    # Keep the small ranges apart, as they would be with real amounts of data.
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        placed = envelope.assign_offsets(records(spark, rows).repartition(4))
        files = spark.read.parquet(*placed.inputFiles()).groupBy(F.input_file_name()).count().collect()
    finally:
        spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "true")
    assert len(files) == 4 and max(r["count"] for r in files) < 2000


def test_no_records_no_offsets(spark):
    assert envelope.assign_offsets(records(spark, [])).count() == 0


def test_topic_records_and_search(spark, events):
    rows = events(*(action(user_id=f"user-{i % 3}", action_type=("POST_CREATED", "USER_FOLLOWED")[i % 2])
                    for i in range(12)))
    log = envelope.topic_records(rows)
    assert log.columns == ["topic", "partition", "offset", "key", "value", "timestamp"]
    found = envelope.find_records(log, "user-1", "USER_FOLLOWED").collect()
    assert len(found) == 2 and all(r.key == "user-1" and "USER_FOLLOWED" in r.value for r in found)
    first = envelope.first_record(log).first()
    assert first.offset == 0 and first.partition == min(r.partition for r in log.collect())


def test_published_records_are_found_with_their_offsets(spark, events):
    rows = [action(user_id=f"user-{i % 4}", occurred_at=NOW + timedelta(minutes=i * 37 % 600),
                   action_type=("POST_CREATED", "USER_FOLLOWED")[i % 3 == 0]) for i in range(120)]
    rows += [action(user_id="user-1", occurred_at=NOW, action_type="USER_FOLLOWED") for _ in range(30)]
    sent = envelope.publishable(events(*rows))
    wanted = {r.event_id: (r.topic, r.partition, r.offset) for r in envelope.assign_offsets(sent).where(
        "key = 'user-1' AND action_type = 'USER_FOLLOWED'").collect()}
    assert len(wanted) == 40
    for span in ("hour", "day", "minute"):
        found = envelope.find_published(sent, "key = 'user-1' AND action_type = 'USER_FOLLOWED'", span=span).collect()
        assert {r.event_id: (r.topic, r.partition, r.offset) for r in found} == wanted
    assert envelope.find_published(sent, "key = 'nobody'").count() == 0


def test_tables_are_deleted_with_their_block(spark, events):
    with released(spark):
        placed = envelope.assign_offsets(envelope.publishable(events(action(), action())))
        files = placed.inputFiles()
        assert placed.count() == 2 and files and all(Path(f.removeprefix("file:")).exists() for f in files)
    assert not any(Path(f.removeprefix("file:")).exists() for f in files)
    kept = envelope.assign_offsets(envelope.publishable(events(action())))
    assert kept.count() == 1


def brute_audit(rows):
    out = {}
    for topic, key in {(r[0], r[1]) for r in rows}:
        mine = [r for r in rows if r[:2] == (topic, key)]
        inversions = 0
        for partition in {r[2] for r in mine}:
            walk = sorted((r[3], r[4]) for r in mine if r[2] == partition)
            inversions += sum(a[1] > b[1] for a, b in zip(walk, walk[1:]))
        out[topic, key] = (len({r[2] for r in mine}), inversions)
    return out


def test_key_order_audit_matches_brute_force_across_blocks(spark):
    rng = random.Random(3)
    rows, next_offset = [], {}
    for i in range(400):
        key = "hot" if rng.random() < 0.5 else f"k{rng.randrange(6)}"
        partition = rng.randrange(2) if key == "k0" else 0
        offset = next_offset.get(partition, 0)
        next_offset[partition] = offset + 1
        late = timedelta(seconds=i if rng.random() < 0.9 else i - 20)
        rows.append(("t", key, partition, offset, START + late, f"e{i:05}"))
    flat = [(t, k, p, o, (at, e)) for t, k, p, o, at, e in rows]
    df = spark.createDataFrame(
        rows, "topic string, key string, partition int, offset bigint, occurred_at timestamp_ntz, event_id string"
    )
    for block in (7, 50, 1_000_000):
        got = {(r.topic, r.key): (r.partitions, r.inversions)
               for r in envelope.key_order_audit(df, block=block).collect()}
        assert got == brute_audit(flat)


def test_records_without_a_key_are_kept_and_spread(events):
    rows = events(*(interaction(content_id=None) for _ in range(60)))
    log = envelope.topic_records(rows).collect()
    assert len(log) == 60 and all(r.key is None and r.partition is not None for r in log)
    assert len({r.partition for r in log}) == 6


def test_record_time_is_the_utc_instant_in_any_session_zone(spark, events):
    before = spark.conf.get("spark.sql.session.timeZone")
    spark.conf.set("spark.sql.session.timeZone", "America/New_York")
    try:
        # The New York clock skips this time.
        rows = events(action(occurred_at=datetime(2024, 3, 10, 2, 30)))
        micros = envelope.topic_records(rows).select(F.unix_micros("timestamp").alias("at")).first().at
    finally:
        spark.conf.set("spark.sql.session.timeZone", before)
    assert micros == 1_710_037_800_000_000


def test_rows_without_a_declared_partition_keep_an_offset(events):
    rows = events(action(), interaction(), action())
    placed = envelope.envelopes(rows, partitions={"user-actions": 12})
    assert placed.count() == 3
    assert placed.where("partition IS NULL AND offset = 0").count() == 1
