from datetime import datetime, timedelta

import pytest
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st

from tidewire.operators import rates

START = datetime(2024, 1, 1, 0, 59, 50)


def events(spark, seconds, topic="t"):
    rows = [(topic, START + timedelta(seconds=s)) for s in seconds]
    return spark.createDataFrame(rows, "topic string, occurred_at timestamp_ntz")


def tracked(seconds, history=30):
    """What a tracker reports at each tick from the first to the last event."""
    first, last = int(min(seconds)), int(max(seconds))
    kept, total, out = [], 0, []
    for at in range(first, last + 1):
        rate = sum(int(s) == at for s in seconds)
        total += rate
        kept = [*kept, rate][-history:]
        out.append((START + timedelta(seconds=at), rate, total, kept))
    return out


def snapshots(spark, seconds, block_ticks):
    got = rates.snapshots(rates.rate_per_tick(events(spark, seconds)), block_ticks=block_ticks)
    return [(r.tick, r.rate, r.total, r.history) for r in got.orderBy("tick").collect()]


def test_three_events_then_an_empty_tick(spark):
    got = snapshots(spark, [0, 0.2, 0.9, 2], 3600)
    assert [(r[1], r[2]) for r in got] == [(3, 3), (0, 3), (1, 4)]


def test_history_holds_thirty_ticks(spark):
    got = snapshots(spark, list(range(40)), 3600)
    assert [len(r[3]) for r in got] == [min(i + 1, 30) for i in range(40)]


@pytest.mark.parametrize("block_ticks", [30, 37, 3600])
def test_blocks_do_not_show_in_the_result(spark, block_ticks):
    seconds = [0, 0, 1, 29, 30, 31, 61, 95, 95, 95, 300, 301]
    assert snapshots(spark, seconds, block_ticks) == tracked(seconds)


@settings(max_examples=6, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(st.lists(st.integers(0, 250), min_size=1, max_size=60))
def test_snapshots_agree_with_a_tracker(spark, seconds):
    assert snapshots(spark, seconds, 31) == tracked(seconds)


def test_gap_fill_and_total_per_series(spark):
    both = events(spark, [0, 0, 70], "a").unionByName(events(spark, [5, 6], "b"))
    counted = rates.rate_per_tick(both)
    filled = rates.gap_filled(counted, block_ticks=10)
    assert {r.topic: r["count"] for r in filled.groupBy("topic").count().collect()} == {"a": 71, "b": 2}
    assert {r.topic: r["sum(rate)"] for r in filled.groupBy("topic").sum("rate").collect()} == {"a": 3, "b": 2}
    totals = rates.running_total(counted, block_ticks=10)
    last = {r.topic: r["max(total)"] for r in totals.groupBy("topic").max("total").collect()}
    assert last == {"a": 3, "b": 2}
    assert totals.where("topic = 'a' and total = 2").count() == 70


def test_longer_ticks(spark):
    counted = rates.rate_per_tick(events(spark, [0, 5, 15, 200]), tick_seconds=60)
    got = rates.gap_filled(counted, tick_seconds=60).orderBy("tick").collect()
    # Minutes 0:59 to 1:03.
    assert [r.rate for r in got] == [2, 1, 0, 0, 1]
    assert got[0].tick == datetime(2024, 1, 1, 0, 59)


def test_a_block_must_cover_the_history(spark):
    with pytest.raises(ValueError):
        rates.snapshots(rates.rate_per_tick(events(spark, [0])), block_ticks=10)


def test_no_events_no_ticks(spark):
    none = events(spark, [0]).where("false")
    assert rates.snapshots(rates.rate_per_tick(none)).isEmpty()


def test_peak_has_a_floor_of_one(spark):
    rows = spark.createDataFrame([("t", [0, 0]), ("u", [1, 4, 2])], "topic string, history array<bigint>")
    got = {r.topic: (r.peak, r.scaled) for r in rates.with_peak(rows).collect()}
    assert got == {"t": (1, [0.0, 0.0]), "u": (4, [0.25, 1.0, 0.5])}


def test_partition_sizing_rounds_up_and_caps(spark):
    peaks = spark.createDataFrame(
        [("user-actions", 30_000_000), ("content-interactions", 20_000_000), ("other", 30_001)],
        "topic string, rate bigint",
    )
    sized = rates.partition_sizing(peaks, 30_000, {"content-interactions": 500})
    got = {r.topic: r.partitions for r in sized.collect()}
    assert got == {"user-actions": 1000, "content-interactions": 500, "other": 2}
    free = rates.partition_sizing(peaks, 30_000, {})
    assert {r.topic: r.partitions for r in free.collect()}["content-interactions"] == 667
