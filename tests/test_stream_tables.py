"""Compaction of batch folders and the order of records."""

import time
from datetime import datetime, timedelta

import pytest

from tidewire import schemas
from tidewire.plans import QUERIES
from tidewire.session import ROOT
from tidewire.streaming import compaction, jobs
from tidewire.streaming.ordering import in_order
from tidewire.streaming.sinks import read_table, table_sink


def numbered(spark, numbers):
    return spark.createDataFrame([(n, "ab"[n % 2]) for n in numbers], "n long, side string")


def ids(df):
    return sorted(r.n for r in df.collect())


def test_compaction_shows_each_row_once_before_and_after_the_swap(spark, tmp_path):
    path = str(tmp_path / "table")
    sink = table_sink(path, "side")
    for batch in range(6):
        sink(numbered(spark, range(10 * batch, 10 * batch + 10)), batch)
    before = compaction.read_compacted(spark, path)
    assert ids(before) == list(range(60)) == ids(read_table(spark, path))
    assert compaction.folders(spark, path) == 6
    assert compaction.compact(spark, path, "side", leave=2, files=1) == 4
    assert ids(before) == list(range(60))  # a reader from before the swap
    after = compaction.read_compacted(spark, path)
    assert ids(after) == list(range(60)) and compaction.folders(spark, path) == 3
    assert set(after.columns) == {"n", "side", "batch_id"}
    assert {(r.batch_id, r["count"]) for r in after.groupBy("batch_id").count().collect()} == {(b, 10) for b in range(6)}
    sink(numbered(spark, range(10, 20)), 1)  # a replay of a compacted batch, and of one that is not
    sink(numbered(spark, range(50, 60)), 5)
    assert ids(compaction.read_compacted(spark, path)) == list(range(60))
    sink(numbered(spark, range(60, 70)), 6)
    assert compaction.compact(spark, path, "side") == 2
    assert compaction.compact(spark, path, "side") == 0
    assert compaction.vacuum(spark, path) > 0
    assert ids(compaction.read_compacted(spark, path)) == list(range(70)) and compaction.folders(spark, path) == 3
    assert ids(read_table(spark, path)) == list(range(70))
    sides = compaction.read_compacted(spark, path).where("side = 'a'")
    assert "side" in sides._jdf.queryExecution().executedPlan().toString() and sides.count() == 35


def test_the_later_of_two_compactions_changes_nothing(spark, tmp_path, monkeypatch):
    path = str(tmp_path / "table")
    for batch in range(3):
        table_sink(path)(numbered(spark, [batch]), batch)
    monkeypatch.setattr(compaction._Folder, "put", lambda *_: False)
    with pytest.raises(RuntimeError):
        compaction.compact(spark, path)
    assert ids(compaction.read_compacted(spark, path)) == [0, 1, 2]
    with pytest.raises(ValueError):
        compaction.read_compacted(spark, str(tmp_path / "none"))


def records(spark, offsets, partition=0):
    return spark.createDataFrame(
        [("t", partition, o, f"k{o}", f"v{o}", None) for o in offsets], schemas.TOPIC_RECORD)


def test_records_leave_in_the_order_of_their_offsets(spark, tmp_path):
    log, progress, seen = str(tmp_path / "log"), str(tmp_path / "p"), []
    parts = [
        [(0, [2, 0, 3]), (1, [0])], [(0, [1, 3, 0]), (1, [2, 1])], [(0, [9, 8]), (1, [3])],
        [(0, [4, 5, 6]), (1, [2])], [(0, [7]), (1, [])]]
    for part in parts:
        whole = [r for p, offsets in part if offsets for r in [records(spark, offsets, p)]]
        both = whole[0] if len(whole) == 1 else whole[0].unionByName(whole[1])
        both.coalesce(1).write.mode("append").parquet(log)
        stream = spark.readStream.schema(schemas.TOPIC_RECORD).parquet(log)
        jobs.drain(in_order(stream).writeStream.foreachBatch(lambda b, _: seen.extend(b.collect())).outputMode("append").option(
            "checkpointLocation", progress).trigger(availableNow=True).start())
    for partition, last in ((0, 10), (1, 4)):
        mine = [r for r in seen if r.partition == partition]
        assert [r.offset for r in mine] == list(range(last))
        assert all(r.value == f"v{r.offset}" and r.missing == 0 for r in mine)


def test_a_full_buffer_and_an_end_of_patience_report_the_gap(spark, tmp_path):
    log, seen = str(tmp_path / "log"), []
    records(spark, [0, 5, 6, 9]).coalesce(1).write.parquet(log)
    stream = spark.readStream.schema(schemas.TOPIC_RECORD).parquet(log)
    query = in_order(stream, most=2, patience_millis=500).writeStream.foreachBatch(
        lambda b, _: seen.extend(b.collect())).outputMode("append").option("checkpointLocation", str(tmp_path / "p")).trigger(
        processingTime="200 milliseconds").start()
    with jobs.running(query):
        deadline = time.time() + 60
        while len(seen) < 4 and time.time() < deadline and query.isActive:
            time.sleep(0.3)
        assert query.exception() is None
    assert [(r.offset, r.missing) for r in seen] == [(0, 0), (5, 4), (6, 0), (9, 2)]


def test_stream_in_order_brings_its_own_state_store_and_package(spark, tmp_path):
    start = datetime(2024, 1, 1)
    rows = [(i, start + timedelta(minutes=i), i % 5, "purchase", 1.0, f'{{"k": {i}}}') for i in range(40)]
    spark.createDataFrame(
        rows, "event_id long, ts timestamp_ntz, user_id long, event_type string, value double, props string").write.parquet(
        str(tmp_path / "events.parquet"))
    name, env = "spark.sql.streaming.stateStore.providerClass", spark.sparkContext.environment
    before, path = spark.conf.get(name), env.pop("PYTHONPATH", None)
    plain = "org.apache.spark.sql.execution.streaming.state.HDFSBackedStateStoreProvider"
    spark.conf.set(name, plain)
    try:
        got = QUERIES["stream_in_order"](spark, str(tmp_path)).collect()
        assert spark.conf.get(name) == plain and ROOT in env["PYTHONPATH"]
    finally:
        spark.conf.set(name, before)
        if path is not None:
            env["PYTHONPATH"] = path
    sent = {(r.topic, r.partition, r.offset) for r in got}
    assert len(got) == len(sent) > 20
    last = {}
    for _, partition, offset in sent:
        last[partition] = max(offset, last.get(partition, 0))
    assert len(got) == sum(n + 1 for n in last.values())


def test_any_number_of_records_is_held_back_without_a_limit(spark, tmp_path):
    log, seen = str(tmp_path / "log"), []
    for offsets in (range(12_000, 0, -1), [0]):  # more than the default limit
        records(spark, offsets).coalesce(1).write.mode("append").parquet(log)
        stream = spark.readStream.schema(schemas.TOPIC_RECORD).parquet(log)
        jobs.drain(in_order(stream, most=None).writeStream.foreachBatch(
            lambda b, _: seen.extend(b.select("offset", "missing").collect())).outputMode("append").option(
            "checkpointLocation", str(tmp_path / "p")).trigger(availableNow=True).start())
    assert [tuple(r) for r in seen] == [(n, 0) for n in range(12_001)]
