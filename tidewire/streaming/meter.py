"""Wall-clock throughput meter: once a second, rate, total and the last thirty rates per topic.

The tick comes from a processing-time timer that is re-armed from its own
time, so ticks neither drift nor get lost: a batch that is late catches up,
with a zero row for every tick it has passed over. Topics that are declared
start with the job and emit zeros before their first record; any other topic
starts with its first record. Only per-task counts reach the stateful step,
never the records themselves.
"""

from collections.abc import Iterator

import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import Row
from pyspark.sql import types as T
from pyspark.sql.streaming import StatefulProcessor, StatefulProcessorHandle

from tidewire.operators.rates import HISTORY

TICK_MILLIS = 1000

ARRIVALS = T.StructType([T.StructField("topic", T.StringType()), T.StructField("n", T.LongType())])
SNAPSHOT = T.StructType([
    T.StructField("topic", T.StringType()),
    T.StructField("tick", T.LongType()),
    T.StructField("rate", T.LongType()),
    T.StructField("total", T.LongType()),
    T.StructField("history", T.ArrayType(T.LongType())),
])
_STATE = T.StructType([
    T.StructField("pending", T.LongType()),
    T.StructField("total", T.LongType()),
    T.StructField("history", T.ArrayType(T.LongType())),
])


def _count_per_topic(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    totals: dict[str, int] = {}
    for batch in batches:
        for entry in pc.value_counts(batch.column(0)).to_pylist():
            totals[entry["values"]] = totals.get(entry["values"], 0) + entry["counts"]
    if totals:
        yield pa.RecordBatch.from_arrays(
            [pa.array(totals.keys(), pa.string()), pa.array(totals.values(), pa.int64())], names=["topic", "n"]
        )


def arrivals(records: DataFrame) -> DataFrame:
    """At most one ``(topic, n)`` row per task and topic: the partial count of a micro-batch."""
    return records.select("topic").mapInArrow(_count_per_topic, ARRIVALS)


class Meter(StatefulProcessor):
    """Counts between ticks, the count since the start, and the last rates of one topic."""

    def __init__(self, tick_millis: int = TICK_MILLIS, history: int = HISTORY):
        self._tick_millis = tick_millis
        self._history = history

    def init(self, handle: StatefulProcessorHandle) -> None:
        self._handle = handle
        self._state = handle.getValueState("meter", _STATE)

    def handleInitialState(self, key, initialState, timerValues) -> None:
        self._state.update((0, 0, []))
        self._arm(timerValues)

    def handleInputRows(self, key, rows, timerValues):
        arrived = sum(row.n for row in rows)
        if self._state.exists():
            pending, total, history = self._state.get()
        else:
            pending, total, history = 0, 0, []
            self._arm(timerValues)
        self._state.update((pending + arrived, total + arrived, list(history)))
        return iter(())

    def handleExpiredTimer(self, key, timerValues, expiredTimerInfo):
        rate, total, history = self._state.get()
        history, tick, now = list(history), expiredTimerInfo.getExpiryTimeInMs(), timerValues.getCurrentProcessingTimeInMs()
        while tick <= now:
            history = [*history, rate][-self._history:]
            yield Row(topic=key[0], tick=tick, rate=rate, total=total, history=history)
            rate, tick = 0, tick + self._tick_millis
        self._state.update((0, total, history))
        self._handle.registerTimer(tick)

    def close(self) -> None:
        pass

    def _arm(self, timerValues) -> None:
        self._handle.registerTimer(timerValues.getCurrentProcessingTimeInMs() + self._tick_millis)


def meter(
    records: DataFrame, tick_millis: int = TICK_MILLIS, history: int = HISTORY, topics: DataFrame | None = None
) -> DataFrame:
    """Snapshots per topic and tick (milliseconds since 1970); needs the RocksDB state store provider.

    ``topics`` names the declared topics (column ``name``, such as the topic catalog): these tick from the start. The
    ticks of a topic follow each other by ``tick_millis`` without gaps, however late a batch runs.
    """
    declared = None
    if topics is not None:
        declared = topics.selectExpr("name AS topic", "0L AS n").groupBy("topic")
    return (
        arrivals(records)
        .groupBy("topic")
        .transformWithState(
            statefulProcessor=Meter(tick_millis, history),
            outputStructType=SNAPSHOT,
            outputMode="Append",
            timeMode="processingTime",
            initialState=declared,
        )
    )
