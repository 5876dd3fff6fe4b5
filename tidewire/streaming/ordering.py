"""Records of a topic partition in the order of their offsets, though they arrive out of order or twice.

A record whose predecessors are missing is held back in the state of its partition and leaves when they have come. A
record that was delivered before leaves no second time. What never comes is given up when the buffer is full, or after a
given patience: the next record then carries the number of offsets missing before it.
"""

from pyspark.sql import DataFrame, Row
from pyspark.sql import types as T
from pyspark.sql.streaming import StatefulProcessor, StatefulProcessorHandle

from tidewire import schemas
from tidewire.session import workers_find_package

ORDERED = T.StructType([*schemas.TOPIC_RECORD.fields, T.StructField("missing", T.LongType())])
_HELD = T.StructType([T.StructField("records", T.ArrayType(T.StructType(
    [f for f in schemas.TOPIC_RECORD if f.name not in ("topic", "partition")])))])
_PLACE = T.StructType([T.StructField("block", T.LongType())])
_NEXT = T.StructType([T.StructField("next", T.LongType()), T.StructField("held", T.LongType()), T.StructField("timer", T.LongType())])


#: Offsets whose records are kept as one value of the state, and such values that a task has in memory.
BLOCK, CACHED = 512, 128


class Held:
    """Records of one partition by offset, kept in the state by blocks: neighbours are read and written together."""

    def __init__(self, state):
        self._state, self._blocks, self._changed = state, {}, set()

    def _block(self, offset: int) -> dict[int, tuple]:
        at = offset // BLOCK
        block = self._blocks.pop(at, None)
        if block is None:
            found = self._state.getValue((at,)) if self._state.containsKey((at,)) else None
            block = {r[0]: tuple(r)[1:] for r in found[0]} if found else {}
            if len(self._blocks) >= CACHED:
                self._write(next(iter(self._blocks)))
        self._blocks[at] = block  # the last used is the last to leave
        return block

    def _write(self, at: int) -> None:
        block = self._blocks.pop(at)
        if at in self._changed:
            self._changed.remove(at)
            if block:
                self._state.updateValue((at,), ([(offset, *record) for offset, record in block.items()],))
            elif self._state.containsKey((at,)):
                self._state.removeKey((at,))

    def __contains__(self, offset: int) -> bool:
        return offset in self._block(offset)

    def put(self, offset: int, record: tuple) -> None:
        self._block(offset)[offset] = record
        self._changed.add(offset // BLOCK)

    def take(self, offset: int) -> tuple:
        self._changed.add(offset // BLOCK)
        return self._block(offset).pop(offset)

    def least(self) -> int:
        self.write()
        return min(self._block(min(at for (at,) in self._state.keys()) * BLOCK))

    def write(self) -> None:
        for at in list(self._blocks):
            self._write(at)


class HoldBack(StatefulProcessor):
    def __init__(self, first: int, most: int | None, patience_millis: int | None):
        self._first, self._most, self._patience = first, most, patience_millis

    def init(self, handle: StatefulProcessorHandle) -> None:
        self._handle = handle
        self._next = handle.getValueState("next", _NEXT)
        self._buffer = handle.getMapState("held", _PLACE, _HELD)

    def handleInputRows(self, key, rows, timerValues):
        next_, held, timer = self._next.get() if self._next.exists() else (self._first, 0, 0)
        buffer = Held(self._buffer)
        for row in rows:
            if row.offset < next_ or held and row.offset in buffer:
                continue
            if row.offset == next_:
                yield self._record(key, row.offset, (row.key, row.value, row.timestamp), 0)
                next_ += 1
                while held and next_ in buffer:
                    yield self._release(key, buffer, next_, 0)
                    next_, held = next_ + 1, held - 1
            else:
                buffer.put(row.offset, (row.key, row.value, row.timestamp))
                held += 1
                if self._most is not None and held > self._most:
                    for record in self._give_up(key, buffer, next_):
                        yield record
                        next_, held = record.offset + 1, held - 1
        buffer.write()
        if held and not timer and self._patience is not None:
            timer = timerValues.getCurrentProcessingTimeInMs() + self._patience
            self._handle.registerTimer(timer)
        self._next.update((next_, held, timer))

    def handleExpiredTimer(self, key, timerValues, expiredTimerInfo):
        next_, held, _ = self._next.get()
        buffer = Held(self._buffer)
        if held:
            for record in self._give_up(key, buffer, next_):
                yield record
                next_, held = record.offset + 1, held - 1
        buffer.write()
        timer = 0
        if held:
            timer = timerValues.getCurrentProcessingTimeInMs() + self._patience
            self._handle.registerTimer(timer)
        self._next.update((next_, held, timer))

    def close(self) -> None:
        pass

    def _give_up(self, key, buffer: Held, next_: int):
        """The least held record, with the gap before it, and all that follow it without one."""
        at = buffer.least()
        yield self._release(key, buffer, at, at - next_)
        while at + 1 in buffer:
            at += 1
            yield self._release(key, buffer, at, 0)

    def _release(self, key, buffer: Held, offset: int, missing: int) -> Row:
        return self._record(key, offset, buffer.take(offset), missing)

    def _record(self, key, offset: int, value: tuple, missing: int) -> Row:
        return Row(topic=key[0], partition=key[1], offset=offset, key=value[0], value=value[1], timestamp=value[2], missing=missing)


def in_order(records: DataFrame, first: int = 0, most: int | None = 10_000, patience_millis: int | None = None) -> DataFrame:
    """A stream of records, each topic partition in the order of its offsets from ``first`` on, each offset once.

    At most ``most`` records of a partition are held back, with None any number; with ``patience_millis`` for that long from the first of them
    on. Such a job has timers and runs until it is stopped, one without them can also run to the end of its input.
    ``missing`` is 0 but for the record after a gap. Needs the RocksDB state store provider, as
    ``state_in_rocksdb`` sets it for the jobs that start in it.
    """
    workers_find_package(records.sparkSession)
    return records.select(*schemas.TOPIC_RECORD.fieldNames()).groupBy("topic", "partition").transformWithState(
        statefulProcessor=HoldBack(first, most, patience_millis), outputStructType=ORDERED, outputMode="Append",
        timeMode="None" if patience_millis is None else "processingTime")
