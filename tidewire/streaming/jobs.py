"""Streaming jobs. Each applies the same operator as its batch twin.

A job is one query with its own checkpoint, so any number of jobs can follow
the same topic and each of them sees every record.
"""

from collections.abc import Callable, Iterator
from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from tidewire.functions.instants import to_wall
from tidewire.operators import feed, outcomes, rates
from tidewire.streaming.sinks import BatchSink, line_sink, read_batch, read_table, table_sink, with_retries

# Fixed value: how often a monitor polls.
POLL = "500 milliseconds"


def start(records: DataFrame, sink: BatchSink, checkpoint: str, poll: str | None = None, mode: str = "append") -> StreamingQuery:
    """Start a job: continuous with ``poll`` as its cadence, else everything available and then stop."""
    writer = records.writeStream.outputMode(mode).option("checkpointLocation", checkpoint).foreachBatch(sink)
    writer = writer.trigger(processingTime=poll) if poll else writer.trigger(availableNow=True)
    return writer.start()


@contextmanager
def running(query: StreamingQuery) -> Iterator[StreamingQuery]:
    """Stop the query on the way out, whatever happens; its checkpoint lets it resume."""
    try:
        yield query
    finally:
        query.stop()


def drain(query: StreamingQuery) -> None:
    """Wait for an available-now query and raise its failure, if any."""
    with running(query):
        query.awaitTermination()


def engagement_job(
    records: DataFrame,
    now: str,
    poison_ids: list[str],
    path: str,
    checkpoint: str,
    poll: str | None = None,
    log_path: str | None = None,
) -> StreamingQuery:
    """Judge interactions and store them by status: ``status=recovered`` is the quarantine.

    Both results are written in one pass over the batch. With a ``log_path`` the
    stored batch is also written as log lines, without judging it again.
    """
    store = table_sink(path, "status")
    log = line_sink(log_path) if log_path else None

    def keep(batch: DataFrame, batch_id: int) -> None:
        store(batch, batch_id)
        if log:
            stored = read_batch(batch, path, batch_id)
            log(outcomes.processed_lines(stored).unionByName(outcomes.recovered_lines(stored)), batch_id)

    judged = outcomes.consume_engagement(records, now, poison_ids)
    return start(judged, with_retries(keep), checkpoint, poll)


def feed_job(
    records: DataFrame, path: str, checkpoint: str, poll: str | None = None, rejects_path: str | None = None
) -> StreamingQuery:
    """Feed items of both topics, stored by stream name; records that cannot be read go to ``rejects_path``, if given."""
    if rejects_path is None:
        items = feed.feed_from_records(records).withColumn("stream_name", F.col("topic"))
        return start(items, with_retries(table_sink(path, "stream_name")), checkpoint, poll)
    store, put_aside = table_sink(path, "stream_name"), table_sink(rejects_path)

    def keep(batch: DataFrame, batch_id: int) -> None:
        read = batch.persist()  # decoded once for both tables
        try:
            store(feed.readable(read).withColumn("stream_name", F.col("topic")), batch_id)
            put_aside(feed.rejects(read), batch_id)
        finally:
            read.unpersist()

    return start(feed.decoded(records), with_retries(keep), checkpoint, poll)


def copy_job(records: DataFrame, path: str, checkpoint: str, poll: str | None = None) -> StreamingQuery:
    """Store every record once, in whatever shape it has."""
    return start(records, with_retries(table_sink(path)), checkpoint, poll)


def transform_job(
    records: DataFrame,
    transform: Callable[[DataFrame], DataFrame],
    sink: BatchSink,
    checkpoint: str,
    poll: str | None = None,
) -> StreamingQuery:
    """The extension point: a caller's transform and a caller's sink."""
    return start(transform(records), with_retries(sink), checkpoint, poll)


def rate_job(
    records: DataFrame,
    path: str,
    checkpoint: str,
    tick_seconds: int = 1,
    poll: str | None = None,
) -> StreamingQuery:
    """Events per topic and tick of event time.

    Every batch stores its own counts and ``stored_rates`` adds them up, so the job holds no state, a record counts
    however late it comes, and a replayed batch counts once.
    """
    store = table_sink(path)

    def keep(batch: DataFrame, batch_id: int) -> None:
        store(rates.rate_per_tick(batch, tick_seconds, "timestamp"), batch_id)

    return start(records, with_retries(keep), checkpoint, poll)


def stored_rates(spark: SparkSession, path: str) -> DataFrame:
    """The count of each topic and tick over all batches."""
    whole = read_table(spark, path).groupBy("topic", "tick").agg(F.sum("rate").alias("rate"))
    return whole.selectExpr("topic", f"{to_wall('tick')} AS tick", "rate")
