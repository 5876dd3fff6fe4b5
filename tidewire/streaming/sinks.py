"""Batch sinks for streams: safe to replay, with bounded retries of failing I/O."""

import time
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.types import IntegerType, StructField, StructType

from tidewire.operators.outcomes import BACK_OFF_SECONDS, RETRIES
from tidewire.streaming import compaction

BatchSink = Callable[[DataFrame, int], None]


def with_retries(
    sink: BatchSink,
    recover: Callable[[DataFrame, int, Exception], None] | None = None,
    retries: int = RETRIES,
    wait_seconds: float = BACK_OFF_SECONDS,
) -> BatchSink:
    """Try a batch again after a failure, then hand it to ``recover`` or let the query fail.

    Meant for transient failures of the sink. A bad record is not one: it is
    judged in the plan and lands in the quarantine without any waiting.
    """

    def run(batch: DataFrame, batch_id: int) -> None:
        for attempt in range(1 + retries):
            try:
                sink(batch, batch_id)
                return
            except Exception as failure:
                if attempt < retries:
                    time.sleep(wait_seconds)
                elif recover is None:
                    raise
                else:
                    recover(batch, batch_id, failure)

    return run


def _batch_folder(batch: DataFrame, path: str, batch_id: int) -> str:
    """Folder of a batch: batch ids start anew with every checkpoint, so the query's own id, kept there, comes first."""
    query = batch.sparkSession.sparkContext.getLocalProperty("sql.streaming.queryId") or "none"
    return f"{path}/query={query}/batch_id={batch_id}"


def table_sink(path: str, *partition_by: str) -> BatchSink:
    """Each batch owns the folder of its query and id and overwrites it.

    A replayed batch leaves no copies, and a query with another checkpoint never touches what is there.
    """

    def write(batch: DataFrame, batch_id: int) -> None:
        writer = batch.write.mode("overwrite")
        if partition_by:
            writer = writer.partitionBy(*partition_by)
        writer.parquet(_batch_folder(batch, path, batch_id))

    return write


def line_sink(path: str) -> BatchSink:
    """Like ``table_sink``, for one column of text."""

    def write(batch: DataFrame, batch_id: int) -> None:
        batch.write.mode("overwrite").text(_batch_folder(batch, path, batch_id))

    return write


def read_table(spark: SparkSession, path: str, schema: StructType | None = None) -> DataFrame:
    """All batches of a table sink; ``batch_id`` and the partition columns come from the folders.

    Give the schema where every batch may have been empty: empty batches leave no file to take it from. A table that
    has been compacted is read by its manifest.
    """
    if compaction.is_compacted(spark, path):
        return compaction.read_compacted(spark, path, schema)
    reader = spark.read.option("basePath", path)
    if schema:
        reader = reader.schema(StructType([*schema, StructField("batch_id", IntegerType())]))
    return reader.parquet(path).drop("query")


def read_batch(batch: DataFrame, path: str, batch_id: int) -> DataFrame:
    """The stored rows of a batch that a table sink has just written; there may be none."""
    return batch.sparkSession.read.schema(batch.schema).parquet(_batch_folder(batch, path, batch_id))
