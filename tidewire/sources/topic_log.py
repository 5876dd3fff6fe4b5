"""A topic log on files: records in the column shape of Spark's Kafka source.

It stands in for the broker where no connector is installed. Records are
stored by topic, so a reader of one topic prunes the other's folder.
"""

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import TimestampType

from tidewire import schemas
from tidewire.functions.instants import to_instant
from tidewire.functions.sql import literal


def append(records: DataFrame, path: str) -> None:
    """Add records to the log. Each task appends files; nothing is rewritten."""
    records.select(*schemas.TOPIC_RECORD.fieldNames()).write.mode("append").partitionBy("topic").parquet(path)


def read(spark: SparkSession, path: str, *topics: str, after: str | None = None) -> DataFrame:
    """The log as a batch, from the earliest record or only those later than ``after``."""
    records = spark.read.schema(schemas.TOPIC_RECORD).parquet(path)
    if topics:
        records = records.where(F.col("topic").isin(*topics))
    return from_latest(records, after) if after else records


def stream(
    spark: SparkSession, path: str, *topics: str, after: str | None = None, files_per_batch: int | None = None
) -> DataFrame:
    """The log as a stream; a checkpoint resumes it.

    It starts at the earliest record, or with ``after`` at the first later one:
    a monitor that must not replay passes its start time and a new checkpoint.
    """
    reader = spark.readStream.schema(schemas.TOPIC_RECORD)
    if files_per_batch:
        reader = reader.option("maxFilesPerTrigger", files_per_batch)
    records = reader.parquet(path)
    if topics:
        records = records.where(F.col("topic").isin(*topics))
    return from_latest(records, after) if after else records


def mark_start(spark: SparkSession, path: str, mark: str) -> None:
    """Note the files the log has now, as a table at ``mark``: what a monitor that starts now must not see.

    Arrival is a matter of files, not of the times their records carry. A mark that exists stays as it is, so a
    monitor that resumes keeps its own start.
    """
    files = spark.read.schema(schemas.TOPIC_RECORD).parquet(path).select(F.col("_metadata.file_path").alias("file")).distinct()
    files.write.mode("ignore").parquet(mark)


def stream_from_mark(spark: SparkSession, path: str, mark: str, *topics: str, files_per_batch: int | None = None) -> DataFrame:
    """Records that arrived after ``mark_start``, whatever their times: the log's files without those of the mark.

    Use a mark and a checkpoint of its own for every start of a monitor that never replays. The names of the marked
    files are joined by Spark, which sends them to all tasks only if their measured size allows.
    """
    reader = spark.readStream.schema(schemas.TOPIC_RECORD)
    if files_per_batch:
        reader = reader.option("maxFilesPerTrigger", files_per_batch)
    records = reader.parquet(path).withColumn("_file", F.col("_metadata.file_path"))
    if topics:
        records = records.where(F.col("topic").isin(*topics))
    seen = spark.read.schema("file string").parquet(mark)
    return records.join(seen, F.col("_file") == F.col("file"), "left_anti").drop("_file")


def from_latest(records: DataFrame, start: str, time: str = "timestamp") -> DataFrame:
    """Only records after the start, a UTC wall time; the filter reaches the scan."""
    limit = f"TIMESTAMP_NTZ {literal(start)}"
    instants = isinstance(records.schema[time].dataType, TimestampType)
    return records.where(f"{time} > {to_instant(limit) if instants else limit}")


def arrivals(records: DataFrame) -> DataFrame:
    """Records per topic, without reading keys or values."""
    return records.groupBy("topic").agg(F.count("*").alias("n"))
