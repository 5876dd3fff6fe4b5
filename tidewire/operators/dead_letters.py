"""Records that failed for good: kept with their attempts, sent round again once each."""

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidewire import schemas

#: A dead letter: its record, why and how often it failed, and how often it was sent round before.
LETTER = T.StructType([
    *schemas.TOPIC_RECORD.fields, T.StructField("reason", T.StringType()), T.StructField("attempts", T.IntegerType()),
    T.StructField("round", T.IntegerType())])
_ID = ["topic", "partition", "offset", "round"]


def letters(records: DataFrame, outcomes: DataFrame, rounds: DataFrame | None = None) -> DataFrame:
    """Dead letters of a run: the records whose outcome is recovered, by topic, partition and offset.

    ``rounds`` holds the letters these records came from, if they were sent round before: attempts are added up.
    """
    place = ["topic", "partition", "offset"]
    failed = outcomes.where("status = 'recovered'").select(*place, "reason", "attempts")
    dead = records.join(failed, place)
    if rounds is None:
        return dead.withColumn("round", F.lit(0)).select(*LETTER.fieldNames())
    earlier = rounds.select(*place, F.col("attempts").alias("_before"), F.col("round").alias("_round"))
    return dead.join(earlier, place).withColumn("attempts", F.col("attempts") + F.col("_before")).withColumn(
        "round", F.col("_round") + 1).select(*LETTER.fieldNames())


def bury(dead: DataFrame, path: str, run: str) -> None:
    """Store the letters of a run in a folder of its own, which a repeated run overwrites."""
    dead.select(*LETTER.fieldNames()).write.mode("overwrite").parquet(f"{path}/run={run}")


def buried(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.schema(LETTER).option("basePath", path).parquet(path)


def redrive(spark: SparkSession, path: str, ledger: str, run: str, most_rounds: int = 3) -> DataFrame:
    """Letters to send round now: those that no earlier run has sent, with rounds left.

    They are written to ``ledger``, in the folder of the run, and read back from there: the ledger is both what is sent
    and what counts as sent. A run that has been written is only read again, so a letter goes round once, whether a run
    is repeated or another follows.
    """
    own = f"{ledger}/run={run}"
    if not _exists(spark, f"{own}/_SUCCESS"):
        waiting = buried(spark, path).where(F.col("round") < most_rounds)
        if _exists(spark, ledger):
            sent = spark.read.schema(T.StructType([*LETTER.fields, T.StructField("run", T.StringType())])).option(
                "basePath", ledger).parquet(ledger).where(F.col("run") != run)
            waiting = waiting.join(sent.select(*_ID), _ID, "left_anti")
        waiting.select(*LETTER.fieldNames()).write.mode("overwrite").parquet(own)
    return spark.read.schema(LETTER).parquet(own)


def _exists(spark: SparkSession, path: str) -> bool:
    place = spark._jvm.org.apache.hadoop.fs.Path(path)
    return place.getFileSystem(spark._jsparkSession.sessionState().newHadoopConf()).exists(place)
