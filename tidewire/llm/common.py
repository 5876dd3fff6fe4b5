"""Steps the training-data operators share: columns, folds, Arrow batches of texts, stored tables."""

from collections.abc import Callable, Iterator
from contextlib import contextmanager

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.pandas.types import to_arrow_schema

from tidewire.session import fresh_path, workers_find_package

#: Texts handled at once inside a task; a batch is cut further when its texts are long.
BATCH_ROWS = 2000
BATCH_CHARS = 8_000_000


def map_batches(df: DataFrame, run: Callable, schema: T.StructType) -> DataFrame:
    workers_find_package(df.sparkSession)
    return df.mapInArrow(run, schema)


def table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{folder}/{name}.parquet")


def crc_fold(column: str, folds: int) -> Column:
    """crc32 of the value as text, modulo ``folds``; a null counts as the empty text."""
    return F.pmod(F.crc32(F.coalesce(F.col(column).cast("string"), F.lit("")).cast("binary")), F.lit(folds))


def schema_of(df: DataFrame, keep: list[str], extra: str) -> T.StructType:
    """Columns ``keep`` of ``df``, nullable, and the columns that the DDL text ``extra`` names."""
    return T.StructType([
        *(T.StructField(c, df.schema[c].dataType) for c in keep), *T._parse_datatype_string(extra).fields])


def stored(df: DataFrame, label: str, *partitioned: str) -> DataFrame:
    """Write ``df`` to the shared folder, zstd-compressed, and read it back: cuts lineage and survives lost executors."""
    path = fresh_path(df.sparkSession, label)
    df.write.option("compression", "zstd").partitionBy(*partitioned).parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


@contextmanager
def shuffles_deleted(spark: SparkSession) -> Iterator[None]:
    """Spark deletes the shuffle files of every query that ends in here: what it made has been stored."""
    name = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"
    before = spark.conf.get(name)
    spark.conf.set(name, "true")
    try:
        yield
    finally:
        spark.conf.set(name, before)


def release(table: DataFrame) -> None:
    """Delete a table that ``stored`` wrote without partitions, once all that is read from it has been stored."""
    files = table.inputFiles()
    if files:
        jvm = table.sparkSession._jvm
        folder = jvm.org.apache.hadoop.fs.Path(files[0]).getParent()
        if not folder.getName().startswith("tidewire-"):
            raise ValueError(f"{folder} is no stored table")
        folder.getFileSystem(table.sparkSession._jsparkSession.sessionState().newHadoopConf()).delete(folder, True)


def slices(
    batch: pa.RecordBatch, text: str, rows: int = BATCH_ROWS, most: int = BATCH_CHARS
) -> Iterator[tuple[pa.RecordBatch, list[str]]]:
    """Parts of a batch with their texts (null: empty), bounded in rows and characters."""
    start, chars, texts = 0, 0, []
    for at, value in enumerate(batch.column(batch.schema.get_field_index(text)).to_pylist()):
        if texts and (len(texts) >= rows or chars > most):
            yield batch.slice(start, at - start), texts
            start, chars, texts = at, 0, []
        texts.append(value or "")
        chars += len(texts[-1])
    if texts:
        yield batch.slice(start), texts


def map_texts(
    df: DataFrame, keep: list[str], make: Callable[[], Callable[[list[str]], list]], extra: str, text: str = "text"
) -> DataFrame:
    """Columns ``keep`` and, for every row, what the function from ``make`` gives for its text.

    ``make`` runs once per task and returns a function from a list of texts to one list per column of ``extra``.
    """
    schema = schema_of(df, keep, extra)
    arrow = to_arrow_schema(schema)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        judge = make()
        for batch in batches:
            for part, texts in slices(batch, text):
                columns = [part.column(part.schema.get_field_index(c)) for c in keep]
                made = [v if isinstance(v, pa.Array) else pa.array(v, type=f.type) for v, f in zip(judge(texts), list(arrow)[len(keep):], strict=True)]
                yield pa.RecordBatch.from_arrays(columns + made, schema=pa.schema(
                    [pa.field(f.name, c.type) for f, c in zip(arrow, columns + made)]))

    return map_batches(df.select(*dict.fromkeys([*keep, text])), run, schema)
