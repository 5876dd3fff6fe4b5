import pytest
from pyspark.sql import types as T

from .conftest_rows import ROWS

SCHEMA = T.StructType([
    T.StructField("doc_id", T.LongType()), T.StructField("text", T.StringType()), T.StructField("source", T.StringType()),
    # Names that operators use for columns of their own.
    T.StructField("n_words", T.StringType()), T.StructField("row", T.StringType()), T.StructField("class", T.StringType()),
    T.StructField("text_key", T.StringType()), T.StructField("position", T.StringType()),
])


@pytest.fixture(scope="session")
def docs(spark):
    return spark.createDataFrame([(*r, "n", "r", "c", "k", "p") for r in ROWS], SCHEMA)


@pytest.fixture(scope="session")
def nothing(spark):
    return spark.createDataFrame([], SCHEMA)
