"""The corpus pipeline: quality, near copies, benchmark contamination, secrets, packing.

Every stage takes ``(spark, docs, sf_dir)``, is written as Parquet and reread as the next one's ``docs``. All but the
last return the columns of ``documents``.
"""

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession

from tidewire.llm import decontaminate, jaccard_join, packing, preference, secret_scan
from tidewire.llm.common import stored, table


def quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the preference ranking accepts."""
    return preference.keep_preferred(docs, table(spark, sf_dir, "labels"))


def near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document, that of the least doc_id, of each class of near copies."""
    return jaccard_join.drop_near_copies(docs)


def decontamination(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that no benchmark item contaminates."""
    return decontaminate.drop_contaminated(docs, table(spark, sf_dir, "benchmark"))


def secrets(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents, secrets replaced by a mark."""
    return secret_scan.redact(docs)


def pack(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pieces of sequences of 2048 tokens, mixed by source."""
    return packing.pack(docs, public_tokenizers.path("byte_bpe_50k.tiktoken"))


STAGES = [
    ("quality", quality),
    ("near_copies", near_copies),
    ("decontamination", decontamination),
    ("secrets", secrets),
    ("packing", pack),
]

#: A learnt ranking and a tokenizer are no SQL; the tests hold the stages against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = stored(stage(spark, docs, sf_dir), f"pipeline-{name}")
    name, stage = STAGES[-1]
    return stored(stage(spark, docs, sf_dir), f"pipeline-{name}")
