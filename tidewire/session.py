"""Session settings and the shared folder for tables that cut lineage."""

import os
import re
import tempfile
from collections.abc import Iterator
from contextlib import contextmanager
from contextvars import ContextVar
from pathlib import Path
from uuid import uuid4

from pyspark.sql import DataFrame, SparkSession

ROOT = str(Path(__file__).resolve().parents[1])
#: The provider of state stores that operators with arbitrary state need.
ROCKSDB = "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"


def build_session(app_name: str = "tidewire", master: str | None = None, **settings: str) -> SparkSession:
    """A session with the settings the jobs expect; ``settings`` override them."""
    defaults = {
        "spark.sql.session.timeZone": "UTC",
        "spark.sql.adaptive.enabled": "true",
        "spark.sql.adaptive.skewJoin.enabled": "true",
        "spark.sql.streaming.stateStore.providerClass": ROCKSDB,
    }
    builder = SparkSession.builder.appName(app_name)
    if master:
        builder = builder.master(master)
    for key, value in {**defaults, **settings}.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()


def workers_find_package(spark: SparkSession) -> None:
    """Put this package's folder on the path of the Python workers; where it is installed, this changes nothing."""
    env = spark.sparkContext.environment
    paths = env.get("PYTHONPATH", "").split(os.pathsep)
    if ROOT not in paths:
        env["PYTHONPATH"] = os.pathsep.join([p for p in paths if p] + [ROOT])


@contextmanager
def state_in_rocksdb(spark: SparkSession) -> Iterator[None]:
    """Streaming queries that start in here keep their state in RocksDB, whatever the session's provider is."""
    name = "spark.sql.streaming.stateStore.providerClass"
    before = spark.conf.get(name, None)
    spark.conf.set(name, ROCKSDB)
    try:
        yield
    finally:
        if before is None:
            spark.conf.unset(name)
        else:
            spark.conf.set(name, before)


def shared_folder(spark: SparkSession) -> str:
    """The folder every executor can reach, named by ``spark.checkpoint.dir``.

    Only a local session may fall back to a temporary folder: on a cluster a
    machine-local path would be lost with the machine.
    """
    folder = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getCheckpointDir()
    if folder:
        return folder.rstrip("/")
    if not re.fullmatch(r"local(\[.*\])?", spark.sparkContext.master):
        raise ValueError("set spark.checkpoint.dir to a folder that all executors share")
    folder = tempfile.mkdtemp(prefix="tidewire-")
    spark.sparkContext.setCheckpointDir(folder)
    return folder


def fresh_path(spark: SparkSession, label: str) -> str:
    """A path below the shared folder that nothing has used before."""
    return f"{shared_folder(spark)}/tidewire-{label}-{uuid4().hex}"


def write_through(df: DataFrame, label: str) -> DataFrame:
    """Store ``df`` as a parquet table in the shared folder and read it back.

    Used where a value must be fixed once (a row's position after a range
    sort) before two branches of a plan read it. Unlike a checkpointed RDD the
    table stays columnar, so later scans prune columns and push filters.
    """
    spark = df.sparkSession
    path = fresh_path(spark, label)
    held = _held.get()
    if held is not None:
        held.append(path)
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


#: Folders that ``write_through`` has filled inside the innermost ``released`` block.
_held: ContextVar[list[str] | None] = ContextVar("held", default=None)


@contextmanager
def released(spark: SparkSession) -> Iterator[None]:
    """Delete the tables that ``write_through`` writes in the block when it ends, whether it fails or not.

    Results that read them are to be written inside the block. Without one, the tables stay until the folder is
    expired.
    """
    paths: list[str] = []
    token = _held.set(paths)
    try:
        yield
    finally:
        _held.reset(token)
        for path in paths:
            place = spark._jvm.org.apache.hadoop.fs.Path(path)
            place.getFileSystem(spark._jsparkSession.sessionState().newHadoopConf()).delete(place, True)
