"""Many small batch folders of a table sink as one: a manifest names what readers see.

A sink that polls twice a second makes 172 800 folders a day. ``compact`` copies the batches that are done into one
table below ``_compact`` and then puts a new manifest in place by a rename. The manifest holds the compacted tables and,
for every query, the last batch they cover. A reader takes the tables of the newest manifest and the batch folders
after it, so it sees each row once: before the swap from the folders, after it from the table. A batch that is replayed
later writes its folder again, which no reader looks at. ``vacuum`` deletes what the newest manifest has replaced.
"""

import json
import re
from uuid import uuid4

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.types import IntegerType, StringType, StructField, StructType

MANIFESTS, TABLES = "_manifests", "_compact"


class _Folder:
    """Names and small files below a path of the file system Spark uses."""

    def __init__(self, spark: SparkSession, path: str):
        self._jvm, self._path = spark._jvm, path.rstrip("/")
        self._fs = self._at("").getFileSystem(spark._jsparkSession.sessionState().newHadoopConf())

    def _at(self, name: str):
        return self._jvm.org.apache.hadoop.fs.Path(f"{self._path}/{name}" if name else self._path)

    def names(self, name: str = "") -> list[str]:
        if not self._fs.exists(self._at(name)):
            return []
        return [s.getPath().getName() for s in self._fs.listStatus(self._at(name))]

    def text(self, name: str) -> str:
        stream = self._fs.open(self._at(name))
        try:
            return self._jvm.org.apache.commons.io.IOUtils.toString(stream, "UTF-8")
        finally:
            stream.close()

    def put(self, name: str, text: str) -> bool:
        """Write under another name and rename; False if the name is taken."""
        draft = f"{MANIFESTS}/.{uuid4().hex}"
        stream = self._fs.create(self._at(draft))
        stream.write(text.encode())
        stream.close()
        if self._fs.exists(self._at(name)):
            self._fs.delete(self._at(draft), False)
            return False
        return self._fs.rename(self._at(draft), self._at(name))

    def delete(self, name: str) -> None:
        self._fs.delete(self._at(name), True)


def _newest(folder: _Folder) -> tuple[int, dict]:
    numbers = [int(n.removesuffix(".json")) for n in folder.names(MANIFESTS) if re.fullmatch(r"\d+\.json", n)]
    if not numbers:
        return 0, {"tables": [], "covered": {}}
    return max(numbers), json.loads(folder.text(f"{MANIFESTS}/{max(numbers):012d}.json"))


def _batches(folder: _Folder) -> dict[str, list[int]]:
    """Batch ids of every query folder."""
    return {
        name.removeprefix("query="): sorted(
            int(n.removeprefix("batch_id=")) for n in folder.names(name) if n.startswith("batch_id="))
        for name in folder.names() if name.startswith("query=")}


def _read(spark: SparkSession, path: str, paths: list[str], schema: StructType | None) -> DataFrame:
    reader = spark.read.option("basePath", path)
    if schema:
        named = {f.name for f in schema}
        extra = [f for f in (StructField("query", StringType()), StructField("batch_id", IntegerType())) if f.name not in named]
        reader = reader.schema(StructType([*schema, *extra]))
    return reader.parquet(*paths)


def is_compacted(spark: SparkSession, path: str) -> bool:
    return bool(_Folder(spark, path).names(MANIFESTS))


def read_compacted(spark: SparkSession, path: str, schema: StructType | None = None) -> DataFrame:
    """All rows of a table sink, whether compacted or not, as ``read_table`` gives them."""
    folder = _Folder(spark, path)
    _, manifest = _newest(folder)
    covered = manifest["covered"]
    fresh = [
        f"{path}/query={query}/batch_id={n}" for query, ids in _batches(folder).items() for n in ids
        if n > covered.get(query, -1)]
    parts = [_read(spark, f"{path}/{table}", [f"{path}/{table}"], schema) for table in manifest["tables"]]
    if fresh:
        parts.append(_read(spark, path, fresh, schema))
    if not parts:
        raise ValueError(f"nothing is stored at {path}")
    whole, *others = parts
    for other in others:
        whole = whole.unionByName(other)
    return whole.drop("query")


def compact(
    spark: SparkSession, path: str, *partition_by: str, schema: StructType | None = None, leave: int = 1, files: int | None = None
) -> int:
    """Compact all batches but the last ``leave`` of every query, which may still be written; the number of folders taken.

    ``partition_by`` are the sink's own partition columns. Earlier tables stay as they are, so every row is copied once;
    ``files`` sets the number of files of the new table. Of two compactions at once, one fails and changes nothing.
    """
    folder = _Folder(spark, path)
    number, manifest = _newest(folder)
    covered = dict(manifest["covered"])
    taken = []
    for query, ids in _batches(folder).items():
        done = [n for n in ids[:len(ids) - leave] if n > covered.get(query, -1)]
        if done:
            covered[query] = done[-1]
            taken += [f"{path}/query={query}/batch_id={n}" for n in done]
    if not taken:
        return 0
    rows = _read(spark, path, taken, schema)
    table = f"{TABLES}/{uuid4().hex}"
    writer = (rows.coalesce(files) if files else rows).write
    (writer.partitionBy(*partition_by) if partition_by else writer).parquet(f"{path}/{table}")
    text = json.dumps({"tables": [*manifest["tables"], table], "covered": covered})
    if not folder.put(f"{MANIFESTS}/{number + 1:012d}.json", text):
        folder.delete(table)
        raise RuntimeError(f"another compaction of {path} has come first")
    return len(taken)


def vacuum(spark: SparkSession, path: str) -> int:
    """Delete batch folders, tables and manifests that the newest manifest has replaced; how many.

    Call it when no reader that began before the last ``compact`` is still at work.
    """
    folder = _Folder(spark, path)
    number, manifest = _newest(folder)
    gone = [
        f"query={query}/batch_id={n}" for query, ids in _batches(folder).items() for n in ids
        if n <= manifest["covered"].get(query, -1)]
    gone += [f"{TABLES}/{t}" for t in folder.names(TABLES) if f"{TABLES}/{t}" not in manifest["tables"]]
    gone += [f"{MANIFESTS}/{n}" for n in folder.names(MANIFESTS) if re.fullmatch(r"\d+\.json", n) and int(n[:-5]) < number]
    for name in gone:
        folder.delete(name)
    return len(gone)


def folders(spark: SparkSession, path: str) -> int:
    """Folders a reader lists: compacted tables and batches after them."""
    folder = _Folder(spark, path)
    _, manifest = _newest(folder)
    return len(manifest["tables"]) + sum(
        n > manifest["covered"].get(query, -1) for query, ids in _batches(folder).items() for n in ids)
