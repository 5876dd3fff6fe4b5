"""Substring deduplication: windows of 20 words, gathered into paths around anchors, judged by coordinates.

This stands in for the compaction of a de Bruijn graph by joins: no nodes or degrees are counted, and paths are cut in
each text instead of being joined node by node. The README says why. Every window has an anchor, the
least-hashed 4-gram inside it, so equal windows have equal anchors: an anchor that only one text holds proves its
windows unique, and they are never shuffled. The other windows compact into the paths of consecutive windows around
one anchor. A path that occurs earlier as a whole is removed as a whole. The first occurrences of paths whose anchor
has several paths alone are cut into their windows, since the first occurrence of any window lies in one of them.
"""

import hashlib

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import to_arrow_schema

from tidewire.llm.common import map_batches, map_texts, release, schema_of, shuffles_deleted, slices, stored

ANCHOR = 4
EMPTY_SHA = hashlib.sha256(b"").hexdigest()
_FACTORS = (np.uint64(0x9E3779B97F4A7C15), np.uint64(0xC2B2AE3D27D4EB4F))


def _mixed(value: np.ndarray) -> np.ndarray:
    value = (value ^ value >> np.uint64(32)) * np.uint64(0xD6E8FEB86659FD93)
    return value ^ value >> np.uint64(29)


def _rolled(hashed: np.ndarray, size: int, factor: np.uint64) -> np.ndarray:
    """Polynomial hash of every ``size`` values in a row, put together from runs whose lengths are powers of two."""
    n, made, covered = len(hashed) - size + 1, None, 0
    run, width, power = hashed, 1, int(factor)
    while size:
        if size & 1:
            part = run[covered:covered + n]
            made = part if made is None else made * np.uint64(power) + part
            covered += width
        size >>= 1
        if size:
            run = run[:-width] * np.uint64(power) + run[width:]
            power, width = power * power % 2 ** 64, 2 * width
    return made


def _least(values: np.ndarray, size: int) -> np.ndarray:
    """Place of the first least value of every ``size`` in a row."""
    place, width = np.arange(len(values)), 1
    while width < size:
        step = min(width, size - width)
        later = values[step:] < values[:-step]
        place = np.where(later, place[step:], place[:-step])
        values = np.minimum(values[:-step], values[step:])
        width += step
    return place


class Windows:
    """Word windows of a text: two 64-bit hashes of each (``high``, ``low``), its anchor and the anchor's place."""

    def __init__(self, words: list[bytes], size: int, both: bool = True):
        hashed = pd.util.hash_array(np.array(words, object), categorize=False)
        grams = _mixed(_rolled(hashed, ANCHOR, _FACTORS[0]))
        self.place = _least(grams, size - ANCHOR + 1)
        self.anchor = grams[self.place].view(np.int64)
        if both:
            self.high = _mixed(_rolled(hashed, size, _FACTORS[0]))
            self.low = _mixed(_rolled(_mixed(hashed), size, _FACTORS[1]))

    def paths(self, anchors: np.ndarray):
        """(start, windows, anchor, high, low) of the runs of windows around one place whose anchor is among ``anchors``."""
        cuts = np.flatnonzero(np.diff(self.place)) + 1
        first = np.concatenate(([0], cuts))
        last = np.concatenate((cuts, [len(self.place)])) - 1
        chosen = np.isin(self.anchor[first], anchors)
        first, last = first[chosen], last[chosen]
        n = (last - first + 1).astype(np.uint64)
        # The first and the last window of a path hold all its words between them.
        ends = [_mixed(_mixed(h[first] + n) * f + h[last]) for h, f in zip((self.high, self.low), _FACTORS)]
        return first, n.astype(np.int64), self.anchor[first], ends[0].view(np.int64), ends[1].view(np.int64)


def split(text: str) -> list[bytes]:
    return text.encode("utf-8", "surrogatepass").split()


def sketches(docs: DataFrame, size: int) -> DataFrame:
    """Stored ``doc_id, text_key, row_key, n_words, digest, sha, anchors, repeated``: ``repeated`` ones occur twice in it."""
    def judge(texts: list[str]) -> list:
        made = ([], [], [], [], [])
        for text in texts:
            words = split(text)
            joined = b" ".join(words)
            anchors = twice = np.empty(0, np.int64)
            if len(words) >= size:
                windows = Windows(words, size, both=False)
                changes = np.concatenate(([True], np.diff(windows.place) > 0))
                anchors, counts = np.unique(windows.anchor[changes], return_counts=True)
                twice = anchors[counts > 1]
            for column, value in zip(made, (
                    len(words), hashlib.blake2b(joined, digest_size=16).digest(), hashlib.sha256(joined).hexdigest(),
                    anchors, twice)):
                column.append(value)
        return list(made)

    keyed = docs.select("doc_id", "text", F.xxhash64("text").alias("text_key"), F.xxhash64("doc_id", "text").alias("row_key"))
    return stored(map_texts(
        keyed, ["doc_id", "text_key", "row_key"], lambda: judge,
        "n_words long, digest binary, sha string, anchors array<long>, repeated array<long>"), "substring-sketches")


def _expand(df: DataFrame, keep: list[str], extra: str, make) -> DataFrame:
    """Rows that ``make(text, value)`` yields for each text and its ``given`` value, with columns ``keep``."""
    schema = schema_of(df, keep, extra)
    arrow = to_arrow_schema(schema)

    def run(batches):
        for batch in batches:
            for part, texts in slices(batch, "text"):
                given = part.column(part.schema.get_field_index("given")).to_pylist()
                rows, made = [], [[] for _ in list(arrow)[len(keep):]]
                for at, (text, value) in enumerate(zip(texts, given)):
                    columns = make(text, value)
                    rows.append(np.full(len(columns[0]), at))
                    for column, values in zip(made, columns):
                        column.append(values)
                take = pa.array(np.concatenate(rows))
                yield pa.RecordBatch.from_arrays(
                    [part.column(part.schema.get_field_index(c)).take(take) for c in keep]
                    + [pa.array(np.concatenate(v), f.type) for v, f in zip(made, list(arrow)[len(keep):])],
                    names=schema.names)

    return map_batches(df.select(*keep, "text", "given"), run, schema)


def based(sketched: DataFrame) -> DataFrame:
    """Stored ``digest, doc_id, text_key, row_key, base``: the first row of each word sequence and its base.

    Bases number the words of these rows in the order of doc_id and text, with one more per row: ``base + start`` is
    one long that orders all windows. Sums run inside ranges; one row per range carries them on.
    """
    firsts = sketched.groupBy("digest").agg(
        F.min(F.struct("doc_id", "text_key", "row_key")).alias("first"), F.max("n_words").alias("n_words")
    ).select("digest", "first.*", (F.col("n_words") + 1).alias("room"))
    ranged = stored(
        firsts.repartitionByRange("doc_id", "text_key").withColumn("range", F.spark_partition_id()), "substring-ranges")
    earlier = ranged.groupBy("range").agg(F.sum("room").alias("room")).select(
        "range", F.sum("room").over(Window.orderBy("range").rowsBetween(Window.unboundedPreceding, -1)).alias("earlier"))
    inside = F.sum("room").over(
        Window.partitionBy("range").orderBy("doc_id", "text_key").rowsBetween(Window.unboundedPreceding, -1))
    numbered = ranged.withColumn("inside", inside).join(F.broadcast(earlier), "range")  # one row per range
    made = stored(numbered.select(
        "digest", "doc_id", "text_key", "row_key",
        (F.coalesce("inside", F.lit(0)) + F.coalesce("earlier", F.lit(0))).alias("base")), "substring-firsts")
    release(ranged)
    return made


def first_of(rows: DataFrame, label: str) -> DataFrame:
    """Stored place of the first row of each (high, low) that has several.

    As a table of its own it leaves both sides of the later join plain shuffles, which Spark splits where a key is hot.
    """
    firsts = rows.groupBy("high", "low").agg(F.min(F.col("base") + F.col("start")).alias("first"), F.count("*").alias("rows"))
    return stored(firsts.where("rows > 1").drop("rows"), label).hint("merge")


def repeated_spans(docs: DataFrame, sketched: DataFrame, firsts: DataFrame, size: int) -> tuple[DataFrame, DataFrame]:
    """Stored texts with shared anchors by base, and spans ``base, start, n`` of windows that start earlier too."""
    # An anchor is shared if texts of different words hold it; copies of one text are judged by their digest.
    held = sketched.select(
        F.xxhash64("digest").alias("short"), F.explode("anchors").alias("anchor"))
    shared = held.groupBy("anchor").agg(F.min("short").alias("least"), F.max("short").alias("most")).where(
        "least != most").select("anchor")
    own = sketched.select(F.xxhash64("digest").alias("short"), F.explode("repeated").alias("anchor"))
    # Stored, so that the shuffles of the anchors are gone before the texts are shuffled.
    wanted = stored(held.join(shared, "anchor").select("short", "anchor").unionByName(own).groupBy("short").agg(
        F.collect_set("anchor").alias("given")), "substring-wanted")
    places = firsts.select(
        F.xxhash64("digest").alias("short"), F.col("doc_id").alias("_doc"), F.col("row_key").alias("_row"), "base"
    ).join(wanted, "short").select("_doc", "_row", "base", "given")
    # The hash of the whole row deals the texts once, for the join and for dropping repeated rows.
    keyed = docs.select("doc_id", F.xxhash64("doc_id", "text").alias("row_key"), "text")
    texts = stored(keyed.join(
        places, (F.col("row_key") == F.col("_row")) & F.col("doc_id").eqNullSafe(F.col("_doc"))
    ).select("row_key", "base", "text", "given").dropDuplicates(["row_key", "base"]).drop("row_key"), "substring-texts")
    release(wanted)

    def paths(text, anchors):
        return Windows(split(text), size).paths(np.array(anchors, np.int64))

    found = stored(_expand(texts, ["base"], "start int, n int, anchor long, high long, low long", paths), "substring-paths")
    judged = found.join(first_of(found, "substring-first-paths"), ["high", "low"], "left").withColumn(
        "again", F.expr("coalesce(base + start != first, false)"))
    judged = stored(judged.select("base", "start", "n", "anchor", "again"), "substring-judged")
    release(found)

    def windows(text, spans):
        made = Windows(split(text), size)
        at = np.concatenate([np.arange(s["start"], s["start"] + s["n"]) for s in spans])
        return at, made.high[at].view(np.int64), made.low[at].view(np.int64)

    # Windows of different paths can only be equal where the paths have their anchor in common.
    once = judged.where("NOT again")
    branching = once.groupBy("anchor").agg(F.count("*").alias("paths")).where("paths > 1").select("anchor")
    fresh = once.join(branching, "anchor").groupBy("base").agg(F.collect_list(F.struct("start", "n")).alias("given"))
    ends = stored(
        _expand(texts.drop("given").join(fresh, "base"), ["base"], "start int, high long, low long", windows),
        "substring-windows")
    late = ends.join(first_of(ends, "substring-first-windows"), ["high", "low"]).where("base + start != first").select(
        "base", "start", F.lit(1).alias("n"))
    spans = stored(judged.where("again").select("base", "start", "n").unionByName(late), "substring-spans")
    release(ends)
    release(judged)
    return texts, spans


def kept_words(text: str, spans: list, size: int) -> list[bytes]:
    words = split(text)
    change = np.zeros(len(words) + 1, np.int64)
    for span in spans:
        change[span["start"]] += 1
        change[span["start"] + span["n"] + size - 1] -= 1
    gone = np.cumsum(change[:-1]) > 0
    return [w for w, g in zip(words, gone) if not g]


def substring_dedup(docs: DataFrame, size: int = 20) -> DataFrame:
    """``doc_id, n_words, n_removed, kept_sha256``, one row per input row.

    Words are runs without ASCII blanks. A word goes if a window of ``size`` words over it also starts earlier: in a
    smaller doc_id, or earlier in the same document; windows are judged on the input. Rows of one doc_id and text are
    one document and get the same result; of one doc_id and other texts, the order is that of the texts' hashes; null
    doc_ids come first. Null, empty and short texts lose nothing. Other columns are ignored. Windows are told apart
    by 128 bits of hash.
    """
    with shuffles_deleted(docs.sparkSession):
        sketched = sketches(docs, size)
        firsts = based(sketched)
        texts, spans = repeated_spans(docs, sketched, firsts, size)
    given = spans.groupBy("base").agg(F.collect_list(F.struct("start", "n")).alias("given"))

    def judge(text, found):
        words = kept_words(text, found, size)
        return np.array([len(words)]), np.array([hashlib.sha256(b" ".join(words)).hexdigest()])

    cut = _expand(texts.drop("given").join(given, "base"), ["base"], "n_kept long, cut_sha string", judge)
    heads = firsts.join(cut, "base", "left").select(
        "digest", F.struct("doc_id", "text_key").alias("first"), "n_kept", "cut_sha")
    copy = ~F.struct("doc_id", "text_key").eqNullSafe(F.col("first")) & (F.col("n_words") >= size)
    return sketched.select("doc_id", "text_key", "n_words", "digest", "sha").join(heads, "digest").select(
        "doc_id", "n_words",
        F.when(copy, F.col("n_words")).otherwise(F.col("n_words") - F.coalesce("n_kept", "n_words")).alias("n_removed"),
        F.when(copy, F.lit(EMPTY_SHA)).otherwise(F.coalesce("cut_sha", "sha")).alias("kept_sha256"))
