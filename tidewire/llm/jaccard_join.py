"""Similarity join on word n-grams: MinHash banding finds candidates, full n-gram sets verify them.

Documents of equal n-gram sets form one class first; everything after that sees one representative per class, so
copies never meet each other. Bands put representatives into buckets; buckets that share members form a candidate
group. A group's sets are dealt out in blocks, every pair of blocks is one task's work, and the pairs inside it are
counted by a matrix product: no pair of documents becomes a row.
"""

import hashlib
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidewire.llm.common import map_texts, stored, workers_find_package
from tidewire.llm.components import components

#: Sets and n-grams that one block may hold; a task compares two blocks.
BLOCK_SETS = 256
BLOCK_GRAMS = 400_000
#: Columns of the incidence matrix that are multiplied at once.
COLUMNS = 8192


def bands_for(threshold: float, recall: float, rows: int = 7) -> int:
    """Bands of ``rows`` hashes that find a pair at the threshold with probability ``recall``."""
    return int(np.ceil(np.log1p(-recall) / np.log1p(-(threshold ** rows))))


def gram_set(text: str, n: int) -> np.ndarray:
    """Sorted distinct 64-bit hashes of the word n-grams; a text of fewer words is one n-gram, an empty one has none."""
    words = text.encode("utf-8", "surrogatepass").split()
    if not words:
        return np.empty(0, np.uint64)
    hashed = pd.util.hash_array(np.array(words, object), categorize=len(words) > 200)
    n = min(n, len(words))
    mixed = np.zeros(len(words) - n + 1, np.uint64)
    for step in range(n):
        mixed = mixed * np.uint64(0x9E3779B97F4A7C15) + hashed[step:step + len(mixed)]
        mixed ^= mixed >> np.uint64(29)
    return np.unique(mixed)


class Sketcher:
    """MinHash bands of n-gram sets; the hash functions follow from their number alone."""

    def __init__(self, n: int, bands: int, rows: int):
        random = np.random.default_rng(20240117)
        self.n, self.bands, self.rows = n, bands, rows
        self.factors = random.integers(1, 2 ** 63, bands * rows, dtype=np.uint64) * np.uint64(2) + np.uint64(1)
        self.added = random.integers(0, 2 ** 63, bands * rows, dtype=np.uint64)
        self.weights = random.integers(1, 2 ** 63, rows, dtype=np.uint64) * np.uint64(2) + np.uint64(1)

    def of(self, grams: np.ndarray) -> np.ndarray:
        least = np.full(bands_rows := self.bands * self.rows, np.uint64(2 ** 64 - 1))
        for start in range(0, len(grams), 512):
            part = grams[start:start + 512, None] * self.factors + self.added
            np.minimum(least, part.min(axis=0), out=least)
        mixed = ((least >> np.uint64(7)).reshape(self.bands, self.rows) * self.weights).sum(axis=1, dtype=np.uint64)
        mixed = (mixed ^ mixed >> np.uint64(31)) * np.uint64(0xD6E8FEB86659FD93) + np.arange(self.bands, dtype=np.uint64)
        assert len(least) == bands_rows
        return mixed.view(np.int64)


def sketches(docs: DataFrame, n: int, bands: int, rows: int) -> DataFrame:
    """Stored ``doc_id, text_key, class, n_grams, bands``; ``class`` is a digest of the whole n-gram set."""
    def make():
        sketcher = Sketcher(n, bands, rows)
        last: dict[bytes, list[int]] = {}

        def judge(texts: list[str]) -> list:
            made = ([], [], [])
            for text in texts:
                grams = gram_set(text, n)
                digest = hashlib.blake2b(grams.tobytes(), digest_size=16).digest()
                if digest not in last:
                    if len(last) >= 5000:
                        last.clear()
                    last[digest] = sketcher.of(grams).tolist() if len(grams) else []
                for column, value in zip(made, (digest, len(grams), last[digest])):
                    column.append(value)
            return list(made)

        return judge

    keyed = docs.select("doc_id", "text", F.xxhash64("text").alias("text_key"))
    return stored(
        map_texts(keyed, ["doc_id", "text_key"], make, "class binary, n_grams long, bands array<long>"), "sketches")


def candidate_groups(classes: DataFrame) -> DataFrame:
    """``class, group`` of classes that share a band bucket, directly or by way of others."""
    members = classes.select("class", F.explode("bands").alias("bucket"))
    hubs = members.groupBy("bucket").agg(F.min("class").alias("b"), F.max("class").alias("most")).where(
        "b != most").select("bucket", "b")
    edges = members.join(hubs, "bucket").where(F.col("class") != F.col("b")).select(F.col("class").alias("a"), "b")
    return components(edges, "candidates").select(F.col("node").alias("class"), F.col("component").alias("group"))


def links_between(ids: list[bytes], sets: list[np.ndarray], left: np.ndarray, right: np.ndarray, threshold: float):
    """Boolean matrix: which of the sets ``left`` and ``right`` (indexes) are similar enough, by the whole sets."""
    sizes = np.array([len(s) for s in sets])
    values = np.concatenate(sets)
    order = np.argsort(values, kind="stable")
    fresh = np.empty(len(values), bool)
    fresh[:1] = True
    ordered = values[order]
    fresh[1:] = ordered[1:] != ordered[:-1]
    column = np.empty(len(values), np.int64)
    column[order] = np.cumsum(fresh) - 1
    shared = np.bincount(column) > 1  # an n-gram of one set alone adds to no intersection
    renumbered = np.cumsum(shared) - 1
    owner = np.repeat(np.arange(len(sets)), sizes)
    keep = shared[column]
    owner, column = owner[keep], renumbered[column[keep]]
    by = np.argsort(column, kind="stable")
    owner, column = owner[by], column[by]
    common = np.zeros((len(left), len(right)), np.float32)
    width = int(shared.sum())
    for start in range(0, width, COLUMNS):
        lo, hi = np.searchsorted(column, (start, start + COLUMNS))
        matrix = np.zeros((len(sets), min(COLUMNS, width - start)), np.float32)
        matrix[owner[lo:hi], column[lo:hi] - start] = 1
        common += matrix[left] @ matrix[right].T
    union = sizes[left][:, None] + sizes[right][None, :] - common
    return common >= threshold * union - 1e-6


def compare_blocks(rows: list[tuple], threshold: float) -> Iterator[tuple]:
    """For the sets of two blocks of a group: per set its linked classes, their documents, and a spanning link."""
    rows = sorted(rows, key=lambda r: r["class"])
    ids = [r["class"] for r in rows]
    sets = [np.frombuffer(r["grams"], np.uint64) for r in rows]
    copies = np.array([r["copies"] for r in rows], np.int64)
    block = np.array([r["block"] for r in rows])
    low, high = rows[0]["low"], rows[0]["high"]
    left, right = np.flatnonzero(block == low), np.flatnonzero(block == high)
    if not len(left) or not len(right):
        return
    similar = links_between(ids, sets, left, right, threshold)
    if low == high:
        np.fill_diagonal(similar, False)
    parent = list(range(len(rows)))

    def root(at):
        while parent[at] != at:
            parent[at] = at = parent[parent[at]]
        return at

    for i, j in zip(*np.nonzero(similar)):
        a, b = root(int(left[i])), root(int(right[j]))
        if a != b:
            parent[max(a, b)] = min(a, b)
    texts, documents = np.zeros(len(rows), np.int64), np.zeros(len(rows), np.int64)
    texts[left] += similar.sum(axis=1)
    documents[left] += similar @ copies[right]
    if low != high:
        texts[right] += similar.sum(axis=0)
        documents[right] += similar.T @ copies[left]
    for at in np.flatnonzero(texts):
        yield ids[at], int(texts[at]), int(documents[at]), ids[root(int(at))]


def verified(docs: DataFrame, groups: DataFrame, n: int, threshold: float) -> DataFrame:
    """Stored ``class, n_texts, n_documents, linked``: partial link counts and spanning links of each pair of blocks."""
    sizes = groups.groupBy("group").agg(
        F.greatest(
            F.ceil(F.count("*") / BLOCK_SETS), F.ceil(F.sum("n_grams") / BLOCK_GRAMS)).cast("int").alias("blocks"))
    placed = groups.join(sizes, "group").withColumn("block", F.pmod(F.xxhash64("class"), F.col("blocks")).cast("int"))
    wanted = docs.select("doc_id", F.xxhash64("text").alias("text_key"), "text").join(
        placed, F.col("doc_id").eqNullSafe(F.col("rep_doc")) & (F.col("text_key") == F.col("rep_key"))
    ).dropDuplicates(["doc_id", "text_key"]).select("class", "group", "block", "blocks", "copies", "text")
    sets = map_texts(
        wanted, ["class", "group", "block", "blocks", "copies"],
        lambda: lambda texts: [[gram_set(t, n).tobytes() for t in texts]], "grams binary")
    other = F.explode(F.sequence(F.lit(0), F.col("blocks") - 1))
    dealt = sets.withColumn("other", other).withColumn("low", F.least("block", "other")).withColumn(
        "high", F.greatest("block", "other"))
    schema = T._parse_datatype_string("class binary, n_texts long, n_documents long, linked binary")

    def compare(part: pa.Table) -> pa.Table:
        made = list(zip(*compare_blocks(part.to_pylist(), threshold))) or [[], [], [], []]
        return pa.table(dict(zip(schema.names, made)), schema=pa.schema([
            ("class", pa.binary()), ("n_texts", pa.int64()), ("n_documents", pa.int64()), ("linked", pa.binary())]))

    workers_find_package(docs.sparkSession)
    return stored(dealt.groupBy("group", "low", "high").applyInArrow(compare, schema), "links")


def jaccard_join(docs: DataFrame, n: int = 5, threshold: float = 0.8, recall: float = 0.9995) -> DataFrame:
    """``doc_id, text_key, class_id, n_links, n_linked_texts, n_copies, n_grams``, one row per input row.

    Words are runs without ASCII blanks, unchanged. ``class_id`` is the least doc_id that links of similarity
    ``threshold`` or more lead to. ``n_links`` counts the other rows within the threshold, copies among them,
    ``n_linked_texts`` the other n-gram sets, ``n_copies`` the other rows of the same set. Links follow from whole
    sets; a pair at the threshold becomes a candidate with probability ``recall``, a more similar one more often.
    A text of fewer than ``n`` words is one n-gram. Null and empty texts have no n-grams, link to nothing and are
    classes of their own. Repeated rows count as copies. Other columns are ignored.
    """
    rows = 7
    sketched = sketches(docs, n, bands_for(threshold, recall, rows), rows)
    full = sketched.where("n_grams > 0")
    classes = stored(
        full.groupBy("class").agg(
            F.min(F.struct("doc_id", "text_key", "n_grams", "bands")).alias("rep"), F.count("*").alias("copies")
        ).select("class", "copies", F.col("rep.doc_id").alias("rep_doc"), F.col("rep.text_key").alias("rep_key"),
                 "rep.n_grams", "rep.bands"), "classes")
    groups = classes.drop("bands").join(candidate_groups(classes), "class")
    links = verified(docs, groups, n, threshold)
    counts = links.groupBy("class").agg(F.sum("n_texts").alias("n_texts"), F.sum("n_documents").alias("n_documents"))
    joined = components(links.select(F.col("class").alias("a"), F.col("linked").alias("b")), "joined").select(
        F.col("node").alias("class"), "component")
    least = classes.select("class", "rep_doc").join(joined, "class").groupBy("component").agg(
        F.min("rep_doc").alias("least"))
    linked = joined.join(least, "component").select("class", "least")
    of_class = classes.select("class", "copies", "rep_doc").join(counts, "class", "left").join(
        linked, "class", "left").select(
        "class", "copies", F.coalesce("least", "rep_doc").alias("class_id"),
        F.coalesce("n_texts", F.lit(0)).alias("n_texts"), F.coalesce("n_documents", F.lit(0)).alias("n_documents"))
    return sketched.select("doc_id", "text_key", "class", "n_grams").join(of_class, "class", "left").select(
        "doc_id", "text_key", F.when(F.col("n_grams") > 0, F.col("class_id")).otherwise(F.col("doc_id")).alias("class_id"),
        F.coalesce(F.col("n_documents") + F.col("copies") - 1, F.lit(0)).alias("n_links"),
        F.coalesce("n_texts", F.lit(0)).alias("n_linked_texts"),
        F.coalesce(F.col("copies") - 1, F.lit(0)).alias("n_copies"), "n_grams")


def drop_near_copies(docs: DataFrame, n: int = 5, threshold: float = 0.8, recall: float = 0.9995) -> DataFrame:
    """``docs`` with one row of each class of near copies: that of the least doc_id, once.

    Null and empty texts are no copies and all stay. Columns and their order stay.
    """
    judged = jaccard_join(docs, n, threshold, recall)
    kept = judged.where(F.col("class_id").eqNullSafe(F.col("doc_id"))).select(
        F.col("doc_id").alias("_doc"), F.col("text_key").alias("_key"), F.col("n_grams").alias("_grams")).distinct()
    marked = docs.select(F.struct(*(F.col(f"`{c}`") for c in docs.columns)).alias("_row"), F.col("doc_id").alias("_id"),
                         F.xxhash64("text").alias("_text"))
    joined = marked.join(kept, F.col("_id").eqNullSafe(F.col("_doc")) & (F.col("_text") == F.col("_key")))
    within = Window.partitionBy("_id", "_text").orderBy("_grams")
    return joined.withColumn("_at", F.row_number().over(within)).where(
        (F.col("_at") == 1) | (F.col("_grams") == 0)).select("_row.*")
