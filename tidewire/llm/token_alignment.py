"""Alignment of two tokenizers by their common byte boundaries, and corpus-wide counts of linked id pairs.

Both tokenizers cut the same bytes, so the offsets at which their tokens end are two rising lists. Every offset of the
shorter list is sought in the longer by galloping: from the place of the offset before it, in steps that double, then
by halving. Common offsets cut both lists into groups, and the differences of their ranks are the ranges of tokens that
overlap. Tokens of one group are linked.

The counts of id pairs need the corpus. A lot of documents writes each of its pairs once, with the number of its
documents that hold it; only these rows are shuffled by pair, so a pair that every document holds is one row a lot.
"""

from functools import lru_cache
from itertools import chain

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.pandas.types import to_arrow_schema

from tidewire.llm.common import map_batches, schema_of, slices, stored, workers_find_package
from tidewire.llm.encoders import byte_encoder

#: Offsets of the shorter list between two that are sought from their document's start.
STRIDE = 8
#: Links written out at once while the pairs of a lot are counted.
LINKS = 1_000_000
#: A lot: so many documents and characters at most, or one longer document.
LOT_ROWS, LOT_CHARS = 1000, 3_000_000
_WIDE = 32
_LOW = (1 << _WIDE) - 1
_NONE = np.zeros(0, np.int64)


class PieceEncoder:
    """A piece model; ``table`` holds the bytes of every id."""

    def __init__(self, path: str):
        import sentencepiece

        self._model = sentencepiece.SentencePieceProcessor(model_file=path)
        self.table = []
        for at in range(self._model.get_piece_size()):
            piece = self._model.id_to_piece(at)
            self.table.append(
                bytes([int(piece[3:5], 16)]) if self._model.is_byte(at) else piece.replace("▁", " ").encode())

    def ids(self, texts: list[str]) -> list[list[int]]:
        """Ids of every text, in front of which the model puts a blank."""
        return self._model.encode(texts, num_threads=1)


@lru_cache(maxsize=2)
def piece_encoder(path: str) -> PieceEncoder:
    return PieceEncoder(path)


class Pair:
    """Ids of both tokenizers for a blank and each of many texts."""

    def __init__(self, ranks: str, pieces: str):
        self.a, self.b = byte_encoder(ranks), piece_encoder(pieces)
        self.widths = tuple(np.array([len(t) for t in side.table]) for side in (self.a, self.b))

    def ids(self, texts: list[str]) -> tuple[list[int], tuple[np.ndarray, np.ndarray], tuple[np.ndarray, np.ndarray]]:
        """Places of the texts that both tokenizers give back, their ids of A and of B in a row, and the ids in each."""
        kept, every = [], ([], [])
        for at, (text, other) in enumerate(zip(texts, self.b.ids(texts))):
            if not text:
                continue
            # A cuts the bytes themselves and always gives them back; B knows a text's characters, or changes them.
            if b"".join(map(self.b.table.__getitem__, other)) == (" " + text).encode():
                kept.append(at)
                every[0].append(self.a.plain(" " + text))
                every[1].append(other)
        joined = [_joined(lists) for lists in every]
        return kept, (joined[0][0], joined[1][0]), (joined[0][1], joined[1][1])


def _joined(lists: list[list[int]]) -> tuple[np.ndarray, np.ndarray]:
    sizes = np.array([len(x) for x in lists], np.int64)
    return np.fromiter(chain.from_iterable(lists), np.int64, int(sizes.sum())), sizes


def gallop(values: np.ndarray, ends: np.ndarray, at: np.ndarray) -> np.ndarray:
    """First index of ``ends``, not before ``at``, whose offset is not below the value; the last offset is the greatest."""
    low, high, last = at.copy(), at.copy(), len(ends) - 1
    left, step = np.arange(len(values)), 1
    while left.size:
        left = left[ends[high[left]] < values[left]]
        low[left] = high[left] + 1
        high[left] = np.minimum(high[left] + step, last)
        step *= 2
    left = np.flatnonzero(low < high)
    while left.size:
        middle = (low[left] + high[left]) >> 1
        below = ends[middle] < values[left]
        low[left] = np.where(below, middle + 1, low[left])
        high[left] = np.where(below, high[left], middle)
        left = left[low[left] < high[left]]
    return low


def common_ends(ends_a: np.ndarray, ends_b: np.ndarray, starts_a: np.ndarray, starts_b: np.ndarray) -> tuple:
    """Indices, in both lists, of the offsets that both hold; ``starts`` are the first indices of each document."""
    swap = len(ends_a) > len(ends_b)
    short, long, begin, other = (ends_b, ends_a, starts_b, starts_a) if swap else (ends_a, ends_b, starts_a, starts_b)
    pivots = np.union1d(np.arange(0, len(short), STRIDE), begin)
    found = gallop(short[pivots], long, other[np.searchsorted(begin, pivots, "right") - 1])
    counts = np.diff(np.append(pivots, len(short)))
    places = gallop(short, long, np.repeat(found, counts))
    both = np.flatnonzero(long[places] == short)
    return (places[both], both) if swap else (both, places[both])


def links_of(
    a: np.ndarray, b: np.ndarray, first_a, size_a, first_b, size_b, doc, widths: tuple[int, int]
) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """``doc, pair, links`` of all groups, sorted; a pair is its two ids in one long."""
    made, (width_a, width_b) = [], widths
    sizes = size_a * size_b
    big = sizes > LINKS
    for g in np.flatnonzero(big):  # a group without common offsets for long: distinct ids only
        ids_a, times_a = np.unique(a[first_a[g]:first_a[g] + size_a[g]], return_counts=True)
        ids_b, times_b = np.unique(b[first_b[g]:first_b[g] + size_b[g]], return_counts=True)
        keys = (doc[g] * width_a + ids_a)[:, None] * width_b + ids_b[None, :]
        made.append((keys.ravel(), (times_a[:, None] * times_b[None, :]).ravel()))
    small = np.flatnonzero(~big)
    lots = (np.cumsum(sizes[small]) - 1) // LINKS
    for part in np.split(small, np.flatnonzero(np.diff(lots)) + 1) if small.size else ():
        wide = np.repeat(part, size_a[part])  # the group of every A token
        at = np.repeat(first_a[part] - np.cumsum(size_a[part]) + size_a[part], size_a[part]) + np.arange(wide.size)
        rep = size_b[wide]
        keys = np.repeat((doc[wide] * width_a + a[at]) * width_b, rep)
        shift = first_b[wide] - np.cumsum(rep) + rep
        keys += b[np.repeat(shift, rep) + np.arange(keys.size)]
        made.append(np.unique(keys, return_counts=True))
    if not made:
        return _NONE, _NONE, _NONE
    keys, times = (np.concatenate(m) for m in zip(*made))
    if len(made) > 1:
        order = np.argsort(keys, kind="stable")
        keys, times = keys[order], times[order]
        new = np.flatnonzero(np.append(True, keys[1:] != keys[:-1]))
        keys, times = keys[new], np.add.reduceat(times, new)
    holder, pairs = np.divmod(keys, width_a * width_b)
    return holder, pairs // width_b << _WIDE | pairs % width_b, times


class Writer:
    """Groups as text: ``a1,a2|b1;a3|b2,b3``."""

    def __init__(self, size_a: int, size_b: int):
        self.width = max(size_a, size_b)
        self.parts = [f"{mark}{i}" for mark in ("", ",", ";", "|") for i in range(self.width)]

    def write(self, a, b, first_a, size_a, first_b, size_b) -> str:
        """Ids with the mark before them, in the order of the text: each group's A ids, then its B ids."""
        code = np.empty(a.size + b.size, np.int64)
        group_a, group_b = np.repeat(np.arange(size_a.size), size_a), np.repeat(np.arange(size_b.size), size_b)
        mark_a, mark_b = np.full(a.size, 1), np.full(b.size, 1)
        mark_a[first_a], mark_b[first_b] = 2, 3
        mark_a[0] = 0
        code[np.arange(a.size) + first_b[group_a]] = mark_a * self.width + a
        code[np.arange(b.size) + first_a[group_b] + size_a[group_b]] = mark_b * self.width + b
        return "".join(map(self.parts.__getitem__, code.tolist()))


def aligned(docs: DataFrame, ranks: str, pieces: str, digest: bool) -> DataFrame:
    """Stored rows: per document ``lot, doc_id, n_*, groups`` and the places of its pairs in the lot's dictionary with
    their links; per lot the dictionary ``pairs`` with the documents that hold each."""
    import hashlib

    schema = schema_of(
        docs, ["doc_id"], "lot long, n_a long, n_b long, n_groups long, n_links long, groups string, "
        "places array<int>, links array<long>, pairs array<long>, holders array<int>")
    arrow = to_arrow_schema(schema)

    def run(batches):
        encode = Pair(ranks, pieces)
        table_a, table_b = encode.a.table, encode.b.table
        width_a, width_b = encode.widths
        writer, part, seq = Writer(len(table_a), len(table_b)), TaskContext.get().partitionId(), 0
        for batch in batches:
            for piece, texts in slices(batch, "text", LOT_ROWS, LOT_CHARS):
                n, lot = len(texts), part << 32 | seq
                seq += 1
                kept, (a, b), (lengths_a, lengths_b) = encode.ids(texts)
                counts = {k: np.zeros(n, np.int64) for k in ("a", "b", "groups", "links")}
                groups, places, links = [""] * n, [_NONE] * n, [_NONE] * n
                dictionary, holders = _NONE, _NONE
                if kept:
                    starts_a, starts_b = np.cumsum(lengths_a) - lengths_a, np.cumsum(lengths_b) - lengths_b
                    cut_a, cut_b = common_ends(np.cumsum(width_a[a]), np.cumsum(width_b[b]), starts_a, starts_b)
                    first_a, first_b = np.append(0, cut_a[:-1] + 1), np.append(0, cut_b[:-1] + 1)
                    size_a, size_b = cut_a + 1 - first_a, cut_b + 1 - first_b
                    doc = np.searchsorted(starts_a, first_a, "right") - 1
                    begin = np.searchsorted(doc, np.arange(len(kept)))
                    counts["a"][kept], counts["b"][kept] = lengths_a, lengths_b
                    counts["groups"][kept] = np.diff(np.append(begin, doc.size))
                    counts["links"][kept] = np.add.reduceat(size_a * size_b, begin)
                    for k, (lo, hi) in enumerate(zip(begin, np.append(begin[1:], doc.size))):
                        text = writer.write(
                            a[starts_a[k]:starts_a[k] + lengths_a[k]], b[starts_b[k]:starts_b[k] + lengths_b[k]],
                            first_a[lo:hi] - starts_a[k], size_a[lo:hi], first_b[lo:hi] - starts_b[k], size_b[lo:hi])
                        groups[kept[k]] = hashlib.sha256(text.encode()).hexdigest() if digest else text
                    holder, found, times = links_of(
                        a, b, first_a, size_a, first_b, size_b, doc, (len(table_a), len(table_b)))
                    dictionary, place, holders = np.unique(found, return_inverse=True, return_counts=True)
                    edges = np.searchsorted(holder, np.arange(len(kept) + 1))
                    for k, at in enumerate(kept):
                        places[at], links[at] = place[edges[k]:edges[k + 1]], times[edges[k]:edges[k + 1]]
                column = piece.column(piece.schema.get_field_index("doc_id"))
                made = [
                    np.full(n, lot), counts["a"], counts["b"], counts["groups"], counts["links"], groups, places, links,
                    [None] * n, [None] * n]
                yield pa.RecordBatch.from_arrays(
                    [column, *(pa.array(v, f.type) for v, f in zip(made, list(arrow)[1:]))], names=arrow.names)
                words = {"lot": [lot], "pairs": [dictionary], "holders": [holders]}
                yield pa.RecordBatch.from_arrays([
                    pa.array(words.get(f.name, [None]), f.type) if f.name != "doc_id" else pa.nulls(1, column.type)
                    for f in arrow], names=arrow.names)

    return stored(map_batches(docs.select("doc_id", "text"), run, schema), "alignment")


def align_tokens(docs: DataFrame, ranks: str, pieces: str, digest: bool = False) -> DataFrame:
    """``doc_id, n_a, n_b, n_groups, n_links, n_best, count_sum, groups`` of every document, one row per input row.

    Tokens of A (rank file ``ranks``) and B (piece model ``pieces``) of a blank and the text. Links are all pairs of an
    A and a B token occurrence in one group; the count of an id pair is the number of input rows that hold it linked.
    ``n_best`` counts the links whose pair has the highest count of its A id, ties included, ``count_sum`` adds the
    counts of all links up. ``groups`` are the ids group by group, or their SHA-256 if ``digest``.

    A text that is null, empty, or that one of the tokenizers does not give back byte by byte has no tokens: zeros and
    empty ``groups``. Repeated rows count each. An empty table gives no rows; other columns are ignored. Both files must
    lie on all executors. A task holds one lot of documents, or one longer document, and the distinct pairs in it.
    """
    spark = docs.sparkSession
    rows = aligned(docs, ranks, pieces, digest)
    words = rows.where("pairs IS NOT NULL").select(
        "lot", F.explode(F.arrays_zip("pairs", "holders")).alias("w")).select("lot", "w.pairs", "w.holders")
    counts = stored(words.groupBy("pairs").agg(F.sum("holders").alias("count")), "pair-counts")
    best = counts.groupBy(F.shiftright("pairs", _WIDE).alias("a")).agg(F.max("count").alias("best"))
    ranked = counts.withColumn("a", F.shiftright("pairs", _WIDE)).join(best, "a").select(
        "pairs", "count", (F.col("count") == F.col("best")).alias("is_best"))
    known = words.select("lot", "pairs").join(ranked, "pairs").select(
        F.col("lot").alias("of_lot"), "pairs", "count", "is_best")
    texts = rows.where("pairs IS NULL").drop("pairs", "holders")
    out = T.StructType([
        *(T.StructField(f.name, f.dataType) for f in texts.schema if f.name not in ("lot", "places", "links")),
        T.StructField("n_best", T.LongType()), T.StructField("count_sum", T.LongType())])
    arrow = to_arrow_schema(out)

    def judge(left: pa.Table, right: pa.Table) -> pa.Table:
        order = np.argsort(right.column("pairs").to_numpy())
        count, is_best = right.column("count").to_numpy()[order], right.column("is_best").to_numpy()[order]
        total, most = [], []
        places, links = left.column("places"), left.column("links")
        for place, times in zip(places, links):
            place, times = place.values.to_numpy(), times.values.to_numpy()
            total.append(int((count[place] * times).sum()))
            most.append(int(times[is_best[place]].sum()))
        made = {"n_best": most, "count_sum": total}
        return pa.table({f.name: pa.array(made[f.name], f.type) if f.name in made else left.column(f.name) for f in arrow})

    workers_find_package(spark)
    return texts.groupBy("lot").cogroup(known.groupBy("of_lot")).applyInArrow(judge, out)
