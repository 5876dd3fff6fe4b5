"""Phrase collocations by prefix-free parsing of the corpus.

A piece of text (between punctuation and line ends) is cut where its content triggers it: in front of every word whose
checksum is a multiple of ``TRIGGER``, if a whole overlap follows. A chunk reaches over its cut by ``longest - 1`` words,
so every phrase lies whole in the chunk that holds its first word before the cut, and is counted there alone. Equal
texts give equal chunks: the corpus becomes a dictionary of distinct chunks with the number of times each was parsed,
and phrases are counted inside the distinct chunks, times that number.

Words are counted first, then pairs, then all longer phrases at once. A phrase can only be frequent if its words, and
then its pairs, are; a bit table of fixed size names these, so most rare phrases are never written. The table may pass a
phrase too many, never one too few, and all counts are of whole strings.
"""

import zlib

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import xxhash
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tidewire.llm.common import map_batches, schema_of, slices, stored

#: One word in so many is a trigger, by its checksum.
TRIGGER = 8
#: Chunks, or rows of counted phrases, that a task holds before it writes them out.
HELD = 200_000
#: Words of more bytes are hashed one by one.
LONG_WORD = 64
#: Bytes of chunks whose words and phrases a task numbers together.
LOT_BYTES = 8_000_000
#: Size of the bit table, as a power of two: 16 MB, of which the driver sees set words of 64 bits only.
TABLE_BITS = 27
#: Lots in which the best phrases of a language are chosen first.
LOTS = 64

# Fixed values of the contract: marks and line ends part pieces, blank and tab part words.
_PIECES = bytes.maketrans(b".,;:!?\x0b\x0c\r\t", b"\n" * 9 + b" ")
_PRIME = np.uint64(0x9E3779B97F4A7C15)
_MIX = np.uint64(0xD6E8FEB86659FD93)


class _Triggers(dict):
    """Whether a word is a trigger; forgotten when too many are known."""

    def __missing__(self, word: bytes) -> bool:
        if len(self) > 2_000_000:
            self.clear()
        self[word] = made = zlib.crc32(word) % TRIGGER == 0
        return made


def chunks(text: str, over: int, triggers: dict) -> list[tuple[bytes, int]]:
    """Chunks of a text, words joined by one blank, with the number of words whose phrases are counted in each."""
    made = []
    for piece in text.encode("utf-8", "surrogatepass").lower().translate(_PIECES).split(b"\n"):
        words = piece.split()
        if not words:
            continue
        start = 0
        if len(words) > over + 1:
            for at in range(1, len(words) - over + 1):
                if triggers[words[at]]:
                    made.append((b" ".join(words[start:at + over]), at - start))
                    start = at
        made.append((b" ".join(words[start:]) if start else b" ".join(words), len(words) - start))
    return made


def chunk_dictionary(docs: DataFrame, longest: int) -> DataFrame:
    """Stored distinct ``lang, chunk, own`` with ``n``, the times each was parsed."""
    keep = docs.select(F.coalesce(F.col("lang").cast("string"), F.lit("und")).alias("lang"), "text")
    over = longest - 1

    def rows(held: dict, names) -> pa.RecordBatch:
        keys = list(held)
        made = ([k[0] for k in keys], [k[1] for k in keys], [k[2] for k in keys], list(held.values()))
        types = (pa.string(), pa.binary(), pa.int32(), pa.int64())
        return pa.RecordBatch.from_arrays([pa.array(v, t) for v, t in zip(made, types)], names=names)

    schema = schema_of(keep, ["lang"], "chunk binary, own int, n long")

    def run(batches):
        triggers, held, size = _Triggers(), {}, 0
        for batch in batches:
            for piece, texts in slices(batch, "text"):
                for lang, text in zip(piece.column(0).to_pylist(), texts):
                    for chunk, own in chunks(text, over, triggers):
                        key = (lang, chunk, own)
                        if key in held:
                            held[key] += 1
                        else:
                            held[key] = 1
                            size += len(chunk) + 100
                    if len(held) >= HELD or size > 40_000_000:
                        yield rows(held, schema.names)
                        held, size = {}, 0
        if held:
            yield rows(held, schema.names)

    parsed = map_batches(keep, run, schema)
    return stored(parsed.groupBy("lang", "chunk", "own").agg(F.sum("n").alias("n")), "chunks")


def _hashes(words: pa.Array) -> np.ndarray:
    """A 64-bit hash of each word: eight bytes at a time for all words at once, the few long ones by themselves."""
    distinct = words.dictionary_encode()
    text = distinct.dictionary.cast(pa.large_binary())
    bounds = np.frombuffer(text.buffers()[1], np.int64)[text.offset:text.offset + len(text) + 1] if len(text) else np.zeros(1, np.int64)
    start, end = bounds[:-1], bounds[1:]
    long = end - start > LONG_WORD
    each = (end - start).astype(np.uint64)
    data = np.append(np.frombuffer(text.buffers()[2] or b"", np.uint8), np.zeros(8, np.uint8))
    eights = np.lib.stride_tricks.sliding_window_view(data, 8)
    at = np.flatnonzero((end > start) & ~long)
    begin = start[at]
    while at.size:
        rest = np.minimum(end[at] - begin, 8).astype(np.uint64)
        block = eights[begin].view("<u8").ravel() & (~np.uint64(0) >> np.uint64(64) - np.uint64(8) * rest)
        mixed = (each[at] * _PRIME ^ block) * _MIX
        each[at] = mixed ^ mixed >> np.uint64(29)
        more = begin + 8 < end[at]
        at, begin = at[more], begin[more] + 8
    which = np.flatnonzero(long)
    each[which] = [xxhash.xxh3_64_intdigest(w) for w in text.take(pa.array(which)).to_pylist()]
    return each[distinct.indices.to_numpy()] if len(words) else np.zeros(0, np.uint64)


def _rolled(words: np.ndarray, langs: np.ndarray, size: int) -> np.ndarray:
    """Places in the bit table of the ``size`` words from every position on; the last ones run over the end."""
    at = langs.copy()
    for k in range(size):
        at = at * _PRIME + np.append(words[k:], np.zeros(k, np.uint64))
    at ^= at >> np.uint64(31)
    return (at * _MIX) >> np.uint64(64 - TABLE_BITS)


def _split(chunks_: pa.Array) -> tuple[pa.Array, np.ndarray]:
    parts = pc.split_pattern(chunks_.cast(pa.large_string()), " ")
    return parts.flatten(), np.diff(parts.offsets.to_numpy())


def bit_table(frequent: DataFrame, size: int) -> np.ndarray:
    """Bits of the given phrases of ``size`` words; the driver gets one row for each 64 bits that are not all zero."""
    def run(batches):
        for batch in batches:
            words, _ = _split(batch.column(1))
            flat = _hashes(words)
            langs = np.repeat(_hashes(batch.column(0)), size)
            places = _rolled(flat, langs, size)[::size] if len(flat) else np.zeros(0, np.uint64)
            slots = (places >> np.uint64(6)).astype(np.int64)
            yield pa.RecordBatch.from_arrays([
                pa.array(slots), pa.array((np.uint64(1) << (places & np.uint64(63))).view(np.int64))], names=["slot", "bits"])

    set_ = map_batches(frequent.select("lang", "phrase"), run, "slot long, bits long").groupBy("slot").agg(
        F.bit_or("bits").alias("bits")).toArrow()
    made = np.zeros(1 << (TABLE_BITS - 6), np.int64)
    made[set_.column("slot").to_numpy()] = set_.column("bits").to_numpy()
    return made.view(np.uint64)


def counted(dictionary: DataFrame, sizes: list[int], table: np.ndarray | None, inner: int, least: int) -> DataFrame:
    """Stored ``lang, phrase, f`` of all phrases of ``sizes`` words with at least ``least`` occurrences.

    Only phrases whose parts of ``inner`` words are all in ``table`` are looked at.
    """
    shared = dictionary.sparkSession.sparkContext.broadcast(table) if table is not None else None
    schema = schema_of(dictionary, ["lang"], "phrase string, n long")

    def summed(tables: list[pa.Table]) -> pa.Table:
        made = pa.concat_tables(tables).group_by(["lang", "phrase"]).aggregate([("n", "sum")])
        return pa.table({"lang": made["lang"], "phrase": made["phrase"], "n": made["n_sum"]})

    def written(made: pa.Table):
        return made.set_column(1, "phrase", made["phrase"].cast(pa.string())).to_batches()

    def lots(batches):
        lot, size = [], 0
        for batch in batches:
            lot.append(batch)
            size += batch.column(1).nbytes
            if size >= LOT_BYTES:
                yield from pa.Table.from_batches(lot).combine_chunks().to_batches()
                lot, size = [], 0
        if lot:
            yield from pa.Table.from_batches(lot).combine_chunks().to_batches()

    def phrases(lot: pa.RecordBatch, bits: np.ndarray | None) -> pa.Table:
        """Phrases of a lot with their times. They are told apart by numbers; only distinct ones are put into words."""
        words, lengths = _split(lot.column(1))
        coded, langs = words.dictionary_encode(), lot.column(0).dictionary_encode()
        codes, many = coded.indices.to_numpy().astype(np.int64), len(coded.dictionary)
        chunk = np.repeat(np.arange(lot.num_rows), lengths)
        inside = np.arange(len(words)) - (np.cumsum(lengths) - lengths)[chunk]
        left = lengths[chunk] - inside
        if bits is not None:
            places = _rolled(_hashes(coded.dictionary)[codes], _hashes(lot.column(0))[chunk], inner)
            known = (bits[(places >> np.uint64(6)).astype(np.int64)] >> (places & np.uint64(63)) & np.uint64(1)).astype(bool)
        at = np.flatnonzero(inside < lot.column(2).to_numpy()[chunk])
        ids, most, made = langs.indices.to_numpy().astype(np.int64)[chunk[at]], len(langs.dictionary), []
        for size in range(1, sizes[-1] + 1):
            fits = left[at] >= size
            at, ids = at[fits], ids[fits]
            if bits is not None and size >= inner:
                fits = known[at + size - inner]
                at, ids = at[fits], ids[fits]
            # A phrase is the phrase one word shorter and its last word.
            ids, most = ids * many + codes[at + size - 1], most * many
            if size not in sizes and most * many < 2 ** 63:
                continue
            ids, most = pa.array(ids).dictionary_encode().indices.to_numpy().astype(np.int64), len(at)
            if size in sizes:
                first = np.zeros(ids.max(initial=-1) + 1, np.int64)
                first[ids[::-1]] = at[::-1]
                n = np.zeros(len(first), np.int64)
                np.add.at(n, ids, lot.column(3).to_numpy()[chunk[at]])
                parts = [coded.dictionary.take(pa.array(codes[first + k])) for k in range(size)]
                phrase = pc.binary_join_element_wise(*parts, pa.scalar(" ", pa.large_string())) if size > 1 else parts[0]
                made.append(pa.table({"lang": lot.column(0).take(pa.array(chunk[first])), "phrase": phrase, "n": n}))
        return pa.concat_tables(made)

    def run(batches):
        bits = shared.value if shared is not None else None
        held, rows = [], 0
        for lot in lots(batches):
            made = phrases(lot, bits)
            if made.num_rows >= HELD:
                yield from written(made)
                continue
            held.append(made)
            rows += made.num_rows
            if rows >= 3 * HELD:
                held = [summed(held)]
                rows = held[0].num_rows
                if rows >= HELD:
                    yield from written(held[0])
                    held, rows = [], 0
        if held:
            yield from written(summed(held))

    found = map_batches(dictionary.select("lang", F.col("chunk").cast("string"), "own", "n"), run, schema).groupBy(
        "lang", "phrase").agg(F.sum("n").alias("f")).where(F.col("f") >= least)
    return stored(found, f"phrases-{sizes[0]}")


def _words(column: str, first: int, length: Column) -> Column:
    return F.array_join(F.slice(column, first, length), " ")


def collocations(docs: DataFrame, least: int = 100, longest: int = 5, top: int = 2000) -> DataFrame:
    """``lang, rank, phrase, a, l, r, n, score``: the first ``top`` phrases of 2 to ``longest`` words of each language.

    ``a`` counts the phrase (at least ``least``), ``l`` and ``r`` the parts of the cut of lowest score (ties: the
    earliest), ``n`` all words of the language; the score is ``floor(1000 a n / (l r))``, in exact decimals. A phrase
    that lies inside a longer one as frequent is dropped. Order: score and ``a`` falling, phrase rising by bytes.

    A null text is empty, a null language ``und``; repeated rows count each; an empty table gives no rows; other
    columns are ignored. The driver holds a bit table of 16 MB, at most.
    """
    dictionary = chunk_dictionary(docs, longest)
    single = counted(dictionary, [1], None, 1, least)
    pairs = counted(dictionary, [2], bit_table(single, 1), 1, least)
    found = pairs
    if longest > 2:
        found = found.unionByName(counted(dictionary, list(range(3, longest + 1)), bit_table(pairs, 2), 2, least))
    known = single.unionByName(found)
    sizes = dictionary.groupBy("lang").agg(F.sum(F.col("n") * F.col("own")).alias("n"))
    # As frequent a phrase one word longer: if any longer one is, so is one of these.
    words = F.split("phrase", " ")
    longer = found.withColumn("w", words).where(F.size("w") > 2).select("lang", "f", F.explode(F.array(
        _words("w", 1, F.size("w") - 1), _words("w", 2, F.size("w") - 1))).alias("phrase")).groupBy("lang", "phrase").agg(
        F.max("f").alias("longer"))
    kept = found.join(longer, ["lang", "phrase"], "left").where("longer IS NULL OR 100 * longer < 100 * f")
    cuts = kept.withColumn("w", words).select(
        "lang", "phrase", F.col("f").alias("a"), "w", F.explode(F.sequence(F.lit(1), F.size("w") - 1)).alias("k")).select(
        "lang", "phrase", "a", "k", _words("w", 1, F.col("k")).alias("first"),
        F.array_join(F.expr("slice(w, k + 1, size(w) - k)"), " ").alias("rest"))
    parts = known.select("lang", F.col("phrase").alias("first"), F.col("f").alias("l"))
    rests = known.select("lang", F.col("phrase").alias("rest"), F.col("f").alias("r"))
    wide = "decimal(38,0)"
    scored = cuts.join(parts, ["lang", "first"]).join(rests, ["lang", "rest"]).join(sizes, "lang").withColumn(
        "score", F.expr(f"(cast(1000 * cast(a AS {wide}) * n AS {wide})) div (cast(cast(l AS {wide}) * r AS {wide}))"))
    best = scored.groupBy("lang", "phrase").agg(F.min(F.struct("score", "k", "a", "l", "r", "n")).alias("b")).select(
        "lang", "phrase", "b.*")
    order = [F.desc("score"), F.desc("a"), F.asc("phrase")]
    lots = best.withColumn("lot", F.pmod(F.xxhash64("phrase"), F.lit(LOTS)))
    first = lots.withColumn("rank", F.row_number().over(Window.partitionBy("lang", "lot").orderBy(*order))).where(
        F.col("rank") <= top).drop("rank")
    return first.withColumn("rank", F.row_number().over(Window.partitionBy("lang").orderBy(*order)).cast("long")).where(
        F.col("rank") <= top).select("lang", "rank", "phrase", "a", "l", "r", "n", "score")
