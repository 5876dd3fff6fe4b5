"""Language-model scores of texts: a word-count base, and a causal self-attention model over subword ids.

Counts come from all training documents, and the attention weights are fit on all windows of them.
They are fit on the executors: windows are dealt into shards, each round trains every shard from the same weights and
averages what comes out in a tree. The driver holds one set of weights.
"""

import numpy as np
import pandas as pd
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.pandas.types import to_arrow_schema

from tidewire.llm import attention_model as attention
from tidewire.llm.common import crc_fold, map_batches, map_texts, release, schema_of, shuffles_deleted, slices, stored
from tidewire.llm.encoders import byte_encoder

#: A word with more than this share of all tokens is looked up in a table that every task has; there are fewer such
#: words than one over the share. All other words meet their counts in a shuffle.
FREQUENT_SHARE = 1 / 500_000
HELD_WORDS = 200_000
#: Characters of texts whose words are told apart at once.
WORD_CHARS = 1_000_000
#: Windows of one step of the fit.
BATCH = 48
#: Share of all training windows that the fit sees: all. With a smaller one, so many windows for each of ``sample`` at least.
FIT_SHARE = 1.0
FIT_LEAST = 8
#: Windows that one task trains on, rounds of training and averaging, and sets of weights that one task adds up.
SHARD = 32_768
ROUNDS = 4
FAN_IN = 16


def base_words(texts: list[str]) -> tuple[pa.Array, np.ndarray]:
    """The words of all texts in a row, A-Z lower-cased, and how many each text has."""
    trimmed = pc.ascii_trim_whitespace(pc.ascii_lower(pa.array(texts, pa.large_string())))
    split = pc.ascii_split_whitespace(trimmed)
    sizes = np.where(pc.equal(trimmed, "").to_numpy(zero_copy_only=False), 0, pc.list_value_length(split).to_numpy())
    words = split.flatten().cast(pa.large_binary())  # a text without words has been split into one empty word
    return words.filter(pc.not_equal(pc.binary_length(words), 0)), sizes


def counted(words: pa.Table) -> pa.Table:
    """``word, n`` with each word once."""
    return words.group_by("word").aggregate([("n", "sum")]).rename_columns({"n_sum": "n"})


def _prepared(docs: DataFrame, tokenizer: str) -> DataFrame:
    """Stored in one pass over the texts, by ``kind``: ``ids`` of each document, partial ``words`` and ``tokens``."""
    size = len(byte_encoder(tokenizer).table)
    keyed = docs.select(
        "doc_id", F.xxhash64("text").alias("text_key"), (crc_fold("doc_id", 7) == 2).alias("held_out"), "text")
    schema = schema_of(
        keyed, ["doc_id", "text_key", "held_out"], "kind string, ids binary, word binary, token int, n long")
    arrow = to_arrow_schema(schema)
    nothing = pa.table({"word": pa.array([], pa.large_binary()), "n": pa.array([], pa.int64())})

    def rows(kind, count, **columns):
        return pa.RecordBatch.from_arrays([
            columns.get(f.name, pa.array([kind] * count, f.type) if f.name == "kind" else pa.nulls(count, f.type))
            for f in arrow], names=schema.names)

    def words(held):
        for batch in held.to_batches(HELD_WORDS):
            yield rows("words", batch.num_rows, word=batch.column("word").cast(pa.binary()), n=batch.column("n"))

    def run(batches):
        encode = byte_encoder(tokenizer)
        held, tokens, ends = nothing, np.zeros(size, np.int64), 0
        for batch in batches:
            for part, texts in slices(batch, "text", most=WORD_CHARS):
                learnt = [i for i, held_out in enumerate(part.column(2).to_pylist()) if not held_out]
                found = [np.array(encode.ids(text), "<u2") for text in texts]
                yield rows("ids", len(found), ids=pa.array([f.tobytes() for f in found], pa.binary()), **{
                    n: part.column(at) for at, n in enumerate(("doc_id", "text_key", "held_out"))})
                if not learnt:
                    continue
                ends += len(learnt)
                tokens += np.bincount(np.concatenate([found[i] for i in learnt]), minlength=size)
                distinct = base_words([texts[i] for i in learnt])[0].value_counts()
                held = pa.concat_tables([held, pa.table({"word": distinct.field(0), "n": distinct.field(1)})])
                if len(held) > 2 * HELD_WORDS:
                    held = counted(held)
                    if len(held) > HELD_WORDS:
                        yield from words(held)
                        held = nothing
        yield from words(counted(held))
        seen = np.flatnonzero(tokens)
        yield rows("tokens", len(seen) + 1, token=pa.array([*seen, -1], pa.int32()), n=pa.array([*tokens[seen], ends], pa.int64()))

    return stored(map_batches(keyed, run, schema), "lm-prepared", "kind")


class Frequent:
    """Counts of the frequent words."""

    def __init__(self, words: pa.Array, counts: np.ndarray):
        self.words, self.counts = words, np.append(counts, 0)

    def of(self, words: pa.Array) -> np.ndarray:
        """Count of each word, 0 for those not in the table."""
        return self.counts[pc.fill_null(pc.index_in(words, self.words), len(self.words)).to_numpy()]


def base_scores(docs: DataFrame, counts: DataFrame, ends: int, n: int, v: int) -> DataFrame:
    """``doc_id, text_key, n_tokens, n_known, base_score`` of every row.

    Frequent words find their counts in the task; the others, once per row and word, meet theirs in a shuffle where
    none of them has many rows.
    """
    often = counts.where(F.col("n") > FREQUENT_SHARE * n).toArrow()  # fewer rows than one over the share
    frequent = Frequent(
        pa.chunked_array(often.column("word").chunks, pa.binary()).combine_chunks(), often.column("n").to_numpy())
    keyed = docs.select(
        "doc_id", F.xxhash64("text").alias("text_key"), F.monotonically_increasing_id().alias("row"), "text")
    end = float(np.log10(ends + 1))

    def judge(texts: list[str]) -> list:
        every, sizes = base_words(texts)
        flat = every.cast(pa.binary()).dictionary_encode()
        codes, found = flat.indices.to_numpy(), frequent.of(flat.dictionary)
        owner = np.repeat(np.arange(len(texts)), sizes)
        known, count = found[codes] > 0, found[codes]
        logs = np.bincount(owner, np.where(known, np.log10(count + 1.0), 0.0), len(texts)) + end
        seen = np.bincount(owner, known, len(texts)).astype(np.int64) + int(ends > 0)
        rare = np.flatnonzero(~known)
        pairs, times = np.unique(owner[rare] * max(1, len(found)) + codes[rare], return_counts=True)
        words, starts = flat.dictionary, np.searchsorted(pairs, np.arange(len(texts) + 1) * max(1, len(found)))
        tail = pa.ListArray.from_arrays(pa.array(starts, pa.int32()), pa.StructArray.from_arrays(
            [words.take(pa.array(pairs % max(1, len(found)))), pa.array(times, pa.int32())], ["word", "times"]))
        return [sizes + 1, logs, seen, tail]

    parts = map_texts(
        keyed, ["doc_id", "text_key", "row"], lambda: judge,
        "n_tokens long, logs double, known long, tail array<struct<word:binary,times:int>>")
    # One more row stands for the document itself. Its key holds a blank, so it meets no word, and spreads the rows.
    head = F.struct(F.concat(F.lit(" "), F.col("row").cast("string")).cast("binary").alias("word"), F.lit(0).alias("times"))
    each = parts.select(
        "doc_id", "text_key", "row", "n_tokens", "logs", "known", F.inline(F.concat(F.array(head), "tail")))
    own = lambda name: F.when(F.col("times") == 0, F.col(name)).alias(name)
    rare = counts.where(F.col("n") <= FREQUENT_SHARE * n)
    met = each.select("row", "word", "times", *map(own, ("doc_id", "text_key", "n_tokens", "logs", "known"))).join(
        rare, "word", "left")
    found = F.col("n").isNotNull()
    whole = float(np.log10(n + 1.0 * (v + 1)))
    return met.groupBy("row").agg(
        F.max("doc_id").alias("doc_id"), F.max("text_key").alias("text_key"), F.max("n_tokens").alias("n_tokens"),
        (F.max("known") + F.coalesce(F.sum(F.when(found, F.col("times"))), F.lit(0))).alias("n_known"),
        (F.max("logs") + F.coalesce(F.sum(F.when(found, F.col("times") * F.log10(F.col("n") + 1))), F.lit(0.0))
         ).alias("logs"),
    ).select("doc_id", "text_key", "n_tokens", "n_known", (F.col("logs") - F.col("n_tokens") * whole).alias("base_score"))


def fit_windows(prepared: DataFrame, end: int, sample: int) -> DataFrame:
    """Stored ``order, window``: windows of whole training documents, end token included, each chosen by its own hash."""
    ids = prepared.where("kind = 'ids' AND NOT held_out").select(F.xxhash64("doc_id", "text_key").alias("hash"), "ids")
    total = ids.agg(F.coalesce(
        F.sum(F.expr(f"(length(ids) div 2 + {attention.SPAN}) div {attention.SPAN}")), F.lit(0))).first()[0]
    share = max(FIT_SHARE, FIT_LEAST * sample / max(1, total))
    limit = np.uint64(min(share, 1.0) * (2 ** 64 - 2 ** 12))
    schema = T.StructType([T.StructField("order", T.LongType()), T.StructField("window", T.BinaryType())])

    def choose(batches):
        for batch in batches:
            for start in range(0, batch.num_rows, 500):
                part = batch.slice(start, 500)
                each = [attention.training_windows(np.append(np.frombuffer(text, "<u2"), end)) for text in part.column(1).to_pylist()]
                sizes = np.array([len(rows) for rows in each])
                within = np.arange(sizes.sum()) - np.repeat(np.cumsum(sizes) - sizes, sizes)
                mixed = pd.util.hash_array(np.repeat(part.column(0).to_numpy().view(np.uint64), sizes) + within.astype(np.uint64))
                rows = np.concatenate(each).astype("<u2", copy=False)
                if share < 1:
                    chosen = mixed < limit
                    mixed, rows = mixed[chosen], rows[chosen]
                windows = pa.Array.from_buffers(pa.binary(rows[:1].nbytes), len(rows), [None, pa.py_buffer(rows)]) if len(rows) else pa.array([])
                yield pa.RecordBatch.from_arrays([pa.array(mixed.view(np.int64)), windows.cast(pa.binary())], names=schema.names)

    return stored(map_batches(ids, choose, schema), "lm-windows")


def averaged(states: DataFrame, shards: int) -> np.ndarray:
    """Mean of the sets of weights of all shards, by the number of windows of each; added up in a tree."""
    def add(part: pa.Table) -> pa.Table:
        total = sum(np.frombuffer(s.as_py(), np.float64) for s in part.column("state"))
        return pa.table({
            "shard": pa.array([part.column("shard")[0].as_py() // FAN_IN], pa.int64()),
            "n": pa.array([pc.sum(part.column("n")).as_py()], pa.int64()), "state": pa.array([total.tobytes()], pa.binary())})

    while shards > 1:
        states = states.groupBy(F.expr(f"shard div {FAN_IN}")).applyInArrow(add, states.schema)
        shards = -(-shards // FAN_IN)
    row = states.first()  # one set of weights
    return (np.frombuffer(row.state, np.float64) / row.n).astype(np.float32)


def by_shard(batches):
    """(shard, rows) of batches in the order of ``shard``."""
    held, of = [], None
    for batch in batches:
        shards = batch.column(0).to_numpy()
        cuts = [0, *(np.flatnonzero(np.diff(shards)) + 1).tolist(), len(shards)]
        for start, end in zip(cuts, cuts[1:]):
            if start == end:
                continue
            if held and shards[start] != of:
                yield of, pa.Table.from_batches(held)
                held = []
            of = int(shards[start])
            held.append(batch.slice(start, end - start))
    if held:
        yield of, pa.Table.from_batches(held)


def train_shards(windows: DataFrame, model: attention.Attention, vocabulary: attention.Vocabulary, steps: int) -> None:
    """Fit ``model`` in rounds: every shard of the windows is trained from the mean of the round before."""
    count = windows.count()
    shards = max(1, -(-count // SHARD))
    # Repeated rows give equal windows, so the place in the table deals them out.
    place = F.pmod(F.xxhash64("order", F.monotonically_increasing_id()), F.lit(shards))
    dealt = windows.select(place.alias("shard"), "order", "window")
    schema = T._parse_datatype_string("shard long, n long, state binary")
    for at in range(ROUNDS if count else 0):
        start = model.state()

        def trained_alone(part: pa.Table) -> tuple[np.ndarray, int]:
            rows = np.frombuffer(b"".join(part.column("window").to_pylist()), "<u2").reshape(-1, attention.SPAN + 1)
            rows = rows[np.lexsort((rows[:, 1], part.column("order").to_numpy()))]
            whole = max(-(-steps // shards), -(-len(rows) // BATCH))
            mine = attention.Attention(vocabulary)
            mine.resume(start)
            mine.train(
                len(rows), lambda chosen: attention.picked(vocabulary, rows[chosen]), whole, BATCH,
                part=(whole * at // ROUNDS, whole * (at + 1) // ROUNDS))
            return mine.state().astype(np.float64) * len(rows), len(rows)

        def train(batches):
            """One row a task: a set of weights can be larger than its shard, so those of a task are added up here."""
            total, n, least = 0.0, 0, None
            for shard, part in by_shard(batches):
                state, rows = trained_alone(part)
                total, n, least = total + state, n + rows, shard if least is None else least
            if n:
                yield pa.RecordBatch.from_arrays(
                    [pa.array([least], pa.int64()), pa.array([n], pa.int64()), pa.array([total.tobytes()], pa.binary())],
                    names=schema.names)

        with shuffles_deleted(windows.sparkSession):  # each round deals all windows anew
            trained = stored(map_batches(dealt.repartition("shard").sortWithinPartitions("shard"), train, schema), "lm-states")
            model.resume(averaged(trained, shards))
        release(trained)


def fit(prepared: DataFrame, tokenizer: str, sample: int, steps: int) -> tuple[attention.Attention, attention.Vocabulary]:
    encode = byte_encoder(tokenizer)
    end = len(encode.table)
    counts = np.zeros(end + 1)
    totals = prepared.where("kind = 'tokens'").groupBy("token").agg(F.sum("n").alias("n"))
    for token, n in totals.collect():  # one row per token of the vocabulary
        counts[token if token >= 0 else end] = n
    tokens = [*encode.table, b""]
    vocabulary = attention.Vocabulary(counts, tokens)
    model = attention.Attention(vocabulary)
    windows = fit_windows(prepared, end, sample)
    train_shards(windows, model, vocabulary, steps)
    release(windows)
    return model, vocabulary


def lm_scores(docs: DataFrame, tokenizer: str, sample: int = 4000, steps: int = 1500) -> DataFrame:
    """``doc_id, held_out, n_tokens, n_known, train_tokens, base_score, score``, one row per input row.

    Documents whose crc32(doc_id) modulo 7 is 2 are held out of all counts and of the fit. The fit sees
    all windows, in ``steps`` steps or as many as meet each window once; ``sample`` counts with a lower ``FIT_SHARE`` alone. Null texts are empty: their end token alone is
    scored. Repeated rows score alike and count each; other columns are ignored. Without training documents every
    count is 0 and the model is untrained.
    """
    prepared = _prepared(docs, tokenizer)
    with shuffles_deleted(docs.sparkSession):
        counts = stored(
            prepared.where("kind = 'words' AND word IS NOT NULL").groupBy("word").agg(F.sum("n").alias("n")), "lm-counts")
    sums = counts.agg(F.coalesce(F.sum("n"), F.lit(0)).alias("n"), F.count("*").alias("v")).first()
    ends = prepared.where("kind = 'tokens' AND token = -1").agg(F.coalesce(F.sum("n"), F.lit(0))).first()[0]
    n, v = sums.n + ends, sums.v + int(ends > 0)
    base = base_scores(docs, counts, ends, n, v)
    model, vocabulary = fit(prepared, tokenizer, sample, steps)
    end = len(byte_encoder(tokenizer).table)
    held = prepared.where("kind = 'ids'").select("doc_id", "text_key", "held_out", "ids")
    schema = schema_of(held, ["doc_id", "text_key", "held_out"], "score double")

    def score(batches):
        for batch in batches:
            for start in range(0, batch.num_rows, 500):
                part = batch.slice(start, 500)
                ids = [np.append(np.frombuffer(i, "<u2").astype(np.int64), end) for i in part.column(3).to_pylist()]
                yield pa.RecordBatch.from_arrays(
                    [*part.columns[:3], pa.array(attention.score_documents(model, vocabulary, ids), pa.float64())],
                    names=schema.names)

    scored = map_batches(held, score, schema).withColumnsRenamed({"doc_id": "_doc", "text_key": "_key"}).dropDuplicates(
        ["_doc", "_key"])
    return base.join(
        scored, F.col("doc_id").eqNullSafe(F.col("_doc")) & F.col("text_key").eqNullSafe(F.col("_key"))
    ).select("doc_id", "held_out", "n_tokens", "n_known", F.lit(n).cast("long").alias("train_tokens"), "base_score", "score")
