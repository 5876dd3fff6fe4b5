"""Mixture-controlled packing: deficit round-robin over source queues into windows of fixed length.

Every round gives each queue its quantum, the window length times its target share, an exact fraction. A queue sends
its next slice as soon as its saved-up quanta cover it but for a credit below the slice's length, and carries the rest
as deficit. The credit comes from a hash of the queue's name, so that queues of one slice do not all end in the last
round. With all queue lengths known, the round of a slice has a closed form, ceil((queue tokens up to its end - credit)
/ quantum), so deficits carry across windows and tasks through prefix sums, and no task walks a queue.
"""

import zlib

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import to_arrow_schema

from tidewire.llm.common import map_batches, schema_of, slices, stored
from tidewire.llm.encoders import byte_encoder

#: Rounds whose slices are ordered together: bounds a window group by the tokens of so many rounds.
ROUNDS = 64
#: Units of the largest target; the others are rounded to them.
TARGET_UNITS = 1_000_000_000
#: Groups of rounds whose sums are added up together.
GROUPS = 4096


def tokenised(docs: DataFrame, tokenizer: str, end_id: int) -> DataFrame:
    """Stored rows ``row, part, queue, doc_id, n, before, ids``: ids as 16-bit integers, ``before`` the tokens of the
    same queue earlier in the same task."""
    keep = docs.select("doc_id", F.coalesce(F.col("source").cast("string"), F.lit("")).alias("queue"), "text")
    schema = schema_of(keep, ["doc_id", "queue"], "row long, part int, n long, before long, ids binary")
    types = list(to_arrow_schema(schema))[2:]

    def run(batches):
        encode, part, row, sent = byte_encoder(tokenizer), TaskContext.get().partitionId(), 0, {}
        for batch in batches:
            for piece, texts in slices(batch, "text"):
                queues = piece.column(1).to_pylist()
                made = ([], [], [], [], [])
                for queue, text in zip(queues, texts):
                    ids = encode.ids(text)
                    ids.append(end_id)
                    before = sent.get(queue, 0)
                    sent[queue] = before + len(ids)
                    for column, value in zip(
                            made, (part << 36 | row, part, len(ids), before, np.array(ids, "<u2").tobytes())):
                        column.append(value)
                    row += 1
                columns = [piece.column(0), piece.column(1), *(pa.array(v, t.type) for v, t in zip(made, types))]
                yield pa.RecordBatch.from_arrays(columns, names=schema.names)

    return stored(map_batches(keep, run, schema), "packing-ids")


def schedule(tokens: DataFrame, window: int, targets: dict[str, float] | None, least: int) -> DataFrame:
    """Slices ``row, start, length, queue, round, position``: ``position`` counts the tokens sent before the slice."""
    spark = tokens.sparkSession
    sums = tokens.groupBy("part", "queue").agg(F.sum("n").alias("sum"))
    earlier = Window.partitionBy("queue").orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    totals = sums.groupBy("queue").agg(F.sum("sum").alias("weight"))
    if targets is not None:  # a queue without a target gets what is left over after the others: a token a round
        largest = max(map(float, targets.values()), default=0.0) or 1.0
        given = spark.createDataFrame(
            [(k, int(float(v) / largest * TARGET_UNITS)) for k, v in targets.items()], "queue string, target long")
        totals = totals.drop("weight").join(given, "queue", "left").withColumn("weight", F.coalesce("target", F.lit(0))).drop("target")
    whole = totals.agg(F.coalesce(F.sum("weight"), F.lit(0))).first()[0]
    weight = F.when(F.col("weight") > 0, F.col("weight")).otherwise(max(1, whole // window))
    step = F.greatest(F.lit(least), F.expr(f"CAST(CAST({window} AS DECIMAL(10,0)) * weight div {max(1, whole)} AS BIGINT)"))
    quanta = totals.withColumn("weight", weight.cast("long")).withColumn("step", step.cast("long"))
    starts = sums.withColumn("base", F.coalesce(F.sum("sum").over(earlier), F.lit(0))).join(quanta, "queue").select(
        "part", "queue", "base", "weight", "step")
    sliced = tokens.select("row", "part", "queue", "n", "before").join(starts, ["part", "queue"]).select(
        "row", "queue", "n", "weight", (F.col("base") + F.col("before")).alias("at"), "step",
        F.explode(F.sequence(F.lit(0).cast("long"), F.col("n") - 1, F.col("step"))).alias("start"))
    # Tokens and weights stay below 10^18, so the products are exact in 38 digits.
    share = f"CAST({window} AS DECIMAL(10,0)) * CAST(weight AS DECIMAL(18,0))"
    owed = f"CAST(end - pmod(xxhash64(queue), length) AS DECIMAL(18,0)) * CAST({max(1, whole)} AS DECIMAL(18,0))"
    slices_ = sliced.withColumn("length", F.least("step", F.col("n") - F.col("start"))).withColumn(
        "end", F.col("at") + F.col("start") + F.col("length")).withColumn(
        "round", F.expr(f"({owed} + {share} - 1) div ({share})")).withColumn(
        "group", F.expr(f"round div {ROUNDS}")).select("row", "queue", "start", "length", "end", "round", "group")
    # Tokens sent before each group of rounds, added up in two steps.
    groups = slices_.groupBy("group").agg(F.sum("length").alias("sum")).withColumn("over", F.expr(f"group div {GROUPS}"))
    inner = Window.partitionBy("over").orderBy("group").rowsBetween(Window.unboundedPreceding, -1)
    outer = Window.orderBy("over").rowsBetween(Window.unboundedPreceding, -1)
    overs = groups.groupBy("over").agg(F.sum("sum").alias("total")).select(
        "over", F.coalesce(F.sum("total").over(outer), F.lit(0)).alias("over_base"))
    bases = groups.withColumn("inner", F.coalesce(F.sum("sum").over(inner), F.lit(0))).join(overs, "over").select(
        "group", (F.col("over_base") + F.col("inner")).alias("group_base"))
    within = Window.partitionBy("group").orderBy("round", "queue", "end").rowsBetween(Window.unboundedPreceding, -1)
    return slices_.withColumn("sent", F.coalesce(F.sum("length").over(within), F.lit(0))).join(bases, "group").select(
        "row", "start", "length", "queue", "round", (F.col("group_base") + F.col("sent")).alias("position"))


def tail_cuts(total: int, window: int) -> list[int]:
    """Where the last, unfilled window is cut into sequences of falling powers of two, which need no padding."""
    at, cuts = total - total % window, []
    for bit in range(window.bit_length() - 1, -1, -1):
        if total % window >> bit & 1:
            cuts.append(at)
            at += 1 << bit
    return cuts


def pack(
    docs: DataFrame, tokenizer: str, window: int = 2048, end_id: int = 1,
    targets: dict[str, float] | None = None, least: int = 256,
) -> DataFrame:
    """Pieces ``doc_id, start, length, ids_crc32, doc_tokens, sequence_id, offset, source, round``.

    Each document's ids, then ``end_id``, are cut into slices of at most the quantum of its source (``least`` or
    more), sent by deficit round-robin and cut at the ends of the windows; every id lies in one piece. ``targets``
    gives the shares of the sources (default: their shares of all tokens, so all queues last to the end, within a slice
    each); a queue that runs dry is skipped. Queues that send in the same round do so by name. All sequences are full but the last few, whose lengths are falling powers of two.
    ``tokenizer`` is the path of a rank file on all executors. A null text is empty and yields its end id alone; null
    sources form one queue; repeated rows are packed each; an empty table gives no rows; other columns are ignored.
    """
    if window & (window - 1):
        raise ValueError("the window must be a power of two")
    tokens = tokenised(docs, tokenizer, end_id)
    total = tokens.agg(F.coalesce(F.sum("n"), F.lit(0))).first()[0]
    full, cuts = total - total % window, tail_cuts(total, window)
    planned = schedule(tokens, window, targets, least)
    stop = F.col("position") + F.col("length")
    first = F.expr(f"(position div {window} + 1) * {window}")
    inside = F.when(first < stop, F.sequence(first, stop - 1, F.lit(window))).otherwise(F.array().cast("array<bigint>"))
    tail = F.array(*(F.lit(c) for c in cuts[1:])).cast("array<bigint>")
    marks = F.array_distinct(F.concat(inside, F.filter(tail, lambda c: (c > F.col("position")) & (c < stop))))
    bounds = F.array_sort(F.concat(F.array("position", stop), marks))
    cut = planned.withColumn("bounds", bounds).select(
        "row", "start", "round", "position", "bounds", F.posexplode(F.slice("bounds", 1, F.size("bounds") - 1)).alias("at", "from"))
    sequence = F.when(F.col("from") < full, F.expr(f"from div {window}")).otherwise(
        full // window - 1 + sum((F.when(F.col("from") >= c, 1).otherwise(0) for c in cuts), F.lit(0)))
    begun = F.when(F.col("from") < full, F.expr(f"from div {window} * {window}")).otherwise(
        F.greatest(F.lit(full), *(F.when(F.col("from") >= c, F.lit(c)) for c in cuts)) if cuts else F.lit(full))
    pieces = cut.select(
        "row", F.struct(
            (F.col("start") + F.col("from") - F.col("position")).alias("start"),
            (F.element_at("bounds", F.col("at") + 2) - F.col("from")).alias("length"),
            sequence.cast("long").alias("sequence_id"), (F.col("from") - begun).cast("long").alias("offset"),
            F.col("round")).alias("piece")).groupBy("row").agg(F.collect_list("piece").alias("pieces"))
    joined = tokens.select("row", "doc_id", F.col("queue").alias("source"), "n", "ids").join(pieces, "row").select(
        "doc_id", "source", "n", "ids", "pieces")
    schema = schema_of(
        joined, ["doc_id"], "start long, length long, ids_crc32 long, doc_tokens long, sequence_id long, offset long, "
        "source string, round long")
    types = list(to_arrow_schema(schema))[1:]

    def check(batches):
        for batch in batches:
            at, made = [], [[] for _ in types]
            for row, (source, n, ids, parts) in enumerate(zip(*(c.to_pylist() for c in batch.columns[1:]))):
                wide = memoryview(np.frombuffer(ids, "<u2").astype("<u4").tobytes())
                for p in sorted(parts, key=lambda p: p["start"]):
                    start, length = p["start"], p["length"]
                    at.append(row)
                    for column, value in zip(made, (
                            start, length, zlib.crc32(wide[4 * start:4 * (start + length)]), n, p["sequence_id"],
                            p["offset"], source, p["round"])):
                        column.append(value)
            yield pa.RecordBatch.from_arrays(
                [batch.column(0).take(pa.array(at, "int64")), *(pa.array(v, t.type) for v, t in zip(made, types))],
                names=schema.names)

    return map_batches(joined, check, schema)
