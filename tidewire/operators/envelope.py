"""From events to topic records: gate, route, key, partition and offset."""

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import Window as W

from tidewire import schemas
from tidewire.functions import events as ev
from tidewire.functions.codec import encode_any
from tidewire.functions.instants import to_instant
from tidewire.functions.sql import cases, literal, literals
from tidewire.functions.text import is_blank
from tidewire.operators.catalog import LOCAL_PARTITIONS
from tidewire.session import write_through


def partition_of(key: str, partitions: str) -> str:
    """Partition a record key belongs to: one key, one partition.

    A stand-in for the broker client's own hash, from the first 32 bits of the key's MD5.
    """
    return f"CAST(pmod(CAST(conv(left(md5({key}), 8), 16, 10) AS BIGINT), {partitions}) AS INT)"


def publishable(events: DataFrame, partitions: dict[str, int] = LOCAL_PARTITIONS) -> DataFrame:
    """Events that reach a topic, with ``topic``, ``key`` and ``partition``.

    Records without a key are spread over the partitions by their event id.

    System events have no topic. A user action with a blank user is turned away
    at the door; interactions are only checked by their consumer. The step is
    one narrow projection.
    """
    turned_away = f"category = {literal(schemas.USER_ACTION)} AND {is_blank('user_id')}"
    counts = cases({f"topic = {literal(name)}": str(count) for name, count in partitions.items()})
    return (
        events.where(f"category IN ({literals(ev.ROUTES)}) AND NOT ({turned_away})")
        .selectExpr("*", f"{ev.topic_of()} AS topic", f"{ev.key_of()} AS key")
        .selectExpr("*", f"{partition_of('coalesce(key, event_id)', counts)} AS partition")
    )


def assign_offsets(records: DataFrame, order_by: tuple[str, ...] = ("occurred_at", "event_id")) -> DataFrame:
    """Add ``offset``: the 0-based position of a record in its topic partition.

    A topic partition may hold any share of the data, so it is never sorted in
    one task. The records are range-partitioned on the full sort key (equal
    keys are split by arrival), each range is sorted on its own, and the
    position inside a range plus the count of the ranges before it gives the
    offset. The ranged rows are stored once, because the counts and the offsets
    must see the same ranges; ``session.released`` deletes them. The table of range starts has at most one row
    per range and topic partition, so it is broadcast. The number of ranges is
    the session's (``spark.sql.adaptive.coalescePartitions.initialPartitionNum``,
    else ``spark.sql.shuffle.partitions``): set it high, adaptive execution merges small ranges before the sort.
    """
    sort_key = ["topic", "partition", *order_by, "_arrival"]
    ranged = (
        records.withColumn("_arrival", F.monotonically_increasing_id())
        .repartitionByRange(*sort_key)
        .sortWithinPartitions(*sort_key)
        .drop("_arrival")
        .withColumn("_at", F.monotonically_increasing_id())
    )
    stored = write_through(ranged, "offsets").withColumn("_range", F.shiftright("_at", 33))
    earlier = W.partitionBy("topic", "partition").orderBy("_range").rowsBetween(W.unboundedPreceding, -1)
    shift = F.coalesce(F.sum("_size").over(earlier), F.lit(0)) - F.col("_first")
    starts = (
        stored.groupBy("topic", "partition", "_range")
        .agg(F.min("_at").alias("_first"), F.count("*").alias("_size"))
        .select(
            F.col("topic").alias("_topic"), F.col("partition").alias("_partition"), F.col("_range").alias("_of"),
            shift.alias("_shift"))
    )
    # Null-safe: a record whose partition nobody has declared keeps its place in a series of its own.
    same = (
        F.col("topic").eqNullSafe(F.col("_topic")) & F.col("partition").eqNullSafe(F.col("_partition"))
        & (F.col("_range") == F.col("_of")))
    return (
        stored.join(F.broadcast(starts), same)
        .withColumn("offset", F.col("_at") + F.col("_shift"))
        .drop("_at", "_range", "_shift", "_topic", "_partition", "_of")
    )


def envelopes(events: DataFrame, *columns: str, partitions: dict[str, int] = LOCAL_PARTITIONS) -> DataFrame:
    """Published events with topic, partition and offset, plus the named columns.

    Name only what is needed: everything else is pruned before the range shuffle.
    """
    needed = dict.fromkeys(("topic", "partition", "occurred_at", "event_id", *columns))
    return assign_offsets(publishable(events, partitions).select(*needed))


def topic_records(events: DataFrame, partitions: dict[str, int] = LOCAL_PARTITIONS) -> DataFrame:
    """Published events as topic records in the column shape of the Kafka source.

    The values are encoded after the shuffle: typed columns are smaller than
    JSON text, and the sampling of the range sort would encode every value too.
    """
    columns = dict.fromkeys(column for name in ev.ROUTES for column in schemas.WIRE_FIELDS[name].values())
    return as_topic_records(envelopes(events, "key", "category", *columns, partitions=partitions))


def as_topic_records(placed: DataFrame) -> DataFrame:
    """Envelopes that still have their event columns, encoded as topic records."""
    return placed.selectExpr(
        "topic",
        "partition",
        "offset",
        "key",
        f"{encode_any(*ev.ROUTES)} AS value",
        f"{to_instant('occurred_at')} AS timestamp",
    )


def delivery_receipts(records: DataFrame, *columns: str) -> DataFrame:
    """What the sender learns back per published event: topic, partition and offset."""
    return records.select("event_id", "topic", "partition", "offset", *columns)


def first_record(records: DataFrame) -> DataFrame:
    """The first available record, by topic, partition and offset."""
    return records.orderBy("topic", "partition", "offset").limit(1)


def first_published(events: DataFrame, order_by: tuple[str, ...] = ("occurred_at", "event_id")) -> DataFrame:
    """The first record that ``publishable`` events will have, at offset 0, without numbering the others."""
    return events.orderBy("topic", "partition", *order_by).limit(1).withColumn("offset", F.lit(0).cast("bigint"))


def find_records(records: DataFrame, key: str, contained: str) -> DataFrame:
    """Records with the given key whose value contains the given text."""
    return records.where((F.col("key") == key) & F.col("value").contains(contained))


def find_published(
    records: DataFrame, found: str, order_by: tuple[str, ...] = ("occurred_at", "event_id"), span: str = "hour"
) -> DataFrame:
    """The ``publishable`` events that meet the condition ``found``, with the ``offset`` they will have.

    The topic is not numbered for a few records. Counts per partition and span of the first ordering column tell how
    many records precede a span; only the spans that hold a record found are put in order, by ``assign_offsets``, with
    no more than the ordering columns. Those spans may hold any share of the topic.
    """
    place = ["topic", "partition"]
    marked = records.select(
        *place, *order_by, F.date_trunc(span, F.col(order_by[0])).alias("_span"),
        F.expr(f"coalesce({found}, false)").alias("_found"))
    counts = marked.groupBy(*place, "_span").agg(F.count("*").alias("_size"), F.max("_found").alias("_holds"))
    earlier = W.partitionBy(*place).orderBy("_span").rowsBetween(W.unboundedPreceding, -1)
    left_out = F.sum(F.when(~F.col("_holds"), F.col("_size")).otherwise(0)).over(earlier)
    spans = counts.withColumn("_before", F.coalesce(left_out, F.lit(0))).where("_holds").select(
        *(F.col(name).alias(f"_of_{name}") for name in place), F.col("_span").alias("_of_span"), "_before")
    same = F.col("_span").eqNullSafe(F.col("_of_span"))
    for name in place:
        same &= F.col(name).eqNullSafe(F.col(f"_of_{name}"))
    placed = assign_offsets(marked.join(spans, same).select(*place, *order_by, "_found", "_before"), order_by)
    return placed.where("_found").withColumn("offset", F.col("offset") + F.col("_before")).drop("_found", "_before")


def key_order_audit(
    records: DataFrame, order_by: tuple[str, ...] = ("occurred_at", "event_id"), block: int = 1_000_000
) -> DataFrame:
    """Per key: partitions it was seen on, and inversions.

    An inversion is a record that comes right after a later one of its key, by offset in one partition.

    A hot key may hold any share of the records, so it is not walked in one
    task. Offsets are unique within a topic partition, hence a block of
    offsets holds at most ``block`` records: order is checked inside blocks
    and then between the last and first record of a key's adjacent blocks.
    """
    place = ["topic", "key", "partition", "_block"]
    moment = F.struct(*order_by)
    in_block = W.partitionBy(*place).orderBy("offset")
    blocks = (
        records.select("topic", "key", "partition", "offset", moment.alias("_moment"))
        .withColumn("_block", F.floor(F.col("offset") / block))
        .withColumn("_before", F.lag("_moment").over(in_block))
        .groupBy(*place)
        .agg(
            F.count_if(F.col("_before") > F.col("_moment")).alias("_inversions"),
            F.min_by("_moment", "offset").alias("_head"),
            F.max_by("_moment", "offset").alias("_tail"),
        )
    )
    between = W.partitionBy("topic", "key", "partition").orderBy("_block")
    return (
        blocks.withColumn("_crossed", (F.lag("_tail").over(between) > F.col("_head")).cast("int"))
        .groupBy("topic", "key")
        .agg(
            F.count_distinct("partition").alias("partitions"),
            (F.sum("_inversions") + F.coalesce(F.sum("_crossed"), F.lit(0))).alias("inversions"),
        )
    )
